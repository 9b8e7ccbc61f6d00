"""SQL of the training-data queries that SQL can express, over the same tables.

Whole texts are cut into words by a pattern; ids may be null, and a null text has no words.
"""

from __future__ import annotations

#: One row per row of documents, with a number of its own, its words and its lines.
WORDS = r"""
rows_of AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents),
worded AS (
  SELECT r, doc_id, body, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS w FROM rows_of)
"""

OP2 = f"""
WITH {WORDS},
windows AS (
  SELECT r, doc_id, i, array_to_string(w[i:i + 49], ' ') AS g
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM worded WHERE len(w) >= 50 AND doc_id IS NOT NULL)),
repeated AS (
  SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY g) AS least FROM windows) WHERE doc_id > least),
gone AS (
  SELECT DISTINCT r, i + k AS i FROM (SELECT r, i, unnest(range(0, 50)) AS k FROM repeated)),
single AS (
  SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM worded),
kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS body FROM single ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT worded.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.body, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (r)
"""

OP4 = r"""
WITH RECURSIVE rows_of AS (
  SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
worded AS (
  SELECT r, doc_id, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS w FROM rows_of),
shingles AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM worded WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (
  SELECT a.r AS x, b.r AS y, count(*) AS shared FROM shingles a JOIN shingles b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r),
links AS (
  SELECT x, y FROM common JOIN sizes s ON s.r = x JOIN sizes t ON t.r = y WHERE 100 * shared >= 80 * (s.n + t.n - shared)),
reach AS (
  SELECT r AS x, r AS y FROM worded
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y),
least AS (SELECT x AS r, min(doc_id) AS component_id FROM reach JOIN worded ON worded.r = reach.y GROUP BY x)
SELECT worded.doc_id, CAST(coalesce(sizes.n, 0) AS BIGINT) AS n_shingles,
       CASE WHEN sizes.n > 0 THEN least.component_id ELSE worded.doc_id END AS component_id,
       coalesce(linked.n, 0) AS n_links
FROM worded LEFT JOIN sizes USING (r) LEFT JOIN least USING (r)
LEFT JOIN (SELECT x AS r, count(*) AS n FROM links GROUP BY x) linked USING (r)
"""

OP7 = rf"""
WITH {WORDS},
windows AS (
  SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM worded WHERE len(w) >= 5)),
repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM (SELECT r, i, unnest(range(0, 5)) AS k FROM repeated) GROUP BY r),
measured AS (
  SELECT worded.*, list_filter(string_split(body, chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(covered.n, 0) AS n_repeat_words
  FROM worded LEFT JOIN covered USING (r)),
counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(body) - length(translate(body, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
         CAST(length(body) - length(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS BIGINT) AS n_capitals,
         CAST(len(lines) AS BIGINT) AS n_lines
  FROM measured)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 100 * n_symbols > 25 * n_words
            OR (n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines) OR 100 * n_capitals > 50 * word_chars
            OR word_chars > 20 * n_words OR word_chars < 2 * n_words) AS kept
FROM counted
"""

#: One round: the distance of every part to every entry, the nearest one, and its floored mean.
OP12_ROUND = """
far{k} AS MATERIALIZED (
  SELECT r, part, entry, sum((x - c) * (x - c)) AS d FROM cells JOIN book{k} USING (part, place) GROUP BY r, part, entry),
near{k} AS MATERIALIZED (
  SELECT r, part, entry, d FROM far{k} QUALIFY row_number() OVER (PARTITION BY r, part ORDER BY d, entry) = 1),
"""
OP12_MOVE = """
mean{k} AS (
  SELECT part, entry, place, sum(x) AS s, count(*) AS n FROM near{k} JOIN cells USING (r, part) GROUP BY part, entry, place),
book{next} AS MATERIALIZED (
  SELECT part, entry, place, CASE WHEN n IS NULL THEN c ELSE (s - (s % n + n) % n) // n END AS c
  FROM book{k} LEFT JOIN mean{k} USING (part, entry, place)),
"""
OP12 = """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS q, len(embedding) // 8 AS w
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS MATERIALIZED (
  SELECT r, i // w AS part, i % w AS place, q[i + 1] AS x FROM (SELECT r, q, w, unnest(range(len(q))) AS i FROM kept)),
book0 AS MATERIALIZED (SELECT part, r AS entry, place, CAST(x AS HUGEINT) AS c FROM cells WHERE r < 16),
""" + "".join(OP12_ROUND.format(k=k) + (OP12_MOVE.format(k=k, next=k + 1) if k < 6 else "") for k in range(7)) + """
coded AS (
  SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near6 GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, place)) FROM book6) AS codebooks_sha256
FROM coded JOIN kept USING (r)
"""

ORACLES: dict[str, str] = {"op2_substring_dedup": OP2, "op4_ngram_jaccard": OP4, "op7_quality_rules": OP7, "op12_vector_codes": OP12}
