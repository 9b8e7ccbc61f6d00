"""The registered queries in SQL. Every text is one list of named subqueries plus a final select."""

from __future__ import annotations

from fixtures.adapter import (
    FAVOURITE_SEGMENT, LAST_YEAR, REWORKED_YEAR, TAG_CODES, TAG_SLOTS, TAG_SLOTS_WIDE, UNNAMED_TAG,
)

_TAGS = ", ".join(
    f"('{t}', {code}, {TAG_SLOTS[t]}, {'NULL' if t == UNNAMED_TAG else repr(t)})"
    for t, code in TAG_CODES.items())


def _vectors(prefix: str, films: str, group: str, weights_after: bool = False) -> str:
    """Subqueries that turn ``films`` into ``{prefix}_vectors(id, dim, x)`` fitted per ``group``."""
    before = (1.0, 0.5, 1.2, 0.8)
    after = (1.0, 1.0, 1.0, 1.0)
    if weights_after:
        before, after = after, before
    names = ("popularity", "release_year", "vote_average", "vote_count")
    numbers = " UNION ALL ".join(
        f"SELECT id, {group} AS g, {d} AS dim, CAST({n} AS DOUBLE) * {before[d]} AS x, "
        f"{after[d]} AS w FROM {films}" for d, n in enumerate(names))
    return f"""
{prefix}_films AS (SELECT id, {group} AS g, tags FROM {films}),
{prefix}_tf AS (
  SELECT id, g, slot, COUNT(*) AS tf
  FROM (SELECT id, g, UNNEST(tags) AS tag FROM {prefix}_films) JOIN tags USING (tag)
  GROUP BY id, g, slot),
{prefix}_n AS (SELECT g, COUNT(*) AS n FROM {prefix}_films GROUP BY g),
{prefix}_df AS (SELECT g, slot, COUNT(*) AS df FROM {prefix}_tf GROUP BY g, slot),
{prefix}_idf AS (
  SELECT n.g, n.n, s.slot, LN((n.n + 1.0) / (COALESCE(df, 0) + 1.0)) AS idf
  FROM {prefix}_n n CROSS JOIN slots s
  LEFT JOIN {prefix}_df d ON d.g = n.g AND d.slot = s.slot),
{prefix}_num AS ({numbers}),
{prefix}_scale AS (
  SELECT g, dim, CASE WHEN MIN(x) = MAX(x) THEN 0.0 ELSE 1.0 / STDDEV_SAMP(x) END AS f
  FROM {prefix}_num GROUP BY g, dim),
{prefix}_counts AS (
  SELECT m.id, m.g, s.slot, COALESCE(tf, 0) AS tf
  FROM {prefix}_films m CROSS JOIN slots s
  LEFT JOIN {prefix}_tf t ON t.id = m.id AND t.slot = s.slot),
{prefix}_vectors AS (
  SELECT id, dim, x * f * w AS x FROM {prefix}_num JOIN {prefix}_scale USING (g, dim)
  UNION ALL
  SELECT id, slot + 4, tf * idf FROM {prefix}_counts JOIN {prefix}_idf USING (g, slot))"""


def _sparse(prefix: str, films: str, group: str) -> str:
    """Subqueries that turn ``films`` into ``{prefix}_vectors(id, dim, x)`` over the wide slots, entries that are not zero."""
    names = (("popularity", 1.0), ("release_year", 0.5), ("vote_average", 1.2), ("vote_count", 0.8))
    numbers = " UNION ALL ".join(
        f"SELECT id, {group} AS g, {d} AS dim, CAST({n} AS DOUBLE) * {w} AS x FROM {films}" for d, (n, w) in enumerate(names))
    wide = ", ".join(f"('{t}', {slot})" for t, slot in TAG_SLOTS_WIDE.items())
    return f"""
{prefix}_slots(tag, slot) AS (VALUES {wide}),
{prefix}_n AS (SELECT {group} AS g, COUNT(*) AS n FROM {films} GROUP BY 1),
{prefix}_tf AS (
  SELECT id, g, slot, COUNT(*) AS tf FROM (SELECT id, {group} AS g, UNNEST(tags) AS tag FROM {films}) JOIN {prefix}_slots USING (tag)
  GROUP BY id, g, slot),
{prefix}_idf AS (
  SELECT g, slot, LN((ANY_VALUE(n) + 1.0) / (COUNT(*) + 1.0)) AS idf FROM {prefix}_tf JOIN {prefix}_n USING (g) GROUP BY g, slot),
{prefix}_num AS ({numbers}),
{prefix}_scale AS (
  SELECT g, dim, CASE WHEN MIN(x) = MAX(x) THEN 0.0 ELSE 1.0 / STDDEV_SAMP(x) END AS f FROM {prefix}_num GROUP BY g, dim),
{prefix}_vectors AS (
  SELECT id, dim, x * f AS x FROM {prefix}_num JOIN {prefix}_scale USING (g, dim) WHERE x * f <> 0
  UNION ALL
  SELECT id, slot + 4, tf * idf FROM {prefix}_tf JOIN {prefix}_idf USING (g, slot) WHERE tf * idf <> 0)"""


_BASE = f"""
li AS (
  SELECT l_orderkey, AVG(l_quantity) / 5 AS va, COUNT(*) AS vc,
         STRING_AGG(DISTINCT p_type, ',' ORDER BY p_type) AS gs
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
raw AS (
  SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderkey END AS id,
         CONCAT('Title ', CAST(o_orderkey AS VARCHAR)) AS title,
         va AS vote_average, vc AS vote_count, CAST(o_orderdate AS DATE) AS release_date,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_custkey * 1000 AS BIGINT) END AS revenue,
         CAST(60 + o_orderkey % 120 AS INT) AS runtime,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 'TRUE'
              ELSE 'FALSE' END AS adult,
         CAST(NULL AS VARCHAR) AS backdrop_path,
         CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey * 10 AS BIGINT) END AS budget,
         CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE 'fr' END AS original_language,
         CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_orderstatus END AS original_title,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS overview,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice / 1000 END AS popularity,
         CAST(NULL AS VARCHAR) AS poster_path, gs AS genres,
         CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderstatus END AS production_companies,
         CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE 'US' END AS production_countries,
         CAST(NULL AS VARCHAR) AS spoken_languages,
         CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE o_orderpriority END AS keywords,
         CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS release_year
  FROM orders LEFT JOIN li ON o_orderkey = l_orderkey),
means AS (
  SELECT release_year, AVG(popularity) AS mean FROM raw WHERE id IS NOT NULL GROUP BY release_year),
cleaned AS (
  SELECT id, title, vote_average, vote_count, release_date, COALESCE(revenue, 0) AS revenue,
         runtime, COALESCE(adult, 'FALSE') AS adult, COALESCE(budget, 0) AS budget,
         COALESCE(original_language, 'en') AS original_language,
         COALESCE(original_title, 'nan') AS original_title,
         COALESCE(overview, 'nan') AS overview, COALESCE(popularity, mean) AS popularity,
         COALESCE(genres, 'nan') AS genres,
         COALESCE(production_companies, 'nan') AS production_companies,
         COALESCE(production_countries, 'nan') AS production_countries,
         COALESCE(keywords, 'nan') AS keywords, release_year
  FROM raw JOIN means USING (release_year) WHERE id IS NOT NULL),
tags(tag, code, slot, name) AS (VALUES {_TAGS}),
slots AS (SELECT UNNEST(RANGE(20)) AS slot),
complete AS (
  SELECT *, STRING_SPLIT(genres, ',') AS tags FROM cleaned
  WHERE vote_average IS NOT NULL AND popularity IS NOT NULL),
favourites AS (
  SELECT c.* FROM complete c JOIN orders ON c.id = o_orderkey
  JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = '{FAVOURITE_SEGMENT}'),
fav_codes AS (
  SELECT f.id, code, name FROM (SELECT id, UNNEST(tags) AS tag FROM favourites) f
  JOIN tags USING (tag)),
track_genres AS (
  SELECT id, LIST(name ORDER BY name) AS genres FROM fav_codes WHERE name IS NOT NULL GROUP BY id),
track AS (
  SELECT f.id, title, adult = 'TRUE' AS adult, popularity, overview, release_date, release_year,
         vote_average, vote_count, t.genres AS tags
  FROM favourites f JOIN track_genres t ON f.id = t.id),
infor_rating AS (
  SELECT id, title, overview, release_year, runtime, genres, vote_average FROM cleaned)"""

_BY_YEAR = _vectors("film", "complete", "release_year")
_GLOBAL = _vectors("flat", "complete", "1")
_WEIGHTED = _vectors("heavy", "complete", "release_year", weights_after=True)
_MINE = _vectors("mine", "track", "1")
_USER = f"""{_MINE},
user_vector AS (SELECT dim, AVG(x) AS x FROM mine_vectors GROUP BY dim)"""
_SCORES = f"""{_BY_YEAR},{_USER},
scores AS (
  SELECT v.id, CASE WHEN SQRT(SUM(v.x * v.x)) * (SELECT SQRT(SUM(x * x)) FROM user_vector) > 0
         THEN SUM(v.x * u.x) / (SQRT(SUM(v.x * v.x)) * (SELECT SQRT(SUM(x * x)) FROM user_vector))
         ELSE 0.0 END AS cosine_similarity
  FROM film_vectors v JOIN user_vector u USING (dim) GROUP BY v.id)"""


_SPARSE = _sparse("thin", "complete", "release_year")
_SPARSE_SCORES = f"""{_SPARSE},{_sparse("own", "track", "1")},
own_mean AS (SELECT dim, SUM(x) / (SELECT COUNT(*) FROM track) AS x FROM own_vectors GROUP BY dim),
thin_scores AS (
  SELECT c.id, COALESCE(CASE WHEN SQRT(SUM(v.x * v.x)) * (SELECT SQRT(SUM(x * x)) FROM own_mean) > 0
         THEN SUM(v.x * COALESCE(u.x, 0)) / (SQRT(SUM(v.x * v.x)) * (SELECT SQRT(SUM(x * x)) FROM own_mean)) END, 0.0) AS cosine_similarity
  FROM complete c LEFT JOIN thin_vectors v USING (id) LEFT JOIN own_mean u USING (dim) GROUP BY c.id)"""
_REWORKED = f"""reworked AS (
  SELECT * REPLACE (CASE WHEN release_year = {REWORKED_YEAR} THEN popularity * 2 + 1 ELSE popularity END AS popularity,
                    CASE WHEN release_year = {REWORKED_YEAR} THEN LIST_SLICE(tags, 1, 1) ELSE tags END AS tags) FROM complete),
{_vectors("redone", "reworked", "1")}"""


def _sql(select: str, *extra: str) -> str:
    return "WITH " + ",".join((_BASE, *extra)) + "\n" + select


_DAY = "STRFTIME(release_date, '%Y-%m-%d') AS release_date"


def _rounded(name: str, digits: int = 6) -> str:
    return f"ROUND({name}, {digits}) AS {name}"


_RAW_COLUMNS = f"""id, title, {_rounded('vote_average')}, vote_count, {_DAY}, revenue, runtime,
  adult, backdrop_path, budget, original_language, original_title, overview,
  {_rounded('popularity')}, poster_path, genres, production_companies, production_countries,
  spoken_languages, keywords"""
_CLEAN_COLUMNS = f"""id, title, {_rounded('vote_average')}, vote_count, {_DAY}, revenue, runtime,
  adult, budget, original_language, original_title, overview, {_rounded('popularity')}, genres,
  production_companies, production_countries, keywords"""
_FAVOURITE_COLUMNS = f"""id, title, adult, {_rounded('popularity')}, overview, {_DAY},
  {_rounded('vote_average')}, vote_count"""
_MODEL_COLUMNS = f"""id, title, overview, release_year, runtime, genres,
  {_rounded('vote_average')}"""
_LONG = f"id, CAST(dim AS INT) AS dim, {_rounded('x')}"

_VOTING = """SELECT release_year, CASE WHEN FLOOR(vote_average) BETWEEN 0 AND 9
         THEN CAST(CAST(FLOOR(vote_average) AS INT) AS VARCHAR) || '-' ||
              CAST(CAST(FLOOR(vote_average) AS INT) + 1 AS VARCHAR)
         ELSE 'unknown' END AS rating_bin_label, COUNT(*) AS movie_count
  FROM infor_rating WHERE vote_average IS NOT NULL GROUP BY 1, 2 ORDER BY 2, 1"""

_API_FAVOURITES = f"""SELECT {_FAVOURITE_COLUMNS.replace('adult', "adult = 'TRUE' AS adult")},
  genre_ids FROM favourites JOIN (
    SELECT id, STRING_AGG(CAST(code AS VARCHAR), '|' ORDER BY tag) AS genre_ids
    FROM (SELECT id, UNNEST(tags) AS tag FROM favourites) JOIN tags USING (tag) GROUP BY id
  ) USING (id)"""

_TOP = f"""SELECT {_MODEL_COLUMNS} FROM infor_rating JOIN scores USING (id)
  ORDER BY CAST(cosine_similarity AS FLOAT) DESC, id LIMIT 100"""


def _profile(name: str, source: str, columns: str) -> str:
    names = columns.replace(" ", "").replace("\n", "")
    return (f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, "
            f"{len(names.split(','))} AS column_count, '{names}' AS columns FROM {source}")


_RAW_NAMES = """id, title, vote_average, vote_count, release_date, revenue, runtime, adult,
  backdrop_path, budget, original_language, original_title, overview, popularity, poster_path,
  genres, production_companies, production_countries, spoken_languages, keywords"""
_CLEAN_NAMES = """id, title, vote_average, vote_count, release_date, revenue, runtime, adult,
  budget, original_language, original_title, overview, popularity, genres,
  production_companies, production_countries, keywords, release_year"""
_TRACK_NAMES = """id, title, adult, popularity, overview, release_date, vote_average, vote_count,
  genres"""


def _nulls(checked: str, source: str, column: str) -> str:
    return (f"SELECT '{checked}' AS checked, 'not_null' AS rule, '{column}' AS \"column\", "
            f"COUNT(*) AS violations FROM {source} WHERE {column} IS NULL")


def _repeats(checked: str, source: str, column: str) -> str:
    return (f"SELECT '{checked}' AS checked, 'unique' AS rule, '{column}' AS \"column\", "
            f"COUNT(*) AS violations FROM (SELECT {column} FROM {source} "
            f"WHERE {column} IS NOT NULL GROUP BY {column} HAVING COUNT(*) > 1)")


_QUALITY = " UNION ALL ".join(
    line for checked, source in (("infor_rating", "infor_rating"), ("movies_raw", "raw"))
    for line in (
        _repeats(checked, source, "id"), _nulls(checked, source, "id"),
        _nulls(checked, source, "title"), _nulls(checked, source, "vote_average"))
) + " UNION ALL " + " UNION ALL ".join(
    _repeats("lineitem", "lineitem", c) for c in ("l_orderkey", "l_partkey"))

_RANKING_QUALITY = " UNION ALL ".join((
    _repeats("recommendations", "ranking", "id"), _nulls("recommendations", "ranking", "id"),
    _repeats("lineitem", "lineitem", "l_orderkey").replace("'l_orderkey'", "'id'"),
    _nulls("lineitem", "lineitem", "l_orderkey").replace("'l_orderkey'", "'id'")))

_RUN_QUALITY = " UNION ALL ".join((*(
    rule(table, source, "id") for table, source in (
        ("movies_infor", "cleaned"), ("movies_rating", "cleaned"), ("movies_genres", "cleaned"),
        ("favorite_track", "track"), ("recommendations", "scores"),
        ("marts.infor_rating", "infor_rating"), ("marts.recommendations", "ranking"))
    for rule in (_repeats, _nulls)),
    _nulls("marts.infor_rating", "infor_rating", "title"),
    _nulls("marts.infor_rating", "infor_rating", "vote_average"),
    """SELECT 'silver.movies_vectors', 'complete', 'movie_vector',
       COUNT_IF(vote_average IS NULL OR popularity IS NULL OR vote_count IS NULL) FROM cleaned"""))

_PUBLISHED = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, rule, CASE WHEN rule = 'rows' THEN n ELSE 0 END AS violations "
    f"FROM (SELECT COUNT(*) AS n FROM {source}), "
    "(VALUES ('rows'), ('unique'), ('not_null')) AS r(rule)"
    for table, source in (
        ("movies_infor", "cleaned"), ("movies_rating", "cleaned"), ("movies_genres", "cleaned"),
        ("favorite_track", "track"), ("recommendations", "complete")))

_DECLARED = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{name}' AS column_name, '{kind}' AS data_type, COUNT({column}) AS filled FROM {source}"
    for table, source, columns in (
        ("movies_infor", "cleaned", "id int, title string, overview string, release_date date, runtime int, genres array<string>"),
        ("movies_rating", "cleaned", "id int, vote_average double, vote_count int"),
        ("movies_genres", "cleaned", "id int, genre array<string> genres"),
        ("favorite_track", "track", "id int, title string, adult string, popularity double, overview string, release_date date, "
                                    "vote_average double, vote_count int, genres array<string> tags"),
        ("recommendations", "scores", "id bigint, cosine_similarity double"))
    for name, kind, column in ((*c.split(), c.split()[0])[:3] for c in columns.split(", ")))

_SEARCH = f"""SELECT {_MODEL_COLUMNS} FROM infor_rating
  WHERE infor_rating.vote_average BETWEEN 3.0 AND 8.0 AND release_year BETWEEN 1996 AND 1999
    AND LIST_CONTAINS(STRING_SPLIT(genres, ','), 'ECONOMY') AND LIST_CONTAINS(STRING_SPLIT(genres, ','), 'PROMO')"""

ORACLES: dict[str, str] = {
    "extract_year": _sql(f"SELECT {_RAW_COLUMNS} FROM raw WHERE release_year = 1998"),
    "partition_domain": _sql(
        f"SELECT {_RAW_COLUMNS} FROM raw WHERE release_year BETWEEN 1920 AND {LAST_YEAR - 1}"),
    "full_load": _sql(f"SELECT {_RAW_COLUMNS}, release_year FROM raw"),
    "single_year_read": _sql(
        f"SELECT {_RAW_COLUMNS}, release_year FROM raw WHERE release_year = 1998"),
    "key_dedupe": """SELECT l_orderkey, l_linenumber, l_partkey, ROUND(l_quantity, 6) AS l_quantity
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS n
              FROM lineitem) WHERE n = 1""",
    "csv_positional": _sql(
        f"""SELECT {_RAW_COLUMNS} FROM (SELECT * REPLACE (
              CASE LENGTH(title) % 3 WHEN 0 THEN title || ' 12" disk'
                   WHEN 1 THEN 'Say "' || title || '", again' ELSE title END AS title) FROM raw)
            WHERE id IS NOT NULL"""),
    "csv_line_breaks": "SELECT doc_id, text, lang FROM documents",
    "binary_decode": "SELECT doc_id, text, lang FROM documents",
    "list_literal_parse": """SELECT o_orderkey,
          CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 0 ELSE 2 END
               AS INT) AS n,
          CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN ''
               ELSE CAST(o_orderkey AS VARCHAR) || '|' || CAST(o_custkey AS VARCHAR) END AS parsed
        FROM orders""",
    "partition_overwrite_roundtrip": _sql(
        """SELECT title, CAST(CASE WHEN release_year = 1998 THEN runtime + 1000 ELSE runtime END
           AS INT) AS runtime, release_year FROM raw"""),
    "skip_empty_write": _sql(
        """SELECT 'bronze.movies' AS dataset, COUNT(*) AS row_count FROM raw
           UNION ALL SELECT 'gold.movies_rating', COUNT(*) FROM cleaned"""),
    "api_pages": _sql(_API_FAVOURITES),
    "api_pages_damaged": _sql(
        """SELECT CASE WHEN page % 5 IN (1, 2) THEN 'is not the API''s JSON' WHEN page % 5 = 3 THEN 'has no results'
                       ELSE 'usable' END AS side,
                  COUNT(DISTINCT page) AS pages, COUNT(*) FILTER (WHERE page % 5 IN (0, 4)) AS films
           FROM (SELECT CAST(FLOOR(id / 20) AS INT) AS page FROM favourites) GROUP BY 1"""),
    "snapshot_fallback": _sql(_API_FAVOURITES),
    "warehouse_publish": _sql(_PUBLISHED),
    "warehouse_declared": _sql(_DECLARED, _SCORES),
    "split_predicates": _sql(
        """SELECT 'movies' AS table_name, COUNT(*) AS n_rows, COUNT(*) AS n_read_once, TRUE AS is_even FROM raw
           UNION ALL SELECT 'lineitem', COUNT(*), COUNT(*), TRUE FROM lineitem"""),
    "model_materialisation": _sql(_VOTING),
    "catalogue_views": _sql(_VOTING),
    "moved_film": _sql(
        "SELECT title, id, CAST(CASE WHEN id % 10 = 3 THEN 1998 ELSE release_year END AS INT) AS release_year FROM raw"),
    "drop_columns": _sql(f"SELECT {_CLEAN_COLUMNS} FROM raw"),
    "non_null_key": _sql("SELECT id, title FROM raw WHERE id IS NOT NULL"),
    "mean_impute_by_year": _sql(
        f"SELECT id, release_year, {_rounded('popularity')} FROM cleaned"),
    "constant_impute": _sql(
        """SELECT title, COALESCE(budget, 0) AS budget, COALESCE(revenue, 0) AS revenue,
                  COALESCE(adult, 'FALSE') AS adult,
                  COALESCE(original_language, 'en') AS original_language,
                  COALESCE(overview, 'nan') AS overview,
                  COALESCE(original_title, 'nan') AS original_title,
                  COALESCE(production_companies, 'nan') AS production_companies,
                  COALESCE(production_countries, 'nan') AS production_countries,
                  COALESCE(keywords, 'nan') AS keywords, COALESCE(genres, 'nan') AS genres
           FROM raw"""),
    "movies_cleaned": _sql(f"SELECT {_CLEAN_COLUMNS}, release_year FROM cleaned"),
    "split_tags": _sql(
        """SELECT id,
                  CAST(CASE WHEN genres = 'nan' THEN 0 ELSE LEN(STRING_SPLIT(genres, ',')) END
                       AS INT) AS n,
                  CASE WHEN genres = 'nan' THEN '' ELSE REPLACE(genres, ',', '|') END AS tags
           FROM cleaned"""),
    "explode_genres": _sql("SELECT id, CAST(code AS BIGINT) AS genre_id FROM fav_codes"),
    "genre_lookup_join": _sql(
        """SELECT id, CAST(code AS BIGINT) AS genre_id, name AS genre_name FROM fav_codes
           WHERE name IS NOT NULL"""),
    "favorite_track": _sql(
        f"SELECT {_FAVOURITE_COLUMNS}, ARRAY_TO_STRING(tags, '|') AS genres FROM track"),
    "my_vector_features": _sql(
        f"""SELECT id, {_rounded('popularity')}, {_DAY}, {_rounded('vote_average')}, vote_count,
            ARRAY_TO_STRING(tags, '|') AS genres FROM track"""),
    "hashed_tf": _sql(
        """SELECT id, CAST(slot + 4 AS INT) AS dim, CAST(tf AS DOUBLE) AS x FROM film_counts""",
        _BY_YEAR),
    "idf_by_year": _sql(
        f"""SELECT g AS release_year, n AS films, CAST(slot AS INT) AS slot, {_rounded('idf')}
            FROM film_idf""", _BY_YEAR),
    "scaled_numeric_by_year": _sql(f"SELECT {_LONG} FROM film_vectors WHERE dim < 4", _BY_YEAR),
    "incomplete_films": _sql(
        """SELECT release_year, COUNT(*) AS films,
                  COUNT(*) FILTER (WHERE vote_average IS NULL OR popularity IS NULL) AS incomplete
           FROM cleaned GROUP BY release_year"""),
    "movie_vectors": _sql(f"SELECT {_LONG} FROM film_vectors", _BY_YEAR),
    "movie_vectors_global": _sql(f"SELECT {_LONG} FROM flat_vectors", _GLOBAL),
    "movie_vectors_sparse": _sql(f"SELECT {_LONG} FROM thin_vectors", _SPARSE),
    "cosine_scores_sparse": _sql(f"SELECT id, {_rounded('cosine_similarity', 9)} FROM thin_scores", _SPARSE_SCORES),
    "movie_vectors_global_rework": _sql(f"SELECT {_LONG} FROM redone_vectors", _REWORKED),
    "movie_vectors_weighted": _sql(f"SELECT {_LONG} FROM heavy_vectors", _WEIGHTED),
    "user_vector": _sql(
        f"SELECT CAST(dim AS INT) AS dim, {_rounded('x')} FROM user_vector", _USER),
    "user_vector_catalogue_space": _sql(
        f"""SELECT CAST(dim AS INT) AS dim, ROUND(AVG(x), 6) AS x FROM (
              SELECT dim, x * f AS x FROM mine_num JOIN flat_scale USING (dim)
              UNION ALL
              SELECT slot + 4, tf * idf FROM mine_counts JOIN flat_idf USING (slot))
            GROUP BY dim""", _GLOBAL, _MINE),
    "cosine_scores": _sql(
        f"SELECT id, {_rounded('cosine_similarity', 9)} FROM scores", _SCORES),
    "cosine_scores_unseen": _sql(
        f"""SELECT id, {_rounded('cosine_similarity', 9)} FROM scores
            WHERE id NOT IN (SELECT id FROM track)""", _SCORES),
    "recommendations_top100": _sql(_TOP, _SCORES),
    "lakehouse_end_to_end": _sql(_TOP, _SCORES),
    "typed_extract": _sql(
        f"""SELECT {_RAW_COLUMNS}, release_year FROM (SELECT * REPLACE (
              CAST(CAST(vote_average AS FLOAT) AS DOUBLE) AS vote_average,
              CAST(CAST(popularity AS FLOAT) AS DOUBLE) AS popularity) FROM raw)"""),
    "recommendations_quality": _sql(_RANKING_QUALITY, _SCORES, f"ranking AS ({_TOP})"),
    "pipeline_quality": _sql(_RUN_QUALITY, _SCORES, f"ranking AS ({_TOP})"),
    "movies_infor": _sql(f"SELECT id, title, overview, {_DAY}, runtime, genres FROM cleaned"),
    "movies_rating": _sql(f"SELECT id, {_rounded('vote_average')}, vote_count FROM cleaned"),
    "movies_genres": _sql("SELECT id, genres FROM cleaned"),
    "infor_rating": _sql(f"SELECT {_MODEL_COLUMNS} FROM infor_rating"),
    "rating_bins": _sql(
        """SELECT title, CAST(FLOOR(vote_average) AS INT) AS floor,
                  CASE WHEN FLOOR(vote_average) BETWEEN 0 AND 9
                       THEN CONCAT(CAST(FLOOR(vote_average) AS INT), '-',
                                   CAST(FLOOR(vote_average) AS INT) + 1)
                       ELSE 'unknown' END AS label
           FROM raw"""),
    "voting_distribution": _sql(_VOTING),
    "monthly_release": _sql(
        """SELECT STRFTIME(release_date, '%Y-%m') AS release_month, COUNT(*) AS movie_count
           FROM cleaned GROUP BY 1 ORDER BY 1"""),
    "catalogue_search": _sql(_SEARCH),
    "catalogue_search_clustered": _sql(_SEARCH),
    "republished": _sql(" UNION ALL ".join(
        f"SELECT '{reader}' AS reader, COUNT(*) AS films, CAST(SUM(vote_count) AS BIGINT) AS votes FROM cleaned{where}"
        for reader, where in (("first", ""), ("second", " WHERE vote_count > 3"), ("third", " WHERE vote_count > 3")))),
    "quality_report": _sql(_QUALITY),
    "dataset_profile": _sql(" UNION ALL ".join((
        _profile("movies", "raw", _RAW_NAMES),
        _profile("movies_cleaned", "cleaned", _CLEAN_NAMES),
        _profile("favorite_track", "track", _TRACK_NAMES)))),
}
