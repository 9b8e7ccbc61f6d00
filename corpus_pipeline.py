"""From raw documents to encoded training text: five stages, each on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.llm import cascade, jaccard, mixing, pieces, secret_scan
from cinelake.llm.queries import model_path
from cinelake.llm.store import stored
from cinelake.llm.text import word_array


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that every rule passes."""
    return cascade.cascade(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id, rows without id last, then by a hash of the text.

    A text is told from others under its id by that hash, and rows equal in id and text count as
    one. Documents without words are linked with nothing and stay.
    """
    groups = jaccard.near_duplicates(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "content")).alias("first")
    leaders = groups.where("n_shingles > 0").groupBy("group_id").agg(first).select("first.doc_id", "first.content")
    kept = leaders.unionAll(groups.where("n_shingles = 0").select("doc_id", "content")).distinct()
    rows = docs.withColumn("_content", F.xxhash64("text")).alias("d").join(
        kept.alias("k"), F.expr("d.doc_id <=> k.doc_id and d._content = k.content"), "left_semi")
    return rows.dropDuplicates(["doc_id", "text"]).select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark; ``n_chars`` follows the text."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, shared out by the tree; a document comes once per epoch that takes it.

    The document that a budget cuts keeps its first words.
    """
    chosen = mixing.mix(docs).select("doc_id", "lang", "source", "content", "taken", "n_tokens")
    keyed = docs.withColumn("_lang", F.coalesce("lang", F.lit(""))).withColumn("_source", F.coalesce("source", F.lit("")))
    once = keyed.dropDuplicates(["doc_id", "text", "_lang", "_source"]).withColumn("_content", F.xxhash64("text"))
    rows = once.alias("d").join(chosen.alias("c"), F.expr(
        "d.doc_id <=> c.doc_id and d._content = c.content and d._lang = c.lang and d._source = c.source"))
    first_words = F.array_join(F.slice(word_array(F.col("d.text")), 1, F.col("c.taken").cast("int")), " ")
    text = F.when(F.col("c.taken") < F.col("c.n_tokens"), first_words).otherwise(F.col("d.text"))
    out = rows.withColumn("_text", text)
    return out.select(*(
        F.col("_text").alias(c) if c == "text" else F.length("_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col(f"d.{c}").alias(c) for c in docs.columns))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they decode to it."""
    encoded = pieces.encode(docs, model_path(), decoded=True)
    return encoded.select("doc_id", "n_pieces", "ids", "round_trip")


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard", near_duplicates),
    ("secret_scans", secrets),
    ("mixing", mixing_weights),
    ("sentencepiece", encoding),
]

#: The last stage has no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
