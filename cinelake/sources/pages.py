"""Landed API pages and the snapshot that stands in when the API has nothing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from cinelake import constants as K
from cinelake import schemas
from cinelake.session import observed

CORRUPT = "_corrupt"
MALFORMED = "is not the API's JSON"
NO_RESULTS = "has no results"


def page_results(pages: DataFrame, page: int | None = None) -> DataFrame:
    """The films on all pages, one row each, or on the one page asked for.

    A page that does not state its number counts as the first.
    """
    if page is not None:
        pages = pages.where(F.coalesce("page", F.lit(1)) == page)
    return pages.select(F.inline("results")).select(*K.PAGE_FIELDS)


def _landed(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """``(file, body, page, results, damage)``, one row per response.

    ``damage`` says why a response cannot be used: it is no single JSON object, a value in it has
    another type than the API's, or it has no results. The body is parsed inside an object of its
    own, so text behind it, or a second object, counts as damage as well.
    """
    if multi_line:
        files = spark.read.format("binaryFile").load(path)
        bodies = files.select(F.col("_metadata.file_path").alias("file"), F.col("content").cast("string").alias("body"))
        # A scan skips files without a byte; the list of files, which Spark holds anyway, has them.
        listed = spark.createDataFrame([(name.replace("file:///", "file:/"),) for name in files.inputFiles()], "file string")
        empty = listed.join(files.select(F.col("_metadata.file_path").alias("file")), "file", "left_anti")
        bodies = bodies.unionAll(empty.withColumn("body", F.lit("")))
    else:
        bodies = spark.read.text(path).where(F.trim("value") != "").select(
            F.col("_metadata.file_path").alias("file"), F.col("value").alias("body"))
    schema = StructType().add("response", schemas.API_PAGE).add(CORRUPT, StringType())
    parsed = F.from_json(
        F.concat(F.lit('{"response":'), F.coalesce("body", F.lit("")), F.lit("}")), schema,
        {"columnNameOfCorruptRecord": CORRUPT})
    read = bodies.withColumn("_parsed", parsed)
    response = F.col("_parsed.response")
    malformed = ~F.is_valid_utf8("body") | F.col(f"_parsed.{CORRUPT}").isNotNull()
    damage = F.when(malformed, F.lit(MALFORMED)).when(response["results"].isNull(), F.lit(NO_RESULTS))
    return read.select("file", F.make_valid_utf8("body").alias("body"), response["page"].alias("page"), response["results"].alias("results"), damage.alias("damage"))


def read_pages(
    spark: SparkSession, path: str, page: int | None = None, multi_line: bool = True,
) -> DataFrame:
    """Films from JSON responses: one response per file, or per line without ``multi_line``.

    A damaged response is an error that names its file; ``land_pages`` keeps such responses apart
    instead.
    """
    landed = _landed(spark, path, multi_line)
    # Naming the task keeps Spark from raising the error before it knows which files are damaged.
    task = F.concat(F.lit(", found by task "), F.spark_partition_id().cast("string"))
    complaint = F.raise_error(F.concat(F.lit("response in "), F.col("file"), F.lit(" "), F.col("damage"), task))
    checked = F.when(F.col("damage").isNotNull(), complaint.cast(schemas.API_PAGE["results"].dataType)).otherwise(F.col("results"))
    return page_results(landed.select("page", checked.alias("results")), page)


@dataclass(frozen=True)
class LandedPages:
    """Usable films, the damaged responses as ``(file, body, damage)``, and how many there are of each."""

    films: DataFrame
    damaged: DataFrame
    pages: int
    damaged_pages: int


def land_pages(
    spark: SparkSession, path: str, folder: str, page: int | None = None, multi_line: bool = True,
) -> LandedPages:
    """Read responses once and store them, usable and damaged ones apart, below ``folder``.

    No response is lost: every one is counted on one side while it is written, and a damaged one is
    kept as it came. ``folder`` is overwritten, so a repaired landing zone can be read again.
    """
    counted = Observation()
    landed = _landed(spark, path, multi_line).withColumn("damaged", F.col("damage").isNotNull())
    stored = landed.withColumn("body", F.when(F.col("damaged"), F.col("body"))).withColumn(
        "results", F.when(~F.col("damaged"), F.col("results")))
    stored.observe(
        counted, F.count_if(~F.col("damaged")).alias("good"), F.count_if("damaged").alias("bad")
    ).write.mode("overwrite").partitionBy("damaged").parquet(folder)
    found = observed(counted)
    kept = spark.read.schema(stored.schema).parquet(folder)
    return LandedPages(
        page_results(kept.where(~F.col("damaged")), page),
        kept.where("damaged").select("file", "body", "damage"), found.get("good", 0), found.get("bad", 0))


def snapshot(df: DataFrame, backup: str) -> DataFrame:
    """Keep ``df`` as the latest snapshot, or return the previous one when ``df`` is empty.

    With nothing before either, the result is empty. The snapshot is parquet, so arrays keep
    their type.
    """
    spark = df.sparkSession
    if not df.isEmpty():
        df.write.mode("overwrite").parquet(backup)
    try:
        return spark.read.schema(df.schema).parquet(backup)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], df.schema)
