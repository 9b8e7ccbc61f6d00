"""Publishing: schema check, key checks and an overwrite of one warehouse table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cinelake.operators.quality import KeyViolation, check, key_rules
from cinelake.schemas import WAREHOUSE, assert_schema
from cinelake.sources.declared import from_declared, to_declared
from cinelake.sources.relational import read_table


@dataclass(frozen=True)
class JdbcWarehouse:
    """Tables of a database.

    A load replaces a table and its definition. ``truncate`` keeps the definition, with its keys,
    and then needs column types that the frame's own fit: ``declared`` writes frames in the declared
    types of their tables and turns them back when they are read. ``connections`` limits how many tasks
    write at once; the work before the write keeps its own tasks. ``split``, from
    ``key_range_options``, shares out the reading of a table.
    """

    options: dict[str, str]
    schema: str = "movies"
    batch_size: int = 10_000
    connections: int | None = None
    truncate: bool = False
    split: dict[str, str] | None = None
    declared: bool = False

    def write_options(self, table: str) -> dict[str, str]:
        return {
            **self.options,
            "dbtable": f"{self.schema}.{table}",
            "truncate": str(self.truncate).lower(),
            "batchsize": str(self.batch_size),
        }

    def save(self, df: DataFrame, table: str) -> None:
        if self.declared:
            df = to_declared(df, table)
        if self.connections is not None:
            df = df.repartition(self.connections)
        df.write.format("jdbc").mode("overwrite").options(**self.write_options(table)).save()

    def load(self, spark: SparkSession, table: str) -> DataFrame:
        rows = read_table(spark, self.options, f"{self.schema}.{table}", self.split)
        return from_declared(rows, table) if self.declared else rows


@dataclass(frozen=True)
class CatalogWarehouse:
    """Catalogue tables bucketed by id.

    One shuffle at load time; the models' joins and the key checks, all of them on id, then need
    none. All tables must have the same number of buckets, about one per 200 MB of the largest.
    """

    root: str
    database: str
    buckets: int

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def save(self, df: DataFrame, table: str) -> None:
        path = f"{self.root.rstrip('/')}/{table}"
        as_table(df, self.name(table), path, ("id", self.buckets))

    def load(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.table(self.name(table))


@dataclass(frozen=True)
class ParquetWarehouse:
    """Tables as parquet folders."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def save(self, df: DataFrame, table: str) -> None:
        df.write.mode("overwrite").parquet(self.path(table))

    def load(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.schema(WAREHOUSE[table]).parquet(self.path(table))


Warehouse = JdbcWarehouse | CatalogWarehouse | ParquetWarehouse


def publish(
    df: DataFrame, table: str, warehouse: Warehouse, enforce_keys: bool = False,
) -> DataFrame:
    """Write one warehouse table and return its key checks ``(rule, column, violations)``.

    The checks do not stop the load unless ``enforce_keys`` is set.
    """
    rows = assert_schema(df, WAREHOUSE[table])
    report = check(rows, key_rules("id"))
    if enforce_keys:
        broken = report.where("violations > 0").collect()  # one row per rule at most
        if broken:
            raise KeyViolation(f"{table}: {[tuple(r) for r in broken]}")
    warehouse.save(rows, table)
    return report


def as_table(df: DataFrame, name: str, path: str, bucket_by: tuple[str, int] | None = None) -> None:
    """Materialise a model as a table, bucketed on request so that joins on the bucket column
    need no shuffle. Rows are shuffled by bucket first, so a bucket is one file."""
    if bucket_by:
        column, buckets = bucket_by
        df = df.repartition(buckets, column)
    writer = df.write.mode("overwrite").format("parquet").option("path", path)
    if bucket_by:
        writer = writer.bucketBy(buckets, column).sortBy(column)
    writer.saveAsTable(name)


def as_view(df: DataFrame, name: str) -> None:
    """Materialise a model as a view of this session."""
    df.createOrReplaceTempView(name)
