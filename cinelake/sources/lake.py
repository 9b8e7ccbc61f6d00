"""The parquet lake: ``<root>/<layer>/<table>``, split by release year where a dataset is yearly.

A dataset that is not yearly is a folder of versions and a pointer file that names the current one.
A new version is written beside the old ones; then a pointer with the next number appears, in one
step on any file system, and the highest number counts. A reader finds the old content or the new
one, never a gap, and the version it has resolved stays until the write after the next.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cinelake.functions import interleaved
from cinelake.schemas import DATASETS, YEAR_COLUMN, assert_schema
from cinelake.session import observed

POINTER = "_current-"


@dataclass(frozen=True)
class Profile:
    """What a write stored; ``written`` is false when an empty frame left the old data alone."""

    table: str
    row_count: int
    columns: tuple[str, ...]
    written: bool

    @property
    def column_count(self) -> int:
        return len(self.columns)


def clustered(rows: DataFrame, columns: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows dealt to tasks, and sorted in them, by the interleaved bits of where each column lies in its range.

    Each file then covers a narrow range of every column, which its statistics tell a reader.
    """
    place = interleaved(*((F.col(c), low, high) for c, (low, high) in columns.items()))
    return rows.withColumn("_place", place).repartitionByRange("_place").sortWithinPartitions("_place").drop("_place")


class Lake:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        dataset = DATASETS[name]
        return f"{self.root}/{dataset.layer}/{dataset.table}"

    def write(
        self, df: DataFrame, name: str, arrives_by_year: bool = False,
    ) -> Profile:
        """Overwrite a dataset, or only the years that ``df`` holds when it is yearly.

        Rows are counted while they are written. An empty frame is not written where the dataset
        keeps its last content; a yearly one always does. ``arrives_by_year`` says that ``df`` is
        a narrow transformation of a yearly dataset: its tasks hold few years each, so the rows
        are written where they are, without a shuffle.

        A dataset that is not yearly is written once, as a new version, so a job that fails leaves
        the old data as they were. A clustered one is dealt by ranges of its columns, interleaved,
        so that filters on any of them skip files. One writer at a time is assumed.
        """
        dataset = DATASETS[name]
        rows = assert_schema(df, dataset.stored_schema)
        columns = tuple(rows.columns)
        if dataset.clustered:  # before rows are counted, since ranges are found by a pass of their own
            rows = clustered(rows, dataset.clustered)
        counted = Observation()
        rows = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
        if dataset.by_year and not arrives_by_year:
            # Brings a year's rows into few files; adaptive execution cuts a year that is too
            # big for one task into several.
            rows = rows.hint("rebalance", YEAR_COLUMN)
        if dataset.by_year:
            # A dynamic overwrite of no rows touches no partition.
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                YEAR_COLUMN).parquet(self.path(name))
            n = observed(counted).get("rows", 0)
            return Profile(name, n, columns, written=n > 0)
        versions = self._numbered(self.path(name), POINTER)
        number = max(versions, default=0) + 1
        staged = f"v{number:08d}-{uuid.uuid4().hex}"
        path = f"{self.path(name)}/{staged}"
        try:
            rows.write.parquet(path)
        except Exception:
            self._delete(path)
            raise
        n = observed(counted).get("rows", 0)
        written = n > 0 or not dataset.keeps_last
        if written:
            self._point(self.path(name), number, staged)
            self._forget(self.path(name), number)
        else:
            self._delete(path)
        return Profile(name, n, columns, written)

    def _files(self, path: str):
        """The Hadoop path and its file system."""
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _delete(self, path: str) -> None:
        where, files = self._files(path)
        files.delete(where, True)

    def _entries(self, path: str, prefix: str) -> list[str]:
        """What follows ``prefix`` in the names of a folder that begin with it."""
        where, files = self._files(path)
        if not files.exists(where):
            return []
        names = [entry.getPath().getName() for entry in files.listStatus(where)]
        return [name[len(prefix):] for name in names if name.startswith(prefix)]

    def _numbered(self, path: str, prefix: str) -> dict[int, str]:
        """Number and name of the entries of a folder that begin with ``prefix`` and eight digits."""
        return {int(rest[:8]): prefix + rest for rest in self._entries(path, prefix) if rest[:8].isdigit()}

    def _point(self, path: str, number: int, version: str) -> None:
        """Make ``version`` the current one: a finished pointer file takes a name that is still free."""
        draft, files = self._files(f"{path}/_draft-{uuid.uuid4().hex}")
        out = files.create(draft, True)
        out.write(version.encode())
        out.close()
        if not files.rename(draft, self._files(f"{path}/{POINTER}{number:08d}")[0]):
            raise OSError(f"cannot point {path} to {version}")

    def _forget(self, path: str, number: int) -> None:
        """Remove all versions but the current one and the one before it, which may still be read."""
        for old, name in self._numbered(path, POINTER).items():
            if old < number:
                self._delete(f"{path}/{name}")
        for old, name in self._numbered(path, "v").items():
            if old < number - 1:
                self._delete(f"{path}/{name}")

    def location(self, name: str) -> str:
        """Where the rows of a dataset are now."""
        path = self.path(name)
        while not DATASETS[name].by_year and (pointers := self._numbered(path, POINTER)):
            where, files = self._files(f"{path}/{pointers[max(pointers)]}")
            try:
                source = files.open(where)
            except Py4JJavaError:  # replaced since it was listed
                continue
            version = bytes(source.readAllBytes()).decode()
            source.close()
            return f"{path}/{version}"
        return path

    def years(self, name: str) -> list[int]:
        """The years a yearly dataset holds, from its folders."""
        return sorted(map(int, self._entries(self.path(name), f"{YEAR_COLUMN}=")))

    def drop_years(self, name: str, years: Iterable[int]) -> None:
        """Remove whole years, for which an overwrite has no rows to bring."""
        for year in years:
            self._delete(f"{self.path(name)}/{YEAR_COLUMN}={year}")
        self.spark.catalog.refreshByPath(self.path(name))

    def read(self, name: str, years: Iterable[int] | None = None) -> DataFrame:
        """A dataset, cut to ``years`` by partition pruning when they are given."""
        dataset = DATASETS[name]
        if years is not None and not dataset.by_year:
            raise ValueError(f"{name} is not stored by year")
        df = self.spark.read.schema(dataset.stored_schema).parquet(self.location(name))
        return df if years is None else df.where(F.col(YEAR_COLUMN).isin(list(years)))
