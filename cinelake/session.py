"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; on a cluster ``spark-submit`` brings its own settings."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("cinelake")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def observed(counted: Observation) -> dict:
    """What was counted while a frame was written; empty if Spark found out on the way that it has no rows.

    Adaptive execution then replaces the whole plan, its counters included.
    """
    try:
        return counted.get
    except Py4JJavaError:
        return {}


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine: on a cluster the executors
    could not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="cinelake-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
