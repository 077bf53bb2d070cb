"""Shared scratch tables: how iterative plans cut their lineage.

Intermediate results are written as Parquet below the folder the cluster names in
``spark.checkpoint.dir`` and read again.  Any executor can reread them, so a lost
executor costs a task and not the job.  Only where the setting is absent (tests on
one machine) is a temporary folder chosen.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FALLBACK = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _FALLBACK.setdefault("dir", tempfile.mkdtemp(prefix="offerweave-"))
    return f"{root.rstrip('/')}/offerweave"


def materialize(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the scratch folder, with the session's or the given codec, and return the table that was written."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete every scratch table of this application."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only if ``df`` (a materialised table) has at most ``max_rows`` rows.

    Beyond the bound the plain table is returned, and Spark joins it by a shuffle.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
