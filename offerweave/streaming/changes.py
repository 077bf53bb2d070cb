"""The change log as a stream: micro-batches of staging rows upserted into snapshots.

An extension; the batch functions in operators.ingest define the results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from offerweave.operators.ingest import history, upsert


def upsert_stream(staging: DataFrame, first_state: DataFrame, root: str) -> DataStreamWriter:
    """A writer that keeps ``root/state-<batch>`` and appends to ``root/history``.

    A batch that is run again after a failure reads the snapshot before it and writes the same
    snapshot and history part again.
    """
    spark = first_state.sparkSession

    def one(batch: DataFrame, number: int) -> None:
        old = first_state if number == 0 else spark.read.parquet(f"{root}/state-{number - 1}")
        now = F.lit(number).cast("timestamp")
        new = upsert(old.drop("change"), batch, now)
        new.write.mode("overwrite").parquet(f"{root}/state-{number}")
        history(spark.read.parquet(f"{root}/state-{number}"), now).write.mode("overwrite").parquet(f"{root}/history/batch={number}")

    return staging.writeStream.foreachBatch(one).option("checkpointLocation", f"{root}/progress")


def windowed_changes(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts and sums per event-time window and type."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
