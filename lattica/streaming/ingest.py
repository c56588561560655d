"""Incremental ingest of response files with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schema
from ..operators import trials


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, after: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Append new Parquet files of observations below source to target, once each, and stop.

    Trial numbers depend on the whole history of a cell, so they are no streaming
    state: stored rows carry their batch, and trials are given by number_history
    when the table is read or compacted. A repeated batch replaces its own folder.
    """
    rows = spark.readStream.schema(OBSERVATIONS).parquet(source)

    def write(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{target}/epoch={epoch:010d}")
        if after:
            after(batch, epoch)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


OBSERVATIONS = "subject_id string, item_id string, benchmark_id string, test_condition string, response double, correct_answer string, trace string, ord long"


def number_history(spark: SparkSession, target: str) -> DataFrame:
    """All rows ingested so far with trials in order of batch and of ord within it."""
    rows = spark.read.schema(f"{OBSERVATIONS}, epoch long").parquet(f"{target}/epoch=*")
    return schema.ensure_columns(trials.assign_trials(rows, ["epoch", "ord"]), schema.RESPONSES)
