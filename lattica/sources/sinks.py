"""Writers of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema


def split_traces(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Narrow responses with a typed NULL trace, and the traces that exist."""
    responses = schema.ensure_columns(rows.withColumn("trace", F.lit(None).cast("string")), schema.RESPONSES)
    return responses, schema.ensure_columns(rows.where(F.col("trace").isNotNull()), schema.TRACES)


def write_responses(rows: DataFrame, path: str) -> bool:
    """path/responses.parquet and, if there is any, path/traces.parquet, by benchmark. Whether traces were written.

    Rows are brought together by benchmark and subject, so a benchmark's folder gets
    files of fair size instead of one from each task.
    """
    responses, traces = split_traces(rows)
    for df, name in ((responses, "responses"), (traces, "traces")):
        if name == "traces" and not df.take(1):
            return False
        df.repartition("benchmark_id", F.pmod(F.xxhash64("subject_id"), F.lit(16))).write.mode("overwrite").partitionBy("benchmark_id").parquet(f"{path}/{name}.parquet")
    return True


def write_contribution(tables: dict[str, DataFrame], path: str) -> list[str]:
    """Registry tables of one build; only those with rows are written. Their names."""
    written = []
    for name, df in tables.items():
        if df.take(1):
            df.write.mode("overwrite").parquet(f"{path}/{name}.parquet")
            written.append(name)
    return written


def cached(spark: SparkSession, path: str, required: list[str], make) -> DataFrame:
    """The table at path if it is there and has rows and the required columns; else it is made, written and read."""
    try:
        df = spark.read.parquet(path)
        if set(required) <= set(df.columns) and df.take(1):
            return df
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
    make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
