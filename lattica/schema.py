"""Declared schemas of the star schema, controlled vocabularies, and the conversions that keep columns typed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fields(spec: str) -> T.StructType:
    kinds = {"s": T.StringType(), "i": T.IntegerType(), "d": T.DoubleType(), "b": T.BooleanType(), "a": T.ArrayType(T.StringType())}
    out = []
    for part in spec.split():
        name, kind = part.rstrip("?").split(":")
        out.append(T.StructField(name, kinds[kind], part.endswith("?")))
    return T.StructType(out)


RESPONSES = _fields("subject_id:s item_id:s benchmark_id:s trial:i test_condition:s? response:d correct_answer:s? trace:s?")
TRACES = _fields("subject_id:s item_id:s benchmark_id:s trial:i test_condition:s? trace:s")
SUBJECTS = _fields("subject_id:s display_name:s provider:s? hub_repo:s? revision:s? params:s? release_date:s? raw_labels_seen:a notes:s?")
ITEMS = _fields("item_id:s benchmark_id:s raw_item_id:s? content:s? correct_answer:s? content_hash:s")
BENCHMARKS = _fields("benchmark_id:s name:s version:s? license:s? source_url:s? description:s? modality:a domain:a response_type:s response_scale:s categorical:b paper_url:s? release_date:s?")

KEY = ["subject_id", "item_id", "trial", "test_condition"]

# The controlled vocabularies of the data format.
RESPONSE_TYPES = ("binary", "likert_5", "likert_10", "win_rate", "ordinal", "fraction", "continuous_bounded", "continuous_unbounded", "error_presence", "mixed")
MODALITIES = ("text", "image", "grid", "gui_screenshot", "audio")
DOMAINS = (
    "software_engineering", "mathematics", "science", "medicine", "law", "finance", "safety", "preference", "tool_use", "gui_agent",
    "cybersecurity", "general", "translation", "summarization", "ner", "cultural", "reasoning", "reward_modeling", "ml_engineering",
)


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns, in its order and types; missing ones are typed NULLs."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def keep_existing(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Those of the wanted columns that exist."""
    return df.select(*[c for c in wanted if c in df.columns])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing is NULL, never NaN, past the boundary."""
    return df.select(*[F.nanvl(F.col(f"`{f.name}`"), F.lit(None)).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`") for f in df.schema.fields])


def read_typed(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Parquet files whose all-NULL columns may have any type: each file is cast by itself, then they are united."""
    frames = [ensure_columns(spark.read.parquet(p), schema) for p in paths]
    return reduce(DataFrame.unionByName, frames) if frames else empty(spark, schema)


def with_missing(df: DataFrame, name: str, value) -> DataFrame:
    """df with the column, computed only if it does not exist."""
    return df if name in df.columns else df.withColumn(name, value)


def where_if_column(df: DataFrame, name: str, value) -> DataFrame:
    """An equality filter that applies only where the column exists."""
    return df.where(F.col(name) == value) if name in df.columns else df
