"""Queries over the star schema: scores, leaderboards, audits, catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import trials


def model_mean(responses: DataFrame, subjects: DataFrame, name: str, benchmark: str | None = None) -> DataFrame:
    r = responses if benchmark is None else responses.where(F.col("benchmark_id") == benchmark)
    return r.join(subjects.where(F.col("display_name") == name), "subject_id").agg(F.avg("response").alias("mean_score"), F.count("*").alias("n"))


def leaderboard(responses: DataFrame, subjects: DataFrame, by: tuple[str, ...] = ("benchmark_id",)) -> DataFrame:
    """Means by subject and `by`. Facts are reduced to one row a subject first, so only that meets the dimension."""
    part = responses.groupBy("subject_id", *by).agg(F.sum("response").alias("s"), F.count("response").alias("n"))
    return part.join(subjects.select("subject_id", "display_name"), "subject_id").groupBy("display_name", *by).agg((F.sum("s") / F.sum("n")).alias("mean_score"), F.sum("n").alias("n"))


def audit(responses: DataFrame) -> DataFrame:
    """One row a benchmark: size, shares, range, key duplicates."""
    doubled = responses.groupBy("benchmark_id", *trials.CELL, "trial").agg(F.count("*").alias("n"))
    dup = doubled.groupBy("benchmark_id").agg(F.sum(F.when(F.col("n") > 1, F.col("n") - 1).otherwise(0)).alias("pk_dup"))
    main = responses.groupBy("benchmark_id").agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("subject_id").alias("subjects"),
        F.count_distinct("item_id").alias("items"),
        F.avg(F.col("response").isin(0.0, 1.0).cast("double")).alias("binary_share"),
        F.min("response").alias("low"),
        F.max("response").alias("high"),
        F.max("trial").alias("max_trial"),
        F.bool_or(F.col("test_condition").isNotNull()).alias("has_condition"),
    )
    return main.join(dup, "benchmark_id")


def content_share(items: DataFrame) -> DataFrame:
    return items.groupBy("benchmark_id").agg(F.avg(F.col("content").isNotNull().cast("double")).alias("content_share"))


def trace_share(traced: DataFrame) -> DataFrame:
    """Of responses that joins.with_traces gave their trace."""
    return traced.groupBy("benchmark_id").agg(F.avg(F.col("trace").isNotNull().cast("double")).alias("trace_share"))


def duplicate_items(items: DataFrame) -> DataFrame:
    """Content that more than one benchmark has."""
    return items.groupBy("content_hash").agg(F.count_distinct("benchmark_id").alias("benchmarks"), F.count("*").alias("items")).where("benchmarks > 1")


def condition_stats(responses: DataFrame) -> DataFrame:
    """Count, mean, deviation and maximum by condition; rows without one are left out."""
    known = responses.where(F.col("test_condition").isNotNull())
    return known.groupBy("test_condition").agg(F.count("*").alias("n"), F.avg("response").alias("mean"), F.stddev_samp("response").alias("std"), F.max("response").alias("high"), F.count_distinct("subject_id").alias("subjects"))


def pass_at(responses: DataFrame) -> DataFrame:
    """The mean over trials of each subject and item."""
    return responses.groupBy("subject_id", "item_id").agg(F.avg("response").alias("pass_rate"), F.count("*").alias("n"))


def public(rows: DataFrame, manifest: DataFrame, key: str = "benchmark_id") -> DataFrame:
    shown = manifest.where("release = 'public'").select(F.col("dataset").alias(key))
    return rows.join(shown, key, "left_semi")


def catalog_totals(variants: DataFrame) -> DataFrame:
    """Over matrices (benchmark_id, variant, subjects, items): unique items by each benchmark's largest variant, all items, cells."""
    each = variants.groupBy("benchmark_id").agg(F.max("items").alias("most"), F.sum("items").alias("all"), F.sum(F.col("subjects") * F.col("items")).alias("cells"), F.count("*").alias("matrices"))
    return each.agg(F.count("*").alias("benchmarks"), F.sum("most").alias("unique_items"), F.sum("all").alias("all_items"), F.sum("cells").alias("cells"), F.sum("matrices").alias("matrices"))


def scored_without_items(responses: DataFrame) -> DataFrame:
    """Means by the fact table's own gold answer: no join to items."""
    return responses.where(F.col("correct_answer").isNotNull()).groupBy("benchmark_id", "correct_answer").agg(F.avg("response").alias("mean_score"), F.count("*").alias("n"))


def for_model_family(responses: DataFrame, benchmarks: DataFrame, *, categorical: bool) -> DataFrame:
    """Responses of benchmarks whose response set is (or is not) finite."""
    return responses.join(benchmarks.where(F.col("categorical") == categorical).select("benchmark_id"), "benchmark_id", "left_semi")
