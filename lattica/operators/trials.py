"""Trial numbers and the primary-key invariant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL = ["subject_id", "item_id", "test_condition"]


def assign_trials(df: DataFrame, order: list[str | Column], *, preserve_valid: bool = False) -> DataFrame:
    """Number the rows of each (subject, item, condition) 1, 2, ... in the given order; a NULL condition is one condition.

    Upstream numbers are replaced. With preserve_valid they stay in cells where they are positive and differ.
    """
    n = F.row_number().over(Window.partitionBy(*CELL).orderBy(*order)).cast("int")
    if not preserve_valid or "trial" not in df.columns:
        return df.withColumn("trial", n)
    cell = Window.partitionBy(*CELL)
    given = F.col("trial")
    fine = (F.size(F.collect_set(given).over(cell)) == F.count("*").over(cell)) & (F.min(given).over(cell) >= 1)
    return df.withColumn("trial", F.when(fine, given).otherwise(n).cast("int"))


def key_duplicates(df: DataFrame) -> DataFrame:
    """Keys that occur more than once; empty by the invariant. groupBy, since count_distinct skips rows with a NULL."""
    return df.groupBy(*CELL, "trial").agg(F.count("*").alias("n")).where("n > 1")
