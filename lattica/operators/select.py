"""Picking rows: first, last, best, tiered. Always by an explicit order, never by arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keys(keys: list[str], order: list[Column | str]):
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Whole rows; the first in order."""
    return df.withColumn("_n", _keys(keys, order)).where("_n = 1").drop("_n")


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return first_per_key(df, keys, [F.col(c).desc() for c in order])


def first_values(df: DataFrame, keys: list[str], values: list[str], order: str) -> DataFrame:
    """As first_per_key for some columns only; an aggregate, so partial results are combined before the shuffle."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*values), order).alias("_v")).select(*keys, "_v.*")


def last_values(df: DataFrame, keys: list[str], values: list[str], order: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("_v")).select(*keys, "_v.*")


def fullest(df: DataFrame, keys: list[str], file: str) -> DataFrame:
    """Rows of each key's file with most rows; of equal ones the first by name."""
    sizes = df.groupBy(*keys, file).agg(F.count("*").alias("_rows"))
    best = first_per_key(sizes, keys, [F.col("_rows").desc(), F.col(file)]).drop("_rows")
    return df.join(best, [*keys, file], "left_semi")


def tiered(df: DataFrame, keys: list[str], tiers: list[tuple[Column, list[Column | str]]], last: list[str]) -> DataFrame:
    """One row a key: from the first tier that has one, the first by that tier's own order, then by `last`.

    The tiers stand for a chain of "those still missing, from the next source";
    one window does what would take an anti-join for each.
    """
    tier = F.coalesce(*[F.when(c, F.lit(i)) for i, (c, _) in enumerate(tiers)])
    width = max(len(o) for _, o in tiers)
    order: list[Column | str] = [F.col("_tier")]
    for k in range(width):
        pick = None
        for i, (_, own) in enumerate(tiers):
            if k < len(own):
                value = F.col(own[k]) if isinstance(own[k], str) else own[k]
                pick = F.when(F.col("_tier") == i, value) if pick is None else pick.when(F.col("_tier") == i, value)
        order.append(pick)
    ranked = df.withColumn("_tier", tier).where(F.col("_tier").isNotNull())
    return ranked.withColumn("_n", _keys(keys, [*order, *last])).where("_n = 1").drop("_n", "_tier")


def primary_files(files: DataFrame) -> DataFrame:
    """One result file for each model_dir: plain prompt without shots, else any prompt without shots, else a large unnamed one.

    Columns model_dir, filename, dataset, prompt, shots, n_items.
    """
    # The order of dataset versions and the least size of an unnamed file.
    place = F.when(F.col("dataset") == "afrimedqa-v2", 0).when(F.col("dataset") == "afrimedqa-v1", 1).when(F.col("dataset") == "afrimedqa-v2.5", 2).otherwise(99)
    least = 2800
    named, plain = F.col("dataset").startswith("afrimedqa"), (F.col("prompt") == "base")
    none = F.col("shots") == 0
    size = -F.col("n_items")
    return tiered(
        files,
        ["model_dir"],
        [(named & plain & none, [place, size]), (named & none, [place, size]), ((F.col("dataset") == "unknown") & plain & none & (F.col("n_items") >= least), [size])],
        ["filename"],
    )


def top_n(df: DataFrame, by: str, n: int, tie: str) -> DataFrame:
    return df.orderBy(F.col(by).desc(), tie).limit(n)
