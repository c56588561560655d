"""From labelled observations to the star schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions import text
from ..operators import registry, trials


@dataclass
class Star:
    responses: DataFrame
    subjects: DataFrame
    items: DataFrame


def finalize(rows: DataFrame, order: list[str], *, preserve_valid: bool = False) -> Star:
    """rows: benchmark_id, label, raw_item_id, content, test_condition, response, and optionally correct_answer and trace.

    order names columns that fix the input order. Ids are expressions, so facts
    need no join to get them; texts stay behind in the items.
    """
    for name in ("correct_answer", "trace", "test_condition", "raw_item_id"):
        rows = schema.with_missing(rows, name, F.lit(None).cast("string"))
    rows = rows.where(F.col("label").isNotNull() & F.col("response").isNotNull() & ~F.isnan(F.col("response").cast("double")))
    rows = rows.withColumn("ord", F.struct(*order))
    ids = rows.withColumn("subject_id", text.subject_id("label")).withColumn("item_id", text.item_id(F.col("benchmark_id"), "content", "raw_item_id"))
    numbered = trials.assign_trials(ids, ["ord"], preserve_valid=preserve_valid)
    return Star(schema.ensure_columns(numbered, schema.RESPONSES), registry.build_subjects(rows, "label", "ord"), registry.build_items(rows, "ord"))


def register_views(star: Star, **more: DataFrame) -> None:
    """responses, subjects, items and further tables as views for SQL."""
    for name, df in {"responses": star.responses, "subjects": star.subjects, "items": star.items, **more}.items():
        df.createOrReplaceTempView(name)
