"""Registry dimensions as set operations: first write wins, aliases gather, contributions merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions import text
from .joins import orphans


class UnknownSubject(ValueError):
    pass


def build_subjects(labels: DataFrame, label: str, order: str) -> DataFrame:
    """One row a subject: the first label seen is its name; all distinct labels, in order of first sight."""
    seen = labels.where(F.col(label).isNotNull()).select(text.subject_id(label).alias("subject_id"), F.col(label).alias("label"), F.col(order).alias("ord"))
    firsts = seen.groupBy("subject_id", "label").agg(F.min("ord").alias("ord"))
    rows = firsts.groupBy("subject_id").agg(F.array_sort(F.collect_list(F.struct("ord", "label"))).alias("seen"))
    rows = rows.select("subject_id", F.col("seen")[0]["label"].alias("display_name"), F.transform("seen", lambda s: s["label"]).alias("raw_labels_seen"))
    return schema.ensure_columns(rows, schema.SUBJECTS)


def build_items(rows: DataFrame, order: str) -> DataFrame:
    """One row an item, as first registered. Columns benchmark_id, raw_item_id, content, correct_answer (optional).

    The text is hashed once and moves only with the first row of its item.
    """
    rows = schema.with_missing(rows, "correct_answer", F.lit(None).cast("string"))
    ids = rows.withColumn("item_id", text.item_id(F.col("benchmark_id"), "content", "raw_item_id")).withColumn("content_hash", text.content_hash("content", "raw_item_id"))
    first = F.min_by(F.struct("benchmark_id", F.col("raw_item_id").cast("string").alias("raw_item_id"), "content", "correct_answer", "content_hash"), order)
    return schema.ensure_columns(ids.groupBy("item_id").agg(first.alias("r")).select("item_id", "r.*"), schema.ITEMS)


def build_benchmarks(infos: DataFrame, order: str) -> DataFrame:
    """One row a benchmark, as first given, with defaults for what is missing or empty."""
    rows = schema.ensure_columns(infos, schema.BENCHMARKS).select("*") if order not in infos.columns else infos
    full = {f.name: F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType) for f in schema.BENCHMARKS.fields}
    some = lambda c: F.when(F.size(c) > 0, c)
    full["name"] = F.coalesce(F.nullif(full["name"], F.lit("")), F.col("benchmark_id"))
    full["modality"] = F.coalesce(some(full["modality"]), F.array(F.lit("text")))
    full["domain"] = F.coalesce(some(full["domain"]), F.array(F.lit("general")))
    full["response_type"] = F.coalesce(F.nullif(full["response_type"], F.lit("")), F.lit("binary"))
    full["response_scale"] = F.coalesce(F.nullif(full["response_scale"], F.lit("")), F.lit("{0, 1}"))
    full["categorical"] = F.coalesce(full["categorical"], F.lit(True))
    out = rows.select(*[v.alias(k) for k, v in full.items()], *([F.col(order).alias("_o")] if order in rows.columns else [F.lit(0).alias("_o")]))
    values = [f.name for f in schema.BENCHMARKS.fields if f.name != "benchmark_id"]
    return out.groupBy("benchmark_id").agg(F.min_by(F.struct(*values), "_o").alias("r")).select("benchmark_id", "r.*")


def require_known(labels: DataFrame, label: str, subjects: DataFrame) -> None:
    """Raise if a label's subject is not registered."""
    missing = orphans(labels.select(text.subject_id(label).alias("subject_id"), F.col(label).alias("label")), subjects, ["subject_id"]).limit(5).collect()
    if missing:
        raise UnknownSubject(", ".join(r["subject_id"] for r in missing))


def merge_subjects(contributions: DataFrame, order: str) -> DataFrame:
    """Subjects of several builds: the first build's row, with the union of all labels in order of first sight."""
    labels = contributions.select("subject_id", F.col(order).alias("o"), F.posexplode_outer("raw_labels_seen").alias("p", "label")).where(F.col("label").isNotNull())
    firsts = labels.groupBy("subject_id", "label").agg(F.min(F.struct("o", "p")).alias("at"))
    seen = firsts.groupBy("subject_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "label"))), lambda s: s["label"]).alias("seen"))
    values = [f.name for f in schema.SUBJECTS.fields if f.name not in ("subject_id", "raw_labels_seen")]
    rows = contributions.groupBy("subject_id").agg(F.min_by(F.struct(*values), order).alias("r")).select("subject_id", "r.*")
    merged = rows.join(seen, "subject_id", "left").withColumn("raw_labels_seen", F.coalesce("seen", F.array().cast("array<string>")))
    return merged.select(*schema.SUBJECTS.fieldNames())


def merge_first(contributions: DataFrame, key: str, order: str) -> DataFrame:
    """Items or benchmarks of several builds: the first build's row."""
    values = [c for c in contributions.columns if c not in (key, order)]
    return contributions.groupBy(key).agg(F.min_by(F.struct(*values), order).alias("r")).select(key, "r.*")


def vocabulary_violations(benchmarks: DataFrame) -> DataFrame:
    """Values outside the controlled vocabularies; for domains, whose list is open, as warnings."""
    outside = lambda c, known: F.array_except(F.col(c), F.array(*map(F.lit, known)))
    found = benchmarks.select(
        "benchmark_id",
        F.explode(
            F.concat(
                F.transform(F.when(~F.col("response_type").isin(*schema.RESPONSE_TYPES), F.array("response_type")).otherwise(F.array().cast("array<string>")), lambda v: F.struct(F.lit("response_type").alias("field"), v.alias("value"), F.lit("error").alias("level"))),
                F.transform(outside("modality", schema.MODALITIES), lambda v: F.struct(F.lit("modality").alias("field"), v.alias("value"), F.lit("error").alias("level"))),
                F.transform(outside("domain", schema.DOMAINS), lambda v: F.struct(F.lit("domain").alias("field"), v.alias("value"), F.lit("warning").alias("level"))),
            )
        ).alias("v"),
    )
    return found.select("benchmark_id", "v.*")
