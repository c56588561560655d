"""Joins of the curation vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(facts: DataFrame, dim: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Equi-join with both sides' keys as text: numbers upstream may be text elsewhere. How to join is left to the optimizer."""
    cast = lambda df: df.withColumns({c: F.col(c).cast("string") for c in on})
    return cast(facts).join(cast(dim), on, how)


def flagged(facts: DataFrame, flags: DataFrame, on: list[str], *, present: float, name: str = "response") -> DataFrame:
    """1.0 or 0.0 by membership in flags: `present` is what members get, the other value goes to the rest."""
    marks = flags.select(*on).distinct().withColumn("_there", F.lit(True))
    return facts.join(marks, on, "left").withColumn(name, F.when(F.col("_there"), F.lit(present)).otherwise(F.lit(1.0 - present))).drop("_there")


def dense_grid(subjects: DataFrame, items: DataFrame) -> DataFrame:
    """Every subject with every item. This product is the operator's result, not a way to a join."""
    return subjects.crossJoin(items)


def append_missing(first: DataFrame, second: DataFrame, on: list[str]) -> DataFrame:
    """first, and the rows of second whose key it has not."""
    return first.unionByName(second.join(first.select(*on).distinct(), on, "left_anti").select(*first.columns))


def prefer(first: DataFrame, second: DataFrame, on: list[str], values: list[str]) -> DataFrame:
    """Full outer merge: a key's values come from `second` wherever it has the key, even as NULL, else from `first`."""
    a = first.select(*on, F.struct(*values).alias("_a"))
    b = second.select(*on, F.struct(*values).alias("_b"))
    return a.join(b, on, "full_outer").select(*on, *[F.when(F.col("_b").isNotNull(), F.col(f"_b.{v}")).otherwise(F.col(f"_a.{v}")).alias(v) for v in values])


def larger_source(parts: list[DataFrame], key: str) -> DataFrame:
    """For each key the rows of the source that has most of them; the first source wins ties."""
    from functools import reduce

    rows = reduce(DataFrame.unionByName, [p.withColumn("_src", F.lit(i)) for i, p in enumerate(parts)])
    sizes = rows.groupBy(key, "_src").agg(F.count("*").alias("_n"))
    best = sizes.groupBy(key).agg(F.max_by("_src", F.struct("_n", -F.col("_src"))).alias("_src"))
    return rows.join(best, [key, "_src"], "left_semi").drop("_src")


def positional(values: DataFrame, reference: DataFrame, array: str, arrays: list[str]) -> DataFrame:
    """The elements of values.array beside those at the same place of the reference row's arrays."""
    own = values.select("*", F.posexplode(array).alias("pos", "value")).drop(array)
    ref = reference.select(F.posexplode(F.arrays_zip(*arrays)).alias("pos", "_r")).select("pos", "_r.*")
    return own.join(ref, "pos")


def aligned(df: DataFrame, left: str, right: str) -> DataFrame:
    """One row for each element of left, with right's element at the same place or NULL past its end."""
    return df.select("*", F.posexplode(left).alias("pos", "left_value")).withColumn("right_value", F.get(F.col(right), F.col("pos"))).drop(left, right)


def with_traces(responses: DataFrame, traces: DataFrame) -> DataFrame:
    """Responses with their sidecar trace; a NULL condition matches a NULL one."""
    t = traces.select("subject_id", "item_id", F.col("trial").alias("_t"), F.col("test_condition").alias("_c"), F.col("trace").alias("_trace"))
    on = (responses["subject_id"] == t["subject_id"]) & (responses["item_id"] == t["item_id"]) & (responses["trial"] == t["_t"]) & responses["test_condition"].eqNullSafe(t["_c"])
    own = [responses[c] for c in responses.columns if c != "trace"]
    trace = F.coalesce(responses["trace"], F.col("_trace")) if "trace" in responses.columns else F.col("_trace")
    return responses.join(t, on, "left").select(*own, trace.alias("trace"))


def orphans(facts: DataFrame, dim: DataFrame, on: list[str]) -> DataFrame:
    """Keys of facts that dim has not."""
    return facts.select(*on).distinct().join(dim.select(*on), on, "left_anti")


def fallback_lookup(facts: DataFrame, lookups: list[DataFrame], on: list[str], value: str) -> DataFrame:
    """facts with the value of the first lookup that has a non-empty one for the key, NULL without any. Lookups have on and value."""
    out, found = facts, []
    for i, dim in enumerate(lookups):
        out = lookup(out, dim.select(*on, F.col(value).alias(f"_v{i}")), on)
        found.append(F.nullif(F.col(f"_v{i}"), F.lit("")))
    return out.withColumn(value, F.coalesce(*found)).drop(*[f"_v{i}" for i in range(len(lookups))])


def name_lookup(facts: DataFrame, dim: DataFrame, left: str, right: str, form) -> DataFrame:
    """Left join on names that are equal in a normal form (a function of a column); a name without any form finds nothing."""
    own = dim.withColumn("_form", F.nullif(form(F.col(right)), F.lit("")))
    return facts.withColumn("_form", F.nullif(form(F.col(left)), F.lit(""))).join(own, "_form", "left").drop("_form")


def validated(files: DataFrame, reference: DataFrame, array: str, subset: str | None = None) -> DataFrame:
    """The files (a row each) whose array is as long as the one-row reference's, and whose subset array is missing, empty or just the same.

    Files that fail are dropped as a whole, so that a join by position never pairs what does not belong together.
    """
    ref = reference.select(F.size(array).alias("_n"), *([F.col(subset).alias("_s")] if subset else []))
    good = F.size(array) == F.col("_n")
    if subset:
        own = F.col(subset)
        good = good & (own.isNull() | (F.size(own) == 0) | (own == F.col("_s")))
    return files.join(F.broadcast(ref), good, "left_semi")  # one row
