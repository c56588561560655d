"""Long to wide, wide to long, arrays and maps to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Up to so many items a matrix has a column for each.
PIVOT_COLUMNS = 10_000


def wide_matrix(responses: DataFrame, items: list[str]) -> DataFrame:
    """subject x item means, one column an item. The items are given, so no extra pass looks for them."""
    if len(items) > PIVOT_COLUMNS:
        raise ValueError(f"{len(items)} items: use sparse_matrix")
    return responses.groupBy("subject_id").pivot("item_id", items).agg(F.avg("response"))


def sparse_matrix(responses: DataFrame) -> DataFrame:
    """subject, item, mean: the matrix for any number of items."""
    return responses.groupBy("subject_id", "item_id").agg(F.avg("response").alias("response"))


def matrix_rows(responses: DataFrame) -> DataFrame:
    """One row a subject with a map from item to mean."""
    cells = sparse_matrix(responses)
    return cells.groupBy("subject_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("item_id", "response")))).alias("responses"))


def melt(df: DataFrame, ids: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """One row for each of the columns that exist."""
    return df.unpivot(ids, [c for c in columns if c in df.columns], name, value)


def metrics_to_rows(df: DataFrame, metrics: dict[str, tuple[Column, Column, dict[str, Column]]]) -> DataFrame:
    """A row for each metric that applies: metric -> (whether, response, further columns)."""
    out = None
    for name, (applies, response, more) in metrics.items():
        part = df.where(applies).withColumns(more).withColumn("metric", F.lit(name)).withColumn("response", response.cast("double"))
        out = part if out is None else out.unionByName(part)
    return out


def cells_to_rows(df: DataFrame, cells: str, names: list[str], name: str, value: str) -> DataFrame:
    """An array with a cell for each of the names to one row a cell."""
    zipped = F.arrays_zip(F.array(*map(F.lit, names)).alias(name), F.col(cells).alias(value))
    return df.select("*", F.inline(zipped)).drop(cells)


def turns_to_rows(df: DataFrame, turns: str) -> DataFrame:
    """A row a turn, numbered from 1."""
    return df.select("*", F.posexplode(turns).alias("_p", "text")).withColumn("turn", F.col("_p") + 1).drop("_p", turns)


def map_to_rows(df: DataFrame, column: str, key: str, value: str) -> DataFrame:
    return df.select("*", F.explode(column).alias(key, value)).drop(column)


def judged_criteria(df: DataFrame, details: dict[str, str], keep: list[str]) -> DataFrame:
    """Rubric arrays, one a judge, to a row a criterion with judge and place; judges whose column is missing are left out.

    details: judge -> array column of structs title, points, max_points, ...
    """
    out = None
    for judge, column in details.items():
        if column in df.columns:
            part = df.select(*keep, F.lit(judge).alias("judge"), F.posexplode(column).alias("place", "c")).select(*keep, "judge", "place", "c.*")
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def trace_on_first(df: DataFrame, record: list[str], order: list[str], trace: str) -> DataFrame:
    """Only a record's first row keeps the trace."""
    first = F.row_number().over(Window.partitionBy(*record).orderBy(*order)) == 1
    return df.withColumn(trace, F.when(first, F.col(trace)))


def nested_ratings(df: DataFrame, completions: str, ratings: str, allowed: tuple[str, ...], form) -> DataFrame:
    """An array of completions, each with a map of ratings, to a row a rating: completion's place and fields, aspect, rating.

    Aspects are brought to a normal form (a function of a column); only allowed ones stay.
    """
    each = df.select("*", F.posexplode(completions).alias("place", "_c")).drop(completions)
    rows = each.select("*", F.explode(F.col(f"_c.{ratings}")).alias("aspect", "rating")).withColumn("aspect", form(F.col("aspect")))
    fields = [f.name for f in each.schema["_c"].dataType.fields if f.name != ratings]
    return allow(rows, "aspect", allowed).select(*[c for c in rows.columns if c not in ("_c", "aspect", "rating")], *[F.col(f"_c.{f}").alias(f) for f in fields], "aspect", "rating")


def allow(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    return df.where(F.col(column).isin(*values))


def deny(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Rows whose value is not one of these; a missing value is none of them."""
    return df.where(~F.coalesce(F.col(column).isin(*values), F.lit(False)))


def json_type(x: Column | str) -> Column:
    """BOOLEAN, STRING, OBJECT, ARRAY, NUMBER or NULL: the type of a JSON value; NULL for text that is no JSON."""
    kind = F.schema_of_variant(F.try_parse_json(x))
    number = kind.rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT|INT)")
    return F.when(kind == "VOID", "NULL").when(number, "NUMBER").otherwise(F.regexp_extract(kind, "^([A-Z]+)", 1))


def list_union(objects: DataFrame, column: str, name: str) -> DataFrame:
    """The distinct elements of all arrays that a map column of any row has."""
    return objects.select(F.explode(F.flatten(F.map_values(column))).alias(name)).distinct()


def numbered(df: DataFrame, order: list[str], name: str = "index") -> DataFrame:
    """df with a running number from 0 in the order, if the column does not exist.

    Parts sorted by range are numbered by themselves and shifted by the rows of the parts before, so no task has all rows.
    """
    if name in df.columns:
        return df
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = placed.withColumns({"_part": F.shiftright("_at", 33), "_row": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a part
    shifts = sizes.select("_part", before.alias("_shift"))
    return placed.join(F.broadcast(shifts), "_part").withColumn(name, F.col("_shift") + F.col("_row")).drop("_at", "_part", "_row", "_shift")


def tallies(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row with the number of rows each condition holds for."""
    return df.agg(*[F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(n) for n, c in conditions.items()])
