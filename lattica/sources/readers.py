"""Readers for the raw shapes. All give rows with an explicit input order where the order means something: (file, pos)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as star
from ..functions.text import blank_to_null

FILE = "_metadata.file_path"


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, pos, line of the lines with text in them. pos orders a file's lines: where the split that has the line starts, then the line's number there.

    Files are read in splits, so a large one is no single task and no row has to hold it.
    """
    pos = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    return spark.read.text(paths).select(F.col(FILE).alias("file"), pos.alias("pos"), F.col("value").alias("line")).where(blank_to_null("line").isNotNull())


def jsonl(spark: SparkSession, paths: str | list[str], schema: T.StructType | str) -> DataFrame:
    """JSON Lines; blank and malformed lines are skipped."""
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema  # noqa: SLF001
    wide = T.StructType([*kind.fields, T.StructField("_bad", T.StringType())])
    rows = _lines(spark, paths).withColumn("r", F.from_json("line", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    return rows.where(F.col("r").isNotNull() & F.col("r._bad").isNull()).select("file", "pos", "r.*").drop("_bad")


def jsonl_strict(spark: SparkSession, paths: str | list[str], schema: T.StructType | str) -> DataFrame:
    """JSON Lines; a malformed line fails the query."""
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema  # noqa: SLF001
    return _lines(spark, paths).select("file", "pos", F.from_json("line", kind, {"mode": "FAILFAST"}).alias("r")).select("file", "pos", "r.*")


def headed_ndjson(spark: SparkSession, paths: str | list[str], header: str, body: str) -> tuple[DataFrame, DataFrame]:
    """Files whose first line is a summary: (a row a file, a row a further line)."""
    lines = _lines(spark, paths)
    first = lines.groupBy("file").agg(F.min(F.struct("pos", "line")).alias("first"))  # one row a file
    head = first.select("file", F.from_json("first.line", header).alias("r")).select("file", "r.*")
    rest = lines.join(first.select("file", F.col("first.pos").alias("top")), "file").where(F.col("pos") != F.col("top"))
    return head, rest.select("file", "pos", F.from_json("line", body).alias("r")).where("r is not null").select("file", "pos", "r.*")


def json_object(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """One JSON object a file; a file that cannot be parsed is skipped. Roots with open keys: give a map type."""
    parsed = spark.read.text(paths, wholetext=True).select(F.col(FILE).alias("file"), F.from_json("value", schema).alias("value"))
    return parsed.where("value is not null")


def json_array(spark: SparkSession, paths: str | list[str], element: str) -> DataFrame:
    """One JSON array a file: file, pos, value."""
    return json_object(spark, paths, f"array<{element}>").select("file", F.posexplode("value").alias("pos", "value"))


# The words that the upstream CSV reader takes for a missing cell.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def csv(spark: SparkSession, paths: str | list[str], columns: list[str] | None = None, *, missing: tuple[str, ...] = ()) -> DataFrame:
    """CSV with quoted line ends, all columns text: types are given by try_cast later. An index column without name is dropped.

    Cells that are one of the words in missing are NULL; MISSING has the usual ones.
    """
    df = spark.read.csv(paths, header=True, multiLine=True, escape='"', inferSchema=False)
    df = df.drop("Unnamed: 0", "_c0")
    if missing:
        df = df.select(*[F.when(~F.col(f"`{c}`").isin(*missing), F.col(f"`{c}`")).alias(c) for c in df.columns])
    return df if columns is None else star.keep_existing(df, columns)


def scored_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """CSV of scored answers without totals and rows that have no id."""
    return csv(spark, paths).where(blank_to_null("id").isNotNull() & (F.col("id") != "Totals:"))


def csv_peek(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, header (names), n_items (records): what choosing among result files needs. Every file is parsed once."""
    raw = spark.read.csv(paths, header=False, multiLine=True, escape='"', inferSchema=False)
    cells = F.array(*raw.columns)
    rows = raw.select(F.col(FILE).alias("file"), cells.alias("cells"), F.monotonically_increasing_id().alias("at"))
    return rows.groupBy("file").agg(F.filter(F.min_by("cells", "at"), lambda c: c.isNotNull()).alias("header"), (F.count("*") - 1).alias("n_items"))


def path_parts(file: Column | str, names: list[str]) -> list[Column]:
    """The last parts of a path, as columns named left to right; the file name without its suffix."""
    parts = F.split(F.col(file) if isinstance(file, str) else file, "/")
    out = []
    for i, name in enumerate(reversed(names)):
        part = F.try_element_at(parts, F.lit(-1 - i))
        out.append((F.regexp_replace(part, r"\.[^.]*$", "") if i == 0 else part).alias(name))
    return out[::-1]


def run_tree(spark: SparkSession, root: str, names: list[str], fields: list[str]) -> DataFrame:
    """One JSON object a file below root; columns from the path, and the object's own field instead wherever it has the key."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(root, wholetext=True)
    rows = files.select(*path_parts(FILE, names), F.from_json("value", "map<string,string>").alias("record"), F.col(FILE).alias("file")).where("record is not null")
    own = {n: F.when(F.map_contains_key("record", f), F.try_element_at("record", F.lit(f))).otherwise(F.col(n)) for n, f in zip(names, fields, strict=True) if f}
    return rows.withColumns(own)


def parquet_union(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    return star.read_typed(spark, paths, schema)


def contributions(spark: SparkSession, dirs: list[str], table: str, schema: T.StructType) -> DataFrame:
    """A registry table of several builds, each row with its build's place in the list (ord)."""
    from functools import reduce

    frames = []
    for i, d in enumerate(dirs):
        try:
            frames.append(star.ensure_columns(spark.read.parquet(f"{d}/{table}.parquet"), schema).withColumn("ord", F.lit(i)))
        except Exception as e:  # a build without rows writes no file
            if "PATH_NOT_FOUND" not in str(e):
                raise
    empty = star.empty(spark, schema).withColumn("ord", F.lit(0))
    return reduce(DataFrame.unionByName, frames, empty)


def register_globs(spark: SparkSession, globs: dict[str, str]) -> None:
    """Temporary views over Parquet paths or globs, so that SQL can name them."""
    for name, path in globs.items():
        spark.read.parquet(path).createOrReplaceTempView(name)


def literal(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table given in code."""
    return spark.createDataFrame(rows, schema)


def manifest(spark: SparkSession, text: str) -> DataFrame:
    """dataset, domain, release from a YAML manifest's two-level mapping (plain scalars only)."""
    rows, name, entry = [], None, {}
    for line in text.splitlines():
        key, _, value = line.strip().partition(":")
        depth = len(line) - len(line.lstrip())
        if not key or key.startswith("#") or not depth:
            continue
        if depth == 2:
            if name:
                rows.append((name, entry.get("domain"), entry.get("release")))
            name, entry = key, {}
        else:
            entry[key] = value.strip().strip("'\"")
    if name:
        rows.append((name, entry.get("domain"), entry.get("release")))
    return spark.createDataFrame(rows, "dataset string, domain string, release string")


def table_lines(lines: DataFrame, line: str, *, seconds: bool = False) -> DataFrame:
    """Result-table lines "name HH:MM C SRC cells": task, time, category, source and exactly eight cells; other lines go.

    Text of a page comes from outside; here a line is one row.
    """
    # Category letters and source codes of the tables.
    clock = r"\d{2}:\d{2}:\d{2}" if seconds else r"\d{2}:\d{2}"
    pattern = rf"^(.+?)\s+({clock})\s+([WRCFPM])\s+(HTB|GLA|S23|S22|HKC)\s+(.*)$"
    part = lambda i: F.regexp_extract(line, pattern, i)
    known = (lambda c: (c == "X") | c.contains("/")) if seconds else (lambda c: c.isin("✓", "X"))
    title = "SumofScores" if seconds else "SuccessCount"
    rows = lines.where(F.col(line).rlike(pattern) & ~F.col(line).contains(title))
    rows = rows.select(part(1).alias("task"), part(2).alias("time"), part(3).alias("category"), part(4).alias("source"), F.filter(F.split(F.trim(part(5)), r"\s+"), known).alias("cells"))
    return rows.where(F.size("cells") == 8)
