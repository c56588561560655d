"""What the corpus operators share: staging, row identity and text expressions."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A word of the corpus contracts: a run of anything but blank and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a local one only where it is unset and all runs on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that all machines share")
        found = "file://" + tempfile.mkdtemp(prefix="lattica-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Paths of the staged tables of this process.
_staged: list[str] = []


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and a lost executor costs no recomputation.

    Rows that depend on where they were read (partition numbers, row numbers)
    are fixed from here on.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lattica/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _staged.append(path)
    return spark.read.schema(df.schema).parquet(path)


def staged() -> int:
    return len(_staged)


def release(spark: SparkSession, keep: DataFrame | None = None, since: int = 0) -> None:
    """Delete the staged tables of this process from the since-th on, but those that keep reads. What was made from the others can't be read any more."""
    held = keep.inputFiles() if keep is not None else []
    left = []
    for path in _staged[since:]:
        name = path.rsplit("/", 1)[1]
        if any(f"/{name}/" in f for f in held):
            left.append(path)
        else:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    _staged[since:] = left


def _reads_files(docs: DataFrame) -> bool:
    """Whether docs is a Parquet scan with nothing but selections, so that each row is one row of one file."""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return plan.getClass().getSimpleName() == "LogicalRelation" and plan.relation().getClass().getSimpleName() == "HadoopFsRelation" and plan.relation().toString() == "parquet"


def identified(docs: DataFrame) -> DataFrame:
    """docs as columns c0, c1, ..., and f and r, which tell its rows apart wherever they are read again.

    f is a hash of the row's file, r its place in it. A table that is not
    read from Parquet files is staged first.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    if not _reads_files(docs):
        docs = stage(docs.toDF(*names), "rows")
    meta = docs.metadataColumn("_metadata")
    return docs.select(F.xxhash64(meta["file_path"]).alias("f"), meta["row_index"].alias("r"), *[F.col(f"`{c}`").alias(k) for c, k in zip(docs.columns, names, strict=True)])


def running_totals(rows: DataFrame, group: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """rows with "before": the sum of value over the rows of the same group that come before in the order.

    The rows are range-sorted by group and order, each part's total is taken, the
    parts' totals give each part's start, and only the rows of one part meet: no group
    is brought together. The order has to tell all rows apart, else equal rows may land in one part.
    A part's number stays with its rows, which are staged.
    """
    rows = stage(rows, f"{name}-rows")  # range bounds are sampled: without this, what makes the rows would run twice
    placed = stage(rows.repartitionByRange(*group, *order).withColumn("part", F.spark_partition_id()), name)
    totals = placed.groupBy(*group, "part").agg(F.sum(value).alias("_total"))
    # One row a group and part here.
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*group, "part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*group, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    found = placed.join(starts, [*group, "part"]).withColumn("before", F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return found.drop("_start")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. Pure ASCII texts (bytes = characters) take the fast built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_bytes(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8, null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def tidy(function):
    """For functions over batches: when one ends, the worker, which waits for its next task, gives back what it does not use any more."""

    @functools.wraps(function)
    def run(*args):
        try:
            yield from function(*args)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # GNU's library only
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


def text_sizes(column: pa.Array) -> list[int]:
    """Bytes of the texts of an Arrow column, 0 for null."""
    return pc.fill_null(pc.binary_length(column), 0).to_pylist()


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand Python workers few rows at a time: a batch is in memory several times, on either side."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def blocks(sizes: list[int], limit: int):
    """Ranges of rows that hold about limit bytes each; a longer row is a block of its own."""
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer: each output bit depends on all input bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class KeyTable:
    """Numbers for 64-bit keys (not negative), 0, 1, ... in the order of their first sight: a hash table that is looked up by arrays."""

    def __init__(self, slots: int = 1 << 16):
        self.size = 0
        self._room(slots)

    def _room(self, slots: int) -> None:
        old = [x[self._rows >= 0].tolist() for x in (self._keys, self._rows)] if self.size else [[], []]
        self._keys, self._rows, self._shift = np.full(slots, -1, np.int64), np.full(slots, -1, np.int32), 64 - (slots.bit_length() - 1)
        for key, row in zip(*old, strict=True):
            self._put(key, row)

    def _put(self, key: int, row: int) -> None:
        at = (key * self.SPREAD & (1 << 64) - 1) >> self._shift
        while self._rows[at] >= 0:
            at = (at + 1) & (len(self._rows) - 1)
        self._keys[at], self._rows[at] = key, row

    SPREAD = 0x9E3779B97F4A7C15

    def add(self, key: int) -> int:
        """The number of a key that is not there yet."""
        if 3 * self.size >= len(self._rows):
            self._room(2 * len(self._rows))
        self._put(key, self.size)
        self.size += 1
        return self.size - 1

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers, -1 where there is none."""
        at = (keys.astype(np.uint64) * np.uint64(self.SPREAD) >> np.uint64(self._shift)).astype(np.int64)
        left = np.flatnonzero(self._keys[at] != keys)
        while len(left):
            left = left[self._rows[at[left]] >= 0]  # an empty slot ends the search
            at[left] = (at[left] + 1) & (len(self._rows) - 1)
            left = left[self._keys[at[left]] != keys[left]]
        return self._rows[at]
