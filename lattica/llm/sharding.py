"""Sharding by extendible hashing.

The directory is indexed by hash-prefix bits. A bucket that holds more bytes than
a shard may is split on the next bit of the hash, until each fits. All buckets
that any split could make are nodes of one binary tree over a histogram of
hash cells (a few cells for each shard to be): sums are taken from the cells upwards,
and a node is a shard where it fits and the node above does not. So the
documents are read once, no text is shuffled, and no step needs a bucket's cells
together. A cell that is itself too large is counted again with more bits, from its own
documents only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import identified, running_totals, stage

#: Bits of hash that the directory can use: those of 15 hexadecimal digits.
BITS = 60
#: Histogram cells for each shard, as a power of two; levels of the tree that are summed in one step.
SPARE_BITS, STRIDE = 5, 4


def key_hash(key: Column) -> Column:
    """The first 60 bits of SHA-256 of the key as text; null as empty text."""
    return F.conv(F.substring(F.sha2(F.coalesce(key.cast("string"), F.lit("")), 256), 1, 15), 16, 10).cast("long")


def _prefix(bits: int) -> Column:
    return F.shiftright(F.col("hash"), BITS - bits)


def _tree(cells: DataFrame, bits: int, top: int) -> DataFrame:
    """depth, prefix, b, n of each node above the cells (prefix of `bits` bits, b, n) down from depth top.

    Each step sums STRIDE levels from the one below them, so all steps together
    read a little more than the cells, and none needs more than two rows of a node at a time.
    """
    out, base, depth = cells.select(F.lit(bits).alias("depth"), "prefix", "b", "n"), cells, bits
    while depth > top:
        rise = min(STRIDE, depth - top)
        up = base.withColumn("up", F.explode(F.sequence(F.lit(1), F.lit(rise))))
        up = up.groupBy((F.lit(depth) - F.col("up")).alias("depth"), F.expr("shiftright(prefix, up)").alias("prefix")).agg(F.sum("b").alias("b"), F.sum("n").alias("n"))
        up, depth = stage(up, "levels"), depth - rise
        out, base = out.unionByName(up), up.where(F.col("depth") == depth).drop("depth")
    return stage(out, "tree")


def _directory(rows: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """The directory of rows (hash, n_bytes): bits, and for each prefix of so many the depth, bucket, bucket_bytes, bucket_docs of its shard.

    One entry, and one more for each time that cells were too large.
    """
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    bits, top, todo, found = min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + SPARE_BITS), 0, rows, []
    while True:
        cells = stage(todo.groupBy(_prefix(bits).alias("prefix")).agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n")), "cells")
        nodes = _tree(cells, bits, top)
        fits = F.col("b") <= limit if bits < BITS else (F.col("b") <= limit) | (F.col("depth") == BITS)
        # A node above that is too large; at the top of the tree it is known to be, or there is none.
        large = nodes.where(F.col("b") > limit).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("above"))
        below = nodes.where(fits).withColumn("above", F.expr("shiftright(prefix, 1)"))
        shards = below.where(F.col("depth") > top).join(large, ["depth", "above"], "left_semi").unionByName(below.where(F.col("depth") == top))
        shards = stage(shards.select("depth", F.col("prefix").alias("bucket"), F.col("b").alias("bucket_bytes"), F.col("n").alias("bucket_docs")), "shards")
        depths = sorted(r[0] for r in shards.select("depth").distinct().collect())  # at most BITS + 1 numbers
        # A cell asks for its shard once a depth; at most one of them is there.
        asks = cells.select("prefix", F.explode(F.array(*map(F.lit, depths)).cast("array<int>")).alias("depth")).withColumn("bucket", F.expr(f"shiftright(prefix, {bits} - depth)"))
        found.append((bits, stage(asks.join(shards, ["depth", "bucket"]), "directory")))
        over = stage(nodes.where((F.col("depth") == bits) & (F.col("b") > limit)).select("prefix"), "over")
        if bits == BITS or not over.take(1):
            return found
        todo = todo.withColumn("prefix", _prefix(bits)).join(over, "prefix", "left_semi").drop("prefix")
        # The next tree starts at the cells that were too large, one level above those that may be shards.
        top, bits = bits, min(BITS, bits + 12)


def assign_shards(docs: DataFrame, *, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id_col, n_bytes, shard, depth, part, shard_bytes, shard_docs.

    shard is the prefix of the key's hash as `depth` binary digits ("" at depth
    0). A shard holds at most limit bytes (UTF-8; null text: 0). What no hash
    bit can separate, rows of one key, stays in one bucket of 60 bits; if that is
    too large, its rows are chained as parts 0, 1, ... of at most limit bytes, in
    order of size, and shard_bytes is the part's. A single row above the limit
    is a part of its own, the one case above the limit. Null identifiers
    share the key "". An empty table gives an empty result; further columns, of whatever name, play no part.
    """
    found = _assigned(identified(docs), docs.columns.index(id_col), docs.columns.index(text_col), limit)
    return found.select(F.col("id").alias(id_col), "n_bytes", "shard", "depth", "part", "shard_bytes", "shard_docs")


def _assigned(own: DataFrame, id_at: int, text_at: int, limit: int) -> DataFrame:
    """f, r, id, n_bytes, shard, depth, part, shard_bytes, shard_docs of each of the rows f, r, c0, c1, ..."""
    if limit < 1:
        raise ValueError("limit is at least 1 byte")
    key, text = F.col(f"c{id_at}"), F.col(f"c{text_at}")
    rows = stage(own.select("f", "r", key.alias("id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), key_hash(key).alias("hash")), "keys")
    found = None
    for bits, directory in _directory(rows, limit):
        part = rows.withColumn("prefix", _prefix(bits)).join(directory, "prefix")
        found = part if found is None else found.unionByName(part)
    label = F.when(F.col("depth") == 0, "").otherwise(F.expr("lpad(bin(bucket), depth, '0')"))
    fit = found.where(F.col("bucket_bytes") <= limit).select("f", "r", "id", "n_bytes", label.alias("shard"), "depth", F.lit(0).cast("long").alias("part"), F.col("bucket_bytes").alias("shard_bytes"), F.col("bucket_docs").alias("shard_docs"))
    return fit.unionByName(_chained(found.where(F.col("bucket_bytes") > limit), limit, label))


def _chained(rows: DataFrame, limit: int, label: Column) -> DataFrame:
    """Rows of one key that overflow: consecutive parts, cut wherever the running total passes a multiple of half the limit.

    A row of more than half the limit is a part of its own, so no other part exceeds the limit.
    The running totals are of range-sorted parts, so rows of one key never meet in one task.
    """
    half = F.lit(max(1, limit // 2))
    own = F.col("n_bytes") * 2 > limit
    rows = rows.select("f", "r", "id", "n_bytes", label.alias("shard"), "depth", own.alias("large"))
    # Large rows are counted, the others' bytes added up.
    rows = running_totals(rows.withColumn("step", F.when(own, 1).otherwise(F.col("n_bytes")).cast("long")), ["shard", "large"], ["n_bytes", "f", "r"], "step", "chains").drop("part")
    rows = rows.withColumn("part", F.when(F.col("large"), -1 - F.col("before")).otherwise(F.floor(F.col("before") / half)).cast("long"))
    sums = rows.groupBy("shard", "part").agg(F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_docs"))
    return rows.join(sums, ["shard", "part"]).select("f", "r", "id", "n_bytes", "shard", "depth", "part", "shard_bytes", "shard_docs")


def write_shards(docs: DataFrame, path: str, *, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write docs as Parquet, one folder a shard and part below path, and return the assignment.

    Rows go by their place in the input, so rows of one key are written once each. The folders are
    named by shard and part; where docs has columns of these names,
    its columns are the fields of one column "row".
    """
    names = docs.columns
    own = identified(docs)
    shards = stage(_assigned(own, names.index(id_col), names.index(text_col), limit), "shards")
    clash = {c.lower() for c in names} & {"shard", "part"}
    kept = [F.col(f"c{i}").alias(c) for i, c in enumerate(names)]
    out = own.join(shards.select("f", "r", "shard", "part"), ["f", "r"]).select("shard", "part", *([F.struct(*kept).alias("row")] if clash else kept))
    out.repartition("shard", "part").write.partitionBy("shard", "part").parquet(path)
    return shards.select(F.col("id").alias(id_col), "n_bytes", "shard", "depth", "part", "shard_bytes", "shard_docs")


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
             CAST('0x' || substr(sha256(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
p AS (SELECT d.*, g.depth, h >> (60 - g.depth) AS bucket FROM d, (SELECT unnest(range(0, 25)) AS depth) g),
s AS (SELECT *, sum(n_bytes) OVER (PARTITION BY depth, bucket) AS b, count(*) OVER (PARTITION BY depth, bucket) AS n FROM p),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS k FROM s WHERE b <= {limit})
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes,
  CASE WHEN depth = 0 THEN '' ELSE lpad(bin(bucket), CAST(depth AS INTEGER), '0') END AS shard,
  CAST(depth AS INTEGER) AS depth, CAST(0 AS BIGINT) AS part, CAST(b AS BIGINT) AS shard_bytes, n AS shard_docs
FROM f WHERE k = 1
"""
