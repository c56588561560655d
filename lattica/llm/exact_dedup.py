"""Exact deduplication by a tree-merge of sorted digest runs.

Every scan partition turns its texts into a run of digests, sorted and with one
entry a digest. The runs lie in slots, one for each RUN rows and a power of two, and
meet in binomial rounds, four bits of the slot's number at a time: in a round a
slot exchanges with the 15 slots that differ from it in those bits only (the last
round has the bits that are left), each receiving the entries whose digest has
its own bits there. A slot merges the runs it got and retains, for each digest,
the smallest identifier (or the largest, on request) and the number of rows.
After the last round, slot p holds the merged entries of 1/slots of the digest space: no
slot is a root that would have to hold everything. Since every run has at most
one entry a digest, a group of copies that holds a third of all rows is at
most one entry of each run.

A slot's merge is Spark's sort, which spills, followed by one pass over neighbours; it
does not make use of the runs being sorted already.

Entries are verified at every level: they merge only if SHA-256, length and a
second, independent 64-bit fingerprint all agree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, identified, stage, tidy

#: Bits of a slot's number that a round exchanges: 16 runs meet in one merge. Rows for each slot.
ROUND_BITS, RUN = 4, 1 << 20

KEY = ["digest", "length", "check"]
#: An entry of a run: the retained identifier of a digest, the row that has it (f and r), and the rows counted so far.
ENTRY = "target long, digest binary, length long, check long, id long, f long, r long, n long"
ENTRY_ARROW = pa.schema([(f.split()[0], pa.binary() if "binary" in f else pa.int64()) for f in ENTRY.split(", ")])


@tidy
def merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge neighbours of equal key in a sorted stream: the first one's identifier stays, the counts add up.

    The last entry of a batch waits for the next batch, so nothing but one batch is held.
    """
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = pa.Table.from_batches([batch]).cast(ENTRY_ARROW)  # the stream's own schema says which are never null
        t = (new if held is None else pa.concat_tables([held, new])).combine_chunks()
        same = np.ones(t.num_rows - 1, bool)
        for k in ["target", *KEY]:
            same &= np.asarray(pc.equal(t[k].slice(1), t[k].slice(0, t.num_rows - 1)))
        first = np.flatnonzero(np.concatenate([[True], ~same]))
        n = np.add.reduceat(t["n"].to_numpy(), first)
        out = t.take(pa.array(first))
        out = out.set_column(out.schema.get_field_index("n"), "n", pa.array(n, pa.int64()))
        held = out.slice(out.num_rows - 1)
        yield from out.slice(0, out.num_rows - 1).combine_chunks().to_batches()
    if held is not None:
        yield from held.combine_chunks().to_batches()


def _order(keep: str) -> list[Column]:
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    return [F.col("target"), *map(F.col, KEY), F.col("id").asc_nulls_last() if keep == "smallest" else F.col("id").desc_nulls_last(), F.col("f"), F.col("r")]


def _merged(runs: DataFrame, keep: str) -> DataFrame:
    """Merge the runs that a partition holds, target by target; the sort spills, so no run has to fit in memory."""
    return runs.sortWithinPartitions(*_order(keep)).mapInArrow(merge_runs, ENTRY)


def _keys(text: Column) -> list[Column]:
    return [F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).cast("long").alias("length"), F.xxhash64(text).alias("check")]


def tree_merge(rows: DataFrame, keep: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of rows (f, r, id, text): the digests of all, each scan partition's run (target: its number), and the merged entries, of which each digest has one."""
    text = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    digests = stage(rows.select("f", "r", F.col("id").cast("long").alias("id"), F.spark_partition_id().cast("long").alias("slot"), text.alias("t")).select("f", "r", "id", "slot", *_keys(F.col("t"))), "digests")
    bits = max(1, math.ceil(math.log2(max(rows.sparkSession.sparkContext.defaultParallelism, digests.count() / RUN))))
    slots = 1 << bits
    first = digests.select(F.col("slot").alias("target"), *KEY, "id", "f", "r", F.lit(1).cast("long").alias("n"))
    local = stage(_merged(first, keep), "runs")
    place, runs = F.pmod(F.col("check"), F.lit(slots)), local.withColumn("target", F.pmod("target", F.lit(slots)))
    for low in range(0, bits, ROUND_BITS):
        mask = (1 << min(bits, low + ROUND_BITS)) - (1 << low)
        target = F.col("target").bitwiseAND(F.lit(~mask)).bitwiseOR(place.bitwiseAND(F.lit(mask)))
        runs = _merged(runs.withColumn("target", target).repartition(slots, "target"), keep)
    return digests, local, runs


def group_texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row for each row of docs: id_col, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty,
    so null and empty texts are one group. keep names the identifier that stays,
    "smallest" or "largest". Repeated rows count each; of rows that repeat the
    kept identifier within a group exactly one is kept. A null identifier loses
    against any other; a group with no other has keep_id null and keeps one row.
    An empty table gives an empty result. Further columns are ignored, whatever
    their names.
    """
    rows = identified(docs).select("f", "r", F.col(f"c{docs.columns.index(id_col)}").alias("id"), F.col(f"c{docs.columns.index(text_col)}").alias("text"))
    digests, local, merged = tree_merge(rows, keep)
    # Back to the rows: a local run asks for the merged entry once a digest, so a group of copies is one row a run in
    # the first join, and in the second never more rows than its scan partitions have.
    found = merged.select(*KEY, F.col("id").alias("keep_id"), F.col("f").alias("keep_f"), F.col("r").alias("keep_r"), F.col("n").alias("group_size"))
    known = local.select(F.col("target").alias("slot"), *KEY).distinct().join(found, KEY)
    rows = digests.join(known, ["slot", *KEY])
    kept = (F.col("f") == F.col("keep_f")) & (F.col("r") == F.col("keep_r"))
    return rows.select(F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """docs without copies, all columns kept: of equal texts the row that group_texts keeps stays.

    Columns of any name pass through; null and empty texts are one group, an empty table stays empty.
    The kept rows are found again by their place in the input, so no group meets in one task and no text is compared.
    """
    names = docs.columns
    own = identified(docs)
    _, _, merged = tree_merge(own.select("f", "r", F.col(f"c{names.index(id_col)}").alias("id"), F.col(f"c{names.index(text_col)}").alias("text")), keep)
    kept = stage(merged.select("f", "r"), "kept")
    # One row a text on this side: merged at any size, since a broadcast would not hold at scale.
    return own.join(kept.hint("merge"), ["f", "r"], "left_semi").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
