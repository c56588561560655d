"""Mixing sources to target weights by weighted fair queueing.

Each source is a flow whose documents queue in a shuffled order, once for every
epoch allowed. A document's virtual finish time is the number of words its
source has sent up to its end, divided by the source's target weight. All
documents are range-sorted by finish time, whichever source they are of, and
what is sent is what comes before the running total of words reaches the
budget. With the targets themselves as weights that is about virtual time 1, so each
source has sent about its target then.

As in any packet queue, a source can be off its share by one packet; a document
that is large beside its source's target is sent as several packets, of a PACKETS-th of
the target each, so that is the most by which a source misses it.

No window spans a source or the table: see running_totals in common.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, identified, running_totals, stage

#: Packets to which a source's target is divided at least.
PACKETS = 1024
#: What tells entries apart beyond their finish time. Which of two wholly equal documents is sent first makes no difference.
TIES = ["flow", "epoch", "key", "id", "size", "packet", "f", "r"]


def source_targets(sizes: DataFrame, *, weights: tuple[int, ...], share_percent: int, epochs: int) -> DataFrame:
    """sizes (src, source_size) with weight, target and budget.

    Sources by code point, null last, weigh weights[0], weights[1], ..., repeating.
    They share share_percent of all sizes by weight; no target is above epochs
    times its source's size, and what is cut there goes to the others by
    weight, until none is above: the level at which min(cap, level * weight) sums to
    the budget. One row a source goes through the windows here.
    """
    w = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last())) - 1)
    pick = F.lit(weights[-1])
    for i, v in enumerate(weights[:-1]):
        pick = F.when(F.col("place") % len(weights) == i, v).otherwise(pick)
    w = w.withColumn("weight", pick.cast("long")).withColumn("cap", F.col("source_size") * epochs)
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    so_far = by_level.rowsBetween(Window.unboundedPreceding, -1)
    w = w.withColumn("budget", F.sum("source_size").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) * share_percent / F.lit(100.0))
    w = w.withColumn("capped", F.coalesce(F.sum("cap").over(so_far), F.lit(0)))
    w = w.withColumn("free", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
    # The level if exactly the sources before this one were cut; the right one is the first that this source does not pass.
    w = w.withColumn("level", (F.col("budget") - F.col("capped")) / F.col("free"))
    holds = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    w = w.withColumn("level", F.first(holds, ignorenulls=True).over(by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")))
    return w.select("src", "source_size", "weight", "budget", target.alias("target"))


def queue(docs: DataFrame, *, weights: tuple[int, ...] = (5, 2, 1), share_percent: int = 150, epochs: int = 2, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Packets in their queues, see packets_of, of a table's rows."""
    places = [docs.columns.index(c) for c in (id_col, source_col, text_col)]
    return packets_of(identified(docs), *[f"c{i}" for i in places], weights=weights, share_percent=share_percent, epochs=epochs, seed=seed)


def packets_of(own: DataFrame, id_col: str, source_col: str, text_col: str, *, weights: tuple[int, ...], share_percent: int, epochs: int, seed: int) -> DataFrame:
    """Packets of the rows f, r, ...: f, r, id, src, size, source_size, target, budget, epoch, packet, words, start, finish (virtual times) and the tie-breakers.

    Size: words of the text, null 0. The order in a queue is that of a hash of
    seed and identifier, so reruns agree; ties go by identifier and size, and equal rows are
    interchangeable. Null source: a source of its own, the last; null identifier: hashed
    as empty text. A row without words is one packet without words; a source without
    words has target 0 and null times. Packets that start at twice the target are
    left out: the budget is spent before. Texts are read once and never shuffled.
    """
    id_, source, text = F.col(id_col), F.col(source_col), F.col(text_col)
    key = F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(id_.cast("string"), F.lit(""))), 256), 1, 16)
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    flow = F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))  # never null, in the order of sources
    rows = own.select("f", "r", id_.alias("id"), source.alias("src"), flow.alias("flow"), size.alias("size"), key.alias("key"))
    rows = running_totals(rows, ["flow"], ["key", "id", "size", "f", "r"], "size", "queues")
    totals = stage(rows.groupBy("flow", "src").agg(F.sum("size").alias("source_size")), "sources")
    targets = source_targets(totals.select("src", "source_size"), weights=weights, share_percent=share_percent, epochs=epochs)
    targets = targets.select(F.coalesce(F.concat(F.lit("0"), F.col("src").cast("string")), F.lit("1")).alias("flow"), "source_size", "target", "budget")
    rows = rows.drop("part").join(targets, "flow").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    rows = rows.withColumn("before", F.col("before") + F.col("epoch") * F.col("source_size"))
    most = F.greatest(F.lit(1), F.ceil(F.col("target") / PACKETS)).cast("long")
    rows = rows.withColumn("most", most).withColumn("packet", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / F.col("most"))))))
    rows = rows.withColumn("begin", F.col("before") + F.col("packet") * F.col("most")).withColumn("words", F.greatest(F.lit(0).cast("long"), F.least(F.col("most"), F.col("size") - F.col("packet") * F.col("most"))))
    rows = rows.where((F.col("begin") < 2 * F.col("target")) | (F.col("epoch") + F.col("packet") == 0))
    time = lambda words: F.when(F.col("target") > 0, words / F.col("target"))
    return rows.select("f", "r", "id", "src", "flow", "size", "key", "source_size", "target", "budget", "epoch", "packet", "words", time(F.col("begin")).alias("start"), time(F.col("begin") + F.col("words")).alias("finish"))


def schedule(packets: DataFrame) -> DataFrame:
    """Packets of queue range-sorted by finish time, with the words sent up to their start (before) and of their own (sent): the budget cuts there."""
    out = running_totals(packets.withColumn("time", F.coalesce("finish", F.lit(0.0))), [], ["time", *TIES], "words", "schedule")
    left = F.floor(F.col("budget") + F.lit(0.5)) - F.col("before")
    return out.withColumn("sent", F.greatest(F.lit(0), F.least("words", left)).cast("long"))


def allot(docs: DataFrame, **options) -> DataFrame:
    """One row for each row of docs: id, size, source_size, target, taken (words the mix takes, epochs added up). An empty table gives an empty result."""
    sent = schedule(queue(docs, **options))
    return sent.groupBy("f", "r", "id", "size", "source_size", "target").agg(F.sum("sent").alias("taken")).drop("f", "r")


def mix(docs: DataFrame, *, ordered: bool = True, weights: tuple[int, ...] = (5, 2, 1), share_percent: int = 150, epochs: int = 2, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed corpus: the columns of docs, a row once for each epoch in which it is taken; ordered: range-sorted by finish time.

    Documents stay whole: one that is cut is taken if at least half of it was
    sent. Rows without words are never taken; repeated rows are taken each for itself. Columns of any
    name pass through. Texts are joined to their times once, and moved again only for the order.
    """
    names = docs.columns
    own = identified(docs)
    packets = packets_of(own, *[f"c{names.index(c)}" for c in (id_col, source_col, text_col)], weights=weights, share_percent=share_percent, epochs=epochs, seed=seed)
    sent = schedule(packets).groupBy("f", "r", "epoch", "size").agg(F.sum("sent").alias("sent"), F.max("finish").alias("finish"))
    times = stage(sent.where("sent > 0 and 2 * sent >= size").groupBy("f", "r").agg(F.collect_list("finish").alias("finish")), "times")
    # One row a document on this side: merged at any size, since a broadcast would not hold at scale.
    out = own.join(times.hint("merge"), ["f", "r"]).withColumn("finish", F.explode("finish"))
    if ordered:
        out = out.repartitionByRange("finish", "f", "r").sortWithinPartitions("finish", "f", "r")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])


ORACLE = """
WITH d AS (SELECT doc_id, source AS src, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
             substr(sha256('0:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16) AS key, row_number() OVER () AS rid FROM documents),
t AS (SELECT src, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY src),
w AS (SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY src ASC NULLS LAST) - 1) % 3] AS BIGINT) AS weight, 2 * source_size AS cap,
        row_number() OVER (ORDER BY src ASC NULLS LAST) AS place, CAST(sum(source_size) OVER () AS BIGINT) * 150 / 100.0::DOUBLE AS budget FROM t),
l AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
        / (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level FROM w),
c AS (SELECT first(level ORDER BY cap::DOUBLE / weight, place) AS level FROM l WHERE level * weight <= cap),
g AS (SELECT src, source_size, budget, coalesce(least(cap::DOUBLE, (SELECT level FROM c) * weight), cap::DOUBLE) AS target FROM w),
o AS (SELECT d.*, g.source_size, g.target, g.budget, coalesce('0' || d.src, '1') AS flow, CAST(greatest(1, ceil(g.target / 1024)) AS BIGINT) AS most,
        CAST(coalesce(sum(size) OVER (PARTITION BY d.src ORDER BY key, doc_id NULLS FIRST, size, rid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pos
      FROM d JOIN g ON d.src IS NOT DISTINCT FROM g.src),
p AS (SELECT o.*, epoch, unnest(range(0, CAST(greatest(0, floor((size - 1) / most)) AS BIGINT) + 1)) AS packet FROM o, (SELECT unnest([0, 1]) AS epoch)),
q AS (SELECT *, pos + epoch * source_size + packet * most AS start, greatest(0, least(most, size - packet * most)) AS words FROM p),
r AS (SELECT *, CASE WHEN target > 0 THEN (start + words) / target ELSE 0.0 END AS finish FROM q WHERE start < 2 * target OR epoch + packet = 0),
s AS (SELECT *, coalesce(sum(words) OVER (ORDER BY finish, flow, epoch, key, doc_id NULLS FIRST, size, packet, rid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS passed FROM r)
SELECT doc_id, size, source_size, target, CAST(sum(greatest(0, least(words, floor(budget + 0.5) - passed))) AS BIGINT) AS taken FROM s GROUP BY rid, doc_id, size, source_size, target
"""
