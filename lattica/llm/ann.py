"""Approximate nearest neighbours by collision counting.

Each of M random lines keeps the vectors, as unit vectors, in the order of their
projections. A query's window on each line is centred at its own projection; virtual
rehashing widens all windows by the same steps, and a vector collides on a line
when the window reaches it. Vectors with collisions on a share ALPHA of the
lines are verified: their cosine is computed from the original vectors. A vector
at distance s collides on a line with probability 2 Phi(r / s) - 1 at half
width r; at r = RATIO s that is enough to be verified three times in four, and
for what is nearer, more often. Widening stops when the k-th best verified is
within r / RATIO, or when the windows are as wide as the sphere and everything is
verified. The stop is each shard's own, where the k-th best is farther away than
the overall one, so those that count are found more often than that; the recall
measured against brute force is in the README.

Vectors are dealt by a hash of their identifier into shards of about SHARD
vectors, each with its own lines in memory; queries visit all shards and
leave k vectors at most in each. All vectors are indexed; nothing is sampled.

How many collisions tell near from far depends on the data: where the nearest are hardly nearer than the rest, as
among random vectors of many dimensions, windows have to cover about half of every line, and a query costs as much as
a pass over all projections. It is cheap only where near ones are near.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, tidy

#: Lines (255 at most), the share of them a vector must collide on, and half width by distance at which widening stops.
M, ALPHA, RATIO = 240, 0.625, 0.93
#: Half widths of the windows, with the lines that are looked at: few are enough while windows are narrow. Unit vectors are at most 2 apart.
WIDTHS = ((0.3, 32), (0.65, 32), (1.04, M), (1.12, M), (1.25, M), (1.5, M))
#: Vectors of a shard on average, those whose collisions are counted together, and queries whose window bounds are looked up together.
SHARD, COUNTED, ASKED = 16_384, 2048, 128
HITS = "query_id long, vec_id long, score double"


class Lines:
    """The sorted projections of one shard's vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int = 0):
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.directions = np.random.default_rng(seed).normal(size=(vectors.shape[1], M))
        places = (vectors / self.norms[:, None]) @ self.directions
        order = np.argsort(places, axis=0, kind="stable").T
        self.sorted = np.ascontiguousarray(np.take_along_axis(places.T, order, axis=1))
        # [line, vector]: the vector's place in the line's order.
        self.rank = np.empty(order.shape, np.uint16 if len(ids) < 1 << 16 else np.uint32)
        np.put_along_axis(self.rank, order, np.arange(len(ids), dtype=self.rank.dtype)[None, :], axis=1)
        #: The same in parts that fit a processor's cache.
        self.parts = [np.ascontiguousarray(self.rank[:, s : s + COUNTED]) for s in range(0, len(ids), COUNTED)]
        del self.rank
        self.verified = 0

    def score(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Cosines; summed the same way for each row, so equal vectors have equal scores."""
        return (self.vectors[at] * query).sum(axis=1) / (self.norms[at] * math.sqrt((query * query).sum()))

    def search(self, ids: list[int], queries: np.ndarray, k: int) -> Iterator[tuple[int, int, float]]:
        """query_id, vec_id, score of the k nearest found of each query."""
        centres = (queries / np.sqrt((queries * queries).sum(axis=1))[:, None]) @ self.directions
        # Windows as places in the sorted arrays, from the first inside to the first beyond: [query, width, line].
        r = np.array([w for w, _ in WIDTHS])
        low, high = (np.stack([np.searchsorted(s, c[:, None] + d * r) for s, c in zip(self.sorted, centres.T, strict=True)], axis=2).astype(self.parts[0].dtype) for d in (-1, 1))
        for i, query, a, b in zip(ids, queries, low, high, strict=True):
            for v, score in self.expand(i, query, a, b, k):
                yield i, v, score

    def expand(self, query_id: int, query: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> list[tuple[int, float]]:
        done = self.ids == query_id
        best: list[tuple[float, int]] = []
        for w, (r, m) in enumerate((*WIDTHS, (None, 0))):
            if r is None:  # wider than the sphere: all the rest
                new = np.flatnonzero(~done)
            else:
                # Unsigned, what lies below the window wraps round and is beyond it as well.
                first, wide = low[w][:m, None], (high[w] - low[w])[:m, None]
                hits = [np.add.reduce((p[:m] - first < wide).view(np.uint8), axis=0, dtype=np.uint8) for p in self.parts]
                new = np.flatnonzero((np.concatenate(hits) >= ALPHA * m) & ~done)
            if len(new):
                done[new] = True
                self.verified += len(new)
                best += zip((-self.score(new, query)).tolist(), self.ids[new].tolist(), strict=True)
                best.sort()
                del best[k:]
            if r is not None and len(best) == k and math.sqrt(max(0.0, 2 + 2 * best[-1][0])) <= r / RATIO:
                break
        return [(i, -s) for s, i in best]


def usable(ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows that share an identifier the first by content."""
    if len(np.unique(ids)) < len(ids):
        order = np.lexsort((*vectors.T[::-1], ids))
        first = order[np.append(True, ids[order][1:] != ids[order][:-1])]
        return ids[first], vectors[first]
    return ids, vectors


@tidy
def visit_shards(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows shard, dim, asks, id, vector, sorted so that a shard's vectors come before the queries that visit it."""
    key, lines, held = None, None, []
    for batch in batches:
        shard, dim, asks, ids = (batch[c].to_numpy(zero_copy_only=False) for c in ("shard", "dim", "asks", "id"))
        lists = batch["vector"]
        flat, ends = lists.flatten().to_numpy(), np.cumsum(dim)
        edges = np.flatnonzero(np.append(True, (shard[1:] != shard[:-1]) | (dim[1:] != dim[:-1]) | (asks[1:] != asks[:-1]))) if len(ids) else []
        for a, b in zip(edges, [*edges[1:], len(ids)], strict=True):
            part = ids[a:b], flat[ends[a] - dim[a] : ends[b - 1]].reshape(b - a, dim[a])
            if key != (shard[a], dim[a]):
                key, lines, held = (shard[a], dim[a]), None, []
            if not asks[a]:
                held.append(part)
                continue
            if lines is None and held:
                lines = Lines(*usable(*map(np.concatenate, zip(*held, strict=True))))
                held = []
            for s in range(0, b - a if lines is not None else 0, ASKED):
                out = list(lines.search(part[0][s : s + ASKED].tolist(), part[1][s : s + ASKED], k))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, *, every: int = 50, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each vector whose id is divisible by `every`, its k nearest by cosine.

    Candidates are all other identifiers; fewer than k rows if there are fewer.
    Ties go to the smaller identifier. Vectors that are null, empty, zero or
    hold a null or non-finite component take no part, nor do rows without
    identifier; vectors meet others of their own length only. Rows that repeat
    an identifier act as one (the least by content). No query or an empty table gives an
    empty result.
    """
    v = F.col("vector")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & sound)
    rows = stage(rows.withColumn("dim", F.size(v)), "vectors")
    shards = max(1, -(-rows.count() // SHARD))
    held = rows.select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), "dim", F.lit(False).alias("asks"), "id", "vector")
    asking = rows.where(F.col("id") % every == 0)
    # A query with several rows asks once, with the row that its shard keeps.
    asking = asking.groupBy("id").agg(F.min(F.struct("vector", "dim")).alias("q")).select("id", "q.vector", "q.dim")
    asking = asking.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "dim", F.lit(True).alias("asks"), "id", "vector")
    visits = held.unionByName(asking).repartition(shards, "shard", "dim").sortWithinPartitions("shard", "dim", "asks", "id")
    hits = visits.mapInArrow(lambda b: visit_shards(k, b), HITS)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
