"""Near-duplicates: circulant MinHash, banding, exact Jaccard verification.

Signatures come from two permutations of the 32-bit numbers only: sigma mixes a
shingle's hash once, pi, circularly shifted by k, gives coordinate k: the least
pi(sigma(x) + k) over the set. Several coordinates make a band; texts that share a
band are candidates. The number of bands is chosen so that two sets of just the
wanted similarity share none of them with a probability of MISS at most.

Documents with one shingle set are one node. In each band value's bucket all
nodes are first held against the least one, so a bucket of n near copies costs
n - 1 pairs. What remains possible then are links between nodes of one bucket
that ended in different components; only buckets with such nodes are looked at
again. There the nodes outside the bucket's main component are compared with all
others, in blocks of bounded size. No rows are made for pairs: a task confirms
them on the spot, and looks no further at components it has found a link between.

Every link is confirmed on the full sets. Before that a pair has to agree on
AGREE signature coordinates less SIGMAS standard deviations of what a pair at the
threshold agrees on, which a link misses with a probability of about 1e-8.
Components of all links are found by label propagation.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, identified, mix64, stage, text_bytes, tidy
from .components import components

#: Probability that a link at the threshold is no candidate, and coordinates of a band and bands at most.
MISS, MAX_ROWS, MAX_BANDS = 2e-8, 8, 45
#: Coordinates of which a byte each is kept to compare pairs, and how far below the mean they may agree.
AGREE, SIGMAS = 128, 6.0
#: Nodes outside the main component of a bucket that a task holds, on average.
HELD = 1000
#: Bytes of text hashed at once, and shingles whose signature is taken at once.
BLOCK, CHUNK = 2 << 20, 2048
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

SKETCH = "row long, f long, r long, id long, n long, digest binary, bands array<long>, sig binary, body binary"


def _powers(n: int, base: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    with np.errstate(over="ignore"):
        out[1:] = np.cumprod(np.full(max(0, n - 1), base, np.uint64))
    return out


_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of each word of lower-cased bytes that end with a blank."""
    blank = SPACE[data]
    before = np.concatenate([[True], blank[:-1]])
    starts, ends = np.flatnonzero(~blank & before), np.flatnonzero(blank & ~before)
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(len(data), BASE))])
        h = (sums[ends] - sums[starts]) * _powers(len(data), _INVERSE)[starts]
        return starts, mix64(h ^ (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's word shingles: runs of width words, or the whole text if it has fewer."""
    out: list[np.ndarray] = []
    for a, b in blocks([len(t) for t in texts], BLOCK):
        joined = b"".join(t.lower() + b"\n" for t in texts[a:b])
        starts, words = word_hashes(np.frombuffer(joined, np.uint8))
        edges = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts[a:b])])).tolist()
        with np.errstate(over="ignore"):
            runs = np.zeros(len(words), np.uint64)
            for j in range(width):
                runs[: len(words) - j] += words[j:] * np.uint64(0xBF58476D1CE4E5B9 + 2 * 0x632BE59BD9B4E019 * j & (1 << 64) - 1)
            runs = mix64(runs)
            for s, e in zip(edges, edges[1:], strict=False):
                if e - s >= width:
                    out.append(np.unique(runs[s : e - width + 1]))
                elif e > s:
                    h = np.uint64(e - s)
                    for w in words[s:e]:
                        h = mix64(h * BASE + w)
                    out.append(np.array([h], np.uint64))
                else:
                    out.append(np.zeros(0, np.uint64))
    return out


def banding(percent: int) -> tuple[int, int]:
    """Bands and rows for a threshold: the longest bands for which MAX_BANDS are enough."""
    for rows in range(MAX_ROWS, 0, -1):
        chance = (percent / 100) ** rows
        bands = 1 if chance >= 1 else math.ceil(math.log(MISS) / math.log1p(-chance))
        if bands <= MAX_BANDS:
            return bands, rows
    raise ValueError("percent is too low for banding")


def _permute(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(a)
    x ^= x >> np.uint32(15)
    x *= np.uint32(b)
    x ^= x >> np.uint32(16)
    return x


def signature(hashes: np.ndarray, length: int) -> np.ndarray:
    """All coordinates: sigma once, then pi shifted by each coordinate's number."""
    mixed = _permute((hashes >> np.uint64(32)).astype(np.uint32), 0x85EBCA6B, 0xC2B2AE35)
    shift = np.arange(length, dtype=np.uint32)[:, None]
    least = None
    for s in range(0, len(mixed), CHUNK):
        own = _permute(mixed[None, s : s + CHUNK] + shift, 0x7FEB352D, 0x846CA68B).min(axis=1)
        least = own if least is None else np.minimum(least, own)
    return least


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        parts, key = sig.reshape(bands, -1).astype(np.uint64), np.arange(bands, dtype=np.uint64)
        for j in range(parts.shape[1]):
            key = mix64(key * BASE + parts[:, j])
        return key.view(np.int64)


@tidy
def sketch_batches(width: int, bands: int, rows: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns row, f, r, id, text."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = text_bytes(batch[4])
        for a, b in blocks([len(t) for t in texts], BLOCK):
            sets = shingle_sets(texts[a:b], width)
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            sigs = [signature(s, max(AGREE, bands * rows)) if len(s) else None for s in sets]
            keys = [np.zeros(0, np.int64) if s is None else band_keys(s[: bands * rows], bands) for s in sigs]
            marks = [b"" if s is None else s[:AGREE].astype(np.uint8).tobytes() for s in sigs]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, keys)]), pa.int32()), pa.array(np.concatenate(keys)))
            bodies = [pack(t.lower()) for t in texts[a:b]]
            yield pa.RecordBatch.from_arrays([*(batch[i].slice(a, b - a) for i in range(4)), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), lists, pa.array(marks, pa.binary()), pa.array(bodies, pa.binary())], [f.split()[0] for f in SKETCH.split(", ")])


def least_agreement(percent: int) -> int:
    p = percent / 100
    return math.floor(AGREE * p - SIGMAS * math.sqrt(AGREE * p * (1 - p)))


class Sets:
    """Tells whether two packed texts are linked; remembers a few sets."""

    def __init__(self, percent: int, width: int):
        self.percent, self.width, self.least = percent, width, least_agreement(percent)
        self.unpack = zstandard.ZstdDecompressor().decompress
        self.held: dict[int, np.ndarray] = {}

    def of(self, node: int, body: bytes) -> np.ndarray:
        if node not in self.held:
            if len(self.held) >= 2 * HELD:
                self.held.clear()
            self.held[node] = shingle_sets([self.unpack(body)], self.width)[0]
        return self.held[node]

    def linked(self, x: np.ndarray, y: np.ndarray) -> bool:
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= self.percent * (len(x) + len(y) - both)


@tidy
def verify_batches(percent: int, width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns a, b and n, sig, body of either: the pairs that are linked."""
    sets = Sets(percent, width)
    for batch in batches:
        if not batch.num_rows:
            continue
        n = [batch[k].to_numpy() for k in (2, 3)]
        x, y = (np.frombuffer(b"".join(batch[k].to_pylist()), np.uint8).reshape(-1, AGREE) for k in (4, 5))
        may = (100 * np.minimum(*n) >= percent * np.maximum(*n)) & ((x == y).sum(axis=1) >= sets.least)
        a, b = batch[0].to_numpy(), batch[1].to_numpy()
        keep = [i for i in np.flatnonzero(may).tolist() if sets.linked(sets.of(int(a[i]), batch[6][i].as_py()), sets.of(int(b[i]), batch[7][i].as_py()))]
        yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])


@tidy
def across_batches(percent: int, width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns band, block, held, node, n, comp, sig, body, sorted so that a block's held nodes come first.

    Links between components, as many as it takes to join them in this block.
    """
    sets = Sets(percent, width)
    key, joined = None, {}
    nodes = sizes = comps = np.zeros(0, np.int64)
    marks, bodies, room = np.zeros((0, AGREE), np.uint8), [], 0

    def top(c: int) -> int:
        while joined.get(c, c) != c:
            c = joined[c]
        return c

    for batch in batches:
        out: list[tuple[int, int]] = []
        for band, block, holds, node, n, comp, sig, body in zip(*(batch[k].to_pylist() for k in range(8)), strict=True):
            if key != (band, block):
                key, joined, bodies, sets.held = (band, block), {}, [], {}
            mark, count = np.frombuffer(sig, np.uint8), len(bodies)
            if count:
                near = np.flatnonzero((comps[:count] != comp) & (100 * np.minimum(sizes[:count], n) >= percent * np.maximum(sizes[:count], n)))
                near = near[(marks[near] == mark).sum(axis=1) >= sets.least]
                for i in near.tolist():
                    x, y = top(int(comps[i])), top(comp)
                    if x != y and sets.linked(sets.of(int(nodes[i]), bodies[i]), sets.of(node, body)):
                        joined[max(x, y)] = min(x, y)
                        out.append((int(nodes[i]), node))
            if holds:
                if count == room:
                    room = max(64, 2 * room)
                    nodes, sizes, comps = (np.resize(v, room) for v in (nodes, sizes, comps))
                    marks = np.resize(marks, (room, AGREE))
                nodes[count], sizes[count], comps[count], marks[count] = node, n, comp, mark
                bodies.append(body)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])


def _verified(pairs: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Those of the pairs (a, b) that are linked."""
    side = lambda k: texts.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("sig").alias(f"sig_{k}"), F.col("body").alias(f"body_{k}"))
    full = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "sig_a", "sig_b", "body_a", "body_b")
    return stage(full.mapInArrow(lambda x: verify_batches(percent, width, x), "a long, b long"), "verified")


def near_duplicates(docs: DataFrame, *, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id_col, n_shingles, component_id, kept.

    A set is that of the distinct shingles of width words after lower-casing A-Z; of a
    text with fewer words, the whole sequence; of a text without words or a null
    one, empty, and linked with nothing. Linked: 100 * intersection >= percent *
    union. component_id is the least identifier reachable, the own included; kept
    where it is the own one (all rows that repeat it). Equal sets are linked.
    Null identifiers count only where a component has no other; it is null
    then and its rows are kept. An empty table gives an empty result.
    """
    found = _components(docs, percent, width, id_col, text_col)
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _components(docs: DataFrame, percent: int, width: int, id_col: str, text_col: str, own: DataFrame | None = None) -> DataFrame:
    """f, r, id, n and component_id for each row of docs; f and r are those of own, its identified rows, where given."""
    if own is None:
        zero = F.lit(0).cast("long")
        rows = docs.select(zero.alias("f"), zero.alias("r"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    else:
        rows = own.select("f", "r", F.col(f"c{docs.columns.index(id_col)}").alias("id"), F.col(f"c{docs.columns.index(text_col)}").alias("text"))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "f", "r", F.col("id").cast("long").alias("id"), "text")  # row numbers are fixed by the next step
    sketches = stage(rows.mapInArrow(lambda b: sketch_batches(width, *banding(percent), b), SKETCH), "sketches")
    sets = stage(sketches.where("n > 0").groupBy("digest").agg(F.min("row").alias("node"), F.min("id").alias("least"), F.min("n").alias("n")), "sets")
    # One node a set; its bands are those of its first row.
    # Joins with a side of one row a document merge at any size: hinted, since a broadcast would not hold at scale.
    nodes = sketches.select("row", "bands").join(sets.select(F.col("node").alias("row")).hint("merge"), "row", "left_semi")
    banded = stage(nodes.select(F.col("row").alias("node"), "bands"), "banded")
    keys = banded.select("node", F.explode("bands").alias("band"))
    # Staged, so that both sides of the next join are exchanges of their own and a band of very many nodes can be split.
    shared = stage(keys.groupBy("band").agg(F.count("*").alias("nodes")).where("nodes > 1").select("band"), "shared").hint("merge")
    members = stage(keys.join(shared, "band", "left_semi"), "members")
    wanted = members.select(F.col("node").alias("row")).distinct().hint("merge")
    texts = stage(sketches.select("row", "n", "sig", "body").join(wanted, "row", "left_semi").withColumnRenamed("row", "node"), "texts")
    centres = members.groupBy("band").agg(F.min("node").alias("b"))
    stars = members.join(centres, "band").where("node != b").select(F.col("node").alias("a"), "b").distinct()
    links = _verified(stars, texts, percent, width)
    labels = components(links)

    # Links that no star saw: nodes of one bucket in different components.
    placed = stage(members.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "placed")
    counts = placed.groupBy("band", "comp").agg(F.count("*").alias("k"))
    open_ = counts.groupBy("band").agg(F.max_by("comp", F.struct("k", -F.col("comp"))).alias("main"), F.max("k").alias("in_main"), F.sum("k").alias("all")).where("all > in_main")
    open_ = open_.select("band", "main", F.ceil((F.col("all") - F.col("in_main")) / HELD).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rest = placed.join(open_, "band").select("band", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "comp", "main", own.alias("own"), "node")
    held = (F.col("comp") != F.col("main")) & (F.col("block") == F.col("own"))
    rest = rest.select("band", "block", held.alias("held"), "node", "comp").join(texts, "node").select("band", "block", "held", "node", "n", "comp", "sig", "body")
    rest = rest.repartition("band", "block").sortWithinPartitions("band", "block", F.col("held").desc(), "node")
    late = stage(rest.mapInArrow(lambda x: across_batches(percent, width, x), "a long, b long"), "late")
    if late.take(1):
        labels = components(links.unionByName(late))

    groups = sets.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = groups.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = groups.join(least, "comp").select("digest", "component_id")
    every = sketches.select("f", "r", "id", "n", "digest")
    found = every.where("n > 0").join(named, "digest").select("f", "r", "id", "n", "component_id")
    return found.unionByName(every.where("n = 0").select("f", "r", "id", "n", F.col("id").alias("component_id")))


def drop_near_copies(docs: DataFrame, *, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that near_duplicates does not keep.

    Of each component the rows of its least identifier stay (rows that repeat it, too); rows go by themselves,
    so another text under the same identifier is not touched. Null and empty texts stay; so do columns of
    any name. An empty table stays empty.
    """
    names = docs.columns
    own = identified(docs)
    found = _components(docs, percent, width, id_col, text_col, own)
    gone = stage(found.where(~F.col("id").eqNullSafe(F.col("component_id"))).select("f", "r"), "gone")
    return own.join(gone.hint("merge"), ["f", "r"], "left_anti").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
