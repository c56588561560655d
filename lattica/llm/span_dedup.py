"""Removal of repeated passages: suffixes sorted deep-shallow, bucket by bucket.

A byte goes if it lies in a string of WINDOW bytes that starts at more than one place
of the corpus. Sorting all suffixes of a corpus would move each of them with its next
WINDOW bytes, so suffixes are first dealt into buckets which provably hold all
partners of a suffix, and suffixes without any partner never move:

1. Each window's anchor is the place in it whose next GRAM bytes hash least, the
   first such. Equal windows have equal anchors. Consecutive windows with one
   anchor are a context: the bytes from the first one's start to the last one's
   end. Only the anchor's hash, the context's digest, and offsets, leave this pass.
2. Anchors whose hash occurs once have no equal window anywhere. A context that
   occurs more than once is repeated as a whole: its span goes.
3. What is left are contexts which share their anchor with different ones, where
   repeated passages begin and end. Their bytes are fetched, once for each
   different context, and in each anchor's bucket the suffixes that start at the
   anchor, and the prefixes that end there, read backwards, are sorted
   deep-shallow. Cutting the two orders where the common prefix falls below a depth
   gives classes of equal right and left parts, and so the equal windows at each offset.
4. A bucket with more than BUCKET different contexts (a passage in very many
   surroundings) is dealt out further before it is sorted, by the bytes that all
   windows of a run of offsets have in common: see deal.

An anchor's hash only deals: two anchors that share it are told apart by their bytes. A context is
named by 64 bits of BLAKE2 beside its anchor's 64; rows with equal texts by 128 bits of two hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, mix64, stage, text_bytes, tidy
from .near_dedup import _INVERSE, BASE, _powers
from .suffix_sort import deep_shallow_sort

WINDOW, GRAM = 400, 200
#: Bytes that are hashed at once; a longer text is read in overlapping parts.
BLOCK = 2 << 20
#: Different contexts that a bucket holds at most when it is sorted, and contexts sorted together.
BUCKET, SORT = 512, 4_000
#: Offsets of a window before its anchor, as a power of two.
RUN = 256
_AT = np.uint64((1 << 24) - 1)

ANCHORS = "id long, h1 long, h2 long, n long, sha string, g array<long>, c array<long>, s array<int>, p array<int>, e array<int>"
CONTEXT = "g long, at int, size int, core long, c long, times long, id long, h1 long, h2 long, p int, lo int, hi int, body binary"
SPAN = "h1 long, h2 long, start int, stop int"


def text_keys(text: Column) -> list[Column]:
    """128 bits that name a text's content."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def anchors(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """For the sorted window starts: hash of anchor, digest of context, first start, anchor, last start of each run of one anchor."""
    span = WINDOW - GRAM + 1
    if not len(starts):
        return (*[np.zeros(0, np.int64)] * 5,)
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(len(data), BASE))])
        back = _powers(len(data) + 1, _INVERSE)
        grams = mix64((sums[GRAM:] - sums[:-GRAM]) * back[: len(sums) - GRAM])
        least = grams & ~_AT | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        at = (least[starts] & _AT).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
        first, last, at = starts[new], starts[np.concatenate([new[1:] - 1, [len(starts) - 1]])], at[new]
        raw = data.tobytes()
        shape = ((at - first) * 1024 + last - first).tolist()
        whole = [hashlib.blake2b(raw[s : e + WINDOW], digest_size=8, salt=k.to_bytes(4, "big")).digest() for s, e, k in zip(first.tolist(), last.tolist(), shape, strict=True)]
        return grams[at].view(np.int64), np.frombuffer(b"".join(whole), np.int64), first, at, last


@tidy
def anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns id, h1, h2, text."""
    for batch in batches:
        texts = text_bytes(batch[3])
        for a, b in blocks([len(t) for t in texts], BLOCK):
            found = [[], [], [], [], []]
            counts = np.zeros(b - a, np.int64)
            if b - a == 1 and len(texts[a]) > 2 * BLOCK:
                data = np.frombuffer(texts[a], np.uint8)
                parts = [(0, s, data[s : s + BLOCK + WINDOW - 1]) for s in range(0, len(data) - WINDOW + 1, BLOCK)]
            else:
                parts = [(None, 0, np.frombuffer(b"".join(texts[a:b]), np.uint8))]
            edges = np.cumsum([0, *map(len, texts[a:b])])
            for row, offset, data in parts:
                if row is None:
                    starts = np.concatenate([np.zeros(0, np.int64), *[np.arange(s, max(s, e - WINDOW + 1)) for s, e in zip(edges, edges[1:], strict=False)]])
                else:
                    starts = np.arange(max(0, len(data) - WINDOW + 1))
                g, c, first, at, last = anchors(data, starts)
                of = np.searchsorted(edges, first, "right") - 1 if row is None else np.zeros(len(first), np.int64)
                counts += np.bincount(of, minlength=b - a)
                base = edges[of] - offset
                for k, x in enumerate((g, c, first - base, at - base, last - base)):
                    found[k].append(x)
            ends = pa.array(np.cumsum([0, *counts]), pa.int32())
            arrays = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64 if k < 2 else np.int32))) for k, x in enumerate(found)]
            yield pa.RecordBatch.from_arrays(
                [*(batch[i].slice(a, b - a) for i in range(3)), pa.array([len(t) for t in texts[a:b]], pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in texts[a:b]]), *arrays],
                [f.split()[0] for f in ANCHORS.split(", ")],
            )


@tidy
def pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts packed before they are dealt out."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch[0], batch[1], batch[2], pa.array([pack(t) for t in text_bytes(batch[3])], pa.binary())], ["id", "h1", "h2", "packed"])


@tidy
def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns id, h1, h2, packed, places: the bytes of each wanted context, with its anchor's place in them."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        out = []
        for i, h1, h2, packed, places in zip(*(batch[k].to_pylist() for k in range(5)), strict=True):
            text = unpack(packed)
            for x in places:
                # lo and hi: how many bytes before the anchor the last and the first window start
                out.append((x["g"], 0, RUN, 0, x["c"], x["times"], i, h1, h2, x["p"], x["p"] - x["e"], x["p"] - x["s"], text[x["s"] : x["e"] + WINDOW]))
        kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 6, *[pa.int32()] * 3, pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 13, kinds, strict=True)], [f.split()[0] for f in CONTEXT.split(", ")])


def equal_windows(bodies: list[bytes], anchor: np.ndarray, lo: np.ndarray, hi: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """[context, bytes before the anchor]: whether another context of its bucket has an equal window there, for lo to hi."""
    n = len(bodies)
    rank, cuts = [], []
    for strings in ([b[h:] for b, h in zip(bodies, anchor.tolist(), strict=True)], [b[:h][::-1] for b, h in zip(bodies, anchor.tolist(), strict=True)]):
        order, shared = deep_shallow_sort(strings)
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        rank.append(place)
        cuts.append(np.array(shared))
    out = np.zeros((n, WINDOW - GRAM + 1), bool)
    for a in range(WINDOW - GRAM + 1):
        who = np.flatnonzero((lo <= a) & (a <= hi))
        if len(who) < 2:
            continue
        right = np.cumsum(cuts[0] < WINDOW - a)[rank[0][who]]
        left = np.cumsum(cuts[1] < a)[rank[1][who]]
        _, back, times = np.unique((buckets[who] * (n + 1) + right) * (n + 1) + left, return_inverse=True, return_counts=True)
        out[who, a] = times[back] > 1
    return out


@tidy
def sort_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of CONTEXT sorted by bucket (g, at, size, core): whole buckets, a few at a time, to the spans of repeated windows.

    A bucket looks at the windows which start at to at + size - 1 before the anchor.
    """
    held: list[tuple] = []

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        out = []
        low = np.array([max(r[10], r[1]) for r in rows])
        high = np.array([min(r[11], r[1] + r[2] - 1) for r in rows])
        buckets = np.cumsum([True, *(x[:4] != y[:4] for x, y in zip(rows, rows[1:], strict=False))]) - 1
        equal = equal_windows([r[12] for r in rows], np.array([r[11] for r in rows]), low, high, buckets)
        for r, e in zip(rows, equal, strict=True):
            if r[5] == 1:  # what occurs more than once goes as a whole anyway
                edge = np.flatnonzero(np.diff(np.concatenate([[0], e.view(np.int8), [0]])))
                out += [(r[7], r[8], r[9] - int(y) + 1, r[9] - int(x) + WINDOW) for x, y in zip(edge[::2], edge[1::2], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 4, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["h1", "h2", "start", "stop"])

    for batch in batches:
        for row in zip(*(batch[k].to_pylist() for k in range(13)), strict=True):
            if held and row[:5] == held[-1][:5]:  # a repeated row's copy
                continue
            if len(held) >= SORT and row[:4] != held[-1][:4]:
                yield spans(held)
                held = []
            held.append(row)
    if held:
        yield spans(held)


def deal(contexts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Buckets of at most BUCKET contexts, and spans found on the way, of the contexts in larger buckets.

    The offsets at which windows start before the anchor are halved again and
    again. A run of offsets has a bucket for each string of the bytes that all its windows
    have in common: equal windows are in one bucket. Buckets that are small enough are
    ready to be sorted; in the others, contexts which also agree on the bytes of all windows of the run are repeated
    there as a whole, and the rest goes on with both halves of the run. A
    run of one offset has nothing left to tell its windows apart, so this ends. A
    context has a few open runs at a time, and no bucket is ever brought together.
    """
    ready, done = [], []
    open_ = contexts.withColumn("asks", F.col("times") == 1).drop("core")
    size = RUN // 2
    open_ = open_.withColumn("at", F.explode(F.array(F.lit(0), F.lit(size))))
    while True:
        last = F.col("at") + size - 1
        inside, meets = (F.col("lo") <= F.col("at")) & (last <= F.col("hi")), (F.col("lo") <= last) & (F.col("at") <= F.col("hi"))
        part = lambda a, b: F.substring("body", F.col("hi") - a + 1, a + WINDOW - b)  # noqa: E731  from a before the anchor, to the end of the window that starts b before it
        # A context that meets the run has the bytes common to all its windows; those of all of them only if it has each window.
        core, hull = part(F.col("at"), last), part(last, F.col("at"))
        runs = stage(open_.where(meets).withColumns({"size": F.lit(size), "core": F.xxhash64(core), "hull": F.when(inside, F.xxhash64(hull)), "hull2": F.when(inside, F.xxhash64(F.lit(1), hull))}), "open")
        sums = stage(runs.groupBy("g", "at", "core").agg(F.sum("times").alias("rows"), F.count("*").alias("kinds"), F.max("asks").alias("asked")).where("rows > 1 and asked"), "sums")
        held = stage(runs.join(sums, ["g", "at", "core"]).drop("asked", "rows"), "held")
        ready.append(held.where(F.col("kinds") <= BUCKET))
        same = stage(held.where((F.col("kinds") > BUCKET) & F.col("hull").isNotNull()).groupBy("g", "at", "core", "hull", "hull2").agg(F.sum("times").alias("hulls")).where("hulls > 1"), "same")
        wide = held.where(F.col("kinds") > BUCKET).join(same, ["g", "at", "core", "hull", "hull2"], "left")
        whole = F.col("hulls").isNotNull()
        done.append(wide.where(whole & F.col("asks")).select("h1", "h2", (F.col("p") - F.col("at") - size + 1).alias("start"), (F.col("p") - F.col("at") + WINDOW).alias("stop")))
        # Partners of an open run stay, even if they do not ask any more themselves.
        open_ = stage(wide.withColumn("asks", F.col("asks") & ~whole).drop("size", "core", "kinds", "hull", "hull2", "hulls"), "rest")
        size //= 2
        if not size or not open_.where("asks").take(1):
            break
        open_ = open_.withColumn("at", F.explode(F.array("at", F.col("at") + size)))
    names = [f.split()[0] for f in CONTEXT.split(", ")]
    return reduce(DataFrame.unionByName, [r.select(*names) for r in ready]), reduce(DataFrame.unionByName, done)


@tidy
def remove_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns id, packed, spans: what is left of the text."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        out = []
        for i, packed, spans in zip(*(batch[k].to_pylist() for k in range(3)), strict=True):
            text, kept, done, runs = unpack(packed), [], 0, []
            for x in sorted((x["start"], x["stop"]) for x in spans):
                if runs and x[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], x[1])
                else:
                    runs.append([*x])
            for s, e in runs:
                kept.append(text[done:s])
                done = e
            kept = b"".join([*kept, text[done:]])
            out.append((i, len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept))
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 6, kinds, strict=True)], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), *text_keys(text), text.alias("text"))


def repeated_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The digest row of each document, and for each text with any (h1, h2) the spans that go."""
    found = stage(_keyed(docs, id_col, text_col).mapInArrow(anchor_batches, ANCHORS), "anchors")
    each = found.select("id", "h1", "h2", F.explode(F.arrays_zip("g", "c", "s", "p", "e")).alias("x")).select("id", "h1", "h2", "x.*")
    # Staged, so that both sides of the next join are exchanges of their own and a very frequent anchor can be split.
    twice = stage(each.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g"), "twice")
    places = stage(each.join(twice, "g"), "places")
    # Of a context: how often it occurs, and one place of it.
    place = F.struct("id", "h1", "h2", "s", "p", "e")
    contexts = stage(places.groupBy("g", "c").agg(F.count("*").alias("times"), F.min(place).alias("x")), "contexts")
    again = contexts.where("times > 1").select("g", "c")
    whole = places.join(again, ["g", "c"], "left_semi").select("h1", "h2", F.col("s").alias("start"), (F.col("e") + WINDOW).alias("stop")).distinct()
    # Staged, like the other sides of joins on g: a frequent anchor's rows can be split if both sides are exchanges of their own.
    mixed = stage(contexts.groupBy("g").agg(F.count("*").alias("kinds"), F.min("times").alias("rarest")).where("kinds > 1 and rarest = 1").select("g", "kinds"), "mixed")
    wanted = contexts.join(mixed, "g").select("g", "c", "times", "x.*")
    wanted = stage(wanted.groupBy("id", "h1", "h2").agg(F.collect_list(F.struct("g", "c", "times", "s", "p", "e")).alias("places")), "wanted")
    packed = _keyed(docs, id_col, text_col).where(F.octet_length("text") >= WINDOW).mapInArrow(pack_batches, "id long, h1 long, h2 long, packed binary")
    same = packed["id"].eqNullSafe(wanted["id"]) & (packed["h1"] == wanted["h1"]) & (packed["h2"] == wanted["h2"])
    fetched = packed.join(wanted, same).select(packed["id"], packed["h1"], packed["h2"], "packed", "places")
    bodies = stage(fetched.mapInArrow(cut_batches, CONTEXT), "bodies")
    wide = stage(mixed.where(F.col("kinds") > BUCKET).select("g"), "wide")
    spans, buckets = whole, bodies.join(wide, "g", "left_anti")
    if wide.take(1):
        dealt, early = deal(stage(bodies.join(wide, "g", "left_semi").dropDuplicates(["g", "c"]), "wide_bodies"))
        spans, buckets = spans.unionByName(early), buckets.unionByName(dealt)
    bucket = ["g", "at", "size", "core"]
    spans = spans.unionByName(buckets.repartition(*bucket).sortWithinPartitions(*bucket, "c").mapInArrow(sort_batches, SPAN))
    spans = spans.groupBy("h1", "h2").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    return found.select("id", "h1", "h2", "n", "sha"), stage(spans, "spans")


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """id_col, n_bytes, n_removed, n_spans, kept_sha256 for each row of docs; with texts, the kept bytes too.

    Texts are UTF-8 bytes, null as empty; matches never cross documents. A byte
    goes if a string of 400 bytes over it also starts elsewhere, in the same document or
    another; all is judged on the input. Texts under 400 bytes lose nothing. All
    rows count as documents, repeated ones and null identifiers too: rows with the
    same long text lose all of it. An empty table gives an empty result.
    """
    rows, spans = repeated_spans(docs, id_col=id_col, text_col=text_col)
    packed = _keyed(docs, id_col, text_col).where((F.octet_length("text") >= WINDOW) | F.lit(texts)).mapInArrow(pack_batches, "id long, h1 long, h2 long, packed binary")
    none = F.array().cast("array<struct<start:int,stop:int>>")
    cut = packed.join(spans, ["h1", "h2"], "left" if texts else "inner").select("id", "packed", F.coalesce("spans", none).alias("spans"))
    cut = cut.mapInArrow(remove_batches, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    if texts:
        return cut.select(F.col("id").alias(id_col), *names, "kept")
    zero = F.lit(0).cast("long")
    whole = rows.join(spans.select("h1", "h2"), ["h1", "h2"], "left_anti").select("id", F.col("n").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.col("sha").alias("kept_sha256"))
    return cut.select("id", *names).unionByName(whole).select(F.col("id").alias(id_col), *names)
