"""Language-model scores: a log-bilinear model trained with noise-contrastive estimation.

The model predicts the class of the next token from the classes of the CONTEXT
tokens before it: their vectors, each weighed by its place's vector, add up to a
prediction, whose products with all class vectors are the logits. Training
(numpy) is noise-contrastive: tell the true class from classes drawn
by frequency. Scoring is exact: batched matrix products give all logits, a
softmax normalises them. The most frequent words and the end of a text are
classes of their own, other frequent words share classes by the company they
keep, all further words share one; inside a class, a word's probability is its
add-one count over the corpus. So the probabilities of all words and one unknown sum to 1.

All training rows are read, whatever their length: their word counts, the company
that frequent words keep, and their tokens, dealt at random over tasks in runs
of RUN. Each task trains on all its runs, from common start vectors; the
tasks' vectors are averaged, those of a class as context by how often the task saw it, the
others by tokens. Only the start vectors come from a sample, START runs of least
hash. Vectors depend a little on how the rows are dealt.

Frequent words' counts are sent to all executors, TOP_WORDS of at most
WORD_BYTES bytes; the others meet theirs in a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, stage, text_bytes, tidy

#: Words whose counts all executors have, and the longest among them.
TOP_WORDS, WORD_BYTES = 65_536, 64
#: Tokens in a run of the training part, and runs that the start vectors are made from.
RUN, START = 1 << 16, 32
#: Words with a class of their own, shared classes, tokens of context, vector length.
OWN, SHARED, CONTEXT, SIZE = 96, 30, 4, 16
END, RARE = 0, 1
#: What stands for them among the numbers of frequent words.
NO_WORD, TEXT_END = -1, -2
#: Steps of the start vectors, tokens of a step there and in the tasks, classes drawn, rate.
STEPS, STEP, TASK_STEP, NOISE, RATE = 4000, 512, 2048, 96, 0.08
#: Words that a task counts before it hands them on, bytes of text and tokens worked on at once.
FLUSH, BLOCK, BATCH = 400_000, 4 << 20, 2048


def words_of(text: bytes) -> list[bytes]:
    """bytes.lower and bytes.split know ASCII only: A-Z, and blank and U+0009 to U+000D."""
    return text.lower().split()


@dataclass
class Model:
    """Class vectors R (context) and Q (target), place vectors C, biases b, and the class and in-class cost of frequent words."""

    R: np.ndarray
    Q: np.ndarray
    C: np.ndarray
    b: np.ndarray
    words: dict[bytes, int]
    counts: np.ndarray
    classes: np.ndarray
    inside: np.ndarray

    def log_probs(self, tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log10 P(class) of each token; first: whether it opens a text. Before a text's start stand ends."""
        n = len(tokens)
        out = np.empty(n, np.float64)
        since = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))
        place = np.einsum("kd,cd->kcd", self.C, self.R).astype(np.float32)
        q, b = np.ascontiguousarray(self.Q.T.astype(np.float32)), self.b.astype(np.float32)
        for s in range(0, n, BATCH):
            at = np.arange(s, min(n, s + BATCH))
            h = np.zeros((len(at), SIZE), np.float32)
            for k in range(CONTEXT):
                h += place[k][np.where(since[at] > k, tokens[at - 1 - k], END)]
            logits = h @ q
            logits += b
            logits -= logits.max()  # one number for all tokens, which is cheaper
            own = logits[np.arange(len(at)), tokens[at]].astype(np.float64)
            total = np.exp(logits) @ np.ones(len(b), np.float32)
            low = np.flatnonzero(total < 1e-20)  # tokens that are far below it get their own
            if len(low):
                rest = logits[low].astype(np.float64)
                most = rest.max(axis=1)
                own[low] -= most
                total = total.astype(np.float64)
                total[low] = np.exp(rest - most[:, None]).sum(axis=1)
            out[at] = own - np.log(total)
        return out / np.log(10)


def company(ids: np.ndarray, lead: int, near: np.ndarray) -> None:
    """Add to near how often words stand up to three places from each of the most frequent ones, whose own rows stay 0.

    Pairs within the lead are left out.
    """
    own = near.shape[1]
    at = np.flatnonzero((ids >= 0) & (ids < own))
    for d in (-3, -2, -1, 1, 2, 3):
        y = at[(at + d >= 0) & (at + d < len(ids)) & (np.maximum(at, at + d) >= lead)]
        x = ids[y + d]
        ok = x >= own
        np.add.at(near.reshape(-1), x[ok].astype(np.int64) * own + ids[y[ok]], 1)


def share_classes(near: np.ndarray, seed: int = 0) -> np.ndarray:
    """Classes of frequent words: own ones, then k-means over which of those the other words stand near."""
    n_words, own = near.shape
    out = np.full(n_words, RARE, np.int64)
    out[:own] = 2 + np.arange(own)
    all_near = near.sum(axis=1)
    seen = np.flatnonzero(all_near > 0)
    seen = seen[seen >= own]
    if not len(seen):
        return out
    f = (near[seen] / all_near[seen, None]).astype(np.float32)
    f = np.sqrt(f / np.maximum(f.mean(axis=0), 1e-9))
    f /= np.maximum(np.linalg.norm(f, axis=1, keepdims=True), 1e-9)
    rng = np.random.default_rng(seed)
    centres = f[rng.choice(len(f), min(SHARED, len(f)), replace=False)]
    for _ in range(8):
        best = (f @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, best, f)
        centres = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 0, sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9), centres)
    out[seen] = 2 + own + (f @ centres.T).argmax(axis=1)
    return out


def gathered(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows by class."""
    order = np.argsort(at, kind="stable")  # a radix sort, classes are bytes
    starts = np.searchsorted(at[order], np.arange(n, dtype=at.dtype))
    ends = np.append(starts[1:], len(at))
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    held = starts < ends
    out[held] = np.add.reduceat(rows.take(order, axis=0), starts[held])
    return out


class Trainer:
    """Noise-contrastive estimation with Adagrad; noise classes are drawn by frequency p and shared by a step."""

    def __init__(self, p: np.ndarray, seed: int = 0):
        self.p, n = p, len(p)
        rng = np.random.default_rng(seed)
        self.params = [x.astype(np.float32) for x in (rng.normal(0, 0.1, (n, SIZE)), rng.normal(0, 0.1, (n, SIZE)), np.ones((CONTEXT, SIZE)) / CONTEXT, np.log(p))]
        self.sums = [np.full_like(x, 1e-3) for x in self.params]
        self.rng = rng

    def step(self, ctx: np.ndarray, y: np.ndarray, noise: int = NOISE, rate: float = RATE) -> None:
        """ctx: the classes at each place before the tokens, y: the tokens' own."""
        R, Q, C, b = self.params
        h = (R * C[0]).take(ctx[0], axis=0)
        for k in range(1, CONTEXT):
            h += (R * C[k]).take(ctx[k], axis=0)
        log_kp = np.log(noise * self.p).astype(np.float32)
        z, times = np.unique(self.rng.choice(len(self.p), noise, p=self.p), return_counts=True)
        q = Q.take(y, axis=0)
        with np.errstate(over="ignore"):
            gy = 1 / (1 + np.exp(np.einsum("ij,ij->i", h, q) + (b - log_kp).take(y)))  # how far the true class is from being told apart
            gz = h @ -Q[z].T
            gz -= b[z] - log_kp[z]
            np.exp(gz, out=gz)
            gz += 1
            np.divide(-times.astype(np.float32), gz, out=gz)
        dh = gy[:, None] * q + gz @ Q[z]
        grads = [np.zeros_like(R), gathered(y, gy[:, None] * h, len(b)), np.zeros_like(C), np.bincount(y, gy, len(b)).astype(np.float32)]
        grads[1][z] += gz.T @ h
        grads[3][z] += gz.sum(axis=0)
        for k in range(CONTEXT):
            by_class = gathered(ctx[k], dh, len(b))
            grads[0] += by_class * C[k]
            grads[2][k] = (by_class * R).sum(axis=0)
        for x, g, s in zip(self.params, grads, self.sums, strict=True):
            g /= len(y)
            s += g * g
            x += rate * g / np.sqrt(s)


def class_tokens(ids: np.ndarray, classes: np.ndarray) -> np.ndarray:
    return np.append(classes, [END, RARE]).astype(np.uint8)[ids]  # TEXT_END and NO_WORD count from the back


def contexts(tokens: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The classes at each place before each token; before a text's start stand ends."""
    out = np.full((CONTEXT, len(tokens)), END, np.uint8)
    n = np.arange(len(tokens))
    first = np.append(True, ids[:-1] == TEXT_END)
    since = n - np.maximum.accumulate(np.where(first, n, 0))
    for k in range(CONTEXT):
        out[k, k + 1 :] = np.where(since[k + 1 :] > k, tokens[: max(0, len(tokens) - 1 - k)], END)
    return out


def start(runs: list[tuple[np.ndarray, int]], classes: np.ndarray, p: np.ndarray, steps: int = STEPS, seed: int = 0) -> Trainer:
    """Vectors from some runs, (numbers of words, lead) each."""
    made = Trainer(p, seed)
    pairs = [(class_tokens(ids, classes), ids, lead) for ids, lead in runs]
    ctx = np.concatenate([contexts(t, ids)[:, lead:] for t, ids, lead in pairs], axis=1) if pairs else np.zeros((CONTEXT, 0), np.uint8)
    y = np.concatenate([t[lead:] for t, _, lead in pairs]) if pairs else np.zeros(0, np.uint8)
    for _ in range(steps if len(y) else 0):
        at = made.rng.integers(0, len(y), STEP)
        made.step(ctx.take(at, axis=1), y.take(at))
    return made


@tidy
def learn_batches(sent, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns ids, lead. Train on all tokens of the task's runs; place, weight * value and weight of each parameter."""
    first, classes = sent.value
    made = Trainer(first.p)
    made.params, made.sums = ([x.copy() for x in xs] for xs in (first.params, first.sums))
    as_context, n = np.zeros(len(first.p)), 0
    for batch in batches:
        for run, lead in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
            ids = np.frombuffer(run, np.int32)
            tokens = class_tokens(ids, classes)
            ctx, n = contexts(tokens, ids), n + len(ids) - lead
            as_context += np.bincount(ctx[:, lead:].ravel(), minlength=len(as_context))
            order = lead + made.rng.permutation(len(ids) - lead)
            for s in range(0, len(order), TASK_STEP):
                at = order[s : s + TASK_STEP]
                made.step(ctx.take(at, axis=1), tokens.take(at))
    if n:
        weights = [np.repeat(as_context, SIZE), *(np.full(x.size, float(n)) for x in made.params[1:])]
        w, x = np.concatenate(weights), np.concatenate([x.ravel() for x in made.params])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(w))), pa.array(w * x), pa.array(w)], ["place", "sum", "weight"])


def learned(first: Trainer, merged: list) -> list[np.ndarray]:
    """The averaged parameters; what no task saw stays as it started."""
    flat = np.concatenate([x.ravel() for x in first.params]).astype(np.float64)
    for place, total, weight in merged:
        if weight > 0:
            flat[place] = np.float32(total / weight)  # the order of the sum does not show
    ends = np.cumsum([x.size for x in first.params])
    return [x.reshape(old.shape) for x, old in zip(np.split(flat, ends[:-1]), first.params, strict=True)]


def model_of(params: list[np.ndarray], words: list[bytes], counts: list[int], classes: np.ndarray) -> Model:
    c = np.array(counts, np.float64) + 1
    inside = np.log10(c) - np.log10(np.bincount(classes, c, 2 + OWN + SHARED)[classes]) if len(words) else np.zeros(0)
    return Model(*params, {w: i for i, w in enumerate(words)}, np.array(counts, np.int64), classes, inside)


def frequencies(classes: np.ndarray, counts: list[int], n_words: int, n_docs: int) -> np.ndarray:
    """Share of each class among all training tokens."""
    freq = np.bincount(classes, np.array(counts, np.float64), 2 + OWN + SHARED) if len(classes) else np.zeros(2 + OWN + SHARED)
    freq[END] += n_docs
    freq[RARE] += n_words - sum(counts)
    return (freq + 0.5) / (freq + 0.5).sum()


def train(sample: list[bytes], words: list[bytes], counts: list[int], *, steps: int = STEPS, seed: int = 0) -> Model:
    """The model of texts that fit in memory."""
    place = {w: i for i, w in enumerate(words)}
    runs = list(runs_of(sample, place))
    near = np.zeros((len(words), min(OWN, len(words))), np.int64)
    for ids, lead in runs:
        company(ids, lead, near)
    classes = share_classes(near, seed)
    n_words = sum(len(words_of(t)) for t in sample)
    return model_of([x.astype(np.float64) for x in start(runs, classes, frequencies(classes, counts, max(n_words, sum(counts)), len(sample)), steps, seed).params], words, counts, classes)


def runs_of(texts: list[bytes], place: dict[bytes, int]) -> Iterator[tuple[np.ndarray, int]]:
    """Numbers of the words, TEXT_END after each text, in runs of RUN; a run that goes on starts with CONTEXT tokens already given, its lead."""
    get, rest, lead = place.get, np.zeros(0, np.int32), 0
    for a, b in blocks([len(t) for t in texts], BLOCK):
        ids: list[int] = []
        for t in texts[a:b]:
            ids += map(get, words_of(t), repeat(NO_WORD))
            ids.append(TEXT_END)
        rest = np.concatenate([rest, np.array(ids, np.int32)])
        while len(rest) >= RUN + lead:
            yield rest[: RUN + lead], lead
            rest, lead = rest[RUN + lead - CONTEXT :], CONTEXT
    if len(rest) > lead:
        yield rest, lead


@tidy
def run_batches(sent, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, lead in runs_of(text_bytes(batch[0]), sent.value):
            yield pa.RecordBatch.from_arrays([pa.array([ids.tobytes()], pa.binary()), pa.array([lead], pa.int32())], ["ids", "lead"])


@tidy
def company_batches(n_words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    near = np.zeros((n_words, min(OWN, n_words)), np.int32)
    for batch in batches:
        for run, lead in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
            company(np.frombuffer(run, np.int32), lead, near)
    at = np.flatnonzero(near)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(near.ravel()[at].astype(np.int64))], ["place", "n"])


@tidy
def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: Counter[bytes] = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "n"])
        found.clear()
        return out

    for batch in batches:
        texts = text_bytes(batch[0])
        for a, b in blocks([len(t) for t in texts], BLOCK):
            found.update(words_of(b"\n".join(texts[a:b])))
            if len(found) > FLUSH:
                yield flush()
    yield flush()


PARTS = "row long, id long, held_out boolean, n_tokens long, known long, base double, model double, n_rare long, rare array<struct<word: binary, n: int>>"


@tidy
def score_batches(sent, n_docs: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns row, id, held_out, text. What frequent words and ends give is summed here; rare words go on with their number."""
    model = sent.value
    get = model.words.get
    # Token ids here: frequent words from 0, then one for rare words, then the end.
    rare_id, end_id = len(model.words), len(model.words) + 1
    classes = np.concatenate([model.classes, [RARE, END]])
    inside = np.concatenate([model.inside, [0.0, 0.0]])
    base = np.concatenate([np.log10(model.counts + 1.0), [0.0, np.log10(n_docs + 1.0)]])
    for batch in batches:
        texts = text_bytes(batch[3])
        for a, b in blocks([len(t) for t in texts], BLOCK):
            flat, n, ids = [], [], []
            for t in texts[a:b]:
                ws = words_of(t)
                ids += map(get, ws, repeat(rare_id))
                ids.append(end_id)
                flat += ws
                flat.append(b"")
                n.append(len(ws) + 1)
            ids, n = np.array(ids, np.int64), np.array(n)
            starts = np.cumsum(n) - n
            first = np.zeros(len(ids), bool)
            first[starts] = True
            logs = model.log_probs(classes[ids], first) + inside[ids]
            is_rare = ids == rare_id
            rare = [Counter() for _ in n]
            at = np.flatnonzero(is_rare)
            for i, k in zip((np.searchsorted(starts, at, "right") - 1).tolist(), at.tolist(), strict=True):
                rare[i][flat[k]] += 1
            n_rare = np.add.reduceat(is_rare.astype(np.int64), starts)
            known = n - n_rare - (n_docs == 0)  # frequent words and, if anything was learned, the end
            sums = [known, np.add.reduceat(base[ids], starts), np.add.reduceat(logs, starts), n_rare]
            flat = pa.StructArray.from_arrays([pa.array([w for r in rare for w in r], pa.binary()), pa.array([k for r in rare for k in r.values()], pa.int32())], ["word", "n"])
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rare)]), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*(batch[i].slice(a, b - a) for i in range(3)), pa.array(n, pa.int64()), *map(pa.array, sums), lists], [f.split()[0] for f in PARTS.split(", ")[:9]])


def frequent_words(counts: DataFrame) -> list[tuple[bytes, int]]:
    """The words above a count that TOP_WORDS of them reach at most, the most frequent first.

    The bound comes from a histogram of a few thousand steps, so the driver gets
    that and the words themselves, never a candidate list from each partition.
    """
    short = counts.where(F.octet_length("word") <= WORD_BYTES).withColumn("step", F.floor(F.log2("c") * 64))
    bound, words = None, 0
    for r in sorted(short.groupBy("step").agg(F.count("*").alias("n")).collect(), key=lambda r: -r["step"]):
        words += r["n"]
        if words > TOP_WORDS:
            break
        bound = r["step"]
    if bound is None:
        return []
    found = [(bytes(r["word"]), r["c"]) for r in short.where(F.col("step") >= bound).select("word", "c").collect()]
    return sorted(found, key=lambda x: (-x[1], x[0]))


def learn(texts: DataFrame, words: list[bytes], counts: list[int], n_words: int, n_docs: int) -> Model:
    """The model of all texts (one column) over their frequent words."""
    context = texts.sparkSession.sparkContext
    sent = context.broadcast({w: i for i, w in enumerate(words)})  # bounded by TOP_WORDS and WORD_BYTES
    # Runs are dealt by hash, so each task trains on texts from everywhere in the table.
    runs = texts.mapInArrow(lambda b: run_batches(sent, b), "ids binary, lead int")
    runs = stage(runs.repartition(F.xxhash64("ids")), "runs")
    n_top, own = len(words), min(OWN, len(words))
    near = np.zeros((n_top, own), np.int64)
    if n_top:
        pairs = runs.mapInArrow(lambda b: company_batches(n_top, b), "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
        found = pairs.toArrow()  # at most TOP_WORDS * OWN
        near.reshape(-1)[found["place"].to_numpy()] = found["n"].to_numpy()
    classes = share_classes(near)
    # Hashes first: a sort of the runs themselves would send START of them from each partition.
    least = [r[0] for r in runs.select(F.xxhash64("ids").alias("h")).distinct().orderBy("h").limit(START).collect()]
    some = runs.where(F.xxhash64("ids").isin(least)).limit(START).collect() if least else []
    some = sorted((bytes(r["ids"]), r["lead"]) for r in some)
    first = start([(np.frombuffer(ids, np.int32), lead) for ids, lead in some], classes, frequencies(classes, counts, n_words, n_docs))
    begin = context.broadcast((first, classes))
    merged = runs.mapInArrow(lambda b: learn_batches(begin, b), "place long, sum double, weight double")
    merged = merged.groupBy("place").agg(F.sum("sum"), F.sum("weight")).collect()  # one row a parameter
    return model_of(learned(first, merged), words, counts, classes)


def score(docs: DataFrame, held_out: Column, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, held_out, n_tokens, n_known, train_tokens, base_score, score for each row; learned from rows not held out.

    Tokens: words of the text after lower-casing A-Z, then one end; null text
    is empty, its only token the end. A null held_out counts as false. base_score: sum of
    log10((c + 1) / (N + V + 1)), c the token's count, N all and V distinct tokens
    of the training part; score: the model's log10 probability. Without
    training rows N = V = 0 and the model is even. Repeated rows are learned and scored
    each; null identifiers are scored as others.
    """
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    training = rows.where(~F.col("held_out"))
    counts = stage(training.select("text").mapInArrow(count_batches, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c")), "counts")
    n_words, v_words = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n_docs = training.select("id").count()
    n_all, v_all = n_words + n_docs, v_words + (n_docs > 0)
    top = frequent_words(counts)
    words, known = [w for w, _ in top], [c for _, c in top]
    model = learn(training.select("text"), words, known, n_words, n_docs)
    top_mass = sum(c + 1 for _, c in top)
    # The class of all further words: those the sample did not show are in it with the rare ones and one unknown.
    listed = np.bincount(model.classes, np.array([c + 1.0 for _, c in top]), 2 + OWN + SHARED)[RARE] if top else 0.0
    rare_mass = n_words + v_words - top_mass + 1 + listed
    in_rare = model.classes == RARE
    model.inside[in_rare] = np.log10(model.counts[in_rare] + 1.0) - np.log10(rare_mass)
    sent = spark.sparkContext.broadcast(model)  # bounded by TOP_WORDS, WORD_BYTES and the classes
    parts = stage(rows.mapInArrow(lambda b: score_batches(sent, n_docs, b), PARTS), "parts")
    rare = parts.select("row", F.inline("rare")).join(counts, "word")
    rare = rare.groupBy("row").agg(F.sum("n").alias("more_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("logs"))
    logs = F.coalesce("logs", F.lit(0.0))
    return parts.drop("rare").join(rare, "row", "left").select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * F.lit(float(np.log10(n_all + v_all + 1)))).alias("base_score"),
        (F.col("model") + logs - F.col("n_rare") * F.lit(float(np.log10(rare_mass)))).alias("score"),
    )
