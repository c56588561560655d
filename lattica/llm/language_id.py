"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts, up to ORDER bytes long, with the
counts of what followed them in its training texts. The code length of a byte is
that in its longest known context: -log2(count / (total + distinct)) if the byte
was seen there, else the escape, -log2(distinct / (total + distinct)), plus its
length in the context one byte shorter; below the empty context all 256 bytes
are alike. The statistics are frozen; lengths are kept in 1/4096 bits as integers, so sums are
exact whatever the order. The language with the shortest code wins.

Training reads a bounded sample of labelled rows, SAMPLE_DOCS of each language;
the trees have every context that these show. They are counted where the
rows are: what reaches the driver is a tree's deepest level, from which the others
follow, as sorted arrays. A worker looks up each string of ORDER + 1 bytes that it meets in each
language's tree once, and remembers what it found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import KeyTable, blocks, tidy

#: Bytes of context; a string of them and the byte after is a number of 32 bits.
ORDER = 3
#: Labelled documents of each language that training reads, whole, whatever their length: those of least hash.
SAMPLE_DOCS = 600
#: Bytes that are scored at once, and lengths that a worker remembers.
BLOCK, MEMO = 1 << 20, 8 << 20
UNIT = 4096
UNDETERMINED = "und"


def grams_of(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """In blocks: the number of each byte with the ORDER before it, and the text that it is of. A text starts as if after line ends."""
    pieces = []
    for i, t in enumerate(texts):
        for s in range(0, len(t), BLOCK):
            lead = t[s - ORDER : s] if s >= ORDER else b"\n" * ORDER
            pieces.append((i, lead + t[s : s + BLOCK]))
    for a, b in blocks([len(p) for _, p in pieces], BLOCK):
        data = np.frombuffer(b"".join(p for _, p in pieces[a:b]), np.uint8).astype(np.int64)
        key = np.zeros(len(data) - ORDER, np.int64)
        for j in range(ORDER + 1):
            key = key << 8 | data[j : len(data) - ORDER + j]
        n = np.array([len(p) - ORDER for _, p in pieces[a:b]])
        own = np.repeat(np.cumsum(n + ORDER) - n - ORDER - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        yield key[own], np.repeat([i for i, _ in pieces[a:b]], n)


@dataclass
class Tree:
    """Of each order: the strings seen (context and byte) with their lengths, the contexts with their escapes, all sorted."""

    strings: list[np.ndarray]
    lengths: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray) -> Tree:
        """From the counts of the strings of ORDER + 1 bytes."""
        out = cls([], [], [], [])
        for order in range(ORDER + 1):
            strings, of = np.unique(keys & (1 << 8 * (order + 1)) - 1, return_inverse=True)
            n = np.bincount(of, counts, len(strings))
            contexts, of = np.unique(strings >> 8, return_inverse=True)
            distinct = np.bincount(of, minlength=len(contexts))
            total = np.bincount(of, n, len(contexts)) + distinct
            out.strings.append(strings)
            out.lengths.append(np.rint(-np.log2(n / total[of]) * UNIT).astype(np.int32))
            out.contexts.append(contexts)
            out.escapes.append(np.rint(-np.log2(distinct / total) * UNIT).astype(np.int32))
        return out

    def code(self, keys: np.ndarray) -> np.ndarray:
        """The code length of the last byte of each of the strings of ORDER + 1 bytes, in 1/UNIT bits."""
        out = np.full(len(keys), 8 * UNIT, np.int32)
        for order in range(ORDER + 1):
            own = keys & (1 << 8 * (order + 1)) - 1
            seen, at = _placed(self.strings[order], own)
            known, context = _placed(self.contexts[order], own >> 8)
            out = np.where(seen, self.lengths[order][at], np.where(known, out + self.escapes[order][context], out))
        return out


def _placed(among: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is among the sorted ones, and where."""
    at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return among[at] == keys, at


@dataclass
class Model:
    """The languages' trees, and what this worker remembers of them."""

    languages: list[str]
    trees: list[Tree]
    table: KeyTable = field(default_factory=KeyTable)
    memo: np.ndarray | None = None

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text for each language, in 1/UNIT bits."""
        out = np.zeros((len(texts), len(self.trees)), np.int64)
        for keys, of in grams_of(texts):
            if not self.trees:
                break
            found = self.table.find(keys)
            if (found < 0).any():
                self.learn(np.unique(keys[found < 0]))
                found = self.table.find(keys)
            starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            for k, row in enumerate(self.memo):
                out[of[starts], k] += np.add.reduceat(row[found], starts, dtype=np.int64)
            if self.memo.size > MEMO:
                self.table, self.memo = KeyTable(), None
        return out

    def learn(self, keys: np.ndarray) -> None:
        new = np.stack([tree.code(keys) for tree in self.trees])
        for key in keys.tolist():
            self.table.add(key)
        self.memo = new if self.memo is None else np.concatenate([self.memo, new], axis=1)


def train(counts: list[tuple[str, np.ndarray, np.ndarray]]) -> Model:
    """From each language's counts of strings of ORDER + 1 bytes."""
    return Model([lang for lang, _, _ in counts], [Tree.of(keys, n) for _, keys, n in counts])


@tidy
def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns lang, text: how often each string of ORDER + 1 bytes stands in each language's texts."""
    for batch in batches:
        for lang, text in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
            for keys, _ in grams_of([text.encode()]):
                found, n = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found), pa.array(n)], ["lang", "gram", "n"])


@tidy
def predict_batches(sent, keep_text: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model = sent.value
    for batch in batches:
        texts = [t or "" for t in batch[1].to_pylist()]
        lengths = model.lengths([t.encode() for t in texts]) if model.languages else np.zeros((len(texts), 1), np.int64)
        best = lengths.argmin(axis=1)
        lead = lengths - lengths[np.arange(len(best)), best][:, None]
        score = 1 / np.exp2(-np.minimum(lead / UNIT, 1000.0)).sum(axis=1)
        letter = np.array([has_letter(t) for t in texts], bool)
        known = letter & bool(model.languages)
        names = [model.languages[i] if k else UNDETERMINED for i, k in zip(best.tolist(), known.tolist(), strict=True)]
        own = [i for i in range(batch.num_columns) if i != 1 or keep_text]
        yield pa.RecordBatch.from_arrays([*(batch[i] for i in own), pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0)), pa.array(letter)], [*(batch.schema.names[i] for i in own), "lang_pred", "score", "letter"])


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def bucket(id_col: str | Column, modulus: int) -> Column:
    """crc32 of the identifier as text, modulo modulus; null as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col.cast("string"), F.lit(""))) % modulus


def fit(docs: DataFrame, train_on: Column, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Train on at most SAMPLE_DOCS documents of each language among the rows of train_on that have one.

    The choice is by a hash of the identifier, so reruns agree. Null and empty texts are not chosen.
    """
    rows = docs.where(train_on & F.col(lang_col).isNotNull() & (F.octet_length(text_col) > 0))
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col).alias("h"))
    n = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}  # one row a language
    if not n:
        return train([])
    # A hash threshold for each language lets about twice the sample through, so the window below sorts no more than that.
    cut = F.lit(False)
    for lang, rows_of in sorted(n.items()):
        share = min(1.0, 2 * SAMPLE_DOCS / rows_of)
        cut = cut | ((F.col("lang") == lang) & (F.pmod("h", F.lit(1 << 30)) <= int(share * (1 << 30))))
    order = Window.partitionBy("lang").orderBy("h", "text")
    sample = rows.where(cut).withColumn("k", F.row_number().over(order)).where(F.col("k") <= SAMPLE_DOCS)
    # Spread first, or each language's texts would be counted in one task.
    spread = sample.select("lang", "text").repartition(F.xxhash64("text"))
    found = spread.mapInArrow(count_batches, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    langs, grams, counts = np.array(found["lang"].to_pylist(), object), found["gram"].to_numpy(), found["n"].to_numpy()
    return train([(lang, grams[langs == lang], counts[langs == lang]) for lang in sorted(set(langs))])


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), lettered: bool = False) -> DataFrame:
    """id_col, lang_pred, score and the columns in carry for each row.

    lang_pred is the language of the shortest code, ties to the first by name;
    "und" with score 0 if the text is null or has no letter, or nothing was
    learned. score is the winner's probability if all languages are equally
    likely beforehand, 2^-length normalised. Only the text is looked at. Rows are
    independent, so repeated rows and null identifiers need no care. lettered:
    only rows whose text has a letter, whether or not anything was learned.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by SAMPLE_DOCS a language
    place = {c: f"c{i}" for i, c in enumerate(dict.fromkeys([id_col, *carry])) if c != text_col} | {text_col: "t"}
    own = docs.select(F.col(f"`{id_col}`").alias(place[id_col]), F.col(f"`{text_col}`").alias("t"), *[F.col(f"`{c}`").alias(k) for c, k in place.items() if c not in (id_col, text_col)])
    keep_text = text_col in carry
    schema = ", ".join([f"{k} {kind}" for k, kind in own.dtypes if k != "t" or keep_text] + ["lang_pred string", "score double", "letter boolean"])
    out = own.mapInArrow(lambda b: predict_batches(sent, keep_text, b), schema)
    if lettered:
        out = out.where("letter")
    return out.select(*[F.col(place[c]).alias(c) for c in dict.fromkeys([id_col, *carry])], "lang_pred", "score")
