"""Byte-level BPE encoding and decoding.

A word's symbols form a doubly linked list; a priority queue holds the rank and
place of every adjacent pair that can merge. The lowest rank merges first, leftmost
first; entries whose pair has changed since are stale and skipped. Decoding
concatenates the vocabulary's byte strings.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, text_bytes, text_sizes, tidy

#: Words that a worker remembers as new ones; with as many, it keeps them as old ones and forgets those that were old. Longer words are never kept.
MEMO_WORDS, MEMO_CHARS = 160_000, 48
#: Characters of a text that are worked on at once, if it has a place to cut, and bytes of texts handed on at once.
PIECE, BLOCK = 1 << 20, 1 << 20
#: How the pre-tokenizer of byte-level vocabularies cuts a text into words.
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Between these two a word always ends: a letter, then a blank that belongs to the next word.
SAFE_CUT = regex.compile(r"(?<=\p{L})(?= \p{L})")


@lru_cache(1)
def byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte: itself where printable, else the next free one from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Memo(dict):
    """word -> ids, filled on demand and bounded; words that were used lately survive."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.old.get(word)
        if ids is None:
            ids = tuple(self.encode(word))
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


class ByteBPE:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        chars = byte_chars()
        back = {c: b for b, c in chars.items()}
        self.single = [vocab[chars[b]] for b in range(256)]
        #: left id << 20 | right id -> rank, and rank -> merged id.
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[vocab[a] << 20 | vocab[b]] = r
            self.merged.append(vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces: dict[int, bytes] = {i: bytes(back[c] for c in t) for t, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        self.names = {i: str(i) for i in self.pieces}
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.memo = _Memo(self.encode_word)

    def encode_word(self, word: str) -> list[int]:
        sym = list(map(self.single.__getitem__, word.encode()))
        n = len(sym)
        if n < 2:
            return sym
        rank, merged = self.rank, self.merged
        shift = n.bit_length()
        mask = (1 << shift) - 1
        queue = [r << shift | i for i in range(n - 1) if (r := rank.get(sym[i] << 20 | sym[i + 1])) is not None]
        if not queue:
            return sym
        heapify(queue)
        prev, next_ = list(range(-1, n - 1)), list(range(1, n + 1))
        while queue:
            e = heappop(queue)
            r, i = e >> shift, e & mask
            j = next_[i]
            if j >= n or sym[i] < 0 or rank.get(sym[i] << 20 | sym[j]) != r:  # stale: one of the pair has merged meanwhile
                continue
            sym[i], sym[j] = merged[r], -1
            k = next_[i] = next_[j]
            if k < n:
                prev[k] = i
                if (q := rank.get(sym[i] << 20 | sym[k])) is not None:
                    heappush(queue, q << shift | i)
            h = prev[i]
            if h >= 0 and (q := rank.get(sym[h] << 20 | sym[i])) is not None:
                heappush(queue, q << shift | h)
        return [s for s in sym if s >= 0]

    def pieces_of(self, text: str) -> Iterator[str]:
        """The text in parts that encode independently, of about PIECE characters where it has a place to cut."""
        start = 0
        while len(text) - start > PIECE and (cut := SAFE_CUT.search(text, start + PIECE)):
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def encode_parts(self, text: str) -> Iterator[list[int]]:
        sections = self.splitter.split(text) if self.splitter and any(s in text for s in self.special) else [text]
        for section in sections:
            if section in self.special:
                yield [self.special[section]]
            else:
                for piece in self.pieces_of(section):
                    yield list(chain.from_iterable(map(self.memo.__getitem__, PRETOKEN.findall(piece))))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.encode_parts(text)))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(2)
def load(path: str) -> ByteBPE:
    return ByteBPE(path)


@tidy
def digest_batches(path: str, keep_ids: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns text, then others that are handed on."""
    bpe = load(path)
    for batch in batches:
        for a, b in blocks(text_sizes(batch[0]), BLOCK):
            out, ids_of = [], []
            for raw in text_bytes(batch[0].slice(a, b - a)):
                ids_hash, n, pieces, kept = hashlib.sha256(), 0, [], []
                for ids in bpe.encode_parts(raw.decode()):
                    if ids:
                        ids_hash.update((("," if n else "") + ",".join(map(bpe.names.__getitem__, ids))).encode())
                        n += len(ids)
                        pieces.append(b"".join(map(bpe.pieces.__getitem__, ids)))
                        if keep_ids:
                            kept.append(np.array(ids, np.int32))
                decoded = b"".join(pieces).decode("utf-8", "replace")
                out.append((n, ids_hash.hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
                ids_of.append(np.concatenate(kept) if kept else np.zeros(0, np.int32))
            made = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.string(), pa.string()), strict=True)]
            names = ["n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                made.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ids_of)]), pa.int32()), pa.array(np.concatenate(ids_of))))
                names.append("ids")
            others = range(1, batch.num_columns)
            yield pa.RecordBatch.from_arrays([*(batch[i].slice(a, b - a) for i in others), *made], [*(batch.schema.names[i] for i in others), *names])


def round_trip(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), ids: bool = False) -> DataFrame:
    """Encode every text, decode it again, and return id_col, carry, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids for each row.

    ids_sha256 is of the decimal ids joined by commas, decoded_sha256 of the
    decoded text. Null counts as empty: 0 tokens and the digests of nothing.
    Special tokens inside a text are matched as the vocabulary's default. Rows
    are independent: repeated rows, null identifiers and further columns, of whatever name, need
    no care. tokenizer is a path that every executor has.
    """
    names = list(dict.fromkeys([id_col, *carry]))
    own = docs.select(F.col(f"`{text_col}`").alias("t"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    schema = ", ".join([f"c{i} {kind}" for i, (_, kind) in enumerate(own.dtypes[1:])] + ["n_tokens long, ids_sha256 string, decoded_sha256 string"] + ["ids array<int>"] * ids)
    found = own.mapInArrow(lambda b: digest_batches(tokenizer, ids, b), schema)
    return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], *found.columns[len(names) :])


@tidy
def encode_batches(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bpe = load(path)
    for batch in batches:
        ids = [bpe.encode(t or "") for t in batch[1].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch[0], pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])


def encode(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the token ids of every text; null text: no ids."""
    return docs.select(id_col, text_col).mapInArrow(lambda b: encode_batches(tokenizer, b), f"{id_col} long, ids array<int>")


@tidy
def decode_batches(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bpe = load(path)
    for batch in batches:
        texts = [None if x is None else bpe.decode(x) for x in batch[1].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch[0], pa.array(texts, pa.string())], ["doc_id", "text"])


def decode(encoded: DataFrame, tokenizer: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the text of every id list; null list: null text."""
    return encoded.select(id_col, ids_col).mapInArrow(lambda b: decode_batches(tokenizer, b), f"{id_col} long, text string")
