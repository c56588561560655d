"""Token counts by compiled finite-state transducers.

The tokenizer's file is compiled into two deterministic transducers.

The first reads characters. It has seven states and cuts the lower-cased text
into words; its transitions say whether a word starts at this character or, for
an apostrophe that turned out to be no contraction, at the one before. A text is
cut into chunks that are read side by side: each chunk is run from all seven
states at once, which gives its state map; the maps compose through a parallel
prefix scan; and with each chunk's true start state known, a second run emits
the marks. So one very long text is as fast as many short ones.

The second reads the bytes of the words and a mark at each word's end. Every
transition is annotated with the tokens it emits. Its state has the places where
a token can still start: how far back each is, the last token of what was
tokenized up to there, and by how many its tokens exceed those already emitted.
The last token after one more byte is the one token that ends there and may
follow the token ending where it starts, where "may follow" means that merging
their symbols gives just the two again. The word's end leads back to the first
state and emits what is outstanding, so every chunk that starts and ends with a word maps the
first state to itself and a number of tokens; these maps, too, compose by a
prefix scan, of which each text's count is a difference. States and transitions are compiled
when first reached and kept in a hash table of arrays, in which all chunks look
their next transition up at once.
"""

from __future__ import annotations

import json
import unicodedata
from collections import Counter as Tally
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame

from .byte_bpe import byte_chars
from .common import KeyTable, tidy

#: States of the second transducer and token pairs that a worker remembers; beyond, it forgets them all and starts anew.
MAX_STATES, MEMO_PAIRS = 250_000, 500_000
#: Characters of text that are read at once, and chunks they are cut into at most.
BLOCK, LANES = 2 << 20, 4096
#: Bytes from which a word is read by itself: it would hold up the chunks beside its own.
LONG = 2048
#: The second transducer's symbol at a word's end, after the 256 bytes, and the bits of a symbol.
END, SYMBOL_BITS = 256, 9

#: Symbol classes of the first transducer: blank, letter, number, other, apostrophe, then the letters of contractions.
BLANK, LETTER, NUMBER, OTHER, APOS = range(5)
CONTRACTION = "stmdrvle"
#: Its states: at a word's end, in letters, in others, after an apostrophe, after it and r, v or l.
FRESH, LETTERS, OTHERS, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(7)
STATES, SYMBOLS = 7, 5 + len(CONTRACTION)
#: Code points that the pattern's \\s matches.
SPACES = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def unassigned() -> list[int]:
    """Code points that Python's character tables do not know; the tokenizer's may. Beyond plane 3 there are none in use."""
    return [c for c in range(0x40000) if unicodedata.category(chr(c)) == "Cn"]


def symbol_table(kind_of: dict[int, int]) -> np.ndarray:
    """The symbol class of each code point; kind_of has those that Python's character tables do not know."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    for c, kind in kind_of.items():
        out[c] = kind
    out[list(SPACES)] = BLANK
    out[ord("'")] = APOS
    for i, c in enumerate(CONTRACTION):
        out[ord(c)] = 5 + i
    return out


@lru_cache(1)
def word_transducer() -> tuple[np.ndarray, np.ndarray]:
    """Next state and output of each (state, symbol). Output 1: a word starts here; 2: one started at the character before."""
    after = np.zeros((STATES, SYMBOLS), np.int16)
    out = np.zeros((STATES, SYMBOLS), np.uint8)
    letters = [LETTER, *range(5, SYMBOLS)]
    sym = {c: 5 + i for i, c in enumerate(CONTRACTION)}
    for s in (FRESH, LETTERS, OTHERS, QUOTE):
        after[s, BLANK] = FRESH
        after[s, NUMBER], out[s, NUMBER] = FRESH, 1
        after[s, OTHER], out[s, OTHER] = OTHERS, s in (FRESH, LETTERS)
        after[s, APOS], out[s, APOS] = (QUOTE, 1) if s in (FRESH, LETTERS) else (OTHERS, 0)
        for c in letters:
            after[s, c], out[s, c] = LETTERS, s != LETTERS
    for c in "stmd":
        after[QUOTE, sym[c]], out[QUOTE, sym[c]] = FRESH, 0
    for c, s, end in (("r", QUOTE_R, "e"), ("v", QUOTE_V, "e"), ("l", QUOTE_L, "l")):
        after[QUOTE, sym[c]], out[QUOTE, sym[c]] = s, 0
        after[s], out[s] = after[LETTERS], out[LETTERS] | 2
        after[s, sym[end]], out[s, sym[end]] = FRESH, 0
    return after, out


def run_chunks(symbols: np.ndarray, start: int = FRESH) -> tuple[np.ndarray, int]:
    """The outputs of the first transducer over all symbols, and its last state."""
    after, out = word_transducer()
    n = len(symbols)
    lanes = max(1, min(LANES, n // 64))
    steps = -(-n // lanes)
    padded = np.full(lanes * steps, BLANK, np.uint8)
    padded[:n] = symbols
    columns = np.ascontiguousarray(padded.reshape(lanes, steps).T).astype(np.intp)
    step = (after.astype(np.intp) * SYMBOLS).ravel()  # states are kept times SYMBOLS, ready to add a symbol
    states = np.repeat(np.arange(STATES, dtype=np.intp)[:, None] * SYMBOLS, lanes, axis=1)
    for c in columns:
        states += c
        np.take(step, states, out=states, mode="clip")
    maps = (states // SYMBOLS).T.copy()  # of each chunk: end state by start state
    d = 1
    while d < lanes:  # parallel prefix: after this, maps[i] is the composition of chunks 0 to i
        maps[d:] = np.take_along_axis(maps[d:], maps[:-d].copy(), axis=1)
        d *= 2
    state = np.empty(lanes, np.intp)
    state[0] = start
    state[1:] = maps[:-1, start]
    state *= SYMBOLS
    marks = np.empty((steps, lanes), np.uint8)
    emit = out.ravel()
    for t, c in enumerate(columns):
        state += c
        np.take(emit, state, out=marks[t], mode="clip")
        np.take(step, state, out=state, mode="clip")
    return marks.T.reshape(-1)[:n], int(maps[-1, start])


def word_bounds(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word; the last symbol has to be blank."""
    marks, _ = run_chunks(symbols)
    begins = marks & 1
    begins[:-1] |= marks[1:] >> 1
    starts = np.flatnonzero(begins)
    blank = np.flatnonzero(symbols == BLANK)
    ends = blank[np.searchsorted(blank, starts)]
    if len(starts):
        ends[:-1] = np.minimum(ends[:-1], starts[1:])
    return starts, ends


class MergeTransducer:
    """Bytes of words to numbers of tokens."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        self.suffix = suffix
        self.rank = {}
        for r, pair in enumerate(merges):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[a, b] = r
        byte_of = {c: b for b, c in byte_chars().items()}
        self.tokens = list(vocab)
        #: Which tokens their own symbols merge to: None until asked.
        self.own: list[bool | None] = [None] * len(self.tokens)
        #: Bytes of a token inside a word, and at its end; and all that a token can start with.
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        self.begins: set[bytes] = set()
        for i, t in enumerate(self.tokens):
            body = t.removesuffix(suffix)
            if all(c in byte_of for c in body):
                raw = bytes(byte_of[c] for c in body)
                (self.inner if len(body) == len(t) else self.final)[raw] = i
                self.begins.update(raw[:k] for k in range(1, len(raw) + 1))
        self.pairs: dict[int, bool] = {}
        self.forget()

    def forget(self) -> None:
        #: A state: the bytes from its first open place on, then of each open place its distance, last token and outstanding tokens.
        self.states: list[tuple] = [(b"", (0, -1, 0))]
        self.number = {self.states[0]: 0}
        self.known = KeyTable()
        self.after, self.emits = np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int16)

    def symbols(self, token: str) -> list[str]:
        body = token.removesuffix(self.suffix)
        out = list(body)
        if len(body) < len(token):
            out[-1] += self.suffix
        return out

    def merge(self, symbols: list[str]) -> list[str]:
        """The tokens that merging by rank makes of the symbols; for short lists."""
        rank = self.rank
        while len(symbols) > 1:
            best, at = 1 << 30, -1
            for i, pair in enumerate(zip(symbols, symbols[1:], strict=False)):
                r = rank.get(pair, best)
                if r < best:
                    best, at = r, i
            if at < 0:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def stands(self, i: int) -> bool:
        """Whether merging the token's symbols gives it."""
        if self.own[i] is None:
            self.own[i] = self.merge(self.symbols(self.tokens[i])) == [self.tokens[i]]
        return self.own[i]

    def follows(self, a: int, b: int) -> bool:
        """Whether token b may come after token a, or open a word if a is -1."""
        if a < 0:
            return self.stands(b)
        known = self.pairs.get(a << 20 | b)
        if known is None:
            x, y = self.tokens[a], self.tokens[b]
            known = self.stands(b) and self.merge(self.symbols(x) + self.symbols(y)) == [x, y]
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            self.pairs[a << 20 | b] = known
        return known

    def compile(self, state: int, symbol: int) -> tuple[int, int]:
        """The state that the transition leads to and the tokens it emits."""
        held, *open_ = self.states[state]
        if symbol == END:
            if not held:
                return 0, 0
            for n, last, more in open_:
                token = self.final.get(held[len(held) - n :])
                if n and token is not None and self.follows(last, token):
                    return 0, more + 1
            raise ValueError(f"no token ends a word after {held!r}")
        held += bytes([symbol])
        new, ends = [], None
        for n, last, more in open_:  # the farthest back first; just one of them starts the last token
            raw = held[len(held) - n - 1 :]
            if ends is None:
                token = self.inner.get(raw)
                if token is not None and self.follows(last, token):
                    ends = (0, token, more + 1)
            if raw in self.begins:
                new.append((n + 1, last, more))
        if ends is None:
            raise ValueError(f"no token ends after {held!r}")
        new.append(ends)
        out = new[0][2]
        key = (held[len(held) - new[0][0] :], *((n, last, more - out) for n, last, more in new))
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
        return to, out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of the transitions (state << SYMBOL_BITS | symbol); missing ones are compiled."""
        found = self.known.find(keys)
        missing = keys[found < 0]
        if len(missing):
            for key in np.unique(missing).tolist():
                i = self.known.add(key)
                if i == len(self.after):
                    self.after, self.emits = np.append(self.after, np.zeros_like(self.after)), np.append(self.emits, np.zeros_like(self.emits))
                self.after[i], self.emits[i] = self.compile(key >> SYMBOL_BITS, key & (1 << SYMBOL_BITS) - 1)
            found = self.known.find(keys)
        return found

    def read(self, symbols: np.ndarray, opens: np.ndarray) -> np.ndarray:
        """The tokens that each symbol's transition emits. opens: where words start; the last symbol is END."""
        out = np.zeros(len(symbols), np.int16)
        if not len(opens):
            return out
        if len(self.states) > MAX_STATES:
            self.forget()
        lengths = np.diff(np.append(opens, len(symbols)))
        for i in np.flatnonzero(lengths > LONG).tolist():
            state, keys = 0, symbols[opens[i] : opens[i] + lengths[i]]
            for k, symbol in enumerate(keys.tolist()):
                at = self.find(np.array([state << SYMBOL_BITS | symbol]))[0]
                state, out[opens[i] + k] = int(self.after[at]), self.emits[at]
        # Chunks of whole words, cut near even distances and around long words; the longest first, so those still running stand in front.
        short = lengths <= LONG
        step = max(64, len(symbols) // LANES)
        cut = np.append(True, (opens[1:] // step != opens[:-1] // step) | ~short[:-1] | ~short[1:])
        first = opens[cut]
        size = np.add.reduceat(lengths, np.flatnonzero(cut))
        first, size = first[short[cut]], size[short[cut]]
        order = np.argsort(-size, kind="stable")
        first, size = first[order], size[order]
        state = np.zeros(len(first), np.int64)
        for t in range(int(size[0]) if len(size) else 0):
            k = int(np.searchsorted(-size, -t, "left"))
            at = first[:k] + t
            found = self.find(state[:k] << SYMBOL_BITS | symbols[at])
            state[:k] = self.after[found]
            out[at] = self.emits[found]
        return out


class Counter:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model.get("end_of_word_suffix") != "</w>":
            raise ValueError("a word-end vocabulary is expected")
        self.words = MergeTransducer(model["vocab"], model["merges"], "</w>")
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(regex.escape(x) for x in sorted(self.specials, key=len, reverse=True)))
        # Characters are those of the tokenizer's library, which knows some that Python's tables do not, and composes by older ones.
        library = tokenizers.Tokenizer.from_file(path)
        new = unassigned()
        joined = "".join(f" a{chr(c)}{chr(c)}b" for c in new)
        pieces = Tally(span[0] // 5 for _, span in library.pre_tokenizer.pre_tokenize_str(joined))
        self.table = symbol_table({c: {1: LETTER, 4: NUMBER}.get(pieces[i], OTHER) for i, c in enumerate(new)})
        lower = tokenizers.normalizers.Lowercase()
        self.lower = {c: x for c, x in zip(new, lower.normalize_str("\n".join(map(chr, new))).split("\n"), strict=True) if x != chr(c)}
        self.newer = regex.compile("[" + "".join(map(chr, self.lower)) + "]") if self.lower else None
        self.compose = tokenizers.normalizers.NFC().normalize_str

    def normal(self, text: str) -> str:
        """NFC and lower case, character by character: a final sigma is an ordinary one."""
        if text.isascii():
            return text.lower()
        if not unicodedata.is_normalized("NFC", text):
            text = self.compose(text)
        text = text.replace("Σ", "σ").lower()
        return text.translate(self.lower) if self.newer and self.newer.search(text) else text

    def pieces(self, text: str) -> Iterator[tuple[str, int]]:
        """The normal text in parts of about BLOCK characters, cut at blanks, each with its number of special tokens."""
        start = 0
        while start < len(text):
            end = text.find(" ", start + BLOCK) if len(text) - start > BLOCK else -1
            part = text[start : end if end >= 0 else len(text)] if start or end >= 0 else text
            start = end if end >= 0 else len(text)
            n = 0
            if any(x in part for x in self.specials):
                part, n = self.special.subn("\n", part)  # a special token is one token and parts the text around it
            yield self.normal(part) + "\n", n

    def count(self, texts: list[str]) -> np.ndarray:
        total = np.zeros(len(texts), np.int64)
        parts, of, held = [], [], 0
        for i, t in enumerate(texts):
            for part, n in self.pieces(t):
                total[i] += n
                if held + len(part) > BLOCK and held:
                    np.add.at(total, of, self.tokens(parts))
                    parts, of, held = [], [], 0
                parts.append(part)
                of.append(i)
                held += len(part)
        if parts:
            np.add.at(total, of, self.tokens(parts))
        return total

    def tokens(self, parts: list[str]) -> np.ndarray:
        """The tokens of each of the parts, which end with a blank."""
        joined = "".join(parts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts, ends = word_bounds(self.table[codes])
        data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
        edges = np.cumsum([0, *map(len, parts)])
        if len(data) > len(codes):  # from characters to bytes
            width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
            place = np.concatenate([[0], np.cumsum(width)])
            starts, ends, edges = place[starts], place[ends], place[edges]
        del codes
        # The words' bytes, each word with its END.
        lengths = ends - starts
        opens = np.cumsum(lengths + 1) - lengths - 1
        symbols = np.full(int((lengths + 1).sum()), END, np.int64)
        inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        symbols[np.repeat(opens, lengths) + inside] = data[np.repeat(starts, lengths) + inside]
        sums = np.concatenate([[0], np.cumsum(self.words.read(symbols, opens), dtype=np.int64)])
        at = np.append(opens, len(symbols))[np.searchsorted(starts, edges)]
        return np.diff(sums[at])


@lru_cache(2)
def load(path: str) -> Counter:
    return Counter(path)


@tidy
def count_batches(path: str, limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter = load(path)
    for batch in batches:
        texts = [t or "" for t in batch[1].to_pylist()]
        n = counter.count(texts)
        sizes = [len(t.encode()) for t in texts]
        yield pa.RecordBatch.from_arrays([batch[0], pa.array(sizes, pa.int64()), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])


def count_tokens(docs: DataFrame, tokenizer: str, *, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) for each row.

    The counts are those of the vocabulary's own library without added special
    tokens; null text counts as empty (0 tokens). Rows are independent, so
    repeated rows, null identifiers and further columns need no care. tokenizer
    is a path that every executor has.
    """
    return docs.select(id_col, text_col).mapInArrow(lambda b: count_batches(tokenizer, limit, b), f"{id_col} long, n_bytes long, n_tokens long, over_limit boolean")
