import hashlib
import random

import corpus
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lattica.llm import byte_bpe, queries, token_counts

tokenizers = pytest.importorskip("tokenizers")
FRAGMENTS = ["'s", "'re", "'r", "'v", "'ll", "'l", "don't", "'", "''", "!'", "é", "é", "Σ", "ΑΣ ", "İ", "<|endoftext|>", "<|startoftext|>", "<|", " ", "\x1c", "\x85", "　", "  ", "\n", "\t\n ", "123", "²", "日本語", "😀", "a" * 30, "THE", "_", "​", "ß", "x" * 300, "====", "'T", "re"]


def samples():
    rng = random.Random(0)
    mixed = ["".join(rng.choice(FRAGMENTS) for _ in range(rng.randint(0, 12))) for _ in range(800)]
    return mixed + [t or "" for _, t, *_ in corpus.rows()]


@pytest.fixture(scope="module")
def words():
    path = queries.vocabulary("word_bpe_49k.json")
    return token_counts.load(path), tokenizers.Tokenizer.from_file(path)


@pytest.fixture(scope="module")
def bytes_():
    path = queries.vocabulary("byte_bpe_50k.json")
    return byte_bpe.load(path), tokenizers.Tokenizer.from_file(path)


def test_counts(words):
    own, library = words
    texts = samples()
    assert own.count(texts).tolist() == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=8))
def test_counts_of_any_text(words, texts):
    own, library = words
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert own.count(texts).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_counts_of_every_character(words):
    """Also of those that Python's character tables do not know."""
    own, library = words
    texts = [f"a{chr(c)}{chr(c)}b {chr(c)}\u0301 e\u0323{chr(c)}\u0301" for c in range(0x40000) if not 0xD800 <= c < 0xE000]
    assert own.count(texts).tolist() == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_long_words_and_texts(words, monkeypatch):
    own, library = words
    texts = ["ab" * 3000 + " c " + "é" * 2500, "x" * 9000, "don't " * 4000 + "<|endoftext|>y", "word " * 9 + "z" * 2100]
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert own.count(texts).tolist() == want
    monkeypatch.setattr(token_counts, "BLOCK", 1000)
    assert own.count(texts).tolist() == want


def test_chunks_compose(words, monkeypatch):
    own, _ = words
    texts = samples()
    whole = own.count(texts).tolist()
    for lanes, block in ((1, 1 << 20), (7, 64), (4096, 50_000), (40, 3_000)):
        monkeypatch.setattr(token_counts, "LANES", lanes)
        monkeypatch.setattr(token_counts, "BLOCK", block)
        assert own.count(texts).tolist() == whole


def test_bounded_memory_tables(words, monkeypatch):
    own, _ = words
    texts = samples()
    whole = own.count(texts).tolist()
    monkeypatch.setattr(token_counts, "MAX_STATES", 3)
    monkeypatch.setattr(token_counts, "MEMO_PAIRS", 3)
    assert own.count(texts[:200]).tolist() == whole[:200]


def test_encode_decode(bytes_):
    own, library = bytes_
    for text, e in zip(texts := samples(), library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert own.encode(text) == e.ids
        assert own.decode(e.ids) == library.decode(e.ids, skip_special_tokens=False) == text


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60), st.lists(st.integers(0, 50256), max_size=12))
def test_round_trip_of_anything(bytes_, text, ids):
    own, library = bytes_
    text = text.encode("utf-8", "ignore").decode()
    assert own.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_long_texts_in_pieces(bytes_, monkeypatch):
    own, library = bytes_
    monkeypatch.setattr(byte_bpe, "PIECE", 50)
    text = " ".join(samples())
    assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_queries(spark, tmp_path, words, bytes_):
    data = corpus.rows()
    d = corpus.parquet(spark, data, tmp_path)
    got = sorted(map(str, map(tuple, queries.op2_token_counts(spark, d).collect())))
    want = []
    for i, t, *_ in data:
        n = len(words[1].encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 2048))
    assert got == sorted(map(str, want))
    hex_ = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for i, t, *_ in data:
        ids = bytes_[1].encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hex_(",".join(map(str, ids))), hex_(bytes_[1].decode(ids, skip_special_tokens=False))))
    assert sorted(map(str, map(tuple, queries.op5_byte_bpe(spark, d).collect()))) == sorted(map(str, want))
    empty = corpus.parquet(spark, [], tmp_path / "empty")
    assert queries.op2_token_counts(spark, empty).count() == queries.op5_byte_bpe(spark, empty).count() == 0


def test_small_memory_of_words(bytes_, monkeypatch):
    own, library = bytes_
    monkeypatch.setattr(byte_bpe, "MEMO_WORDS", 3)
    own.memo.clear()
    for text in samples()[:200]:
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert len(own.memo) <= 3 and len(own.memo.old) <= 3


def test_encode_and_decode_frames(spark, bytes_):
    path = queries.vocabulary("byte_bpe_50k.json")
    data = corpus.rows()
    ids = byte_bpe.encode(corpus.frame(spark, data), path)
    back = byte_bpe.decode(ids, path).collect()
    assert sorted(map(str, map(tuple, back))) == sorted(str((i, t or "")) for i, t, *_ in data)
