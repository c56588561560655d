import hashlib
import random
from collections import Counter, defaultdict

import corpus
import numpy as np
import pytest

from lattica.llm import exact_dedup, near_dedup, queries, span_dedup
from lattica.llm.components import components
from lattica.llm.suffix_sort import common_prefix, deep_shallow_sort


def lower(text):
    return (text or "").encode().lower()


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact(spark, keep):
    data = corpus.rows()
    got = exact_dedup.group_texts(corpus.frame(spark, data), keep=keep).collect()
    groups = defaultdict(list)
    for i, t, *_ in data:
        groups[lower(t)].append(i)
    pick = min if keep == "smallest" else max
    want = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        best, first = (pick(known) if known else None), True
        for i in sorted(ids, key=str):
            want.append((i, best, len(ids), i == best and first, hashlib.sha256(t).hexdigest()))
            first = first and i != best
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_exact_empty_and_options(spark):
    assert exact_dedup.group_texts(corpus.frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        exact_dedup.group_texts(corpus.frame(spark, []), keep="any")


def test_drop_copies(spark):
    data = corpus.rows(1)
    docs = corpus.frame(spark, data)
    kept = exact_dedup.drop_copies(docs, keep="largest")
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert Counter(lower(r["text"]) for r in rows) == Counter({lower(t) for _, t, *_ in data})
    best = {}
    for i, t, *_ in data:
        best[lower(t)] = max(best.get(lower(t), -1), -1 if i is None else i)
    assert all((-1 if r["doc_id"] is None else r["doc_id"]) == best[lower(r["text"])] for r in rows)
    assert exact_dedup.drop_copies(corpus.frame(spark, [])).count() == 0


def components_of(data, width, percent):
    def grams(t):
        w = corpus.words(t)
        return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])

    sets = [grams(t) for _, t, *_ in data]
    comp = list(range(len(data)))

    def top(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in range(len(data)):
        for b in range(a):
            both, all_ = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * all_:
                comp[top(a)] = top(b)
    least = {}
    for k, (i, *_) in enumerate(data):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return [(i, len(sets[k]), i if not sets[k] else least.get(top(k)), i == (i if not sets[k] else least.get(top(k)))) for k, (i, *_) in enumerate(data)]


def near_copies(seed=3):
    """A chain in which neighbours are linked but the ends are not, and unlinked texts around one passage."""
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 500)}" for _ in range(120)]
    out = []
    for k in range(14):
        base = list(base)
        base[(k * 8) % 120] = f"n{k}"
        out.append((1000 + 13 * k % 14, " ".join(base), "en", "a"))
    passage = [f"p{i}" for i in range(60)]
    for k in range(25):
        out.append((2000 + k, " ".join(passage + [f"u{k}_{i}" for i in range(25)]), "en", "a"))
    return out


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
@pytest.mark.parametrize("held", [1000, 2])
def test_near(spark, width, percent, held, monkeypatch):
    monkeypatch.setattr(near_dedup, "HELD", held)
    data = corpus.rows(2) + near_copies()
    got = near_dedup.near_duplicates(corpus.frame(spark, data), percent=percent, width=width).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, components_of(data, width, percent)))


def test_near_edges(spark):
    assert near_dedup.near_duplicates(corpus.frame(spark, [])).count() == 0
    only = [(1, None, None, None), (2, "", None, None), (2, "", None, None)]
    assert sorted(map(tuple, near_dedup.near_duplicates(corpus.frame(spark, only)).collect())) == [(1, 0, 1, True), (2, 0, 2, True), (2, 0, 2, True)]
    docs = corpus.frame(spark, near_copies())
    kept = near_dedup.drop_near_copies(docs)
    want = {i for i, _, _, k in components_of(near_copies(), 5, 80) if k}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == want


def test_near_copies_go_by_row(spark):
    """Rows that share an identifier, or have none, stay or go each by its own text."""
    a, b, c = (" ".join(f"{k}{i}" for i in range(40)) for k in "abc")
    data = [(1, a, None, None), (2, a + " end", None, None), (2, b, None, None), (None, a, None, None), (None, c, None, None), (3, c + " end", None, None), (None, "", None, None)]
    kept = near_dedup.drop_near_copies(corpus.frame(spark, data)).select("doc_id", "text").collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [(1, a), (2, b), (3, c + " end"), (None, "")]))


def test_signature():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 2**63, 1000, dtype=np.uint64), rng.integers(0, 2**63, 400, dtype=np.uint64)
    x, y = near_dedup.signature(a, 2000), near_dedup.signature(np.concatenate([a[200:], b]), 2000)
    assert abs((x == y).mean() - 800 / 1400) < 0.05
    for percent in (80, 85):
        bands, rows = near_dedup.banding(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= near_dedup.MISS


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(40)]
    comp = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            comp[a] = comp[b] = min(comp[a], comp[b])
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: comp[x] for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("shallow", [0, 2, 24])
def test_suffix_sort(shallow):
    rng = random.Random(shallow)
    for _ in range(150):
        pool = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 40))) for _ in range(5)]
        strings = [rng.choice(pool)[: rng.randint(0, 40)] + bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(1, 60))]
        order, shared = deep_shallow_sort(strings, shallow)
        assert [strings[i] for i in order] == sorted(strings)
        assert shared == [0, *(common_prefix(strings[x], strings[y]) for x, y in zip(order, order[1:], strict=False))]


def spans_of(data, window=400):
    seen = Counter()
    texts = [(t or "").encode() for _, t, *_ in data]
    for b in texts:
        seen.update(b[s : s + window] for s in range(len(b) - window + 1))
    out = []
    for (i, *_), b in zip(data, texts, strict=True):
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - window + 1):
            if seen[b[s : s + window]] > 1:
                gone[s : s + window] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def repeats(seed=0):
    rng = random.Random(seed)
    some = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passages = [some(n) for n in (380, 399, 410, 500, 900)]
    out = [(i, some(rng.randint(0, 300)) + rng.choice(passages)[rng.randint(0, 20) :] + some(rng.randint(0, 300)) + rng.choice(["", rng.choice(passages)]), "en", "a") for i in range(40)]
    return out + [(90, "x" * 1500, "en", "a"), (91, "ab" * 300, "en", "a"), (92, some(30) * 20, "en", "a"), (93, "q" * 400, "en", "a"), (94, "z" * 401, "en", "a")]


@pytest.mark.parametrize("bucket", [512, 6, 1])
def test_spans(spark, bucket, monkeypatch):
    monkeypatch.setattr(span_dedup, "BUCKET", bucket)
    data = corpus.rows(4) + repeats()
    docs = corpus.frame(spark, data)
    got = span_dedup.remove_repeats(docs).collect()
    want = sorted(map(str, spans_of(data)))
    assert sorted(map(str, map(tuple, got))) == want
    texts = span_dedup.remove_repeats(docs, texts=True).collect() if bucket == 512 else []
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in texts) and len(texts) in (0, len(data))


def test_spans_in_parts(spark, monkeypatch):
    monkeypatch.setattr(span_dedup, "BLOCK", 700)
    data = repeats(1) + corpus.rows(6)[:20]
    assert sorted(map(str, map(tuple, span_dedup.remove_repeats(corpus.frame(spark, data)).collect()))) == sorted(map(str, spans_of(data)))
    assert span_dedup.remove_repeats(corpus.frame(spark, [])).count() == 0


def test_queries(spark, tmp_path):
    data = [r for r in corpus.rows(7) if r[0] is not None]
    d = corpus.parquet(spark, data, tmp_path)
    assert sorted(map(str, map(tuple, queries.op7_near_dedup(spark, d).collect()))) == sorted(map(str, components_of(data, 3, 85)))
    assert sorted(map(str, map(tuple, queries.op3_span_dedup(spark, d).collect()))) == sorted(map(str, spans_of(data)))
