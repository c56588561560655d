import math
import random
import zlib
from collections import Counter

import corpus
import numpy as np
from pyspark.sql import functions as F

from lattica.llm import ann, language_id, lm_score, queries


def crc(i):
    return zlib.crc32(("" if i is None else str(i)).encode())


def labelled(n=240, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(corpus.WORDS))
        out.append((1000 + i, corpus.prose(rng, lang, 60), lang, "a"))
    return out


def test_language(spark, tmp_path):
    data = labelled() + corpus.rows(8)[-11:]
    got = queries.op8_language_id(spark, corpus.parquet(spark, data, tmp_path)).collect()
    assert len(got) == len(data)
    lang = {i: x for i, _, x, _ in labelled()}
    held = [r for r in got if r["held_out"] and r["doc_id"] in lang]
    assert len(held) > 20 and np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95
    text = {i: t for i, t, *_ in data}
    for r in got:
        assert r["held_out"] == (crc(r["doc_id"]) % 5 == 0) and 0 <= r["score"] <= 1
        t = text[r["doc_id"]] if r["doc_id"] is not None else "x"
        if not t or not any(c.isalpha() for c in t):
            assert r["lang_pred"] == "und"
    empty = queries.op8_language_id(spark, corpus.parquet(spark, [], tmp_path / "empty"))
    assert empty.count() == 0
    none = queries.op8_language_id(spark, corpus.parquet(spark, [(1, "some words", None, "a")], tmp_path / "none")).first()
    assert none["lang_pred"] == "und" and none["score"] == 0.0


def plain_lengths(training, text):
    """Code length of a text for each language, from counts in dictionaries and the rule as it is stated."""
    out = {}
    for lang in sorted(training):
        seen = {}
        for t in training[lang]:
            padded = b"\n" * 3 + t
            for k in range(3, len(padded)):
                for order in range(4):
                    follow = seen.setdefault(padded[k - order : k], Counter())
                    follow[padded[k]] += 1

        def length(context, byte, seen=seen):
            if context in seen:
                follow = seen[context]
                total = sum(follow.values()) + len(follow)
                if byte in follow:
                    return round(-math.log2(follow[byte] / total) * 4096)
                rest = length(context[1:], byte) if context else 8 * 4096
                return round(-math.log2(len(follow) / total) * 4096) + rest
            return length(context[1:], byte)

        padded = b"\n" * 3 + text
        out[lang] = sum(length(padded[k - 3 : k], padded[k]) for k in range(3, len(padded)))
    return out


def grams(texts):
    parts = [k for k, _ in language_id.grams_of(texts)]
    return np.unique(np.concatenate(parts), return_counts=True)


def test_code_lengths(monkeypatch):
    """The trees against plain counting, in blocks of any size and with a full memory."""
    training = {"en": [b"the cat and the hat and the bat", b"then there"], "fr": ["le chat et le été".encode(), b"x"]}
    probe = [b"", b"the", "été xyz".encode(), bytes(range(256)), b"the the the cat" * 20, b"q"]
    want = [[*plain_lengths(training, t).values()] for t in probe]
    model = lambda: language_id.train([(k, *grams(v)) for k, v in sorted(training.items())])
    assert model().lengths(probe).tolist() == want
    monkeypatch.setattr(language_id, "BLOCK", 5)
    assert model().lengths(probe).tolist() == want
    monkeypatch.setattr(language_id, "MEMO", 10)
    assert model().lengths(probe * 2).tolist() == want * 2
    # Code lengths never promise more than there is: what a context codes for sums to one at most.
    for tree in model().trees:
        for context in (0, 0x746865, 0x0A0A0A, 0xFFFFFF):
            assert np.exp2(-tree.code(np.arange(256) + (context << 8)) / language_id.UNIT).sum() < 1.01


def test_language_query_by_hand(spark, tmp_path):
    """The registered query against the plain rule: all labelled rows out of the fold train, long ones too, where they are few."""
    rng = random.Random(3)
    data = [(i, corpus.prose(rng, lang, 30 if i % 7 else 2500), lang, "a") for i in range(70) for lang in [rng.choice(["en", "fr", "de"])]]
    training = {}
    for i, t, lang, _ in data:
        if crc(i) % 5:
            training.setdefault(lang, []).append(t.encode())
    for r in queries.op8_language_id(spark, corpus.parquet(spark, data, tmp_path)).collect():
        text = data[r["doc_id"]][1]
        if len(text) < 1000:
            lengths = plain_lengths(training, text.encode())
            best = min(lengths, key=lambda k: (lengths[k], k))
            assert r["lang_pred"] == best
            assert abs(r["score"] - 1 / sum(2 ** max(-1000, (lengths[best] - x) / 4096) for x in lengths.values())) < 1e-9


def test_lm(spark, tmp_path):
    data = corpus.rows(9, 80)
    rows = queries.op9_lm_score(spark, corpus.parquet(spark, data, tmp_path)).collect()
    counts, docs = Counter(), 0
    for i, t, *_ in data:
        if crc(i) % 7 != 2:
            counts.update(corpus.words(t))
            docs += 1
    n, v = sum(counts.values()) + docs, len(counts) + 1
    want = []
    for i, t, *_ in data:
        w = corpus.words(t)
        base = sum(math.log10((c + 1) / (n + v + 1)) for c in [*(counts[x] for x in w), docs])
        want.append((str(i), crc(i) % 7 == 2, len(w) + 1, sum(counts[x] > 0 for x in w) + 1, n, round(base, 6)))
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows) == sorted(want)
    assert all(r["score"] < 0 for r in rows)
    assert queries.op9_lm_score(spark, corpus.parquet(spark, [], tmp_path / "empty")).count() == 0


def test_lm_score_by_hand(spark, tmp_path, monkeypatch):
    """The model's score of every text, token by token in plain Python: softmax over classes, then the word's share of its class."""
    data = corpus.rows(9, 50)
    learned = []
    learn = lm_score.learn
    monkeypatch.setattr(lm_score, "learn", lambda *a: learned.append(learn(*a)) or learned[-1])
    monkeypatch.setattr(lm_score, "TOP_WORDS", 60)
    rows = queries.op9_lm_score(spark, corpus.parquet(spark, data, tmp_path)).collect()
    model, counts = learned[0], Counter()
    for i, t, *_ in data:
        if crc(i) % 7 != 2:
            counts.update(corpus.words(t))
    assert {w: counts[w] for w in model.words} == {w: int(model.counts[k]) for w, k in model.words.items()} and 0 < len(model.words) < len(counts)
    class_of = lambda w: int(model.classes[model.words[w]]) if w in model.words else lm_score.RARE
    mass = Counter()
    for w, c in counts.items():
        mass[class_of(w)] += c + 1
    mass[lm_score.RARE] += 1  # one unknown word

    def score(words):
        total, before = 0.0, [lm_score.END] * lm_score.CONTEXT
        for w in [*words, None]:
            c = lm_score.END if w is None else class_of(w)
            h = sum(model.C[k] * model.R[before[-1 - k]] for k in range(lm_score.CONTEXT))
            logits = [float(q @ h + b) for q, b in zip(model.Q, model.b, strict=True)]
            total += (logits[c] - math.log(sum(math.exp(x) for x in logits))) / math.log(10)
            total += 0.0 if w is None else math.log10((counts[w] + 1) / mass[c])
            before.append(c)
        return total

    got = sorted((str(r["doc_id"]), r["n_tokens"], r["score"]) for r in rows)
    want = sorted((str(i), len(corpus.words(t)) + 1, score(corpus.words(t))) for i, t, *_ in data if len(corpus.words(t)) < 500)
    got = [g for g in got if g[1] <= 500]
    assert len(got) == len(want)
    assert all(a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-3 * max(1, abs(b[2])) for a, b in zip(got, want, strict=True))


def test_lm_rare_words_join(spark, tmp_path, monkeypatch):
    """With few words sent to the executors the counts of the others come by the join: the base score stays the same."""
    d = corpus.parquet(spark, corpus.rows(9, 40), tmp_path)
    key = lambda r: (str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6))
    whole = sorted(map(key, queries.op9_lm_score(spark, d).collect()))
    monkeypatch.setattr(lm_score, "TOP_WORDS", 5)
    assert sorted(map(key, queries.op9_lm_score(spark, d).collect())) == whole


def test_lm_is_normalised():
    rng = random.Random(0)
    sample = [corpus.prose(rng, "en", 50).encode() for _ in range(30)]
    counts = Counter(w for t in sample for w in lm_score.words_of(t)).most_common(60)
    model = lm_score.train(sample, [w for w, _ in counts], [c for _, c in counts], steps=200)
    n = len(model.b)
    context = np.array([5, 3, 9, 2])
    probs = []
    for c in range(n):
        tokens = np.concatenate([context, [c]])
        probs.append(10 ** model.log_probs(tokens, np.array([True, False, False, False, False]))[-1])
    assert abs(sum(probs) - 1) < 1e-5
    trained = model.log_probs(np.concatenate([model.classes[[model.words[w] for w in lm_score.words_of(t) if w in model.words]] for t in sample]), np.zeros(1, bool).repeat(sum(w in model.words for t in sample for w in lm_score.words_of(t))))
    assert trained.mean() > -np.log10(n)


def test_lm_runs(monkeypatch):
    """Texts cut into runs give the same tokens, contexts and company as in one run."""
    rng = random.Random(4)
    texts = [corpus.prose(rng, rng.choice(list(corpus.WORDS)), n).encode() for n in (1, 700, 3, 0, 40, 2, 90)]
    place = {w: i for i, (w, _) in enumerate(Counter(w for t in texts for w in lm_score.words_of(t)).most_common(150))}
    (whole, _), classes = next(lm_score.runs_of(texts, place)), np.arange(150) % 100 + 2
    assert len(whole) == sum(len(t.split()) + 1 for t in texts)
    monkeypatch.setattr(lm_score, "RUN", 50)
    runs = list(lm_score.runs_of(texts, place))
    assert len(runs) > 10 and np.concatenate([ids[lead:] for ids, lead in runs]).tolist() == whole.tolist()
    ctx = [lm_score.contexts(lm_score.class_tokens(ids, classes), ids)[:, lead:] for ids, lead in runs]
    assert np.concatenate(ctx, axis=1).tolist() == lm_score.contexts(lm_score.class_tokens(whole, classes), whole).tolist()
    near, once = np.zeros((2, 150, 96), np.int64)
    lm_score.company(whole, 0, once)
    for ids, lead in runs:
        lm_score.company(ids, lead, near)
    assert once.sum() > 100 and (near == once).all()


def test_lm_learns_from_all_rows(spark, tmp_path, monkeypatch):
    """Words that only stand in texts of over 20,000 bytes, or in few of many documents, have learned contexts."""
    rng = random.Random(5)
    common, thin = ([f"{k}{i}" for i in range(120)] for k in ("w", "thin"))

    def text(words, n):  # each word is followed by the next one
        at = rng.randrange(len(words))
        return " ".join(words[(at + i) % len(words)] for i in range(n))

    data = [(i, text(common, 12), "en", "a") for i in range(2400)] + [(5000 + i, text(thin, 4000), "en", "b") for i in range(7)]
    monkeypatch.setattr(lm_score, "START", 1)
    monkeypatch.setattr(lm_score, "RUN", 2000)
    got = {r["doc_id"]: r for r in queries.op9_lm_score(spark, corpus.parquet(spark, data, tmp_path)).collect()}
    assert len(got) == len(data)
    long_ones = [got[5000 + i] for i in range(7)]
    assert all(r["score"] > 0.9 * r["base_score"] for r in long_ones), [(r["score"] / r["n_tokens"], r["base_score"] / r["n_tokens"]) for r in long_ones]


VECTORS = "vec_id long, embedding array<float>, label int, id long, dim int, shard int"


def brute(rows, every, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            v = [float(np.float32(x)) for x in v]
            if i not in good or tuple(v) < tuple(good[i]):
                good[i] = v
    out = {}
    for q, x in good.items():
        if q % every == 0:
            near = sorted((-float(np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y)), i) for i, y in good.items() if i != q and len(y) == len(x))
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def test_nearest(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD", 150)
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[7][1]) for i in range(30)]  # ties
    rows += [(5000, None), (5050, [0.0] * 16), (5100, [1.0, None] * 8), (5150, [float("nan")] * 16), (5200, [float("inf")] * 16), (None, rows[1][1]), (5250, []), rows[50], rows[50], (5300, [1.0, 2.0]), (5301, [2.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], VECTORS).repartition(3)
    got = {}
    for r in ann.nearest(df).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute(rows, 50, 5)
    assert set(got) == set(want)
    hits = total = 0
    for q, near in want.items():
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, len(mine) + 1)) and len(mine) == len(near)
        assert [(round(-s, 9), i) for _, i, s in mine] == sorted((round(-s, 9), i) for _, i, s in mine)
        hits += len({i for _, i, _ in mine} & {i for i, _ in near})
        total += len(near)
    assert hits / total >= 0.95
    assert ann.nearest(df.limit(0)).count() == 0


def test_nearest_query(spark, tmp_path):
    """The registered query with production parameters: recall against brute force, and exact scores."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(10, 64))
    rows = [(i, (rng.normal(size=64) + 0.5 * centres[i % 10]).tolist()) for i in range(3000)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    want = {q: dict(near) for q, near in brute(rows, 50, 5).items()}
    got = queries.op4_nearest(spark, str(tmp_path)).collect()
    assert len(got) == 5 * len(want) == 300
    assert sum(r["vec_id"] in want[r["query_id"]] for r in got) >= 0.9 * len(got)
    assert all(abs(want[r["query_id"]].get(r["vec_id"], r["score"]) - r["score"]) < 1e-12 for r in got)


def test_all_copies(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0], 1, 2, 3, 4) for i in range(60)], VECTORS)
    got = ann.nearest(df).where(F.col("query_id") == 50).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [0, 1, 2, 3, 4]
