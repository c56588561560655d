import hashlib
import math
from collections import Counter, defaultdict

import corpus
import duckdb
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from lattica.llm import mixing, queries, sharding
from test_dedup import components_of


def duck(spark, d, sql):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{d}/documents.parquet/*.parquet'")
    cur = con.execute(sql)
    return [x[0] for x in cur.description], cur.fetchall()


def same(df, names, rows):
    cols = sorted(df.columns)
    assert sorted(names) == cols
    assert sorted(str(tuple(r[c] for c in cols)) for r in df.collect()) == sorted(str(tuple(r[names.index(c)] for c in cols)) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, tmp_path, name):
    data = [r for r in dict.fromkeys(corpus.rows(10)) if r[0] is not None]
    d = corpus.parquet(spark, data, tmp_path)
    same(queries.queries()[name](spark, d), *duck(spark, d, queries.oracle_sql()[name]))


def test_mixing_by_hand(spark):
    data = corpus.rows(11, 200)
    got = mixing.allot(corpus.frame(spark, data)).collect()
    assert len(got) == len(data)
    size = defaultdict(int)
    for i, t, _, s in data:
        size[s] += len(corpus.words(t))
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    budget, target = 1.5 * sum(size.values()), {}
    while len(target) < len(size):  # cut the sources above their cap, share the rest again
        free = [s for s in size if s not in target]
        left, total = budget - sum(target.values()), sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 2 * size[s]]
        for s in over or free:
            target[s] = 2.0 * size[s] if over else left * weight[s] / total
    taken, targets = defaultdict(int), {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        targets[r["source_size"]] = r["target"]
        taken[r["source_size"]] += r["taken"]
    for s in size:
        assert targets[size[s]] == pytest.approx(target[s]) and abs(taken[size[s]] - target[s]) <= 1 + 2 * target[s] / mixing.PACKETS
    assert abs(sum(taken.values()) - budget) <= 1
    again = mixing.allot(corpus.frame(spark, data, parts=5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixing_edges(spark):
    assert mixing.allot(corpus.frame(spark, [])).count() == 0
    blank = mixing.allot(corpus.frame(spark, [(1, None, None, "a"), (2, " ", None, None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in blank] == [(0, 0.0, 0)] * 2
    one = mixing.allot(corpus.frame(spark, [(1, "a b c d", None, "a")])).first()
    assert (one["target"], one["taken"]) == (6.0, 6)


def test_schedule_is_fair(spark):
    """At any moment of the schedule each source has sent its share of its target."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sent = mixing.schedule(mixing.queue(corpus.frame(spark, corpus.rows(12, 200)))).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sent.sort(key=lambda r: r["before"])
    times = [r["finish"] for r in sent if r["finish"] is not None and r["words"]]
    assert times == sorted(times) and len({r["part"] for r in sent}) > 1
    passed, cut = 0, 0
    for r in sent:
        assert r["before"] == passed and r["sent"] == max(0, min(r["words"], math.floor(r["budget"] + 0.5) - passed))
        passed += r["words"]
        cut += 0 < r["sent"] < r["words"]
    assert cut <= 1 < sum(r["sent"] == 0 for r in sent if r["words"])


def test_mixing_nulls_and_order(spark):
    """Rows without identifier are spread, a long document is cut to its source's share, and the order is that of finish times."""
    data = [(None, "w " * (i % 7 + 1), "en", "a") for i in range(300)] + [(i, "w " * 5, "en", "b") for i in range(30)] + [(99, "w " * 5000, "en", "c")]
    docs = corpus.frame(spark, data)
    got = mixing.allot(docs).collect()
    assert len(got) == len(data)
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r["source_size"]] += r["taken"]
        target[r["source_size"]] = r["target"]
    assert all(abs(taken[s] - t) <= 2 + 2 * t / mixing.PACKETS for s, t in target.items())
    assert mixing.mix(docs).columns == docs.columns and mixing.mix(corpus.frame(spark, [])).count() == 0


def test_mix_rows(spark):
    docs = corpus.frame(spark, [(i, "w " * (i % 5 + 1), "en", "ab"[i % 2]) for i in range(200)])
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    rows = out.groupBy("doc_id").count().collect()
    assert max(r["count"] for r in rows) <= 2
    words = out.select(F.sum(F.size(F.split(F.trim("text"), " ")))).first()[0]
    assert abs(words - 1.5 * 600) <= 10


def test_shards(spark):
    data = corpus.rows(13, 150)
    got = sharding.assign_shards(corpus.frame(spark, data), limit=9_000).collect()
    assert len(got) == len(data)
    shards = defaultdict(list)
    for r in got:
        shards[r["shard"], r["part"]].append(r)
        bits = format(int(hashlib.sha256(("" if r["doc_id"] is None else str(r["doc_id"])).encode()).hexdigest()[:15], 16), "060b")
        assert bits.startswith(r["shard"]) and len(r["shard"]) == r["depth"]
    for rows in shards.values():
        total = sum(r["n_bytes"] for r in rows)
        assert total <= 9_000 or len(rows) == 1
        assert all(r["shard_bytes"] == total and r["shard_docs"] == len(rows) for r in rows)
    assert sum(r["n_bytes"] for r in got) == sum(len((t or "").encode()) for _, t, *_ in data)
    for shard, _ in shards:  # no bucket was split that would have fitted
        if shard:
            assert sum(r["n_bytes"] for r in got if r["shard"].startswith(shard[:-1])) > 9_000


@pytest.mark.parametrize("bits", [0, 2])
def test_shards_deep(spark, monkeypatch, bits):
    """Cells too large for a shard are counted again with more bits."""
    monkeypatch.setattr(sharding, "SPARE_BITS", bits)
    data = [(i, "x" * (i % 50), None, None) for i in range(400)] + [(7, "z" * 90, None, None)] * 4
    got = sharding.assign_shards(corpus.frame(spark, data), limit=100).collect()
    shards = defaultdict(list)
    for r in got:
        shards[r["shard"], r["part"]].append(r["n_bytes"])
    assert len(got) == len(data) and all(sum(x) <= 100 for x in shards.values())
    for shard, _ in shards:
        assert not shard or sum(r["n_bytes"] for r in got if r["shard"].startswith(shard[:-1])) > 100


def test_write_shards_with_clashing_names(spark, tmp_path):
    docs = corpus.frame(spark, [(i, "abc " * i, "en", "a") for i in range(30)]).withColumnRenamed("lang", "shard").withColumnRenamed("t", "Part").withColumnRenamed("source", "f")
    assert sharding.write_shards(docs, str(tmp_path / "out"), limit=300).count() == 30
    back = spark.read.option("basePath", str(tmp_path / "out")).parquet(str(tmp_path / "out"))
    assert sorted((r["row"]["doc_id"], r["row"]["shard"], r["row"]["Part"]) for r in back.collect()) == [(i, "en", "x") for i in range(30)]


def test_shards_of_one_key(spark):
    data = [(7, "x" * n, None, None) for n in (10, 20, 30, 40, 50, 60, 200, 0)] + [(8, "y" * 5, None, None)]
    got = sharding.assign_shards(corpus.frame(spark, data), limit=100).collect()
    parts = defaultdict(list)
    for r in got:
        parts[r["shard"], r["part"]].append(r["n_bytes"])
    assert len(got) == len(data) and all(sum(p) <= 100 or len(p) == 1 for p in parts.values())
    assert sharding.assign_shards(corpus.frame(spark, []), limit=10).count() == 0
    with pytest.raises(ValueError):
        sharding.assign_shards(corpus.frame(spark, []), limit=0)


def test_write_shards(spark, tmp_path):
    data = [r for r in corpus.rows(14) if r[0] is not None]
    docs = corpus.frame(spark, data)
    sharding.write_shards(docs, str(tmp_path / "out"), limit=9_000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(data)


def test_pipeline_stages(spark, tmp_path):
    data = corpus.rows(15, 120)
    d = corpus.parquet(spark, data, tmp_path)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    seen = {}
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, d)
        out.write.parquet(f"{tmp_path}/{name}")
        docs, before = spark.read.parquet(f"{tmp_path}/{name}"), docs
        seen[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
    letters = [r["text"] for r in seen["language_id"].collect()]
    assert len(letters) == sum(any(map(str.isalpha, t or "")) for _, t, *_ in data)
    lowered = [t.encode().lower() for t in (r["text"] for r in seen["exact_dedup"].collect())]
    assert len(lowered) == len(set(lowered)) and set(lowered) == {t.encode().lower() for t in letters}
    # Near copies: of each component of brute-force links the rows of the least identifier stay.
    rows = lambda name: [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in seen[name].collect()]
    before = rows("exact_dedup")
    kept = [r for r, (_, _, _, stays) in zip(before, components_of(before, 5, 80), strict=True) if stays]
    assert sorted(map(str, rows("near_dedup"))) == sorted(map(str, kept))
    # Mix: whole documents, each twice at most, every source near its target.
    after, size = Counter(map(str, rows("mix_sources"))), defaultdict(int)
    assert after <= Counter({k: 2 * n for k, n in Counter(map(str, kept)).items()})
    for _, t, _, s in kept:
        size[s] += len(corpus.words(t))
    targets = {r["source_size"]: r["target"] for r in mixing.allot(seen["near_dedup"]).collect()}
    longest = max(len(corpus.words(t)) for _, t, _, _ in kept)
    for s, n in size.items():
        got = sum(len(corpus.words(t)) for _, t, _, x in rows("mix_sources") if x == s)
        assert abs(got - targets[n]) <= longest
    # Tokens: those of the library, and back.
    library = tokenizers.Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))
    want = []
    for i, t, lang, s in rows("mix_sources"):
        ids = library.encode(t, add_special_tokens=False).ids
        want.append((i, lang, s, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest(), ids))
    assert sorted(map(str, map(tuple, seen["byte_bpe"].collect()))) == sorted(map(str, want))
    assert sorted(map(str, map(tuple, corpus_pipeline.run(spark, d).collect()))) == sorted(map(str, want))


def test_write_repeated_ids(spark, tmp_path):
    """Rows of one key that are chained into parts are written once each, and no part exceeds the limit."""
    data = [(7, f"{i:03d} " * 10, None, "a") for i in range(30)] + [(None, "x" * 30, None, "a")] * 5 + [(i, "y" * 20, None, "b") for i in range(20, 30)]
    shards = sharding.write_shards(corpus.frame(spark, data), str(tmp_path / "out"), limit=100)
    assert shards.columns == ["doc_id", "n_bytes", "shard", "depth", "part", "shard_bytes", "shard_docs"]
    back = spark.read.option("basePath", str(tmp_path / "out")).parquet(str(tmp_path / "out"))
    assert sorted(str((r["doc_id"], r["text"])) for r in back.collect()) == sorted(str((i, t)) for i, t, *_ in data)
    assert all(r["b"] <= 100 for r in back.groupBy("shard", "part").agg(F.sum(F.octet_length("text")).alias("b")).collect())


def test_language_stage_without_languages(spark, tmp_path):
    """Where no language can be learned only null and letterless texts go."""
    step = dict(corpus_pipeline.STAGES)["language_id"]
    rows = [(1, "some words", None, "a"), (2, "12 - 34", None, "a"), (3, None, None, "a"), (4, "", None, "b"), (None, "été", None, None), (5, "long " * 5000, None, "b")]
    for lang in (None, "en"):  # "en": there is one labelled text, a long one
        docs = corpus.frame(spark, [(i, t, lang if i == 5 else x, s) for i, t, x, s in rows])
        assert sorted(str(r["doc_id"]) for r in step(spark, docs, str(tmp_path)).collect()) == ["1", "5", "None"]
    assert step(spark, docs, str(tmp_path)).columns == docs.columns


def test_pipeline_of_nothing(spark, tmp_path):
    d = corpus.parquet(spark, [], tmp_path)
    assert corpus_pipeline.run(spark, d).count() == 0
