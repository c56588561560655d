import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lattica import schema
from lattica.operators import joins, registry, reshape, select, trials
from lattica.plans import audit, longform
from lattica.sources import sinks


def test_trial_vectors(spark):
    rows = [(1, "a", "x", None, 4), (2, "a", "x", None, 1), (3, "a", "x", "k", 1), (4, "b", "x", None, 9)]
    df = spark.createDataFrame(rows, "ord int, subject_id string, item_id string, test_condition string, trial int")
    assert [r["trial"] for r in trials.assign_trials(df, ["ord"]).orderBy("ord").collect()] == [1, 2, 1, 1]
    assert [r["trial"] for r in trials.assign_trials(df, ["ord"], preserve_valid=True).orderBy("ord").collect()] == [4, 1, 1, 9]


def test_trials_as_cumcount(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"subject_id": rng.choice(list("abc"), 300), "item_id": rng.choice(list("xyz"), 300), "test_condition": rng.choice(["k", None], 300), "ord": np.arange(300)})
    want = (pdf.groupby(["subject_id", "item_id", "test_condition"], dropna=False).cumcount() + 1).tolist()
    shuffled = spark.createDataFrame(pdf.sample(frac=1, random_state=1).astype(object).where(pdf.notna(), None), "subject_id string, item_id string, test_condition string, ord long")
    got = trials.assign_trials(shuffled, ["ord"])
    assert [r["trial"] for r in got.orderBy("ord").collect()] == want
    assert trials.key_duplicates(got).count() == 0


OBSERVED = "benchmark_id string, label string, raw_item_id string, content string, test_condition string, response double, correct_answer string, trace string, ord int"


def observed(spark):
    rows = [
        ("b", "GPT-4", "r1", "Hello", None, 1.0, "A", "t1", 1),
        ("b", " gpt-4 ", "r2", "Hello ", None, 0.0, "B", None, 2),
        ("b", "caf\u00e9", "r3", None, "k=1", 0.5, None, "t3", 3),
        ("b", "caf\u00e9", "r4", "Other", None, float("nan"), None, None, 4),
        ("c", "GPT-4", "r1", "Hello", None, 1.0, None, None, 5),
    ]
    return spark.createDataFrame(rows, OBSERVED)


def test_star_schema(spark, tmp_path):
    star = longform.finalize(observed(spark), ["ord"])
    assert star.responses.schema.simpleString() == schema.RESPONSES.simpleString()
    r = star.responses.collect()
    assert len(r) == 4 and sorted(x["trial"] for x in r if x["benchmark_id"] == "b" and x["response"] != 0.5) == [1, 2]
    subjects = {x["display_name"]: x["raw_labels_seen"] for x in star.subjects.collect()}
    assert subjects == {"GPT-4": ["GPT-4", " gpt-4 "], "caf\u00e9": ["caf\u00e9"]}
    items = {(x["benchmark_id"], x["raw_item_id"]): x for x in star.items.collect()}
    assert set(items) == {("b", "r1"), ("b", "r3"), ("c", "r1")} and items["b", "r1"]["correct_answer"] == "A" and items["b", "r3"]["content"] is None
    assert joins.orphans(star.responses, star.items, ["item_id"]).count() == joins.orphans(star.responses, star.subjects, ["subject_id"]).count() == 0
    again = longform.finalize(observed(spark).orderBy(F.col("ord").desc()), ["ord"])  # the order of arrival changes nothing
    assert sorted(map(str, again.responses.collect())) == sorted(map(str, r))
    assert sinks.write_responses(star.responses, str(tmp_path))
    back, traces = spark.read.parquet(f"{tmp_path}/responses.parquet"), spark.read.parquet(f"{tmp_path}/traces.parquet")
    assert dict(back.dtypes)["trace"] == "string" and traces.count() == 2
    full = joins.with_traces(back.select(*schema.RESPONSES.fieldNames()), traces)
    assert sorted(x["trace"] for x in full.collect() if x["trace"]) == ["t1", "t3"]
    assert audit.audit(star.responses).where("pk_dup > 0").count() == 0
    assert [x["benchmarks"] for x in audit.duplicate_items(star.items).collect()] == [2]
    with pytest.raises(registry.UnknownSubject):
        registry.require_known(spark.createDataFrame([("new",)], "label string"), "label", star.subjects)
    registry.require_known(spark.createDataFrame([("GPT-4",)], "label string"), "label", star.subjects)


def test_empty_star(spark):
    star = longform.finalize(observed(spark).limit(0), ["ord"])
    assert star.responses.count() == star.items.count() == star.subjects.count() == 0 and star.responses.columns == schema.RESPONSES.fieldNames()


def test_sql_views(spark):
    longform.register_views(longform.finalize(observed(spark), ["ord"]))
    got = spark.sql("SELECT s.display_name, r.benchmark_id, AVG(r.response) AS mean_score FROM responses r JOIN subjects s USING (subject_id) GROUP BY 1, 2 ORDER BY 1, 2").collect()
    assert [tuple(r) for r in got] == [("GPT-4", "b", 0.5), ("GPT-4", "c", 1.0), ("caf\u00e9", "b", 0.5)]


def test_ensure_and_typed(spark, tmp_path):
    spark.sql("select 'a' subject_id, null test_condition, 1 trial").write.parquet(f"{tmp_path}/1")
    spark.sql("select 'b' subject_id, 'k' test_condition, 2L trial").write.parquet(f"{tmp_path}/2")
    got = schema.read_typed(spark, [f"{tmp_path}/1", f"{tmp_path}/2"], schema.RESPONSES)
    assert got.schema.simpleString() == schema.RESPONSES.simpleString()
    assert sorted((r["subject_id"], r["test_condition"], r["trial"]) for r in got.collect()) == [("a", None, 1), ("b", "k", 2)]
    df = spark.sql("select double('nan') x, 'q' s")
    assert schema.nan_to_null(df).first()["x"] is None
    assert schema.where_if_column(df, "s", "z").count() == 0 and schema.where_if_column(df, "no", "z").count() == 1


def test_merge_subjects(spark):
    rows = [("s", "A", ["A", "a"], 1), ("s", "B", ["b", "A"], 2), ("t", "T", [], 1)]
    df = spark.createDataFrame(rows, "subject_id string, display_name string, raw_labels_seen array<string>, ord int")
    more = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.SUBJECTS.fields if f.name not in df.columns]
    got = {r["subject_id"]: (r["display_name"], r["raw_labels_seen"]) for r in registry.merge_subjects(df.select("*", *more), "ord").collect()}
    assert got == {"s": ("A", ["A", "a", "b"]), "t": ("T", [])}
    assert [tuple(r) for r in registry.merge_first(spark.createDataFrame([("i", "late", 2), ("i", "early", 1)], "item_id string, content string, ord int"), "item_id", "ord").collect()] == [("i", "early")]


def test_selection(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("m", 3, "c")], "k string, o int, v string")
    assert sorted(r["v"] for r in select.first_per_key(df, ["k"], ["o"]).collect()) == ["a", "c"]
    assert sorted(r["v"] for r in select.last_per_key(df, ["k"], ["o"]).collect()) == ["b", "c"]
    files = [("m1", "f1", "afrimedqa-v1", "base", 0, 10), ("m1", "f2", "afrimedqa-v2", "base", 0, 5), ("m2", "g", "afrimedqa-v1", "instruct", 0, 9), ("m3", "h", "unknown", "base", 0, 2799), ("m4", "j", "unknown", "base", 0, 2800), ("m4", "i", "unknown", "base", 0, 2800), ("m5", "z", "medqa", "base", 0, 9000)]
    got = select.primary_files(spark.createDataFrame(files, "model_dir string, filename string, dataset string, prompt string, shots int, n_items long"))
    assert sorted((r["model_dir"], r["filename"]) for r in got.collect()) == [("m1", "f2"), ("m2", "g"), ("m4", "i")]


def test_joins(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(2, "late"), (3, None)], "k int, v string")
    assert sorted(map(tuple, joins.prefer(a, b, ["k"], ["v"]).collect()), key=str) == [(1, "x"), (2, "late"), (3, None)]
    assert sorted(r["k"] for r in joins.append_missing(a, b, ["k"]).collect()) == [1, 2, 3]
    c = spark.createDataFrame([([True, False, True], ["p"])], "g array<boolean>, o array<string>")
    assert [(r["left_value"], r["right_value"]) for r in joins.aligned(c, "g", "o").orderBy("pos").collect()] == [(True, "p"), (False, None), (True, None)]
    assert sorted(map(tuple, joins.flagged(a.select("k"), b, ["k"], present=1.0).collect())) == [(1, 0.0), (2, 1.0)]
    assert joins.dense_grid(a, b.select(F.col("k").alias("j"))).count() == 4


def test_reshape(spark):
    r = spark.createDataFrame([("s", "i", 1.0), ("s", "i", 0.0), ("t", "j", 1.0)], "subject_id string, item_id string, response double")
    assert sorted(map(tuple, reshape.wide_matrix(r, ["i", "j"]).collect())) == [("s", 0.5, None), ("t", None, 1.0)]
    with pytest.raises(ValueError):
        reshape.wide_matrix(r, ["i"] * 10_001)
    cells = spark.createDataFrame([("t", [0.1, 0.2])], "task string, cells array<double>")
    assert [tuple(x) for x in reshape.cells_to_rows(cells, "cells", ["m1", "m2"], "model", "score").collect()] == [("t", "m1", 0.1), ("t", "m2", 0.2)]
    turns = spark.createDataFrame([(1, ["a", "b"])], "q int, turns array<string>")
    assert [tuple(x) for x in reshape.turns_to_rows(turns, "turns").collect()] == [(1, "a", 1), (1, "b", 2)]
