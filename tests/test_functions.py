import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lattica.functions import content, scoring, text


def one(spark, value, f, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(f(F.col("x")).alias("y")).first()["y"]


def many(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_identity_vectors(spark):
    assert many(spark, ["GPT-4", "  gpt-4\t", "caf\u00e9", "Cafe\u0301", "\u00a0x\u3000"], text.subject_id) == ["1b1ae706971632ad"] * 2 + ["850f7dc43910ff89"] * 2 + ["2d711642b726b044"]
    rows = [("b1", "Hello", None), ("b1", " Hello\n", None), ("b1", "hello", None), ("b2", "Hello", None), ("b1", "cafe\u0301", None), ("b1", "", None), ("b1", None, "r7")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, b string, c string, r string")
    got = df.select("i", text.item_id(F.col("b"), "c", "r").alias("id"), text.content_hash("c", "r").alias("h")).orderBy("i").collect()
    assert [r["id"] for r in got] == ["09d15d532c379739", "09d15d532c379739", "a5a0e4d5f46a3ffc", "3a2a9acde24346d7", "f41911bb54b2eb42", "22a540c02ee3fcef", "8e0d825f30915955"]
    assert [got[i]["h"] for i in (0, 1, 2, 3, 5, 6)] == ["185f8db32271fe25", "185f8db32271fe25", "2cf24dba5fb0a30e", "185f8db32271fe25", "e3b0c44298fc1c14", "9fd496561ad6a0e8"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=1, max_size=60))
def test_nfc_and_strip_as_python(spark, values):
    values = [v.encode("utf-8", "ignore").decode() for v in values]
    assert many(spark, values, text.content_form) == [unicodedata.normalize("NFC", v).strip() for v in values]


LETTERS = [
    ("A", "A", "A"), ("a", "A", None), (" b ", "B", None), ("E", None, "E"), ("The answer is C.", "C", "C"), ("answer: d", "D", None), ("The answer is a dog", "A", "A"),
    ("Answer   is:B", "B", "B"), ("**D** because", "D", "D"), ("**Dog", None, None), ("(B) foo", "B", "B"), ("A dog runs", "A", "A"), ("( C", "C", "C"), ("I think", None, "I"),
    ("answer is (J)", None, "J"), ("answer is incorrect", None, "I"), ("so I pick B or C", "B", "C"), ("A B", "A", "B"), ("ANSWER IS (d)", None, "D"), ("answer :c", "C", None),
    ("xA", None, None), ("nan", None, None), ("", None, None), ("F\u00fcr", None, None),
]


def test_choice_letters(spark):
    values = [x for x, _, _ in LETTERS]
    assert many(spark, values, scoring.choice_letter) == [a for _, a, _ in LETTERS]
    assert many(spark, values, scoring.choice_letter_ten) == [b for _, _, b in LETTERS]


def test_choice_scores(spark):
    rows = [("A", "A"), ("a", "a"), ("zzz", "A"), ("B", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, p string, g string")
    got = df.select("i", scoring.choice_score("p", "g").alias("a"), scoring.choice_score_ten("p", "g").alias("b")).orderBy("i").collect()
    assert [r["a"] for r in got] == [1.0, 0.0, None, 0.0] and [r["b"] for r in got] == [1.0, 0.0, 0.0, 0.0]


def test_free_scores(spark):
    rows = [("The answer is 3.50", "3.5", 1), ("about 12 apples", "12", 1), ("yes", "Yes", 1), ("No, yes", "yes", 1), ("1,200", "1200", 0), ("-.5", "-0.5", 1), ("3 of 4", "4", 0), ("nan 3", "nan", 0), ("abc", "", 1), ("5", "five", 0), ("1e3", "1000", 0), ("one", "1", 0)]
    df = spark.createDataFrame([(i, p, g) for i, (p, g, _) in enumerate(rows)], "i int, p string, g string")
    assert [r["s"] for r in df.select("i", scoring.free_score("p", "g").alias("s")).orderBy("i").collect()] == [float(s) for _, _, s in rows]


def test_small_scalars(spark):
    assert one(spark, "x" * 4001, lambda x: text.cut_marked(x, 4000)) == "x" * 3985 + text.CUT_MARK
    assert many(spark, ["x" * 4000, ""], lambda x: text.cut_marked(x, 4000)) == ["x" * 4000, None]
    assert many(spark, [" Instruction-Following", "HONESTY"], text.key_form) == ["instruction_following", "honesty"]
    assert many(spark, ["model_outputs_GPT-4o_5shots.json.zip", "a_5-shots.zip", "b_5shots_1_2_3.zip", "c.json.zip"], text.archive_model_name) == ["GPT-4o", "a", "b", "c"]
    assert many(spark, ["2/5", "X", "1/0"], scoring.fraction) == [0.4, 0.0, None]
    assert many(spark, [0.5, 60.0, 1.0], scoring.from_percent, "double") == [0.5, 0.6, 1.0]
    assert many(spark, ["0.9", "x", "-1.7"], scoring.whole) == [0, None, -1]
    assert many(spark, [" Yes ", "no", None], scoring.yes) == [1.0, 0.0, 0.0]
    assert many(spark, ["True", "False", "3", "nan", "z"], scoring.number) == [1.0, 0.0, 3.0, None, None]
    assert many(spark, ["0", "1", "5", "6", "q"], scoring.rating) == [None, 1.0, 5.0, None, None]
    assert many(spark, ["[Easy] 01-Data Siege", "02_X y", "plain"], text.bare_slug) == ["datasiege", "xy", "plain"]
    assert many(spark, ["It's a-\"b\""], text.plain_slug) == ["itsab"]
    assert many(spark, ["https://arxiv.org/abs/2306.05685", "x"], text.paper_month) == ["2023-06", None]


@pytest.mark.parametrize(("points", "most", "want"), [(8.0, 7.0, 1.0), (-1.0, 7.0, 0.0), (1.0, 0.0, None), (1.0, None, None), (None, 2.0, None), (float("nan"), 2.0, None), (1.0, 4.0, 0.25)])
def test_share(spark, points, most, want):
    df = spark.createDataFrame([(points, most)], "p double, m double")
    assert df.select(scoring.share("p", "m").alias("s")).first()["s"] == want


def test_judge_score(spark):
    rows = [(-1.0, "ok [[7.5]]", 7.5), (None, "nothing", None), (-1.0, "[[x]]", None), (3.0, "[[9]]", 3.0)]
    df = spark.createDataFrame([(i, s, j) for i, (s, j, _) in enumerate(rows)], "i int, s double, j string")
    assert [r["v"] for r in df.select("i", scoring.judge_score("s", "j").alias("v")).orderBy("i").collect()] == [v for _, _, v in rows]


def test_present_or(spark):
    df = spark.createDataFrame([({"score": None, "rating": "4"},), ({"rating": "4"},)], "m map<string,string>")
    assert [r["v"] for r in df.select(scoring.present_or("m", "score", "rating").alias("v")).collect()] == [None, "4"]


def test_file_classes(spark):
    names = ["m_afrimed-qa-v2.5_mcq_instruct-prompt_5-shot.csv", "m_medqa_mcq.csv", "m_saq.csv", "a_mcq.txt"]
    got = many(spark, names, text.result_file_class)
    assert [None if r is None else tuple(r) for r in got] == [("afrimedqa-v2.5", "instruct", 5), ("medqa", "base", 0), None, None]


def test_contents(spark):
    df = spark.sql("select 'q ' q, 'x' a, cast(null as string) b, array('u', null, 'w') o, cast(array() as array<string>) e")
    r = df.select(content.choice_content("q", {"A": "a", "B": "b"}).alias("c"), content.listed_content("q", "o").alias("l"), content.listed_content("q", "e").alias("n"), content.tagged_pair("a", "b").alias("p"), content.tagged_pair("b", "b").alias("z"), content.titled("a", "q").alias("t")).first()
    assert r["c"] == "q\n\nA: x" and r["l"] == "q \n\nA: u\nB: \nC: w" and r["n"] == "q " and r["p"] == "[user_task] x" and r["z"] is None and r["t"] is None


def test_messages(spark):
    rows = [([("system", "s"), ("user", " "), ("user", " u"), ("assistant", "r")],), ([("x", " "), ("y", "a"), ("z", "b")],), ([],)]
    df = spark.createDataFrame(rows, "m array<struct<role:string,content:string>>")
    assert [tuple(r) for r in df.select(content.user_prompt("m"), content.assistant_reply("m")).collect()] == [(" u", "r"), ("a", "b"), (None, None)]


def test_nested_text(spark):
    raw = ['[[{"role":"user","content":"a"},{"content":"b"}],["c",[" ",{"role":"x"}]]]', '" s "', "null", "{bad", None]
    assert many(spark, raw, content.nested_text) == ["[user] a\nb\nc", "s", None, None, None]


def test_conditions(spark):
    df = spark.sql("select 'v' a, 2 b, cast(null as string) c")
    made = df.select(content.condition({"x": "a", "y": "b"}, ";").alias("t"), content.condition({"x": "c"}).alias("n"))
    assert tuple(made.first()) == ("x=v;y=2", None)
    assert made.select(content.condition_map("t").alias("m")).first()["m"] == {"x": "v", "y": "2"}
