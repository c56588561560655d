import json
import zipfile

import pytest
from pyspark.sql import functions as F

from lattica import schema
from lattica.sources import python_sources, readers, sinks


def test_jsonl(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"q": 1, "s": 2.5}\n\n{broken\n  \n{"q": 2}\r\n{"q": 3, "s": -1}')
    got = readers.jsonl(spark, str(p), "q long, s double").orderBy("pos").collect()
    assert [(r["q"], r["s"]) for r in got] == [(1, 2.5), (2, None), (3, -1.0)]
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.jsonl_strict(spark, str(p), "q long, s double").collect()


def test_headed_ndjson(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"accuracy": 0.5, "total_count": 2}\n{"id": "x"}\n{"id": "y"}\n')
    (tmp_path / "b.json").write_text('{"accuracy": 1.0, "total_count": 1}\n')
    head, rest = readers.headed_ndjson(spark, str(tmp_path), "accuracy double, total_count int", "id string")
    assert sorted(r["accuracy"] for r in head.collect()) == [0.5, 1.0] and sorted(r["id"] for r in rest.collect()) == ["x", "y"]


def test_json_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"resolved": ["x", "y"]}))
    (tmp_path / "b.json").write_text("{nope")
    got = readers.json_object(spark, str(tmp_path), "map<string,array<string>>").collect()
    assert [r["value"] for r in got] == [{"resolved": ["x", "y"]}]
    (tmp_path / "c").mkdir()
    (tmp_path / "c/d.json").write_text('[{"v": 1}, {"v": 2}]')
    assert [(r["pos"], r["value"]["v"]) for r in readers.json_array(spark, str(tmp_path / "c"), "struct<v:int>").orderBy("pos").collect()] == [(0, 1), (1, 2)]


def test_csv(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text('id,score,answer\nq1,1,"two\nlines, ""quoted"""\n,0,x\nTotals:,9,\nq2,0,z\n')
    assert [(r["id"], r["answer"]) for r in readers.scored_csv(spark, str(p)).orderBy("id").collect()] == [("q1", 'two\nlines, "quoted"'), ("q2", "z")]
    peek = readers.csv_peek(spark, str(p)).first()
    assert peek["header"] == ["id", "score", "answer"] and peek["n_items"] == 4


def test_run_tree(spark, tmp_path):
    d = tmp_path / "model-x" / "bank" / "user_task_1" / "none"
    d.mkdir(parents=True)
    (d / "none.json").write_text(json.dumps({"suite_name": "other", "utility": True}))
    (d / "bad.json").write_text("[")
    rows = readers.run_tree(spark, str(tmp_path), ["model", "suite", "task", "attack", "injection"], ["", "suite_name", "user_task_id", "", ""]).collect()
    assert [(r["model"], r["suite"], r["task"], r["injection"], r["record"]["utility"]) for r in rows] == [("model-x", "other", "user_task_1", "none", "true")]


def test_zip_and_xlsx(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("__MACOSX/x.json", "[]")
        z.writestr("r.json", json.dumps([{"q": 1}, "skip", {"q": 2}]))
    (tmp_path / "b.zip").write_bytes(b"no archive")
    got = python_sources.zipped_json(spark, str(tmp_path)).orderBy("pos").collect()
    assert [json.loads(r["record"])["q"] for r in got] == [1, 2]
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "s.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>index</t></si><si><t>answer</t></si><si><r><t>B</t></r><r><t>!</t></r></si></sst>")
        cell = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row><row r="2"><c r="A2"><v>7</v></c><c r="B2" t="s"><v>2</v></c></row><row r="3"><c r="B3" t="b"><v>1</v></c></row>'
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{cell}</sheetData></worksheet>")
    got = python_sources.xlsx(spark, str(tmp_path)).orderBy("pos").collect()
    assert [r["cells"] for r in got] == [{"index": "7", "answer": "B!"}, {"index": None, "answer": "True"}]


def test_task_prompts(spark, tmp_path):
    for version, extra in (("v1", ""), ("v1_2", "!")):
        d = tmp_path / version / "bank"
        d.mkdir(parents=True)
        (d / "user_tasks.py").write_text(f'''
NAME = "Bob"
class UserTask0(Base):
    X = "day"
    PROMPT = f"Pay {{NAME}} by {{X}} {{self.y}}{extra}"
    GROUND_TRUTH_OUTPUT: str = "done" + "!"
class UserTask1(Base):
    PROMPT = "two"
suite.create_combined_task("UserTask2", task_suite.user_tasks["user_task_0"], task_suite.user_tasks["user_task_1"])
''')
        (d / "injection_tasks.py").write_text('class InjectionTask3(Base):\n    GOAL = "steal"\n')
        (d / "broken_tasks.py").write_text("def (")
    got = {(r["kind"], r["task"]): r["text"] for r in python_sources.task_prompts(spark, str(tmp_path)).collect()}
    assert got == {("user_task", "user_task_0"): "Pay Bob by day {self.y}!", ("ground_truth", "user_task_0"): "done!", ("user_task", "user_task_1"): "two", ("user_task", "user_task_2"): "Pay Bob by day {self.y}! two", ("injection_task", "injection_task_3"): "steal"}


def test_table_lines(spark):
    lines = ["Data Siege 00:02 C HTB ✓ X X ✓ X X X X", "Short 00:02 C HTB ✓ X", "SuccessCount 00:02 C HTB ✓ X X ✓ X X X X", "noise"]
    got = readers.table_lines(spark.createDataFrame([(x,) for x in lines], "line string"), "line").collect()
    assert [(r["task"], r["cells"].count("✓")) for r in got] == [("Data Siege", 2)]
    frac = spark.createDataFrame([("A b 00:02:10 W GLA 1/2 X X 2/5 X X X X",)], "line string")
    assert readers.table_lines(frac, "line", seconds=True).first()["cells"][3] == "2/5"


def test_manifest_and_contributions(spark, tmp_path):
    m = readers.manifest(spark, "datasets:\n  a:\n    domain: ''\n    release: public\n  b:\n    domain: 'x'\n    release: private\n").collect()
    assert [tuple(r) for r in m] == [("a", "", "public"), ("b", "x", "private")]
    for i in (1, 2):
        sinks.write_contribution({"items": schema.ensure_columns(spark.createDataFrame([(f"i{i}",)], "item_id string"), schema.ITEMS), "subjects": schema.empty(spark, schema.SUBJECTS)}, f"{tmp_path}/{i}")
    got = readers.contributions(spark, [f"{tmp_path}/{i}" for i in (1, 2)], "items", schema.ITEMS)
    assert sorted((r["item_id"], r["ord"]) for r in got.collect()) == [("i1", 0), ("i2", 1)]
    assert readers.contributions(spark, [f"{tmp_path}/1"], "subjects", schema.SUBJECTS).count() == 0


def test_cached(spark, tmp_path):
    calls = []

    def make():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "c")
    assert sinks.cached(spark, path, ["id"], make).count() == sinks.cached(spark, path, ["id"], make).count() == 3 and len(calls) == 1
    sinks.cached(spark, path, ["other"], lambda: spark.range(2).select(F.col("id").alias("other")))
    assert spark.read.parquet(path).columns == ["other"]
