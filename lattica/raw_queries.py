"""Registered queries of readers, writers and the functions of raw records, each with its SQL.

Raw files are made from the driver's tables, written to the folder that all
machines share, and read back by the reader in question.
"""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema
from .functions import content, scoring, text
from .operators import joins, registry, reshape
from .plans import builds, longform
from .queries import _EVENTS, _content, _h16, messages, observed, query, table
from .sources import python_sources, readers, sinks

_WS = "'" + text.WS + "'"


def folder(spark: SparkSession) -> str:
    """A new folder where spark.checkpoint.dir says, or a local one where that is unset and all runs on one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that all machines share")
        base = "file://" + tempfile.mkdtemp(prefix="lattica-raw-")
    return f"{base.rstrip('/')}/raw-{uuid.uuid4().hex}"


def put(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file, by the file system that the path is of."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where)
    out.write(bytearray(data))
    out.close()


def lines(df: DataFrame, path: str, *columns: str | Column) -> str:
    """df's columns as JSON Lines."""
    df.select(F.to_json(F.struct(*columns)).alias("value")).write.text(path)
    return path


# --- readers -----------------------------------------------------------------------------------------------------


@query("SELECT event_id, event_type, value FROM events")
def jsonl_scan(spark: SparkSession, d: str) -> DataFrame:
    """Blank and broken lines between the records are skipped."""
    e = table(spark, d, "events")
    good = F.to_json(F.struct("event_id", "event_type", "value"))
    path = folder(spark)
    e.select(F.explode(F.array(good, F.lit(""), F.lit("  "), F.concat(F.lit("{"), F.col("event_type")))).alias("value")).write.text(path)
    return readers.jsonl(spark, path, "event_id long, event_type string, value double").select("event_id", "event_type", "value")


@query("SELECT conv_id, turn, role, text FROM conversations")
def jsonl_strict_scan(spark: SparkSession, d: str) -> DataFrame:
    path = lines(table(spark, d, "conversations"), folder(spark), "conv_id", "turn", "role", "text")
    return readers.jsonl_strict(spark, path, "conv_id long, turn long, role string, text string").select("conv_id", "turn", "role", "text")


@query("""SELECT n_nationkey AS k, count(*) AS total, CAST(NULL AS BIGINT) AS id FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1
UNION ALL SELECT c_nationkey, NULL, c_custkey FROM customer""")
def headed_scan(spark: SparkSession, d: str) -> DataFrame:
    """Files whose first line is a summary."""
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("id"))
    head = F.to_json(F.struct(F.col("k").alias("key"), "total"))
    heads = c.groupBy("k").agg(F.count("*").alias("total")).select("k", F.lit(-1).cast("long").alias("o"), head.alias("value"))
    rows = heads.unionByName(c.select("k", F.col("id").alias("o"), F.to_json(F.struct(F.col("k").alias("key"), "id")).alias("value")))
    path = folder(spark)
    rows.repartition("k").sortWithinPartitions("k", "o").drop("o").write.partitionBy("k").text(path)
    top, rest = readers.headed_ndjson(spark, path, "key int, total long", "key int, id long")
    return top.select(F.col("key").alias("k"), "total", F.lit(None).cast("long").alias("id")).unionByName(rest.select(F.col("key").alias("k"), F.lit(None).cast("long").alias("total"), "id"))


@query("SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS task FROM orders")
def resolved_union(spark: SparkSession, d: str) -> DataFrame:
    """One JSON object a file, of open keys; the distinct elements of all its lists; a broken file is skipped."""
    o = table(spark, d, "orders").select(F.pmod(F.col("o_orderkey"), F.lit(9)).alias("k"), "o_orderstatus", F.col("o_custkey").cast("string").alias("t"))
    lists = o.groupBy("k", "o_orderstatus").agg(F.collect_list("t").alias("ts")).groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("o_orderstatus", "ts"))).alias("m"))
    path = folder(spark)
    broken = spark.range(1).select(F.lit(99).cast("long").alias("k"), F.lit("{nope").alias("value"))
    lists.select(F.col("k").cast("long"), F.to_json("m").alias("value")).unionByName(broken).repartition("k").write.partitionBy("k").text(path)
    return reshape.list_union(readers.json_object(spark, path, "map<string,array<string>>"), "value", "task")


@query("SELECT c_custkey AS id, c_acctbal AS balance, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS pos FROM customer")
def json_array_scan(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.array_sort(F.collect_list(F.struct(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance")))).alias("a"))
    path = folder(spark)
    c.select("k", F.to_json("a").alias("value")).repartition("k").write.partitionBy("k").text(path)
    return readers.json_array(spark, path, "struct<id:long,balance:double>").select("value.*", F.col("pos").cast("long").alias("pos"))


@query("""SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE replace(text, chr(13), ' ') END AS text, CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE lang END AS lang FROM documents""")
def csv_scan(spark: SparkSession, d: str) -> DataFrame:
    """Quoted line ends, an index column without name, and words that mean a missing cell."""
    k = F.col("doc_id")
    docs = table(spark, d, "documents").select(k.alias("Unnamed: 0"), "doc_id", F.when(k % 5 == 0, "NA").otherwise(F.replace("text", F.lit("\r"), F.lit(" "))).alias("text"), F.when(k % 4 == 0, "nan").when(k % 4 == 1, "None").otherwise(F.col("lang")).alias("lang"))
    path = folder(spark)
    docs.write.csv(path, header=True, escape='"', quoteAll=True)
    return readers.csv(spark, path, ["doc_id", "text", "lang", "absent"], missing=readers.MISSING).withColumn("doc_id", F.col("doc_id").cast("long"))


@query("""SELECT 'q' || c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(trunc(c_acctbal) AS INTEGER) END AS score FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0""")
def scored_csv_scan(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    ident = F.when(k % 7 == 0, "  ").when(k % 11 == 0, "Totals:").otherwise(F.concat(F.lit("q"), k.cast("string")))
    path = folder(spark)
    table(spark, d, "customer").select(ident.alias("id"), F.when(k % 3 == 0, "x").otherwise(F.col("c_acctbal").cast("decimal(18,2)").cast("string")).alias("score")).write.csv(path, header=True, escape='"')
    return readers.scored_csv(spark, path).select("id", scoring.whole("score").alias("score"))


@query("SELECT c_nationkey AS k, 'c_custkey|c_name' AS header, count(*) AS n_items FROM customer GROUP BY 1")
def csv_peek_scan(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark)
    table(spark, d, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("k")).repartition("k").write.partitionBy("k").csv(path, header=True)
    peek = readers.csv_peek(spark, path + "/*")
    return peek.select(F.regexp_extract("file", r"/k=(\d+)/", 1).cast("int").alias("k"), F.array_join("header", "|").alias("header"), "n_items")


def _workbook(rows: list[list]) -> bytes:
    cell = lambda v: f"<c><v>{v}</v></c>" if isinstance(v, int) else f'<c t="inlineStr"><is><t>{v}</t></is></c>'
    sheet = "".join(f"<row>{''.join(map(cell, r))}</row>" for r in rows)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{sheet}</sheetData></worksheet>')
    return out.getvalue()


def _nations(spark: SparkSession, d: str) -> list[tuple[int, str]]:
    """A table of fixed size, small enough to make a file of it here."""
    return sorted((r[0], r[1]) for r in table(spark, d, "nation").select("n_nationkey", "n_name").collect())


@query("SELECT CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS INTEGER) AS pos, CAST(n_nationkey AS VARCHAR) AS key, n_name AS name FROM nation")
def xlsx_scan(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark)
    put(spark, f"{path}/a.xlsx", _workbook([["key", "name"], *map(list, _nations(spark, d))]))
    return python_sources.xlsx(spark, path).select("pos", F.col("cells")["key"].alias("key"), F.col("cells")["name"].alias("name"))


@query("SELECT n_nationkey % 2 AS k, n_name AS name, CAST(row_number() OVER (PARTITION BY n_nationkey % 2 ORDER BY n_nationkey) - 1 AS INTEGER) AS pos FROM nation")
def zip_scan(spark: SparkSession, d: str) -> DataFrame:
    """Archives of a JSON array beside other members and elements, and one that is no archive."""
    import json

    path, rows = folder(spark), _nations(spark, d)
    for k in (0, 1):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("__MACOSX/a.json", "[]")
            z.writestr("a.json", json.dumps(["no record", *({"k": k, "name": n} for i, n in rows if i % 2 == k), 7]))
        put(spark, f"{path}/m{k}.zip", out.getvalue())
    put(spark, f"{path}/bad.zip", b"no archive")
    rec = F.from_json("record", "k int, name string")
    return python_sources.zipped_json(spark, path).select(rec["k"].alias("k"), rec["name"].alias("name"), "pos")


@query("SELECT r_name AS model, CASE WHEN n_nationkey % 3 = 0 THEN 'own' ELSE 's' || (n_nationkey % 4) END AS suite, 't' || n_nationkey AS task, CASE WHEN n_nationkey % 2 = 0 THEN 'true' END AS utility FROM nation JOIN region ON n_regionkey = r_regionkey")
def run_tree_scan(spark: SparkSession, d: str) -> DataFrame:
    """One object a file in a tree of folders; a record's own suite counts more than its folder's."""
    path, regions = folder(spark), {r[0]: r[1] for r in table(spark, d, "region").collect()}
    for k, rk in table(spark, d, "nation").select("n_nationkey", "n_regionkey").collect():
        own = ['"suite_name":"own"'] * (k % 3 == 0) + ['"utility":true'] * (k % 2 == 0)
        put(spark, f"{path}/{regions[rk].replace(' ', '_')}/s{k % 4}/t{k}.json", ("{" + ",".join(own) + "}").encode())
        put(spark, f"{path}/{regions[rk].replace(' ', '_')}/s{k % 4}/bad{k}.json", b"[")
    rows = readers.run_tree(spark, path, ["model", "suite", "task"], ["", "suite_name", ""])
    return rows.select(F.replace("model", F.lit("_"), F.lit(" ")).alias("model"), "suite", "task", F.try_element_at("record", F.lit("utility")).alias("utility"))


@query("""SELECT 'user_task' AS kind, CASE WHEN n_nationkey % 2 = 0 THEN 'even' ELSE 'odd' END AS suite, 'user_task_' || n_nationkey AS task, 'Visit ' || n_name || CASE WHEN n_nationkey % 3 = 0 THEN ' again' ELSE '' END AS text FROM nation
UNION ALL SELECT 'injection_task', CASE WHEN n_nationkey % 2 = 0 THEN 'even' ELSE 'odd' END, 'injection_task_' || n_nationkey, 'Leave ' || n_name FROM nation""")
def task_prompt_scan(spark: SparkSession, d: str) -> DataFrame:
    """Texts of classes in Python source; a later version's replace an earlier one's."""
    path, rows = folder(spark), _nations(spark, d)
    for suite in (0, 1):
        own = [(k, n) for k, n in rows if k % 2 == suite]
        first = "VERB = 'Visit'\n" + "".join(f"class UserTask{k}(T):\n    NAME = {n!r}\n    PROMPT = f'{{VERB}} {{NAME}}'\nclass InjectionTask{k}(T):\n    GOAL: str = 'Leave ' + {n!r}\n" for k, n in own)
        later = "".join(f"class UserTask{k}(T):\n    PROMPT = 'Visit {n}' + ' again'\n" for k, n in own if k % 3 == 0)
        name = "odd" if suite else "even"
        put(spark, f"{path}/v1/{name}/user_tasks.py", first.encode())
        put(spark, f"{path}/v1_2/{name}/user_tasks.py", later.encode())
    return python_sources.task_prompts(spark, path)


@query("""SELECT replace(p_name, ' ', '-') || p_partkey AS task, 'm' || (m + 1) AS model, CASE (p_partkey + m) % 3 WHEN 0 THEN 0.0 ELSE ((p_partkey + m) % 3) / 4.0 END::DOUBLE AS score
FROM part, (SELECT unnest(range(0, 8)) AS m) WHERE p_partkey % 5 <> 0""")
def table_line_scan(spark: SparkSession, d: str) -> DataFrame:
    """Lines of a printed table: one row a line and model; titles, noise and short lines go."""
    k = F.col("p_partkey")
    cell = lambda m: F.when((k + m) % 3 == 0, "X").otherwise(F.concat(((k + m) % 3).cast("string"), F.lit("/4")))
    cells = F.concat_ws(" ", *[cell(m) for m in range(8)])
    name = F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), k.cast("string"))
    line = F.when(k % 5 != 0, F.concat_ws(" ", name, F.lit("00:02:10 W GLA"), cells)).when(k % 10 == 0, F.concat(name, F.lit(" 00:02:10 W GLA X X"))).otherwise(F.concat(F.lit("SumofScores 00:02:10 W GLA "), cells))
    found = readers.table_lines(table(spark, d, "part").select(line.alias("line")), "line", seconds=True)
    rows = reshape.cells_to_rows(found, "cells", [f"m{i + 1}" for i in range(8)], "model", "cell")
    return rows.select("task", "model", scoring.fraction("cell").alias("score"))


@query("SELECT n_name AS name, CASE n_regionkey WHEN 0 THEN 'south' WHEN 3 THEN 'north' END AS side FROM nation")
def literal_table(spark: SparkSession, d: str) -> DataFrame:
    sides = readers.literal(spark, [(0, "south"), (3, "north")], "n_regionkey int, side string")
    return joins.lookup(table(spark, d, "nation"), sides, ["n_regionkey"]).select(F.col("n_name").alias("name"), "side")


@query("SELECT o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0 GROUP BY 1")
def glob_sql(spark: SparkSession, d: str) -> DataFrame:
    """SQL over Parquet globs."""
    readers.register_globs(spark, {"lattica_orders": f"{d}/order*.parquet", "lattica_customer": f"{d}/{{customer,nothing}}.parquet"})
    return spark.sql("SELECT o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM lattica_orders JOIN lattica_customer ON o_custkey = c_custkey WHERE c_acctbal > 0 GROUP BY 1")


# --- writers -----------------------------------------------------------------------------------------------------


@query(f"WITH {_EVENTS} SELECT subject_id, item_id, CAST(trial AS INTEGER) AS trial, test_condition, response, CASE WHEN event_id % 3 = 0 THEN 't' || event_id END AS trace FROM e")
def responses_sink(spark: SparkSession, d: str) -> DataFrame:
    """Responses and traces are written apart, by benchmark, and found together again."""
    rows = observed(spark, d).withColumn("trace", F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("t"), "event_id")))
    path = folder(spark)
    sinks.write_responses(longform.finalize(rows, ["event_id"]).responses, path)
    back = joins.with_traces(spark.read.parquet(f"{path}/responses.parquet"), spark.read.parquet(f"{path}/traces.parquet"))
    return back.select("subject_id", "item_id", "trial", "test_condition", "response", "trace")


@query(f"""WITH c AS (SELECT c_custkey % 3 AS build, c_custkey, c_name FROM customer)
SELECT {_h16(f"lower({_content('c_name')})")} AS subject_id, c_name AS display_name, CAST(build AS INTEGER) AS build FROM c""")
def contribution_sink(spark: SparkSession, d: str) -> DataFrame:
    """Each build writes the registry tables that have rows; they are read in the order of builds."""
    c, path = table(spark, d, "customer"), folder(spark)
    for i in range(3):
        rows = c.where(F.col("c_custkey") % 3 == i).select(F.col("c_name").alias("label"), F.col("c_custkey").alias("o"))
        tables = {"subjects": schema.ensure_columns(registry.build_subjects(rows, "label", "o"), schema.SUBJECTS), "items": schema.empty(spark, schema.ITEMS)}
        if sinks.write_contribution(tables, f"{path}/{i}") != ["subjects"]:
            raise AssertionError("only tables with rows are written")
    found = readers.contributions(spark, [f"{path}/{i}" for i in range(3)], "subjects", schema.SUBJECTS)
    return found.select("subject_id", "display_name", F.col("ord").alias("build"))


@query("SELECT n_nationkey, n_name, 1 AS made FROM nation")
def cache_sink(spark: SparkSession, d: str) -> DataFrame:
    """A table is made once, and read from then on."""
    path, made = folder(spark), []

    def make() -> DataFrame:
        made.append(1)
        return table(spark, d, "nation").select("n_nationkey", "n_name")

    for _ in range(3):
        found = sinks.cached(spark, path, ["n_nationkey"], make)
    return found.withColumn("made", F.lit(len(made)))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def parquet_union_scan(spark: SparkSession, d: str) -> DataFrame:
    """Files in which a column that is all NULL has another type are united under one schema."""
    line, path = table(spark, d, "lineitem"), folder(spark)
    line.where("l_linenumber % 2 = 0").select("l_returnflag", "l_linestatus").write.parquet(f"{path}/a")
    line.where("l_linenumber % 2 = 1").select("l_linestatus", "l_returnflag", F.lit(None).cast("int").alias("note")).write.parquet(f"{path}/b")
    from pyspark.sql import types as T

    kinds = T.StructType([T.StructField(c, T.StringType()) for c in ("l_returnflag", "l_linestatus", "note")])
    return readers.parquet_union(spark, [f"{path}/a", f"{path}/b"], kinds).where("note is null").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


# --- filters, joins, counters ------------------------------------------------------------------------------------


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view') AND user_id % 3 <> 0")
def allow_deny(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumns({"kind": text.key_form(F.concat(F.lit(" "), F.upper("event_type"))), "rest": F.when(F.col("user_id") % 3 == 0, "drop").when(F.col("user_id") % 3 == 1, "keep")})
    return reshape.deny(reshape.allow(schema.where_if_column(e, "absent", 1), "kind", ("click", "view")), "rest", ("drop",)).select("event_id", "event_type")


@query("""SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'BOOLEAN' WHEN 1 THEN 'STRING' WHEN 2 THEN 'OBJECT' WHEN 3 THEN 'ARRAY' WHEN 4 THEN 'NUMBER' WHEN 5 THEN 'NULL' END AS kind FROM events""")
def json_types(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    raw = F.when(k % 7 == 0, "true").when(k % 7 == 1, F.to_json(F.struct("event_type")).substr(15, 99)).when(k % 7 == 2, F.col("props")).when(k % 7 == 3, F.to_json(F.array("value"))).when(k % 7 == 4, k.cast("string")).when(k % 7 == 5, "null").otherwise("{nope")
    raw = F.when(k % 7 == 1, F.concat(F.lit('"'), F.col("event_type"), F.lit('"'))).otherwise(raw)
    return table(spark, d, "events").select("event_id", reshape.json_type(raw).alias("kind"))


@query("""SELECT vec_id AS file, 64 AS n FROM embeddings WHERE vec_id % 2 = 0 AND (vec_id % 3 <> 0 OR label = (SELECT label FROM embeddings WHERE vec_id = 0))""")
def file_validation(spark: SparkSession, d: str) -> DataFrame:
    """Whole files are dropped whose length or subsets differ from the reference's; a file without subsets is judged by length."""
    k = F.col("vec_id")
    subset = F.when(k % 3 == 0, F.array("label")).when(k % 3 == 1, F.array().cast("array<int>"))
    files = table(spark, d, "embeddings").select(k.alias("file"), F.when(k % 2 == 0, F.col("embedding")).otherwise(F.slice("embedding", 1, 63)).alias("results"), subset.alias("subset"))
    return joins.validated(files, files.where("file = 0"), "results", "subset").select("file", F.size("results").alias("n"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 3 = 0 THEN p_type WHEN l_partkey % 2 = 0 THEN p_name END AS title FROM lineitem JOIN part ON l_partkey = p_partkey")
def fallback_lookups(spark: SparkSession, d: str) -> DataFrame:
    """The first lookup's value, or where it is missing or empty the second's."""
    p = table(spark, d, "part").withColumnRenamed("p_partkey", "l_partkey")
    first = p.where("l_partkey % 5 <> 1 OR l_partkey % 3 = 0").select("l_partkey", F.when(F.col("l_partkey") % 3 == 0, F.col("p_type")).otherwise("").alias("title"))
    second = p.where("l_partkey % 2 = 0").select("l_partkey", F.col("p_name").alias("title"))
    out = joins.fallback_lookup(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), [first, second], ["l_partkey"], "title")
    return out.withColumn("l_partkey", F.col("l_partkey").cast("long"))


@query("SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND c_custkey % 4 <> 0")
def name_join(spark: SparkSession, d: str) -> DataFrame:
    """Names that are equal but for case, blanks and marks."""
    n = table(spark, d, "nation")
    c = table(spark, d, "customer").join(n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("raw")), "c_nationkey")
    name = F.when(F.col("c_custkey") % 4 == 0, " -").otherwise(F.concat(F.lit(" "), F.lower("raw"), F.lit("'-")))
    return joins.name_lookup(c.select("c_custkey", name.alias("name")), n.select("n_name"), "name", "n_name", text.plain_slug).select("c_custkey", "n_name")


@query("SELECT doc_id, CAST(turn AS INTEGER) AS turn, score FROM (SELECT d.doc_id, c.turn, length(c.text) AS score FROM documents d JOIN conversations c ON c.conv_id = d.doc_id)")
def composite_lookup(spark: SparkSession, d: str) -> DataFrame:
    """A lookup by two columns, whose types differ."""
    c = table(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("doc_id"), F.col("turn").cast("double").cast("int").alias("turn"), F.char_length("text").cast("long").alias("score"))
    asked = table(spark, d, "documents").select("doc_id").join(c.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("turn").cast("long").alias("turn")).distinct(), "doc_id")
    return joins.lookup(asked, c, ["doc_id", "turn"]).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("turn").cast("int").alias("turn"), "score")


@query("""SELECT count(*) AS rows, count(*) FILTER (WHERE length(text) < 100) AS short, count(*) FILTER (WHERE lang = 'en') AS english, CAST(0 AS BIGINT) AS missing FROM documents""")
def counters(spark: SparkSession, d: str) -> DataFrame:
    return reshape.tallies(table(spark, d, "documents"), {"rows": F.lit(True), "short": F.char_length("text") < 100, "english": F.col("lang") == "en", "missing": F.col("text").isNull()})


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS index FROM orders")
def index_if_missing(spark: SparkSession, d: str) -> DataFrame:
    o = reshape.numbered(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"])
    return reshape.numbered(o, ["o_orderkey"])


@query("""SELECT o_custkey % 100 AS prompt, CAST(row_number() OVER (PARTITION BY o_custkey % 100, a ORDER BY o_orderkey) - 1 AS INTEGER) AS place, o_orderkey AS model, a AS aspect,
CASE WHEN a = 'honesty' THEN CASE WHEN o_orderkey % 7 BETWEEN 1 AND 5 THEN o_orderkey % 7 END ELSE 4 END::DOUBLE AS rating FROM orders, (SELECT unnest(['honesty', 'instruction_following']) AS a)""")
def nested_ratings(spark: SparkSession, d: str) -> DataFrame:
    """An array of completions, each with a map of ratings by aspect; other aspects and ratings out of range do not count."""
    k = F.col("o_orderkey")
    ratings = F.create_map(F.lit("HONESTY"), (k % 7).cast("string"), F.lit(" Instruction-Following"), F.lit("4"), F.lit("Other"), F.lit("5"))
    o = table(spark, d, "orders").groupBy((F.col("o_custkey") % 100).alias("prompt")).agg(F.sort_array(F.collect_list(F.struct(k.alias("model"), F.to_json(ratings).alias("raw")))).alias("c"))
    o = o.withColumn("c", F.transform("c", lambda x: F.struct(x["model"].alias("model"), F.from_json(x["raw"], "map<string,string>").alias("annotations"))))
    rows = reshape.nested_ratings(o, "c", "annotations", ("honesty", "instruction_following"), text.key_form)
    return rows.select("prompt", "place", "model", "aspect", scoring.rating("rating").alias("rating"))


@query("SELECT event_id, CASE WHEN event_id % 4 IN (0, 2) THEN value WHEN event_id % 4 = 1 THEN -value END AS score FROM events WHERE event_id % 4 <> 3")
def either_key(spark: SparkSession, d: str) -> DataFrame:
    """pass@1 or, where the record has no such key, pass1; records with neither are skipped."""
    k, v = F.col("event_id"), F.col("value")
    both = F.create_map(F.lit("pass@1"), v, F.lit("pass1"), v * 2)
    rec = F.when(k % 4 == 0, both).when(k % 4 == 1, F.create_map(F.lit("pass1"), -v)).when(k % 4 == 2, F.create_map(F.lit("pass@1"), v)).otherwise(F.create_map(F.lit("x"), v))
    return scoring.with_either(table(spark, d, "events").select("event_id", rec.alias("record")), "record", ("pass@1", "pass1"), "score").select("event_id", "score")


@query("SELECT DISTINCT l_returnflag AS flag FROM lineitem")
def sorted_distinct(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_returnflag").alias("flag")).distinct().orderBy("flag")


# --- functions of raw records ------------------------------------------------------------------------------------


@query(f"""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment WHEN c_custkey % 3 = 1 THEN c_name END AS first,
CASE c_custkey % 3 WHEN 0 THEN '[user_task] ' || c_name WHEN 1 THEN '[user_task] ' || c_name || chr(10) || '[injection_task] ' || c_mktsegment END AS pair,
CASE WHEN c_custkey % 5 = 0 THEN 'cust_' || c_custkey ELSE c_name END AS id, CASE WHEN length(c_name || c_mktsegment) >= 28 THEN c_name || chr(10) || c_mktsegment END AS titled,
'20' || (10 + c_custkey % 15) || '-' || lpad(CAST(1 + c_custkey % 12 AS VARCHAR), 2, '0') AS month FROM customer""")
def record_text(spark: SparkSession, d: str) -> DataFrame:
    k, name, seg = F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")
    url = F.concat(F.lit("https://example.org/abs/"), (10 + k % 15).cast("string"), F.lpad((1 + k % 12).cast("string"), 2, "0"), F.lit(".01234"))
    return table(spark, d, "customer").select(
        "c_custkey",
        content.first_text(F.when(k % 3 == 0, seg).otherwise(" \t"), F.when(k % 3 == 1, name)).alias("first"),
        content.tagged_pair(F.when(k % 3 < 2, name), F.when(k % 3 == 1, seg).otherwise("")).alias("pair"),
        content.numbered_id(F.when(k % 5 != 0, name).otherwise(""), F.lit("cust"), "c_custkey").alias("id"),
        content.titled("c_name", "c_mktsegment", 29).alias("titled"),
        text.paper_month(url).alias("month"),
    )


@query("""SELECT p_partkey, '[' || CASE WHEN p_partkey % 2 = 0 THEN p_brand || ', ' || p_type ELSE p_brand END || '] ' || CASE WHEN p_partkey % 3 = 0 THEN p_name || ': ' || p_type ELSE 'difficulty=' || CASE WHEN p_size > 25 THEN 'hard' ELSE '' END || ' | ' || p_name END AS task,
'm-' || p_partkey AS model FROM part WHERE p_partkey % 3 <> 0 OR p_partkey % 2 = 1""")
def task_texts(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    cats = F.when(k % 2 == 0, F.array("p_brand", "p_type")).otherwise(F.array().cast("array<string>"))
    made = content.task_content(cats, "p_brand", F.when(F.col("p_size") > 25, "hard"), "p_name", "p_name", "p_type", k % 3 != 0)
    ends = F.array(*map(F.lit, ("_5shots.json.zip", "_5-shots.zip", "_3shots_1_2_3.zip", ".json.zip")))
    name = F.concat(F.lit("model_outputs_m-"), k.cast("string"), F.get(ends, (k % 4).cast("int")))
    return table(spark, d, "part").where("p_partkey % 3 <> 0 OR p_partkey % 2 = 1").select("p_partkey", made.alias("task"), text.archive_model_name(name).alias("model"))


@query(f"""WITH t AS (SELECT conv_id, string_agg('[' || role || '] ' || text, chr(10) ORDER BY turn) FILTER (WHERE trim(text, {_WS}) <> '') AS x, '[' || string_agg('{{"role":' || to_json(role) || ',"content":' || to_json(text) || '}}', ',' ORDER BY turn) || ']' AS raw,
 arg_min(text, turn) FILTER (WHERE role = 'user' AND trim(text, {_WS}) <> '') AS u, arg_min(text, turn) FILTER (WHERE trim(text, {_WS}) <> '') AS f FROM conversations GROUP BY 1)
SELECT conv_id, CASE WHEN conv_id % 5 = 0 THEN 'plain text' ELSE nullif(substr(x, 1, 8000), '') END AS flat, CASE WHEN conv_id % 5 = 0 THEN 'plain text' ELSE coalesce(u, f) END AS prompt, CASE WHEN conv_id % 5 <> 0 THEN md5(raw) END AS json_md5 FROM t""")
def nested_messages(spark: SparkSession, d: str) -> DataFrame:
    """Messages as JSON: their text at any depth, the prompt of a list or of plain text, and the JSON itself."""
    m = messages(spark, d).withColumn("raw", content.compact_json("messages"))
    plain = F.col("conv_id") % 5 == 0
    deep = F.concat(F.lit("[["), F.col("raw"), F.lit("],[]]"))
    return m.select(
        "conv_id",
        content.nested_text(F.when(plain, '"  plain text "').otherwise(deep)).alias("flat"),
        content.prompt_of(F.when(plain, " plain text ").otherwise(F.col("raw"))).alias("prompt"),
        F.when(~plain, F.md5(F.col("raw"))).alias("json_md5"),
    )


@query("""SELECT event_id, CASE event_id % 6 WHEN 0 THEN 1.0 WHEN 1 THEN 0.0 WHEN 2 THEN 1.0 WHEN 3 THEN NULL WHEN 4 THEN 0.0 ELSE 1.0 END::DOUBLE AS four,
CASE event_id % 6 WHEN 0 THEN 1.0 WHEN 1 THEN 0.0 WHEN 2 THEN 1.0 WHEN 3 THEN 0.0 WHEN 4 THEN 0.0 ELSE 1.0 END::DOUBLE AS ten,
CASE WHEN event_id % 6 = 3 THEN NULL WHEN event_id % 6 IN (0, 2, 5) THEN 1.0 ELSE 0.0 END::DOUBLE AS multi FROM events""")
def choice_scores(spark: SparkSession, d: str) -> DataFrame:
    """The letter that an answer chooses against the right one, by three rules for answers that choose none."""
    k = F.col("event_id")
    said = F.array(*map(F.lit, ("The answer is B.", "**C** it is", "(B) because", "no idea", "A", "Answer: B")))
    p, g = F.get(said, (k % 6).cast("int")), F.lit("B")
    return table(spark, d, "events").select("event_id", scoring.choice_score(p, g).alias("four"), scoring.choice_score_ten(p, F.lit(" b ")).alias("ten"), scoring.free_score(p, g, F.lit("multi_choice")).alias("multi"))


# --- whole builds ------------------------------------------------------------------------------------------------


def _named(star: longform.Star) -> DataFrame:
    """Responses with the labels and raw identifiers that their ids stand for."""
    out = star.responses.join(star.subjects.select("subject_id", "display_name"), "subject_id").join(star.items.select("item_id", "raw_item_id"), "item_id")
    return out.select("display_name", "raw_item_id", "trial", "test_condition", "response")


@query("""WITH c AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS t, text FROM conversations),
j AS (SELECT conv_id, t, m, CASE (conv_id + t + m) % 4 WHEN 0 THEN 7.0 WHEN 1 THEN t + 0.5 WHEN 2 THEN 3.0 END AS response FROM c, (SELECT unnest([0, 1, 1]) AS m))
SELECT 'model ' || m AS display_name, count(*) AS n, sum(response)::DOUBLE AS total, CAST(max(k) AS INTEGER) AS trials, count(DISTINCT x) AS items
FROM (SELECT j.*, trim(c.text, """ + _WS + """) AS x, row_number() OVER (PARTITION BY m, trim(c.text, """ + _WS + """)) AS k FROM j JOIN c USING (conv_id, t) WHERE response IS NOT NULL) GROUP BY 1""")
def build_judged_turns(spark: SparkSession, d: str) -> DataFrame:
    """Judgments and questions as JSON Lines, with scores, marks for none, judgments that name one, and repeated lines."""
    q = messages(spark, d).select(F.col("conv_id").alias("question_id"), F.transform("messages", lambda x: x["content"]).alias("turns"))
    each = q.select("question_id", F.posexplode("turns").alias("p", "x")).select("question_id", (F.col("p") + 1).alias("turn"), F.explode(F.array(F.lit(0), F.lit(1), F.lit(1))).alias("m"))
    kind = (F.col("question_id") + F.col("turn") + F.col("m")) % 4
    score = F.when(kind == 0, 7.0).when(kind == 1, -1.0).when(kind == 3, -1.0)
    judgment = F.when(kind == 1, F.concat(F.lit("so [["), F.col("turn").cast("string"), F.lit(".5]]"))).when(kind == 2, "rated [[3]]").otherwise("no mark")
    base = folder(spark)
    lines(q, f"{base}/questions", "question_id", "turns")
    lines(each, f"{base}/judgments", F.concat(F.lit("model "), F.col("m").cast("string")).alias("model"), "question_id", "turn", score.alias("score"), judgment.alias("judgment"))
    judgments = readers.jsonl(spark, f"{base}/judgments", "model string, question_id long, turn int, score double, judgment string")
    star = builds.judged_turns(judgments, readers.jsonl(spark, f"{base}/questions", "question_id long, turns array<string>").select("question_id", "turns"), "judged")
    out = star.responses.join(star.subjects.select("subject_id", "display_name"), "subject_id")
    return out.groupBy("display_name").agg(F.count("*").alias("n"), F.sum("response").alias("total"), F.max("trial").alias("trials"), F.count_distinct("item_id").alias("items"))


@query("""WITH r AS (SELECT label FROM embeddings WHERE vec_id = 0), e AS (SELECT vec_id, embedding, unnest(range(0, 64)) AS pos FROM embeddings WHERE vec_id % 2 = 0 AND (vec_id % 3 <> 0 OR label = (SELECT label FROM r)))
SELECT 'v' || vec_id AS display_name, 'i' || pos AS raw_item_id, CAST(1 AS INTEGER) AS trial, 'subset=' || (pos % 3) AS test_condition, CAST(embedding[pos + 1] AS DOUBLE) AS response FROM e""")
def build_positional_results(spark: SparkSession, d: str) -> DataFrame:
    """Files by position; those of another length or with other subsets are dropped."""
    k, e = F.col("vec_id"), table(spark, d, "embeddings")
    parts = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: (i % 3).cast("string"))
    first = e.where("vec_id = 0").select("label").first()
    subset = F.when((k % 3 == 0) & (F.col("label") == (first[0] if first else None)), parts).when(k % 3 == 0, F.reverse(parts)).when(k % 3 == 1, F.array().cast("array<string>"))
    files = e.select(F.concat(F.lit("v"), k.cast("string")).alias("label"), F.when(k % 2 == 0, F.col("embedding")).otherwise(F.slice("embedding", 1, 63)).alias("results"), subset.alias("subset"))
    named = lambda mark: F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.concat(F.lit(mark), i.cast("string")))
    reference = e.where("vec_id = 0").select(F.col("embedding").alias("results"), parts.alias("subset"), named("i").alias("ids"), named("text of ").alias("contents"))
    return _named(builds.positional_results(files, reference, "positional"))


@query("""WITH o AS (SELECT o_orderkey % 9 AS k, o_orderstatus AS s, 't' || (o_custkey % 200) AS task FROM orders)
SELECT 'run ' || f.k AS display_name, t.task AS raw_item_id, CAST(1 AS INTEGER) AS trial, CAST(NULL AS VARCHAR) AS test_condition,
CASE WHEN EXISTS (SELECT 1 FROM o WHERE o.k = f.k AND o.s = 'F' AND o.task = t.task) THEN 1.0 ELSE 0.0 END::DOUBLE AS response
FROM (SELECT DISTINCT k FROM o) f, (SELECT DISTINCT task FROM o) t""")
def build_resolved_grid(spark: SparkSession, d: str) -> DataFrame:
    """Lists of resolved tasks, one object a run: every run with every task that any list names."""
    o = table(spark, d, "orders").select(F.pmod(F.col("o_orderkey"), F.lit(9)).alias("k"), F.when(F.col("o_orderstatus") == "F", "resolved").otherwise(F.col("o_orderstatus")).alias("s"), F.concat(F.lit("t"), (F.col("o_custkey") % 200).cast("string")).alias("task"))
    objects = o.groupBy("k", "s").agg(F.collect_set("task").alias("ts")).groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("s", "ts"))).alias("m"))
    path = folder(spark)
    objects.select("k", F.to_json("m").alias("value")).repartition("k").write.partitionBy("k").text(path)
    files = readers.json_object(spark, path, "map<string,array<string>>")
    return _named(builds.resolved_grid(files.select(F.concat(F.lit("run "), F.regexp_extract("file", r"/k=(\d+)/", 1)).alias("label"), "value"), "resolved"))
