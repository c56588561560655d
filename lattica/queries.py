"""The registered queries of the curation engine, each with its SQL for another engine.

They run the library on projections of the driver's tables: returns (lineitem
with supplier and part), events, labelled documents, conversations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema
from .functions import content, scoring, text
from .operators import joins, registry, reshape, select, trials
from .plans import audit, longform

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- projections of the driver's tables --------------------------------------------------------------------------

RETURN_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity"]


def returns(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as subjects, part names as items, the return flag as condition, the quantity as response."""
    line = table(spark, d, "lineitem").select(*RETURN_ORDER, "l_returnflag")
    supplier = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("label"))
    part = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("content"))
    rows = line.join(supplier, "l_suppkey").join(part, "l_partkey")
    return rows.select(F.lit("returns").alias("benchmark_id"), "label", F.col("l_partkey").cast("string").alias("raw_item_id"), "content", F.concat(F.lit("flag="), "l_returnflag").alias("test_condition"), F.col("l_quantity").cast("double").alias("response"), *RETURN_ORDER)


def observed(spark: SparkSession, d: str) -> DataFrame:
    """Users as subjects, event types as items, k as condition where it is 50 or more."""
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "value", F.get_json_object("props", "$.k").cast("int").alias("k"))
    cond = F.when(F.col("k") >= 50, content.condition({"k": "k"}))
    return e.select(F.lit("events").alias("benchmark_id"), F.concat(F.lit("user_"), "user_id").alias("label"), F.col("event_type").alias("content"), cond.alias("test_condition"), F.col("value").cast("double").alias("response"), "event_id")


def event_responses(spark: SparkSession, d: str) -> DataFrame:
    return longform.finalize(observed(spark, d), ["event_id"]).responses


def messages(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    m = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))), lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    return c.groupBy("conv_id").agg(m.alias("messages"))


def rounded(name: str, digits: int = 6):
    return F.round(F.col(name), digits).alias(name)


_WS = "'" + text.WS + "'"
_NFORM = "trim(nfc_normalize({x}), " + _WS + ")"
_H16 = "substr(sha256({x}), 1, 16)"


def _content(x: str) -> str:
    return _NFORM.format(x=x)


def _h16(x: str) -> str:
    return _H16.format(x=x)


def _subject(x: str) -> str:
    return _h16(f"lower({_content(x)})")


def _item(bench: str, x: str) -> str:
    return _h16(f"{bench} || '::' || {_content(x)}")


_RETURNS = """r AS (SELECT 'returns' AS benchmark_id, s_name AS label, p_name AS content, 'flag=' || l_returnflag AS test_condition, l_quantity AS response, l.*
 FROM lineitem l JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)"""
_EVENTS = f"""k AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
e0 AS (SELECT event_id, 'events' AS benchmark_id, 'user_' || user_id AS label, event_type AS content, CASE WHEN k >= 50 THEN 'k=' || k END AS test_condition, value AS response FROM k),
e AS (SELECT *, {_subject("label")} AS subject_id, {_item("'events'", "content")} AS item_id,
  row_number() OVER (PARTITION BY label, content, test_condition ORDER BY event_id) AS trial FROM e0)"""


# --- identity, registry, keys ------------------------------------------------------------------------------------


@query(f"WITH {_RETURNS} SELECT label AS display_name, benchmark_id, test_condition, round(avg(response), 6) AS mean_score, count(*) AS n FROM r GROUP BY ALL")
def leaderboard(spark: SparkSession, d: str) -> DataFrame:
    star = longform.finalize(returns(spark, d), RETURN_ORDER)
    out = audit.leaderboard(star.responses, star.subjects, ("benchmark_id", "test_condition"))
    return out.select("display_name", "benchmark_id", "test_condition", rounded("mean_score"), "n").orderBy("display_name", "benchmark_id", F.col("test_condition").asc_nulls_last())


@query(f"WITH {_RETURNS} SELECT round(avg(response), 6) AS mean_score, count(*) AS n FROM r WHERE label = 'Supplier#000000001'")
def single_model_mean(spark: SparkSession, d: str) -> DataFrame:
    star = longform.finalize(returns(spark, d), RETURN_ORDER)
    return audit.model_mean(star.responses, star.subjects, "Supplier#000000001", "returns").select(rounded("mean_score"), "n")


@query(f"""WITH t AS (SELECT 'documents' AS b, doc_id AS raw_id, text FROM documents UNION ALL SELECT 'benchmark', item_id, text FROM benchmark)
SELECT b AS benchmark_id, raw_id, {_item("b", "coalesce(text, 'raw:' || raw_id)")} AS item_id, {_h16(_content("coalesce(text, 'raw:' || raw_id)"))} AS content_hash FROM t""")
def item_ids(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.lit("documents").alias("benchmark_id"), F.col("doc_id").alias("raw_id"), "text")
    rows = docs.unionByName(table(spark, d, "benchmark").select(F.lit("benchmark").alias("benchmark_id"), F.col("item_id").alias("raw_id"), "text"))
    return rows.select("benchmark_id", "raw_id", text.item_id(F.col("benchmark_id"), "text", "raw_id").alias("item_id"), text.content_hash("text", "raw_id").alias("content_hash"))


_LABELS = "SELECT c_name AS label, c_custkey * 3 AS o FROM customer UNION ALL SELECT '  ' || upper(c_name) || chr(9), c_custkey * 3 + 1 FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_name, c_custkey * 3 + 2 FROM customer"


@query(f"""WITH l AS ({_LABELS}), f AS (SELECT {_subject("label")} AS subject_id, label, min(o) AS o FROM l GROUP BY ALL)
SELECT subject_id, arg_min(label, o) AS display_name, string_agg(label, '|' ORDER BY o) AS labels FROM f GROUP BY subject_id""")
def subject_registry(spark: SparkSession, d: str) -> DataFrame:
    c, key = table(spark, d, "customer"), F.col("c_custkey") * 3
    rows = c.select(F.col("c_name").alias("label"), key.alias("o"))
    rows = rows.union(c.where("c_custkey % 2 = 0").select(F.concat(F.lit("  "), F.upper("c_name"), F.lit("\t")), key + 1)).union(c.select("c_name", key + 2))
    out = registry.build_subjects(rows, "label", "o")
    return out.select("subject_id", "display_name", F.array_join("raw_labels_seen", "|").alias("labels"))


@query(f"""WITH t AS (SELECT doc_id, text, {_item("'docs'", "coalesce(text, 'raw:' || doc_id)")} AS item_id, {_h16(_content("coalesce(text, 'raw:' || doc_id)"))} AS content_hash FROM documents)
SELECT item_id, CAST(min(doc_id) AS VARCHAR) AS raw_item_id, length(arg_min(text, doc_id)) AS n_chars, arg_min(content_hash, doc_id) AS content_hash FROM t GROUP BY item_id""")
def item_registry_first_wins(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(F.lit("docs").alias("benchmark_id"), F.col("doc_id").alias("raw_item_id"), F.col("text").alias("content"), "doc_id")
    return registry.build_items(rows, "doc_id").select("item_id", "raw_item_id", F.char_length("content").cast("long").alias("n_chars"), "content_hash")


@query(f"""WITH t AS (SELECT source AS b, text FROM documents UNION ALL SELECT 'benchmark', text FROM benchmark),
i AS (SELECT DISTINCT b, {_h16(_content("text"))} AS content_hash FROM t WHERE text IS NOT NULL)
SELECT content_hash, count(DISTINCT b) AS benchmarks, count(*) AS items FROM i GROUP BY content_hash HAVING count(DISTINCT b) > 1""")
def content_dupes(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("source").alias("benchmark_id"), F.col("doc_id").alias("raw_item_id"), F.col("text").alias("content"))
    rows = docs.unionByName(table(spark, d, "benchmark").select(F.lit("benchmark").alias("benchmark_id"), F.col("item_id").alias("raw_item_id"), F.col("text").alias("content")))
    return audit.duplicate_items(registry.build_items(rows.where("content is not null"), "raw_item_id"))


@query(f"WITH {_EVENTS} SELECT event_id, CAST(trial AS INTEGER) AS trial FROM e")
def trial_numbers(spark: SparkSession, d: str) -> DataFrame:
    rows = observed(spark, d).withColumns({"subject_id": text.subject_id("label"), "item_id": text.item_id(F.col("benchmark_id"), "content")})
    return trials.assign_trials(rows, ["event_id"]).select("event_id", "trial")


@query(f"""WITH {_EVENTS}, g AS (SELECT subject_id, item_id, trial, test_condition, count(*) AS n FROM e GROUP BY ALL)
SELECT count(*) AS keys, coalesce(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END), 0)::BIGINT AS doubled, sum(n)::BIGINT AS n_rows FROM g""")
def pk_audit(spark: SparkSession, d: str) -> DataFrame:
    r = event_responses(spark, d)
    counted = r.groupBy(*schema.KEY).agg(F.count("*").alias("n"))
    return counted.agg(F.count("*").alias("keys"), F.coalesce(F.sum(F.when(F.col("n") > 1, 1).otherwise(0)), F.lit(0)).cast("long").alias("doubled"), F.sum("n").alias("n_rows"))


@query(f"""WITH {_EVENTS} SELECT benchmark_id, count(*) AS n_rows, count(DISTINCT subject_id) AS subjects, count(DISTINCT item_id) AS items,
round(avg(CASE WHEN response IN (0, 1) THEN 1.0 ELSE 0.0 END), 6) AS binary_share, min(response) AS low, max(response) AS high, CAST(max(trial) AS INTEGER) AS max_trial,
bool_or(test_condition IS NOT NULL) AS has_condition, CAST(0 AS BIGINT) AS pk_dup FROM e GROUP BY benchmark_id""")
def audit_table(spark: SparkSession, d: str) -> DataFrame:
    out = audit.audit(event_responses(spark, d))
    return out.select("benchmark_id", "n_rows", "subjects", "items", rounded("binary_share"), "low", "high", "max_trial", "has_condition", "pk_dup")


@query("""WITH t AS (SELECT source AS benchmark_id, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE text END AS text, doc_id FROM documents),
i AS (SELECT benchmark_id, coalesce(trim(text, """ + _WS + """), 'raw:' || doc_id) AS c, min(doc_id) AS f FROM t GROUP BY ALL)
SELECT benchmark_id, round(avg(CASE WHEN t.text IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS content_share FROM i JOIN t USING (benchmark_id) WHERE t.doc_id = i.f GROUP BY benchmark_id""")
def content_share(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(F.col("source").alias("benchmark_id"), F.col("doc_id").alias("raw_item_id"), F.when(F.col("doc_id") % 7 != 0, F.col("text")).alias("content"), "doc_id")
    return audit.content_share(registry.build_items(rows, "doc_id")).select("benchmark_id", rounded("content_share"))


@query("SELECT DISTINCT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def fk_orphans(spark: SparkSession, d: str) -> DataFrame:
    return joins.orphans(table(spark, d, "documents"), table(spark, d, "labels"), ["doc_id"])


@query("""SELECT 'docs' AS benchmark_id, 'docs' AS name, 'text' AS modality, 'general' AS domain, 'binary' AS response_type, '{0, 1}' AS response_scale, true AS categorical
UNION ALL SELECT 'n' || n_nationkey, n_name, 'text|image', 'medicine|multilingual', 'fraction', 'k/N', false FROM nation""")
def benchmark_defaults(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("benchmark_id"), F.col("n_name").alias("name"), F.array(F.lit("text"), F.lit("image")).alias("modality"), F.array(F.lit("medicine"), F.lit("multilingual")).alias("domain"), F.lit("fraction").alias("response_type"), F.lit("k/N").alias("response_scale"), F.lit(False).alias("categorical"), F.lit(1).alias("o"))
    late = n.withColumn("name", F.lit("late")).withColumn("o", F.lit(2))  # a second registration changes nothing
    bare = spark.range(1).select(F.lit("docs").alias("benchmark_id"), F.lit("").alias("name"), F.array().cast("array<string>").alias("modality"), F.lit(None).cast("array<string>").alias("domain"), F.lit("").alias("response_type"), F.lit(None).cast("string").alias("response_scale"), F.lit(None).cast("boolean").alias("categorical"), F.lit(1).alias("o"))
    out = registry.build_benchmarks(n.unionByName(late).unionByName(bare), "o")
    return out.select("benchmark_id", "name", F.array_join("modality", "|").alias("modality"), F.array_join("domain", "|").alias("domain"), "response_type", "response_scale", "categorical")


@query("""SELECT 'n' || n_nationkey AS benchmark_id, 'domain' AS field, 'multilingual' AS value, 'warning' AS level FROM nation
UNION ALL SELECT 'n' || n_nationkey, 'response_type', n_name, 'error' FROM nation WHERE n_nationkey % 3 = 0
UNION ALL SELECT 'n' || n_nationkey, 'modality', 'smell', 'error' FROM nation""")
def vocabulary_violations(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("n_nationkey") % 3 == 0, F.col("n_name")).otherwise("ordinal")
    b = table(spark, d, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("benchmark_id"), kind.alias("response_type"), F.array(F.lit("audio"), F.lit("smell")).alias("modality"), F.array(F.lit("law"), F.lit("multilingual")).alias("domain"))
    return registry.vocabulary_violations(b)


@query("""WITH c AS (SELECT c_custkey AS k, 'b' || (c_custkey % 3) AS o, c_name FROM customer)
SELECT 'x' || (k % 40) AS subject_id, arg_min(c_name, o || lpad(k::VARCHAR, 9, '0')) AS display_name, string_agg(DISTINCT c_name, '|' ORDER BY c_name) AS labels FROM c GROUP BY 1""")
def registry_merge(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    build = F.concat(F.lit("b"), (k % 3).cast("string"), F.lpad(k.cast("string"), 9, "0")).alias("ord")
    c = table(spark, d, "customer").select(F.concat(F.lit("x"), (k % 40).cast("string")).alias("subject_id"), F.col("c_name").alias("display_name"), F.array("c_name").alias("raw_labels_seen"), build)
    more = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.SUBJECTS.fields if f.name not in c.columns]
    return registry.merge_subjects(c.select("*", *more), "ord").select("subject_id", "display_name", F.array_join(F.array_sort("raw_labels_seen"), "|").alias("labels"))


# --- projections, joins, reshaping -------------------------------------------------------------------------------


@query("""SELECT doc_id, source, 'quality' AS metric, CAST(quality AS DOUBLE) AS response FROM labels JOIN documents USING (doc_id)
UNION ALL SELECT doc_id, source, 'toxic', CAST(toxic AS DOUBLE) FROM labels JOIN documents USING (doc_id) WHERE lang = 'en'""")
def metric_unpivot(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "source", "lang"), "doc_id")
    out = reshape.metrics_to_rows(rows, {"quality": (F.col("quality").isNotNull(), F.col("quality"), {}), "toxic": (F.col("lang") == "en", F.col("toxic"), {})})
    return out.select("doc_id", "source", "metric", "response")


@query("""SELECT p_partkey, category, round(CASE WHEN score > 1 THEN score / 100 ELSE score END, 6) AS score FROM
(SELECT p_partkey, unnest(['p_size', 'p_retailprice']) AS category, unnest([CAST(p_size AS DOUBLE), p_retailprice]) AS score FROM part)""")
def unpivot_melt(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    out = reshape.melt(p, ["p_partkey"], ["p_size", "p_missing", "p_retailprice"], "category", "score")
    return out.select("p_partkey", "category", F.round(scoring.from_percent("score"), 6).alias("score"))


_KINDS = ["click", "error", "purchase", "signup", "view"]


@query("SELECT user_id, " + ", ".join(f"round(avg(CASE WHEN event_type = '{k}' THEN value END), 6) AS \"{k}\"" for k in _KINDS) + " FROM events GROUP BY user_id")
def wide_matrix(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(F.col("user_id").alias("subject_id"), F.col("event_type").alias("item_id"), F.col("value").alias("response"))
    out = reshape.wide_matrix(e, _KINDS)
    return out.select(F.col("subject_id").alias("user_id"), *[rounded(k) for k in _KINDS])


@query("SELECT user_id, count(DISTINCT event_type) AS items, round(sum(m), 6) AS total FROM (SELECT user_id, event_type, avg(value) AS m FROM events GROUP BY ALL) GROUP BY user_id")
def matrix_rows(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(F.col("user_id").alias("subject_id"), F.col("event_type").alias("item_id"), F.col("value").alias("response"))
    total = F.aggregate(F.map_values("responses"), F.lit(0.0), lambda a, x: a + x)
    return reshape.matrix_rows(e).select(F.col("subject_id").alias("user_id"), F.size("responses").cast("long").alias("items"), F.round(total, 6).alias("total"))


@query("""SELECT n_name, event_type, CASE WHEN EXISTS (SELECT 1 FROM events x WHERE x.event_type = t.event_type AND x.user_id = n.n_nationkey) THEN 0.0 ELSE 1.0 END::DOUBLE AS response
FROM nation n, (SELECT DISTINCT event_type FROM events) t""")
def dense_grid(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    grid = joins.dense_grid(table(spark, d, "nation").select("n_nationkey", "n_name"), e.select("event_type").distinct())
    failed = e.select(F.col("user_id").alias("n_nationkey"), "event_type")
    return joins.flagged(grid, failed, ["n_nationkey", "event_type"], present=0.0).select("n_name", "event_type", "response")


@query("""WITH a AS (SELECT c_custkey, c_name, 'a' AS src FROM customer WHERE c_acctbal >= 0), b AS (SELECT c_custkey, upper(c_name) AS c_name, 'b' AS src FROM customer WHERE c_nationkey < 12)
SELECT * FROM a UNION ALL SELECT * FROM b WHERE c_custkey NOT IN (SELECT c_custkey FROM a)""")
def anti_append(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return joins.append_missing(c.where("c_acctbal >= 0").select("c_custkey", "c_name", F.lit("a").alias("src")), c.where("c_nationkey < 12").select("c_custkey", F.upper("c_name").alias("c_name"), F.lit("b").alias("src")), ["c_custkey"])


@query("""SELECT c_custkey, CASE WHEN c_nationkey < 12 THEN CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE upper(c_name) END ELSE c_name END AS c_name FROM customer WHERE c_acctbal >= 0 OR c_nationkey < 12""")
def precedence_merge(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    later = c.where("c_nationkey < 12").select("c_custkey", F.when(F.col("c_mktsegment") != "MACHINERY", F.upper("c_name")).alias("c_name"))
    return joins.prefer(c.where("c_acctbal >= 0").select("c_custkey", "c_name"), later, ["c_custkey"], ["c_name"])


@query("""WITH a AS (SELECT o_custkey % 50 AS m, o_orderkey AS k, 0 AS s FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT o_custkey % 50 AS m, o_orderkey AS k, 1 AS s FROM orders WHERE o_orderstatus = 'O'),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b), n AS (SELECT m, s, count(*) AS n FROM u GROUP BY ALL), w AS (SELECT m, arg_max(s, n * 2 - s) AS s FROM n GROUP BY m)
SELECT m, k FROM u JOIN w USING (m, s)""")
def larger_source(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select((F.col("o_custkey") % 50).alias("m"), F.col("o_orderkey").alias("k"), "o_orderstatus")
    return joins.larger_source([o.where("o_orderstatus = 'F'").drop("o_orderstatus"), o.where("o_orderstatus = 'O'").drop("o_orderstatus")], "m")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name, s_name FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size > 25 JOIN supplier ON l_suppkey = s_suppkey""")
def lookups(spark: SparkSession, d: str) -> DataFrame:
    line = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    part = table(spark, d, "part").where("p_size > 25").select(F.col("p_partkey").cast("string").alias("l_partkey"), "p_name")
    supplier = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    out = joins.lookup(joins.lookup(line, part, ["l_partkey"]), supplier, ["l_suppkey"], "inner")
    return out.select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("long").alias("l_partkey"), F.col("l_suppkey").cast("long").alias("l_suppkey"), "p_name", "s_name")


@query("""WITH u AS (SELECT vec_id, unnest(range(0, len(embedding))) AS pos, embedding FROM embeddings)
SELECT vec_id, CAST(pos AS INTEGER) AS pos, CAST(u.embedding[pos + 1] AS DOUBLE) AS value, CASE WHEN pos < 32 THEN CAST(u.embedding[pos + 33] AS DOUBLE) END AS other FROM u""")
def arrays_align(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("graded"), F.slice("embedding", 33, 32).alias("outputs"))
    out = joins.aligned(e, "graded", "outputs")
    return out.select("vec_id", "pos", F.col("left_value").cast("double").alias("value"), F.col("right_value").cast("double").alias("other"))


@query("""WITH f AS (SELECT embedding AS ref FROM embeddings WHERE vec_id = 0), u AS (SELECT vec_id, unnest(range(0, len(embedding))) AS pos, embedding FROM embeddings)
SELECT vec_id, CAST(pos AS INTEGER) AS pos, CAST(embedding[pos + 1] AS DOUBLE) AS value, 'i' || pos AS id, CAST(ref[pos + 1] AS DOUBLE) AS gold FROM u, f""")
def positional_join(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    ref = e.where("vec_id = 0").select(F.transform("embedding", lambda x, i: F.concat(F.lit("i"), i.cast("string"))).alias("id"), F.col("embedding").alias("gold"))
    out = joins.positional(e.select("vec_id", F.col("embedding").alias("results")), ref, "results", ["id", "gold"])
    return out.select("vec_id", "pos", F.col("value").cast("double").alias("value"), "id", F.col("gold").cast("double").alias("gold"))


@query("SELECT event_id, j.key AS name, CAST(j.value AS VARCHAR) AS value FROM events, json_each(props) j")
def map_explode(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", F.from_json("props", "map<string,string>").alias("m"))
    return reshape.map_to_rows(e, "m", "name", "value")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, judge, place, CASE WHEN most <> 0 THEN round(greatest(0, least(1, points / most)), 6) END AS share FROM
(SELECT *, 'a' AS judge, 0 AS place, l_tax * 10 AS points, l_discount * 10 AS most FROM lineitem UNION ALL SELECT *, 'a', 1, -l_tax, 1.0 FROM lineitem UNION ALL SELECT *, 'b', 0, l_quantity, 25.0 FROM lineitem)""")
def ratio_clip(spark: SparkSession, d: str) -> DataFrame:
    row = lambda p, m: F.struct(p.alias("points"), m.alias("max_points"))
    c = F.col
    line = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.array(row(c("l_tax") * 10, c("l_discount") * 10), row(-c("l_tax"), F.lit(1.0))).alias("first"), F.array(row(c("l_quantity"), F.lit(25.0))).alias("second"))
    out = reshape.judged_criteria(line, {"a": "first", "b": "second", "c": "third"}, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "judge", "place", F.round(scoring.share("points", "max_points"), 6).alias("share"))


@query("SELECT conv_id, turn, CASE WHEN row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1 THEN text END AS trace FROM conversations WHERE role <> 'system'")
def trace_on_first(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").where("role <> 'system'").select("conv_id", "turn", F.col("text").alias("trace"))
    return reshape.trace_on_first(rows, ["conv_id"], ["turn"], "trace")


@query("SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS turn, text FROM conversations")
def turn_rows(spark: SparkSession, d: str) -> DataFrame:
    m = messages(spark, d).select("conv_id", F.transform("messages", lambda x: x["content"]).alias("turns"))
    return reshape.turns_to_rows(m, "turns").select("conv_id", F.col("turn").cast("long").alias("turn"), "text")


@query(f"WITH {_EVENTS} SELECT benchmark_id, round(avg(CASE WHEN event_id % 3 = 0 THEN 1.0 ELSE 0.0 END), 6) AS trace_share FROM e GROUP BY 1")
def trace_sidecar(spark: SparkSession, d: str) -> DataFrame:
    from .sources.sinks import split_traces

    rows = observed(spark, d).withColumn("trace", F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("t"), "event_id")))
    responses, traces = split_traces(longform.finalize(rows, ["event_id"]).responses)
    return audit.trace_share(joins.with_traces(responses, traces)).select("benchmark_id", rounded("trace_share"))


# --- selection, sets ---------------------------------------------------------------------------------------------


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1")
def top_per_group(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return select.first_per_key(o, ["o_custkey"], [F.col("o_totalprice").desc_nulls_last(), "o_orderkey"])


@query("SELECT source, min(doc_id) AS first_doc, arg_min(lang, doc_id) AS first_lang, max(doc_id) AS last_doc, arg_max(lang, doc_id) AS last_lang FROM documents GROUP BY source")
def first_last(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("source", "doc_id", "lang")
    first = select.first_values(docs, ["source"], ["doc_id", "lang"], "doc_id").select("source", F.col("doc_id").alias("first_doc"), F.col("lang").alias("first_lang"))
    return first.join(select.last_values(docs, ["source"], ["doc_id", "lang"], "doc_id").select("source", F.col("doc_id").alias("last_doc"), F.col("lang").alias("last_lang")), "source")


_FILES = """f AS (SELECT c_custkey % 60 AS m, 'f' || lpad(o_orderkey::VARCHAR, 9, '0') AS filename, ['afrimedqa-v2', 'afrimedqa-v1', 'afrimedqa-v2.5', 'unknown', 'medqa'][1 + o_orderkey % 5] AS dataset,
 CASE WHEN o_orderkey % 7 < 3 THEN 'instruct' ELSE 'base' END AS prompt, CAST(o_orderkey % 3 AS INTEGER) AS shots, CAST(floor(o_totalprice / 100) AS BIGINT) AS n_items FROM orders JOIN customer ON o_custkey = c_custkey)"""


@query(f"""WITH {_FILES}, t AS (SELECT *, CASE WHEN dataset LIKE 'afrimedqa%' AND prompt = 'base' AND shots = 0 THEN 0 WHEN dataset LIKE 'afrimedqa%' AND shots = 0 THEN 1
 WHEN dataset = 'unknown' AND prompt = 'base' AND shots = 0 AND n_items >= 2800 THEN 2 END AS tier, CASE dataset WHEN 'afrimedqa-v2' THEN 0 WHEN 'afrimedqa-v1' THEN 1 WHEN 'afrimedqa-v2.5' THEN 2 ELSE 99 END AS p FROM f)
SELECT m AS model_dir, filename, dataset, n_items FROM t WHERE tier IS NOT NULL QUALIFY row_number() OVER (PARTITION BY m ORDER BY tier, CASE WHEN tier = 2 THEN 0 ELSE p END, n_items DESC, filename) = 1""")
def tiered_select(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").join(table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey")), "o_custkey")
    k = F.col("o_orderkey")
    names = F.array(*map(F.lit, ("afrimedqa-v2", "afrimedqa-v1", "afrimedqa-v2.5", "unknown", "medqa")))
    files = o.select((F.col("o_custkey") % 60).alias("model_dir"), F.concat(F.lit("f"), F.lpad(k.cast("string"), 9, "0")).alias("filename"), F.get(names, (k % 5).cast("int")).alias("dataset"), F.when(k % 7 < 3, "instruct").otherwise("base").alias("prompt"), (k % 3).cast("int").alias("shots"), F.floor(F.col("o_totalprice") / 100).cast("long").alias("n_items"))
    return select.primary_files(files).select("model_dir", "filename", "dataset", "n_items")


@query("""WITH n AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL), b AS (SELECT lang, source FROM n QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, source) = 1)
SELECT doc_id, lang, source FROM documents JOIN b USING (lang, source)""")
def fullest_file(spark: SparkSession, d: str) -> DataFrame:
    return select.fullest(table(spark, d, "documents").select("doc_id", "lang", "source"), ["lang"], "source").select("doc_id", "lang", "source")


@query("SELECT source, count(*) AS items FROM documents GROUP BY source ORDER BY items DESC, source LIMIT 10")
def top_benchmarks(spark: SparkSession, d: str) -> DataFrame:
    return select.top_n(table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("items")), "items", 10, "source")


@query("""SELECT 'union' AS op, count(*) AS n FROM (SELECT c_custkey FROM customer UNION SELECT o_custkey FROM orders)
UNION ALL SELECT 'intersect', count(*) FROM (SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders)
UNION ALL SELECT 'except', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)
UNION ALL SELECT 'all', (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders)""")
def set_ops(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "customer").select(F.col("c_custkey").alias("k")), table(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    parts = {"union": a.union(b).distinct(), "intersect": a.intersect(b), "except": a.join(b, "k", "left_anti"), "all": a.union(b)}
    out = None
    for name, df in parts.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("op"), "n")
        out = one if out is None else out.unionByName(one)
    return out


# --- scalar functions --------------------------------------------------------------------------------------------

_SP = "[" + "".join(f"\\x{{{c:x}}}" for c in text.SPACE_POINTS) + "]"
_NW = r"[^\p{L}\p{N}_]"


@query(f"""WITH t AS (SELECT doc_id, trim(text, {_WS}) AS x FROM documents)
SELECT doc_id, coalesce(CASE WHEN upper(x) IN ('A', 'B', 'C', 'D') THEN upper(x) END,
 nullif(upper(regexp_extract(x, '(?i)answer{_SP}*(?:is|:){_SP}*([A-D])(?:$|{_NW})', 1)), ''), nullif(regexp_extract(x, '\\*\\*([A-D])(?:$|{_NW})', 1), ''),
 nullif(regexp_extract(x, '^[({_SP[1:-1]}]*([A-D])[.):{_SP[1:-1]}]', 1), ''), nullif(regexp_extract(x, '(?:^|{_NW})([A-D])(?:$|{_NW})', 1), '')) AS letter FROM t""")
def mcq_letter_4(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", scoring.choice_letter("text").alias("letter"))


@query(f"""WITH t AS (SELECT doc_id, trim(text, {_WS}) AS x FROM documents), s AS (SELECT doc_id, x, regexp_replace(x, '({_NW})', '\\1\\1', 'g') AS y FROM t)
SELECT doc_id, coalesce(CASE WHEN regexp_full_match(x, '[A-J]') THEN x END, nullif(upper(regexp_extract(x, '(?i)answer is{_SP}*\\(?([A-J])', 1)), ''),
 list_last(regexp_extract_all(y, '(?:^|{_NW})([A-J])(?:$|{_NW})', 1))) AS letter FROM s""")
def mcq_letter_10(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", scoring.choice_letter_ten("text").alias("letter"))


@query("""WITH t AS (SELECT event_id, 'about ' || event_id % 13 || ' apples' AS p, CASE WHEN event_id % 5 = 0 THEN 'apples' WHEN event_id % 5 = 1 THEN 'pears' ELSE CAST(event_id % 17 AS VARCHAR) || '.0' END AS g FROM events)
SELECT event_id, CASE WHEN try_cast(g AS DOUBLE) IS NOT NULL THEN CASE WHEN abs(try_cast(regexp_extract(p, '([-+]?\\d*\\.?\\d+)', 1) AS DOUBLE) - try_cast(g AS DOUBLE)) < 1e-6 THEN 1.0 ELSE 0.0 END
 ELSE CASE WHEN contains(p, g) THEN 1.0 ELSE 0.0 END END::DOUBLE AS score FROM t""")
def numeric_score(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    gold = F.when(k % 5 == 0, "apples").when(k % 5 == 1, "pears").otherwise(F.concat((k % 17).cast("string"), F.lit(".0")))
    e = table(spark, d, "events").select("event_id", F.concat(F.lit("about "), (k % 13).cast("string"), F.lit(" apples")).alias("prediction"), gold.alias("answer"))
    return e.select("event_id", scoring.free_score("prediction", "answer").alias("score"))


@query("""WITH t AS (SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN -1.0 WHEN 1 THEN NULL ELSE 4.0 END::DOUBLE AS s, CASE WHEN conv_id % 4 = 0 THEN text ELSE text || ' [[' || turn || '.5]]' END AS j FROM conversations)
SELECT conv_id, turn, coalesce(CASE WHEN s = -1 THEN NULL ELSE s END, try_cast(nullif(regexp_extract(j, '\\[\\[(\\d+(?:\\.\\d+)?)\\]\\]', 1), '') AS DOUBLE)) AS score FROM t""")
def judge_fallback(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    s = F.when(F.col("turn") % 3 == 0, -1.0).when(F.col("turn") % 3 == 2, 4.0)
    j = F.when(F.col("conv_id") % 4 == 0, F.col("text")).otherwise(F.concat("text", F.lit(" [["), F.col("turn").cast("string"), F.lit(".5]]")))
    return c.select("conv_id", "turn", scoring.judge_score(s, j).alias("score"))


@query(f"""WITH t AS (SELECT * FROM conversations WHERE text IS NOT NULL AND trim(text, {_WS}) <> '')
SELECT conv_id, coalesce(arg_min(text, turn) FILTER (WHERE role = 'user'), arg_min(text, turn)) AS prompt, coalesce(arg_min(text, turn) FILTER (WHERE role = 'assistant'), arg_max(text, turn)) AS reply FROM t GROUP BY conv_id""")
def first_user_msg(spark: SparkSession, d: str) -> DataFrame:
    return messages(spark, d).select("conv_id", content.user_prompt("messages").alias("prompt"), content.assistant_reply("messages").alias("reply"))


@query("""WITH t AS (SELECT event_id, 'type=' || event_type || '|user=' || user_id AS tc FROM events)
SELECT event_id, tc AS test_condition, regexp_extract(tc, 'type=([^|]*)', 1) AS kind, regexp_extract(tc, 'user=([^|]*)', 1) AS who FROM t""")
def condition_map(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", content.condition({"type": "event_type", "user": "user_id"}).alias("test_condition"))
    m = content.condition_map("test_condition")
    return e.select("event_id", "test_condition", F.try_element_at(m, F.lit("type")).alias("kind"), F.try_element_at(m, F.lit("user")).alias("who"))


@query(f"""SELECT doc_id, CASE WHEN length(text) <= 4000 THEN nullif(text, '') ELSE substr(text, 1, 3985) || chr(10) || '...[truncated]' END AS marked, substr(text, 1, 1500) AS cut, substr(nullif(trim(text, {_WS}), ''), 1, 100) AS stripped FROM documents""")
def truncate_marker(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.cut_marked("text", 4000).alias("marked"), text.cut("text", 1500).alias("cut"), text.strip_cut("text", 100).alias("stripped"))


@query("""SELECT p_partkey, substr(p_name || chr(10) || chr(10) || 'A: ' || p_brand || chr(10) || 'B: ' || p_type || CASE WHEN p_size > 25 THEN chr(10) || 'C: ' || p_size ELSE '' END, 1, 4000) AS choice,
p_name || chr(10) || chr(10) || 'A) ' || p_brand || chr(10) || 'B) ' || p_type AS listed FROM part""")
def option_content(spark: SparkSession, d: str) -> DataFrame:
    options = {"A": "p_brand", "B": "p_type", "C": F.when(F.col("p_size") > 25, F.col("p_size")), "D": F.lit(None).cast("string")}
    return table(spark, d, "part").select("p_partkey", content.choice_content("p_name", options).alias("choice"), content.listed_content("p_name", F.array("p_brand", "p_type"), mark=") ").alias("listed"))


@query("""WITH t AS (SELECT page_id, ['m_afrimed-qa-v2.5_mcq_instruct-prompt_5-shot.csv', 'm_medqa_mcq.csv', 'm_saq.csv', 'X_MCQ_afrimed-qa_3shot.CSV', 'z_mcq.txt', 'q_mcq_instruct_0shot.csv'][1 + page_id % 6] AS f FROM pages)
SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'afrimedqa-v2.5' WHEN 1 THEN 'medqa' WHEN 3 THEN 'afrimedqa-v1' WHEN 5 THEN 'unknown' END AS dataset,
 CASE page_id % 6 WHEN 0 THEN 'instruct' WHEN 1 THEN 'base' WHEN 3 THEN 'base' WHEN 5 THEN 'instruct' END AS prompt, CAST(CASE page_id % 6 WHEN 0 THEN 5 WHEN 1 THEN 0 WHEN 3 THEN 3 WHEN 5 THEN 0 END AS INTEGER) AS shots FROM t""")
def filename_classify(spark: SparkSession, d: str) -> DataFrame:
    names = F.array(*map(F.lit, ("m_afrimed-qa-v2.5_mcq_instruct-prompt_5-shot.csv", "m_medqa_mcq.csv", "m_saq.csv", "X_MCQ_afrimed-qa_3shot.CSV", "z_mcq.txt", "q_mcq_instruct_0shot.csv")))
    c = text.result_file_class(F.get(names, (F.col("page_id") % 6).cast("int")))
    return table(spark, d, "pages").select("page_id", c["dataset"].alias("dataset"), c["prompt"].alias("prompt"), c["shots"].alias("shots"))


@query("""SELECT p_partkey, lower(regexp_replace(p_type, '[\\s\\-''"]', '', 'g')) AS plain, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS bare,
 translate(lower(p_brand || ' x-y'), '- ', '__') AS key_form FROM part""")
def slugs(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select("p_partkey", text.plain_slug("p_type").alias("plain"), text.bare_slug(F.concat(F.lit("[Very Easy] "), (F.col("p_partkey") % 9).cast("string"), F.lit("-"), "p_name")).alias("bare"), text.key_form(F.concat(F.lit(" "), "p_brand", F.lit(" x-y\t"))).alias("key_form"))


@query("""SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 0.0 WHEN 1 THEN (s_suppkey % 4) / 5.0 ELSE NULL END::DOUBLE AS fraction, CASE WHEN s_suppkey % 2 = 0 THEN s_name || ' (guard)' ELSE s_name || '-other' END AS label,
 CASE WHEN s_suppkey % 4 = 0 THEN 'first' ELSE s_name END AS renamed, CASE WHEN s_suppkey % 2 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS yes, CASE WHEN s_suppkey % 6 BETWEEN 1 AND 5 THEN s_suppkey % 6 END::DOUBLE AS rating, CAST(trunc(s_acctbal) AS INTEGER) AS whole FROM supplier""")
def small_scalars(spark: SparkSession, d: str) -> DataFrame:
    k, s = F.col("s_suppkey"), table(spark, d, "supplier")
    frac = F.when(k % 3 == 0, "X").when(k % 3 == 1, F.concat((k % 4).cast("string"), F.lit("/5"))).otherwise("3/0")
    name = F.concat("s_name", F.when(k % 2 == 0, "-guard").otherwise("-other"))
    return s.select(
        "s_suppkey",
        scoring.fraction(frac).alias("fraction"),
        text.suffix_label(name, ("guard", "filter")).alias("label"),
        text.renamed(F.when(k % 4 == 0, "alias").otherwise(F.col("s_name")), {"alias": "first"}).alias("renamed"),
        scoring.yes(F.when(k % 2 == 0, " Yes ").when(k % 5 == 0, F.lit(None)).otherwise("no")).alias("yes"),
        scoring.rating((k % 6).cast("string")).alias("rating"),
        scoring.whole(F.col("s_acctbal")).alias("whole"),
    )


# --- aggregates, catalog -----------------------------------------------------------------------------------------


@query(f"""WITH {_EVENTS} SELECT test_condition, count(*) AS n, round(avg(response), 6) AS mean, round(stddev_samp(response), 6) AS std, max(response) AS high, count(DISTINCT subject_id) AS subjects FROM e WHERE test_condition IS NOT NULL GROUP BY 1""")
def group_stats(spark: SparkSession, d: str) -> DataFrame:
    return audit.condition_stats(event_responses(spark, d)).select("test_condition", "n", rounded("mean"), rounded("std"), "high", "subjects")


@query(f"WITH {_EVENTS} SELECT subject_id, item_id, round(avg(response), 6) AS pass_rate, count(*) AS n FROM e GROUP BY 1, 2")
def pass_rate(spark: SparkSession, d: str) -> DataFrame:
    return audit.pass_at(event_responses(spark, d)).select("subject_id", "item_id", rounded("pass_rate"), "n")


@query(f"""WITH {_RETURNS}, v AS (SELECT s_nationkey AS b, l_returnflag AS variant, count(DISTINCT l_suppkey) AS subjects, count(DISTINCT l_partkey) AS items FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
g AS (SELECT b, max(items) AS most, sum(items) AS a, sum(subjects * items) AS c, count(*) AS m FROM v GROUP BY b)
SELECT count(*) AS benchmarks, sum(most)::BIGINT AS unique_items, sum(a)::BIGINT AS all_items, sum(c)::BIGINT AS cells, sum(m)::BIGINT AS matrices FROM g""")
def catalog_totals(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").join(table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("benchmark_id")), "l_suppkey")
    v = rows.groupBy("benchmark_id", F.col("l_returnflag").alias("variant")).agg(F.count_distinct("l_suppkey").alias("subjects"), F.count_distinct("l_partkey").alias("items"))
    return audit.catalog_totals(v)


@query("SELECT doc_id, source FROM documents WHERE source IN ('src1', 'src4', 'src9')")
def public_subset(spark: SparkSession, d: str) -> DataFrame:
    from .sources.readers import manifest

    lines = "".join(f"  src{i}:\n    domain: ''\n    release: {'public' if i in (1, 4, 9) else 'private'}\n" for i in range(12))
    return audit.public(table(spark, d, "documents").select("doc_id", "source"), manifest(spark, "datasets:\n" + lines), "source")


@query(f"WITH {_RETURNS} SELECT benchmark_id, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS correct_answer, round(avg(response), 6) AS mean_score, count(*) AS n FROM r WHERE l_returnflag <> 'N' GROUP BY ALL")
def gold_scores(spark: SparkSession, d: str) -> DataFrame:
    rows = returns(spark, d).withColumn("correct_answer", F.when(F.col("test_condition") != "flag=N", F.substring("test_condition", 6, 9)))
    star = longform.finalize(rows, RETURN_ORDER)
    return audit.scored_without_items(star.responses).select("benchmark_id", "correct_answer", rounded("mean_score"), "n")


@query("SELECT event_type AS benchmark_id, count(*) AS n FROM events WHERE event_type < 'p' GROUP BY 1")
def model_family(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(F.col("event_type").alias("benchmark_id"), "event_id")
    b = e.select("benchmark_id").distinct().withColumn("categorical", F.col("benchmark_id") < "p")
    return audit.for_model_family(e, b, categorical=True).groupBy("benchmark_id").agg(F.count("*").alias("n"))


@query(f"WITH {_EVENTS} SELECT subject_id, count(*) AS n, count(DISTINCT item_id) AS items, round(avg(response), 4) AS mean_score, sum(CASE WHEN test_condition IS NULL THEN 1 ELSE 0 END)::BIGINT AS unconditioned FROM e GROUP BY 1")
def subject_summary(spark: SparkSession, d: str) -> DataFrame:
    r = event_responses(spark, d)
    out = r.groupBy("subject_id").agg(F.count("*").alias("n"), F.count_distinct("item_id").alias("items"), F.avg("response").alias("mean_score"), F.sum(F.when(F.col("test_condition").isNull(), 1).otherwise(0)).alias("unconditioned"))
    return out.select("subject_id", "n", "items", rounded("mean_score", 4), "unconditioned")


def _all() -> None:
    from . import raw_queries  # noqa: F401  registers its own


def queries() -> dict[str, Query]:
    _all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _all()
    return dict(_SQL)
