from lattica.operators import trials
from lattica.streaming import ingest


def test_incremental_ingest(spark, tmp_path):
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    row = lambda o, r: ("s", "i", "b", None, r, None, None, o)
    spark.createDataFrame([row(1, 0.0), row(2, 1.0)], ingest.OBSERVATIONS).write.parquet(f"{src}", mode="append")
    ingest.ingest(spark, src, out, ck).awaitTermination()
    spark.createDataFrame([row(1, 0.5)], ingest.OBSERVATIONS).write.parquet(f"{src}", mode="append")
    ingest.ingest(spark, src, out, ck).awaitTermination()
    rows = ingest.number_history(spark, out)
    assert sorted((r["trial"], r["response"]) for r in rows.collect()) == [(1, 0.0), (2, 1.0), (3, 0.5)]
    assert trials.key_duplicates(rows).count() == 0
