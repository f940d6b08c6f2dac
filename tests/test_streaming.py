"""The streaming twins give what the batch operators give."""

import datetime as dt

from pyspark.sql import functions as F

from vaglio.operators.history import error_streaks
from vaglio.operators.incremental import ChangeFeed
from vaglio.streaming.state import changed_pages, streaks


def test_streaks_of_a_file_stream(spark, tmp_path):
    rows = [("s", i, "error" if i % 4 else "ok") for i in range(10)]
    for k in (0, 5):
        spark.createDataFrame(rows[k : k + 5], "source_id string, seq int, status string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        query = streaks(spark.readStream.schema("source_id string, seq int, status string").parquet(f"{tmp_path}/in")).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/check").option("path", f"{tmp_path}/out").trigger(availableNow=True).start()
        query.awaitTermination()
    got = sorted((r.seq, r.streak) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    want = sorted((r.seq, r.streak) for r in error_streaks(spark.createDataFrame(rows, "source_id string, seq int, status string")).collect())
    assert got == want


def test_an_outcome_that_comes_late_is_put_in_its_place(spark, tmp_path):
    for part in ([(1, "error"), (3, "error")], [(2, "ok"), (4, "error")]):
        spark.createDataFrame([("s", q, x) for q, x in part], "source_id string, seq int, status string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        query = streaks(spark.readStream.schema("source_id string, seq int, status string").parquet(f"{tmp_path}/in")).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/check").option("path", f"{tmp_path}/out").trigger(availableNow=True).start()
        query.awaitTermination()
    assert sorted((r.seq, r.streak) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [(1, 1), (2, 0), (3, 1), (3, 2), (4, 2)]


def test_changed_pages_are_handled_once(spark, tmp_path):
    schema = "candidate_id bigint, source_id string, url string, text string, fetched_at timestamp_ntz, arrived_at timestamp_ntz"
    sources = spark.createDataFrame([("s", "https://h.ex/", None)], "id string, url string, list_url string")
    feed, handled = ChangeFeed(spark, f"file://{tmp_path}/feed"), []
    at = dt.datetime(2026, 5, 1)
    for part in ([(1, "s", "/a", "x", at, at), (2, "s", "/b", "y", at, at)], [(3, "s", "/a", " x ", at, at), (4, "s", "/b", "z", at + dt.timedelta(1), at)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        query = changed_pages(stream, sources, feed, lambda d: handled.extend(r.candidate_id for r in d.orderBy(F.col("candidate_id")).collect())).option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
        query.awaitTermination()
    assert handled == [1, 2, 4]
