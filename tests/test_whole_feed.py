"""Late rows and marks of the change feed."""

import datetime as dt

from vaglio.functions.text import content_hash
from vaglio.functions.urls import canonical_url, url_hash
from vaglio.operators import incremental
from pyspark.sql import functions as F

T = dt.datetime(2026, 5, 1, 6)
H = dt.timedelta(hours=1)


def sources(spark):
    return spark.createDataFrame([("s", "https://h.ex/", None), ("z", "https://z.ex/", None)], "id string, url string, list_url string")


def rows(spark, data):
    return spark.createDataFrame(data, "candidate_id bigint, source_id string, url string, text string, fetched_at timestamp_ntz, arrived_at timestamp_ntz")


def marks(spark, **at):
    return spark.createDataFrame(list(at.items()), "source_id string, reread_from timestamp_ntz")


def ids(pending):
    return sorted(r.candidate_id for r in pending.collect())


def test_a_late_older_row_is_not_taken_for_the_newest(spark, tmp_path):
    feed = incremental.ChangeFeed(spark, f"file://{tmp_path}/feed")
    first = [(1, "s", "/p", "new", T + 5 * H, T + 5 * H), (2, "s", "/q", "a", T, T), (6, "s", "/r", "x", T + 2 * H, T + 2 * H), (7, "z", "/p", "y", T, T)]
    feed.commit(feed.pending(rows(spark, first), sources(spark)), marks(spark, s=T + 6 * H, z=None))
    assert feed.state() == {"epoch": 1, "epochs": [1], "marks": {"s": "2026-05-01 12:00:00"}}
    # arrived after the mark: an older version of p, a newer one of q, q's again, and one as old as r's with a greater number
    late = [(3, "s", "/p", "old", T + H, T + 8 * H), (4, "s", "/q", "b", T + 7 * H, T + 7 * H), (8, "s", "/r", "w", T + 2 * H, T + 9 * H), (9, "z", "/p", "z", T + H, T + H)]
    again = incremental.ChangeFeed(spark, f"file://{tmp_path}/feed")
    # the committed marks keep the first rows of s out; z has none
    unread = [(10, "s", "/u", "u", T, T + H)]
    due = again.pending(rows(spark, first + late + unread), sources(spark))
    assert ids(due) == [4, 9]
    again.commit(due)
    assert again.state()["marks"] == {"s": "2026-05-01 12:00:00"}
    everything = incremental.newest_version(incremental.page_versions(rows(spark, first + late), sources(spark)))
    key = lambda d: {(r.source_id, bytes(r.page), bytes(r.version), r.candidate_id) for r in d.collect()}
    assert key(again.ledger()) == key(everything)


def test_an_unchanged_newer_row_moves_its_time(spark, tmp_path):
    feed = incremental.ChangeFeed(spark, f"file://{tmp_path}/feed")
    for data, want in (([(1, "s", "/p", "a", T, T)], [1]), ([(2, "s", "/p", " a ", T + 4 * H, T + 4 * H)], []), ([(3, "s", "/p", "b", T + 2 * H, T + 9 * H)], []), ([(4, "s", "/p", "b", T + 5 * H, T + 9 * H)], [4]), ([(5, "s", "/p", "a", T + 6 * H, T + 9 * H)], [5])):
        due = feed.pending(rows(spark, data), sources(spark))
        assert ids(due) == want
        feed.commit(due)


def test_pending_pages_with_marks_leaves_out_rows_before_the_snapshot(spark):
    page = spark.createDataFrame([("https://h.ex/p", "new")], "u string, t string").select(url_hash(canonical_url(F.col("u"))).alias("u"), content_hash(F.col("t")).alias("t")).first()
    snapshots = spark.createDataFrame([("s", page.u, page.t, T + 5 * H)], "source_id string, url_hash string, content_hash string, last_seen_at timestamp_ntz")
    data = [(1, "s", "/p", "new", T + 5 * H, T + 5 * H), (2, "s", "/p", "old", T, T + 8 * H), (3, "s", "/q", "a", T, T + 8 * H)]
    mark = marks(spark, s=T + 6 * H)
    assert ids(incremental.pending_pages(rows(spark, data), sources(spark), snapshots, mark)) == [3]
    assert ids(incremental.pending_pages(rows(spark, data + [(4, "s", "/p", "b", T + 7 * H, T + 8 * H)]), sources(spark), snapshots, mark)) == [3, 4]
