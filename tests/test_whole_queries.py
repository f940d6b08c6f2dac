"""Queries that take all rows of their tables, against brute force on small tables."""

import datetime as dt

import __spark_entry__ as entry

T = dt.datetime(2026, 5, 1, 6)


def tables(spark, root, **rows):
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def test_link_candidates_reads_the_list_of_every_run(spark, tmp_path):
    seen = [(i, run, "s" if run < 3 else "z", pos, f"/b/{i}", f"T & {i}" if i % 4 else None) for i, (run, pos) in enumerate([(1, 2), (1, 1), (2, 1), (2, 1), (2, 3), (3, 1), (4, 1), (4, 2)])]
    root = tables(
        spark, tmp_path,
        candidates=(seen, "candidate_id bigint, run_id bigint, source_id string, pos int, url string, title string"),
        sources=([("s", "https://h.ex/", "https://h.ex/l"), ("z", "https://z.ex/", None)], "id string, url string, list_url string"),
        scan_runs=([(1, "s", 1), (2, "s", 2), (3, "z", 1), (4, "z", 2)], "run_id bigint, source_id string, seq int"),
    )
    want = set()
    for run in (1, 2, 3, 4):
        for k, (_, _, s, _, url, title) in enumerate(sorted((r for r in seen if r[1] == run), key=lambda r: (r[3], r[0]))):
            want.add((str(run), k, f"https://{'h' if s == 's' else 'z'}.ex{url}", title, "ok"))
    got = [tuple(r) for r in entry.queries()["link_candidates"](spark, root).select("list_id", "pos", "url", "title", "status").collect()]
    assert len(got) == len(seen) and set(got) == want


def test_grant_upsert_takes_every_grant(spark, tmp_path):
    d = dt.timedelta(1)
    # url_hash, found_at, last_seen_at; the newest run began at T
    seen = [
        ("a", T - 2 * d, T - d), ("b", T - 2 * d, T + d), ("c", T + d, T + d), ("d", None, None), ("e", T + d, None), ("f", T + d, T - d), ("g", T - d, None),
        ("h", T - 3 * d, T - 2 * d), ("h", T - 2 * d, T - d), ("h", T + d, T + 2 * d), ("h", T, T + d), (None, T - d, T - d), ("i", None, T),
    ]
    grants = [(i, u, f"s{i}", f"t{i}" if i != 9 else None, f, l, None) for i, (u, f, l) in enumerate(seen, 1)]
    schema = "grant_id bigint, url_hash string, source_id string, title string, found_at timestamp_ntz, last_seen_at timestamp_ntz, duplicate_of bigint"
    runs = [(1, "s", T - d), (2, "s", T), (3, "z", None)]
    root = tables(spark, tmp_path, grants=(grants, schema), scan_runs=(runs, "run_id bigint, source_id string, started_at timestamp_ntz"))
    old = lambda g: g[4] is None or g[4] < T
    new = lambda g: not old(g) or (g[5] is not None and g[5] >= T)
    order = lambda g: (g[5] is not None, g[5] or T, g[0])
    want = {}
    for u in {g[1] for g in grants}:
        o, n = (max((g for g in grants if g[1] == u and side(g)), key=order, default=None) for side in (old, new))
        assert o or n
        pick = lambda k, first=False: next((g[k] for g in ((o, n) if first else (n, o)) if g and g[k] is not None), None)  # noqa: B023, E731
        want[u] = (pick(2), pick(3), pick(4, True), pick(5), o is None)
    got = {r.url_hash: (r.source_id, r.title, r.found_at, r.last_seen_at, r.is_new) for r in entry.queries()["grant_upsert"](spark, root).collect()}
    assert got == want
    assert [u for u, row in sorted(want.items(), key=str) if row[4]] == ["c", "e", "f"]


def test_grant_upsert_without_runs_keeps_all(spark, tmp_path):
    grants = [(i, f"u{i}", "s", "t", T, T, None) for i in range(1, 8)]
    schema = "grant_id bigint, url_hash string, source_id string, title string, found_at timestamp_ntz, last_seen_at timestamp_ntz, duplicate_of bigint"
    root = tables(spark, tmp_path, grants=(grants, schema), scan_runs=([], "run_id bigint, source_id string, started_at timestamp_ntz"))
    assert {(r.url_hash, r.is_new) for r in entry.queries()["grant_upsert"](spark, root).collect()} == {(g[1], False) for g in grants}
