"""The composed flows on small fixtures: nulls, repeats, empty tables, columns with clashing names."""

import datetime as dt

from pyspark.sql import functions as F

from vaglio.functions import html, values
from vaglio.operators import flow, history, merge, scan
from vaglio.sources import readers

T = dt.datetime(2026, 5, 1, 6)
PAGE = "url string, method string, status int, html string, rendered_html string, counted string"


def test_character_references_are_read(spark):
    text = "Attivit&agrave; &#232; l&rsquo;ente &euro; 5 &copy 2020 &bogus; &#x1F600;"
    row = spark.createDataFrame([(text,), (None,)], "x string").select(html.unescape(F.col("x")).alias("y")).collect()
    assert [r.y for r in row] == ["Attività è l’ente € 5 © 2020 &bogus; 😀", None]


def test_noise_that_nests_or_stays_open(spark):
    pages = ["<body><nav><nav>x</nav>y</nav><p>z</p></body>", "<body><p>a</p><form><b>in</b>", "<body><p>a</p></form><b>c</b></body>", ""]
    got = [r.t for r in spark.createDataFrame(list(enumerate(pages)), "i int, x string").select("i", html.visible_text(F.col("x")).alias("t")).orderBy("i").collect()]
    assert got == ["z", "a", "a\nc", ""]


def test_unclosed_items_and_places():
    page = "<ul><li><a href=/1>u</a><li><a href=/2>d</a><li><a href=/3>t</a></ul>"
    assert [h for h, _ in html.links(page, "li:nth-child(2n+1) > a")] == ["/1", "/3"]
    assert [h for h, _ in html.links(page, "li:last-child a, li:nth-last-child(3) a")] == ["/1", "/3"]


def test_fetched_counts_answers_and_heeds_robots(spark):
    pages = spark.createDataFrame([("https://h.ex/a", "GET", 200, "A", None, "x"), ("https://h.ex/b", "GET", 404, "B", None, "x"), ("https://h.ex/c", "GET", None, None, None, "x"), ("https://h.ex/a", "POST", 200, "P", None, "x"), ("https://n.ex/a", "GET", 200, "N", None, "x")], PAGE)
    asked = spark.createDataFrame([(1, "https://h.ex/a#x", None), (2, "https://h.ex/b", None), (3, "https://h.ex/c", None), (4, "https://h.ex/a", "post"), (5, "https://n.ex/a", None), (6, "https://h.ex/zz", None), (7, None, None)], "k int, url string, method string")
    robots = spark.createDataFrame([("N.ex", False), ("h.ex", True)], "domain string, allowed boolean")
    got = {r.k: (r.html, r.counted) for r in scan.fetched(asked, pages.drop("counted"), robots).collect()}
    assert got == {1: ("A", True), 2: (None, True), 3: (None, False), 4: ("P", True), 5: (None, False), 6: (None, False), 7: (None, False)}


def test_capped_reads_pages_until_there_are_enough(spark):
    rows = [("l", p, i, f"u{p}-{i}" if i else "same", None) for p in (1, 2, 3) for i in range(4)] + [("m", 1, 0, "x", "t")]
    got, counts = scan.capped(spark.createDataFrame(rows, "list_id string, page_no int, pos int, url string, title string"), 6)
    assert [r.url for r in got.where("list_id = 'l'").orderBy("pos").collect()] == ["same", "u1-1", "u1-2", "u1-3", "u2-1", "u2-2"]
    assert {r.list_id: (r.candidates, r.capped) for r in counts.collect()} == {"l": (6, True), "m": (1, False)}


def _pager(spark, most):
    """Pages of a list, each with a link to the next one, of which each holds two items."""
    item = "<ul><li><a href='/b/x/{0}-1'>a</a></li><li><a href='/b/x/{0}-2'>b</a></li></ul>"
    rows = [(f"https://h.ex/l?p={k}", "GET", 200, item.format(k) + f"<a rel=next href='/l?p={k + 1}'>avanti</a>", None) for k in range(1, most + 1)]
    return spark.createDataFrame(rows, "url string, method string, status int, html string, rendered_html string")


def test_only_pages_that_a_walk_reaches_are_parsed(spark, monkeypatch):
    parsed = []
    links = scan.pages.next_links
    monkeypatch.setattr(scan.pages, "next_links", lambda rows, keep=(): parsed.extend(r.url for r in rows.select("url").collect()) or links(rows, keep))
    lists = spark.createDataFrame([("a", "https://h.ex/l?p=38", "li", False), ("b", "https://h.ex/l?p=39", "li", False)], "list_id string, url string, selector string, rendered boolean")
    _, counts = scan.paged(lists, spark.createDataFrame([], "list_id string, pos int, url string, title string"), _pager(spark, 40))
    assert {r.list_id: r.pages_scanned for r in counts.collect()} == {"a": 3, "b": 2}
    assert set(parsed) == {f"https://h.ex/l?p={k}" for k in (38, 39, 40)}


def test_candidates_come_of_reached_pages_alone(spark, monkeypatch):
    monkeypatch.setattr(scan.pages, "next_links", lambda rows, keep=(), links=scan.pages.next_links: links(rows, keep) if rows.count() <= 1 else 1 / 0)
    lists = spark.createDataFrame([("a", "https://h.ex/l?p=39", "li", False)], "list_id string, url string, selector string, rendered boolean")
    seed = spark.createDataFrame([("a", 0, "https://h.ex/b/x/39-1", "a")], "list_id string, pos int, url string, title string")
    found, _ = scan.paged(lists, seed, _pager(spark, 40))
    assert [r.url for r in found.orderBy("pos").collect()] == [f"https://h.ex/b/x/{k}" for k in ("39-1", "40-1", "40-2")]


def test_a_ladder_gates_its_attempts_and_blames_the_pool(spark):
    items = "".join(f"<li class='v'><a href='/b/x/{i}'>t{i}</a></li>" for i in range(5))
    lists = spark.createDataFrame([("1", "https://h.ex/l", f"<body><nav><a href='/'>h</a></nav>{items}</body>", "p.old"), ("2", "https://h.ex/m", "<p>x</p>", None)], "list_id string, url string, html string, cached string")
    pool = spark.createDataFrame([("a", "nav a", None, 9, 0), ("b", "p.old", None, 8, 1), ("c", "a:bad(", None, 7, 2), ("d", "li.v", None, 1, 3), ("e", "li a", None, 0, 4)], "strategy_id string, list_selector string, fingerprint string, times_worked int, pool_pos int")
    out, found = scan.climbed(lists, pool, spark.createDataFrame([("2", '{"list_selector": "p"}')], "list_id string, answer string"))
    got = {r.list_id: (r.rung, r.selector_used, r.worked_strategy_id, r.blamed, r.answered) for r in out.collect()}
    assert got == {"1": (2, "li.v", "d", "a,c", False), "2": (None, None, None, "a,b,c,d,e", True)}
    assert found.count() == 5


def test_remember_credits_known_pairs_and_adds_others(spark):
    pool = spark.createDataFrame([("a", "li", None, 1, 0), ("b", "li", "f", 2, None)], "strategy_id string, list_selector string, fingerprint string, times_worked int, times_failed int")
    seen = spark.createDataFrame([("li", None), ("li", None), ("p", "f"), (None, "f")], "list_selector string, fingerprint string")
    got = {(r.list_selector, r.fingerprint): (r.times_worked, r.times_failed) for r in merge.remember(pool, seen).collect()}
    assert got == {("li", None): (3, 0), ("li", "f"): (2, 0), ("p", "f"): (1, 0)}
    credited = merge.track_record(pool, spark.createDataFrame([("a",), ("zz",), (None,)], "strategy_id string"), spark.createDataFrame([], "strategy_id string"))
    assert {r.strategy_id: r.times_worked for r in credited.collect()} == {"a": 2, "b": 2}


def test_status_and_log_are_scrubbed_before_they_are_cut(spark):
    sources = spark.createDataFrame([("s", 2, T, "ok"), ("z", None, None, None)], "id string, consecutive_errors int, last_scan_at timestamp_ntz, last_status string")
    secret = "segretissimo"
    o = spark.createDataFrame([("s", "error", "x" * 995 + secret, T), ("s", "ok", None, None)], "source_id string, status string, error string, at timestamp_ntz")
    got = {r.id: (r.last_status, r.consecutive_errors, r.last_error) for r in history.source_status(sources, o, [secret]).collect()}
    assert got["s"] == ("error", 3, "x" * 995 + "[REDA") and got["z"] == (None, None, None)


def test_processed_stops_at_the_budget_and_keeps_what_is_no_grant(spark):
    rows = [("s", i, f"https://h.ex/{i}", None, None) for i in range(5)] + [("s", 9, "https://h.ex/9", "T", '{"summary": "x"}')]
    candidates = spark.createDataFrame(rows, "source_id string, pos bigint, url string, title string, payload string")
    pages = spark.createDataFrame([(f"https://h.ex/{i}", "GET", 200, f"<p>testo {i}</p>" if i != 3 else "<p> </p>", None, "x") for i in range(4)], PAGE).drop("counted")
    good = '{"grant": {"title": "Titolo"}}'
    from vaglio.functions.urls import canonical_url, url_hash

    told = spark.createDataFrame([("https://h.ex/0", good, None), ("https://h.ex/1", "no", good), ("https://h.ex/2", '{"grant": null}', None), ("https://h.ex/9", good, None)], "u string, first string, second string").select(url_hash(canonical_url(F.col("u"))).alias("url_hash"), "first", "second")
    none = spark.createDataFrame([], "source_id string, url_hash string, content_hash string, last_seen_at timestamp_ntz")
    pool = spark.createDataFrame([], "grant_id bigint, source_id string, title string, deadline date, pool_pos bigint")
    done = flow.processed(flow.page_texts(candidates, pages), none, told, pool, cap=100, budget=4)
    assert {r.pos: (r.outcome, r.calls) for r in done.collect()} == {0: ("stored", 1), 1: ("stored", 2), 2: ("rejected", 1), 3: ("blank", 0), 4: ("unfetched", 0), 9: ("over_budget", 0)}
    again = flow.processed(flow.page_texts(candidates, pages), flow.snapshot_rows(done, F.lit(T)), told, pool, cap=100, budget=4)
    assert {r.pos: r.outcome for r in again.collect()} == {0: "unchanged", 1: "unchanged", 2: "unchanged", 3: "blank", 4: "unfetched", 9: "stored"}


def test_prompts_settings_and_moments(spark):
    row = spark.createDataFrame([("u", [("a", "n", None)], "x")], "u string, t array<struct<id: string, name: string, description: string>>, x string").select(values.retry_prompt(values.prompt(F.col("u"), F.col("t"), F.col("x")), F.lit("title: missing")).alias("p")).first()
    assert row.p.split("\n\n")[1] == "TOPICS TO SCORE:\n- id=a name=n: no description" and row.p.endswith("Return corrected JSON matching the schema exactly.")
    moments = spark.createDataFrame([("2026-05-01T06:00:00Z",), ("ieri",), (None,)], "x string").select(values.iso_timestamp(F.col("x")).cast("timestamp_ntz").alias("t")).collect()
    assert [r.t for r in moments] == [T, None, None]
    assert readers.config(spark)["draft_threshold"] == 3
    spark.conf.set("spark.vaglio.draft_threshold", "5")
    assert readers.config(spark)["draft_threshold"] == 5
    spark.conf.unset("spark.vaglio.draft_threshold")
