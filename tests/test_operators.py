"""Operators on small fixtures with nulls, ties, repeats, empty tables and clashing columns."""

import datetime as dt
import random

from pyspark.sql import functions as F

from vaglio.functions.distance import indel_ratio
from vaglio.operators import components, dedup, extraction, gate, history, incremental, merge, pages, units
from vaglio.sources import readers

T = dt.datetime(2026, 5, 1, 6)


def sources(spark):
    return spark.createDataFrame([("s", "https://h.ex/", "https://h.ex/l"), ("z", "https://z.ex/", None)], "id string, url string, list_url string")


CANDIDATE = "candidate_id bigint, source_id string, url string, text string, fetched_at timestamp_ntz, arrived_at timestamp_ntz, page string, version int"


def candidates(spark, rows):
    return spark.createDataFrame([(i, s, u, t, f, f, "clash", 1) for i, s, u, t, f in rows], CANDIDATE)


def digest(spark, url, text):
    from vaglio.functions.text import content_hash
    from vaglio.functions.urls import canonical_url, url_hash

    r = spark.createDataFrame([(url, text)], "u string, t string").select(url_hash(canonical_url(F.col("u"))).alias("u"), content_hash(F.col("t")).alias("t")).first()
    return r.u, r.t


def test_pending_pages_takes_the_newest_and_compares_with_the_newest_snapshot(spark):
    u, same = digest(spark, "https://h.ex/p", "uguale")
    _, old = digest(spark, "https://h.ex/p", "vecchio")
    w, _ = digest(spark, "https://h.ex/w", "x")
    rows = [
        (1, "s", "/p", "vecchio", T), (2, "s", "https://h.ex/p/#a", " uguale ", T + dt.timedelta(1)),  # unchanged
        (3, "s", "/q", "a", T), (4, "s", "/q?utm_source=x", "b", T), (5, "z", "/q", "a", None),  # new, tie, other source
        (6, "s", "/w", None, T), (6, "s", "/w", None, T), (7, "s", None, "x", T), (8, None, "/p", "x", T),
    ]
    snapshots = spark.createDataFrame([("s", u, old, T), ("s", u.upper(), same, T + dt.timedelta(2)), ("s", w, None, T)], "source_id string, url_hash string, content_hash string, last_seen_at timestamp_ntz")
    got = sorted(r.candidate_id for r in incremental.pending_pages(candidates(spark, rows), sources(spark), snapshots).collect())
    assert got == [3, 5, 6]
    assert incremental.pending_pages(candidates(spark, []), sources(spark), snapshots).count() == 0


def test_change_feed_survives_a_death_before_commit(spark, tmp_path):
    feed = incremental.ChangeFeed(spark, f"file://{tmp_path}/feed")
    rows = candidates(spark, [(1, "s", "/p", "a", T), (2, "s", "/q", "b", T)])
    first = feed.pending(rows, sources(spark))
    assert first.count() == 2
    # a run that wrote its ledger but died before the rename: it is ignored and done again
    first.select("source_id", "page", "version").write.parquet(f"file://{tmp_path}/feed/ledger/1")
    again = incremental.ChangeFeed(spark, f"file://{tmp_path}/feed")
    assert again.state() == {"epoch": 0} and again.pending(rows, sources(spark)).count() == 2
    assert again.commit(again.pending(rows, sources(spark))) == 1
    assert again.pending(rows, sources(spark)).count() == 0
    more = candidates(spark, [(1, "s", "/p", "a", T), (3, "s", "/q", "c", T + dt.timedelta(1)), (4, "s", "/r", "d", T)])
    due = again.pending(more, sources(spark))
    assert sorted(r.candidate_id for r in due.collect()) == [3, 4]
    again.commit(due)
    assert again.ledger().count() == 3 and again.pending(more, sources(spark)).count() == 0


def test_low_water_mark_is_the_oldest_open_run(spark):
    d = dt.timedelta(1)
    runs = [
        ("s", T, T + d / 4, "ok"), ("s", T + d, None, "error"), ("s", T + 2 * d, T + 2.2 * d, "ok"),  # the failed run is covered by the success after it
        ("o", T, T + 3 * d, "ok"), ("o", T + d, T + 1.2 * d, "ok"), ("o", T + 2 * d, T + 2.1 * d, "error"),  # one still open when the last began to read, one failed since
        ("r", T, None, "ok"), ("r", T + d, T + 1.2 * d, "ok"),  # begun, not ended and not failed
        ("n", T, T, "error"), (None, T, T, "ok"), ("s", None, T, "ok"),
    ]
    got = {r.source_id: (r.reread_from, r.open_runs) for r in incremental.low_water_mark(spark.createDataFrame(runs, "source_id string, started_at timestamp_ntz, finished_at timestamp_ntz, status string")).collect()}
    assert got == {"s": (T + 2 * d, 0), "o": (T, 2), "r": (T, 1), "n": (None, 0)}


AMOUNTS = {
    "fino a 5.000 euro": (None, 5000, "EUR"), "da 1,5 a 2,5 mln €": (1.5e6, 2.5e6, "EUR"), "n. 10 voucher, ciascuno fino a € 8.000": (None, 8000, "EUR"),
    "dotazione 12 milioni di euro; contributo massimo 80 mila euro": (None, 80000, "EUR"), "importi in migliaia di euro: 80 - 2.500": (80000, 2500000, "EUR"),
    "Fr. 80'000.– bis 400'000.–": (80000, 400000, "CHF"), "un milione e 500 mila euro": (None, 1.5e6, "EUR"), "da cinquemila a settantacinquemila euro": (5000, 75000, "EUR"),
    "between EUR 8k and EUR 1.2m": (8000, 1.2e6, "EUR"), "contributo massimo 80.000 euro, minimo 5.000 euro": (5000, 80000, "EUR"), "copertura del 50%, 6 mesi": None, "vedi bando": None,
    "fino a 5 millioni di eruo": (None, 5e6, "EUR"), "bando 2024": None, "$8,000.00 to $15,000.00": (8000, 15000, "USD"),
}


def test_amounts_are_read_from_text(spark):
    texts = spark.createDataFrame([(t,) for t in AMOUNTS], "funding_text string")
    got = {r.funding_text: (r.low, r.high, r.currency) for r in units.text_amounts(texts).collect()}
    assert got == {t: v for t, v in AMOUNTS.items() if v}


def test_bounds_use_the_habit_of_a_source_and_rates(spark):
    rows = [(k, "k", f"fino a {k}.000 euro", None, float(k)) for k in (5, 6, 7)]
    rows += [(10, "k", None, 2.0, 8.0), (11, "n", None, 2.0, 0.0), (12, "n", "max CHF 1'000", None, None), (13, "n", "max 10 GBP 5k", None, None), (14, None, None, float("nan"), None), (5, "k", "fino a 5.000 euro", None, 5.0)]
    grants = spark.createDataFrame([(*r, "EUR") for r in rows], "grant_id bigint, source_id string, funding_text string, funding_min double, funding_max double, currency string")
    rates = spark.createDataFrame([("CHF", 1.5)], "currency string, eur_rate double")
    got = {(r.grant_id, r.bound): r.amount_eur for r in units.bounds_in_euro(grants, rates).collect()}
    assert got == {(5, "max"): 5000, (6, "max"): 6000, (7, "max"): 7000, (10, "min"): 2000, (10, "max"): 8000, (11, "min"): 2, (12, "max"): 1500}
    assert units.bounds_in_euro(grants.limit(0), rates).count() == 0


def test_components_of_random_links(spark):
    random.seed(4)
    links = [(random.randint(1, 60), random.randint(1, 60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 140)] + [(200, k) for k in range(201, 260)] + [(None, 1), (3, 3)]
    parent = {}

    def find(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a and b and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {n: find(n) for n in {x for a, b in links if a and b and a != b for x in (a, b)}}
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def gated(spark, urls, titles=None):
    rows = [("l", i, u, (titles or {}).get(i), "h.ex") for i, u in enumerate(urls)]
    j = gate.judged(spark.createDataFrame(rows, "list_id string, pos int, url string, title string, domain string"))
    return {r.pos: r.reason for r in j.collect()}, gate.verdicts(j).first(), gate.accepted(j).count()


def test_gate_reasons_and_cohesion(spark):
    reasons, verdict, kept = gated(spark, [f"https://h.ex/bandi/x/{i}" for i in range(8)] + ["https://h.ex/a/b", "https://h.ex/c/d", "https://o.ex/bandi/x/1", "https://h.ex/bandi", "https://h.ex/bandi/x/1", "https://h.ex/bandi/x/9"], {13: " HOME "})
    assert [reasons[i] for i in range(8, 14)] == ["incohesive", "incohesive", "url_shape", "url_shape", "duplicate", "chrome"]
    assert (verdict.candidates_accepted, verdict.rejected_incohesive, verdict.gate_verdict, kept) == (8, 2, "accepted", 8)
    assert gated(spark, [f"https://h.ex/{p}/x/{i}" for p in "ab" for i in range(3)])[1].rejected_incohesive == 0
    assert gated(spark, ["https://h.ex/a/b"])[1].gate_verdict == "implausible_count_low"
    _, verdict, kept = gated(spark, [f"https://h.ex/a/{i}" for i in range(250)])
    assert (verdict.gate_verdict, verdict.candidates_accepted, kept) == ("implausible_count_high", 250, 0)


def test_list_links_report_bad_selectors(spark):
    rows = [("a", "https://h.ex/l", '<li class="v"><a href="/b/1">U</a></li>', "li.v"), ("b", "https://h.ex/", "<a href='/x'>x</a>", "a:zz("), ("c", None, None, "a")]
    got = [(r.list_id, r.url, r.title, r.status) for r in gate.list_links(spark.createDataFrame(rows, "list_id string, base_url string, html string, selector string")).orderBy("list_id").collect()]
    assert got == [("a", "https://h.ex/b/1", "U", "ok"), ("b", None, None, "invalid_selector")]


def test_fingerprint_counts_stable_classes(spark):
    page = '<meta name="generator" content="Drupal 10"><div class="card js-x card__a1b2c"></div><li class="voce card"></li><div class="ab"></div>'
    other = page.replace("voce", "altro")
    rows = {r.page_id: (r.platform, r.fingerprint) for r in pages.fingerprints(spark.createDataFrame([(1, page), (2, page + "<p>x</p>"), (3, other), (4, "<p>wp-content</p>")], "page_id int, html string")).collect()}
    assert rows[1] == rows[2] != rows[3] and rows[1][0] == "drupal" and rows[4][0] == "wordpress"


def test_next_links_and_walk_stop_at_cycles(spark):
    html = '<a href="https://h.ex/l?p=1">avanti</a><a href="/f.pdf">next</a><a href="https://o.ex/">next</a><a href="/l?p=2">Pagina successiva</a>'
    got = pages.next_links(spark.createDataFrame([("https://h.ex/l?p=1", html), ("https://h.ex/z", '<link rel="next" href="/y"><a href="/x">next</a>'), ("https://h.ex/e", None)], "url string, html string")).collect()
    assert {r.url: r.next_url for r in got} == {"https://h.ex/l?p=1": "https://h.ex/l?p=2", "https://h.ex/z": "https://h.ex/y"}
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "gone")], "url string, next_url string")
    walked = pages.walk(spark.createDataFrame([("a",), ("d",)], "url string"), links).collect()
    assert sorted((r.start, r.page_no, r.url) for r in walked) == [("a", 1, "a"), ("a", 2, "b"), ("a", 3, "c"), ("d", 1, "d")]


def test_soft_duplicates_equal_brute_force(spark):
    random.seed(9)
    words = "bosco legno fiere borghi mare acque lana vino olio fiume".split()
    rows = []
    for i in range(160):
        t = " ".join(random.choices(words, k=4))
        if i % 3 == 0 and rows:
            t = rows[random.randrange(len(rows))][2] or "lana vino"
            t = t[: random.randrange(len(t))] + random.choice(["", "x"]) + t[random.randrange(len(t)) :] if random.random() < 0.7 else t
        rows.append((i, f"s{i % 4}" if i % 17 else None, t if i % 23 else None, dt.date(2026, 1 + i % 2, 5) if i % 19 else None, i))
    frame = spark.createDataFrame(rows, "grant_id bigint, source_id string, title string, deadline date, pool_pos bigint")
    got = {r.grant_id: (r.duplicate_of, r.score) for r in dedup.soft_duplicates(frame, frame).collect()}
    want = {}
    norm = lambda t: " ".join(sorted((t or "").split()))
    for a in rows:
        best = None
        for b in rows:
            if a[0] != b[0] and norm(a[2]) and norm(b[2]) and a[3] and b[3] and (a[3].year, a[3].month) == (b[3].year, b[3].month) and (a[1] is None or b[1] is None or a[1] != b[1]):
                s = indel_ratio(norm(a[2]), norm(b[2]))
                if s >= 90 and (best is None or s > best[1]):
                    best = (b[0], round(s, 6))
        if best:
            want[a[0]] = best
    assert len(want) > 20 and got == want


def test_titles_of_common_words_are_hardly_ever_aligned(spark, monkeypatch):
    random.seed(4)
    words = "bosco legno fiere borghi mare acque lana vino olio fiume più".split()
    texts = sorted({" ".join(random.choices(words, k=random.randint(1, 7))) for _ in range(200)})
    texts = sorted({*texts, *(t[: len(t) // 2] + "x" + t[len(t) // 2 :] for t in texts)})
    want = {(a, b, indel_ratio(a, b)) for a in texts for b in texts if indel_ratio(a, b) >= 90}
    aligned = []
    monkeypatch.setattr(dedup, "indel_ratio", lambda a, b: aligned.append(a) or indel_ratio(a, b))
    got = list(dedup.like_pairs(texts, texts, 90))
    assert len(got) == len(want) and set(got) == want and len(aligned) < len(texts) ** 2 / 10
    monkeypatch.setattr(dedup, "SHARD", 5)
    rows = spark.createDataFrame([(dt.date(2026, 1, 1), t) for t in texts], "month date, text string")
    assert sorted((r.a, r.b, r.score) for r in dedup.like_titles(rows, rows).collect()) == sorted(want)


def test_upsert_keeps_first_values_and_old_ones_for_nulls(spark):
    old = spark.createDataFrame([("a", "t", 1, "k"), (None, "n", 2, "k")], "k string, title string, found int, link string")
    new = spark.createDataFrame([("a", "u", 5, None), ("b", "v", 6, "z"), (None, None, 7, None)], "k string, title string, found int, link string")
    got = {r.k: (r.title, r.found, r.link, r.is_new) for r in merge.upsert(old, new, ["k"], keep=("found",)).collect()}
    assert got == {"a": ("u", 1, "k", False), "b": ("v", 6, "z", True), None: ("n", 2, "k", False)}


def test_streaks_and_drafts(spark):
    rows = [("s", i, x) for i, x in enumerate("eeoeeee")] + [("r", i, "e") for i in range(3)]
    o = spark.createDataFrame([(s, i, {"e": "error", "o": "ok"}[x]) for s, i, x in rows], "source_id string, seq int, status string")
    streaks = history.error_streaks(o)
    assert [r.streak for r in streaks.where("source_id = 's'").orderBy("seq").collect()] == [1, 2, 0, 1, 2, 3, 4]
    kinds = spark.createDataFrame([("s", "html"), ("r", "rss")], "id string, type string")
    assert [tuple(r) for r in history.drafts_due(streaks, kinds).collect()] == [("s", 5)]
    assert history.drafts_due(streaks, kinds, threshold=0).count() == 0


def test_schedule_across_clock_changes(spark):
    rows = [("daily", "2026-10-25 05:30:00", "2026-10-24 10:00:00"), ("daily", "2026-10-25 04:30:00", "2026-10-24 10:00:00"), ("daily", "2026-07-01 04:00:00", "2026-07-01 03:59:00"), ("six_hourly", "2026-07-01 10:05:00", "2026-07-01 10:01:00"), ("hourly", "2026-07-01 10:50:00", "2026-07-01 10:00:00"), ("hourly", "2026-07-01 10:49:00", "2026-07-01 10:00:00"), ("mai", "2026-07-01 10:49:00", "2026-07-01 10:00:00"), ("daily", "2026-07-01 01:00:00", None)]
    f = spark.createDataFrame(rows, "f string, n string, l string").select(history.should_run(F.col("f"), F.col("n").cast("timestamp"), F.col("l").cast("timestamp")).alias("r"))
    assert [r.r for r in f.collect()] == [True, False, True, False, True, False, True, True]


def test_admission_leaves_the_runs_cap_to_others(spark):
    calls = spark.createDataFrame([("r", s, i) for s in "ab" for i in range(5)], "run_key string, source_id string, seq int")
    got = {(r.source_id, r.seq): r.admitted for r in history.admitted(calls, cap=5, budget=3).collect()}
    assert [k for k, v in sorted(got.items()) if v] == [("a", 0), ("a", 1), ("a", 2), ("b", 0), ("b", 1)]


def test_extraction_retries_and_quarantine(spark):
    good, bad = '{"grant": {"title": "T", "deadline": "2026-01-05"}, "relevance": [{"topic_id": "t", "score": 0.5}]}', '{"grant": {"title": ""}}'
    rows = [(1, good, None), (2, bad, good), (3, "no", "["), (4, '{"grant": null}', None), (5, '{"relevance": []}', None), (6, good.replace("01-05", "02-30"), None), (7, good.replace("0.5", "1.5"), good), (8, None, None)]
    got = {r.id: (r.attempt, r.outcome) for r in extraction.extracted(spark.createDataFrame(rows, "id int, first string, second string")).collect()}
    assert got == {1: (1, "stored"), 2: (2, "stored"), 3: (2, "quarantined"), 4: (1, "rejected"), 5: (1, "rejected"), 6: (2, "quarantined"), 7: (2, "stored"), 8: (2, "quarantined")}


def test_rules(spark):
    rules = ['{"item_selector": "li"}', '{"results_path": "a", "request": {"method": "post"}}', "{}", '{"item_selector": "javascript:x"}', '{"item_selector": "li", "max_pages": 99}', '{"request": {"method": "DELETE"}}', "[1]", None]
    got = [tuple(r.r)[:4] for r in spark.createDataFrame([(i, r) for i, r in enumerate(rules)], "i int, x string").orderBy("i").select(extraction.checked_rule(F.col("x")).alias("r")).collect()]
    assert got == [("valid", True, False, "GET"), ("valid", True, True, "POST"), ("valid", False, False, "GET")] + [("invalid", False, False, None)] * 5


def test_feeds_and_interfaces(spark):
    xml = "<rss><channel><item><title> A </title><link>https://h.ex/a/#x</link></item><item><title>no link</title></item></channel></rss>"
    got = [(r.url, r.title) for r in readers.feed_items(spark.createDataFrame([("s", xml)], "source_id string, xml string")).collect()]
    assert got == [("https://h.ex/a", "A")]
    page = '{"rows": [{"u": ["/a"], "t": "A"}, {"u": "/a", "t": "B"}, {"x": 1}, 5, {"url": "/c", "metadata": {"title": ["M"]}}]}'
    api = readers.api_items(spark.createDataFrame([("s", 1, "https://h.ex/", page), ("s", 9, "https://h.ex/", page)], "source_id string, page int, base_url string, json string"), "rows", "u", "t")
    assert sorted((r.url, r.title) for r in api.collect()) == [("https://h.ex/a", "A"), ("https://h.ex/c", "M")]


def test_rule_files_and_rendering(spark, tmp_path):
    (tmp_path / "r.json").write_text('{\n "source_id": "s",\n "label": "L",\n "rule": {"item_selector": "li", "max_pages": 2}\n}')
    assert readers.rule_files(spark, str(tmp_path)).first().rule.item_selector == "li"
    rows = spark.createDataFrame([("<body>x</body>", "<body>r</body>"), (None, None), ("<body>" + "y" * 600 + "</body>", "z")], "html string, rendered_html string")
    assert [r.html for r in readers.page_html(rows).collect()][:2] == ["<body>r</body>", None]
