"""What no filter, cap or round limit of the llm operators may leave out."""

import datetime as dt
import itertools
import random

import pandas as pd

from vaglio.llm import linkage, names

D = dt.date(2026, 3, 31)


def side(spark, rows):
    """id, title, issuer, deadline, amount, seen -> prepared side."""
    schema = "id bigint, title string, issuer string, deadline date, amount double, seen date"
    return linkage.durable(linkage.prepared(spark.createDataFrame(rows, schema), "id", "seen", None))


def test_pairs_whose_only_stems_are_common_are_candidates(spark):
    seen = dt.date(2026, 1, 10)
    crowd = [(k, f"Bando energia per PMI {2000 + k % 40}", f"Comune di Borgo{'abcdefghij'[k % 10]}{'klmnop'[k // 10]}", D, 1000.0 * k, seen) for k in range(1, 60)]
    register = [*crowd, (100, "Bando energia per PMI", "Comune di Ravenna", None, 5000.0, seen), (101, "Energia PMI", None, None, 7777.0, seen), (102, "Bando PMI", "Provincia di Trento", None, None, seen)]
    grants = [(1, "Avviso energia PMI", "Comune di Ravena", D, None, seen), (2, "Avviso energia per PMI", "Comune di Ravenna", None, None, seen), (3, "Energia PMI", None, D, 7777.0, seen), (4, None, "Provincia di Trento", None, None, seen)]
    found = {(r.a, r.b) for r in linkage.candidates(side(spark, grants), side(spark, register)).collect()}
    assert {(1, 100), (2, 100), (3, 101), (4, 102)} <= found


def test_reordered_and_long_names_are_verified(spark):
    spelt = ["Comune di Reggio Emilia", "Emilia Reggio (Comune)", "Comune di Castelvecchio Montefiorito Roccalumera", "Comune di Castelvecio Montefiorido Rocalunera", "Comune di Bari"]
    rows = spark.createDataFrame(list(enumerate(spelt, 1)), "spelling_id bigint, issuer string")
    forms = [names.parse_name(n) for n in spelt]
    assert names.monge_elkan(forms[0][1], forms[1][1]) == 1 and names.monge_elkan(forms[2][1], forms[3][1]) >= names.VERIFIED
    assert {(r.spelling_id_a, r.spelling_id_b) for r in names.same_entity_pairs(rows).collect()} == {(1, 2), (3, 4)}


def test_star_clusters_follow_a_long_chain_to_its_end(spark):
    n = 41
    nodes = spark.createDataFrame([(k, n - k) for k in range(n)], "node bigint, rank int")
    links = spark.createDataFrame([(k, k + 1, 0.9) for k in range(n - 1)], "a bigint, b bigint, similarity double")
    got = {r.node: r.centre for r in names.star_clusters(nodes, links).collect()}
    assert got == {k: k - k % 2 for k in range(n)}


def test_every_pair_of_a_large_bucket_is_compared(spark):
    random.seed(3)
    cores = sorted({"consorziovalle" + "".join(random.choices("bcdfgklmnprtvz", k=9)) for _ in range(800)})
    frame = spark.createDataFrame([(k, "other", c, "", c) for k, c in enumerate(cores)], "form bigint, kind string, core string, given string, closed string")
    signed = names._signature(names.BANDS * names.ROWS).func(pd.Series(cores))
    buckets, want = {}, set()
    for k, s in enumerate(signed):
        for band in range(names.BANDS):
            buckets.setdefault((band, *s[band * names.ROWS : (band + 1) * names.ROWS]), []).append(k)
    assert max(map(len, buckets.values())) > 400
    for bucket in buckets.values():
        want.update(itertools.combinations(bucket, 2))
    got = names._banded(frame).select("a", "b").distinct()
    assert {(r.a, r.b) for r in got.collect()} == want


def test_rows_without_issuer_and_audience_meet_on_the_amount(spark):
    seen = dt.date(2026, 1, 10)
    grants = [(1, "Bando energia", None, None, 5000.0, seen), (2, "Bando turismo", "Comune di Bari", None, 900.0, seen), (3, "Bando musei PMI", None, None, 70.0, seen), (4, "Bando olivi", None, None, None, seen)]
    register = [(11, "Energia PMI", "Comune di Ravenna", None, 5010.0, seen), (12, "Turismo PMI", None, None, 900.0, seen), (13, "Musei", "Comune di Trento", None, 70.0, seen), (14, "Energia PMI", "Comune di Ravenna", None, 9000.0, seen)]
    assert {(r.a, r.b) for r in linkage.candidates(side(spark, grants), side(spark, register)).collect()} == {(1, 11), (2, 12), (3, 13)}


def plan_run(frame) -> str:
    """The plan that collecting frame ran, without its first draft."""
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def few_calls(spark):
    seen = dt.date(2026, 1, 10)
    rows = [(k, f"Bando energia per PMI {2000 + k}", f"Comune di Borgo{'abcdefghij'[k]}", D, 1000.0 * k, seen) for k in range(1, 10)]
    return side(spark, rows), side(spark, rows)


def test_keys_and_rows_of_calls_do_not_go_through_the_driver(spark):
    left, right = few_calls(spark)
    pairs = linkage.candidates(left, right)
    for frame in (pairs, linkage.votes(linkage.durable(pairs), left, right)):
        assert "BroadcastExchange" not in plan_run(frame)


def test_rows_that_lack_issuer_or_audience_meet_as_brute_force_says(spark):
    lacks = list(itertools.product([False, True], [False, True]))
    rows = {n: [(n + k, "Bando energia" + " PMI" * (not a), None if i else f"Comune di {town}", None, 5000.0, dt.date(2026, 1, 10)) for k, (a, i) in enumerate(lacks)] for n, town in ((0, "Ravenna"), (10, "Bari"))}
    want = {(k, 10 + j) for k, (a, i) in enumerate(lacks) for j, (b, o) in enumerate(lacks) if i or o}
    assert {(r.a, r.b) for r in linkage.candidates(side(spark, rows[0]), side(spark, rows[10])).collect()} == want


def test_vote_patterns_go_through_the_driver_as_one_number(spark):
    seen = dt.datetime(2026, 1, 10)
    rows = [(k, f"Bando energia per PMI {2000 + k}", f"Comune di Borgo{'abcdefghij'[k]}", D, None, seen, 1000.0 * k, "s") for k in range(1, 10)]
    grants = spark.createDataFrame([(*r[:6], None, r[6], r[7]) for r in rows], "grant_id bigint, title string, issuer string, deadline date, funding_text string, found_at timestamp_ntz, funding_min double, funding_max double, source_id string")
    register = spark.createDataFrame([(*r[:4], r[6], r[5], None) for r in rows], "reg_id bigint, title string, issuer string, deadline date, funding_max double, published_on timestamp_ntz, territory string")
    linked = linkage.link(grants, register, spark.createDataFrame([("EUR", 1.0)], "currency string, eur_rate double"))
    sent = [line for line in plan_run(linked).splitlines() if " BroadcastExchange " in line]
    assert len(sent) == 1 and sent[0].count("input[") == 1
    assert {(r.grant_id, r.reg_id) for r in linkage.pairs_found(linked).collect()} == {(k, k) for k in range(1, 10)}


def test_forms_and_their_bands_do_not_go_through_the_driver(spark):
    spelt = ["Comune di Reggio Emilia", "Emilia Reggio (Comune)", "Com. Regio Emilia", "Ente Nazionale Cammini e Sentieri", "ENCS", "Fond. Gigi Buggouzo", "Fondazione Luigi Bugoguzo"]
    forms = linkage.durable(names.forms_of(spark.createDataFrame(list(enumerate(spelt)), "spelling_id bigint, issuer string")))
    links = names.links_of(forms.drop("spelling_id", "issuer"), forms.where("kind = 'other'").selectExpr("form", "issuer AS typed"))
    for frame in (names._banded(forms), links):
        assert "BroadcastExchange" not in plan_run(frame)
    number = {r.form: r.spelling_id for r in forms.collect()}
    assert {frozenset((number[r.a], number[r.b])) for r in links.collect()} >= {frozenset((3, 4)), frozenset((0, 2)), frozenset((5, 6))}
