"""Scans of list pages: requests against a table of fetched pages, the ladder of selectors with its gate, pagination, and rules.

Nothing is fetched here: what was fetched is a table of pages (method, url, status, html, rendered_html), and what a
model answered is a table of answers. A page is parsed once for all selectors that are tried on it.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vaglio.functions import html as H
from vaglio.functions.text import strip
from vaglio.functions.urls import canonical_url, netloc, truthy
from vaglio.functions.values import dig
from vaglio.operators import gate, pages
from vaglio.operators.extraction import checked_rule
from vaglio.session import durable, small_side

#: Candidates kept of one source, and characters kept of a model's reasons and of what it proposed.
MOST_CANDIDATES = 60
REASON_CHARS, PROPOSAL_CHARS = 200, 60


def fetched(requests: DataFrame, pages_: DataFrame, robots: DataFrame | None = None, rendered: Column | None = None) -> DataFrame:
    """requests with html and counted: what a request brought, and whether it counts as a page.

    requests: url and any others, method if not GET; pages_: url, status, html, and method and rendered_html if there are
    such. A page whose status is not 200 counts but brings nothing; one of null status (no answer), none on record, or
    one that its domain's robots file forbids neither counts nor brings anything. rendered: where the rendered page is
    asked for; it counts if there is one. Of several records of a URL the one with the greatest status and html holds.
    """
    known = recorded(pages_).groupBy("_u", "_m").agg(F.max("p").alias("_p"))
    asked = requests.withColumn("_m2", F.upper(F.coalesce("method", F.lit("GET"))) if "method" in requests.columns else F.lit("GET")).withColumn("_u2", canonical_url(F.col("url")))
    return brought(asked, known, robots, rendered).select(*requests.columns, "html", "counted")


def recorded(pages_: DataFrame) -> DataFrame:
    """_u, _m, p of each record of a page: its canonical URL, the method, and status, html and rendered html."""
    method = F.upper(F.coalesce("method", F.lit("GET"))) if "method" in pages_.columns else F.lit("GET")
    shown = F.col("rendered_html") if "rendered_html" in pages_.columns else F.lit(None).cast("string")
    return pages_.select(canonical_url(F.col("url")).alias("_u"), method.alias("_m"), F.struct("status", "html", shown.alias("rendered")).alias("p"))


def among(records: DataFrame, asked: DataFrame) -> DataFrame:
    """_u, _m, _p: of the recorded pages those that are asked for by _u2 and _m2, each once; asked is read twice."""
    wanted, _ = small_side(asked.select(F.col("_u2").alias("_u"), F.col("_m2").alias("_m")).distinct())
    return records.join(wanted, ["_u", "_m"], "left_semi").groupBy("_u", "_m").agg(F.max("p").alias("_p"))


def brought(asked: DataFrame, known: DataFrame, robots: DataFrame | None, rendered: Column | None) -> DataFrame:
    """asked (_u2, _m2 and any others) with html and counted; known: _u, _m, _p, one row a page."""
    met = asked.join(known, (F.col("_u2") == F.col("_u")) & (F.col("_m2") == F.col("_m")), "left")
    ok = F.lit(True)
    if robots is not None:
        r = robots.groupBy(F.lower("domain").alias("_d")).agg(F.bool_and("allowed").alias("_ok"))
        met = met.join(r, F.lower(netloc(F.col("_u2"))) == F.col("_d"), "left")
        ok = F.coalesce("_ok", F.lit(True))
    plain = F.when(F.col("_p.status") == 200, F.col("_p.html"))
    draw = F.coalesce(rendered, F.lit(False)) if rendered is not None else F.lit(False)
    html = F.when(ok, F.when(draw, F.nullif("_p.rendered", F.lit(""))).otherwise(plain))
    counted = ok & F.when(draw, F.nullif("_p.rendered", F.lit("")).isNotNull()).otherwise(F.col("_p.status").isNotNull())
    return met.select(*asked.columns, html.alias("html"), F.coalesce(counted, F.lit(False)).alias("counted"))


def answered_selector(answers: DataFrame) -> DataFrame:
    """list_id, proposed (a safe selector, stripped, or null) and reasoning of recorded answers.

    answers: list_id, answer (JSON). No selector is a list that the model did not find; an unsafe one is rejected.
    """
    raw, why = F.get_json_object("answer", "$.list_selector"), F.substring(F.coalesce(F.get_json_object("answer", "$.reasoning"), F.lit("")), 1, REASON_CHARS)
    safe = pages.safe_selector(raw)
    reason = F.when(raw.isNull(), F.coalesce(F.nullif(why, F.lit("")), F.lit("model found no grant list on the page"))).when(~safe, F.concat(F.lit("implausible selector rejected: "), F.substring(raw, 1, PROPOSAL_CHARS))).otherwise(why)
    one = answers.groupBy("list_id").agg(F.min("answer").alias("answer"))
    return one.select("list_id", F.when(safe, strip(raw)).alias("proposed"), reason.alias("reasoning"))


def attempts(lists: DataFrame, strategies: DataFrame, answers: DataFrame) -> DataFrame:
    """list_id, rung, rank, strategy_id, selector of what is to be tried on each list page, in order.

    lists: list_id, html, cached; strategies: strategy_id, list_selector, fingerprint, times_worked, pool_pos. Rung 1
    is the cached selector, rung 2 the ten best of the pool, where the cached one takes a place but is not tried
    again, rung 3 the selector that the model proposed.
    """
    cached = lists.where(F.coalesce("cached", F.lit("")) != "").select("list_id", F.lit(1).alias("rung"), F.lit(0).alias("rank"), F.lit(None).cast("string").alias("strategy_id"), F.col("cached").alias("selector"))
    prints = pages.fingerprints(lists.select(F.col("list_id").alias("page_id"), "html"))
    ranked = pages.ranked_strategies(prints, strategies).join(F.broadcast(pages.pool_top(strategies).select("strategy_id", F.col("list_selector").alias("selector"))), "strategy_id")
    pool = ranked.join(lists.select(F.col("list_id").alias("page_id"), "cached"), "page_id").where(~F.col("selector").eqNullSafe(F.col("cached")))
    pool = pool.select(F.col("page_id").alias("list_id"), F.lit(2).alias("rung"), "rank", "strategy_id", "selector")
    model = answered_selector(answers).where("proposed IS NOT NULL").join(lists.select("list_id"), "list_id").select("list_id", F.lit(3).alias("rung"), F.lit(0).alias("rank"), F.lit(None).cast("string").alias("strategy_id"), F.col("proposed").alias("selector"))
    return cached.unionByName(pool).unionByName(model)


def tried(lists: DataFrame, selectors: DataFrame) -> DataFrame:
    """list_id, selector, pos, url, title, domain, status of the links that each selector finds on its list's page.

    lists: list_id, url, html; selectors: list_id, selector. A page is parsed once for all its selectors. status is
    'ok', 'none' on one row without url where a selector finds nothing, or 'invalid_selector' on one where it cannot be read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for list_id, url, html, asked in batch[["list_id", "url", "html", "asked"]].itertuples(index=False):
                tree = H.parse(html or "")
                for selector in asked:
                    try:
                        found = [k for node in H.matched(tree, selector) for k in H.anchors_in(tree, node)]
                    except ValueError:
                        rows.append((list_id, url, selector, None, None, None, "invalid_selector"))
                        continue
                    fit = [(k, h) for k in found if (h := tree.attributes[k].get("href")) and not h.startswith(("#", "javascript:", "mailto:", "tel:"))]
                    rows += [(list_id, url, selector, i, h, tree.text(k) or None, "ok") for i, (k, h) in enumerate(fit)] or [(list_id, url, selector, None, None, None, "none")]
            yield pd.DataFrame(rows, columns=["list_id", "base", "selector", "pos", "href", "title", "status"]).astype({"pos": "Int64"})

    asked = lists.select("list_id", "url", "html").join(selectors.groupBy("list_id").agg(F.array_sort(F.collect_set("selector")).alias("asked")), "list_id")
    raw = asked.mapInPandas(run, "list_id STRING, base STRING, selector STRING, pos INT, href STRING, title STRING, status STRING")
    return raw.select("list_id", "selector", "pos", canonical_url(F.col("href"), F.col("base")).alias("url"), "title", F.lower(netloc(F.col("base"))).alias("domain"), "status")


def gated(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The accepted links of each (list_id, selector), and its verdict with the counts. links: as tried()."""
    key = F.to_json(F.struct("list_id", "selector"))
    rows = links.withColumn("list_id", key)
    judged = gate.judged(rows.where("status = 'ok'").select("list_id", "pos", "url", "title", "domain"))
    parts = lambda d: d.withColumn("selector", F.get_json_object("list_id", "$.selector")).withColumn("list_id", F.get_json_object("list_id", "$.list_id"))
    none = links.where("status <> 'ok'").select("list_id", "selector", F.when(F.col("status") == "none", "implausible_count_low").otherwise("invalid_selector").alias("gate_verdict"))
    verdicts = parts(gate.verdicts(judged)).unionByName(none, allowMissingColumns=True)
    return parts(gate.accepted(judged)).select("list_id", "selector", "pos", "url", "title"), verdicts


def climbed(lists: DataFrame, strategies: DataFrame, answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ladder on each list page: (outcomes, candidates).

    lists: list_id, url, html, cached. outcomes: list_id, fingerprint, rung, selector_used, worked_strategy_id, blamed
    (ids of the pool's selectors that the gate rejected before), tried (selectors), answered. candidates: list_id, pos,
    url, title of the first accepted attempt. A list whose attempts are all rejected has null rung and selector_used.
    """
    todo = durable(attempts(lists, strategies, answers))
    accepted, verdicts = gated(durable(tried(lists, todo)))
    good = verdicts.where("gate_verdict = 'accepted'").select("list_id", "selector", F.lit(True).alias("accepted"))
    judged = durable(todo.join(good, ["list_id", "selector"], "left").withColumn("accepted", F.coalesce("accepted", F.lit(False))))
    place = F.struct("rung", "rank", "selector", "strategy_id")
    win = judged.groupBy("list_id").agg(F.min(F.when(F.col("accepted"), place)).alias("w"), F.count("*").alias("tried"))
    ladder = pages.ladder(judged.select(F.col("list_id").alias("page_id"), "rung", "rank", F.coalesce("strategy_id", F.lit("")).alias("strategy_id"), "accepted")).select(F.col("page_id").alias("list_id"), "blamed")
    prints = pages.fingerprints(lists.select(F.col("list_id").alias("page_id"), "html")).select(F.col("page_id").alias("list_id"), "fingerprint")
    answer = answers.select("list_id").distinct().withColumn("answered", F.lit(True))
    out = prints.join(win, "list_id", "left").join(ladder, "list_id", "left").join(answer, "list_id", "left").select(
        "list_id", "fingerprint", F.col("w.rung").alias("rung"), F.col("w.selector").alias("selector_used"), F.col("w.strategy_id").alias("worked_strategy_id"),
        F.coalesce("blamed", F.lit("")).alias("blamed"), F.coalesce("tried", F.lit(0)).alias("tried"), F.coalesce("answered", F.lit(False)).alias("answered"),
    )
    out = durable(out)
    first = accepted.join(out.select("list_id", F.col("selector_used").alias("selector")), ["list_id", "selector"])
    return out, first.select("list_id", "pos", "url", "title")


def capped(found: DataFrame, most: int = MOST_CANDIDATES) -> tuple[DataFrame, DataFrame]:
    """(candidates, counts) of links over the pages of a list: each URL once, the first by page and pos, pages in order until most is reached.

    found: list_id, page_no, pos, url, title. A page is read if fewer than most were held before it; what it adds
    beyond most is cut. counts: list_id, candidates, capped, which is true only if a page was left unread.
    """
    first = found.where("url IS NOT NULL").groupBy("list_id", "url").agg(F.min(F.struct("page_no", "pos", "title")).alias("m")).select("list_id", "url", "m.*")
    fresh = first.groupBy("list_id", "page_no").agg(F.count("*").alias("n"))
    # one row a page: at most MAX_PAGES a list
    every = found.select("list_id", "page_no").distinct().join(fresh, ["list_id", "page_no"], "left")
    held = every.withColumn("before", F.coalesce(F.sum(F.coalesce("n", F.lit(0))).over(W.partitionBy("list_id").orderBy("page_no").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    read = first.join(held.where(F.col("before") < most).select("list_id", "page_no"), ["list_id", "page_no"])
    kept = read.withColumn("k", F.row_number().over(W.partitionBy("list_id").orderBy("page_no", "pos"))).where(F.col("k") <= most)
    n = kept.groupBy("list_id").agg(F.count("*").alias("candidates"))
    counts = held.groupBy("list_id").agg(F.bool_or(F.col("before") >= most).alias("capped")).join(n, "list_id", "left")
    return kept.select("list_id", F.col("k").alias("pos"), "url", "title"), counts


def followed(starts: DataFrame, records: DataFrame, robots: DataFrame | None = None, most: int = pages.MAX_PAGES) -> DataFrame:
    """start, rendered, page_no, url, html: pages reached along next links, the start first, none twice, at most most.

    starts: start (a canonical URL), rendered; records: as recorded(), durable. Only pages that a walk reaches are
    parsed, step by step, however many there are. Plain and rendered pages are two webs that do not link to each other.
    """
    at = durable(starts.select("start", "rendered", F.col("start").alias("url"), F.array("start").alias("seen"), F.lit(1).alias("page_no")))
    out = []
    while True:
        asked = at.select("*", F.col("url").alias("_u2"), F.lit("GET").alias("_m2"))
        step = durable(brought(asked, among(records, asked), robots, F.col("rendered")).where("html IS NOT NULL").select("start", "rendered", "page_no", "url", "html", "seen"))
        out.append(step.drop("seen"))
        if len(out) == most:
            break
        links = pages.next_links(step.select("url", "html", "rendered").dropDuplicates(["url", "rendered"]), keep=("rendered",))
        onward = step.drop("html").join(links, ["url", "rendered"]).where(~F.array_contains("seen", F.col("next_url")))
        at = durable(onward.select("start", "rendered", F.col("next_url").alias("url"), F.concat("seen", F.array("next_url")).alias("seen"), (F.col("page_no") + 1).alias("page_no")))
        if at.isEmpty():
            break
    return functools.reduce(DataFrame.unionByName, out)


def paged(lists: DataFrame, seed: DataFrame, pages_: DataFrame, robots: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(candidates, counts) of lists whose selector was accepted on their first page, over all pages of their pager.

    lists: list_id, url, selector, and rendered if there is such; seed: list_id, pos, url, title, the first page's accepted. Every further page is
    gated by itself. pages_ may be recorded() already. counts: list_id, pages_scanned, candidates, capped.
    """
    rendered = F.col("rendered") if "rendered" in lists.columns else F.lit(False)
    start = durable(lists.select("list_id", "selector", canonical_url(F.col("url")).alias("start"), F.coalesce(rendered, F.lit(False)).alias("rendered")))
    walked = followed(start.select("start", "rendered").distinct(), pages_ if "_u" in pages_.columns else durable(recorded(pages_)), robots)
    of = start.join(walked, ["start", "rendered"])
    later = of.where("page_no > 1")
    key = F.to_json(F.struct("list_id", "page_no"))
    links_, _ = gated(durable(tried(later.select(key.alias("list_id"), "url", "html"), later.select(key.alias("list_id"), "selector"))))
    more = links_.select(F.get_json_object("list_id", "$.list_id").alias("list_id"), F.get_json_object("list_id", "$.page_no").cast("int").alias("page_no"), "pos", "url", "title")
    # a page that adds nothing is a page all the same
    blank = of.where("page_no > 1").select("list_id", "page_no", F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("title"))
    found = seed.join(lists.select("list_id"), "list_id").select("list_id", F.lit(1).alias("page_no"), "pos", "url", "title").unionByName(more)
    rows = durable(found.unionByName(blank.join(found.select("list_id", "page_no").distinct(), ["list_id", "page_no"], "left_anti")))
    candidates, counts = capped(rows)
    scanned = of.groupBy("list_id").agg(F.max("page_no").alias("pages_scanned"))
    return candidates, scanned.join(counts, "list_id", "left")


def html_scan(lists: DataFrame, pages_: DataFrame, strategies: DataFrame, answers: DataFrame, robots: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Scans of HTML list pages: (outcomes, candidates).

    lists: list_id, url, cached, rendered (whether the rendered page is read). outcomes: list_id, error (null if
    candidates were found), the page's diagnostics, what the ladder learnt, and the pager's counts. candidates: list_id,
    pos, url, title. An unfetched page, a ladder that had nothing to try, and one that was tried in vain are told apart.
    """
    records = durable(recorded(pages_))
    asked = lists.select("*", canonical_url(F.col("url")).alias("_u2"), F.lit("GET").alias("_m2"))
    got = durable(brought(asked, among(records, asked), robots, F.col("rendered")).drop("_u2", "_m2"))
    live = got.where("html IS NOT NULL")
    won, first = climbed(live, strategies, answers)
    first = durable(first)
    candidates, counts = paged(live.join(won.where("selector_used IS NOT NULL").select("list_id", F.col("selector_used").alias("selector")), "list_id").select("list_id", "url", "selector", "rendered"), first, records, robots)
    seen = got.select("list_id", "counted", F.col("html").isNull().alias("_missing"), H.diagnostics(H.clean_html(F.col("html"))).alias("d"))
    error = F.when(F.col("_missing"), "could not fetch listing").when(F.col("rung").isNotNull(), F.lit(None)).when((F.col("tried") == 0) & ~F.coalesce("answered", F.lit(False)), "no selector to try and no inference").otherwise("every rung was tried and gated out")
    out = seen.join(won, "list_id", "left").join(counts, "list_id", "left").select(
        "list_id", error.alias("error"), "counted", "d.fetched_bytes", "d.cleaned_text_length", "d.truncated", "fingerprint", "rung", "selector_used", "worked_strategy_id",
        F.coalesce("blamed", F.lit("")).alias("blamed"), F.coalesce("pages_scanned", F.lit(0)).alias("pages_scanned"), F.coalesce("candidates", F.lit(0)).alias("candidates"), F.coalesce("capped", F.lit(False)).alias("capped"),
    )
    return out, candidates


def next_by_rule(pages_: DataFrame) -> DataFrame:
    """url, next_url by each page's own selector: the first match, or the first link in it, of the same host and not the page itself.

    pages_: url, html, selector, and key. A selector that cannot be read finds nothing.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, url, html, selector in batch[["key", "url", "html", "selector"]].itertuples(index=False):
                tree = H.parse(html or "")
                try:
                    nodes = H.matched(tree, selector)
                except ValueError:
                    continue
                inside = H.anchors_in(tree, nodes[0]) if nodes else []
                href = tree.attributes[inside[0]].get("href") if inside else None
                if href and not href.startswith(("#", "javascript:")):
                    rows.append((key, url, href))
            yield pd.DataFrame(rows, columns=["key", "url", "href"])

    links = pages_.select("key", "url", "html", "selector").mapInPandas(run, "key STRING, url STRING, href STRING").withColumn("next_url", canonical_url(F.col("href"), F.col("url")))
    return links.where((netloc(F.col("next_url")) == netloc(F.col("url"))) & (F.col("next_url") != canonical_url(F.col("url")))).select("key", "url", "next_url")


def rule_scan(lists: DataFrame, pages_: DataFrame, robots: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Scans by rules: (outcomes, candidates).

    lists: list_id, rule (JSON), list_url, url. A rule reads selectors on pages, which it may page through by its own
    next link, or paths in one JSON answer, which it does not page. outcomes: list_id, error, api_style,
    pages_scanned, candidates. candidates: list_id, pos, url, title, payload; each URL once, the first. Pages of a rule
    are gated each; rows of an answer are not. Rows that are no objects or name no URL are left out.
    """
    r = lists.withColumn("r", checked_rule(F.col("rule"))).select(
        "list_id", "r.*", F.get_json_object("rule", "$.item_selector").alias("item"), F.nullif(strip(F.get_json_object("rule", "$.next_page_selector")), F.lit("")).alias("next"),
        F.get_json_object("rule", "$.results_path").alias("results"), F.nullif(F.get_json_object("rule", "$.item_url_path"), F.lit("")).alias("url_path"), F.nullif(F.get_json_object("rule", "$.item_title_path"), F.lit("")).alias("title_path"),
        F.coalesce(F.get_json_object("rule", "$.render").cast("boolean"), F.lit(False)).alias("render"),
        truthy(F.get_json_object("rule", "$.request.url"), F.col("list_url"), F.col("url")).alias("url"), F.col("rule").alias("_rule"),
    )
    r = durable(r)
    bad = F.when(F.coalesce(F.col("_rule"), F.lit("")).isin("", "{}", "null"), "no rule").when(F.try_parse_json("_rule").isNull(), "rule is not JSON").when(F.col("status") != "valid", F.concat(F.lit("invalid rule: "), F.array_join("reasons", "; "))).when(~F.col("usable"), "rule names no way to find items")
    judged = r.select("list_id", bad.alias("bad"))
    good = durable(fetched(r.join(judged.where("bad IS NULL").select("list_id"), "list_id"), pages_, robots, F.col("render")))
    # pages of selector rules, step by step along their own next links
    step = good.where(~F.col("api_style") & F.col("html").isNotNull()).select("list_id", canonical_url(F.col("url")).alias("url"), "html", "item", "next", "max_pages", "render", F.lit(1).alias("page_no"))
    step = durable(step.withColumn("seen", F.array("url")))
    walked = step
    number = 1
    while True:
        onward = step.where(F.col("next").isNotNull() & (F.col("max_pages") > number))
        if onward.isEmpty():
            break
        found = next_by_rule(onward.select(F.col("list_id").alias("key"), "url", "html", F.col("next").alias("selector"))).select(F.col("key").alias("list_id"), "next_url")
        asked = onward.drop("url", "html", "page_no").join(found, "list_id").where(~F.array_contains("seen", F.col("next_url"))).withColumnRenamed("next_url", "url")
        number += 1
        step = durable(fetched(asked, pages_, robots, F.col("render")).where("html IS NOT NULL").select("list_id", "url", "html", "item", "next", "max_pages", "render", F.lit(number).alias("page_no"), F.concat("seen", F.array("url")).alias("seen")))
        walked = walked.unionByName(step)
    key = F.to_json(F.struct("list_id", "page_no"))
    able = walked.where(F.coalesce("item", F.lit("")) != "")
    kept, _ = gated(durable(tried(able.select(key.alias("list_id"), "url", "html"), able.select(key.alias("list_id"), strip(F.col("item")).alias("selector")))))
    from_pages = kept.select(F.get_json_object("list_id", "$.list_id").alias("list_id"), (F.get_json_object("list_id", "$.page_no").cast("int") * 100_000 + F.col("pos")).alias("place"), "url", "title", F.lit(None).cast("string").alias("payload"))
    # rows of one answer
    api = good.where(F.col("api_style") & F.col("html").isNotNull())
    # the results are a top-level key by its whole name, or the answer itself
    rows_json = F.when(F.coalesce("results", F.lit("")) == "", F.col("html")).otherwise(F.try_element_at(F.from_json("html", "MAP<STRING, STRING>"), F.col("results")))
    listed = api.withColumn("rows", F.when(F.ltrim(rows_json).startswith("["), F.from_json(rows_json, "ARRAY<STRING>")))
    rows = listed.select("list_id", "url", "url_path", "title_path", F.posexplode("rows").alias("place", "row")).where(F.ltrim("row").startswith("{"))
    paths = [p.url_path for p in rows.select("url_path").where("url_path IS NOT NULL").distinct().collect()]
    titles = [p.title_path for p in rows.select("title_path").where("title_path IS NOT NULL").distinct().collect()]

    def at(column: str, given: list[str], otherwise: str) -> Column:
        """The value at the row's own path; rules are few, and so are their distinct paths."""
        c = F.get_json_object("row", f"$.{otherwise}")
        for path in given:
            c = F.when(F.col(column) == path, dig(F.col("row"), path)).otherwise(c)
        return c

    named = rows.withColumn("raw", at("url_path", paths, "url")).where(F.coalesce("raw", F.lit("")) != "")
    from_api = named.select("list_id", F.col("place").cast("int").alias("place"), canonical_url(F.col("raw"), F.col("url")).alias("url"), F.nullif(strip(at("title_path", titles, "title")), F.lit("")).alias("title"), F.col("row").alias("payload"))
    first = from_pages.unionByName(from_api).groupBy("list_id", "url").agg(F.min(F.struct("place", "title", "payload")).alias("m")).select("list_id", "url", "m.*")
    candidates = durable(first.withColumn("pos", F.row_number().over(W.partitionBy("list_id").orderBy("place"))).select("list_id", "pos", "url", "title", "payload"))
    n = candidates.groupBy("list_id").agg(F.count("*").alias("n"))
    scanned = walked.groupBy("list_id").agg(F.max("page_no").alias("pages_scanned"))
    shapes = listed.select("list_id", F.col("rows").isNotNull().alias("_rows"), F.try_parse_json("html").isNotNull().alias("_json"))
    error = (
        F.when(F.col("bad").isNotNull(), F.col("bad")).when(F.col("html").isNull(), F.when(F.col("api_style"), "request failed").otherwise("could not fetch listing"))
        .when(F.col("api_style") & ~F.coalesce("_json", F.lit(False)), "answer is not JSON").when(F.col("api_style") & ~F.coalesce("_rows", F.lit(False)), "results are no list")
        .when(F.coalesce("n", F.lit(0)) == 0, "rule found no candidates")
    )
    out = judged.join(good.select("list_id", "api_style", "html"), "list_id", "left").join(n, "list_id", "left").join(scanned, "list_id", "left").join(shapes, "list_id", "left")
    return out.select("list_id", error.alias("error"), F.coalesce("api_style", F.lit(False)).alias("api_style"), F.coalesce("pages_scanned", F.lit(0)).alias("pages_scanned"), F.coalesce("n", F.lit(0)).alias("candidates")), candidates
