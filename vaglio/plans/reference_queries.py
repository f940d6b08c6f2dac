"""Queries of the web-monitoring operators over the data folder's tables.

There are no stored HTML pages: list pages are built from the candidates of each run, in the same way in Spark and in SQL.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vaglio.functions import html as H
from vaglio.functions import scrub as S
from vaglio.functions import urls as U
from vaglio.functions import values as V
from vaglio.functions.text import content_hash
from vaglio.operators import dedup, extraction, gate, history, incremental, merge, pages
from vaglio.plans import world
from vaglio.session import table
from vaglio.sources import readers


def _base(sources: DataFrame) -> DataFrame:
    return F.broadcast(sources.select(F.col("id").alias("source_id"), U.truthy(F.col("list_url"), F.col("url")).alias("base")))


def _listed(spark: SparkSession, root: str) -> DataFrame:
    """candidate_id, list_id, pos, url (canonical), title, domain of every candidate, in its run's list."""
    c = table(spark, root, "candidates").join(_base(table(spark, root, "sources")), "source_id")
    return c.select(
        "candidate_id", F.col("run_id").cast("string").alias("list_id"), (F.col("pos").cast("long") * 1_000_000_000 + F.col("candidate_id")).alias("pos"),
        U.canonical_url(F.col("url"), F.col("base")).alias("url"), "title", F.lower(U.netloc(F.col("base"))).alias("domain"),
    )


def _escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))


#: Wrappings of a page's title (T) and text (X), as they are met: noise that nests or stays open, character references, other quoting, no body.
NOTICE_SHAPES = (
    "<html><head><title>x</title><style>p{}</style></head><body><nav><a href='/'>Home</a></nav><header>h</header><div class=\"corpo riga is-open\"><h1>T</h1><script>var a=1;</script><!-- c --><p>X</p></div><li class=\"voce nav__a1b2c3\">&copy;</li><footer>f</footer></body></html>",
    "<head><meta content='WordPress 6' name='generator'></head><BODY class=x><nav><nav>a</nav>b</nav><div class='corpo testo'><li class=voce>Attivit&agrave; &#232; l&rsquo;ente &euro; 5 &notit; &amp;lt;</li><p>X</p></div><article class='voce voce'>T</article></BODY>",
    "<body><p>T</p><div class=\"k1 k2 k3 k4 k5 k6 k7 k8 k9\"><label>e</label>X</div><section class='k9 k9b ab'><b>&#x20AC;&nbsp;</b></section><link href='/wp-content/a.css'><form><input value=\"a>b\">modulo<p>aperto</p>",
    "<header>via</header><h2 id=\"t\" style='x'>T</h2><svg><path d='M0'/></svg><div>X</div><select><option>1</option></select><noscript>n</noscript><iframe>i</iframe><p>fine &quot;&#39;&apos;&lt;b&gt;</p>",
)


def _notice_pages(spark: SparkSession, root: str) -> DataFrame:
    """page_id, html: each candidate's page, built around its title and text in one of the shapes."""
    c = table(spark, root, "candidates")
    title, text = F.coalesce(_escape(F.col("title")), F.lit("")), F.coalesce(_escape(F.col("text")), F.lit(""))

    def built(shape: str) -> Column:
        pieces = re.split(r"(?<=[>])([TX])(?=<)", shape)
        return F.concat(*[title if p == "T" else text if p == "X" else F.lit(p) for p in pieces])

    html = F.lit(None).cast("string")
    for k, shape in enumerate(NOTICE_SHAPES):
        html = F.when(F.col("candidate_id") % len(NOTICE_SHAPES) == k, built(shape)).otherwise(html)
    return c.select(F.col("candidate_id").alias("page_id"), html.alias("html"))


def canonical_urls(spark: SparkSession, root: str) -> DataFrame:
    c = table(spark, root, "candidates").join(_base(table(spark, root, "sources")), "source_id")
    return c.select("candidate_id", U.canonical_url(F.col("url"), F.col("base")).alias("canonical"))


def url_hashes(spark: SparkSession, root: str) -> DataFrame:
    return canonical_urls(spark, root).select("candidate_id", U.url_hash(F.col("canonical")).alias("url_hash"))


def content_hashes(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id", content_hash(F.col("text")).alias("content_hash"))


def clean_pages(spark: SparkSession, root: str) -> DataFrame:
    return _notice_pages(spark, root).select("page_id", H.clean_html(F.col("html")).alias("c")).select("page_id", "c.text", "c.original_bytes", "c.text_length", "c.truncated")


def clean_diagnostics(spark: SparkSession, root: str) -> DataFrame:
    return _notice_pages(spark, root).select("page_id", H.diagnostics(H.clean_html(F.col("html"))).alias("d")).select("page_id", "d.*")


def condense_html(spark: SparkSession, root: str) -> DataFrame:
    return _notice_pages(spark, root).select("page_id", H.condense(F.col("html"), True).alias("for_inference"), H.condense(F.col("html"), False).alias("for_drafting"))


def link_candidates(spark: SparkSession, root: str) -> DataFrame:
    """The links that the selector finds on the list page of every run, built from that run's candidates."""
    s = table(spark, root, "sources")
    c = table(spark, root, "candidates")
    item = F.concat(F.lit('<li class="voce"><a href="'), _escape(F.col("url")), F.lit('">'), _escape(F.coalesce("title", F.lit(""))), F.lit("</a></li>"))
    page = c.groupBy("run_id", "source_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "candidate_id", item.alias("h")))), lambda x: x["h"]), "").alias("h"))
    built = page.join(_base(s), "source_id").select(F.col("run_id").cast("string").alias("list_id"), F.col("base").alias("base_url"), F.concat(F.lit('<ul class="esiti">'), "h", F.lit("</ul>")).alias("html"), F.lit("ul.esiti > li.voce").alias("selector"))
    return gate.list_links(built).select("list_id", "pos", "url", "title", "status")


def gate_verdicts(spark: SparkSession, root: str) -> DataFrame:
    return gate.verdicts(gate.judged(_listed(spark, root)))


def gate_accepted(spark: SparkSession, root: str) -> DataFrame:
    return gate.accepted(gate.judged(_listed(spark, root))).select("list_id", "candidate_id", "url")


def page_fingerprints(spark: SparkSession, root: str) -> DataFrame:
    return pages.fingerprints(_notice_pages(spark, root))


def _pool(spark: SparkSession, root: str) -> DataFrame:
    """A pool of strategies, one a source that has a selector."""
    s = table(spark, root, "sources").where("list_selector IS NOT NULL")
    return s.select(F.col("id").alias("strategy_id"), F.concat(F.lit("f"), (F.length("label") % 3).cast("string")).alias("fingerprint"), (F.length("list_selector") % 5).alias("times_worked"), F.row_number().over(W.orderBy("id")).alias("pool_pos"))


def _ladder_pages(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "scan_runs").select(F.col("run_id").alias("page_id"), F.concat(F.lit("f"), (F.col("run_id") % 3).cast("string")).alias("fingerprint"))


def ladder_ranks(spark: SparkSession, root: str) -> DataFrame:
    return pages.ranked_strategies(_ladder_pages(spark, root), _pool(spark, root))


def _pager(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "scan_runs")
    link = lambda k: F.concat(F.lit("https://p.example/"), F.col("source_id"), F.lit("/"), F.col("seq") + k)
    return r.select(link(0).alias("url"), F.when(F.col("seq") % 5 == 4, link(-3)).otherwise(link(1)).alias("next_url"), (F.col("seq") == 0).alias("is_first"))


def next_page(spark: SparkSession, root: str) -> DataFrame:
    """The next page of every page of every run's list."""
    return pages.next_links(world.list_pages(spark, root).select("url", "html"))


def page_walk(spark: SparkSession, root: str) -> DataFrame:
    p = _pager(spark, root)
    return pages.walk(p.where("url LIKE '%/1'").select("url"), p.select("url", "next_url"))


def snapshot_diff(spark: SparkSession, root: str) -> DataFrame:
    """Every page's newest candidate with what its snapshot says of it."""
    newest = incremental.newest_version(incremental.page_versions(table(spark, root, "candidates"), table(spark, root, "sources")))
    old = incremental.ledger_state(table(spark, root, "page_snapshots")).withColumnRenamed("version", "old").withColumn("there", F.lit(True))
    state = F.when(F.col("there").isNull(), "new").when(F.col("version").eqNullSafe(F.col("old")), "unchanged").otherwise("changed")
    return newest.join(old, ["source_id", "page"], "left").select("candidate_id", state.alias("state"))


def snapshot_upsert(spark: SparkSession, root: str) -> DataFrame:
    s = merge.latest(table(spark, root, "page_snapshots"), ["source_id", "url_hash"], ["last_seen_at", F.coalesce("content_hash", F.lit(""))])
    c = table(spark, root, "candidates").join(_base(table(spark, root, "sources")), "source_id")
    new = c.select("source_id", U.url_hash(U.canonical_url(F.col("url"), F.col("base"))).alias("url_hash"), content_hash(F.col("text")).alias("content_hash"), F.col("fetched_at").alias("last_seen_at"), "candidate_id")
    new = merge.latest(new, ["source_id", "url_hash"], ["last_seen_at", -F.col("candidate_id")]).drop("candidate_id")
    return merge.upsert(s, new, ["source_id", "url_hash"])


def grant_upsert(spark: SparkSession, root: str) -> DataFrame:
    """Grants found before the newest run began, with what was found or seen again since merged in. A grant of unknown time, or any if there is no run, is old."""
    began = table(spark, root, "scan_runs").agg(F.max("started_at").alias("began"))
    g = table(spark, root, "grants").select("url_hash", "source_id", "title", "found_at", "last_seen_at", "duplicate_of", "grant_id").crossJoin(F.broadcast(began))
    known = F.coalesce(F.col("found_at") < F.col("began"), F.lit(True))
    seen = F.coalesce(F.col("last_seen_at") >= F.col("began"), F.lit(False))
    old = merge.latest(g.where(known).drop("began"), ["url_hash"], ["last_seen_at", "grant_id"])
    new = merge.latest(g.where(~known | seen).drop("began"), ["url_hash"], ["last_seen_at", "grant_id"])
    return merge.upsert(old, new, ["url_hash"], keep=("found_at",)).drop("grant_id")


def title_normalise(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "grants").select("grant_id", V.normalise_title(F.col("title")).alias("normalised"))


def soft_duplicates(spark: SparkSession, root: str) -> DataFrame:
    """The best match of each grant whose number is divisible by 50, among all grants; of equal scores the smallest number wins."""
    g = table(spark, root, "grants").select("grant_id", "source_id", "title", "deadline")
    return dedup.soft_duplicates(g.where("grant_id % 50 = 0"), g.withColumn("pool_pos", F.col("grant_id")))


def error_streaks(spark: SparkSession, root: str) -> DataFrame:
    return history.error_streaks(table(spark, root, "scan_runs").select("source_id", "seq", "status"))


def autodraft_fires(spark: SparkSession, root: str) -> DataFrame:
    return history.drafts_due(error_streaks(spark, root), table(spark, root, "sources"), threshold=1)


def _ticks(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "scan_runs")
    last = F.lag("finished_at").over(W.partitionBy("source_id").orderBy("seq"))
    rows = r.select("run_id", F.col("started_at").cast("timestamp").alias("now"), last.cast("timestamp").alias("last"))
    return rows.withColumn("frequency", F.explode(F.array(*[F.lit(x) for x in ("hourly", "six_hourly", "daily", "weekly")])))


def schedule_windows(spark: SparkSession, root: str) -> DataFrame:
    t = _ticks(spark, root).where(F.col("frequency").isin("six_hourly", "daily"))
    return t.select("run_id", "frequency", history.window_start(F.col("frequency"), F.col("now")).cast("timestamp_ntz").alias("window_start"))


def schedule_gate(spark: SparkSession, root: str) -> DataFrame:
    t = _ticks(spark, root)
    return t.select("run_id", "frequency", history.should_run(F.col("frequency"), F.col("now"), F.col("last")).alias("run"), history.reason(F.col("frequency"), F.col("now"), F.col("last")).alias("reason"))


def latest_run(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "scan_runs").where("finished_at IS NOT NULL").orderBy(F.desc("finished_at"), "run_id").limit(1).select("run_id", "finished_at")


def strategy_pool(spark: SparkSession, root: str) -> DataFrame:
    return pages.pool_top(_pool(spark, root)).select("strategy_id", "times_worked")


def dedup_pool(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "grants").orderBy(F.desc("found_at"), "grant_id").limit(500).select("grant_id", "source_id", "title", F.col("deadline").cast("string").alias("deadline"))


def active_sources(spark: SparkSession, root: str) -> DataFrame:
    return readers.active_sources(table(spark, root, "sources")).select("id", "label", readers.reader_kind(F.col("type")).alias("reader"), U.truthy(F.col("list_url"), F.col("url")).alias("page"))


def known_url_hashes(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "grants").select("source_id", "url_hash").distinct()


def _outcomes(spark: SparkSession, root: str) -> DataFrame:
    n = table(spark, root, "candidates").groupBy("run_id").agg(F.count("*").alias("new_count"))
    return table(spark, root, "scan_runs").join(n, "run_id", "left").withColumn("new_count", F.coalesce("new_count", F.lit(0)))


def run_summary(spark: SparkSession, root: str) -> DataFrame:
    return history.run_summary(_outcomes(spark, root), ["seq"])


def source_outcomes(spark: SparkSession, root: str) -> DataFrame:
    o = _outcomes(spark, root)
    return o.groupBy("source_id").agg(F.count_if(F.col("status") == "ok").alias("ok_runs"), F.count_if(F.col("status") == "error").alias("error_runs"), F.count_if(F.col("finished_at").isNull()).alias("died"), F.sum("new_count").alias("candidates"))


def track_record(spark: SparkSession, root: str) -> DataFrame:
    """Credits and blames of every run; sources without selector are no strategies."""
    pool = _pool(spark, root).select("strategy_id", "times_worked", F.lit(0).alias("times_failed"))
    r = table(spark, root, "scan_runs").select(F.col("source_id").alias("strategy_id"), "status")
    return merge.track_record(pool, r.where("status = 'ok'"), r.where("status = 'error'"))


def budget_admission(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "scan_runs").select("run_id", "seq")
    c = table(spark, root, "candidates").select("run_id", "source_id", "candidate_id").join(F.broadcast(r), "run_id")
    calls = c.select(F.col("seq").alias("run_key"), "source_id", F.col("candidate_id").alias("seq"))
    return history.admitted(calls, cap=200, budget=12).select("run_key", F.col("seq").alias("candidate_id"), "in_budget", "admitted")


def source_budgets(spark: SparkSession, root: str) -> DataFrame:
    n = table(spark, root, "candidates").groupBy("run_id").agg(F.countDistinct("source_id").alias("sources"), F.count("*").alias("calls"))
    budget = V.source_budget(F.lit(200), F.col("run_id").cast("int") % 40 + 1)
    return n.select("run_id", budget.alias("budget"), V.calls_remaining(F.lit(200), F.col("calls"), budget, F.col("calls")).alias("remaining"))


def relevance_topics(spark: SparkSession, root: str) -> DataFrame:
    score = F.coalesce("relevance_score", F.lit(0.0))
    made = F.array(*[F.struct(F.lit(f"t{k}").alias("topic_id"), F.round(F.abs(score - k / 4), 6).alias("score")) for k in range(3)])
    g = table(spark, root, "grants").select("grant_id", made.alias("r"))
    return g.select("grant_id", F.array_join(V.relevant_topics(F.col("r")), ",").alias("matched_topics"), V.best_relevance(F.col("r")).alias("best_score"))


def amount_parse(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "grants").select("grant_id", V.amount(F.col("funding_text")).alias("amount"))


def category_coerce(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "grants").select("grant_id", V.category(F.col("category")).alias("category"))


def deadline_coerce(spark: SparkSession, root: str) -> DataFrame:
    k = F.col("grant_id") % 6
    day = F.coalesce(F.col("deadline").cast("string"), F.lit("n/d"))
    raw = F.when(k == 0, F.concat(F.substring(day, 1, 4), F.lit("-02-30"))).when(k == 1, F.concat(F.lit("entro il "), day)).when(k == 2, F.concat(F.lit("\u00a0"), day, F.lit("\n"))).when(k == 3, F.concat(day, F.lit("T12:00"))).when(k == 4, F.replace(day, F.lit("-"), F.lit("/"))).otherwise(day)
    return table(spark, root, "grants").select("grant_id", V.deadline(raw).alias("d")).select("grant_id", F.col("d.value").cast("string").alias("deadline"), F.coalesce("d.failed", F.lit(False)).alias("failed"))


def requirements_clean(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "grants").select("grant_id", F.array_join(V.requirements(F.col("requirements")), "|").alias("requirements"))


def json_dig(spark: SparkSession, root: str) -> DataFrame:
    """Paths into objects that hold the events' properties at several depths, in lists and not."""
    p = F.coalesce("props", F.lit("{}"))
    k = F.col("event_id") % 5
    wrap = lambda before, after: F.concat(F.lit(before), p, F.lit(after))
    made = F.when(k == 0, wrap('{"a": [{"b": ', '}], "c": [1, 2]}')).when(k == 1, wrap('{"a": {"b": [', ', 5]}, "c": ["x"]}')).when(k == 2, wrap('{"a": {"b": ', '}, "c": {"d": "e"}}')).when(k == 3, wrap('[{"a": {"b": ', '}, "c": []}]')).otherwise(wrap('{"a": 4, "z": ', ', "c": "testo"}'))
    e = table(spark, root, "events").select("event_id", made.alias("j"))
    return e.select("event_id", V.dig(F.col("j"), "a.b.k").alias("k"), V.dig(F.col("j"), "c").alias("c"), V.dig(F.col("j"), "a.x.y").alias("missing"))


def payload_text(spark: SparkSession, root: str) -> DataFrame:
    c = table(spark, root, "candidates")
    n = F.col("candidate_id").cast("string")
    extra = F.when(F.col("pos") % 3 == 0, F.concat(F.lit('"callTitle": ["C'), n, F.lit('", "z"], "programmeDivision": [], "other": "no", '))).when(F.col("pos") % 3 == 1, F.concat(F.lit('"closingDate": null, "description": "d '), n, F.lit('", '))).otherwise(F.lit(""))
    summary = F.when(F.col("pos") % 2 == 0, F.concat(F.lit('"summary": "s'), F.col("pos").cast("string"), F.lit('", '))).otherwise(F.lit('"summary": "", '))
    made = F.concat(F.lit("{"), summary, F.lit('"metadata": {'), extra, F.lit('"budget": ['), n, F.lit('], "duration": "", "deadlineModel": "m"}}'))
    return c.select("candidate_id", V.payload_text(F.col("title"), made, F.col("url")).alias("text"))


def _responses(spark: SparkSession, root: str) -> DataFrame:
    """Model responses around the grants' own values: whole, broken, without grant, overlong, with impossible days and scores out of range."""
    g = table(spark, root, "grants")
    k = F.col("grant_id") % 12
    grant = F.to_json(F.struct(
        F.when(k != 7, F.coalesce(F.nullif("title", F.lit("")), F.lit("Senza"))).alias("title"), F.when(k == 8, F.repeat(F.lit("i"), 301)).otherwise(F.col("issuer")).alias("issuer"), F.col("category"),
        F.when(k == 6, F.lit("2026-02-30")).otherwise(F.coalesce(F.col("deadline").cast("string"), F.lit("a sportello"))).alias("deadline"), F.col("funding_text").alias("funding_max"), "requirements",
    ))
    score = F.when(k == 9, F.lit("1.5")).when(k == 10, F.lit("-0.1")).otherwise(F.lit("0.5"))
    whole = F.concat(F.lit('{"grant": '), grant, F.lit(', "relevance": [{"topic_id": "t", "score": '), score, F.lit("}]}"))
    first = F.when(k == 0, F.lit("no json")).when(k == 1, F.lit('{"grant": null, "relevance": []}')).when(k == 2, F.lit('{"relevance": []}')).when(k == 3, F.concat(F.lit("["), whole, F.lit("]"))).when(k == 4, F.expr("left(w, length(w) - 2)")).otherwise(whole)
    second = F.when(F.col("grant_id") % 2 == 0, F.lit('{"grant": {"title": "Secondo"}}')).when(F.col("grant_id") % 3 == 0, F.lit('{"grant": null}')).otherwise(F.lit("{"))
    return g.withColumn("w", whole).select("grant_id", first.alias("first"), second.alias("second"))


def extraction_validate(spark: SparkSession, root: str) -> DataFrame:
    e = extraction.extracted(_responses(spark, root))
    return e.select("grant_id", "attempt", "outcome", F.col("record.title").alias("title"), F.col("record.category").alias("category"), F.col("record.funding_max").alias("funding_max"), F.col("record.deadline").cast("string").alias("deadline"))


def quarantine(spark: SparkSession, root: str) -> DataFrame:
    return extraction.extracted(_responses(spark, root)).where("outcome = 'quarantined'").select("grant_id", "status")


def rule_validate(spark: SparkSession, root: str) -> DataFrame:
    """Rules made from the sources' selectors, some of them hostile or out of range."""
    s = table(spark, root, "sources")
    bad = F.when(F.length("label") % 4 == 0, F.lit("javascript:x")).otherwise(F.coalesce("list_selector", F.lit("")))
    made = F.concat(F.lit('{"item_selector": "'), bad, F.lit('", "max_pages": '), (F.length("url") % 25).cast("string"), F.lit(', "request": {"method": "'), F.when(F.length("url") % 3 == 0, F.lit("delete")).otherwise(F.lit("post")), F.lit('"}, "extra": 1}'))
    return s.select("id", extraction.checked_rule(made).alias("r"), pages.safe_selector(bad).alias("safe")).select("id", "safe", "r.status", "r.usable", "r.api_style", "r.method", "r.max_pages")


def scrub_text(spark: SparkSession, root: str) -> DataFrame:
    """Documents with every shape of secret, and two literal ones of which one begins the other; keys are put together here, none is one."""
    keys = [F.concat(F.lit(" " + a), F.lit(b), F.repeat(F.lit("a1"), 12)) for a, b in (("s", "k-"), ("r", "e_"), ("gh", "p_"), ("github", "_pat_"), ("sb_", "secret_"))]
    token = F.concat(F.lit(" ey"), F.lit("J"), F.repeat(F.lit("b2"), 5), F.lit("."), F.repeat(F.lit("c3"), 5), F.lit(".d4"))
    made = F.concat(F.col("text"), F.lit(" a.b@c.example hunter2hunter2-x hunter2hunter2 corto"), *keys, token, F.lit(" Authorization: Bearer abc, fine\nApi-Key=xyz; ok"))
    return table(spark, root, "documents").select("doc_id", S.scrub(made, ["hunter2hunter2", "corto", "hunter2hunter2-x"]).alias("text"))


def api_candidates(spark: SparkSession, root: str) -> DataFrame:
    c = table(spark, root, "candidates").join(_base(table(spark, root, "sources")), "source_id")
    row = F.to_json(F.struct(F.struct(F.array("url").alias("u")).alias("metadata"), F.col("title").alias("titolo")))
    made = c.groupBy("run_id", "base").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "candidate_id", row.alias("j")))), lambda x: x["j"]), ",").alias("j"))
    pages_ = made.select(F.col("run_id").cast("string").alias("source_id"), F.lit(1).alias("page"), F.col("base").alias("base_url"), F.concat(F.lit('{"esiti": ['), "j", F.lit("]}")).alias("json"))
    return readers.api_items(pages_, "esiti", "metadata.u", "titolo").select(F.col("source_id").alias("run_id"), "url", "title")


def _feeds(spark: SparkSession, root: str) -> DataFrame:
    """A feed of every run: RSS, Atom, one that breaks off behind its last entry, or a page that is none."""
    c = table(spark, root, "candidates").join(_base(table(spark, root, "sources")), "source_id").withColumn("u", _escape(U.canonical_url(F.col("url"), F.col("base"))))
    t = _escape(F.coalesce("title", F.lit("")))
    item = F.concat(F.lit("<item><title>"), t, F.lit("</title><link>"), "u", F.lit("</link></item>"))
    entry = F.concat(F.lit("<entry><title>"), t, F.lit('</title><link rel="alternate" href="'), "u", F.lit('"/></entry>'))
    k = F.col("run_id") % 4
    joined = lambda n: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "candidate_id", n.alias("x")))), lambda x: x["x"]), "")
    made = c.groupBy("run_id").agg(joined(item).alias("i"), joined(entry).alias("e"))
    xml = F.when(k == 1, F.concat(F.lit("<feed><title>f</title>"), "e", F.lit("<entry><title>senza</title></entry></feed>"))).when(k == 3, F.lit("<html><body>errore")).otherwise(F.concat(F.lit("<rss><channel><title>f</title>"), "i", F.lit("<item><title>senza</title></item></channel></rss>")))
    return made.select(F.col("run_id").cast("string").alias("source_id"), xml.alias("xml"))


def rss_candidates(spark: SparkSession, root: str) -> DataFrame:
    return readers.feed_items(_feeds(spark, root)).select(F.col("source_id").alias("run_id"), "pos", "url", "title")


def rss_outcomes(spark: SparkSession, root: str) -> DataFrame:
    return readers.feed_outcomes(_feeds(spark, root)).select(F.col("source_id").alias("run_id"), "entries", "error")


def page_urls(spark: SparkSession, root: str) -> DataFrame:
    s = table(spark, root, "sources").select("id", "url", F.get_json_object("api_config", "$.page_param").alias("parameter"), F.explode(F.sequence(F.lit(1), F.lit(5))).alias("page"))
    return s.select("id", "page", V.page_url(F.col("url"), F.col("parameter"), F.col("page")).alias("page_url"))


def prompts(spark: SparkSession, root: str) -> DataFrame:
    """What a model is asked about each candidate, with topics made of the portals' types; with none where the candidate's number is divisible by seven."""
    made = table(spark, root, "sources").groupBy("type").agg(F.count("*").alias("n")).select(F.concat(F.lit("t-"), "type").alias("id"), F.col("type").alias("name"), F.when(F.col("n") > 8, F.concat(F.lit("da "), F.col("n").cast("string"))).alias("description"))
    every = V.topic_list(made)
    c = table(spark, root, "candidates").join(F.broadcast(every), F.lit(True))
    return c.select("candidate_id", V.prompt(F.col("url"), F.when(F.col("candidate_id") % 7 != 0, F.col("topics")), F.col("text")).alias("prompt"))


QUERIES = {f.__name__: f for f in (
    canonical_urls, url_hashes, content_hashes, clean_pages, clean_diagnostics, condense_html, link_candidates, gate_verdicts, gate_accepted, page_fingerprints,
    ladder_ranks, next_page, page_walk, snapshot_diff, snapshot_upsert, grant_upsert, title_normalise, soft_duplicates, error_streaks, autodraft_fires,
    schedule_windows, schedule_gate, latest_run, strategy_pool, dedup_pool, active_sources, known_url_hashes, run_summary, source_outcomes, track_record, budget_admission,
    source_budgets, relevance_topics, amount_parse, category_coerce, deadline_coerce, requirements_clean, json_dig, payload_text, extraction_validate, quarantine,
    rule_validate, scrub_text, api_candidates, rss_candidates, rss_outcomes, page_urls, prompts,
)}
