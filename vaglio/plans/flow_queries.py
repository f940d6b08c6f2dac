"""Queries of the composed flows: scans of pages, the ladder, candidates to records, runs, drafts, and the replay of the change feed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaglio.functions import urls as U
from vaglio.functions import values as V
from vaglio.operators import flow, history, incremental, merge, pages, scan
from vaglio.plans import world
from vaglio.session import durable, once, shared_folder, table
from vaglio.sources import readers


@once
def _pages(spark: SparkSession, root: str) -> DataFrame:
    return world.list_pages(spark, root)


def fetched_pages(spark: SparkSession, root: str) -> DataFrame:
    """What the first page of every run's list brought, plain."""
    return scan.fetched(world.runs(spark, root).select("list_id", "url"), _pages(spark, root), world.robots(spark, root)).select("list_id", F.col("html").isNotNull().alias("brought"), "counted")


def robots_allowed(spark: SparkSession, root: str) -> DataFrame:
    return readers.allowed(world.runs(spark, root).select("list_id", "url"), world.robots(spark, root)).select("list_id")


def _lists(spark: SparkSession, root: str) -> DataFrame:
    r = world.runs(spark, root).where("type IN ('html', 'html_js')")
    return r.select("list_id", "url", "cached", (F.col("type") == "html_js").alias("rendered"))


@once
def _html(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    return scan.html_scan(_lists(spark, root), _pages(spark, root), world.strategy_pool(spark), world.answers(spark, root), world.robots(spark, root))


def scan_html(spark: SparkSession, root: str) -> DataFrame:
    return _html(spark, root)[0].select("list_id", "error", "rung", "selector_used", "worked_strategy_id", "blamed", "pages_scanned", "candidates", "capped")


def scan_html_candidates(spark: SparkSession, root: str) -> DataFrame:
    return _html(spark, root)[1].select("list_id", "pos", "url", "title")


@once
def ladder_run(spark: SparkSession, root: str) -> DataFrame:
    """The ladder on the first page of every run's list that was brought, each attempt extracted and gated."""
    lists = scan.fetched(world.runs(spark, root), _pages(spark, root), world.robots(spark, root), F.col("type") == "html_js").where("html IS NOT NULL")
    out, _ = scan.climbed(durable(lists.select("list_id", "url", "html", "cached")), world.strategy_pool(spark), world.answers(spark, root))
    return out.select("list_id", "fingerprint", "rung", "selector_used", "worked_strategy_id", "blamed")


def selector_answers(spark: SparkSession, root: str) -> DataFrame:
    return scan.answered_selector(world.answers(spark, root))


def pool_learning(spark: SparkSession, root: str) -> DataFrame:
    """The pool after the ladders of all runs: credits and blames, and selectors that the pool did not have."""
    out = ladder_run(spark, root)
    pool = world.strategy_pool(spark)
    worked = out.where("worked_strategy_id IS NOT NULL").select(F.col("worked_strategy_id").alias("strategy_id"))
    blamed = out.select(F.explode(F.split("blamed", ",")).alias("strategy_id")).where("strategy_id <> ''")
    learnt = merge.track_record(pool, worked, blamed)
    new = out.where("worked_strategy_id IS NULL AND selector_used IS NOT NULL").select(F.col("selector_used").alias("list_selector"), "fingerprint")
    return merge.remember(learnt, new).select("list_selector", "fingerprint", F.col("times_worked").cast("bigint").alias("times_worked"), F.col("times_failed").cast("bigint").alias("times_failed"))


def cached_selectors(spark: SparkSession, root: str) -> DataFrame:
    """Each source's selector after the ladder on the list of its newest run."""
    r = world.runs(spark, root).join(table(spark, root, "scan_runs").groupBy("source_id").agg(F.max("run_id").alias("run_id")), ["source_id", "run_id"])
    used = ladder_run(spark, root).join(r.select("list_id", "source_id"), "list_id")
    return flow.cache_selectors(table(spark, root, "sources"), used).select("id", "list_selector")


def _rules(spark: SparkSession, root: str) -> DataFrame:
    """The runs of rule sources under their own rule and four more: one that pages, one of an interface, a broken one and none."""
    r = world.runs(spark, root).where("type = 'rule'").join(table(spark, root, "sources").select(F.col("id").alias("source_id"), "extraction_rules"), "source_id")
    rules = F.array(
        F.struct(F.lit("a").alias("v"), F.col("extraction_rules").alias("rule")), F.struct(F.lit("b").alias("v"), F.lit('{"item_selector": " div.voce ", "next_page_selector": "link[rel=next], a[href*=pagina]", "max_pages": 2}').alias("rule")),
        F.struct(F.lit("c").alias("v"), F.concat(F.lit('{"results_path": "esiti", "item_url_path": "meta.u", "item_title_path": "t", "request": {"url": "'), "url", F.lit('?format=json"}}')).alias("rule")),
        F.struct(F.lit("d").alias("v"), F.lit('{"item_selector": "li", "max_pages": 40}').alias("rule")), F.struct(F.lit("e").alias("v"), F.lit("{oops").alias("rule")), F.struct(F.lit("f").alias("v"), F.lit('{"note": "x"}').alias("rule")),
        F.struct(F.lit("g").alias("v"), F.lit(None).cast("string").alias("rule")),
    )
    return r.withColumn("x", F.explode(rules)).select(F.concat("list_id", "x.v").alias("list_id"), "x.rule", F.lit(None).cast("string").alias("list_url"), "url")


def _rule_pages(spark: SparkSession, root: str) -> DataFrame:
    """The list pages, and a JSON answer for each list."""
    c = table(spark, root, "candidates").select("run_id", "candidate_id", "pos", "url", "title")
    row = F.to_json(F.struct(F.struct(F.array("url").alias("u")).alias("meta"), F.col("title").alias("t")))
    made = c.groupBy("run_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "candidate_id", row.alias("j")))), lambda x: x["j"]), ",").alias("j"))
    api = made.join(world.runs(spark, root).where("type = 'rule'").select("run_id", F.concat("url", F.lit("?format=json")).alias("url")), "run_id")
    body = F.when(F.col("run_id") % 5 == 0, F.lit("<html>")).otherwise(F.concat(F.lit('{"totale": 5, "esiti": ['), "j", F.lit(', 7, {"t": "senza"}]}')))
    return _pages(spark, root).unionByName(api.select("url", F.lit("GET").alias("method"), F.lit(200).alias("status"), body.alias("html")), allowMissingColumns=True)


@once
def _ruled(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    return scan.rule_scan(_rules(spark, root), durable(_rule_pages(spark, root)), world.robots(spark, root))


def scan_rules(spark: SparkSession, root: str) -> DataFrame:
    return _ruled(spark, root)[0]


def scan_rules_candidates(spark: SparkSession, root: str) -> DataFrame:
    return _ruled(spark, root)[1].select("list_id", "pos", "url", "title")


CAP, BUDGET = 4000, 90


def _candidates(spark: SparkSession, root: str) -> DataFrame:
    """Each page's newest candidate; the payload is kept of interface sources only, the others have a page built around their text."""
    c, s = table(spark, root, "candidates"), table(spark, root, "sources")
    kind = s.select(F.col("id").alias("source_id"), "type", U.truthy(F.col("list_url"), F.col("url")).alias("base"))
    rows = c.join(F.broadcast(kind), "source_id").withColumn("url", U.canonical_url(F.col("url"), F.col("base")))
    newest = merge.latest(rows.select("source_id", "url", "fetched_at", "candidate_id", "title", "text", "type", "payload"), ["source_id", "url"], ["fetched_at", -F.col("candidate_id")])
    return newest.select("source_id", F.col("candidate_id").alias("pos"), "url", "title", F.when(F.col("type") == "api", F.coalesce("payload", F.lit("{}"))).alias("payload"), "text")


def _detail_pages(spark: SparkSession, root: str) -> DataFrame:
    c = _candidates(spark, root)
    one = c.groupBy("url").agg(F.min(F.struct("pos", "text")).alias("m"))
    escaped = F.replace(F.replace(F.coalesce("m.text", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    status = F.when(F.col("m.pos") % 23 == 0, 500).otherwise(200)
    return one.select("url", F.lit("GET").alias("method"), status.alias("status"), F.concat(F.lit("<html><body><header>Portale</header><p>"), escaped, F.lit("</p><footer>fine</footer></body></html>")).alias("html"))


def _answers(spark: SparkSession, root: str) -> DataFrame:
    """Recorded answers for pages: whole ones, broken ones mended or not by the second, and pages that are no grants."""
    c = _candidates(spark, root)
    named = F.concat(F.lit("Scheda "), F.substring(U.url_hash(F.col("url")), 1, 8))
    whole = F.to_json(F.struct(F.struct(named.alias("title"), F.lit("training").alias("category"), F.lit("2026-09-15").alias("deadline")).alias("grant"), F.array(F.struct(F.lit("t1").alias("topic_id"), ((F.length("url") % 11) / 10.0).cast("double").alias("score"))).alias("relevance")))
    k = F.length("url") % 10
    first = F.when(k == 0, F.lit('{"grant": null}')).when(k == 1, F.lit('{"grant": {"title": "", "deadline": "2026-02-30"}}')).when(k == 2, F.lit("no")).otherwise(whole)
    rows = c.select(U.url_hash(F.col("url")).alias("url_hash"), first.alias("first"), F.when(k == 1, whole).when(k == 2, F.lit('{"grant": {"issuer": "x"}, "relevance": [{"topic_id": "t", "score": 2}]}')).alias("second"))
    return rows.groupBy("url_hash").agg(F.min(F.struct("first", "second")).alias("m")).select("url_hash", "m.first", "m.second")


def _pool(spark: SparkSession, root: str) -> DataFrame:
    g = table(spark, root, "grants").orderBy(F.desc("found_at"), "grant_id").limit(500)
    return g.select("grant_id", "source_id", "title", "deadline", F.row_number().over(pages.W.orderBy(F.desc("found_at"), "grant_id")).alias("pool_pos"))


@once
def _processed(spark: SparkSession, root: str) -> DataFrame:
    read = flow.page_texts(_candidates(spark, root).drop("text"), _detail_pages(spark, root))
    return flow.processed(read, table(spark, root, "page_snapshots"), _answers(spark, root), _pool(spark, root), CAP, BUDGET)


def process_candidates(spark: SparkSession, root: str) -> DataFrame:
    return _processed(spark, root).select("source_id", F.col("pos").alias("candidate_id"), "outcome", F.col("calls").cast("int").alias("calls"), F.col("record.title").alias("title"), "retry_errors", "message")


def scanned_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Snapshots after the run: old ones, and those of stored and rejected pages."""
    done = flow.snapshot_rows(_processed(spark, root), F.lit("2030-01-01").cast("timestamp_ntz"))
    old = merge.latest(table(spark, root, "page_snapshots"), ["source_id", "url_hash"], ["last_seen_at", F.coalesce("content_hash", F.lit(""))])
    return merge.upsert(old, done, ["source_id", "url_hash"]).select("source_id", "url_hash", "content_hash", F.col("last_seen_at").cast("string").alias("last_seen_at"), "is_new")


def stored_grants(spark: SparkSession, root: str) -> DataFrame:
    """Records after the run, by url_hash."""
    g = merge.latest(table(spark, root, "grants").drop("duplicate_of", "duplicate_score"), ["url_hash"], ["last_seen_at", "grant_id"])
    return flow.store(g, _processed(spark, root), F.lit("2030-01-01").cast("timestamp_ntz")).select("url_hash", "source_id", "title", "category", F.col("deadline").cast("string").alias("deadline"), F.col("found_at").cast("string").alias("found_at"), "is_new")


@once
def _results(spark: SparkSession, root: str) -> DataFrame:
    s = table(spark, root, "sources")
    error = F.when(F.length("label") % 6 == 0, F.concat(F.lit("could not fetch listing of scrivi@portale.example: "), F.repeat(F.lit("x"), 1200)))
    scans = s.select(F.col("id").alias("source_id"), error.alias("error"), F.lit(1).alias("pages_scanned"))
    done = _processed(spark, root).join(scans.where("error IS NULL").select("source_id"), "source_id", "left_semi")
    return flow.source_results(s, scans, done, table(spark, root, "grants"))


def run_results(spark: SparkSession, root: str) -> DataFrame:
    """Each source's result as it is logged."""
    return history.run_rows(_results(spark, root)).select("source_id", "status", "new_count", "updated_count", "pages_fetched", "llm_calls", F.length("log").alias("log_length"))


def run_totals(spark: SparkSession, root: str) -> DataFrame:
    return flow.run_summary(_results(spark, root), table(spark, root, "sources")).drop("log")


def source_status(spark: SparkSession, root: str) -> DataFrame:
    """Sources after the run."""
    o = _results(spark, root).select("source_id", "status", "error", F.lit("2030-01-01").cast("timestamp_ntz").alias("at"))
    return history.source_status(table(spark, root, "sources"), o).select("id", "last_status", "last_error", "consecutive_errors", F.col("last_scan_at").cast("string").alias("last_scan_at"))


def errored_sources(spark: SparkSession, root: str) -> DataFrame:
    return _results(spark, root).where("status = 'error'").select("source_id")


def run_log(spark: SparkSession, root: str) -> DataFrame:
    """Run rows with a log that holds secrets, some right at the cut."""
    r = table(spark, root, "scan_runs")
    log = F.concat(F.repeat(F.lit("r"), (4960 + F.col("run_id") % 60).cast("int")), F.lit(" hunter2hunter2-x hunter2hunter2 gh"), F.lit("p_"), F.repeat(F.lit("a1"), 9), F.lit(" fine"))
    return history.run_rows(r.select("run_id", log.alias("log")), ["hunter2hunter2", "hunter2hunter2-x"]).select("run_id", "log")


def rule_drafts(spark: SparkSession, root: str) -> DataFrame:
    """Drafts and the proposals that they open, for sources whose streak of errors just reached one."""
    due = history.drafts_due(history.error_streaks(table(spark, root, "scan_runs").select("source_id", "seq", "status")), table(spark, root, "sources"), threshold=1).select("source_id").distinct()
    s = table(spark, root, "sources").select(F.col("id").alias("source_id"), "label", F.lit(1).alias("streak"))
    due = due.join(s, "source_id")
    k = F.length("label") % 4
    answer = F.when(k == 0, F.lit('{"item_selector": "li.voce", "max_pages": 3, "note": "lista"}')).when(k == 1, F.lit('{"item_selector": "<script>", "max_pages": 0, "request": {"method": "put"}}')).when(k == 2, F.lit('{"note": ""}')).otherwise(F.lit('{"results_path": "esiti", "item_url_path": "u"}'))
    drafted = flow.drafts(due, s.select("source_id", answer.alias("answer")))
    open_ = s.where("length(label) % 3 = 0").select("source_id", F.lit("old").alias("path"), F.lit("old").alias("content"), F.lit("open").alias("state"))
    rule = F.get_json_object("content", "$.rule.item_selector")
    done = flow.proposals(open_, drafted).select("source_id", "path", rule.alias("item_selector"), "opened")
    return drafted.select("source_id", "ok", "note").join(done, "source_id", "full")


def topics(spark: SparkSession, root: str) -> DataFrame:
    """Topics made of the categories of the grants; the active ones as a run reads them."""
    g = table(spark, root, "grants").where("category IS NOT NULL").groupBy(V.category(F.col("category")).alias("name")).agg(F.count("*").alias("n"))
    made = g.select(F.substring(F.sha2("name", 256), 1, 8).alias("id"), "name", F.when(F.col("n") % 2 == 0, F.concat(F.lit("su "), "name")).alias("description"), F.lit(None).cast("string").alias("keywords"), (F.length("name") > 5).alias("active"))
    return readers.active_topics(made)


def settings(spark: SparkSession, root: str) -> DataFrame:
    rows = spark.createDataFrame([(1, "daily"), (2, "hourly")], "id INT, scan_frequency STRING")
    return readers.settings(rows)


def last_completed(spark: SparkSession, root: str) -> DataFrame:
    """The newest finished row of all sources, among runs of single sources and such rows made one a seq."""
    r = table(spark, root, "scan_runs").select("source_id", "seq", "finished_at", "status")
    every = r.groupBy("seq").agg(F.max("finished_at").alias("finished_at")).select(F.lit(None).cast("string").alias("source_id"), "seq", F.col("finished_at"), F.lit("error").alias("status"))
    return history.last_completed(r.withColumn("finished_at", F.col("finished_at") + F.expr("INTERVAL 9 DAYS")).unionByName(every))


def api_totals(spark: SparkSession, root: str) -> DataFrame:
    """How many items each run's interface says it has, and how many its pages give, PER_PAGE a page, until a short one."""
    c = table(spark, root, "candidates").select("run_id", "candidate_id", "pos")
    nth = c.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("pos", "candidate_id"))).alias("l")).select("run_id", F.size("l").alias("n"), F.posexplode("l").alias("k", "x"))
    row = F.to_json(F.struct(F.concat(F.lit("/i/"), F.col("x.candidate_id").cast("string")).alias("url")))
    made = nth.groupBy("run_id", "n", F.floor(F.col("k") / world.PER_PAGE).alias("p")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", row.alias("j")))), lambda x: x["j"]), ",").alias("j"))
    total = F.when(F.col("p") > 0, F.concat(F.lit('"totalResults": '), F.col("n").cast("string"), F.lit(", "))).otherwise(F.lit(""))
    body = F.concat(F.lit("{"), total, F.lit('"esiti": ['), "j", F.lit("]}"))
    responses = made.select(F.col("run_id").cast("string").alias("source_id"), (F.col("p") + 1).cast("int").alias("page"), F.lit("https://i.example/").alias("base_url"), body.alias("json"))
    return readers.api_totals(responses, "esiti", world.PER_PAGE)


def completions(spark: SparkSession, root: str) -> DataFrame:
    """Requests for every candidate against answers on record, within a budget of 25 calls a source and 900 a run."""
    c = table(spark, root, "candidates").select(F.lit("run").alias("run_key"), "source_id", F.col("candidate_id").alias("seq"), F.col("candidate_id").cast("string").alias("request_key"))
    k = F.col("candidate_id") % 5
    answer = F.when(k == 0, F.lit("[1]")).when(k == 1, F.lit("testo")).when(k == 2, F.lit('{"a": 1}')).when(k == 3, F.lit(' {"b": [2]} '))
    a = table(spark, root, "candidates").select(F.col("candidate_id").cast("string").alias("request_key"), answer.alias("response")).where("response IS NOT NULL")
    return readers.completions(c, a, cap=900, budget=25).select(F.col("seq").alias("candidate_id"), "status", "answer")


def p3_replay(spark: SparkSession, root: str) -> DataFrame:
    """step, candidate_id: what each of the runs, one after the other, handles through the change feed.

    Step k sees what had arrived when the last run of seq k ended, rereads from the marks of the runs before, and
    commits; every fourth step fails before its commit and leaves its pages to the next one.
    """
    c, s, r = table(spark, root, "candidates"), table(spark, root, "sources"), table(spark, root, "scan_runs")
    ends = {x.seq: x.at for x in r.groupBy("seq").agg(F.max(F.coalesce("finished_at", "started_at")).alias("at")).collect()}  # one row a run of all sources
    feed = incremental.ChangeFeed(spark, f"{shared_folder(spark)}/feed-{uuid.uuid4().hex}")
    out = None
    at = None
    for seq in sorted(ends):
        at = max(x for x in (at, ends[seq]) if x is not None)
        cut = F.lit(at)
        marks = incremental.low_water_mark(r.where((F.col("seq") <= seq) & (F.coalesce("finished_at", "started_at") <= cut)))
        due = durable(feed.pending(c.where(F.col("arrived_at") <= cut), s))
        if seq % 4 == 3:
            continue
        feed.commit(due, marks.select("source_id", F.least("reread_from", F.lit(at)).alias("reread_from")))
        step = due.select(F.lit(seq).alias("step"), "candidate_id")
        out = step if out is None else out.unionByName(step)
    return out if out is not None else spark.createDataFrame([], "step INT, candidate_id BIGINT")


QUERIES = {f.__name__: f for f in (
    fetched_pages, robots_allowed, scan_html, scan_html_candidates, ladder_run, selector_answers, pool_learning, cached_selectors, scan_rules, scan_rules_candidates, process_candidates, scanned_snapshots,
    stored_grants, run_results, run_totals, source_status, errored_sources, run_log, rule_drafts, topics, settings, last_completed, api_totals, completions, p3_replay,
)}
