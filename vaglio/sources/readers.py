"""Readers of what portals offer: feeds, JSON interfaces, rule files, and the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vaglio.functions.html import visible_text
from vaglio.functions.text import strip
from vaglio.functions.urls import canonical_url, netloc
from vaglio.functions.values import dig
from vaglio.operators.extraction import RULE
from vaglio.operators.history import admitted

#: Kinds of source; an unknown one is read as html.
KINDS = ("rss", "api", "html", "html_js", "rule")
API_PAGES, PAGE_SIZE = 5, 50
#: Defaults of the engine's settings.
CONFIG = {"calls_per_run": 200, "request_delay": 2.0, "timeout": 30.0, "draft_threshold": 3}
FEED = "channel STRUCT<item: ARRAY<STRUCT<title: STRING, link: STRING>>>, entry ARRAY<STRUCT<title: STRING, link: STRUCT<_href: STRING>>>"


def active_sources(sources: DataFrame, source_id: str | None = None) -> DataFrame:
    """The active sources; or the one asked for, active or not."""
    return sources.where(F.col("id") == source_id) if source_id is not None else sources.where("active")


def reader_kind(kind: Column) -> Column:
    return F.when(kind.isin(*KINDS), kind).otherwise("html")


def feed_items(feeds: DataFrame) -> DataFrame:
    """source_id, pos, url, title of the entries with a link, in order. feeds: source_id, xml (RSS or Atom)."""
    read = feeds.select("source_id", F.from_xml("xml", FEED).alias("f"))
    items = F.coalesce(F.transform("f.channel.item", lambda x: F.struct(x["title"].alias("title"), x["link"].alias("link"))), F.transform("f.entry", lambda x: F.struct(x["title"].alias("title"), x["link"]["_href"].alias("link"))))
    rows = read.select("source_id", F.posexplode(items).alias("pos", "x"))
    return rows.where(F.coalesce(strip(F.col("x.link")), F.lit("")) != "").select("source_id", "pos", canonical_url(F.col("x.link")).alias("url"), F.nullif(strip(F.col("x.title")), F.lit("")).alias("title"))


def feed_outcomes(feeds: DataFrame) -> DataFrame:
    """source_id, entries, error of each feed: an error only where it cannot be read and has no entry."""
    n = feed_items(feeds).groupBy("source_id").agg(F.count("*").alias("n"))
    read = feeds.select("source_id", F.from_xml("xml", FEED).alias("f"), "xml")
    known = F.col("f.channel").isNotNull() | F.col("f.entry").isNotNull() | F.coalesce(F.col("xml").rlike(r"(?s)^\s*(?:<\?xml[^>]*>\s*)?<(?:rss|feed)\b.*</(?:rss|feed)>\s*$"), F.lit(False))
    rows = read.select("source_id", known.alias("known")).groupBy("source_id").agg(F.bool_or("known").alias("known")).join(n, "source_id", "left")
    return rows.select("source_id", F.coalesce("n", F.lit(0)).alias("entries"), F.when(~F.col("known") & F.col("n").isNull(), "feed cannot be read").alias("error"))


def api_items(responses: DataFrame, results: str, url_path: str, title_path: str) -> DataFrame:
    """source_id, pos, url, title, payload of the rows of JSON responses, the first of each URL.

    responses: source_id, page, base_url, json. Pages beyond API_PAGES are not read. results is a top-level key;
    rows that are no objects, or name no URL, are left out.
    """
    rows = responses.where(F.col("page") <= API_PAGES).select("source_id", "page", "base_url", F.posexplode(F.from_json(F.get_json_object("json", f"$.{results}"), "ARRAY<STRING>")).alias("k", "row"))
    rows = rows.where(F.ltrim("row").startswith("{")).withColumn("raw", F.coalesce(F.nullif(dig(F.col("row"), url_path), F.lit("")), F.get_json_object("row", "$.url")))
    rows = rows.where(F.coalesce("raw", F.lit("")) != "").withColumn("url", canonical_url(F.col("raw"), F.col("base_url")))
    first = rows.withColumn("nth", F.row_number().over(W.partitionBy("source_id", "url").orderBy("page", "k"))).where("nth = 1")
    title = F.coalesce(F.nullif(dig(F.col("row"), title_path), F.lit("")), dig(F.col("row"), "metadata.title"))
    return first.select("source_id", (F.col("page") * 1000 + F.col("k")).alias("pos"), "url", F.nullif(strip(title), F.lit("")).alias("title"), F.col("row").alias("payload"))


def rule_files(spark: SparkSession, path: str) -> DataFrame:
    """source_id, label, note, rule of a folder of JSON documents, one a file."""
    return spark.read.schema(f"source_id STRING, label STRING, note STRING, rule {RULE}").option("multiLine", True).json(path)


def page_html(pages: DataFrame, shortest: int = 500) -> DataFrame:
    """The plain page, or the rendered one where the plain is missing or its text shorter than shortest; plain if there is no rendered."""
    thin = F.col("html").isNull() | (F.length(visible_text(F.col("html"))) < shortest)
    return pages.withColumn("html", F.when(thin, F.coalesce(F.nullif("rendered_html", F.lit("")), "html")).otherwise(F.col("html")))


def active_topics(topics: DataFrame) -> DataFrame:
    """id, name, description, keywords of the active topics."""
    return topics.where("active").select("id", "name", "description", "keywords")


def settings(rows: DataFrame) -> DataFrame:
    """The settings row, the one of id 1; no row, or more than one, is an error when it is read."""
    one = rows.where("id = 1")
    n = one.agg(F.count("*").alias("_n"))
    return one.join(n, F.lit(True)).where(F.when(F.col("_n") == 1, True).otherwise(F.raise_error(F.lit("settings: not one row of id 1")).cast("boolean"))).drop("_n")


def config(spark: SparkSession, prefix: str = "spark.vaglio.") -> dict[str, object]:
    """The engine's settings of a session under prefix, with their defaults; a value that is no number where one is due is an error."""
    out = {}
    for name, default in CONFIG.items():
        said = spark.conf.get(prefix + name, None)
        out[name] = default if said is None or said == "" else type(default)(said)
    return out


def allowed(pages: DataFrame, robots: DataFrame) -> DataFrame:
    """Pages that their domain's robots file allows; a domain without one allows all. robots: domain, allowed."""
    r = robots.groupBy(F.lower("domain").alias("_d")).agg(F.bool_and("allowed").alias("_ok"))
    return pages.join(r, F.lower(netloc(F.col("url"))) == F.col("_d"), "left").where(F.coalesce("_ok", F.lit(True))).drop("_d", "_ok")


def recorded(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Requests with the answers on record under their key; none is ever asked for. One answer a key, the first by text."""
    return requests.join(responses.groupBy("request_key").agg(F.min("response").alias("response")), "request_key", "left")


def completions(requests: DataFrame, responses: DataFrame, cap: int, budget: int | None) -> DataFrame:
    """requests with status and answer, in order of source_id and seq within a run.

    requests: run_key, source_id, seq, request_key; responses: request_key, response. A request beyond the run's cap or its
    source's budget is over_budget and costs nothing; any other costs a call, whatever comes of it: unavailable (no
    answer on record), invalid (no JSON object) or ok.
    """
    got = recorded(requests, responses).join(admitted(requests.select("run_key", "source_id", "seq"), cap, budget).select("run_key", "source_id", "seq", "admitted"), ["run_key", "source_id", "seq"])
    text = strip(F.col("response"))
    object_ = F.coalesce(text.startswith("{") & F.try_parse_json(text).isNotNull(), F.lit(False))
    status = F.when(~F.col("admitted"), "over_budget").when(F.col("response").isNull(), "unavailable").when(~object_, "invalid").otherwise("ok")
    return got.withColumn("status", status).select(*requests.columns, "status", F.when(F.col("status") == "ok", text).alias("answer"))


def api_totals(responses: DataFrame, results: str, page_size: int) -> DataFrame:
    """source_id, pages_fetched, rows, total_reported of paged JSON answers: the first total that a page names, pages as api_items() reads them."""
    read = read_pages(responses, results, page_size)
    named = F.get_json_object("json", "$.totalResults").try_cast("bigint")
    return read.groupBy("source_id").agg(F.max("page").alias("pages_fetched"), F.sum("n").alias("rows"), F.min(F.when(named.isNotNull(), F.struct("page", named.alias("t")))).alias("m")).select("source_id", "pages_fetched", "rows", F.col("m.t").alias("total_reported"))


def read_pages(responses: DataFrame, results: str, page_size: int) -> DataFrame:
    """responses with rows and n, up to the first page that is missing, short or empty, and API_PAGES at most."""
    rows = responses.where(F.col("page").between(1, API_PAGES)).withColumn("rows", F.from_json(F.get_json_object("json", f"$.{results}"), "ARRAY<STRING>")).withColumn("n", F.coalesce(F.size("rows"), F.lit(0)))
    rows = rows.withColumn("n", F.greatest("n", F.lit(0)))
    by = W.partitionBy("source_id").orderBy("page").rowsBetween(W.unboundedPreceding, -1)
    # API_PAGES rows a source at most
    full = rows.withColumn("_full", F.coalesce(F.bool_and(F.col("n") >= page_size).over(by), F.lit(True))).withColumn("_k", F.row_number().over(W.partitionBy("source_id").orderBy("page")))
    return full.where(F.col("_full") & (F.col("_k") == F.col("page"))).drop("_full", "_k")
