"""What stands in for the world outside: list pages of every run, built from its candidates in several layouts, robots, a pool of selectors and recorded answers.

The literal rows are given to Spark and to the SQL alike; what must come out of them is stated in the SQL only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaglio.functions import urls as U
from vaglio.session import table

PER_PAGE = 3
#: layout, selector that finds its items, what opens the list, an item around its link, what closes the list.
LAYOUTS = (
    (0, "ul.esiti li", "<ul class='esiti'>", "<li>", "</li>", "</ul>"),
    (1, "article.voce", "<section>", '<article class="voce is-new"><h3>', "</h3></article>", "</section>"),
    (2, "div.scheda-avviso", "<div>", "<div class=scheda-avviso>", "</div>", "</div>"),
    (3, "table.risultati td.titolo", "<table class=\"risultati\">", "<tr><td class='titolo'>", "</td><td>x</td></tr>", "</table>"),
    (4, "div.voce a", "<div>", "<div class='voce'>", "</div>", "</div>"),
)
#: strategy_id, list_selector, classes of the pages it is known from, times_worked, times_failed.
POOL = (
    ("p1", "nav a", "voce", 9, 1), ("p2", "ul.esiti li", "", 4, 0), ("p3", "article.voce", "voce", 4, 2), ("p4", "li:nth-child(", None, 50, 0), ("p5", "div.scheda-avviso", "scheda-avviso", 1, 0),
    ("p6", "footer a", "scheda-avviso", 7, 3), ("p7", "ul.esiti li", "voce", 2, 0), ("p8", ".nowhere", "", 3, 3),
)


def strategy_pool(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([(*r, i) for i, r in enumerate(POOL)], "strategy_id STRING, list_selector STRING, shape STRING, times_worked INT, times_failed INT, pool_pos INT")
    return rows.withColumn("fingerprint", F.concat(F.lit("drupal:"), F.substring(F.sha2("shape", 256), 1, 12))).drop("shape")


def layouts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LAYOUTS), "layout INT, selector STRING, opens STRING, before STRING, after STRING, closes STRING")


def runs(spark: SparkSession, root: str) -> DataFrame:
    """list_id, source_id, type, cached, layout, host, url of each run's list."""
    s = table(spark, root, "sources")
    base = U.truthy(F.col("list_url"), F.col("url"))
    s = s.select(F.col("id").alias("source_id"), "type", "label", F.col("list_selector").alias("cached"), F.lower(U.netloc(base)).alias("host"))
    r = table(spark, root, "scan_runs").select("run_id", "source_id", "seq").join(F.broadcast(s), "source_id")
    layout = F.when(F.col("type") == "rule", 4).otherwise((F.length("label") + F.floor(F.col("seq") / 5)) % 4).cast("int")
    return r.select(F.col("run_id").cast("string").alias("list_id"), "run_id", "source_id", "type", "cached", layout.alias("layout"), "host", F.concat(F.lit("https://"), "host", F.lit("/elenco-"), F.col("run_id").cast("string")).alias("url"))


def _escape(c):
    for plain, name in (("&", "&amp;"), ("<", "&lt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(plain), F.lit(name))
    return c


def list_pages(spark: SparkSession, root: str) -> DataFrame:
    """url, method, status, html, rendered_html: the pages of every run's list, PER_PAGE candidates each.

    Some answer with an error, those of html_js sources hold nothing until they are rendered, and their pagers
    are written in several ways, with a document and a link to another host before the next page's.
    """
    c = table(spark, root, "candidates").select("run_id", "candidate_id", "pos", "url", "title")
    nth = c.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("pos", "candidate_id", "url", "title"))).alias("l"))
    held = nth.select("run_id", F.posexplode("l").alias("k", "x")).select("run_id", F.floor(F.col("k") / PER_PAGE).cast("int").alias("page"), "k", "x.url", "x.title")
    r = runs(spark, root).join(F.broadcast(layouts(spark)), "layout")
    link = F.concat("before", F.lit('<a href="'), _escape(F.col("l.url")), F.lit('">'), _escape(F.coalesce("title", F.lit(""))), F.lit("</a>"), "after")
    items = held.alias("l").join(r.select("run_id", "before", "after"), "run_id").groupBy("run_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", link.alias("h")))), lambda x: x["h"]), "").alias("items"))
    last = items.groupBy("run_id").agg(F.max("page").alias("last"))
    rows = items.join(last, "run_id").join(r, "run_id")
    onward = F.concat("url", F.lit("?pagina="), (F.col("page") + 2).cast("string"))
    pager = F.when(F.col("page") < F.col("last"), F.concat(
        F.lit("<a href='/guida.pdf'>Avanti: la guida</a><a href=\"https://altrove.example/\">Next</a>"),
        F.when(F.col("run_id") % 3 == 0, F.concat(F.lit('<link rel="next" href="'), onward, F.lit('">'))).when(F.col("run_id") % 3 == 1, F.concat(F.lit("<a href='"), onward, F.lit("'>Pagina successiva &raquo;</a>"))).otherwise(F.concat(F.lit("<a aria-label=Next href="), onward, F.lit("></a>"))),
    )).otherwise(F.lit(""))
    html = F.concat(F.lit("<html><head><meta content='Drupal 10' name=generator></head><body><nav><a href='/'>Home</a></nav>"), "opens", "items", "closes", pager, F.lit("<footer>fine</footer></body></html>"))
    gone = (F.col("run_id") % 29 == 0) & (F.col("page") == 0) | (F.col("run_id") % 11 == 0) & (F.col("page") == 1)
    shell = F.col("type") == "html_js"
    return rows.select(
        F.when(F.col("page") == 0, F.col("url")).otherwise(F.concat("url", F.lit("?pagina="), (F.col("page") + 1).cast("string"))).alias("url"), F.lit("GET").alias("method"),
        F.when(gone, 404).otherwise(200).alias("status"), F.when(shell, F.lit("<html><body><div id=app></div></body></html>")).otherwise(html).alias("html"), F.when(shell & ~gone, html).alias("rendered_html"),
    )


def robots(spark: SparkSession, root: str) -> DataFrame:
    return runs(spark, root).select("host").distinct().select(F.upper("host").alias("domain"), (F.length("host") % 9 != 0).alias("allowed"))


def answers(spark: SparkSession, root: str) -> DataFrame:
    """What a model answered about lists: the right selector, none, an unsafe one, or no answer on record."""
    r = runs(spark, root).join(F.broadcast(layouts(spark)), "layout")
    said = F.when(F.col("run_id") % 4 == 0, F.to_json(F.struct(F.concat(F.lit(" "), "selector", F.lit(" ")).alias("list_selector"), F.lit("una lista").alias("reasoning")))).when(F.col("run_id") % 4 == 1, F.lit('{"list_selector": null, "reasoning": "nessuna lista"}')).when(F.col("run_id") % 4 == 2, F.lit('{"list_selector": "a[href^=javascript:]"}'))
    return r.select("list_id", said.alias("answer")).where("answer IS NOT NULL")
