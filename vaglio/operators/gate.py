"""Link candidates of a list page, and the gate that tells a list of notices from navigation."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vaglio.functions.html import links
from vaglio.functions.text import strip
from vaglio.functions.urls import canonical_url, netloc, path, query

#: Link texts that are no notices.
CHROME = ("home", "contatti", "privacy", "cookie", "cookie policy", "accedi", "login", "registrati", "cerca", "menu", "torna su", "leggi tutto", "continua", "vai al contenuto", "mappa del sito", "note legali", "amministrazione trasparente", "seguici", "newsletter", "faq", "aiuto", "english", "italiano")
MOST, FEWEST = 200, 2
COHESION_FROM, COHESION_LEAST = 4, 3


def segments(url: Column) -> Column:
    return F.filter(F.split(path(url), "/"), lambda x: x != "")


def path_prefix(url: Column) -> Column:
    """The first two segments of the path."""
    return F.array_join(F.slice(segments(url), 1, 2), "/")


def detail_url(url: Column, domain: Column) -> Column:
    """Whether a URL looks like a detail page: of this domain or none, with two segments, or one and a query."""
    parts = segments(url)
    return ((netloc(url) == "") | (netloc(url) == domain)) & (F.size(parts) > 0) & ((F.size(parts) >= 2) | (query(url) != ""))


def list_links(pages: DataFrame) -> DataFrame:
    """list_id, pos, url, title, status of the links that each page's selector matches.

    pages: list_id, base_url, html, selector. status is 'ok', or 'invalid_selector' on one row without url.
    A null page or selector gives nothing. Nested matches repeat their anchors; the gate drops repeats.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for list_id, base, html, selector in batch[["list_id", "base_url", "html", "selector"]].itertuples(index=False):
                if html is None or selector is None:
                    continue
                try:
                    rows += [(list_id, base, k, href, title, "ok") for k, (href, title) in enumerate(links(html, selector))]
                except ValueError:
                    rows.append((list_id, base, None, None, None, "invalid_selector"))
            yield pd.DataFrame(rows, columns=["list_id", "base_url", "pos", "href", "title", "status"]).astype({"pos": "Int64"})

    raw = pages.select("list_id", "base_url", "html", "selector").mapInPandas(run, "list_id STRING, base_url STRING, pos INT, href STRING, title STRING, status STRING")
    return raw.select("list_id", "pos", canonical_url(F.col("href"), F.col("base_url")).alias("url"), "title", "status")


def judged(candidates: DataFrame, title: str = "title") -> DataFrame:
    """Each candidate with its reason: chrome, url_shape, duplicate, incohesive or kept.

    candidates: list_id, pos, url, title, domain. The checks run in that order; duplicates keep the first by
    pos; of four kept or more, if the leading path prefix (on a tie the first seen) has three and twice the
    runner-up, the others are incohesive.
    """
    reason = F.when(F.lower(strip(F.col(title))).isin(*CHROME), F.lit("chrome")).when(~detail_url(F.col("url"), F.col("domain")) | F.col("url").isNull(), F.lit("url_shape"))
    rows = candidates.withColumn("reason", reason).withColumn("prefix", path_prefix(F.col("url")))
    # a null reason so far: the first of each URL stays
    nth = F.row_number().over(W.partitionBy("list_id", "url", F.col("reason").isNull()).orderBy("pos"))
    rows = rows.withColumn("nth", nth).withColumn("reason", F.when(F.col("reason").isNull() & (F.col("nth") > 1), F.lit("duplicate")).otherwise(F.col("reason"))).drop("nth")
    counts = rows.where("reason IS NULL").groupBy("list_id", "prefix").agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    order = W.partitionBy("list_id").orderBy(F.desc("n"), "first")
    lead = counts.withColumn("k", F.row_number().over(order)).groupBy("list_id").agg(
        F.sum("n").alias("kept"), F.max(F.when(F.col("k") == 1, F.col("n"))).alias("top"), F.max(F.when(F.col("k") == 1, F.col("prefix"))).alias("dominant"),
        F.coalesce(F.max(F.when(F.col("k") == 2, F.col("n"))), F.lit(0)).alias("second"),
    )
    prune = (F.col("kept") >= COHESION_FROM) & (F.col("top") >= COHESION_LEAST) & (F.col("top") >= 2 * F.col("second"))
    return rows.join(lead, "list_id", "left").withColumn(
        "reason", F.coalesce(F.col("reason"), F.when(prune & (F.col("prefix") != F.col("dominant")), F.lit("incohesive")), F.lit("kept"))
    ).select(*candidates.columns, "prefix", "reason")


def verdicts(judgement: DataFrame) -> DataFrame:
    """Per list the counts by reason and the verdict; the accepted count is that before the verdict."""
    count = lambda r: F.count_if(F.col("reason") == r)
    return judgement.groupBy("list_id").agg(
        F.count("*").alias("candidates_before_gate"), count("kept").alias("candidates_accepted"), count("chrome").alias("rejected_chrome"),
        count("url_shape").alias("rejected_url_shape"), count("duplicate").alias("rejected_duplicate"), count("incohesive").alias("rejected_incohesive"),
        F.when(count("kept") > MOST, "implausible_count_high").when(count("kept") < FEWEST, "implausible_count_low").otherwise("accepted").alias("gate_verdict"),
    )


def accepted(judgement: DataFrame) -> DataFrame:
    """The kept candidates of lists whose count is plausible. The counts are combined on the map side and joined back."""
    plausible = judgement.where("reason = 'kept'").groupBy("list_id").agg(F.count("*").alias("n")).where(F.col("n").between(FEWEST, MOST)).select("list_id")
    return judgement.where("reason = 'kept'").join(plausible, "list_id", "left_semi").drop("reason", "prefix")
