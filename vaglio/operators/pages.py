"""Fingerprints of pages, next-page links and walks along them, and the ladder of selectors."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vaglio.functions.html import classes, platform, select, stable_class
from vaglio.functions.urls import canonical_url, netloc, path
from vaglio.session import durable

SHAPE_CLASSES = 8
#: What links to a next page say, and suffixes of documents.
NEXT = ("avanti", "successiva", "successivo", "prossima", "pagina successiva", "next", "»", "›", "→")
DOCUMENTS = r"\.(pdf|doc|docx|xls|xlsx|zip|rtf|odt)$"
MAX_PAGES = 20
LADDER_ATTEMPTS = 10


def fingerprints(pages: DataFrame) -> DataFrame:
    """page_id, platform, fingerprint. pages: page_id, html. The shape is the eight commonest stable class names.

    All counting is within a row: one projection, no shuffle. A null page is of no known platform and has no classes.
    """
    named = pages.select("page_id", platform(F.col("html")).alias("platform"), F.filter(F.coalesce(classes(F.col("html")), F.array().cast("array<string>")), stable_class).alias("c"))
    # (-count, name) in order: the commonest first, names of one count by the alphabet
    counted = F.transform(F.array_distinct("c"), lambda x: F.struct((-F.size(F.filter("c", lambda y: y == x))).alias("n"), x.alias("c")))
    top = F.slice(F.array_sort(counted), 1, SHAPE_CLASSES)
    digest = F.substring(F.sha2(F.array_join(F.transform(top, lambda x: x["c"]), ","), 256), 1, 12)
    return named.select("page_id", "platform", F.concat("platform", F.lit(":"), digest).alias("fingerprint"))


def next_links(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """url, next_url (and keep) of each page: rel=next first, else the first link that says so, of the same host and not itself."""
    kept = [f for f in pages.schema.fields if f.name in keep]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for url, html, *others in batch[["url", "html", *[f.name for f in kept]]].itertuples(index=False):
                tree, nodes = select(html or "", 'a[rel~="next"],link[rel~="next"]')
                found = [(0, k) for k in nodes]
                for k in tree.anchors:
                    a = tree.attributes[k]
                    said = (tree.text(k) or a.get("aria-label") or a.get("title") or "").lower()
                    href = a.get("href") or ""
                    if said and any(m in said for m in NEXT) and href and not href.startswith(("#", "javascript:")):
                        found.append((1, k))
                rows += [(url, i, kind, tree.attributes[k].get("href"), *others) for i, (kind, k) in enumerate(found) if tree.attributes[k].get("href")]
            yield pd.DataFrame(rows, columns=["url", "pos", "kind", "href", *[f.name for f in kept]])

    schema = "url STRING, pos INT, kind INT, href STRING" + "".join(f", {f.name} {f.dataType.simpleString()}" for f in kept)
    links = pages.select("url", "html", *[f.name for f in kept]).mapInPandas(run, schema)
    links = links.withColumn("next_url", canonical_url(F.col("href"), F.col("url")))
    return first_next(links, keep)


def first_next(links: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """url, next_url off url, pos, kind (0 rel, 1 text) and next_url: the first that may be followed."""
    fit = (F.col("next_url") != canonical_url(F.col("url"))) & (netloc(F.col("next_url")) == netloc(F.col("url"))) & ((F.col("kind") == 0) | ~F.lower(path(F.col("next_url"))).rlike(DOCUMENTS))
    return links.where(fit).groupBy("url", *keep).agg(F.min(F.struct("kind", "pos", "next_url")).alias("m")).select("url", *keep, "m.next_url")


def walk(starts: DataFrame, links: DataFrame, most: int = MAX_PAGES) -> DataFrame:
    """start, page_no, url: pages reached along next links, the start first, none twice, at most most.

    links: url, next_url, at most one row a url. A next page that is no url of links ends the walk before it.
    """
    at = durable(starts.select(F.col("url").alias("start"), "url", F.array("url").alias("seen"), F.lit(1).alias("page_no")).join(links.select("url"), "url", "left_semi"))
    known = links.select(F.col("url").alias("u")).distinct()
    out = at.select("start", "page_no", "url")
    for number in range(2, most + 1):
        step = at.join(links, "url").join(known, F.col("next_url") == F.col("u"), "left_semi").where(~F.array_contains("seen", F.col("next_url")))
        at = durable(step.select("start", F.col("next_url").alias("url"), F.concat("seen", F.array("next_url")).alias("seen"), F.lit(number).alias("page_no")))
        if at.isEmpty():
            break
        out = out.unionByName(at.select("start", "page_no", "url"))
    return out


def pool_top(strategies: DataFrame, most: int = 50) -> DataFrame:
    """The pool a run reads: the most often worked strategies, on a tie in pool order."""
    return strategies.orderBy(F.desc("times_worked"), "pool_pos").limit(most)


def ranked_strategies(pages: DataFrame, strategies: DataFrame) -> DataFrame:
    """Each page's ten best strategies: same fingerprint first, then the more often worked, then pool order.

    strategies: strategy_id, fingerprint, times_worked, pool_pos; the 50 best make the pool. They are ranked once a
    distinct fingerprint, of which the pool itself has at most 50; all other fingerprints share one ranking, so
    pages find theirs by an equal join. A null fingerprint equals a null one.
    """
    pool = pool_top(strategies)
    kinds = pool.select(F.struct("fingerprint").alias("f")).distinct().unionByName(pool.sparkSession.createDataFrame([(None,)], "f STRUCT<fingerprint: STRING>"))
    order = W.partitionBy("f").orderBy(F.when(F.col("f").isNull(), True).otherwise(~F.col("fingerprint").eqNullSafe(F.col("f.fingerprint"))).cast("int"), F.desc("times_worked"), "pool_pos")
    ranks = kinds.join(F.broadcast(pool), F.lit(True)).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= LADDER_ATTEMPTS)
    # at most 51 kinds of ten rows
    ranks = F.broadcast(ranks.select(F.coalesce(F.to_json("f", {"ignoreNullFields": "false"}), F.lit("*")).alias("kind"), "strategy_id", "rank"))
    known = F.broadcast(pool.select(F.to_json(F.struct("fingerprint"), {"ignoreNullFields": "false"}).alias("kind"), F.lit(True).alias("there")).distinct())
    of = pages.select("page_id", F.to_json(F.struct("fingerprint"), {"ignoreNullFields": "false"}).alias("kind"))
    return of.join(known, "kind", "left").withColumn("kind", F.when(F.col("there"), F.col("kind")).otherwise("*")).join(ranks, "kind").select("page_id", "strategy_id", "rank")


def ladder(attempts: DataFrame) -> DataFrame:
    """page_id, winner (strategy_id), rank, blamed: the first accepted attempt, and those rejected before it in rung 2.

    attempts: page_id, rung (1 cached, 2 pool, 3 inferred), rank, strategy_id, accepted. Pages that no
    attempt was accepted for have a null winner and every attempt of the pool blamed.
    """
    place = F.col("rung") * 1000 + F.col("rank")
    win = attempts.groupBy("page_id").agg(F.min(F.when(F.col("accepted"), F.struct(place.alias("place"), "strategy_id", "rung"))).alias("w"))
    before = attempts.join(win, "page_id").where((F.col("rung") == 2) & ~F.col("accepted") & (F.col("w").isNull() | (place < F.col("w.place"))))
    blamed = before.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "strategy_id"))), lambda x: x["strategy_id"]), ",").alias("blamed"))
    return win.join(blamed, "page_id", "left").select("page_id", F.col("w.strategy_id").alias("winner"), F.col("w.rung").alias("rung"), F.coalesce("blamed", F.lit("")).alias("blamed"))


def safe_selector(c: Column) -> Column:
    """Whether a proposed selector may be kept: not blank, at most 200 characters, harmless ones only."""
    text = F.trim(c)
    bad = F.lit(False)
    for token in ("javascript:", "expression(", "<", ">alert", "url("):
        bad = bad | F.contains(F.lower(text), F.lit(token))
    return F.coalesce(text.rlike(r"^[A-Za-z0-9\s.,#\[\]='\"_:()>+~*-]{1,200}$") & ~bad & (text != ""), F.lit(False))
