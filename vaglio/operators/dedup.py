"""Soft duplicates across sources: like titles with a deadline in the same month.

Indel similarity of sorted words at a threshold bounds the lengths of two titles and the number of edits between
them, and an edit changes the count of one character by one. Titles of a month whose lengths are within the bound are
compared in blocks by their counts of characters first, with one matrix operation a block; only pairs within the
bound are aligned. No pair is lost. A month of the pool is dealt out by length, and by rows where a length has many.
Equal titles are compared once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaglio.functions.distance import indel_ratio
from vaglio.functions.values import iso_date, normalise_title, sorted_words

THRESHOLD = 90
#: Lengths of titles that are compared together, and titles of a pool and cells of a block, at most.
BAND, SHARD, CELLS = 4, 20_000, 1_000_000
#: Kinds of characters that are counted apart; others share a kind, which can only raise the number of pairs that are aligned.
KINDS = 64
PAIRS = "month DATE, a STRING, b STRING, score DOUBLE"


def counted(texts: list[str]) -> np.ndarray:
    """How often each text holds each kind of character, the text a row."""
    sizes = [len(t) for t in texts]
    kind = np.int16 if max(sizes, default=0) < 2**15 else np.int32
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(texts)), sizes)
    return np.bincount(row * KINDS + codes % KINDS, minlength=len(texts) * KINDS).reshape(len(texts), KINDS).astype(kind)


def like_pairs(left: list[str], right: list[str], threshold: int) -> Iterator[tuple[str, str, float]]:
    """a, b, score of all texts a (left) and b (right) with a ratio of threshold or more."""
    if not left or not right:
        return
    right = sorted(right, key=len)
    sizes, held = np.array([len(b) for b in right]), counted(right)
    most = 200 / threshold - 1
    groups: dict[int, list[str]] = {}
    for a in left:
        groups.setdefault(len(a), []).append(a)
    for n, group in groups.items():
        low, high = np.searchsorted(sizes, [math.ceil(n / most - 1e-6), math.floor(n * most + 1e-6) + 1])
        own, step = counted(group), max(1, CELLS // max(1, len(group)))
        used = [k for k in range(KINDS) if own[:, k].any()]
        for at in range(low, high, step):
            block = slice(at, min(at + step, high))
            other = held[block]
            # characters that both hold: no common subsequence is longer
            shared = np.zeros((len(group), len(other)), np.result_type(own, other))
            for k in used:
                if other[:, k].any():
                    shared += np.minimum.outer(own[:, k], other[:, k])
            total = n + sizes[block]
            allowed = ((100 - threshold) / 100.0 * total + 1e-6).astype(np.int64)
            for i, j in zip(*np.nonzero(total[None, :] - 2 * shared <= allowed[None, :])):
                score = indel_ratio(a := group[i], b := right[at + j])
                if score >= threshold:
                    yield a, b, score


def like_titles(left: DataFrame, right: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """month, a, b, score of all texts a (left) and b (right) of one month with a ratio of threshold or more.

    left, right: month, text; distinct, non-empty.
    """
    most = 200 / threshold - 1
    band = lambda length: F.floor(length / BAND).cast("int")
    pool = right.withColumn("band", band(F.length("text")))
    # as many parts of a band as its titles need; the queries go to each part
    parts = pool.groupBy("month", "band").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("parts"))
    dealt = pool.join(parts, ["month", "band"]).withColumn("part", F.pmod(F.xxhash64("text"), F.col("parts")).cast("int"))
    # a name of its own for each column: both sides may come of one table
    asked = left.select(F.col("month").alias("month"), F.col("text").alias("text")).withColumn("band", F.explode(F.sequence(band(F.ceil(F.length("text") / most - 1e-6)), band(F.floor(F.length("text") * most + 1e-6)))))
    asked = asked.join(parts, ["month", "band"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def run(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        rows = [(key[0], *pair) for pair in like_pairs(list(a["text"]), list(b["text"]), threshold)]
        return pd.DataFrame(rows, columns=["month", "a", "b", "score"])

    keys = ["month", "band", "part"]
    return asked.select(*keys, "text").groupBy(*keys).cogroup(dealt.select(*keys, "text").groupBy(*keys)).applyInPandas(run, PAIRS)


def soft_duplicates(queries: DataFrame, pool: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """grant_id, duplicate_of, score: each query's best match of another source in the pool.

    queries, pool: grant_id, source_id, title, deadline, and pool_pos in the pool: of equal scores the
    smallest pool_pos wins. A row never matches itself; a null deadline or an empty title never matches; a
    pool row without source matches any.
    """
    def read(rows: DataFrame) -> DataFrame:
        return rows.withColumn("text", sorted_words(normalise_title(F.col("title")))).withColumn("month", F.date_trunc("month", iso_date(F.col("deadline").cast("string"))).cast("date")).where("text <> '' AND month IS NOT NULL")

    q, p = read(queries), read(pool)
    texts = like_titles(q.select("month", "text").distinct(), p.select("month", "text").distinct(), threshold)
    left = q.select("grant_id", F.col("source_id").alias("qs"), "month", F.col("text").alias("a"))
    right = p.select(F.col("grant_id").alias("other"), F.coalesce(F.nullif("source_id", F.lit("")), F.concat(F.lit("#"), F.col("grant_id").cast("string"))).alias("ps"), "month", F.col("text").alias("b"), "pool_pos")
    # per text of the pool the first row of each source, which is all a query can need; a row without source stands for itself
    first = right.groupBy("month", "b", "ps").agg(F.min(F.struct("pool_pos", "other")).alias("m"), F.count("*").alias("n"))
    met = left.join(texts, ["month", "a"]).join(first, ["month", "b"]).where(F.col("qs").isNull() | (F.col("ps") != F.col("qs")))
    met = met.where(F.col("m.other") != F.col("grant_id"))
    best = met.groupBy("grant_id").agg(F.max(F.struct("score", -F.col("m.pool_pos"), F.col("m.other").alias("other"))).alias("best"))
    return best.select("grant_id", F.col("best.other").alias("duplicate_of"), F.round("best.score", 6).alias("score"))
