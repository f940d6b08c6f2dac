"""Filling fixed-capacity containers with items.

Method: minimum bin slack. The largest remaining item opens a container; a subset-sum dynamic program over
the remaining lengths, held as bitsets, finds the combination that fills the rest fullest, and that is
removed. Items of one length are alike, so the program runs on the histogram of lengths (at most capacity
entries, whatever the number of items) and each combination is taken as often as the histogram holds it.
Items then find their containers by length and rank; ranks are counted in hash buckets, so that a length
that a third of all items share is no hot task.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vaglio.session import durable, small_side

CAPACITY = 2048
#: Where the vocabulary is: this setting of the session, else this file.
VOCABULARY_SETTING, VOCABULARY = "spark.vaglio.vocabulary", "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Hash buckets in which the items of one length are ranked.
BUCKETS = 64
#: Fixed value: the pre-tokenisation pattern that this vocabulary was made with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def token_counts(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, tokens of each document with text. The vocabulary is read on the driver and sent to executors (below 1 MB)."""
    spark = documents.sparkSession
    with open(vocabulary or spark.conf.get(VOCABULARY_SETTING, VOCABULARY), "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, sent.value.splitlines())}
        encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("int64"), "tokens": [len(encoding.encode_ordinary(t)) for t in batch["text"]]})

    rows = documents.select("doc_id", "text").where("doc_id IS NOT NULL AND length(text) > 0")
    return rows.mapInPandas(count, "doc_id BIGINT, tokens INT").where("tokens > 0")


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Of the multiset of lengths, a combination of greatest sum up to room; larger lengths are tried first."""
    reach = 1
    mask = (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []  # sums reachable before the step, length, copies
    for length in sorted(counts, reverse=True):
        left = min(counts[length], room // length) if length else 0
        copies = 1
        while left > 0:
            take = min(copies, left)
            steps.append((reach, length, take))
            reach |= (reach << (length * take)) & mask
            left -= take
            copies *= 2
        if reach >> room:
            break
    total = reach.bit_length() - 1
    out: dict[int, int] = {}
    for before, length, take in reversed(steps):
        if not (before >> total) & 1:
            out[length] = out.get(length, 0) + take
            total -= length * take
    return out


def combinations(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """How often, and which lengths with how many copies: a packing of the whole histogram."""
    left = {k: v for k, v in histogram.items() if v > 0}
    out = []
    while left:
        first = max(left)
        rest = dict(left)
        rest[first] -= 1
        if not rest[first]:
            del rest[first]
        chosen = fullest(rest, capacity - first) if first < capacity else {}
        chosen[first] = chosen.get(first, 0) + 1
        times = min(left[k] // n for k, n in chosen.items())
        out.append((times, chosen))
        for k, n in chosen.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return out


def items_of(counted: DataFrame, capacity: int) -> DataFrame:
    """doc_id, part, tokens: a text beyond the capacity in full parts and a rest, others whole."""
    whole = F.ceil(F.col("tokens") / F.lit(capacity)).cast("int")
    return counted.select("doc_id", "tokens", F.explode(F.sequence(F.lit(0), whole - 1)).alias("part")).select(
        "doc_id", "part", F.least(F.lit(capacity), F.col("tokens") - F.col("part") * capacity).cast("int").alias("tokens")
    )


def pack(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """container_id, doc_id, part, tokens: every item in one container, none over capacity.

    Null and empty texts need no room and are left out; a doc_id on several rows is an item on each. Only
    a text of more than capacity tokens is split. Equal lengths are dealt by hash of the id, then the id.
    """
    spark: SparkSession = documents.sparkSession
    items = durable(items_of(token_counts(documents, vocabulary), capacity))
    bucket = F.pmod(F.xxhash64("doc_id", "part"), F.lit(BUCKETS)).cast("int")
    by_bucket = durable(items.groupBy("tokens", bucket.alias("bucket")).agg(F.count("*").alias("n")))
    histogram = {r.tokens: r.n for r in by_bucket.groupBy("tokens").agg(F.sum("n").alias("n")).collect()}
    rows, base, taken = [], 0, dict.fromkeys(histogram, 0)
    for times, chosen in combinations(histogram, capacity):
        for length, copies in chosen.items():
            rows.append((length, taken[length], taken[length] + times * copies, base, copies))
            taken[length] += times * copies
        base += times
    # one row for each length of each combination: a combination uses up a length, so they are a few times capacity
    plan = spark.createDataFrame(rows, "tokens INT, first BIGINT, last BIGINT, base BIGINT, copies INT") if rows else spark.createDataFrame([], "tokens INT, first BIGINT, last BIGINT, base BIGINT, copies INT")
    before = by_bucket.withColumn("before", F.sum("n").over(W.partitionBy("tokens").orderBy("bucket")) - F.col("n")).select("tokens", "bucket", "before")
    ranked = items.withColumn("bucket", bucket).withColumn("k", F.row_number().over(W.partitionBy("tokens", "bucket").orderBy("doc_id", "part")) - 1)
    sides = [small_side(before)[0], small_side(plan)[0]]
    placed = ranked.join(sides[0], ["tokens", "bucket"]).withColumn("rank", F.col("before") + F.col("k"))
    return (
        placed.join(sides[1], (placed["tokens"] == plan["tokens"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
        .select((F.col("base") + F.floor((F.col("rank") - F.col("first")) / F.col("copies"))).cast("bigint").alias("container_id"), "doc_id", "part", placed["tokens"])
    )


def fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """containers, items, tokens and the share of the containers' room that is used."""
    return packed.agg(
        F.countDistinct("container_id").alias("containers"), F.count("*").alias("items"), F.sum("tokens").alias("tokens"),
        (F.sum("tokens") / (F.countDistinct("container_id") * F.lit(capacity))).alias("used"),
    )
