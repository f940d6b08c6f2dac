"""Keyed upserts. Parquet has no MERGE: the old and new rows are joined in full and written anew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row a key, the last by order (columns, compared in turn; nulls first). Combined on the map side."""
    rest = [c for c in rows.columns if c not in keys]
    rank = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order], F.struct(*rest).alias("row"))
    return rows.groupBy(*keys).agg(F.max(rank).alias("m")).select(*keys, *[F.col("m.row")[c].alias(c) for c in rest])


def upsert(old: DataFrame, new: DataFrame, keys: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """old with new merged in by keys: new values win unless null; columns of keep hold their first value.

    Adds is_new. Both sides have one row a key; null keys equal each other.
    """
    values = [c for c in old.columns if c not in keys]
    o = old.select(*[F.col(k).alias(f"o_{k}") for k in keys], *[F.col(c).alias(f"o_{c}") for c in values], F.lit(True).alias("o_there"))
    n = new.select(*[F.col(k).alias(f"n_{k}") for k in keys], *[(F.col(c) if c in new.columns else F.lit(None).cast(dict(old.dtypes)[c])).alias(f"n_{c}") for c in values], F.lit(True).alias("n_there"))
    on = None
    for k in keys:
        c = F.col(f"o_{k}").eqNullSafe(F.col(f"n_{k}"))
        on = c if on is None else on & c
    pick = lambda c: F.coalesce(f"o_{c}", f"n_{c}") if c in keep else F.coalesce(f"n_{c}", f"o_{c}")
    return o.join(n, on, "full").select(*[F.coalesce(f"o_{k}", f"n_{k}").alias(k) for k in keys], *[pick(c).alias(c) for c in values], F.col("o_there").isNull().alias("is_new"))


def track_record(pool: DataFrame, worked: DataFrame, failed: DataFrame) -> DataFrame:
    """The pool of strategies with credits and blames added.

    pool: strategy_id, times_worked, times_failed and any others; worked and failed: strategy_id, a row an event.
    Events of unknown strategies, and of null, do nothing; null counts are 0.
    """
    up = worked.groupBy("strategy_id").agg(F.count("*").alias("_w"))
    down = failed.groupBy("strategy_id").agg(F.count("*").alias("_f"))
    known = pool.join(up, "strategy_id", "left").join(down, "strategy_id", "left")
    added = {"times_worked": "_w", "times_failed": "_f"}
    return known.select(*[(F.coalesce(c, F.lit(0)) + F.coalesce(added[c], F.lit(0))).alias(c) if c in added else F.col(c) for c in pool.columns])


def remember(pool: DataFrame, accepted: DataFrame) -> DataFrame:
    """The pool with selectors that the gate accepted: known (selector, fingerprint) pairs are credited, others added with their count.

    pool: strategy_id, list_selector, fingerprint, times_worked, times_failed; accepted: list_selector, fingerprint, a row
    an event. Null fingerprints equal each other; rows without selector are left out. A pair that the pool holds
    twice is credited on its smallest strategy_id. New ids are made from the pair.
    """
    key = [F.col("list_selector"), F.col("fingerprint")]
    events = accepted.where("list_selector IS NOT NULL").groupBy(*key).agg(F.count("*").alias("_n"))
    first = pool.groupBy(*key).agg(F.min("strategy_id").alias("_id"))
    same = F.col("e.list_selector").eqNullSafe(F.col("p.list_selector")) & F.col("e.fingerprint").eqNullSafe(F.col("p.fingerprint"))
    met = events.alias("e").join(first.alias("p"), same, "left").select("e.list_selector", "e.fingerprint", "_n", "_id")
    credited = pool.join(met.where("_id IS NOT NULL").select(F.col("_id").alias("strategy_id"), "_n"), "strategy_id", "left")
    kept = credited.select("strategy_id", "list_selector", "fingerprint", (F.coalesce("times_worked", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("times_worked"), F.coalesce("times_failed", F.lit(0)).alias("times_failed"))
    made = F.substring(F.sha2(F.concat_ws("|", "list_selector", F.coalesce("fingerprint", F.lit("-"))), 256), 1, 16)
    new = met.where("_id IS NULL").select(made.alias("strategy_id"), "list_selector", "fingerprint", F.col("_n").alias("times_worked"), F.lit(0).alias("times_failed"))
    return kept.unionByName(new)
