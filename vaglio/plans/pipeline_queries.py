"""Queries of the general operators for training data: incremental processing and units."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaglio.operators import incremental, units
from vaglio.session import table


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    pending = incremental.pending_pages(table(spark, root, "candidates"), table(spark, root, "sources"), table(spark, root, "page_snapshots"))
    return pending.select("candidate_id")


def p3_reread_marks(spark: SparkSession, root: str) -> DataFrame:
    return incremental.low_water_mark(table(spark, root, "scan_runs"))


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    return units.bounds_in_euro(table(spark, root, "grants"), table(spark, root, "currency_rates"))


def p6_unit_aliases(spark: SparkSession, root: str) -> DataFrame:
    texts = table(spark, root, "grants").where("funding_text IS NOT NULL").select("funding_text").distinct()
    words = units.tokens_of(texts).where(~F.col("token").rlike(r"^[\d%;,:]")).select(F.col("token").alias("spelling")).distinct()
    return units.alias_dictionary(words)


QUERIES = {"p3_found": p3_found, "p3_reread_marks": p3_reread_marks, "p6_found": p6_found, "p6_unit_aliases": p6_unit_aliases}

ORACLES = {
    "p3_reread_marks": """
WITH r AS (SELECT * FROM scan_runs WHERE source_id IS NOT NULL AND started_at IS NOT NULL),
l AS (SELECT source_id, started_at AS last_start, finished_at AS last_end FROM r WHERE status = 'ok' AND finished_at IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY started_at DESC, finished_at DESC) = 1),
o AS (
  SELECT r.*, last_start, last_end, started_at < last_start AND (finished_at > last_start OR (finished_at IS NULL AND status IS DISTINCT FROM 'error')) AS is_open,
    started_at >= last_start AND (status IS DISTINCT FROM 'ok' OR finished_at IS NULL) AS failed_since FROM r LEFT JOIN l USING (source_id))
SELECT source_id, any_value(last_end) AS last_end, coalesce(min(started_at) FILTER (is_open), any_value(last_start)) AS reread_from, count(*) FILTER (is_open OR failed_since) AS open_runs
FROM o GROUP BY source_id""",
}
