"""Queries of the llm operators. Where SQL can say the same, ORACLES has it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vaglio.llm import boilerplate, consensus, leakage, linkage, names, packing, toxicity
from vaglio.session import table


def _survivors(spark: SparkSession, root: str) -> DataFrame:
    return consensus.survivors(table(spark, root, "grants"), table(spark, root, "sources"))


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return _survivors(spark, root).select("group_id", "field", "grant_id")


def p1_groups(spark: SparkSession, root: str) -> DataFrame:
    return consensus.groups(table(spark, root, "grants"))


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    return boilerplate.furniture_lines(table(spark, root, "cleaned_pages"))


def p2_main_text(spark: SparkSession, root: str) -> DataFrame:
    return boilerplate.main_text(table(spark, root, "cleaned_pages"))


def _linked(spark: SparkSession, root: str) -> DataFrame:
    return linkage.link(table(spark, root, "grants"), table(spark, root, "register_calls"), table(spark, root, "currency_rates"))


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return linkage.pairs_found(_linked(spark, root))


def p4_confidences(spark: SparkSession, root: str) -> DataFrame:
    return _linked(spark, root)


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    return names.same_entity_pairs(table(spark, root, "issuer_spellings"))


def p5_entities(spark: SparkSession, root: str) -> DataFrame:
    return names.entities(table(spark, root, "issuer_spellings"))


def p7_containers(spark: SparkSession, root: str) -> DataFrame:
    return packing.pack(table(spark, root, "documents"))


def p7_fill(spark: SparkSession, root: str) -> DataFrame:
    return packing.fill(packing.pack(table(spark, root, "documents")))


def p8_found(spark: SparkSession, root: str) -> DataFrame:
    return leakage.exact(leakage.leaks(table(spark, root, "documents"), table(spark, root, "eval_items")))


def p8_leak_lengths(spark: SparkSession, root: str) -> DataFrame:
    return leakage.leaks(table(spark, root, "documents"), table(spark, root, "eval_items"))


def _scored(spark: SparkSession, root: str) -> DataFrame:
    documents = table(spark, root, "documents")
    return toxicity.score_documents(documents, toxicity.fit(documents, table(spark, root, "moderation_labels")))


def p9_found(spark: SparkSession, root: str) -> DataFrame:
    return toxicity.categories(_scored(spark, root))


def p9_scores(spark: SparkSession, root: str) -> DataFrame:
    return _scored(spark, root)


def p9_source_rates(spark: SparkSession, root: str) -> DataFrame:
    return toxicity.source_rates(_scored(spark, root))


QUERIES = {
    "p1_found": p1_found,
    "p1_groups": p1_groups,
    "p2_found": p2_found,
    "p2_main_text": p2_main_text,
    "p4_found": p4_found,
    "p4_confidences": p4_confidences,
    "p5_found": p5_found,
    "p5_entities": p5_entities,
    "p7_containers": p7_containers,
    "p7_fill": p7_fill,
    "p8_found": p8_found,
    "p8_leak_lengths": p8_leak_lengths,
    "p9_found": p9_found,
    "p9_scores": p9_scores,
    "p9_source_rates": p9_source_rates,
}

ORACLES: dict[str, str] = {
    "p1_groups": """
WITH RECURSIVE e AS (
  SELECT a.grant_id AS x, a.duplicate_of AS y FROM grants a JOIN grants b ON b.grant_id = a.duplicate_of WHERE a.grant_id <> a.duplicate_of),
s AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
r(n, c) AS (SELECT x, x FROM s UNION SELECT s.x, r.c FROM r JOIN s ON s.y = r.n WHERE r.c < s.x)
SELECT n AS grant_id, min(c) AS group_id FROM r GROUP BY n""",
}
