"""Validation of extracted records and of rules, with quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaglio.functions import values
from vaglio.functions.text import strip

#: Longest texts of a record; a longer one fails, it is not cut.
LONGEST = {"title": 500, "issuer": 300, "description": 4000, "funding_text": 200}
RESPONSE = "grant STRUCT<title: STRING, issuer: STRING, category: STRING, description: STRING, requirements: ARRAY<STRING>, funding_text: STRING, funding_min: STRING, funding_max: STRING, deadline: STRING>, relevance ARRAY<STRUCT<topic_id: STRING, score: DOUBLE>>"
#: What no selector may hold, and longest texts of a rule.
FORBIDDEN = ("javascript:", "<script", "expression(", "url(")
RULE_LONGEST = {"item_selector": 200, "link_selector": 200, "title_selector": 200, "results_path": 100, "item_url_path": 100, "item_title_path": 100, "next_page_selector": 200, "page_param": 60, "note": 500}
RULE = "STRUCT<item_selector: STRING, link_selector: STRING, title_selector: STRING, results_path: STRING, item_url_path: STRING, item_title_path: STRING, next_page_selector: STRING, page_param: STRING, max_pages: INT, render: BOOLEAN, request: STRUCT<method: STRING, url: STRING>, note: STRING>"


def _said(tests: list[tuple[Column, str]]) -> Column:
    """The messages of the tests that hold, in order."""
    every = F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(m)) for c, m in tests])
    return F.filter(every, lambda x: x.isNotNull())


#: Fixed value: errors that a quarantined record's message names.
ERRORS_NAMED = 3


def checked_response(text: Column) -> Column:
    """status, errors (each field that fails and why, in order) and the record of a model's response.

    status: invalid_json, not_a_grant (grant null or missing), invalid (a missing or overlong text, a date
    that does not exist, a score outside [0, 1]) or valid. A null response is invalid_json.
    """
    parsed = F.from_json(text, RESPONSE)
    g = parsed["grant"]
    due = values.deadline(g["deadline"])
    scores = F.coalesce(F.exists(parsed["relevance"], lambda r: r["score"].isNull() | (r["score"] < 0) | (r["score"] > 1)), F.lit(False))
    unnamed = F.coalesce(F.exists(parsed["relevance"], lambda r: r["topic_id"].isNull()), F.lit(False))
    tests = [(F.length(F.coalesce(g["title"], F.lit(""))) == 0, "title: missing")]
    tests += [(F.length(g[name]) > most, f"{name}: longer than {most}") for name, most in LONGEST.items()]
    tests += [(due["failed"], "deadline: no such day"), (unnamed, "relevance: no topic"), (scores, "relevance: score not in 0 to 1")]
    object_ = F.coalesce(strip(text).startswith("{") & F.try_parse_json(text).isNotNull(), F.lit(False)) & parsed.isNotNull()
    errors = F.when(~object_, F.array(F.lit("no JSON object"))).when(g.isNull(), F.array().cast("array<string>")).otherwise(_said(tests))
    status = F.when(~object_, "invalid_json").when(g.isNull(), "not_a_grant").when(F.size(errors) > 0, "invalid").otherwise("valid")
    record = F.struct(
        g["title"].alias("title"), g["issuer"].alias("issuer"), values.category(g["category"]).alias("category"), g["description"].alias("description"),
        values.requirements(g["requirements"]).alias("requirements"), g["funding_text"].alias("funding_text"), values.amount(g["funding_min"]).alias("funding_min"),
        values.amount(g["funding_max"]).alias("funding_max"), due["value"].alias("deadline"), parsed["relevance"].alias("relevance"),
    )
    return F.struct(status.alias("status"), errors.alias("errors"), F.when(status == "valid", record).alias("record"))


def extracted(responses: DataFrame) -> DataFrame:
    """responses with attempt (1 or 2), outcome (stored, rejected or quarantined), record, retry_errors and message.

    responses: first and second (the retry). The retry counts where the first did not pass, and is asked for with
    the first's errors (retry_errors); what fails twice is quarantined with a message that names its first three
    errors, what is no grant is rejected.
    """
    tried = responses.withColumn("c1", checked_response(F.col("first"))).withColumn("c2", checked_response(F.col("second")))
    ok1 = F.col("c1.status").isin("valid", "not_a_grant")
    last = F.when(ok1, F.col("c1")).otherwise(F.col("c2"))
    return tried.select(
        *responses.columns, F.when(ok1, 1).otherwise(2).alias("attempt"), last["status"].alias("status"),
        F.when(last["status"] == "valid", "stored").when(last["status"] == "not_a_grant", "rejected").otherwise("quarantined").alias("outcome"), last["record"].alias("record"),
        F.when(~ok1, F.array_join("c1.errors", "; ")).alias("retry_errors"), F.when(~last["status"].isin("valid", "not_a_grant"), F.array_join(F.slice(last["errors"], 1, ERRORS_NAMED), "; ")).alias("message"),
    )


def checked_rule(text: Column) -> Column:
    """status (valid, invalid), usable, api_style, method, max_pages and reasons of a rule's JSON. Unknown fields are ignored."""
    r = F.from_json(text, RULE)
    object_ = F.coalesce(strip(text).startswith("{") & F.try_parse_json(text).isNotNull(), F.lit(False)) & r.isNotNull()
    method = F.upper(F.coalesce(r["request"]["method"], F.lit("GET")))
    pages = F.coalesce(r["max_pages"], F.lit(5))
    tests = [(F.length(r[name]) > most, f"{name}: longer than {most}") for name, most in RULE_LONGEST.items()]
    for name in ("item_selector", "link_selector", "title_selector", "next_page_selector"):
        held = F.lit(False)
        for token in FORBIDDEN:
            held = held | F.contains(F.lower(r[name]), F.lit(token))
        tests.append((held, f"{name}: forbidden token"))
    tests += [(~pages.between(1, 20), "max_pages: not in 1 to 20"), (~method.isin("GET", "POST"), "method: only GET and POST")]
    reasons = F.when(~object_, F.array(F.lit("no JSON object"))).otherwise(_said(tests))
    ok = F.size(reasons) == 0
    given = lambda c: F.coalesce(c, F.lit("")) != ""
    return F.struct(
        F.when(ok, "valid").otherwise("invalid").alias("status"), (ok & (given(strip(r["item_selector"])) | given(r["results_path"]))).alias("usable"),
        (ok & (given(r["results_path"]) | given(r["item_url_path"]))).alias("api_style"), F.when(ok, method).alias("method"), F.when(ok, pages).alias("max_pages"), reasons.alias("reasons"),
    )
