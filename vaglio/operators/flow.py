"""The pipeline from discovered candidates to stored records, and what a run leaves behind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaglio.functions import html as H
from vaglio.functions import values as V
from vaglio.functions.text import content_hash, strip
from vaglio.functions.urls import url_hash
from vaglio.operators import dedup, extraction, history, merge
from vaglio.operators.scan import fetched
from vaglio.session import durable

RECORD = ("title", "issuer", "category", "description", "requirements", "funding_text", "funding_min", "funding_max", "deadline")


def page_texts(candidates: DataFrame, pages: DataFrame, robots: DataFrame | None = None) -> DataFrame:
    """candidates with text, original_bytes, truncated and counted: their payload as lines, or their page cleaned.

    candidates: source_id, pos, url, title, payload. A candidate with a payload asks for no page. A page that was
    not brought has a null text.
    """
    got = fetched(candidates, pages, robots)
    own = F.col("payload").isNotNull()
    cleaned = H.clean_html(F.when(~own, F.col("html")))
    read = got.withColumn("_c", cleaned)
    return read.select(
        *candidates.columns, F.when(own, V.payload_text(F.col("title"), F.col("payload"), F.col("url"))).otherwise(F.col("_c.text")).alias("text"),
        F.when(own, F.octet_length("payload")).otherwise(F.col("_c.original_bytes")).alias("original_bytes"), F.when(own, F.lit(False)).otherwise(F.col("_c.truncated")).alias("truncated"),
        (F.col("counted") & ~own).alias("counted"),
    )


def with_state(read: DataFrame, snapshots: DataFrame, dry_run: bool = False) -> DataFrame:
    """read with url_hash, content_hash and state: unfetched, unchanged, blank or due.

    snapshots: source_id, url_hash, content_hash, last_seen_at; the newest of a page holds. An unchanged page is left
    before anything costly; a dry run looks at every page. A page that is blank after cleaning is not due, and leaves no snapshot.
    """
    old = merge.latest(snapshots.select("source_id", "url_hash", "content_hash", "last_seen_at"), ["source_id", "url_hash"], ["last_seen_at", F.coalesce("content_hash", F.lit(""))]).select(F.col("source_id").alias("_s"), F.col("url_hash").alias("_u"), F.col("content_hash").alias("_old"))
    keyed = read.withColumn("url_hash", url_hash(F.col("url"))).withColumn("content_hash", content_hash(F.col("text")))
    met = keyed.join(old, (F.col("source_id") == F.col("_s")) & (F.col("url_hash") == F.col("_u")), "left")
    same = F.lit(False) if dry_run else F.coalesce(F.col("_old") == F.col("content_hash"), F.lit(False))
    state = F.when(F.col("text").isNull(), "unfetched").when(same, "unchanged").when(strip(F.col("text")) == "", "blank").otherwise("due")
    return met.withColumn("state", state).drop("_s", "_u", "_old")


def processed(read: DataFrame, snapshots: DataFrame, answers: DataFrame, pool: DataFrame, cap: int, budget: int | None, dry_run: bool = False) -> DataFrame:
    """Every candidate with what became of it.

    read: as page_texts(); answers: url_hash, first, second (recorded); pool: grant_id, source_id, title, deadline,
    pool_pos, the records that duplicates are looked for among. A due page costs one call, or two if the first answer
    fails; the run's cap and the source's budget are used in order of source and pos, and a source stops at the
    first call that has no room. outcome: unfetched, unchanged, blank, over_budget, failed (no first answer on record, or both answers fail),
    rejected (no grant; its snapshot is kept), or stored, with record, duplicate_of, duplicate_score, calls and a line for the log.
    """
    state = with_state(read, snapshots, dry_run)
    one = answers.groupBy("url_hash").agg(F.min(F.struct("first", "second")).alias("_a"))
    asked = state.join(one, "url_hash", "left").withColumn("first", F.col("_a.first")).withColumn("second", F.col("_a.second")).drop("_a")
    tried = durable(extraction.extracted(asked).withColumn("needs", F.when(F.col("state") == "due", F.col("attempt")).otherwise(0)))
    calls = tried.where("needs > 0").select(F.lit(0).alias("run_key"), "source_id", F.posexplode(F.sequence(F.lit(1), "needs")).alias("nth", "_"), "pos", "url_hash").select("run_key", "source_id", F.struct("pos", "url_hash", "nth").alias("seq"))
    room = history.admitted(calls, cap, budget).groupBy("source_id", F.col("seq.pos").alias("pos"), F.col("seq.url_hash").alias("url_hash")).agg(F.bool_and("admitted").alias("_room"), F.count_if("admitted").alias("calls"))
    got = tried.join(room, ["source_id", "pos", "url_hash"], "left")
    outcome = (
        F.when(F.col("state") != "due", F.col("state")).when(~F.col("_room"), "over_budget").when(F.col("outcome") == "quarantined", "failed").otherwise(F.col("outcome"))
    )
    got = got.withColumn("outcome", outcome).withColumn("calls", F.coalesce("calls", F.lit(0)))
    asked_for = F.col("outcome").isin("stored", "rejected", "failed")
    got = durable(got.withColumn("record", F.when(F.col("outcome") == "stored", F.col("record"))).withColumn("retry_errors", F.when(asked_for, F.col("retry_errors"))).withColumn("message", F.when(asked_for, F.col("message"))))
    stored = got.where("outcome = 'stored'")
    wanted = stored.select(F.concat_ws("|", "source_id", "url_hash").alias("grant_id"), "source_id", "record.title", "record.deadline").distinct()
    like = dedup.soft_duplicates(wanted, pool.withColumn("grant_id", F.col("grant_id").cast("string"))).select(F.col("grant_id").alias("_k"), "duplicate_of", F.col("score").alias("duplicate_score"))
    full = got.join(like, F.concat_ws("|", "source_id", "url_hash") == F.col("_k"), "left").drop("_k")
    line = (
        F.when(F.col("outcome") == "unfetched", F.concat(F.lit("could not fetch "), "url")).when(F.col("outcome") == "blank", F.concat(F.lit("no text after cleaning: "), "url"))
        .when(F.col("outcome") == "rejected", F.concat(F.lit("not a grant page: "), "url")).when(F.col("outcome") == "failed", F.concat(F.lit("extraction failed for "), "url", F.lit(": "), F.coalesce("message", F.lit(""))))
        .when(F.col("duplicate_of").isNotNull(), F.concat(F.lit("probable duplicate of "), "duplicate_of", F.lit(": "), "record.title"))
    )
    return full.withColumn("line", F.when(F.col("outcome") != "stored", line).otherwise(F.when(F.col("duplicate_of").isNotNull(), line)))


def grant_rows(done: DataFrame, at: Column) -> DataFrame:
    """The records to store of processed(): one a url_hash, of several sources the last by source_id."""
    rows = done.where("outcome = 'stored'").select(
        "url_hash", "source_id", "url", *[F.col(f"record.{c}").alias(c) for c in RECORD], V.best_relevance(F.col("record.relevance")).alias("relevance_score"),
        V.relevant_topics(F.col("record.relevance")).alias("matched_topics"), "content_hash", "duplicate_of", "duplicate_score", at.alias("found_at"), "pos",
    )
    return merge.latest(rows, ["url_hash"], ["source_id", "pos"]).drop("pos")


def snapshot_rows(done: DataFrame, at: Column) -> DataFrame:
    """The snapshots to keep of processed(): of stored and of rejected pages; failed ones are tried again."""
    rows = done.where("outcome IN ('stored', 'rejected')").select("source_id", "url_hash", "content_hash", at.alias("last_seen_at"), "pos")
    return merge.latest(rows, ["source_id", "url_hash"], ["pos"]).drop("pos")


def store(grants: DataFrame, done: DataFrame, at: Column) -> DataFrame:
    """grants with the records of done merged in by url_hash: first found_at stays, nulls change nothing. Adds is_new."""
    new = grant_rows(done, at)
    return merge.upsert(grants, new.select(*[c for c in new.columns if c in grants.columns]), ["url_hash"], keep=("found_at",))


def source_results(sources: DataFrame, scans: DataFrame, done: DataFrame, known: DataFrame) -> DataFrame:
    """source_id, status, error, new_count, updated_count, pages_fetched, llm_calls, log of each scanned source.

    scans: source_id, error, pages_scanned; known: url_hash of the stored records. The log holds the lines of the
    candidates in order, and of a source that stopped at its budget one line for that; null if there is none.
    """
    there = known.select("url_hash").where("url_hash IS NOT NULL").distinct().withColumn("_known", F.lit(True))
    rows = done.join(there, "url_hash", "left")
    stored = F.col("outcome") == "stored"
    said = F.array_sort(F.collect_list(F.when(F.col("line").isNotNull(), F.struct("pos", "line"))))
    per = rows.groupBy("source_id").agg(
        F.count_if(stored & F.col("_known").isNull()).alias("new_count"), F.count_if(stored & F.col("_known").isNotNull()).alias("updated_count"),
        F.count_if("counted").alias("_p"), F.sum("calls").alias("llm_calls"), F.array_join(F.transform(said, lambda x: x["line"]), "\n").alias("_log"), F.bool_or(F.col("outcome") == "over_budget").alias("_over"),
    )
    met = scans.join(per, "source_id", "left").join(sources.select(F.col("id").alias("source_id")).distinct(), "source_id", "left_semi")
    zero = lambda c: F.coalesce(c, F.lit(0))
    log = F.concat_ws("\n", F.nullif("_log", F.lit("")), F.when(F.col("_over"), F.lit("call budget spent")))
    return met.select(
        "source_id", F.when(F.col("error").isNull(), "ok").otherwise("error").alias("status"), "error", zero("new_count").alias("new_count"), zero("updated_count").alias("updated_count"),
        (zero("pages_scanned") + zero("_p")).cast("bigint").alias("pages_fetched"), zero("llm_calls").cast("bigint").alias("llm_calls"), F.nullif(log, F.lit("")).alias("log"),
    )


def run_summary(results: DataFrame, labels: DataFrame) -> DataFrame:
    """The run of all sources as one row: totals, 'error' if any source failed, and a line a source, in order of source_id."""
    named = results.join(labels.select(F.col("id").alias("source_id"), "label"), "source_id", "left")
    line = F.concat(F.coalesce("label", "source_id"), F.lit(": "), "status", F.coalesce(F.concat(F.lit(" — "), "error"), F.lit("")))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("source_id", line.alias("line")))), lambda x: x["line"]), "\n")
    return named.agg(
        F.when(F.bool_or(F.col("status") == "error"), "error").otherwise("ok").alias("status"), F.sum("new_count").alias("new_count"), F.sum("updated_count").alias("updated_count"),
        F.sum("pages_fetched").alias("pages_fetched"), F.sum("llm_calls").alias("llm_calls"), F.count_if(F.col("status") == "error").alias("errored"), lines.alias("log"),
    )


def cache_selectors(sources: DataFrame, scans: DataFrame) -> DataFrame:
    """sources with list_selector set to the one that a scan found to work, where that is another. scans: source_id, selector_used."""
    used = scans.where("selector_used IS NOT NULL").groupBy("source_id").agg(F.max("selector_used").alias("_used")).withColumnRenamed("source_id", "_s")
    met = sources.join(used, F.col("id") == F.col("_s"), "left")
    return met.select(*[F.coalesce("_used", "list_selector").alias(c) if c == "list_selector" else F.col(c) for c in sources.columns])


def drafts(due: DataFrame, answers: DataFrame) -> DataFrame:
    """source_id, ok, note of the rules that a model drafted for sources whose draft is due.

    due: source_id, label, streak; answers: source_id, answer (JSON), the least of several. ok is whether the rule passes and can find
    items; note is its own, with how many errors brought it, or the reason it is not taken.
    """
    one = answers.groupBy("source_id").agg(F.min("answer").alias("answer"))
    read = due.join(one, "source_id").withColumn("r", extraction.checked_rule(F.col("answer")))
    said = F.coalesce(F.get_json_object("answer", "$.note"), F.lit(""))
    reason = F.when(F.col("r.status") != "valid", F.concat(F.lit("rule rejected by validation: "), F.array_join("r.reasons", "; "))).when(~F.col("r.usable"), F.coalesce(F.nullif(said, F.lit("")), F.lit("model found no grant list")))
    return read.select("source_id", "label", F.coalesce("r.usable", F.lit(False)).alias("ok"), F.coalesce(reason, F.concat(F.lit("[auto-draft after "), F.col("streak").cast("string"), F.lit(" consecutive errors] "), said)).alias("note"), "answer")


def proposals(open_: DataFrame, drafted: DataFrame) -> DataFrame:
    """Open proposals with the drafted rules merged in: one a source, a later draft takes the place of the open one.

    open_: source_id, path, content, state; drafted: as drafts(). content is the rule's file as indented JSON, without null fields.
    """
    rule = F.from_json("answer", extraction.RULE)
    body = F.struct("source_id", "label", "note", rule.alias("rule"))
    new = drafted.where("ok").select("source_id", F.concat(F.lit("drafted_rules/"), "source_id", F.lit(".json")).alias("path"), F.to_json(body, {"pretty": "true"}).alias("content"), F.lit("open").alias("state"))
    return merge.upsert(open_, new, ["source_id"]).withColumnRenamed("is_new", "opened")
