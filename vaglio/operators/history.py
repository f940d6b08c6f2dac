"""What past runs tell: streaks of errors, schedules, summaries, budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vaglio.functions.scrub import scrub

#: The source types that a rule can be drafted for.
DRAFTABLE = ("html", "html_js")
GAP_MINUTES = 50
DAILY_HOUR = 6
ZONE = "Europe/Rome"
#: Characters kept of a source's last error, and of a run's log.
LAST_ERROR_CHARS, LOG_CHARS = 1000, 5000


def error_streaks(outcomes: DataFrame) -> DataFrame:
    """Each outcome with its streak: errors in a row up to it, 0 after a success. outcomes: source_id, seq, status."""
    by = W.partitionBy("source_id").orderBy("seq")
    island = outcomes.withColumn("island", F.sum(F.when(F.col("status") == "error", 0).otherwise(1)).over(by))
    streak = F.sum(F.when(F.col("status") == "error", 1).otherwise(0)).over(W.partitionBy("source_id", "island").orderBy("seq"))
    return island.withColumn("streak", streak).drop("island")


def log_cut(text: Column, most: int, secrets: list[str] = ()) -> Column:
    """A message as it is kept: secrets out first, then cut, so that no half secret is left at the cut."""
    return F.substring(scrub(text, secrets), 1, most)


def source_status(sources: DataFrame, outcomes: DataFrame, secrets: list[str] = ()) -> DataFrame:
    """sources after a run: last_status, last_scan_at, last_error and consecutive_errors of those with an outcome.

    outcomes: source_id, status, error, at; of several the last by at. An error adds one to the streak, a success ends it.
    """
    last = outcomes.groupBy("source_id").agg(F.max(F.struct("at", "status", "error")).alias("_o")).select(F.col("source_id").alias("_s"), "_o")
    failed = F.col("_o.status") == "error"
    new = {
        "last_status": F.col("_o.status"), "last_scan_at": F.col("_o.at"), "last_error": log_cut(F.col("_o.error"), LAST_ERROR_CHARS, secrets),
        "consecutive_errors": F.when(failed, F.coalesce("consecutive_errors", F.lit(0)) + 1).otherwise(0),
    }
    rows = sources if "last_error" in sources.columns else sources.withColumn("last_error", F.lit(None).cast("string"))
    met = rows.join(last, F.col("id") == F.col("_s"), "left")
    return met.select(*[F.when(F.col("_s").isNotNull(), new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in rows.columns])


def run_rows(runs: DataFrame, secrets: list[str] = ()) -> DataFrame:
    """Runs as they are appended to the log of runs: log scrubbed, then cut."""
    return runs.withColumn("log", log_cut(F.col("log"), LOG_CHARS, secrets))


def last_completed(runs: DataFrame) -> DataFrame:
    """finished_at of the newest run of all sources (source_id null); no row if none has finished. Failed runs count."""
    return runs.where("source_id IS NULL").agg(F.max("finished_at").alias("finished_at")).where("finished_at IS NOT NULL")


def drafts_due(streaks: DataFrame, sources: DataFrame, threshold: int = 3) -> DataFrame:
    """source_id, seq where a draft is due: the streak just reached threshold, of a draftable source; none if it is 0."""
    able = sources.where(F.col("type").isin(*DRAFTABLE)).select(F.col("id").alias("source_id")).distinct()
    return streaks.where((F.lit(threshold) > 0) & (F.col("streak") == threshold)).join(F.broadcast(able), "source_id").select("source_id", "seq")


def window_start(frequency: Column, now: Column) -> Column:
    """When the window that holds now (UTC) began: daily at six, or every sixth hour, by the clock of ZONE."""
    local = F.from_utc_timestamp(now, ZONE)
    day = F.date_trunc("day", local)
    hours = F.when(frequency == "daily", F.lit(DAILY_HOUR)).otherwise(F.floor(F.hour(local) / 6) * 6)
    return F.to_utc_timestamp(day + F.make_dt_interval(F.lit(0), hours.cast("int")), ZONE)


def should_run(frequency: Column, now: Column, last: Column) -> Column:
    """Whether a tick at now is to scan: unknown frequencies and first scans always do."""
    early = F.hour(F.from_utc_timestamp(now, ZONE)) < DAILY_HOUR
    return (
        F.when(~F.coalesce(frequency.isin("hourly", "six_hourly", "daily"), F.lit(False)) | last.isNull(), F.lit(True))
        .when(frequency == "hourly", F.unix_micros(now) - F.unix_micros(last) >= GAP_MINUTES * 60_000_000)
        .when((frequency == "daily") & early, F.lit(False))
        .otherwise(last < window_start(frequency, now))
    )


def reason(frequency: Column, now: Column, last: Column) -> Column:
    """Why should_run() says what it says, in a word."""
    early = F.hour(F.from_utc_timestamp(now, ZONE)) < DAILY_HOUR
    return (
        F.when(~F.coalesce(frequency.isin("hourly", "six_hourly", "daily"), F.lit(False)), "unknown_frequency").when(last.isNull(), "no_previous_scan")
        .when((frequency == "daily") & early, "before_hour").when(should_run(frequency, now, last), "due").otherwise("window_done")
    )


def run_summary(results: DataFrame, keys: list[str]) -> DataFrame:
    """Per run of all sources: totals, 'error' if any source failed, and the sources' logs in order, a line each."""
    log = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("source_id", F.concat_ws(": ", "source_id", "log").alias("line")))), lambda x: x["line"]), "\n")
    return results.groupBy(*keys).agg(
        F.count("*").alias("sources"), F.sum("new_count").alias("new_count"),
        F.when(F.bool_or(F.col("status") == "error"), "error").otherwise("ok").alias("status"), F.nullif(log, F.lit("")).alias("log"),
    )


def admitted(calls: DataFrame, cap: int, budget: int | None) -> DataFrame:
    """Each call with whether both its run's cap and its source's budget have room for it.

    calls: run_key, source_id, seq; a source stops at its budget (null: none), so calls beyond it use
    none of the run's. Ordered by source and seq within a run. A run's calls are never in one task: those of a
    source are ranked by themselves, and what the sources before it used is a sum over one row a source.
    """
    ranked = calls.withColumn("of_source", F.row_number().over(W.partitionBy("run_key", "source_id").orderBy("seq")))
    used = F.count("*") if budget is None else F.least(F.count("*"), F.lit(budget))
    per = calls.groupBy("run_key", "source_id").agg(used.alias("_u"))
    before = per.select("run_key", F.col("source_id").alias("_s"), (F.sum("_u").over(W.partitionBy("run_key").orderBy("source_id")) - F.col("_u")).alias("_b"))
    fits = ranked.join(before.withColumnRenamed("run_key", "_r"), F.col("run_key").eqNullSafe(F.col("_r")) & F.col("source_id").eqNullSafe(F.col("_s")))
    fits = fits.withColumn("in_budget", F.lit(True) if budget is None else F.col("of_source") <= budget).withColumn("of_run", F.col("_b") + F.col("of_source"))
    return fits.withColumn("admitted", F.col("in_budget") & (F.col("of_run") <= cap)).drop("_r", "_s", "_b")
