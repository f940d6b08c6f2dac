"""Processing only new or changed records.

Method: each run rereads its input from the oldest transaction that was open when the last successful
run began (the low-water mark), so that nothing arriving late or left by a dead run is skipped; the
overlap this reads again is removed by an anti-join of (key, version) pairs against a ledger of what
has been processed, and rows older than what the ledger has of their page are left out. The ledger and
the marks are committed together by one atomic rename, so a run that dies at any point leaves either
the old state or the new one.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaglio.functions.text import content_hash
from vaglio.functions.urls import canonical_url, split_url, truthy, url_hash
from vaglio.session import small_side


#: Microseconds that a null time counts as.
OLDEST = -(2**62)


def low_water_mark(runs: DataFrame) -> DataFrame:
    """Per source, from which moment on the input must be read again.

    runs: source_id, started_at, finished_at, status. The last successful run of a source read all that had arrived
    when it began, from the mark that held then. What it cannot have seen was written by transactions open at that
    moment: runs that had begun and ended after it, or have not ended and did not fail. The mark is the earliest
    start of these, else the start of the last successful run itself, so that it also goes back behind all runs that
    failed since; runs that failed before are covered by it and hold nothing back. Null (read all) for a
    source that never had a success. open_runs counts the open ones and those that failed since. Ties do
    not matter, rows without source or start are left out.
    """
    runs = runs.where(F.col("source_id").isNotNull() & F.col("started_at").isNotNull())
    good = F.coalesce((F.col("status") == "ok") & F.col("finished_at").isNotNull(), F.lit(False))
    last = runs.where(good).groupBy("source_id").agg(F.max(F.struct("started_at", "finished_at")).alias("l")).select("source_id", F.col("l.started_at").alias("last_start"), F.col("l.finished_at").alias("last_end"))
    open_ = (F.col("started_at") < F.col("last_start")) & F.coalesce(F.col("finished_at") > F.col("last_start"), ~F.coalesce(F.col("status") == "error", F.lit(False)))
    since = (F.col("started_at") >= F.col("last_start")) & ~good
    return (
        runs.join(last, "source_id", "left")
        .groupBy("source_id")
        .agg(
            F.first("last_end").alias("last_end"),
            F.coalesce(F.min(F.when(open_, F.col("started_at"))), F.first("last_start")).alias("reread_from"),
            F.count_if(F.coalesce(open_ | since, F.lit(False))).alias("open_runs"),
        )
    )


def page_versions(candidates: DataFrame, sources: DataFrame) -> DataFrame:
    """Candidates with their page (source, canonical URL hash) and version (content hash).

    Relative URLs are read against the source's list_url, or its url where that is null. Rows
    without URL or source name no page and are left out; a null text has a null version.
    """
    base = sources.select(F.col("id").alias("_sid"), split_url(truthy(F.col("list_url"), F.col("url"))).alias("_base")).dropDuplicates(["_sid"])
    rows = candidates.select("candidate_id", "source_id", "url", "text", "fetched_at", "arrived_at")
    return (
        rows.where(F.col("url").isNotNull() & F.col("source_id").isNotNull())
        .join(base, F.col("source_id") == F.col("_sid"), "left")
        .select(
            "candidate_id",
            "source_id",
            F.unhex(url_hash(canonical_url(F.col("url"), base_parts=F.col("_base")))).alias("page"),
            F.unhex(content_hash(F.col("text"))).alias("version"),
            "fetched_at",
            "arrived_at",
        )
    )


def _age(c: str) -> Column:
    """Microseconds of a time; a null is older than any other."""
    return F.coalesce(F.unix_micros(F.col(c).cast("timestamp")), F.lit(OLDEST))


def newest_version(versions: DataFrame) -> DataFrame:
    """Per page the row with the newest fetched_at (as fetched, in microseconds), on a tie the smallest candidate_id.

    One shuffle, combined on the map side: a page that holds a third of all rows arrives as one row
    a map task. A null fetched_at is older than any other.
    """
    rank = F.struct(_age("fetched_at").alias("t"), (-F.col("candidate_id")).alias("i"), F.col("version").alias("v"))
    return (
        versions.groupBy("source_id", "page")
        .agg(F.max(rank).alias("best"))
        .select((-F.col("best.i")).alias("candidate_id"), "source_id", "page", F.col("best.v").alias("version"), F.col("best.t").alias("fetched"))
    )


def ledger_state(snapshots: DataFrame) -> DataFrame:
    """Per page the newest snapshot's version. On equal times a known hash precedes null, then the greater."""
    return (
        snapshots.where(F.col("url_hash").isNotNull() & F.col("source_id").isNotNull())
        .groupBy("source_id", F.unhex(F.lower("url_hash")).alias("page"))
        .agg(F.max(F.struct(F.unix_micros(F.col("last_seen_at").cast("timestamp")).alias("t"), F.unhex(F.lower("content_hash")).alias("v"))).alias("best"))
        .select("source_id", "page", F.col("best.v").alias("version"), F.coalesce("best.t", F.lit(OLDEST)).alias("fetched"))
    )


def unprocessed(newest: DataFrame, ledger: DataFrame) -> DataFrame:
    """Newest versions whose (key, version) pair the ledger lacks; a null version matches nothing."""
    return newest.join(ledger.select("source_id", "page", "version"), ["source_id", "page", "version"], "left_anti")


def not_older(newest: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of newest but those that are older than what the ledger has of their page; of equal times the greater candidate_id is older, where the ledger has one."""
    k = ledger.select("source_id", "page", F.col("fetched").alias("_t"), (F.col("candidate_id") if "candidate_id" in ledger.columns else F.lit(None).cast("long")).alias("_c"))
    older = (F.col("fetched") < F.col("_t")) | ((F.col("fetched") == F.col("_t")) & (F.col("candidate_id") > F.col("_c")))
    return newest.join(k, ["source_id", "page"], "left").where(~F.coalesce(older, F.lit(False))).drop("_t", "_c")


def since(candidates: DataFrame, marks: DataFrame) -> DataFrame:
    """The candidates that arrived from their source's mark on, at an unknown time, or whose source has no mark."""
    m = marks.select(F.col("source_id").alias("_m"), "reread_from")
    return candidates.join(small_side(m)[0], F.col("source_id") == F.col("_m"), "left").where(
        F.col("reread_from").isNull() | F.col("arrived_at").isNull() | (F.col("arrived_at") >= F.col("reread_from"))
    )


def pending_pages(candidates: DataFrame, sources: DataFrame, snapshots: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """The candidates to process now: the newest of each page where it differs from the newest snapshot.

    marks: low_water_mark() of an earlier committed run; rows that arrived before their source's mark
    are not read, and of the others those fetched before their page's newest snapshot was last seen are
    late and left out. Without it (no run of ours has been committed) all rows are read. Each page comes once.
    Empty tables give an empty result; repeated rows and columns besides the named ones change nothing.
    """
    ledger = ledger_state(snapshots)
    if marks is None:
        newest = newest_version(page_versions(candidates, sources))
    else:
        newest = not_older(newest_version(page_versions(since(candidates, marks), sources)), ledger)
    return unprocessed(newest, ledger).drop("fetched")


class ChangeFeed:
    """Runs of pending_pages() with their own ledger, safe against a death at any point.

    State lies in a folder that all executors share: ledger/<epoch> (Parquet) and state.json, which names the
    committed epoch, the epochs that make up the ledger, and the marks, one a source. Each epoch holds only the pages
    of its run, so that a commit costs what the run handled; every COMPACT epochs they are written as one. The newest
    row of a page holds: a row that arrives late and is older is neither handled nor recorded. commit() writes the
    epoch first and renames the new state.json over the old one last: what a run that died before that left is
    ignored and rewritten.
    """

    COMPACT = 16

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.folder).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._same: DataFrame | None = None
        self._overwrite = spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename

    def state(self) -> dict:
        at = self._path(f"{self.folder}/state.json")
        if not self._fs.exists(at):
            return {"epoch": 0}
        return json.loads(self.spark.read.text(str(at.toString())).first().value)

    def ledger(self) -> DataFrame:
        """source_id, page, version, candidate_id and fetched (microseconds) of the newest row of all pages that were processed."""
        state = self.state()
        schema = "source_id STRING, page BINARY, version BINARY, candidate_id BIGINT, fetched BIGINT"
        if not state["epoch"]:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*[f"{self.folder}/ledger/{e}" for e in state["epochs"]])
        if len(state["epochs"]) == 1:
            return rows
        rank = F.struct("fetched", (-F.col("candidate_id")).alias("i"), "version")
        return rows.groupBy("source_id", "page").agg(F.max(rank).alias("m")).select("source_id", "page", "m.version", (-F.col("m.i")).alias("candidate_id"), "m.fetched")

    def marks(self) -> DataFrame:
        """source_id, reread_from of the last commit that was given marks."""
        rows = [(s, dt.datetime.fromisoformat(at)) for s, at in self.state().get("marks", {}).items()]
        return self.spark.createDataFrame(rows, "source_id STRING, reread_from TIMESTAMP_NTZ")

    def pending(self, candidates: DataFrame, sources: DataFrame, marks: DataFrame | None = None) -> DataFrame:
        """As pending_pages(), against this feed's ledger, with fetched; the committed marks hold unless others are given, and any only once a run is committed."""
        state = self.state()
        if state["epoch"] and (marks is not None or state.get("marks")):
            candidates = since(candidates, self.marks() if marks is None else marks)
        ledger = self.ledger()
        newest = not_older(newest_version(page_versions(candidates, sources)), ledger)
        # a newer row of the same version is not handled again, but its time is recorded
        self._same = newest.join(ledger.select("source_id", "page", "version"), ["source_id", "page", "version"], "left_semi")
        return unprocessed(newest, ledger)

    def commit(self, done: DataFrame, marks: DataFrame | None = None) -> int:
        """Record done (rows of the last pending()) as processed, and the marks of the run, as low_water_mark() gives them; returns the new epoch."""
        state = self.state()
        epoch = state["epoch"] + 1
        columns = ["source_id", "page", "version", "candidate_id", "fetched"]
        seen = done.select(columns).dropDuplicates(["source_id", "page"])
        if self._same is not None:
            seen = seen.unionByName(self._same.select(columns).join(seen.select("source_id", "page"), ["source_id", "page"], "left_anti"))
        epochs = [*state.get("epochs", []), epoch]
        gone: list[int] = []
        if len(epochs) > self.COMPACT:
            kept = self.ledger().join(seen.select("source_id", "page"), ["source_id", "page"], "left_anti")
            seen, gone, epochs = kept.unionByName(seen), epochs[:-1], [epoch]
        seen.write.mode("overwrite").parquet(f"{self.folder}/ledger/{epoch}")
        self._same = None
        kept_marks = state.get("marks", {}) if marks is None else {r.source_id: r.at for r in marks.where("reread_from IS NOT NULL").select("source_id", F.col("reread_from").cast("timestamp_ntz").cast("string").alias("at")).collect()}
        new = self._path(f"{self.folder}/state.json.new")
        out = self._fs.create(new, True)
        out.write(bytearray(json.dumps({"epoch": epoch, "epochs": epochs, "marks": kept_marks}).encode()))
        out.close()
        rename = self.spark.sparkContext._gateway.new_array(self._overwrite, 1)
        rename[0] = self._overwrite.OVERWRITE
        self._context.rename(new, self._path(f"{self.folder}/state.json"), rename)
        for e in gone:  # no state names them any more
            self._fs.delete(self._path(f"{self.folder}/ledger/{e}"), True)
        return epoch
