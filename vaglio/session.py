"""Session helpers: reading tables, durable lineage cuts, shipping the package to executors."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED = "vaglio.shipped"
_KEPT: dict[tuple[str, str, str], DataFrame | tuple[DataFrame, ...]] = {}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table of the data folder, with column pruning and pushdown left to Catalyst."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give executors the package once per application, whatever their working folder is."""
    context = spark.sparkContext
    if context.getLocalProperty(_SHIPPED) == context.applicationId:
        return
    here = Path(__file__).resolve().parent
    # Only the driver reads this file: addPyFile sends its content to every executor.
    folder = tempfile.mkdtemp(prefix="vaglio-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "vaglio.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(here.rglob("*.py")):
            z.write(path, f"vaglio/{path.relative_to(here)}")
    context.addPyFile(archive)
    context.setLocalProperty(_SHIPPED, context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or in local mode one of our own.

    A cluster without that setting is an error, because a machine-local folder is lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="vaglio-checkpoint-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    folder = "file://" + own
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and cut its lineage there; losing an executor loses nothing of it."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def once(build):
    """What build(spark, root) gives, durable, and the same again within an application: a run computes once what several queries report on."""

    @functools.wraps(build)
    def kept(spark: SparkSession, root: str):
        key = (spark.sparkContext.applicationId, build.__qualname__, root)
        if key not in _KEPT:
            got = build(spark, root)
            _KEPT[key] = tuple(durable(d) for d in got) if isinstance(got, tuple) else durable(got)
        return _KEPT[key]

    return kept


def small_side(df: DataFrame, limit: int = 200_000) -> tuple[DataFrame, bool]:
    """df, broadcast if it is counted to have at most limit rows; else unchanged for a shuffle join."""
    rows = df.limit(limit + 1).count()
    return (F.broadcast(df), True) if rows <= limit else (df, False)
