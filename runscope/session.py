"""Session settings and the shared folder for written tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN_FOLDER = "runscope.work.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(name: str = "runscope", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution, Arrow and UTC; sizes are left to the cluster."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session that
    names none gets a temporary folder; on a cluster that is an error, because a
    machine-local path is lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_OWN_FOLDER, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="runscope-")
    spark.conf.set(_OWN_FOLDER, own)
    return own


def fresh_path(spark: SparkSession, label: str) -> str:
    return os.path.join(shared_folder(spark), "runscope", f"{label}-{uuid.uuid4().hex}")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go when the query is done, not when the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def written_table(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder, with the writer's ``options``, and read it back.

    Used where a result feeds several later steps. It cuts the lineage, survives
    the loss of executors, and gives the planner the true size of the table, so
    that Spark broadcasts it in a join only below ``autoBroadcastJoinThreshold``
    and otherwise falls back to a shuffled join with skew handling. The shuffle files
    of the write go as soon as it is done.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    with shuffles_removed(spark):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
