"""Records of experiment runs: an append-only long table, its search and its wide view."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from runscope.session import written_table
from runscope.sources import schema

#: Partitions of a log, by a hash of the run.
PARTS = 64
LOGGED = T.StructType([*schema.RUN_LOG, T.StructField("record_id", T.StringType()), T.StructField("part", T.IntegerType())])

PARAM, METRIC, ARTIFACT, STATUS = "param", "metric", "artifact", "status"


def long_records(
    results: DataFrame,
    run_id: Column,
    run_name: Column,
    params: dict[str, Column] | None = None,
    metrics: dict[str, Column] | None = None,
    artifacts: dict[str, Column] | None = None,
    status: Column | None = None,
    ts: Column | None = None,
) -> DataFrame:
    """One row per logged value, for every row of ``results``; ``ts`` is now unless given."""
    text, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    entry = lambda kind, key, s, n: F.struct(
        F.lit(kind).alias("kind"), F.lit(key).alias("key"), s.alias("value_str"), n.alias("value_num")
    )
    entries = [entry(PARAM, k, v.cast("string"), number) for k, v in (params or {}).items()]
    entries += [entry(METRIC, k, text, v.cast("double")) for k, v in (metrics or {}).items()]
    entries += [entry(ARTIFACT, k, v.cast("string"), number) for k, v in (artifacts or {}).items()]
    if status is not None:
        entries.append(entry(STATUS, STATUS, status.cast("string"), number))
    return results.select(
        run_id.cast("string").alias("run_id"),
        run_name.cast("string").alias("run_name"),
        (F.current_timestamp() if ts is None else ts.cast("timestamp")).alias("ts"),
        F.inline(F.array(*entries)),
    ).select(*schema.RUN_LOG.names)


def metric_records(log: DataFrame, run_id: Column, run_name: Column, key: Column, value: Column, ts: Column) -> DataFrame:
    """Records of metrics whose names are data."""
    return log.select(
        run_id.cast("string").alias("run_id"), run_name.cast("string").alias("run_name"), F.lit(METRIC).alias("kind"),
        key.cast("string").alias("key"), F.lit(None).cast("string").alias("value_str"),
        value.cast("double").alias("value_num"), ts.cast("timestamp").alias("ts"),
    )


def with_record_id(records: DataFrame) -> DataFrame:
    """Add ``record_id``, a hash of everything a record says, and ``part``, a hash of its run."""
    # Texts are named by their length, so no two records have the same concatenation.
    said = [F.coalesce(F.concat_ws(":", F.length(c), c), F.lit("-")) for c in (F.col(n).cast("string") for n in schema.RUN_LOG.names if n != "ts")]
    time = F.coalesce(F.unix_micros("ts").cast("string"), F.lit("-"))
    return records.withColumns(
        {"record_id": F.md5(F.concat_ws("|", *said, time)), "part": F.pmod(F.xxhash64("run_id"), F.lit(PARTS)).cast("int")}
    )


def _logged(spark: SparkSession, path: str) -> DataFrame | None:
    """What a log holds, or None if there is none yet."""
    try:
        return spark.read.schema(LOGGED).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def log_run(records: DataFrame, path: str) -> None:
    """Append records that the log does not hold yet.

    A repeated append, or one repeated after it failed halfway, leaves the log as one append would: records are
    named by a hash of all they say, time included, and those the log has are left out. Give ``ts``, so that a
    repeated record has the same time. The log is partitioned by a hash of the run; only the ids of the partitions that the
    new records fall into are read. One writer at a time.
    """
    spark = records.sparkSession
    new = with_record_id(records.select(*schema.RUN_LOG.names)).dropDuplicates(["part", "record_id"])
    logged = _logged(spark, path)
    if logged is not None:
        new = written_table(new, "log-records")
        parts = [r["part"] for r in new.select("part").distinct().collect()]  # PARTS at most
        ids = logged.where(F.col("part").isin(parts)).select(F.col("part").alias("_part"), F.col("record_id").alias("_id"))
        new = new.join(ids, (F.col("part") == F.col("_part")) & (F.col("record_id") == F.col("_id")), "left_anti")
    new.write.mode("append").partitionBy("part").parquet(path)


def compact_log(spark: SparkSession, path: str, target: str) -> None:
    """Write the log to ``target`` with few files for each partition, sorted by run and time, every record once."""
    logged = _logged(spark, path)
    if logged is None:
        raise FileNotFoundError(path)
    once = logged.dropDuplicates(["part", "record_id"])
    once.hint("rebalance", "part").sortWithinPartitions("part", "run_id", "ts").write.partitionBy("part").parquet(target)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOGGED).parquet(path).select(*schema.RUN_LOG.names)


def search_runs(log: DataFrame) -> DataFrame:
    """One row per run with its name, status, start time and the latest value of everything logged.

    ``metrics``, ``params`` and ``artifacts`` are maps, so no key needs to be known beforehand and none
    is lost. The first grouping keeps one value per run and key and combines before the shuffle,
    however long a run's log is; the second one only gathers those. Of records of the same time the
    larger value counts.
    """
    by_key = log.groupBy("run_id", "kind", "key").agg(
        F.max(F.struct("ts", "value_num", "value_str")).alias("last"),
        F.min("ts").alias("start"),
        F.max(F.struct("ts", "run_name")).alias("named"),
    )

    def collected(kind: str, value: str) -> Column:
        mine = F.collect_list(F.when(F.col("kind") == kind, F.struct("key", F.col(f"last.{value}").alias("value"))))
        return F.map_from_entries(F.sort_array(mine))

    return by_key.groupBy("run_id").agg(
        F.max("named")["run_name"].alias("run_name"),
        F.max(F.when(F.col("kind") == STATUS, F.col("last")))["value_str"].alias("status"),
        F.min("start").alias("start_time"),
        collected(PARAM, "value_str").alias("params"),
        collected(METRIC, "value_num").alias("metrics"),
        collected(ARTIFACT, "value_str").alias("artifacts"),
    )


#: Columns of a wide table that are found without being named.
MOST_COLUMNS = 10_000


def metric_columns(found: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``metrics`` as columns ``metrics.<key>``; without ``keys`` those of all runs, found by one aggregation.

    More than ``MOST_COLUMNS`` names are an error: name the columns, or use the map.
    """
    if keys is None:
        names = found.select(F.explode(F.map_keys("metrics")).alias("key")).distinct().orderBy("key")
        keys = [r["key"] for r in names.limit(MOST_COLUMNS + 1).collect()]
        if len(keys) > MOST_COLUMNS:
            raise ValueError(f"the log has more than {MOST_COLUMNS} metrics; name the columns wanted")
    plain = [c for c in found.columns if c != "metrics"]
    return found.select(*plain, *[F.try_element_at("metrics", F.lit(k)).alias(f"metrics.{k}") for k in keys])
