"""Live progress of running experiments with Structured Streaming."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from runscope.session import fresh_path

# Executors need not have this package installed: the few functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def as_instant(ts: str) -> Column:
    """A zone-less timestamp read as UTC; watermarks do not accept zone-less ones."""
    return F.timestamp_micros(F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, {ts})"))


def as_utc_wall_time(instant: str) -> Column:
    return F.expr(f"timestampadd(MICROSECOND, unix_micros({instant}), {_EPOCH})")


def stream_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def live_progress(
    stream: DataFrame, by: str, ts: str, value: str, window: str = "1 day", delay: str = "1 hour"
) -> DataFrame:
    """Count and best value by window and method; works on a stream and on a batch.

    State is kept per window and method only, and dropped once the watermark passes.
    """
    return (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, window).alias("window"), F.col(by))
        .agg(F.count(F.lit(1)).alias("trials"), F.max(value).alias("best"))
        .select(F.col("window.start").alias("window_start"), by, "trials", "best")
    )


def run_to_table(progress: DataFrame, path: str, checkpoint: str) -> None:
    """Process all available input; keep the changed windows of every batch.

    Update mode also writes windows that are still open. Each batch overwrites its own
    folder, so a batch repeated after a failure leaves the same files.
    """

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    (
        progress.writeStream.outputMode("update")
        .foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def latest(spark: SparkSession, path: str, keys: list[str], values: list[str]) -> DataFrame:
    """The last written state of every window."""
    batches = spark.read.parquet(path)
    return (
        batches.groupBy(*keys)
        .agg(F.max_by(F.struct(*values), "batch").alias("_v"))
        .select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values])
    )


def progress_of(
    spark: SparkSession, path: str, schema: T.StructType, by: str, ts: str, value: str,
    window: str = "1 day", delay: str = "1 hour",
) -> DataFrame:
    """Stream the records below ``path``, a folder or a glob, to their end; return the progress by window."""
    records = stream_records(spark, path, schema)
    if isinstance(schema[ts].dataType, T.TimestampNTZType):
        records = records.withColumn(ts, as_instant(ts))
    keys = ["window_start", by]
    out = fresh_path(spark, "live-progress")
    run_to_table(live_progress(records, by, ts, value, window, delay), out, fresh_path(spark, "live-checkpoint"))
    return latest(spark, out, keys, ["trials", "best"])


#: Trials of a method that are numbered and handed on at once.
SLICE = 100_000


def _in_order(keys: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Places of the trials by time, then key; rows of the same time and key as they came."""
    if keys.dtype.kind in "iufM" and times.dtype.kind == "M":
        return np.lexsort((keys, times))
    return pd.DataFrame({"k": keys, "t": times}).sort_values(["t", "k"], kind="stable").index.to_numpy()


# --- running best ---------------------------------------------------------------------


def running_best(
    stream: DataFrame, by: str, ts: str, key: str, value: str, target: float, start: float = 0.0, idle: str | None = None
) -> DataFrame:
    """Every trial of a stream with its number, the best value of its method so far, and the first trial that reached the target.

    The state of a method is three numbers: trials, best value, first hit. They carry over from batch to batch and
    through restarts. Within a batch trials are taken by ``ts`` and ``key``; one that arrives
    after later ones is numbered after them. NaN and NULL are trials without a value. With ``idle``, an interval, a method
    without trials for that long of event time ends: it gets a last row with ``ended`` and its state goes.
    """
    kind = dict(stream.dtypes)[key]
    out = f"`{by}` string, `{key}` {kind}, trial bigint, value double, best double, hit bigint, ended boolean"
    pause = None if idle is None else int(pd.Timedelta(idle).total_seconds() * 1000)
    names = [by, key, "trial", "value", "best", "hit", "ended"]

    def step(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        trials, best, hit = state.get if state.exists else (0, start, None)
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([(group[0], None, trials, None, best, hit, True)], columns=names)
            return
        # Three plain arrays and an order are held; names and results exist for one slice at a time.
        parts = [(f[ts].to_numpy(), f[key].to_numpy(), f[value].to_numpy(dtype=float, na_value=np.nan)) for f in frames]
        times, keys, values = (np.concatenate(c) for c in zip(*parts))
        del parts
        order, size, last = _in_order(keys, times), len(times), pd.Series(times).max()
        del times
        for at in range(0, size, SLICE):
            taken = order[at : at + SLICE]
            found = values[taken]
            so_far = np.fmax.accumulate(np.fmax(found, best))
            number = np.arange(trials, trials + len(taken))
            reached = np.flatnonzero((found >= target) | (start >= target))
            if hit is None and len(reached):
                hit = int(number[reached[0]])
            hits = pd.array(np.full(len(taken), -1 if hit is None else hit), "Int64")
            hits[number < hit if hit is not None else np.full(len(taken), True)] = pd.NA
            trials, best = trials + len(taken), float(so_far[-1])
            if at + SLICE >= size:
                state.update((trials, best, hit))
                if pause is not None:
                    state.setTimeoutTimestamp(max(int(last.timestamp() * 1000), state.getCurrentWatermarkMs()) + pause)
            yield pd.DataFrame(
                {by: group[0], key: keys[taken], "trial": number, "value": found, "best": so_far, "hit": hits, "ended": False}
            )

    if idle is not None:
        stream = stream.withWatermark(ts, "0 seconds")
    timeout = GroupStateTimeout.NoTimeout if idle is None else GroupStateTimeout.EventTimeTimeout
    rows = stream.select(F.col(by).cast("string").alias(by), ts, key, F.col(value).cast("double").alias(value))
    return rows.groupBy(by).applyInPandasWithState(step, out, "trials bigint, best double, hit bigint", "append", timeout)


def run_appended(rows: DataFrame, path: str, checkpoint: str) -> None:
    """Process all available input of a stream that appends; a batch repeated after a failure leaves the same files."""

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = rows.writeStream.outputMode("append").foreachBatch(keep).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()


def best_of(
    spark: SparkSession, path: str, schema: T.StructType, by: str, ts: str, key: str, value: str, target: float, start: float = 0.0
) -> DataFrame:
    """Stream the records below ``path`` to their end; return every trial with the running best."""
    records = stream_records(spark, path, schema)
    if isinstance(schema[ts].dataType, T.TimestampNTZType):
        records = records.withColumn(ts, as_instant(ts))
    out = fresh_path(spark, "live-best")
    run_appended(running_best(records, by, ts, key, value, target, start), out, fresh_path(spark, "live-checkpoint"))
    return spark.read.parquet(out).drop("batch")


def reached_target(best: DataFrame, by: str) -> DataFrame:
    """By method: trials, trials before the target was reached (all of them if it never was), and whether it was."""
    trials = F.max("trial") + 1
    return best.where(~F.col("ended")).groupBy(by).agg(
        trials.alias("n_trials"), F.coalesce(F.min("hit"), trials).alias("trials_to_target"), F.min("hit").isNotNull().alias("reached")
    )
