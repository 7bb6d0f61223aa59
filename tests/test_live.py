import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from runscope.operators import running as run
from runscope.session import fresh_path
from runscope.streaming import live

SCHEMA = T.StructType(
    [T.StructField("ts", T.TimestampNTZType()), T.StructField("method", T.StringType()), T.StructField("value", T.DoubleType())]
)


def records(spark, n, start):
    first = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=start)
    rows = [(first + dt.timedelta(minutes=37 * i), "ab"[i % 2], float(i % 13)) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def batch(df):
    return {
        (r["window_start"], r["method"]): (r["trials"], r["best"])
        for r in df.groupBy(F.window("ts", "1 day").start.alias("window_start"), "method")
        .agg(F.count("*").alias("trials"), F.max("value").alias("best"))
        .collect()
    }


def streamed(df):
    wall = live.as_utc_wall_time("window_start")
    return {(r["w"], r["method"]): (r["trials"], r["best"]) for r in df.withColumn("w", wall).collect()}


def test_stream_equals_batch(spark, tmp_path):
    path = str(tmp_path / "in")
    df = records(spark, 200, 0)
    df.write.parquet(path)
    assert streamed(live.progress_of(spark, path, SCHEMA, "method", "ts", "value")) == batch(df)


def test_result_does_not_depend_on_the_session_zone(spark, tmp_path):
    path = str(tmp_path / "in")
    df = records(spark, 50, 0)
    df.write.parquet(path)
    want = batch(df)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        got = streamed(live.progress_of(spark, path, SCHEMA, "method", "ts", "value"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == want


def test_a_second_run_continues_from_the_checkpoint(spark, tmp_path):
    path, out, check = str(tmp_path / "in"), fresh_path(spark, "live"), fresh_path(spark, "check")

    def step():
        source = live.stream_records(spark, path, SCHEMA).withColumn("ts", live.as_instant("ts"))
        live.run_to_table(live.live_progress(source, "method", "ts", "value"), out, check)
        return streamed(live.latest(spark, out, ["window_start", "method"], ["trials", "best"]))

    early, late = records(spark, 60, 0), records(spark, 60, 60 * 37 + 5)
    early.write.parquet(path)
    assert step() == batch(early)
    late.write.mode("append").parquet(path)
    assert step() == batch(early.unionByName(late))


def test_live_progress_works_on_a_batch(spark):
    df = records(spark, 100, 0)
    assert streamed(live.live_progress(df.withColumn("ts", live.as_instant("ts")), "method", "ts", "value")) == batch(df)


# --- running best ---------------------------------------------------------------------

TRIALS = T.StructType([*SCHEMA, T.StructField("id", T.LongType())])


def trials(spark, n, start, seed=0):
    rng = random.Random(seed + start)
    first = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=start)
    values = [rng.choice([None, math.nan, *(float(v) for v in range(20))]) for _ in range(n)]
    rows = [(first + dt.timedelta(minutes=i // 3), rng.choice("abc"), v, start * 10 + i) for i, v in enumerate(values)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, TRIALS)


def expected(df, target):
    best = run.best_so_far(df, ["method"], ["ts", "id"], "value").select("method", "id", "trial", "best")
    hits = run.trials_to_target(df, ["method"], ["ts", "id"], "value", target)
    return {tuple(r) for r in best.collect()}, {tuple(r) for r in hits.select("method", "n_trials", "trials_to_target", "reached").collect()}


def found(best):
    rows = best.where("not ended").select("method", "id", "trial", "best")
    hits = live.reached_target(best, "method").select("method", "n_trials", "trials_to_target", "reached")
    return {tuple(r) for r in rows.collect()}, {tuple(r) for r in hits.collect()}


@pytest.mark.parametrize("target", [0.0, 18.0, 99.0])
def test_running_best_equals_best_so_far(spark, tmp_path, target):
    df, path = trials(spark, 300, 0), str(tmp_path / "in")
    df.write.parquet(path)
    assert found(live.best_of(spark, path, TRIALS, "method", "ts", "id", "value", target)) == expected(df, target)


def test_running_best_continues_after_a_restart(spark, tmp_path):
    path, out, check = str(tmp_path / "in"), fresh_path(spark, "best"), fresh_path(spark, "check")

    def step():
        source = live.stream_records(spark, path, TRIALS).withColumn("ts", live.as_instant("ts"))
        live.run_appended(live.running_best(source, "method", "ts", "id", "value", 19.0), out, check)
        return found(spark.read.parquet(out))

    parts = [trials(spark, 90, k * 1000) for k in range(3)]
    seen = None
    for part in parts:
        part.write.mode("append").parquet(path)
        seen = part if seen is None else seen.unionByName(part)
        assert step() == expected(seen, 19.0)
    # Nothing new: nothing changes.
    assert step() == expected(seen, 19.0)


def test_a_method_is_handed_on_in_slices(spark, tmp_path, monkeypatch):
    df, path, out = trials(spark, 300, 0), str(tmp_path / "in"), fresh_path(spark, "best")
    df.write.parquet(path)
    monkeypatch.setattr(live, "SLICE", 7)
    source = live.stream_records(spark, path, TRIALS).withColumn("ts", live.as_instant("ts"))
    live.run_appended(live.running_best(source, "method", "ts", "id", "value", 18.0), out, fresh_path(spark, "check"))
    assert found(spark.read.parquet(out)) == expected(df, 18.0)


def test_order_by_time_and_key():
    times = np.array(["2024-01-02", "2024-01-01", "NaT", "2024-01-01", "2024-01-01"], dtype="datetime64[ns]")
    assert live._in_order(np.array([1, 5, 0, 3, 5]), times).tolist() == [3, 1, 4, 0, 2]
    assert live._in_order(np.array(["1", "5", "0", "3", "5"], dtype=object), times).tolist() == [3, 1, 4, 0, 2]


def test_a_method_without_trials_ends(spark, tmp_path):
    path, out, check = str(tmp_path / "in"), fresh_path(spark, "best"), fresh_path(spark, "check")

    def step():
        source = live.stream_records(spark, path, TRIALS).withColumn("ts", live.as_instant("ts"))
        live.run_appended(live.running_best(source, "method", "ts", "id", "value", 5.0, idle="1 hour"), out, check)
        return {(r["method"], r["trial"], r["best"]) for r in spark.read.parquet(out).where("ended").collect()}

    def write(method, hour, value, number):
        row = [(dt.datetime(2024, 1, 1, hour), method, value, number)]
        spark.createDataFrame(row, TRIALS).write.mode("append").parquet(path)

    write("a", 0, 3.0, 1)
    assert step() == set()
    write("b", 9, 4.0, 2)
    step()
    write("b", 10, 6.0, 3)
    assert step() == {("a", 1, 3.0)}
