import random

import pytest
from pyspark.sql import Window as W, functions as F

from runscope.operators import running as run
from runscope.operators.ranking import TIEBREAK, top_per_group, top_per_group_by_step, top_runs_per_space, warm_start_pool

ORDER = ["ts", "event_id"]


@pytest.fixture(scope="module")
def skewed(spark):
    """One method holds two thirds of the rows; many trials share a time; some lack a value."""
    rng = random.Random(1)
    rows = [
        ("hot" if i % 3 else f"m{i % 5}", rng.randrange(20), i, None if i % 11 == 0 else rng.uniform(-1, 1))
        for i in range(3000)
    ]
    return spark.createDataFrame(rows, "method string, ts int, event_id long, value double").repartition(5)


def brute(rows, start=0.0):
    state, out = {}, {}
    for r in sorted(rows, key=lambda r: (r["method"], r["ts"], r["event_id"])):
        n, best = state.get(r["method"], (0, start))
        best = best if r["value"] is None else max(best, r["value"])
        out[r["event_id"]] = (n, best)
        state[r["method"]] = (n + 1, best)
    return out


@pytest.mark.parametrize("rows_per_range", [10_000, 1000, 137])
def test_best_so_far_equals_a_plain_loop(skewed, rows_per_range):
    found = run.best_so_far(skewed, ["method"], ORDER, "value", rows_per_range=rows_per_range).collect()
    assert {r["event_id"]: (r["trial"], r["best"]) for r in found} == brute(skewed.collect())
    assert len(found) == 3000


def test_a_hot_method_is_spread_over_ranges(skewed):
    cut = skewed.repartitionByRange(10, "method", *ORDER).withColumn("r", F.spark_partition_id())
    assert cut.where("method = 'hot'").select("r").distinct().count() > 4


def test_running_without_groups_and_with_null_groups(spark):
    df = spark.createDataFrame([(None, 1, 2.0), (None, 2, 1.0), ("a", 1, 5.0)], "k string, i int, v double")
    found = run.running(df, ["k"], ["i"], {"total": ("sum", F.col("v"))}, rows_per_range=1).collect()
    assert sorted((r["k"] or "", r["i"], r["total"]) for r in found) == [("", 1, 2.0), ("", 2, 3.0), ("a", 1, 5.0)]
    found = run.running(df.where("k is null"), [], ["i"], {"n": ("sum", F.lit(1))}, rows_per_range=1).collect()
    assert sorted((r["i"], r["n"]) for r in found) == [(1, 1), (2, 2)]


def test_best_starts_at_zero(spark):
    df = spark.createDataFrame([("m", 0, -0.5), ("m", 1, -0.1), ("m", 2, 0.3)], "m string, i int, v double")
    found = run.best_so_far(df, ["m"], ["i"], "v").orderBy("i").collect()
    assert [r["best"] for r in found] == [0.0, 0.0, 0.3]


def test_trials_to_target_from_zero_and_from_one(spark):
    rows = [("fast", 0, 0.95), ("fast", 1, 0.2), ("late", 0, 0.1), ("late", 1, 0.9), ("late", 2, 0.99), ("never", 0, 0.5), ("never", 1, 0.6)]
    df = spark.createDataFrame(rows, "m string, i int, v double")
    ask = lambda base: {
        r["m"]: r["trials_to_target"] for r in run.trials_to_target(df, ["m"], ["i"], "v", 0.9, base).collect()
    }
    assert ask(0) == {"fast": 0, "late": 1, "never": 2}
    assert ask(1) == {"fast": 1, "late": 2, "never": 2}


def test_trials_to_target_agrees_with_the_curve(skewed):
    curve = run.best_so_far(skewed, ["method"], ORDER, "value").where("best >= 0.97")
    want = {r[0]: r[1] for r in curve.groupBy("method").agg(F.min("trial")).collect()}
    found = run.trials_to_target(skewed, ["method"], ORDER, "value", 0.97).where("reached").collect()
    assert {r["method"]: r["trials_to_target"] for r in found} == want


def test_cumulative_importance(spark):
    df = spark.createDataFrame([("a", 0.2), ("b", 0.5), ("c", 0.3)], "hp string, importance double")
    found = run.cumulative_importance(df).orderBy("cumulative").collect()
    assert [(r["hp"], round(r["cumulative"], 6), r["within_line"]) for r in found] == [
        ("b", 0.5, True), ("c", 0.8, True), ("a", 1.0, False)]


def test_daily_growth(spark):
    df = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-01-01 10:00:00'), (TIMESTAMP_NTZ'2024-01-01 23:59:59'), (TIMESTAMP_NTZ'2024-01-03 00:00:00') AS t(ts)")
    found = run.daily_growth(df, "ts").orderBy("day").collect()
    assert [(r["records"], r["total_records"]) for r in found] == [(2, 2), (1, 3)]


@pytest.mark.parametrize("k", [1, 5, 1500])
def test_top_k_forms_agree_on_a_hot_group(skewed, k):
    order = [F.desc_nulls_last("value"), "event_id"]
    plain = skewed.withColumn("rank", F.row_number().over(W.partitionBy("method").orderBy(*order))).where(F.col("rank") <= k)
    want = {(r["method"], r["event_id"], r["rank"]) for r in plain.collect()}
    forms = [
        top_per_group(skewed, ["method"], order, k),
        top_per_group_by_step(skewed, ["method"], F.coalesce(-F.floor(F.col("value") * 10), F.lit(99)), order, k),
        top_per_group_by_step(skewed, ["method"], F.lit(0), order, k),
    ]
    for form in forms:
        assert {(r["method"], r["event_id"], r["rank"]) for r in form.collect()} == want


def test_top_k_keeps_null_groups_and_null_steps(spark):
    df = spark.createDataFrame([(None, 1, 3), (None, 2, None), ("a", 3, 1)], "g string, id int, v int")
    found = top_per_group_by_step(df, ["g"], F.col("v"), ["v", "id"], 1).collect()
    assert {(r["g"], r["id"]) for r in found} == {(None, 2), ("a", 3)}


def test_top_runs_limit_each_space_before_the_shuffle(runs, capsys):
    top_per_group(runs, ["search_space_id"], [F.desc("val_accuracy"), *TIEBREAK], 3).explain()
    plan = capsys.readouterr().out
    partial, exchange = plan.index("Partial"), plan.index("Exchange")
    assert "WindowGroupLimit" in plan and exchange < partial  # printed from the root down


def test_top_runs_per_space(runs):
    found = top_runs_per_space(runs).collect()
    best = {r[0]: r[1] for r in runs.groupBy("search_space_id").agg(F.max("val_accuracy")).collect()}
    assert len(found) == 3 * len(best)
    assert {r["search_space_id"]: r["val_accuracy"] for r in found if r["rank"] == 1} == best


def test_warm_start_pool_skips_the_target(runs):
    found = warm_start_pool(runs, target=1, n_spaces=3, k=3).collect()
    assert len(found) == 9 and sorted({r["search_space_id"] for r in found}) == [0, 2, 3]


def test_best_runs_have_an_accuracy(spark):
    rows = [(1, f"r{i}", a) for i, a in enumerate([0.9, 0.89, 0.88, 0.87, 0.86, None, None, float("nan")])]
    runs = spark.createDataFrame(rows, "search_space_id int, run_id string, val_accuracy double")
    for c in ("learning_rate", "weight_decay", "epochs", "dropout"):
        runs = runs.withColumn(c, F.lit(0.0))
    assert [r["run_id"] for r in top_runs_per_space(runs).orderBy("rank").collect()] == ["r0", "r1", "r2"]
    steps = top_per_group_by_step(
        runs.where("not isnan(val_accuracy) or val_accuracy is null"), ["search_space_id"], F.floor(-F.col("val_accuracy") * 10), [F.desc("val_accuracy"), "run_id"], 7, nulls_first=False
    )
    assert [r["run_id"] for r in steps.orderBy("rank").collect()] == ["r0", "r1", "r2", "r3", "r4", "r5", "r6"]


def test_nan_is_neither_a_hit_nor_a_best_value(spark):
    rows = [("m", i, v) for i, v in enumerate([float("nan"), 0.2, float("nan"), 0.95])]
    trials = spark.createDataFrame(rows, "m string, i int, v double")
    assert run.trials_to_target(trials, ["m"], ["i"], "v").first()["trials_to_target"] == 3
    assert [r["best"] for r in run.best_so_far(trials, ["m"], ["i"], "v").orderBy("i").collect()] == [0.0, 0.2, 0.2, 0.95]
