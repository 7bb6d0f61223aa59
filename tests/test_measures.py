from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from runscope.functions import draws, names
from runscope.functions.measures import bin_of, gain_percent, gap_percent, highest, lr_band, mean, speed_label, spread


def exact(values, digits):
    total = sum(Decimal(repr(v)) for v in values) / len(values)
    return float(total.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def test_mean_rounds_ties_up(spark):
    # The mean is exactly 0.00015; a mean of doubles lands on either side.
    df = spark.createDataFrame([(0.0001,), (0.0002,)], "v double")
    assert df.agg(mean("v", 4)).first()[0] == 0.0002


def test_mean_of_negative_values_rounds_away_from_zero(spark):
    df = spark.createDataFrame([(-0.0001,), (-0.0002,)], "v double")
    assert df.agg(mean("v", 4)).first()[0] == -0.0002


def test_mean_skips_nulls_and_is_null_for_nothing(spark):
    df = spark.createDataFrame([(1, 0.5), (1, None), (2, None)], "k int, v double")
    assert dict(df.groupBy("k").agg(mean("v", 4)).collect()) == {1: 0.5, 2: None}


def test_mean_keeps_digits_beyond_the_sixth(spark):
    values = [0.843751234567, 0.120000499999, 0.5]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(mean("v", 6)).first()[0] == exact(values, 6)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10**7, 10**7), min_size=1, max_size=40), st.sampled_from([2, 4, 6]))
def test_mean_equals_decimal_arithmetic_on_any_partitioning(spark, units, digits):
    values = [u / 10**6 for u in units]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = {df.repartition(n).agg(mean("v", digits)).first()[0] for n in (1, 3)}
    assert found == {exact(values, digits)}


def test_spread_of_one_row_is_null(spark):
    assert spark.range(1).agg(spread(F.col("id").cast("double"))).first()[0] is None


def test_gain_and_gap(spark):
    row = spark.range(1).select(
        gain_percent(F.lit(0.99), F.lit(0.9)).alias("gain"),
        gap_percent(F.lit(1.0), F.lit(0.75)).alias("gap"),
        gain_percent(F.lit(1.0), F.lit(0.0)).alias("none"),
    ).first()
    assert row["gain"] == pytest.approx(10.0) and row["gap"] == 25.0 and row["none"] is None


def test_speed_labels(spark):
    cases = [(24, 10, "2.4x faster"), (24, 39, "0.6x slower"), (24, 24, "1.0x"), (1, 4, "0.3x slower"), (5, 0, None)]
    df = spark.createDataFrame(cases, "base long, trials long, want string")
    for row in df.withColumn("got", speed_label(F.col("base"), F.col("trials"))).collect():
        assert row["got"] == row["want"]


def test_speed_labels_from_trial_0(spark):
    cases = [(24, 10, "2.4x faster"), (0, 0, "1.0x"), (0, 3, "0.3x slower"), (5, 0, "6.0x faster")]
    df = spark.createDataFrame(cases, "base long, trials long, want string")
    for row in df.withColumn("got", speed_label(F.col("base"), F.col("trials"), base=0)).collect():
        assert row["got"] == row["want"]


def test_means_survive_nan_and_size(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (2.0,), (None,)], "v double")
    row = df.agg(mean("v", 4).alias("m"), highest("v").alias("h"), spread("v").alias("s")).first()
    assert (row["m"], row["h"]) == (1.5, 2.0) and row["s"] == pytest.approx(0.7071)
    big = spark.range(10_000_000).select(F.lit(3.6e9).alias("v")).agg(mean("v", 4).alias("m")).first()
    assert big["m"] == 3.6e9
    assert df.where("isnan(v)").agg(mean("v", 4).alias("m")).first()["m"] is None


def test_lr_band_limits_are_strict(spark):
    df = spark.createDataFrame([(0.0009,), (0.001,), (0.0099,), (0.01,)], "r double")
    assert [r[0] for r in df.select(lr_band("r")).collect()] == ["low", "medium", "medium", "high"]


def test_bins_include_both_ends(spark):
    df = spark.createDataFrame([(0.0,), (0.999,), (1.0,), (-0.1,), (1.5,)], "v double")
    assert [r[0] for r in df.select(bin_of(F.col("v"), 10)).collect()] == [0, 9, 9, 0, 9]


def test_metric_names(spark):
    df = spark.createDataFrame([("Bayesian TPE",)], "label string")
    row = df.select(
        names.metric_key(F.col("label")).alias("key"), names.metric_title(F.lit("metrics.surrogate_r2_test")).alias("title")
    ).first()
    assert (row["key"], row["title"]) == ("bayesian_tpe", "Surrogate R2 Test")


def test_draws_do_not_depend_on_the_layout(spark):
    def drawn(partitions):
        df = spark.range(0, 500, 1, partitions)
        u = draws.uniform_draws(F.col("id"), 7, 5)
        return sorted(map(tuple, df.select("id", *u).collect()))

    rows = drawn(1)
    assert rows == drawn(7)
    flat = [v for r in rows for v in r[1:]]
    assert 0 <= min(flat) and max(flat) < 1 and abs(sum(flat) / len(flat) - 0.5) < 0.02
