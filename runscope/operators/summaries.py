"""Grouped summaries of runs. All are one partial and one final aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from runscope.functions.measures import bin_of, gain_percent, gap_percent, highest, lr_band, mean, spread

PROFILE_FEATURES = ["avg_acc", "best_acc", "std_acc", "avg_hp0", "avg_hp1", "avg_hp2", "avg_hp3"]


def _runs() -> Column:
    return F.count(F.lit(1))


def dataset_profiles(runs: DataFrame, min_runs: int = 10, ordered: bool = True) -> DataFrame:
    """One profile per (space, dataset) with at least ``min_runs`` runs, best first.

    The order costs one more shuffle of the profiles; leave it out where they feed
    another operator.
    """
    profiles = (
        runs.groupBy("search_space_id", "dataset_id")
        .agg(
            _runs().alias("n_runs"),
            mean("val_accuracy", 4).alias("avg_acc"),
            highest("val_accuracy").alias("best_acc"),
            spread("val_accuracy").alias("std_acc"),
            *[mean(f"hp_{j}", 4).alias(f"avg_hp{j}") for j in range(4)],
        )
        .where(F.col("n_runs") >= min_runs)
    )
    return profiles.orderBy(F.desc("best_acc"), "search_space_id", "dataset_id") if ordered else profiles


def top_config_profile(runs: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Mean configuration of the runs at or above ``threshold``, by space."""
    return (
        runs.where(F.col("val_accuracy") >= threshold)
        .groupBy("search_space_id")
        .agg(
            *[mean(f"hp_{j}", 6).alias(f"best_hp{j}") for j in range(5)],
            highest("val_accuracy").alias("best_acc"),
            _runs().alias("top_runs"),
        )
        .orderBy(F.desc("best_acc"), "search_space_id")
    )


def space_optimizer_summary(runs: DataFrame, n: int | None = 15) -> DataFrame:
    table = (
        runs.groupBy("search_space_id", "optimizer")
        .agg(
            mean("val_accuracy", 4).alias("avg_acc"),
            mean("learning_rate", 6).alias("avg_lr"),
            mean("dropout", 4).alias("avg_dropout"),
            _runs().alias("runs"),
        )
        .orderBy(F.desc("avg_acc"), "search_space_id", "optimizer")
    )
    return table if n is None else table.limit(n)


def _by_space(runs: DataFrame) -> DataFrame:
    return runs.groupBy("search_space_id").agg(
        _runs().alias("runs"), mean("val_accuracy", 4).alias("avg_acc"), highest("val_accuracy").alias("best_acc")
    )


def space_summary(runs: DataFrame) -> DataFrame:
    return _by_space(runs).orderBy(F.desc("runs"), "search_space_id")


def space_by_accuracy(runs: DataFrame) -> DataFrame:
    return _by_space(runs).orderBy(F.desc("avg_acc"), "search_space_id")


def largest_spaces(runs: DataFrame, n: int = 10) -> DataFrame:
    return space_summary(runs).limit(n)


def accuracy_by(runs: DataFrame, column: str) -> DataFrame:
    """Mean accuracy and run count by one column, best first."""
    return (
        runs.groupBy(column)
        .agg(mean("val_accuracy", 4).alias("avg_acc"), _runs().alias("runs"))
        .orderBy(F.desc("avg_acc"), column)
    )


def batch_size_summary(runs: DataFrame) -> DataFrame:
    return accuracy_by(runs, "batch_size")


def optimizer_summary(runs: DataFrame) -> DataFrame:
    return accuracy_by(runs, "optimizer")


def lr_band_summary(runs: DataFrame, low: float = 0.001, mid: float = 0.01) -> DataFrame:
    return runs.groupBy(lr_band("learning_rate", low, mid).alias("lr_range")).agg(
        mean("val_accuracy", 4).alias("avg_acc"), _runs().alias("count")
    )


def dataset_distribution(runs: DataFrame, n: int = 20) -> DataFrame:
    return (
        runs.groupBy("dataset_id")
        .agg(_runs().alias("runs"), mean("val_accuracy", 4).alias("avg_acc"))
        .orderBy(F.desc("runs"), "dataset_id")
        .limit(n)
    )


def runs_per_space(runs: DataFrame) -> DataFrame:
    return runs.groupBy("search_space_id").agg(_runs().alias("runs"))


def global_accuracy(runs: DataFrame) -> DataFrame:
    return runs.agg(
        mean("val_accuracy", 4).alias("avg_acc"), highest("val_accuracy").alias("best_acc"), _runs().alias("runs")
    )


def distinct_counts(runs: DataFrame, approximate: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return runs.agg(
        _runs().alias("runs"),
        distinct("search_space_id").alias("spaces"),
        distinct("dataset_id").alias("datasets"),
    )


def list_spaces(runs: DataFrame) -> DataFrame:
    return runs.select("search_space_id").distinct()


def datasets_per_space(profiles: DataFrame, spaces: list[int]) -> DataFrame:
    return (
        profiles.where(F.col("search_space_id").isin(spaces))
        .groupBy("search_space_id")
        .agg(_runs().alias("datasets"), mean("avg_acc", 4).alias("mean_acc"))
    )


def accuracy_heatmap(runs: DataFrame, space: int, hp_x: str, hp_y: str, bins: int = 30) -> DataFrame:
    """Mean accuracy on a grid of two hyperparameters in one space; rows missing either are left out."""
    return (
        runs.where(F.col("search_space_id") == space)
        .where(F.col(hp_x).isNotNull() & F.col(hp_y).isNotNull())
        .groupBy(bin_of(F.col(hp_x), bins).alias("x_bin"), bin_of(F.col(hp_y), bins).alias("y_bin"))
        .agg(mean("val_accuracy", 4).alias("avg_acc"), _runs().alias("runs"))
    )


def status_counts(records: DataFrame, status: str, finished: str) -> DataFrame:
    return records.agg(
        _runs().alias("total"), F.count_if(F.col(status) == finished).alias("finished")
    )


def accuracy_gain(runs: DataFrame) -> DataFrame:
    """By space: gain of the best run over the mean, and the gap the other way, in percent."""
    best, average = F.col("best_acc"), F.col("avg_acc")
    return _by_space(runs).select(
        "search_space_id",
        "best_acc",
        "avg_acc",
        gain_percent(best, average).alias("gain_pct"),
        gap_percent(best, average).alias("gap_pct"),
    )
