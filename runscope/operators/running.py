"""Running values over long ordered logs, and what is derived from them.

A window partitioned by method hands all rows of a method to one task. A log with
one dominant method would not fit. So a long log is first cut into ranges of the
full sort key, tiebreak included: a method of any size spreads over many ranges.
Every range is then scanned on its own, starting from a carry row that holds the
running values of the ranges before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from runscope.functions.measures import present
from runscope.session import written_table

ROWS_PER_RANGE = 1_000_000

_COMBINE = {"max": F.max, "sum": F.sum}


def running(
    df: DataFrame,
    by: list[str],
    order: list[str],
    measures: dict[str, tuple[str, Column]],
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add running ``max`` / ``sum`` columns by group; ``order`` must end in a unique tiebreak."""
    ranges = -(-df.count() // rows_per_range)
    prepared = df.select("*", *[value.alias(f"_{name}") for name, (_, value) in measures.items()])
    kinds = {name: kind for name, (kind, _) in measures.items()}
    if ranges <= 1:
        window = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
        return prepared.select(
            *df.columns, *[_COMBINE[k](f"_{n}").over(window).alias(n) for n, k in kinds.items()]
        )

    # Range sampling may differ between two evaluations, so the cut is written down once.
    cut = written_table(
        prepared.repartitionByRange(ranges, *by, *order).withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    before = W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    totals = cut.groupBy(*by, "_range").agg(*[_COMBINE[k](f"_{n}").alias(f"_{n}") for n, k in kinds.items()])
    carry = totals.select(
        *by, "_range", F.lit(True).alias("_carry"),
        *[_COMBINE[k](f"_{n}").over(before).alias(f"_{n}") for n, k in kinds.items()],
    )
    rows = cut.withColumn("_carry", F.lit(False)).unionByName(carry, allowMissingColumns=True)
    within = (
        W.partitionBy(*by, "_range")
        .orderBy(F.desc("_carry"), *order)
        .rowsBetween(W.unboundedPreceding, 0)
    )
    scanned = rows.select(
        *df.columns, "_carry", *[_COMBINE[k](f"_{n}").over(within).alias(n) for n, k in kinds.items()]
    )
    return scanned.where(~F.col("_carry")).drop("_carry")


def best_so_far(
    trials: DataFrame,
    by: list[str],
    order: list[str],
    value: str,
    start: float = 0.0,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Trial number (0-based) and best value so far, never below ``start``; NaN and NULL are no best value."""
    scanned = running(
        trials, by, order, {"trial": ("sum", F.lit(1)), "best": ("max", present(value))}, rows_per_range
    )
    return scanned.withColumn("trial", F.col("trial") - 1).withColumn(
        "best", F.greatest(F.lit(float(start)), "best")
    )


def trials_to_target(
    trials: DataFrame,
    by: list[str],
    order: list[str],
    value: str,
    target: float = 0.90,
    base: int = 0,
    start: float = 0.0,
) -> DataFrame:
    """Trials before the best value reaches ``target``; all of them if it never does.

    The best value reaches the target at the first trial that does, so no window is
    needed: find the first hit of each group, then count the rows before it. A NaN is no hit. Only
    rows that reach the target are looked at for the first hit. The table of hits is written, hence the
    planner knows its size and broadcasts it only if small.
    """
    reached = (present(value) >= target) | F.lit(start >= target)
    place = F.struct(*order)
    hits = trials.groupBy(*by).agg(F.min(F.when(reached, place)).alias("_hit"))
    first = written_table(hits, "first-hits")
    keys = {c: f"_by_{c}" for c in by}
    renamed = first.withColumnsRenamed(keys)
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()]
    return (
        trials.join(renamed, same, "inner")
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n_trials"),
            F.count_if(F.col("_hit").isNull() | (place < F.col("_hit"))).alias("_before"),
            F.bool_or(F.col("_hit").isNotNull()).alias("reached"),
        )
        .select(
            *by,
            "n_trials",
            F.when(F.col("reached"), F.col("_before") + base).otherwise(F.col("n_trials")).alias("trials_to_target"),
            "reached",
        )
    )


def daily_growth(log: DataFrame, ts: str) -> DataFrame:
    """Records by day and in total so far. The window runs over one row per calendar day."""
    days = log.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("records"))
    so_far = W.orderBy("day").rowsBetween(W.unboundedPreceding, 0)
    return days.withColumn("total_records", F.sum("records").over(so_far))


def cumulative_importance(importances: DataFrame, line: float = 0.8) -> DataFrame:
    """Running share in descending importance; one row per model column."""
    so_far = W.orderBy(F.desc("importance"), "hp").rowsBetween(W.unboundedPreceding, 0)
    ranked = importances.withColumn("cumulative", F.sum("importance").over(so_far))
    return ranked.withColumn("within_line", F.col("cumulative") <= line)
