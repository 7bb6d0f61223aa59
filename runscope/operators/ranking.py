"""Best runs per space and the warm-start pool drawn from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from runscope.functions.measures import present, whole_millionths
from runscope.session import written_table

PARTS = 64
TIEBREAK = ["run_id", "learning_rate", "weight_decay", "epochs", "dropout"]


def top_per_group(df: DataFrame, by: list[str], order: list[str | Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of every group.

    Spark limits each group inside every task before the shuffle, so a hot group
    sends at most ``k`` rows per task. It does so up to a threshold on ``k``; above it,
    a first ranking within ``PARTS`` parts of each group does the same by hand.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > limit:
        part = F.pmod(F.xxhash64(*df.columns), F.lit(PARTS))
        in_part = W.partitionBy(*by, "_part").orderBy(*order)
        df = (
            df.withColumn("_part", part)
            .withColumn(rank, F.row_number().over(in_part))
            .where(F.col(rank) <= k)
            .drop("_part", rank)
        )
    window = W.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def top_per_group_by_step(
    df: DataFrame,
    by: list[str],
    step: Column,
    order: list[str | Column],
    k: int,
    rank: str = "rank",
    nulls_first: bool = True,
) -> DataFrame:
    """The same, for large inputs: most rows are put aside before anything is sorted.

    ``step`` is a whole number that never falls along the order and takes few values;
    ``nulls_first`` tells on which end of the order the rows stand whose step is NULL.
    Rows are counted by step, which combines before the shuffle. The last step needed
    to fill each group's ``k`` places is written as a small table, and a second scan
    keeps the rows up to it: all of the top ``k``, plus ties within the last step.
    """
    step = F.coalesce(step.cast("bigint"), F.lit(-(2**62) if nulls_first else 2**62))
    counts = df.groupBy(*by, step.alias("_step")).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*by).orderBy("_step").rowsBetween(W.unboundedPreceding, -1)
    needed = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).where(F.col("_before") < k)
    last = needed.groupBy(*[F.col(c).alias(f"_by_{c}") for c in by]).agg(F.max("_step").alias("_last"))
    same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    kept = df.join(written_table(last, "last-steps"), same).where(step <= F.col("_last"))
    return top_per_group(kept.select(*df.columns), by, order, k, rank)


def top_runs_per_space(runs: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` most accurate runs of every space. Runs without an accuracy (NULL or NaN) are none of the best."""
    measured = runs.where(present("val_accuracy").isNotNull())
    return top_per_group_by_step(
        measured, ["search_space_id"], -whole_millionths(F.col("val_accuracy")), [F.desc("val_accuracy"), *TIEBREAK], k
    )


def source_spaces(runs: DataFrame, target: int, n_spaces: int = 3) -> DataFrame:
    """The lowest space ids other than the target."""
    return (
        runs.select("search_space_id")
        .where(F.col("search_space_id") != target)
        .distinct()
        .orderBy("search_space_id")
        .limit(n_spaces)
    )


def warm_start_pool(runs: DataFrame, target: int, n_spaces: int = 3, k: int = 3) -> DataFrame:
    """The ``k`` best runs of each of ``n_spaces`` source spaces."""
    chosen = source_spaces(runs, target, n_spaces)
    return top_runs_per_space(runs.join(chosen, "search_space_id", "left_semi"), k)
