"""Projections, filters and cleaning of run tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from runscope.functions.measures import spread
from runscope.session import written_table


def project_runs(runs: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Pick columns; keys are the new names."""
    return runs.select(*[F.col(source).alias(name) for name, source in columns.items()])


def filter_space(runs: DataFrame, space: int) -> DataFrame:
    return runs.where(F.col("search_space_id") == space)


def filter_top_accuracy(runs: DataFrame, threshold: float = 0.95) -> DataFrame:
    return runs.where(F.col("val_accuracy") >= threshold)


def exclude_target_space(runs: DataFrame, space: int) -> DataFrame:
    return runs.where(F.col("search_space_id") != space)


def fill_missing_hp(runs: DataFrame, columns: list[str]) -> DataFrame:
    """NULL and NaN become 0. For models and distances only; averages skip NULL instead."""
    return runs.fillna(0, subset=columns)


def _extremes(runs: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    filled = fill_missing_hp(runs.select(*by, *columns), columns)
    return filled.groupBy(*by).agg(
        *[F.min(c).alias(f"min_{c}") for c in columns],
        *[F.max(c).alias(f"max_{c}") for c in columns],
        *[spread(c, 6).alias(f"std_{c}") for c in columns],
    )


def hp_variation(runs: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Per column, overall or by group: sample deviation after filling, and whether the column varies at all.

    ``min < max`` is the exact form of "deviation above zero" and is false for a
    single row, whose deviation is undefined.
    """
    by = by or []
    rows = [
        F.struct(
            F.lit(c).alias("hp"),
            F.col(f"std_{c}").alias("std"),
            F.coalesce(F.col(f"min_{c}") < F.col(f"max_{c}"), F.lit(False)).alias("kept"),
        )
        for c in columns
    ]
    return _extremes(runs, columns, by).select(*by, F.inline(F.array(*rows)))


def blank_constant_hp(runs: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """``drop_constant_hp`` for many groups at once: a column is NULL in the groups in which it doesn't vary."""
    found = _extremes(runs, columns, by).select(
        *[F.col(c).alias(f"_by_{c}") for c in by],
        *[(F.col(f"min_{c}") < F.col(f"max_{c}")).alias(f"_varies_{c}") for c in columns],
    )
    found = written_table(found, "variation")
    same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    filled = fill_missing_hp(runs, columns)
    joined = filled.join(found, same)
    return joined.select(
        *[F.when(F.col(f"_varies_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in filled.columns]
    )


def varying_columns(runs: DataFrame, columns: list[str]) -> list[str]:
    """Columns that take more than one value; one pass, one row to the driver."""
    kept = {r["hp"] for r in hp_variation(runs, columns).where("kept").collect()}
    return [c for c in columns if c in kept]


def drop_constant_hp(runs: DataFrame, columns: list[str]) -> DataFrame:
    kept = set(varying_columns(runs, columns))
    filled = fill_missing_hp(runs, columns)
    return filled.drop(*[c for c in columns if c not in kept])


def drop_all_null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(how="all", subset=[f"`{c}`" if "." in c else c for c in columns])


def drop_empty_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop those of ``columns`` that never hold a value; one pass, one row to the driver."""
    quoted = {c: f"`{c}`" for c in columns}
    counts = df.agg(*[F.count(F.col(q)).alias(f"n{i}") for i, q in enumerate(quoted.values())]).first()
    empty = [c for i, c in enumerate(columns) if counts[i] == 0]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in empty])


def in_manifest(runs: DataFrame, manifest: DataFrame, test: bool) -> DataFrame:
    """Runs of the held-out datasets, or all others.

    No hint: the planner broadcasts the manifest when its size allows and otherwise
    shuffles, where adaptive execution splits a hot (space, dataset).
    """
    kind = "left_semi" if test else "left_anti"
    return runs.join(manifest, ["search_space_id", "dataset_id"], kind)


def mark_held_out(runs: DataFrame, manifest: DataFrame) -> DataFrame:
    """Both sides of the manifest in one scan, told apart by ``part``."""
    listed = manifest.distinct().withColumn("_listed", F.lit(True))
    marked = runs.join(listed, ["search_space_id", "dataset_id"], "left")
    return marked.withColumn("part", F.when(F.col("_listed"), "test").otherwise("train")).drop("_listed")


def when_known(known: Column, value: Column) -> Column:
    """Score of a candidate with an unknown label is 0."""
    return F.when(known, value).otherwise(F.lit(0.0))
