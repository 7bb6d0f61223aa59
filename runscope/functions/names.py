"""Names of columns, metrics and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def columns_with_prefix(df: DataFrame, prefix: str = "hp_") -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def metric_key(label: Column) -> Column:
    """``Random Search`` becomes ``random_search``."""
    return F.lower(F.replace(label, F.lit(" "), F.lit("_")))


def metric_title(key: Column, prefix: str = "metrics.") -> Column:
    """``metrics.best_value`` becomes ``Best Value``."""
    return F.initcap(F.replace(F.replace(key, F.lit(prefix), F.lit("")), F.lit("_"), F.lit(" ")))
