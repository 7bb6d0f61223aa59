"""Label encoding, feature vectors and splits."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from runscope.functions.draws import in_share
from runscope.operators.running import running
from runscope.session import written_table

INDEXED = {"optimizer": "optimizer_idx", "search_space_id": "space_idx", "dataset_id": "dataset_idx"}
ASSEMBLED = [
    "learning_rate", "batch_size", "dropout", "num_layers", "hidden_units",
    "weight_decay", "epochs", "optimizer_idx", "space_idx", "dataset_idx",
]
MATRIX_COLUMNS = ["run_id", "search_space_id", "dataset_id", "features", "val_accuracy", "optimizer"]


def _labels(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with their counts. Grouped by the value itself, named only afterwards."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return written_table(counts.withColumn("label", F.col("value").cast("string")), "labels")


def _numbered(labels: DataFrame, order: list[str | Column]) -> DataFrame:
    """0-based position of every label; long label lists are numbered range by range."""
    numbered = running(labels, [], order, {"position": ("sum", F.lit(1))})
    return numbered.select("value", "label", (F.col("position") - 1).cast("int").alias("index"))


def alphabetical_labels(df: DataFrame, column: str) -> DataFrame:
    return _numbered(_labels(df, column), ["label"])


def frequency_labels(df: DataFrame, column: str) -> DataFrame:
    """Most frequent label first; equal counts in alphabetical order."""
    return _numbered(_labels(df, column).withColumn("less", -F.col("n")), ["less", "label"])


def encode(df: DataFrame, column: str, labels: DataFrame, output: str) -> DataFrame:
    """Add the index of each label; unknown labels get NULL and no row is lost."""
    named = labels.select(F.col("value").alias(f"_{output}"), F.col("index").alias(output))
    return df.join(named, F.col(column) == F.col(f"_{output}"), "left").drop(f"_{output}")


def encode_alphabetical(df: DataFrame, column: str, output: str) -> DataFrame:
    return encode(df, column, alphabetical_labels(df, column), output)


def encode_by_frequency(df: DataFrame, column: str, output: str) -> DataFrame:
    return encode(df, column, frequency_labels(df, column), output)


def decode_labels(df: DataFrame, index: str, labels: DataFrame, output: str) -> DataFrame:
    named = labels.select(F.col("index").alias(f"_{output}"), F.col("label").alias(output))
    return df.join(named, F.col(index) == F.col(f"_{output}"), "left").drop(f"_{output}")


def feature_matrix(runs: DataFrame) -> DataFrame:
    """Index the three label columns by frequency and assemble ten inputs.

    The labels are tables and are joined, so their number is not bounded by the driver. A missing label gets
    the index after the last one.
    """
    coded = runs
    for column, output in INDEXED.items():
        # Labels come from the plain runs, not from the runs joined so far.
        labels = written_table(frequency_labels(runs, column), "labels")
        coded = encode(coded, column, labels, output).withColumn(
            output, F.coalesce(F.col(output), F.lit(labels.count())).cast("double")
        )
    return VectorAssembler(inputCols=ASSEMBLED, outputCol="features").transform(coded).select(*MATRIX_COLUMNS)


def save_feature_matrix(matrix: DataFrame, path: str) -> None:
    matrix.select(*MATRIX_COLUMNS).write.mode("overwrite").parquet(path)


def split_runs(runs: DataFrame, key: str = "run_id", first_hex: str = "cccc") -> tuple[DataFrame, DataFrame]:
    """Train and test by hash of the run id, 80/20 by default; the same split on any layout."""
    share = in_share(F.col(key), first_hex)
    return runs.where(share), runs.where(~share)


def with_part(runs: DataFrame, key: str = "run_id", first_hex: str = "cccc") -> DataFrame:
    """The same split as a ``part`` column, for uses that need both sides in one scan."""
    return runs.withColumn("part", F.when(in_share(F.col(key), first_hex), "train").otherwise("test"))
