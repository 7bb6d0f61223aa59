"""What is stored: files, sizes and the shape of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def storage_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Files below ``path`` with type and size.

    The content column of the binary source is never selected, so Spark only lists
    the files and opens none.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(
        F.regexp_replace("path", "/[^/]*$", "").alias("directory"),
        name.alias("file"),
        F.when(name.contains("."), F.element_at(F.split(name, r"\."), -1)).alias("file_type"),
        F.col("length").alias("bytes"),
    )


def bytes_by_directory(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("directory", "file_type").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes")
    )


def profile_table(df: DataFrame) -> DataFrame:
    """One row per column: position, type, rows and non-null values; a single pass."""
    columns = df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(columns)]
    )
    types = dict(df.dtypes)
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("column_name"),
            F.lit(types[c]).alias("data_type"),
            F.col("n_rows"),
            F.col(f"n{i}").alias("non_null"),
        )
        for i, c in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*rows)))
