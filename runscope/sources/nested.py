"""Nested JSON documents: runs by space and dataset, and the split manifest.

A document that does not parse stops the job with Spark's own error, so an incomplete
result is never mistaken for a complete one. With ``skip_bad`` such documents are left
out; ``rejected_documents`` returns them. Blank lines are no documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from runscope.session import written_table
from runscope.sources import schema


def read_documents(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """One JSON document per row of ``value``: a line each, or a file each.

    A document is parsed by one task. Prefer JSON lines; a file per document is
    for documents spread over several lines, best one per space.
    """
    return spark.read.text(path, wholetext=whole_files)


def _parsed(kind: T.DataType, skip_bad: bool) -> Column:
    return F.from_json("value", kind, {"mode": "PERMISSIVE" if skip_bad else "FAILFAST"})


def _documents(documents: DataFrame) -> DataFrame:
    return documents.where(F.trim(F.regexp_replace("value", r"[\x09-\x0D]", " ")) != "")


def rejected_documents(documents: DataFrame, kind: T.DataType = schema.NESTED_RUNS) -> DataFrame:
    """The documents that ``skip_bad`` leaves out."""
    return _documents(documents).where(_parsed(kind, skip_bad=True).isNull())


def flatten_documents(documents: DataFrame, skip_bad: bool = False) -> DataFrame:
    """``{space: {dataset: {X, y}}}`` to one row per run; ``hp`` has all its configuration values.

    ``X`` and ``y`` are paired by position, up to the shorter of the two. An entry of ``y`` is a
    number or a list, of which the first element counts. A run is named after its space, dataset,
    document and position. Documents are told apart by a hash of their content, and copies of
    one by their number, so names are unique and depend neither on files nor on partitions.
    Only hashes and lengths are shuffled, and the text of documents that share theirs with another one.
    """
    hashed = _documents(documents).select("value", F.xxhash64("value").alias("hash"), F.octet_length("value").alias("size"))
    repeated = hashed.groupBy("hash", "size").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = written_table(repeated.select(F.col("hash").alias("_hash"), F.col("size").alias("_size")), "repeated-documents")
    shared = (F.col("hash") == F.col("_hash")) & (F.col("size") == F.col("_size"))
    copies = (
        hashed.join(repeated, shared, "left_semi")
        .groupBy("value", "hash")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("value", "hash", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("copy"))
    )
    single = hashed.join(repeated, shared, "left_anti").select("value", "hash", F.lit(1).cast("bigint").alias("copy"))
    counted = single.unionByName(copies)
    document = F.concat(F.lower(F.hex("hash")), F.when(F.col("copy") > 1, F.concat(F.lit("."), "copy")).otherwise(""))
    runs = (
        counted.select(document.alias("document"), _parsed(schema.NESTED_RUNS, skip_bad).alias("spaces"))
        .select("document", F.explode("spaces").alias("search_space_id", "datasets"))
        .select("document", "search_space_id", F.explode("datasets").alias("dataset_id", "runs"))
        .select(
            "document",
            "search_space_id",
            "dataset_id",
            F.least(F.size("runs.X"), F.size("runs.y")).alias("n"),
            F.posexplode(F.arrays_zip("runs.X", "runs.y")).alias("i", "run"),
        )
        .where(F.col("i") < F.col("n"))
    )
    y = F.trim(F.col("run.y"))
    first = F.when(y.startswith("["), F.get(F.from_json(y, "array<double>"), F.lit(0))).otherwise(y.cast("double"))
    return runs.select(
        F.concat_ws("_", "search_space_id", "dataset_id", "document", F.col("i")).alias("run_id"),
        F.col("search_space_id").cast("int").alias("search_space_id"),
        F.col("dataset_id").cast("int").alias("dataset_id"),
        first.alias("val_accuracy"),
        F.col("run.X").alias("hp"),
    )


def widen(runs: DataFrame, width: int | None = None) -> DataFrame:
    """``hp`` as columns ``hp_0, hp_1, ...``, NULL past the end of a configuration.

    Without ``width`` one aggregation finds it. A configuration with more values than
    ``width`` stops the job.
    """
    if width is None:
        width = runs.agg(F.max(F.size("hp")).alias("width")).first()["width"] or 0
    too_long = F.raise_error(F.concat(F.lit(f"a configuration has more than {width} values: run "), "run_id"))
    checked = F.when(F.size("hp") > width, too_long.cast("array<double>")).otherwise(F.col("hp"))
    plain = [c for c in runs.columns if c != "hp"]
    return runs.withColumn("hp", checked).select(
        *plain, *[F.get("hp", F.lit(j)).alias(f"hp_{j}") for j in range(width)]
    )


def flatten_nested_runs(
    spark: SparkSession, path: str, width: int | None = None, whole_files: bool = False, skip_bad: bool = False
) -> DataFrame:
    """All runs of the documents, with a column per configuration value.

    Without ``width`` the runs are written first, so that the documents are parsed once.
    """
    runs = flatten_documents(read_documents(spark, path, whole_files), skip_bad)
    return widen(runs if width is not None else written_table(runs, "flat-runs"), width)


def explode_manifest(documents: DataFrame, skip_bad: bool = False) -> DataFrame:
    """``{space: [dataset, ...]}`` documents to (space, dataset) rows."""
    return (
        _documents(documents)
        .select(_parsed(schema.MANIFEST, skip_bad).alias("spaces"))
        .select(F.explode("spaces").alias("search_space_id", "datasets"))
        .select("search_space_id", F.explode("datasets").alias("dataset_id"))
        .select(F.col("search_space_id").cast("int"), F.col("dataset_id").cast("int"))
    )


def explode_split_manifest(
    spark: SparkSession, path: str, whole_files: bool = True, skip_bad: bool = False
) -> DataFrame:
    return explode_manifest(read_documents(spark, path, whole_files), skip_bad)


def nest_runs(runs: DataFrame, document: str, hp_columns: list[str], order: list[str]) -> DataFrame:
    """The inverse of :func:`flatten_documents`, used to build its input.

    Runs with the same value of ``document`` share a JSON document, so the caller
    bounds its size by that value. They meet once, before they are nested: the lists are
    wider than the runs and are not shuffled.
    """
    runs = runs.select(document, "search_space_id", "dataset_id", *order, *hp_columns, "val_accuracy").repartition(document)
    entry = F.struct(*order, F.array(*hp_columns).alias("x"), F.array("val_accuracy").alias("y"))
    lists = (
        runs.groupBy(document, "search_space_id", "dataset_id")
        .agg(F.array_sort(F.collect_list(entry)).alias("runs"))
        .select(
            document,
            F.col("search_space_id").cast("string").alias("space"),
            F.struct(
                F.col("dataset_id").cast("string").alias("key"),
                F.struct(F.col("runs.x").alias("X"), F.col("runs.y").alias("y")).alias("value"),
            ).alias("dataset"),
        )
    )
    spaces = lists.groupBy(document, "space").agg(
        F.map_from_entries(F.collect_list("dataset")).alias("datasets")
    )
    return spaces.groupBy(document).agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("space", "datasets")))).alias("value")
    )
