"""Run tables: scans, sinks, catalog names and the generator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from runscope.functions import draws

# The identifiers and options of the synthetic run log.
SPACES = ["4796", "5527", "5636", "5859", "5860", "5891", "5906", "5965", "5970", "5971"]
OPTIMIZERS = ["adam", "sgd", "rmsprop", "adagrad"]
BATCH_SIZES = [16, 32, 64, 128, 256]
HIDDEN_UNITS = [64, 128, 256, 512]
N_DATASETS = 50


def scan_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_runs_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Runs from CSV with a header. Without a schema Spark reads the files twice to infer one."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.csv(path, inferSchema=True)


def write_runs(runs: DataFrame, path: str) -> None:
    """Overwrite a Parquet table partitioned by space.

    The rebalance hint lets adaptive execution split a space that holds a large
    share of the rows over several writers and join small ones, so neither one
    huge task nor many tiny files come out.
    """
    (
        runs.hint("rebalance", "search_space_id")
        .write.mode("overwrite")
        .partitionBy("search_space_id")
        .parquet(path)
    )


def write_runs_csv(runs: DataFrame, path: str) -> None:
    runs.write.mode("overwrite").option("header", True).csv(path)


def register_runs(runs: DataFrame, name: str, path: str | None = None) -> None:
    """Name a table for SQL: a view, or an external Parquet table when a path is given."""
    if path is None:
        runs.createOrReplaceTempView(name)
    else:
        runs.write.mode("overwrite").option("path", path).format("parquet").saveAsTable(name)


def synthetic_columns(number: Column, seed: int = 42) -> list[Column]:
    """The columns of one synthetic run, drawn from its number."""
    u = draws.uniform_draws(number, seed, 14)
    return [
        F.concat(F.lit("run_"), F.lpad(number.cast("string"), 7, "0")).alias("run_id"),
        draws.pick(u[0], SPACES).cast("int").alias("search_space_id"),
        F.concat(F.lit("dataset_"), draws.whole_between(u[1], 0, N_DATASETS).cast("string")).alias(
            "dataset_id"
        ),
        draws.log_between(u[2], 1e-5, 1e-1).alias("learning_rate"),
        draws.pick(u[3], BATCH_SIZES).alias("batch_size"),
        draws.between(u[4], 0.0, 0.5).alias("dropout"),
        draws.whole_between(u[5], 1, 6).alias("num_layers"),
        draws.pick(u[6], HIDDEN_UNITS).alias("hidden_units"),
        draws.pick(u[7], OPTIMIZERS).alias("optimizer"),
        draws.log_between(u[8], 1e-6, 1e-2).alias("weight_decay"),
        draws.whole_between(u[9], 10, 200).alias("epochs"),
        draws.between(u[10], 0.5, 0.99).alias("val_accuracy"),
        draws.between(u[11], 0.01, 2.0).alias("train_loss"),
        draws.between(u[12], 0.01, 2.5).alias("val_loss"),
        draws.between(u[13], 10.0, 3600.0).alias("train_time_sec"),
    ]


def generate_runs(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    return spark.range(n).select(*synthetic_columns(F.col("id"), seed))


def runs_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test tables hold no tuning runs; this derives one run per line item.

    Plain projections, so a query reads only the source columns behind the run
    columns it uses. Every measure lies on a grid of at most six decimals.
    """
    c = F.col
    cents = lambda name: F.rint(c(name) * 100.0)
    return scan_runs(spark, f"{sf_dir}/lineitem.parquet").select(
        F.concat_ws("_", F.lit("run"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias(
            "run_id"
        ),
        (c("l_suppkey") % 16).cast("int").alias("search_space_id"),
        (c("l_partkey") % 97).cast("int").alias("dataset_id"),
        ((c("l_orderkey") % 2000 + 1) / F.lit(100000.0)).alias("learning_rate"),
        F.element_at(
            F.array(*[F.lit(b) for b in BATCH_SIZES]), F.least(c("l_linenumber") % 5, F.lit(4)) + 1
        ).alias("batch_size"),
        (cents("l_discount") / 20.0).alias("dropout"),
        (c("l_partkey") % 5 + 1).cast("int").alias("num_layers"),
        F.element_at(
            F.array(*[F.lit(h) for h in HIDDEN_UNITS]), (c("l_orderkey") % 4).cast("int") + 1
        ).alias("hidden_units"),
        F.element_at(
            F.array(*[F.lit(o) for o in OPTIMIZERS]), (c("l_partkey") % 4).cast("int") + 1
        ).alias("optimizer"),
        (cents("l_tax") / 1000.0).alias("weight_decay"),
        (c("l_quantity") + 10).cast("int").alias("epochs"),
        (c("l_quantity") / 50.0).alias("hp_0"),
        (cents("l_discount") / 10.0).alias("hp_1"),
        (cents("l_tax") / 10.0).alias("hp_2"),
        ((c("l_partkey") % 101) / F.lit(100.0)).alias("hp_3"),
        F.when(c("l_suppkey") % 2 == 0, (c("l_orderkey") % 51) / F.lit(50.0)).alias("hp_4"),
        (
            (
                F.lit(500000.0)
                + c("l_quantity") * 6000.0
                + cents("l_discount") * 15000.0
                + cents("l_tax") * 4000.0
            )
            / 1e6
        ).alias("val_accuracy"),
    )
