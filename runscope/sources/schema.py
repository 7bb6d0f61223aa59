"""Schemas of the run tables."""

from __future__ import annotations

from pyspark.sql import types as T

SYNTHETIC_RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("search_space_id", T.IntegerType()),
        T.StructField("dataset_id", T.StringType()),
        T.StructField("learning_rate", T.DoubleType()),
        T.StructField("batch_size", T.IntegerType()),
        T.StructField("dropout", T.DoubleType()),
        T.StructField("num_layers", T.IntegerType()),
        T.StructField("hidden_units", T.IntegerType()),
        T.StructField("optimizer", T.StringType()),
        T.StructField("weight_decay", T.DoubleType()),
        T.StructField("epochs", T.IntegerType()),
        T.StructField("val_accuracy", T.DoubleType()),
        T.StructField("train_loss", T.DoubleType()),
        T.StructField("val_loss", T.DoubleType()),
        T.StructField("train_time_sec", T.DoubleType()),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_name", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value_str", T.StringType()),
        T.StructField("value_num", T.DoubleType()),
        T.StructField("ts", T.TimestampType()),
    ]
)


def real_runs(width: int) -> T.StructType:
    """Runs of a real benchmark: ids, accuracy and ``hp_0 .. hp_{width-1}``."""
    return T.StructType(
        [
            T.StructField("run_id", T.StringType()),
            T.StructField("search_space_id", T.IntegerType()),
            T.StructField("dataset_id", T.IntegerType()),
            T.StructField("val_accuracy", T.DoubleType()),
            *[T.StructField(f"hp_{j}", T.DoubleType()) for j in range(width)],
        ]
    )


# Split manifest: space -> datasets held out for testing.
MANIFEST = T.MapType(T.StringType(), T.ArrayType(T.StringType()))

# Nested runs: space -> dataset -> X (one configuration per run) and y. An entry
# of y may be a list or a plain number, so it is kept as JSON text.
NESTED_RUNS = T.MapType(
    T.StringType(),
    T.MapType(
        T.StringType(),
        T.StructType(
            [
                T.StructField("X", T.ArrayType(T.ArrayType(T.DoubleType()))),
                T.StructField("y", T.ArrayType(T.StringType())),
            ]
        ),
    ),
)
