"""The registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from runscope.functions import names
from runscope.functions.measures import lr_band, mean, speed_label
from runscope.operators import (
    features as feat,
    filters as flt,
    forests,
    neighbours as near,
    ranking as rank,
    running as run,
    search as srch,
    summaries as summ,
    surrogate as surr,
)
from runscope.session import fresh_path, shuffles_removed, written_table
from runscope.sources import nested, runs as src, storage, tracking
from runscope.streaming import live

Query = Callable[[SparkSession, str], DataFrame]

HP = ["hp_0", "hp_1", "hp_2", "hp_3", "hp_4"]
SETTINGS = ["learning_rate", "batch_size", "dropout", "num_layers", "hidden_units", "weight_decay", "epochs"]
TARGET = 6
TREES = 100
LIVE_TARGET = 200.0
SPACE_TREES = 50

_REGISTRY: dict[str, Query] = {}


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def _on_runs(name: str, op: Callable[[DataFrame], DataFrame]) -> None:
    _REGISTRY[name] = lambda spark, sf: op(src.runs_from_lineitem(spark, sf))


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    return src.runs_from_lineitem(spark, sf)


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet")


def _profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles feed several steps of the recommender, so the runs are scanned once."""
    return written_table(summ.dataset_profiles(_runs(spark, sf), ordered=False), "profiles")


def _vector_columns(matrix: DataFrame) -> DataFrame:
    parts = vector_to_array("features")
    return matrix.select(
        "run_id", "search_space_id", "dataset_id", "val_accuracy", "optimizer",
        *[parts[i].alias(f"f{i}_{c}") for i, c in enumerate(feat.ASSEMBLED)],
    )


# --- sources and sinks ------------------------------------------------------------


@query
def scan_runs(spark, sf):
    return _runs(spark, sf)


@query
def scan_runs_csv(spark, sf):
    runs, path = _runs(spark, sf), fresh_path(spark, "runs-csv")
    src.write_runs_csv(runs, path)
    return src.scan_runs_csv(spark, path, runs.schema)


@query
def write_runs_csv(spark, sf):
    path = fresh_path(spark, "runs-csv")
    src.write_runs_csv(_runs(spark, sf), path)
    return src.scan_runs_csv(spark, path)


@query
def write_runs(spark, sf):
    runs, path = _runs(spark, sf), fresh_path(spark, "runs-by-space")
    src.write_runs(runs, path)
    return src.scan_runs(spark, path).select(*runs.columns)


def _nested_files(spark: SparkSession, sf: str) -> str:
    """All runs as JSON documents of about 64 runs each, by hash of the run id, whatever the data size."""
    runs, path = _runs(spark, sf), fresh_path(spark, "nested-json")
    digits = max(1, math.ceil(math.log(max(1, runs.count()) / 64, 16)))
    dealt = runs.withColumn("document", F.substring(F.md5("run_id"), 1, digits))
    with shuffles_removed(spark):
        nested.nest_runs(dealt, "document", HP, ["run_id"]).select("value").write.text(path)
    return path


@query
def flatten_nested_runs(spark, sf):
    """Every run of the documents with all its values; names are checked by ``nested_run_names``."""
    return nested.flatten_nested_runs(spark, _nested_files(spark, sf)).drop("run_id")


@query
def nested_run_names(spark, sf):
    runs = nested.flatten_nested_runs(spark, _nested_files(spark, sf), len(HP))
    named = runs.groupBy("search_space_id", "dataset_id", "run_id").agg(F.count(F.lit(1)).alias("n"))
    return named.groupBy("search_space_id", "dataset_id").agg(
        F.sum("n").alias("runs"), F.count(F.lit(1)).alias("names")
    )


@query
def explode_split_manifest(spark, sf):
    return nested.explode_manifest(_manifest_documents(spark, sf, 1))


def _manifest_documents(spark: SparkSession, sf: str, every: int = 10) -> DataFrame:
    """Every tenth dataset is held out, or every one; a document lists at most 64 ids of one space."""
    held_out = (
        _runs(spark, sf)
        .where(F.col("dataset_id") % every == 0)
        .select("search_space_id", "dataset_id")
        .distinct()
    )
    lists = held_out.groupBy("search_space_id", F.floor(F.col("dataset_id") / 64).alias("part")).agg(
        F.collect_list(F.col("dataset_id").cast("string")).alias("datasets")
    )
    return lists.select(
        F.to_json(F.create_map(F.col("search_space_id").cast("string"), F.col("datasets"))).alias("value")
    )


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    return written_table(nested.explode_manifest(_manifest_documents(spark, sf)), "manifest")


@query
def split_by_manifest(spark, sf):
    marked = flt.mark_held_out(_runs(spark, sf), _manifest(spark, sf))
    return marked.groupBy("search_space_id", "part").agg(
        mean("val_accuracy", 4).alias("avg_acc"), F.count(F.lit(1)).alias("runs")
    )


@query
def manifest_test_runs(spark, sf):
    return summ.accuracy_by(flt.in_manifest(_runs(spark, sf), _manifest(spark, sf), test=True), "search_space_id")


@query
def manifest_train_runs(spark, sf):
    return summ.accuracy_by(flt.in_manifest(_runs(spark, sf), _manifest(spark, sf), test=False), "search_space_id")


@query
def register_runs(spark, sf):
    src.register_runs(_runs(spark, sf), "real_runs")
    return spark.sql("SELECT search_space_id, COUNT(*) AS runs FROM real_runs GROUP BY search_space_id")


@query
def log_run(spark, sf):
    """Two appends, one of them in two goes of which the second repeats the first; then the log is compacted."""
    spaces, path = summ.space_summary(_runs(spark, sf)), fresh_path(spark, "run-log")
    run_id, name, ts = F.col("search_space_id"), F.lit("space_summary"), F.timestamp_seconds(F.lit(0))
    summary = tracking.long_records(
        spaces, run_id, name,
        params={"search_space": F.col("search_space_id")},
        metrics={"avg_acc": F.col("avg_acc"), "best_acc": F.col("best_acc"), "runs": F.col("runs")},
        ts=ts,
    )
    tracking.log_run(summary.where(F.col("kind") == tracking.METRIC), path)
    tracking.log_run(summary, path)
    tracking.log_run(tracking.long_records(spaces, run_id, name, artifacts={"table": F.lit("space_summary.parquet")}, ts=ts), path)
    compacted = fresh_path(spark, "run-log")
    tracking.compact_log(spark, path, compacted)
    return tracking.read_log(spark, compacted).drop("ts")


def _event_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as the log of runs: every user is a run, every event a metric named after its type."""
    events, path = _events(spark, sf), fresh_path(spark, "run-log")
    run, name = F.col("user_id"), F.concat(F.lit("user "), F.col("user_id"))
    tracking.log_run(tracking.metric_records(events, run, name, F.col("event_type"), F.col("value"), F.col("ts")), path)
    last = events.groupBy("user_id").agg(F.max("ts").alias("ts"), F.count(F.lit(1)).alias("n"))
    state = F.when(F.col("n") % 2 == 0, "FINISHED").otherwise("RUNNING")
    tracking.log_run(tracking.long_records(last, run, name, {"events": F.col("n")}, status=state, ts=F.col("ts")), path)
    return tracking.read_log(spark, path)


@query
def search_runs(spark, sf):
    """All runs of a log with every value logged; metrics as rows, so that no list of names is needed."""
    found = tracking.search_runs(_event_log(spark, sf))
    return found.select(
        "run_id", "run_name", "status", F.date_format("start_time", "yyyy-MM-dd HH:mm:ss").alias("start_time"),
        F.col("params")["events"].alias("events"), F.explode("metrics").alias("key", "value"),
    )


@query
def drop_all_null_rows(spark, sf):
    """Runs that have logged neither of the two metrics go."""
    wide = tracking.metric_columns(tracking.search_runs(_event_log(spark, sf)).select("run_id", "metrics"))
    return flt.drop_all_null_rows(
        flt.drop_empty_columns(wide, names.columns_with_prefix(wide, "metrics.")), ["metrics.click", "metrics.error"]
    ).select("run_id", "`metrics.click`", "`metrics.error`")


_on_runs("profile_table", storage.profile_table)
_on_runs("save_feature_matrix", lambda r: _saved_matrix(r))


def _saved_matrix(runs: DataFrame) -> DataFrame:
    path = fresh_path(runs.sparkSession, "features")
    feat.save_feature_matrix(feat.feature_matrix(runs), path)
    return _vector_columns(src.scan_runs(runs.sparkSession, path))


# --- projections and filters ------------------------------------------------------

_on_runs("project_runs", lambda r: flt.project_runs(r, {"run": "run_id", "space": "search_space_id", "accuracy": "val_accuracy"}))
_on_runs("filter_space", lambda r: flt.filter_space(r, TARGET).select("run_id", "dataset_id", "val_accuracy"))
_on_runs("filter_top_accuracy", lambda r: flt.filter_top_accuracy(r).select("run_id", "search_space_id", "val_accuracy"))
_on_runs("exclude_target_space", lambda r: flt.exclude_target_space(r, TARGET).select("run_id", "search_space_id"))
_on_runs("lr_bands", lambda r: r.select("run_id", "learning_rate", lr_band("learning_rate").alias("lr_range")))
_on_runs("fill_missing_hp", lambda r: flt.fill_missing_hp(r, HP).select("run_id", *HP))
_on_runs("select_hp_columns", lambda r: r.select("run_id", *names.columns_with_prefix(r)))
_on_runs("hp_variation", lambda r: flt.hp_variation(r, HP, ["search_space_id"]))
_on_runs("drop_constant_hp", lambda r: flt.blank_constant_hp(r, HP, ["search_space_id"]).select("run_id", *HP))
_on_runs("accuracy_gain", summ.accuracy_gain)


@query
def metric_names(spark, sf):
    label = F.concat(F.lit("Best Value "), F.initcap("event_type"))
    labels = _events(spark, sf).select(label.alias("label")).distinct()
    key = names.metric_key(F.col("label"))
    return labels.select(
        "label", key.alias("metric_key"), names.metric_title(F.concat(F.lit("metrics."), key)).alias("title")
    )


def _with_gaps(runs: DataFrame) -> DataFrame:
    """The same runs with accuracies missing in every space: NULL for some, NaN for others."""
    line = F.split_part("run_id", F.lit("_"), F.lit(3))
    return runs.withColumn(
        "val_accuracy",
        F.when(line == "3", F.lit(None)).when(line == "5", F.lit(float("nan"))).otherwise(F.col("val_accuracy").cast("double")),
    )


_on_runs(
    "top_runs_with_gaps",
    lambda r: rank.top_runs_per_space(_with_gaps(r)).select("search_space_id", "rank", "run_id", "val_accuracy"),
)
_on_runs("space_summary_with_gaps", lambda r: summ.space_summary(_with_gaps(r)))


# --- summaries ----------------------------------------------------------------------

for _op in (
    summ.dataset_profiles, summ.top_config_profile, summ.space_optimizer_summary, summ.space_summary,
    summ.space_by_accuracy, summ.batch_size_summary, summ.optimizer_summary, summ.dataset_distribution,
    summ.lr_band_summary, summ.runs_per_space, summ.global_accuracy, summ.distinct_counts, summ.list_spaces,
    summ.largest_spaces,
):
    _on_runs(_op.__name__, _op)

_on_runs("space_accuracy", lambda r: summ.global_accuracy(flt.filter_space(r, TARGET)))
_on_runs("accuracy_heatmap", lambda r: summ.accuracy_heatmap(r, TARGET, "hp_0", "hp_3"))
_on_runs("datasets_per_space", lambda r: summ.datasets_per_space(summ.dataset_profiles(r, ordered=False), [2, 4, 6]))


@query
def run_status_counts(spark, sf):
    return summ.status_counts(spark.read.parquet(f"{sf}/orders.parquet"), "o_orderstatus", "F")


# --- running values and rankings ------------------------------------------------------


@query
def best_so_far(spark, sf):
    trials = _events(spark, sf).select("event_type", "ts", "event_id", "value")
    curve = run.best_so_far(trials, ["event_type"], ["ts", "event_id"], "value")
    return curve.select("event_type", "event_id", "trial", "value", "best")


def _to_target(spark: SparkSession, sf: str, base: int) -> DataFrame:
    return run.trials_to_target(
        _events(spark, sf), ["event_type"], ["ts", "event_id"], "value", target=200.0, base=base
    )


@query
def trials_to_target(spark, sf):
    return _to_target(spark, sf, 0)


@query
def trials_to_target_from_one(spark, sf):
    return _to_target(spark, sf, 1)


@query
def speed_ratio(spark, sf):
    trials = written_table(_to_target(spark, sf, 1), "trials-to-target")
    base = trials.where(F.col("event_type") == "view").select(F.col("trials_to_target")).scalar()
    return trials.select(
        "event_type", "trials_to_target", speed_label(base, F.col("trials_to_target")).alias("speed")
    )


@query
def trials_to_target_with_gaps(spark, sf):
    """Every third value is NaN: neither a hit nor a best value."""
    gaps = _events(spark, sf).withColumn(
        "value", F.when(F.col("event_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    )
    return run.trials_to_target(gaps, ["event_type"], ["ts", "event_id"], "value", target=200.0)


@query
def daily_growth(spark, sf):
    return run.daily_growth(_events(spark, sf), "ts").withColumn("day", F.col("day").cast("string"))


@query
def cumulative_importance(spark, sf):
    """Share of each hyperparameter in the absolute correlations with accuracy."""
    runs = flt.fill_missing_hp(_runs(spark, sf), HP)
    strengths = runs.agg(*[F.round(F.abs(F.corr(c, "val_accuracy")), 6).alias(c) for c in HP])
    total = sum((F.col(c) for c in HP[1:]), F.col(HP[0]))
    rows = F.array(*[F.struct(F.lit(c).alias("hp"), (F.col(c) / total).alias("importance")) for c in HP])
    table = run.cumulative_importance(strengths.select(F.inline(rows)))
    return table.select(
        "hp", F.round("importance", 6).alias("importance"), F.round("cumulative", 6).alias("cumulative"), "within_line"
    )


_on_runs(
    "top_runs_per_space",
    lambda r: rank.top_runs_per_space(r).select("search_space_id", "rank", "run_id", "val_accuracy"),
)
_on_runs(
    "warm_start_pool",
    lambda r: rank.warm_start_pool(r, TARGET).select("search_space_id", "rank", "run_id", "val_accuracy", *SETTINGS, "optimizer"),
)


# --- neighbours and recommendations -----------------------------------------------------


@query
def cosine_pairs(spark, sf):
    return near.cosine_pairs(_profiles(spark, sf), [0, 10, 50])


@query
def nearest_profiles(spark, sf):
    found = near.nearest_profiles(_profiles(spark, sf), 3)
    return found.withColumn("similarity", F.round("similarity", 6))


@query
def nearest_other_datasets(spark, sf):
    found = near.nearest_profiles(_profiles(spark, sf), 3, exclude_same_dataset=True)
    return found.withColumn("similarity", F.round("similarity", 6))


@query
def neighbour_configs(spark, sf):
    runs = _runs(spark, sf)
    # A stricter threshold than the default leaves some spaces without a configuration.
    configs = summ.top_config_profile(runs, 0.98)
    found = near.neighbour_configs(near.nearest_profiles(_profiles(spark, sf), 3), configs)
    return found.drop("similarity")


@query
def recommend_configs(spark, sf):
    return near.recommend_configs(_profiles(spark, sf), summ.top_config_profile(_runs(spark, sf)), 3)


def _hit_rate(spark: SparkSession, sf: str, tolerance: float) -> DataFrame:
    profiles = _profiles(spark, sf)
    asked = near.profiles_in_order(profiles, 100)
    found = near.recommend_configs(profiles, summ.top_config_profile(_runs(spark, sf)), 3, asked)
    return near.hit_rate(found, profiles, 100, tolerance)


@query
def hit_rate(spark, sf):
    return _hit_rate(spark, sf, 0.95)


@query
def hit_rate_strict(spark, sf):
    return _hit_rate(spark, sf, 0.99)


@query
def similarity_matrix(spark, sf):
    return near.similarity_matrix(_profiles(spark, sf))


# --- features and models --------------------------------------------------------------

_on_runs(
    "encode_alphabetical",
    lambda r: feat.encode_alphabetical(
        feat.encode_alphabetical(r, "optimizer", "optimizer_enc"), "search_space_id", "space_enc"
    ).select("run_id", "optimizer", "optimizer_enc", "search_space_id", "space_enc"),
)
_on_runs("encode_by_frequency", lambda r: _encoded_by_frequency(r))
_on_runs("decode_labels", lambda r: _decoded(r))
_on_runs("feature_matrix", lambda r: _vector_columns(feat.feature_matrix(r)))


def _encoded_by_frequency(runs: DataFrame) -> DataFrame:
    coded = runs
    for column, output in feat.INDEXED.items():
        # Labels come from the plain runs, not from the runs joined so far.
        coded = feat.encode(coded, column, feat.frequency_labels(runs, column), output)
    return coded.select("run_id", *feat.INDEXED, *feat.INDEXED.values())


def _decoded(runs: DataFrame) -> DataFrame:
    labels = feat.alphabetical_labels(runs, "optimizer")
    coded = feat.encode(runs, "optimizer", labels, "code").select("run_id", "code")
    return feat.decode_labels(coded, "code", labels, "optimizer")


@query
def split_runs(spark, sf):
    return feat.with_part(_runs(spark, sf)).select("run_id", "search_space_id", "part")


@query
def surrogate_r2(spark, sf):
    train, test = feat.split_runs(_runs(spark, sf))
    return surr.r_squared(surr.predict_by_mean(train, test, ["epochs"]), "val_accuracy", "prediction")


@query
def surrogate_quality(spark, sf):
    return surr.surrogate_quality(_runs(spark, sf), HP, trees=TREES)


@query
def fit_surrogate(spark, sf):
    """The surrogate of the training settings, judged on the rows it was trained on."""
    labels_in = {"optimizer": "optimizer_enc", "search_space_id": "space_enc"}
    plain = runs = _runs(spark, sf)
    for column, output in labels_in.items():
        runs = feat.encode(runs, column, written_table(feat.alphabetical_labels(plain, column), "labels"), output)
    inputs = [*SETTINGS, *labels_in.values()]
    model = surr.fit_surrogate(runs, inputs, trees=TREES)
    return surr.predict(model, runs.select("run_id", "val_accuracy", *inputs)).select("run_id", "val_accuracy", "prediction")


@query
def hp_importance(spark, sf):
    return surr.space_importance(_runs(spark, sf), HP, trees=TREES)


@query
def space_surrogates(spark, sf):
    runs = _runs(spark, sf)
    return surr.space_surrogate_quality(runs, surr.space_surrogates(runs, HP, trees=SPACE_TREES))


@query
def space_surrogate_bounds(spark, sf):
    """Whether the forest of every space explains nearly all of a noiseless accuracy."""
    found = space_surrogates(spark, sf)
    return found.select("search_space_id", "rows", (F.col("r2") >= 0.99).alias("r2_from_099"))


@query
def space_hp_importance(spark, sf):
    return surr.hp_importance(surr.space_surrogates(_runs(spark, sf), HP, trees=SPACE_TREES))


@query
def space_top_hp(spark, sf):
    """The two most important columns of every space."""
    found = space_hp_importance(spark, sf)
    rank = F.row_number().over(Window.partitionBy("search_space_id").orderBy(F.desc("importance"), "hp"))
    return found.select("search_space_id", "hp", rank.cast("long").alias("rank")).where("rank <= 2")


@query
def space_first_splits(spark, sf):
    """The best single split of every space, over all its runs."""
    model = forests.fit_forests(_runs(spark, sf), HP, by=["search_space_id"], trees=1, depth=1, sample=False)
    hp = F.get(F.array(*[F.lit(c) for c in HP]), F.col("feature"))
    found = forests.with_groups(model, forests.root_splits(model))
    return found.select("search_space_id", hp.alias("hp"), F.round("threshold", 6).alias("threshold"), F.round("gain", 4).alias("gain"))


@query
def profile_pca(spark, sf):
    return surr.profile_pca(_profiles(spark, sf))


# --- search ---------------------------------------------------------------------------------


@query
def random_candidates(spark, sf):
    return srch.random_candidates(summ.list_spaces(_runs(spark, sf)), HP)


@query
def random_settings(spark, sf):
    return srch.random_settings(summ.list_spaces(_runs(spark, sf)))


@query
def score_candidates(spark, sf):
    runs = _runs(spark, sf)
    model = surr.fit_surrogate(runs, HP, trees=TREES)
    return srch.score_candidates(model, srch.random_candidates(summ.list_spaces(runs), HP), 10)


@query
def score_settings(spark, sf):
    """Candidates of the training settings, scored by a surrogate of the same settings and encoded labels."""
    runs = _runs(spark, sf)
    spaces = written_table(summ.list_spaces(runs), "spaces")
    candidates = srch.random_settings(spaces)
    coded = runs
    for column, output in {"optimizer": "optimizer_enc", "search_space_id": "space_enc"}.items():
        labels = written_table(feat.alphabetical_labels(runs, column), "labels")
        coded = feat.encode(coded, column, labels, output)
        candidates = feat.encode(candidates, column, labels, output)
    inputs = [*SETTINGS, "optimizer_enc", "space_enc"]
    model = surr.fit_surrogate(coded, inputs, trees=SPACE_TREES)
    known = F.col("optimizer_enc").isNotNull() & F.col("space_enc").isNotNull()
    return srch.score_candidates(model, candidates, 10, known)


def _halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """History and held-out runs, from one scan into a narrow table."""
    narrow = _runs(spark, sf).select("search_space_id", "run_id", "val_accuracy", *HP)
    return feat.split_runs(written_table(narrow, "narrow-runs"), first_hex="8")


@query
def density_ratio_rank(spark, sf):
    history, rest = _halves(spark, sf)
    ranked = srch.density_ratio_rank(history, rest, HP)
    return ranked.select("search_space_id", "rank", "run_id", F.col("density").cast("double").alias("density"))


@query
def elite_profile(spark, sf):
    return srch.elite_profile(_runs(spark, sf), HP)


@query
def elite_rank(spark, sf):
    history, rest = _halves(spark, sf)
    ranked = srch.elite_rank(history, rest, HP)
    return ranked.select("search_space_id", "rank", "run_id", F.col("distance").cast("double").alias("distance"))


@query
def elite_draws(spark, sf):
    profile = written_table(srch.elite_profile(_runs(spark, sf), HP, digits=srch.DIGITS), "elite-profile")
    return srch.elite_draws(profile, HP)


@query
def replay_generations(spark, sf):
    return srch.replay_generations(_runs(spark, sf), HP)


@query
def regret_curves(spark, sf):
    return srch.regret_curves(srch.replay_trials(*_halves(spark, sf), HP))


@query
def compare_methods(spark, sf):
    return srch.compare_methods(srch.replay_trials(*_halves(spark, sf), HP))


@query
def transfer_gain(spark, sf):
    return srch.transfer_gain(_runs(spark, sf), HP, TARGET)


# --- streaming ----------------------------------------------------------------------------------


@query
def live_best(spark, sf):
    """Every trial of the stream with the running best of its method."""
    found = live.best_of(spark, f"{sf}/events*.parquet", _events(spark, sf).schema, "event_type", "ts", "event_id", "value", LIVE_TARGET)
    return found.select("event_type", "event_id", "trial", "best")


@query
def live_target(spark, sf):
    found = live.best_of(spark, f"{sf}/events*.parquet", _events(spark, sf).schema, "event_type", "ts", "event_id", "value", LIVE_TARGET)
    return live.reached_target(found, "event_type")


@query
def live_progress(spark, sf):
    schema = _events(spark, sf).schema
    progress = live.progress_of(spark, f"{sf}/events*.parquet", schema, "event_type", "ts", "value")
    return progress.select(
        live.as_utc_wall_time("window_start").cast("string").alias("window_start"), "event_type", "trials", "best"
    )
