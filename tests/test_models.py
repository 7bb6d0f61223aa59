import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from runscope.operators import features as feat, search as srch, summaries as summ, surrogate as surr
from runscope.plans.queries import HP
from runscope.session import written_table

LETTERS = [("b",), ("a",), ("c",), ("a",), ("c",), ("a",), (None,)]


@pytest.fixture(scope="module")
def letters(spark):
    return spark.createDataFrame(LETTERS, "x string")


def test_alphabetical_labels(letters):
    assert {r["label"]: r["index"] for r in feat.alphabetical_labels(letters, "x").collect()} == {"a": 0, "b": 1, "c": 2}


def test_frequency_labels_break_ties_by_name(spark):
    df = spark.createDataFrame([("z",), ("z",), ("y",), ("y",), ("x",)], "x string")
    assert {r["label"]: r["index"] for r in feat.frequency_labels(df, "x").collect()} == {"y": 0, "z": 1, "x": 2}


def test_unknown_labels_keep_their_row(spark, letters):
    labels = feat.alphabetical_labels(letters.where("x <> 'c'"), "x")
    coded = feat.encode(letters, "x", labels, "code")
    assert coded.count() == 7 and coded.where("code is null").count() == 3
    decoded = feat.decode_labels(coded, "code", labels, "back").where("code is not null")
    assert decoded.where("x <> back").count() == 0


def test_feature_matrix_indexes_like_the_frequency_labels(runs):
    matrix = feat.feature_matrix(runs)
    assert matrix.columns == feat.MATRIX_COLUMNS
    own = {r["label"]: float(r["index"]) for r in feat.frequency_labels(runs, "optimizer").collect()}
    found = matrix.select("optimizer", vector_to_array("features").alias("v")).distinct().limit(200).collect()
    assert all(len(r["v"]) == 10 and r["v"][7] == own[r["optimizer"]] for r in found)


def test_split_is_stable_and_complete(runs):
    train, test = feat.split_runs(runs)
    share = train.count() / runs.count()
    assert 0.77 < share < 0.83 and train.count() + test.count() == runs.count()
    again, _ = feat.split_runs(runs.repartition(7))
    assert train.select("run_id").exceptAll(again.select("run_id")).count() == 0
    parts = feat.with_part(runs)
    assert parts.where("part = 'train'").count() == train.count()


def test_r_squared(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 2.0, 2.0), ("b", 1.0, 1.5), ("b", 2.0, 1.5), ("c", 1.0, 1.0)], "k string, y double, p double")
    assert {r["k"]: r["r2"] for r in surr.r_squared(df, "y", "p", ["k"]).collect()} == {"a": 1.0, "b": 0.0, "c": None}


def test_surrogate_finds_the_columns_that_matter(runs):
    table = surr.space_importance(runs, HP, trees=10)
    weights = {r["hp"]: r["importance"] for r in table.collect()}
    assert math.isclose(sum(weights.values()), 1.0, abs_tol=1e-9)
    assert min(weights["hp_0"], weights["hp_1"]) > max(weights["hp_3"], weights["hp_4"])
    assert [r["importance"] for r in table.collect()] == sorted(weights.values(), reverse=True)


def test_surrogates_do_not_depend_on_the_layout(runs):
    one = surr.space_importance(runs.repartition(1), HP, trees=10).collect()
    other = surr.space_importance(runs.repartition(9, "epochs"), HP, trees=10).collect()
    assert [r["hp"] for r in one] == [r["hp"] for r in other]
    assert [r["importance"] for r in one] == pytest.approx([r["importance"] for r in other], abs=1e-9)


def test_new_groups_get_the_overall_mean(spark):
    train = spark.createDataFrame([(1, 0.2), (1, 0.4), (2, 0.9)], "g int, val_accuracy double")
    test = spark.createDataFrame([(1, 0.0), (7, 0.0), (None, 0.0)], "g int, val_accuracy double")
    found = {r["g"]: r["prediction"] for r in surr.predict_by_mean(train, test, ["g"]).collect()}
    assert found == {1: 0.3, 7: 0.5, None: 0.5}


def test_feature_matrix_keeps_runs_without_a_label(runs):
    gaps = runs.withColumn("optimizer", F.when(F.col("dataset_id") % 7 != 0, F.col("optimizer")))
    assert feat.feature_matrix(gaps).count() == runs.count()


def test_surrogate_quality_is_named_by_part(runs):
    r2 = {r["part"]: r["r2"] for r in surr.surrogate_quality(runs, HP, trees=10).collect()}
    assert set(r2) == {"train", "test"} and 0.6 < r2["test"] <= 1 and 0.6 < r2["train"] <= 1


def test_one_surrogate_per_space(spark, runs):
    rows = written_table(runs.where("search_space_id in (1, 2)").select("search_space_id", "val_accuracy", *HP), "two-spaces")
    model = surr.space_surrogates(rows, HP, trees=3, depth=3)
    found = surr.space_surrogate_quality(rows, model).collect()
    assert sorted(r["search_space_id"] for r in found) == [1, 2] and sum(r["rows"] for r in found) == rows.count()


def test_pca_is_centred_and_ordered(spark, runs):
    profiles = summ.dataset_profiles(runs)
    stats = surr.profile_pca(profiles).agg(
        F.avg("pca_1"), F.avg("pca_2"), F.var_pop("pca_1"), F.var_pop("pca_2"), F.covar_pop("pca_1", "pca_2")
    ).first()
    assert abs(stats[0]) < 1e-9 and abs(stats[1]) < 1e-9 and stats[2] >= stats[3] and abs(stats[4]) < 1e-9


def test_candidates_cover_the_unit_cube(spark):
    spaces = spark.createDataFrame([(1,), (2,)], "search_space_id int")
    found = srch.random_candidates(spaces, HP, 500)
    assert found.count() == 1000
    low, high = found.agg(F.min(F.least(*HP)), F.max(F.greatest(*HP))).first()
    assert 0 <= low < 0.01 and 0.99 < high < 1


def test_unknown_labels_score_zero(spark, runs):
    model = surr.fit_surrogate(runs, HP, trees=3, depth=3)
    candidates = srch.random_candidates(spark.createDataFrame([(1,), (99,)], "search_space_id int"), HP, 20)
    scored = srch.score_candidates(model, candidates, 40, known=F.col("search_space_id") == 1)
    assert {r["search_space_id"]: r["m"] for r in scored.groupBy("search_space_id").agg(F.max("score").alias("m")).collect()}[99] == 0.0
    assert scored.where("search_space_id = 1").agg(F.min("score")).first()[0] > 0.4


def test_accuracy_cut_keeps_ties(spark):
    df = spark.createDataFrame([(1, v / 10) for v in (9, 9, 9, 8, 7, 6, 5, 4, 3, 2)] + [(2, 0.5)], "search_space_id int, val_accuracy double")
    good = srch.mark_good(df, 20).where("_good").groupBy("search_space_id").count().collect()
    assert {tuple(r) for r in good} == {(1, 3), (2, 1)}


def test_density_prefers_where_the_good_runs_are(spark):
    rows = [(1, f"g{i}", 0.9, 0.95) for i in range(20)] + [(1, f"b{i}", 0.5, 0.05) for i in range(80)]
    history = spark.createDataFrame(rows, "search_space_id int, run_id string, val_accuracy double, hp_0 double")
    candidates = spark.createDataFrame([(1, "near", 0.0, 0.91), (1, "far", 0.0, 0.01), (1, "new", 0.0, 0.5), (7, "other", 0.0, 0.5)], history.schema)
    ranked = {r["run_id"]: (r["rank"], float(r["density"])) for r in srch.density_ratio_rank(history, candidates, ["hp_0"], good=20).collect()}
    assert ranked["near"][0] == 1 and ranked["new"][0] == 2 and ranked["far"][0] == 3
    want = math.log(21 / 30) - math.log(1 / 90)
    assert ranked["near"][1] == pytest.approx(want, abs=1e-6)
    assert ranked["other"] == (1, 0.0)


def test_replay_uses_held_out_runs_only(runs):
    history, rest = feat.split_runs(runs, first_hex="8")
    trials = written_table(srch.replay_trials(history, rest, HP, n_trials=20), "replay-test")
    assert trials.join(history.select("run_id"), "run_id", "left_semi").count() == 0
    per_method = trials.groupBy("search_space_id", "method").agg(F.count("*").alias("n"), F.max("trial").alias("last"))
    assert {(r["n"], r["last"]) for r in per_method.collect()} == {(20, 19)}
    curve = srch.regret_curves(trials)
    assert curve.where("best < value").count() == 0
    table = srch.compare_methods(trials).collect()
    assert all(r["gain_pct"] == 0.0 and r["speed"] == "1.0x" for r in table if r["method"] == "random")
    assert all(r["speed"] for r in table)


def test_transfer_gain_with_a_pool_that_hits(spark):
    rows = [(1, "s", 0.99, 0.8)] + [(2, f"t{i}", 0.9 if i == 37 else 0.5, 0.8 if i == 37 else i / 100) for i in range(60)]
    runs = spark.createDataFrame(rows, "search_space_id int, run_id string, val_accuracy double, hp_0 double")
    for c, t in (("learning_rate", "double"), ("weight_decay", "double"), ("epochs", "int"), ("dropout", "double")):
        runs = runs.withColumn(c, F.lit(0).cast(t))
    row = srch.transfer_gain(runs, ["hp_0"], target=2, n_trials=1).first()
    assert row["warm_best"] == 0.9 and row["n_trials"] == 1


def test_elite_distance_is_the_mahalanobis_distance(spark):
    rng = np.random.default_rng(4)
    wide = rng.uniform(size=(60, 1))
    best = np.clip(np.hstack([wide, wide * 0.7 + rng.normal(size=(60, 1)) * 0.05, np.full((60, 1), 0.25)]), 0, 1)
    rest = rng.uniform(size=(200, 3))
    rows = [(1, f"b{i}", 0.9, *map(float, x)) for i, x in enumerate(best)] + [(1, f"r{i}", 0.1, *map(float, x)) for i, x in enumerate(rest)]
    rows.append((2, "single", 0.5, 0.5, 0.5, 0.5))
    hp = HP[:3]
    history = spark.createDataFrame(rows, "search_space_id int, run_id string, val_accuracy double, " + ", ".join(f"{c} double" for c in hp))
    profile = srch.elite_profile(history, hp, percent=20, digits=12)
    found = {r["run_id"]: float(r["distance"]) for r in srch.elite_distance(history, profile, hp).collect()}
    # One column of the best runs doesn't vary: the ridge keeps the matrix regular.
    inverse = np.linalg.inv(np.cov(best.T) + srch.RIDGE * np.eye(3))
    gaps = np.vstack([best, rest]) - best.mean(axis=0)
    want = np.einsum("ij,jk,ik->i", gaps, inverse, gaps)
    assert np.allclose([found[r[1]] for r in rows[:-1]], want, rtol=1e-5, atol=1e-3) and found["single"] == 0.0
    plain = (gaps**2).sum(axis=1)
    assert list(np.argsort(want)) != list(np.argsort(plain))


def test_draws_have_the_means_and_covariances_of_the_best(spark):
    rows = [(1, 500, 0.5, 0.4, 0.1, 0.1, 0.008)]
    profile = spark.createDataFrame(rows, "search_space_id int, n_elite int, mean_hp_0 double, mean_hp_1 double, std_hp_0 double, std_hp_1 double, cov_hp_0_hp_1 double")
    drawn = np.array([tuple(r)[2:] for r in srch.elite_draws(profile, HP[:2], 4_000).collect()])
    assert np.allclose(drawn.mean(axis=0), [0.5, 0.4], atol=0.01)
    assert np.allclose(np.cov(drawn.T), [[0.0101, 0.008], [0.008, 0.0101]], atol=0.001)


def test_a_generation_scores_the_pool_once(runs, monkeypatch):
    written, keep = [], srch.written_table
    monkeypatch.setattr(srch, "written_table", lambda df, label: written.append((label, df.columns)) or keep(df, label))
    assert srch.replay_generations(runs, HP, generations=2, size=5).count() > 0
    scored = [c for label, c in written if {"density", "distance"} & set(c)]
    assert len(scored) == 1 and "_digest" not in scored[0]


def test_generations_learn_from_their_own_trials(runs):
    found = srch.replay_generations(runs, HP, generations=3, size=20).collect()
    by_method = {}
    for r in found:
        by_method.setdefault((r["search_space_id"], r["method"]), []).append(r)
    for (space, method), trials in by_method.items():
        trials.sort(key=lambda r: r["trial"])
        assert [r["trial"] for r in trials] == list(range(60)) and [r["generation"] for r in trials] == [t // 20 for t in range(60)]
        assert len({r["run_id"] for r in trials}) == 60
        assert [r["run_id"] for r in trials[:20]] == [r["run_id"] for r in by_method[space, "random"][:20]]
    mean = lambda m, g: np.mean([r["value"] for r in found if r["method"] == m and r["generation"] == g])
    assert mean("elite", 2) > mean("random", 2) + 0.03 and mean("density_ratio", 2) > mean("random", 2) + 0.03
