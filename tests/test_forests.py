"""Forests against a plain tree, and the two ways to grow and to predict against each other."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from runscope.functions import trees as tr
from runscope.operators import forests as fo, surrogate as surr
from runscope.plans.queries import HP
from runscope.session import written_table

COLUMNS = ["a", "b", "c"]


def plain_tree(x, y, w, depth):
    """One node after another: the mean, or (feature, threshold, left, right)."""
    mean = (w * y).sum() / w.sum()
    if depth == 0 or np.ptp(y) < 1e-12:
        return mean
    best, cut = 1e-12 * (w * (y - mean) ** 2).sum(), None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for t in (values[:-1] + values[1:]) / 2:
            left = x[:, f] <= t
            gain = sum((w[s] * y[s]).sum() ** 2 / w[s].sum() for s in (left, ~left)) - (w * y).sum() ** 2 / w.sum()
            if gain > best + 1e-12:
                best, cut = gain, (f, t)
    if cut is None:
        return mean
    left, below = x[:, cut[0]] <= cut[1], None if depth is None else depth - 1
    return *cut, *(plain_tree(x[s], y[s], w[s], below) for s in (left, ~left))


def plain_value(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


@pytest.mark.parametrize("depth", [None, 1, 3])
@pytest.mark.parametrize("dense", [0, 4, 10**6])
def test_levels_at_once_equal_the_plain_tree(monkeypatch, depth, dense):
    monkeypatch.setattr(tr, "_DENSE", dense)
    rng = np.random.default_rng(7)
    for _ in range(25):
        n = int(rng.integers(1, 60))
        x, y = rng.integers(0, rng.integers(2, 30), (n, 3)).astype(float), rng.normal(size=n) + 100
        w = rng.integers(0, 4, n).astype(float)
        w[0] = 1
        grown, plain, kept = tr.grow(x[w > 0], y[w > 0], w[w > 0], depth), plain_tree(x[w > 0], y[w > 0], w[w > 0], depth), w > 0
        assert np.allclose(tr.predict(grown, x)[kept], [plain_value(plain, r) for r in x[kept]], atol=1e-9)


def test_samples_follow_the_poisson_law_and_the_row():
    keys = np.arange(200_000)
    w = tr.sample_weights(keys, 3, 42)
    assert np.array_equal(w[::7], tr.sample_weights(keys[::7], 3, 42)) and not np.array_equal(w, tr.sample_weights(keys, 4, 42))
    for k, p in enumerate([0.3679, 0.3679, 0.1839, 0.0613]):
        assert abs((w == k).mean() - p) < 0.005


def test_many_values_become_quantiles():
    x = np.random.default_rng(1).normal(size=(5_000, 1))
    cuts = tr.cuts_of(x[:, 0])
    counts = np.bincount(tr.binned(x, [cuts])[0])
    assert len(cuts) < tr.BINS and counts.max() < 3 * 5_000 / tr.BINS


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    rows = []
    for g, n in (("hot", 1_500), ("x y", 300), (None, 40), ("one", 1)):
        for k in range(n):
            a, b, c = (float(v) for v in rng.integers(0, 12, 3))
            rows.append((g, k, a, b if k % 9 else None, c, a * a + 3 * (b if k % 9 else 0.0) + float(rng.normal()) * 0.1))
    rows.append(("hot", -1, 1.0, 1.0, 1.0, None))
    return spark.createDataFrame(rows, "g string, k int, a double, b double, c double, y double")


def quality(table, model):
    found = fo.predict_forests(model, table).where("y is not null")
    return {r["g"]: (r["rows"], r["r2"]) for r in surr.r_squared(found, "y", "prediction", ["g"]).collect()}


def test_every_group_has_its_forest(table):
    model = fo.fit_forests(table, COLUMNS, "y", by=["g"], trees=12)
    found = quality(table, model)
    assert {g: n for g, (n, _) in found.items()} == {"hot": 1_500, "x y": 300, None: 40, "one": 1}
    assert found["hot"][1] > 0.99 and found["x y"][1] > 0.98 and found["one"][1] is None
    weights = {(r["g"], r["hp"]): r["importance"] for r in fo.forest_importance(model).collect()}
    assert len(weights) == 12 and weights["hot", "a"] > weights["hot", "b"] > weights["hot", "c"]
    assert sum(weights["hot", c] for c in COLUMNS) == pytest.approx(1) and sum(weights["one", c] for c in COLUMNS) == 0


@pytest.mark.parametrize("depth", [None, 4])
def test_large_groups_grow_from_the_top_alike(table, depth):
    whole = fo.fit_forests(table, COLUMNS, "y", by=["g"], trees=6, depth=depth)
    split = fo.fit_forests(table, COLUMNS, "y", by=["g"], trees=6, depth=depth, local_values=300, block_values=600)
    assert whole.top.isEmpty() and split.top.where("kind = 'split'").count() > 20
    assert split.subtrees.groupBy("grp", "tree").count().agg(F.max("count")).first()[0] >= (9 if depth is None else 4)
    one, other = (
        {(r["g"], r["k"]): r["prediction"] for r in fo.predict_forests(m, table, block_values=200).collect()} for m in (whole, split)
    )
    # The splits part the sampled rows alike; between two values of a node a threshold may stand elsewhere.
    gaps = np.array([abs(one[k] - other[k]) for k in one])
    assert one.keys() == other.keys() and np.median(gaps) < 0.01 and gaps.mean() < 0.02 * np.std(list(one.values()))
    a, b = quality(table, whole), quality(table, split)
    assert all(a[g][0] == b[g][0] and abs((a[g][1] or 0) - (b[g][1] or 0)) < 0.01 for g in a)


def test_depth_is_a_limit(table):
    found = [quality(table, fo.fit_forests(table, COLUMNS, "y", by=["g"], trees=8, depth=d))["hot"][1] for d in (1, 3, 8, None)]
    assert found == sorted(found) and found[0] < 0.9 < found[2]
    model = fo.fit_forests(table, COLUMNS, "y", by=["g"], trees=2, depth=2, local_values=300)
    assert model.subtrees.where(F.size("feature") > 7).count() == 0 and model.top.agg(F.max("node")).first()[0] < 8
    with pytest.raises(ValueError):
        fo.fit_forests(table, COLUMNS, "y", depth=0)


def test_forests_do_not_depend_on_the_layout(table):
    one, other = (
        {(r["g"], r["k"]): r["prediction"] for r in fo.predict_forests(fo.fit_forests(t, COLUMNS, "y", by=["g"], trees=3), table).collect()}
        for t in (table.repartition(1), table.repartition(7, "k"))
    )
    assert one == other


def test_tables_without_rows_and_unknown_groups(spark, table):
    none = fo.fit_forests(table.where("g = 'nobody'"), COLUMNS, "y", by=["g"], trees=2)
    assert fo.predict_forests(none, table).where("prediction is not null").isEmpty()
    some = fo.fit_forests(table.where("g = 'hot'"), COLUMNS, "y", by=["g"], trees=2)
    found = fo.predict_forests(some, table)
    assert found.columns == [*table.columns, "prediction"] and found.count() == table.count()
    assert found.where("g = 'hot' and prediction is null or g <> 'hot' and prediction is not null").isEmpty()


def test_deep_surrogates_are_better(runs):
    found = [
        {r["part"]: r["r2"] for r in surr.surrogate_quality(runs, HP, trees=10, depth=d).collect()} for d in (5, None)
    ]
    assert found[1]["test"] > found[0]["test"] and found[1]["test"] > 0.99


def test_trees_are_finished_some_at_a_time(table):
    """However many trees: copies of the rows for a bounded number of them are on their way at once."""
    assert fo._at_once(36_000_000, 5, 100, fo.WAVE_VALUES) == 11 and fo._at_once(10**12, 5, 100, fo.WAVE_VALUES, 10) == 10
    once, waves = (
        fo.fit_forests(table, COLUMNS, "y", by=["g"], trees=6, local_values=300, block_values=600, together=2, wave_values=w)
        for w in (fo.WAVE_VALUES, 1)
    )
    of = lambda m: {(r["grp"], r["tree"], r["node"]): tuple(r["threshold"]) for r in m.subtrees.collect()}
    assert of(once) == of(waves) and {t for _, t, _ in of(waves)} == set(range(6))
    by_row = lambda p: {(r["g"], r["k"]): r["prediction"] for r in p.collect()}
    walked = by_row(fo.predict_forests(waves, table, block_values=300))
    routed = by_row(fo.predict_forests(waves, table, block_values=300, walk_nodes=0, wave_values=1))
    assert walked == pytest.approx(routed)


def test_written_tables_restore_the_cleanup_setting(spark, table):
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    written = written_table(table.repartition(3, "k"), "test")
    assert written.count() == table.count()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before


@pytest.mark.parametrize("values", [np.arange(5.0), np.zeros(0), np.array([[1, 2], [3, 4]], dtype=np.int64), np.array([np.nan, -0.0])])
def test_packed_columns_come_back(values):
    back = fo._unpack(fo._pack(values), values.dtype.type)
    assert np.array_equal(back, values.ravel(), equal_nan=values.dtype.kind == "f")


def test_columns_of_few_values_and_ordered_hashes_take_less_room():
    """F3-F7: blocks, their pieces and the rows on their way to nodes hold codes, and come back bit by bit."""
    rng = np.random.default_rng(11)
    x, row = np.stack([rng.integers(0, k, 20_000) / 7 for k in (50, 11, 9, 101, 2_000)]), np.sort(rng.integers(-(2**63), 2**63 - 1, 20_000))
    x[1, ::50] = -0.0
    plain = lambda v: len(fo.pa.compress(v.tobytes(), codec="zstd", asbytes=True))
    assert len(fo._pack(x)) < 0.7 * plain(x) and len(fo._pack(row)) < 0.9 * plain(row)
    for v in (x, row, rng.permutation(row), x[:, :0], rng.normal(size=(2, 500)), np.array([0.0, -0.0, np.nan, np.inf] * 9)):
        assert fo._unpack(fo._pack(v), v.dtype.type).tobytes() == np.ascontiguousarray(v).tobytes()
    some = np.flatnonzero(rng.random(20_000) < 0.1)
    packed = fo._pack_columns([fo._some(c, some) for c in fo._columns(fo._pack(x))])
    assert len(packed) < 0.7 * plain(x[:, some]) and np.array_equal(fo._unpack(packed).reshape(5, -1), x[:, some])


def test_cuts_of_codes_are_those_of_the_values():
    rng = np.random.default_rng(12)
    for k in range(60):
        parts = [rng.integers(0, rng.integers(1, 1_500), rng.integers(1, 3_000)) / 7 - 3 for _ in range(3)]
        coded = [(None, c) if k % 3 and j == 0 else fo._coded(c) for j, c in enumerate(parts)]
        assert np.array_equal(tr.cuts_of_codes(coded), tr.cuts_of(np.concatenate(parts)))


def test_rows_are_packed_in_the_order_of_their_hashes_before_they_are_shuffled(spark):
    """F2-F7: the shuffle behind the blocks has packed pieces, not rows, and no table of plain rows is written."""
    rows = spark.range(20_000).selectExpr("if(id % 4 = 0, 'b', 'a') grp", "xxhash64(id) row", "id % 7 * 1D x0", "id % 3 * 1D x1", "id * 1D y").repartition(3)
    dealt = fo._blocks(rows, rows.groupBy("grp").agg(F.count("*").alias("n")), 1_000)
    packed = fo._packed_blocks(dealt, 2)
    found = packed.orderBy("grp", "block").collect()
    assert [sum(r["grp"] == g for r in found) for g in "ab"] == [15, 5]
    for g, n in (("a", 15_000), ("b", 5_000)):
        row, x, y = (np.concatenate([fo._unpack(r[c], t).reshape(k, -1) for r in found if r["grp"] == g], axis=1) for c, t, k in (("row", np.int64, 1), ("x", float, 2), ("y", float, 1)))
        assert row.shape == (1, n) and (np.diff(row[0]) > 0).all() and np.array_equal(x, [y[0] % 7, y[0] % 3])
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert plan.index("FlatMapGroupsInArrow") < plan.index("Exchange hashpartitioning(grp") < plan.index("MapInArrow pack")


def test_waves_have_a_bounded_number_of_packed_bytes(spark, table, monkeypatch):
    """F2-F8: trees are finished as many at once as fit the bytes allowed, and give the same forest."""
    waves, finished = [], fo._finished
    monkeypatch.setattr(fo, "_finished", lambda blocks, top, trees, *rest: waves.append(trees) or finished(blocks, top, trees, *rest))
    of = lambda m: {(r["grp"], r["tree"], r["node"]): tuple(r["threshold"]) for r in m.subtrees.collect()}
    once, some = (of(fo.fit_forests(table, COLUMNS, "y", by=["g"], trees=5, local_values=300, wave_bytes=b)) for b in (fo.WAVE_BYTES, 1))
    assert waves == [range(5), *(range(t, t + 1) for t in range(5))] and once == some


def test_predictions_keep_all_columns_and_copies(spark, table):
    """rows travel packed with all their columns, whatever they are called, and are not joined again."""
    model = fo.fit_forests(table, COLUMNS, "y", by=["g"], trees=3)
    asked = table.selectExpr("*", "k grp", "string(k) row", "struct(timestamp_seconds(k) t) block", "array(decimal(k)) x0").unionByName(
        table.where("k = 5").selectExpr("*", "k grp", "string(k) row", "struct(timestamp_seconds(k) t) block", "array(decimal(k)) x0")
    )
    found = fo.predict_forests(model, asked, block_values=90)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapCoGroupsInArrow") == 1 and "SortMergeJoin" not in plan.split("FlatMapCoGroupsInArrow")[0]
    assert found.schema.fieldNames() == [*asked.columns, "prediction"]
    key = lambda r: (str(r["g"]), r["k"])
    plain = sorted(asked.collect(), key=key)
    assert [tuple(r)[:-1] for r in sorted(found.collect(), key=key)] == [tuple(r) for r in plain]
    routed = {key(r): r["prediction"] for r in fo.predict_forests(model, asked, block_values=90, walk_nodes=0).collect()}
    assert {key(r): r["prediction"] for r in found.collect()} == pytest.approx(routed)


def test_rows_that_no_split_tells_apart_walk_once():
    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 20, (3_000, 3)).astype(float), rng.integers(0, 20, 3_000).astype(float)
    trees = [tr.grow(x[k::2, :], y[k::2], np.ones(1_500), 3) for k in (0, 1)]
    first, place = tr.alike([(t.feature, t.threshold) for t in trees], x)
    assert len(first) < 3_000
    for t in trees:
        assert np.array_equal(tr.predict(t, x[first])[place], tr.predict(t, x))
    many = [(np.repeat(np.arange(3), 2**21), np.tile(np.arange(2.0**21), 3))]
    first, place = tr.alike(many, x)
    assert len(first) == 3_000 and np.array_equal(first, place)


def test_small_groups_are_shuffled_once_for_all_batches_of_trees(spark, table, monkeypatch):
    """no blocks are written for them, and the batches read one exchange."""
    kept, written = {}, fo.written_table
    monkeypatch.setattr(fo, "written_table", lambda df, label, **options: kept.update({label: df}) or written(df, label, **options))
    model = fo.fit_forests(table, COLUMNS, "y", by=["g"], trees=6, together=2)
    assert sorted(kept) == ["forest-sizes", "forest-subtrees", "forest-top"]
    assert model.subtrees.groupBy("grp").agg(F.array_sort(F.collect_list("tree")).alias("t")).where("t = array(0, 1, 2, 3, 4, 5)").count() == 4
    kept["forest-subtrees"].collect()
    plan = kept["forest-subtrees"]._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FlatMapGroupsInArrow") == 3 and plan.count("ReusedExchange") == 2 and plan.count("MapInArrow pack") == 1


def test_copies_of_large_groups_stay_within_the_bytes_of_a_wave(spark):
    """only the rows that a tree samples travel, so that is what counts."""
    blocks = spark.createDataFrame([("", b, b"", bytes(400), bytes(100)) for b in (0, 1)], fo._PACKED)
    large = spark.createDataFrame([("", 4_000)], "grp string, n bigint")
    trees_of = lambda seed, most: fo._wave(blocks, large, 1_000, 2, 50, seed, fo.WAVE_VALUES, most)[0]
    assert [trees_of(42, m) for m in (1, 1_280 * 3 + 9, 10**9)] == [1, 3, 50] and trees_of(None, 2_000 * 3 + 9) == 3


@pytest.mark.parametrize("depth", [3, 1])
def test_forests_do_not_depend_on_the_size_from_which_groups_are_large(spark, depth):
    """bins, splits and predictions of a group are the same whether one task grows it or many, also of columns with many values."""
    rng = np.random.default_rng(8)
    rows = [(g, k, float(rng.normal()), float(rng.integers(0, 9)) / 7, float(rng.integers(0, 700))) for g, n in (("a", 2_000), ("b", 900)) for k in range(n)]
    runs = spark.createDataFrame([(*r, float(np.sin(r[2]) + r[3] * r[4] + rng.normal() / 9)) for r in rows], "g string, k int, a double, b double, c double, y double")
    models = [fo.fit_forests(runs, COLUMNS, "y", by=["g"], trees=4, depth=depth, local_values=v, block_values=900) for v in (fo.LOCAL_VALUES, 600)]
    assert models[0].top.isEmpty() and models[1].subtrees.where("node = 1").isEmpty()
    splits = [{(r["grp"], r["tree"]): (r["feature"], r["threshold"]) for r in fo.root_splits(m).collect()} for m in models]
    assert len(splits[0]) == 8 and splits[0] == splits[1]
    one, other = ({(r["g"], r["k"]): r["prediction"] for r in fo.predict_forests(m, runs).collect()} for m in models)
    assert len(one) == 2_900 and one == pytest.approx(other, rel=1e-9)


def test_first_splits_of_large_groups_are_exact(spark, runs, monkeypatch):
    """the query has a row for every space, with the threshold and gain of all its rows, at any size."""
    from runscope.plans import queries as pq

    monkeypatch.setattr(pq, "_runs", lambda *_: runs)
    small = sorted(map(tuple, pq.space_first_splits(spark, "").collect()))
    fit = fo.fit_forests
    monkeypatch.setattr(fo, "fit_forests", lambda *a, **k: fit(*a, **k, local_values=50, block_values=100))
    assert len(small) == runs.select("search_space_id").distinct().count() > 1
    assert sorted(map(tuple, pq.space_first_splits(spark, "").collect())) == small


def test_bounds_of_many_tasks_are_those_of_one(spark):
    """bounds come from all rows of a group, exactly, however many values there are and however the blocks lie."""
    rng = np.random.default_rng(9)
    x = np.stack([rng.normal(size=6_000) * 10.0 ** rng.integers(-9, 9, 6_000), rng.integers(0, 3_000, 6_000) / 7, rng.integers(-3, 3, 6_000) * 0.5])
    x[0, ::7] = -0.0
    parts = [slice(0, 2_500), slice(2_500, 2_600), slice(2_600, 6_000)]
    blocks = [("a", k, b"", fo._pack(np.ascontiguousarray(x[:, p])), b"") for k, p in enumerate(parts)] + [("b", 0, b"", fo._pack(np.ones((3, 5))), b"")]
    blocks = spark.createDataFrame(blocks, fo._PACKED).repartition(3)
    sizes = spark.createDataFrame([("a", 6_000), ("b", 5)], "grp string, n bigint")
    for listed in (fo.LISTED, 100):
        found = {r["grp"]: r["cuts"] for r in fo._cuts(blocks, sizes, 3, listed).collect()}
        assert all(np.array_equal(found["a"][f], tr.cuts_of(x[f])) for f in range(3)) and found["b"] == [[], [], []]
