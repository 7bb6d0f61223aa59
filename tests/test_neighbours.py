import math
import random

import pytest
from pyspark.sql import functions as F

from runscope.operators import neighbours as near
from runscope.operators.summaries import PROFILE_FEATURES

SMALL = dict(rows_per_cell=40, query_block=16, candidate_block=24)


def cosine(x, y):
    dot = sum_in_order(a * b for a, b in zip(x, y))
    length = math.sqrt(sum_in_order(a * a for a in x)) * math.sqrt(sum_in_order(b * b for b in y))
    return dot / length if length > 0 else 0.0


def sum_in_order(values):
    total = 0.0
    for v in values:
        total += v
    return total


def brute(rows, k):
    out = set()
    for i, x in rows:
        ranked = sorted((-cosine(x, y), j) for j, y in rows if j != i)[:k]
        out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(ranked)}
    return out


def found(df):
    return {(r["id"], r["rank"], r["similar_id"], r["similarity"]) for r in df.collect()}


def table(spark, rows):
    return spark.createDataFrame(rows, "id long, vec array<double>").repartition(3)


def continuous(n, seed, width=4):
    rng = random.Random(seed)
    return [(i, [rng.uniform(0, 1) for _ in range(width)]) for i in range(n)]


def grid(n, seed):
    """Few distinct directions: many exact ties, copies and zero vectors."""
    rng = random.Random(seed)
    return [(i, [float(rng.randint(-1, 2)) for _ in range(3)]) for i in range(n)]


def one_hot_group(n, seed):
    """More than a third of the rows are copies of one vector."""
    rows = continuous(n, seed)
    return [(i, [0.3, 0.3, 0.1, 0.9] if i % 5 < 2 else v) for i, v in rows]


@pytest.mark.parametrize("rows", [continuous(300, 1), grid(260, 2), one_hot_group(300, 3)], ids=["continuous", "grid", "hot"])
@pytest.mark.parametrize("sizes", [{}, SMALL], ids=["one cell", "many cells"])
def test_nearest_equals_all_pairs(spark, rows, sizes):
    assert found(near.nearest(table(spark, rows), ["id"], 3, **sizes)) == brute(rows, 3)


def test_fewer_rows_than_k(spark):
    rows = continuous(3, 4)
    assert found(near.nearest(table(spark, rows), ["id"], 5)) == brute(rows, 5)
    assert found(near.nearest(table(spark, rows), ["id"], 5, rows_per_cell=1, candidate_block=1)) == brute(rows, 5)


def test_some_queries_only(spark):
    rows = continuous(200, 5)
    df = table(spark, rows)
    got = found(near.nearest(df, ["id"], 2, queries=df.where("id < 7"), **SMALL))
    assert got == {r for r in brute(rows, 2) if r[0] < 7}


def test_queries_visit_few_cells(spark):
    """Far-apart bundles: a query must not be sent to every cell."""
    rng = random.Random(6)
    rows = []
    for i in range(400):
        axis = i % 4
        rows.append((i, [(1.0 if j == axis else 0.0) + rng.uniform(0, 0.01) for j in range(4)]))
    sent = []
    original = near.written_table

    def spy(df, label):
        out = original(df, label)
        if label == "sent-queries":
            sent.append(out.count())
        return out

    near.written_table = spy
    try:
        got = found(near.nearest(table(spark, rows), ["id"], 3, **SMALL))
    finally:
        near.written_table = original
    assert got == brute(rows, 3)
    cells = 10  # 400 candidates, 40 per cell
    assert sum(sent) < 0.5 * 400 * (cells - 1)


def test_plan_has_no_cross_join(spark, capsys):
    near.nearest(table(spark, continuous(50, 7)), ["id"], 3).explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def profile(space, dataset, best, features=None):
    values = features or [0.5, best, 0.1, 0.4, 0.3, 0.2, 0.1]
    return (space, dataset, 20, *values)


PROFILE_SCHEMA = "search_space_id int, dataset_id int, n_runs long, " + ", ".join(f"{c} double" for c in PROFILE_FEATURES)


def test_missing_features_count_as_zero(spark):
    df = spark.createDataFrame([(1, 1, 20, 0.5, 0.9, None, 0.1, 0.2, None, 0.3)], PROFILE_SCHEMA)
    assert near.profile_vectors(df).first()["vec"] == [0.5, 0.9, 0.0, 0.1, 0.2, 0.0, 0.3]


def test_same_dataset_in_another_space_is_optional(spark):
    same = [0.5, 0.9, 0.1, 0.4, 0.3, 0.2, 0.1]
    other = [0.5, 0.9, 0.1, 0.1, 0.9, 0.2, 0.1]
    df = spark.createDataFrame([profile(1, 7, 0.9, same), profile(2, 7, 0.9, same), profile(1, 8, 0.9, other)], PROFILE_SCHEMA)
    first = near.nearest_profiles(df, 1).where("search_space_id = 1 and dataset_id = 7").first()
    assert (first["similar_search_space_id"], first["similar_dataset_id"]) == (2, 7)
    other = near.nearest_profiles(df, 1, exclude_same_dataset=True).where("search_space_id = 1 and dataset_id = 7").collect()
    assert [(r["rank"], r["similar_dataset_id"]) for r in other] == [(1, 8)]


def test_neighbours_without_a_config_are_dropped_after_the_cut(spark):
    near_rows = spark.createDataFrame(
        [(1, 1, 1, 5, 1, 0.9), (1, 1, 2, 6, 2, 0.8)],
        "search_space_id int, dataset_id int, rank int, similar_search_space_id int, similar_dataset_id int, similarity double",
    )
    configs = spark.createDataFrame(
        [(6, 0.1, 0.2, 0.3, 0.4)], "search_space_id int, best_hp0 double, best_hp1 double, best_hp2 double, best_hp3 double"
    )
    got = near.neighbour_configs(near_rows, configs).collect()
    assert [(r["rank"], r["recommended_hp0"]) for r in got] == [(2, 0.1)]


def test_hit_rate_counts_misses_and_profiles_without_recommendation(spark):
    profiles = spark.createDataFrame([profile(1, 1, 0.9), profile(1, 2, 0.8), profile(1, 3, 0.7), profile(1, 4, 0.6)], PROFILE_SCHEMA)
    recs = spark.createDataFrame(
        [(1, 1, 0.9 * 0.95), (1, 1, 0.1), (1, 2, 0.75), (1, 4, 0.9)], "search_space_id int, dataset_id int, best_acc double"
    )
    row = near.hit_rate(recs, profiles).first()
    assert (row["profiles"], row["hits"], row["hit_rate_pct"]) == (4, 2, 50.0)
    row = near.hit_rate(recs, profiles, n=1).first()
    assert (row["profiles"], row["hits"]) == (1, 1)


def test_cosine_of_a_zero_vector_is_zero(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0])], "a array<double>, b array<double>")
    assert df.select(near.cosine(F.col("a"), F.col("b"), 2)).first()[0] == 0.0
