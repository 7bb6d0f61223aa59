"""Cosine neighbours and the recommender built on them.

The exact k nearest of every row are found without forming all pairs:

1. Rows with the same vector are equally similar to everything, so only the first
   k + 1 of them by key can ever be chosen, and one search serves them all. A group
   of copies, however large, shrinks to k + 1 candidates and one query.
2. Vectors are scaled to length 1, where a high cosine is a short distance, and
   every vector joins the cell of its nearest pivot. A query first meets the
   candidates of its own cell. The k-th similarity found there limits how far away a
   better candidate can be, and by the triangle inequality most other cells lie
   farther: the query travels only to the rest (pivots and bounds as in Lu et al.,
   "Efficient Processing of k Nearest Neighbor Joins using MapReduce", VLDB 2012).
3. Inside a cell, queries and candidates are dealt into blocks of limited size. One
   task compares one block of each and returns k rows per query, so a crowded cell
   becomes many small tasks.
4. The partial lists of a query are merged by one more top-k.

The driver sees only the pivots (at most ``MAX_CELLS``) and their statistics.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from runscope.functions.blocks import block_top, distances, matrix, unit
from runscope.operators.filters import fill_missing_hp
from runscope.operators.ranking import top_per_group
from runscope.operators.summaries import PROFILE_FEATURES
from runscope.session import written_table

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 8192
MAX_CELLS = 1024
ROWS_PER_CELL = 1024
PROFILE_KEYS = ["search_space_id", "dataset_id"]

# Far above the rounding error of a distance, far below any gap that matters.
_SLACK = 1e-6


def profile_vectors(profiles: DataFrame, features: list[str] = PROFILE_FEATURES) -> DataFrame:
    """Profiles with their features as one vector; missing features count as 0."""
    filled = fill_missing_hp(profiles, features)
    return filled.withColumn("vec", F.array(*[F.col(f).cast("double") for f in features]))


def cosine(a: Column, b: Column, width: int) -> Column:
    """Cosine of two arrays of ``width`` numbers, added up in index order; 0 if either has length 0.

    Written out term by term: higher-order functions would leave generated code.
    """

    def dot(x: Column, y: Column) -> Column:
        terms = [F.get(x, F.lit(i)) * F.get(y, F.lit(i)) for i in range(width)]
        return sum(terms[1:], terms[0])

    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))


# --- the join -----------------------------------------------------------------


def _search(queries: DataFrame, candidates: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Compare the blocks that share (cell, query block, candidate block): k rows per query and block."""
    group = ["_cell", "_qb", "_cb"]
    fields = [f for f in candidates.schema if f.name in keys]
    schema = T.StructType([queries.schema["vec"], *fields, T.StructField("similarity", T.DoubleType())])

    def compare(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if len(q) == 0 or len(c) == 0:
            return pd.DataFrame(columns=schema.names, dtype=object)
        return pd.concat(block_top(q, c, keys, k), ignore_index=True)

    return queries.groupBy(group).cogroup(candidates.groupBy(group)).applyInPandas(compare, schema)


def _merged(partial: DataFrame, keys: list[str], k: int) -> DataFrame:
    return top_per_group(partial, ["vec"], [F.desc("similarity"), *keys], k, "_place")


def _dealt(df: DataFrame, own: str, other: str, own_blocks: Column, other_blocks: Column, on: Column) -> DataFrame:
    """Give each row its own block and one copy per block of the other side."""
    return df.withColumn(own, F.pmod(F.xxhash64(on), own_blocks.cast("bigint")).cast("int")).withColumn(
        other, F.explode(F.sequence(F.lit(0), other_blocks - 1))
    )


def _blocks(counts: list[int], size: int) -> Column:
    """Number of blocks of the row's cell."""
    return F.element_at(F.array(*[F.lit(max(1, -(-int(n) // size))) for n in counts]), F.col("_cell") + 1)


def _search_cells(queries: DataFrame, candidates: DataFrame, keys: list[str], k: int, n_q: list[int], n_c: list[int],
                  query_block: int, candidate_block: int) -> DataFrame:
    qb, cb = _blocks(n_q, query_block), _blocks(n_c, candidate_block)
    return _search(
        _dealt(queries.select("vec", "_cell"), "_qb", "_cb", qb, cb, F.col("vec")),
        _dealt(candidates.select(*keys, "vec", "_cell"), "_cb", "_qb", cb, qb, F.struct(*keys)),
        keys,
        k,
    )


def _per_cell(df: DataFrame, cells: int, *aggregates: Column) -> list[tuple]:
    """Counts and other figures of every cell; at most ``MAX_CELLS`` rows."""
    rows = {r[0]: tuple(r[1:]) for r in df.groupBy("_cell").agg(F.count(F.lit(1)), *aggregates).collect()}
    return [rows.get(i, (0, *[0.0] * len(aggregates))) for i in range(cells)]


def _many_cells(queries: DataFrame, candidates: DataFrame, keys: list[str], k: int, cells: int,
                query_block: int, candidate_block: int) -> DataFrame:
    length = F.aggregate("vec", F.lit(0.0), lambda s, v: s + v * v)
    directed = candidates.where(length > 0)
    sample = directed.select("vec").distinct().orderBy(F.xxhash64("vec"), "vec").limit(cells)
    pivots = unit(matrix(sample.toPandas()["vec"]))
    m = len(pivots)
    between = distances(pivots, pivots)

    @F.pandas_udf("cell int, dist double")
    def place(vec: pd.Series) -> pd.DataFrame:
        d = distances(unit(matrix(vec)), pivots)
        cell = d.argmin(axis=1)
        return pd.DataFrame({"cell": cell.astype("int32"), "dist": d[np.arange(len(d)), cell]})

    housed = written_table(
        directed.select(*keys, "vec", place("vec").alias("_at")).select(
            *keys, "vec", F.col("_at.cell").alias("_cell"), F.col("_at.dist").alias("_dist")
        ),
        "housed-candidates",
    )
    # Cell m is for queries of length 0: all similarities are 0, so the first keys win.
    placed = written_table(
        queries.select("vec", F.when(length > 0, place("vec")["cell"]).otherwise(m).alias("_cell")), "placed-queries"
    )
    figures = _per_cell(housed, m, F.max("_dist"))
    held, radius = np.array([f[0] for f in figures]), np.array([f[1] for f in figures])

    # First every query meets its own cell and the few candidates of length 0.
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    at_home = (
        housed.select(*keys, "vec", "_cell")
        .unionByName(candidates.where(length == 0).select(*keys, "vec", everywhere.alias("_cell")))
        .unionByName(candidates.orderBy(*keys).limit(k).select(*keys, "vec", F.lit(m).alias("_cell")))
    )
    n_home = [int(n) + k for n in held] + [k]
    n_placed = [f[0] for f in _per_cell(placed, m + 1)]
    first = _search_cells(placed, at_home, keys, k, n_placed, n_home, query_block, candidate_block)
    first = written_table(_merged(first, keys, k).drop("_place"), "home-neighbours")

    # The k-th similarity found at home limits how far away a better one can be.
    @F.pandas_udf("array<int>")
    def visits(vec: pd.Series, kth: pd.Series) -> pd.Series:
        d = distances(unit(matrix(vec)), pivots)
        home = d.argmin(axis=1)
        row = np.arange(len(d))
        # Without k neighbours at home: enough candidates lie within this distance.
        outer = np.where(held > 0, d + radius, np.inf)
        order = outer.argsort(axis=1)
        enough = (held[order].cumsum(axis=1) >= k).argmax(axis=1)
        reach = np.where(held.sum() >= k, outer[row, order[row, enough]], np.inf)
        known = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * kth.to_numpy(dtype="float64")))
        reach = np.fmin(reach, known)[:, None] + _SLACK
        gap = between[home]
        plane = np.divide(
            d * d - d[row, home][:, None] ** 2, 2.0 * gap, out=np.full_like(d, -np.inf), where=gap > _SLACK
        )
        go = (held > 0) & (d - radius <= reach) & (plane <= reach)
        go[row, home] = False
        return pd.Series([np.nonzero(g)[0].astype("int32") for g in go])

    limits = first.groupBy("vec").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("similarity")).alias("_kth")
    )
    travelling = placed.where(F.col("_cell") < m).join(limits, "vec", "left")
    sent = written_table(travelling.select("vec", F.explode(visits("vec", "_kth")).alias("_cell")), "sent-queries")
    n_sent = [f[0] for f in _per_cell(sent, m)]
    second = _search_cells(sent, housed, keys, k, n_sent, list(held), query_block, candidate_block)
    return _merged(first.unionByName(second), keys, k)


def _one_cell(queries: DataFrame, candidates: DataFrame, keys: list[str], k: int, n_q: int, n_c: int,
              query_block: int, candidate_block: int) -> DataFrame:
    here = F.lit(0).alias("_cell")
    found = _search_cells(
        queries.select("vec", here), candidates.select(*keys, "vec", here), keys, k, [n_q], [n_c],
        query_block, candidate_block,
    )
    return _merged(found, keys, k)


def nearest(
    vectors: DataFrame,
    keys: list[str],
    k: int,
    queries: DataFrame | None = None,
    rows_per_cell: int = ROWS_PER_CELL,
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """The ``k`` most similar other rows of every query: keys, ``similarity``, ``rank``.

    ``vectors`` holds the keys and ``vec``; ``queries`` is a part of it, all rows if
    left out. Neighbour keys are prefixed ``similar_``. Ties go to the lower keys.
    Input is read several times; pass a written table.
    """
    queries = vectors if queries is None else queries
    wide = k + 1  # a row finds itself among its neighbours
    candidates = written_table(
        top_per_group(vectors.select(*keys, "vec"), ["vec"], keys, wide, "_copy").drop("_copy"), "candidates"
    )
    distinct = queries.select("vec").distinct()
    n_c, n_q = candidates.count(), distinct.count()
    cells = min(MAX_CELLS, -(-n_c // rows_per_cell))
    if n_c <= candidate_block:
        found = _one_cell(distinct, candidates, keys, wide, n_q, n_c, query_block, candidate_block)
    else:
        found = _many_cells(distinct, candidates, keys, wide, cells, query_block, candidate_block)

    renamed = [F.col(c).alias(f"similar_{c}") for c in keys]
    entry = F.struct(F.col("_place"), *renamed, "similarity")
    lists = found.groupBy("vec").agg(F.array_sort(F.collect_list(entry)).alias("_near"))
    itself = lambda e: F.forall(
        F.array(*[e[f"similar_{c}"] == F.col(c) for c in keys]), lambda same: same
    )
    others = F.slice(F.filter("_near", lambda e: ~itself(e)), 1, k)
    return (
        queries.select(*keys, "vec")
        .join(lists, "vec")
        .select(*keys, F.posexplode(others).alias("_i", "_e"))
        .select(
            *keys,
            (F.col("_i") + 1).alias("rank"),
            *[F.col(f"_e.similar_{c}").alias(f"similar_{c}") for c in keys],
            F.col("_e.similarity").alias("similarity"),
        )
    )


# --- recommender ----------------------------------------------------------------


def profiles_in_order(profiles: DataFrame, n: int) -> DataFrame:
    """The first ``n`` profiles by best accuracy, with their 0-based ``position``."""
    first = profiles.orderBy(F.desc("best_acc"), *PROFILE_KEYS).limit(n)
    order = W.orderBy(F.desc("best_acc"), *PROFILE_KEYS)
    return first.withColumn("position", F.row_number().over(order) - 1)


def nearest_profiles(
    profiles: DataFrame,
    k: int,
    features: list[str] = PROFILE_FEATURES,
    queries: DataFrame | None = None,
    exclude_same_dataset: bool = False,
) -> DataFrame:
    """Top-k similar profiles. The same dataset in another space counts unless excluded."""
    vectors = profile_vectors(profiles, features)
    asked = None if queries is None else profile_vectors(queries, features)
    if not exclude_same_dataset:
        return nearest(vectors, PROFILE_KEYS, k, asked)
    # At most one profile per space shares the dataset, so k plus that many suffice.
    spaces = profiles.select("search_space_id").distinct().count()
    wide = nearest(vectors, PROFILE_KEYS, k + spaces, asked)
    kept = wide.where(F.col("similar_dataset_id") != F.col("dataset_id"))
    return top_per_group(kept, PROFILE_KEYS, ["rank"], k, "_rank").drop("rank").withColumnRenamed("_rank", "rank")


def cosine_pairs(profiles: DataFrame, positions: list[int], features: list[str] = PROFILE_FEATURES) -> DataFrame:
    """Similarity of a few chosen profiles to every profile.

    The chosen profiles are picked by position and travel as one array, whose length
    is the length of ``positions``.
    """
    vectors = profile_vectors(profiles, features)
    chosen = profile_vectors(profiles_in_order(profiles, max(positions) + 1), features).where(
        F.col("position").isin(positions)
    )
    asked = chosen.agg(F.collect_list(F.struct(F.col("position").alias("query"), F.col("vec").alias("asked"))).alias("a"))
    return vectors.select(*PROFILE_KEYS, "vec", F.inline(asked.scalar())).select(
        "query", *PROFILE_KEYS, F.round(cosine(F.col("asked"), F.col("vec"), len(features)), 6).alias("similarity")
    )


def similarity_matrix(profiles: DataFrame, n: int = 20, features: list[str] = PROFILE_FEATURES) -> DataFrame:
    """Cosine of the first ``n`` profiles with each other, the diagonal included."""
    first = profile_vectors(profiles_in_order(profiles, n), features).select("position", "vec")
    row = first.agg(F.collect_list(F.struct(F.col("position").alias("column"), F.col("vec").alias("other"))).alias("a"))
    return first.select(F.col("position").alias("row"), "vec", F.inline(row.scalar())).select(
        "row", "column", F.round(cosine(F.col("vec"), F.col("other"), len(features)), 6).alias("similarity")
    )


def neighbour_configs(neighbours: DataFrame, top_configs: DataFrame) -> DataFrame:
    """Attach the top configuration of each neighbour's space.

    Neighbours whose space has none are dropped after the top-k cut, so a query may
    keep fewer than k rows.
    """
    configs = top_configs.select(
        F.col("search_space_id").alias("similar_search_space_id"),
        *[F.col(f"best_hp{j}").alias(f"recommended_hp{j}") for j in range(4)],
    )
    return neighbours.join(configs, "similar_search_space_id")


def recommend_configs(
    profiles: DataFrame, top_configs: DataFrame, k: int = 5, queries: DataFrame | None = None
) -> DataFrame:
    """For every query profile: similar datasets, how well they did and what to try."""
    near = nearest_profiles(profiles, k, queries=queries)
    reached = profiles.select(
        F.col("search_space_id").alias("similar_search_space_id"),
        F.col("dataset_id").alias("similar_dataset_id"),
        "best_acc",
    )
    return (
        neighbour_configs(near, top_configs)
        .join(reached, ["similar_search_space_id", "similar_dataset_id"])
        .select(
            *PROFILE_KEYS,
            "rank",
            F.col("similar_dataset_id").alias("similar_dataset"),
            F.col("similar_search_space_id").alias("search_space"),
            F.round("similarity", 4).alias("similarity"),
            "best_acc",
            *[f"recommended_hp{j}" for j in range(4)],
        )
    )


def hit_rate(recommendations: DataFrame, profiles: DataFrame, n: int = 100, tolerance: float = 0.95) -> DataFrame:
    """Share of the first ``n`` profiles whose best recommendation is within tolerance.

    A profile without a recommendation is a miss.
    """
    asked = profiles_in_order(profiles, n).select(*PROFILE_KEYS, F.col("best_acc").alias("own"))
    offered = recommendations.groupBy(*PROFILE_KEYS).agg(F.max("best_acc").alias("offered"))
    hit = F.coalesce(F.col("offered") >= F.col("own") * F.lit(tolerance), F.lit(False))
    return (
        asked.join(offered, PROFILE_KEYS, "left")
        .agg(F.count(F.lit(1)).alias("profiles"), F.count_if(hit).alias("hits"))
        .withColumn("hit_rate_pct", F.try_divide(F.col("hits") * 100.0, "profiles"))
    )
