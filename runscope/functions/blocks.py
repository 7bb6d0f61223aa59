"""Array helpers that run inside tasks, on one block of vectors at a time."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle

# Executors need not have this package installed: the few functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype("float64")


def norms(m: np.ndarray) -> np.ndarray:
    total = np.zeros(len(m))
    for j in range(m.shape[1]):
        total += m[:, j] * m[:, j]
    return np.sqrt(total)


def unit(m: np.ndarray) -> np.ndarray:
    lengths = norms(m)
    return m / np.where(lengths > 0, lengths, 1.0)[:, None]


def distances(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (units @ pivots.T)))


def cosines(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Row-wise cosines in index order: the same value whatever block a pair meets in."""
    dot = np.zeros(len(a))
    for j in range(a.shape[1]):
        dot += a[:, j] * b[:, j]
    length = na * nb
    return np.divide(dot, length, out=np.zeros(len(a)), where=length > 0)


# A matrix product may differ from the sum in index order by far less than this.
_MARGIN = 1e-9


def _close_pairs(qu: np.ndarray, cu: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that may be among the k nearest of a query, by fast but inexact products.

    The candidates pass in slices. The k-th best value so far rises quickly, so later
    slices are mostly put aside after one comparison per row.
    """
    best = np.full((len(qu), k), -np.inf)  # column 0 holds the k-th best value
    rows, cols, values = [], [], []
    for at in range(0, len(cu), width):
        near = qu @ cu[at : at + width].T
        hit = np.nonzero(near.max(axis=1) >= best[:, 0] - _MARGIN)[0]
        if len(hit) == 0:
            continue
        near = near[hit]
        both = np.concatenate([best[hit], near], axis=1)
        best[hit] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
        r, c = np.nonzero(near >= best[hit][:, :1] - _MARGIN)
        rows.append(hit[r])
        cols.append(c + at)
        values.append(near[r, c])
    rows, cols, values = np.concatenate(rows), np.concatenate(cols), np.concatenate(values)
    kept = values >= best[rows, 0] - _MARGIN
    return rows[kept], cols[kept]


def block_top(
    queries: pd.DataFrame, candidates: pd.DataFrame, keys: list[str], k: int, size: int = 1024
) -> Iterator[pd.DataFrame]:
    """The k nearest candidates of every query in a block; ties go to the lower keys."""
    q, c = matrix(queries["vec"]), matrix(candidates["vec"])
    qn, cn = norms(q), norms(c)
    qu, cu = unit(q), unit(c)
    for at in range(0, len(q), size):
        rows, cols = _close_pairs(qu[at : at + size], cu, k, size)
        rows = rows + at
        found = candidates[keys].iloc[cols].reset_index(drop=True)
        found["similarity"] = cosines(q[rows], c[cols], qn[rows], cn[cols])
        found["_row"] = rows
        found = found.sort_values(["_row", "similarity", *keys], ascending=[True, False, *[True] * len(keys)])
        found = found.groupby("_row", sort=False).head(k)
        found["vec"] = queries["vec"].iloc[found["_row"].to_numpy()].to_numpy()
        yield found[["vec", *keys, "similarity"]]
