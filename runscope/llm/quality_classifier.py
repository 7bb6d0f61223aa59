"""Operator 9: a quality classifier learnt from preference pairs (Bradley-Terry).

A document has a strength ``w . x`` over measures ``x`` of its text. That a document
of label 1 is preferred to one of label 0 has the probability
``1 / (1 + exp(-(w . x1 - w . x0)))``; ``w`` minimises the logistic loss over such
pairs. The cut between the classes is a quantile of the strengths of the documents
learnt from: the lowest whose accuracy on them is within ``TOLERANCE`` of the best, so
that good documents go through. Scores are ``sigmoid(strength - cut + logit(0.7))``, so a score of 0.7
is exactly the cut.

The fit uses a bounded sample: at most ``SAMPLE`` labelled documents, the first by a
hash of their id, and ``PAIRS`` pairs of them. The labelled rows are counted first; then only those whose hash lies
below a bound that about ``2 * SAMPLE`` rows reach are sorted, so neither a task nor the driver meets more, whatever
the size of the input. Everything else runs over all rows.

Defined cases: a null text is an empty one. Empty texts have a score as any other. A
null ``doc_id`` has no label and is not held out. Labels other than 0 and 1 are left out;
a document with several label rows counts with each. If one of the classes has no
labelled row, nothing can be learnt and every score is 0.7. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from runscope.llm.texts import map_texts, text_rows
from runscope.session import written_table

SAMPLE = 20_000
PAIRS = 60_000
THRESHOLD = 0.7
TOLERANCE = 0.001
_SHIFT = math.log(THRESHOLD / (1 - THRESHOLD))

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()
_NON_ASCII = bytes(range(0x80, 0x100))


def _count(text: bytes, characters: bytes) -> int:
    return len(text) - len(text.translate(None, characters))


def measures(text: bytes) -> tuple[list[float]]:
    """Shape of a text: lengths, shares of character kinds, and repetition."""
    words = text.split()
    n = max(1, len(words))
    upper, lower = _count(text, _UPPER), _count(text, _LOWER)
    counts = Counter(words)
    distinct, top = len(counts), max(counts.values(), default=0)
    repeats = sum(map(eq, words, words[1:]))
    lines = [x for x in text.split(b"\n") if x.strip()]
    n_lines = max(1, len(lines))
    size = max(1, sum(map(len, words)))
    return (
        [
            math.log1p(len(words)),
            min(size / n, 100.0),
            upper / max(1, upper + lower),
            min(_count(text, b"#*$%&|<>") / n, 5.0),
            min(_count(text, b"!?") / n, 5.0),
            min(_count(text, b".,;:") / n, 5.0),
            min(_count(text, b"0123456789") / n, 10.0),
            distinct / n,
            (distinct / n) * math.log1p(len(words)),
            top / n,
            repeats / n,
            len(set(lines)) / n_lines,
            math.log1p(n / n_lines),
            _count(text, _NON_ASCII) / size,
            min(_count(text, b"|") / n, 5.0),
            min(_count(text, b"{}[]()=_\\/@") / n, 5.0),
        ],
    )


def held_out(doc_id: Column, parts: int = 4) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == 2, F.lit(False))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of every text."""
    return map_texts(text_rows(docs, "doc_id"), measures, "x array<double>", "doc_id bigint")


@dataclass(frozen=True)
class Ranking:
    """Strengths are ``(x - mean) / scale . weights``; ``cut`` is the quantile chosen."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        strength = ((x - self.mean) / self.scale) @ self.weights
        return 1.0 / (1.0 + np.exp(-np.clip(strength - self.cut + _SHIFT, -30, 30)))


def learn(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, ridge: float = 1e-3) -> Ranking | None:
    """Fit the strengths on random pairs (good, bad) by Newton's method; None without pairs."""
    best, rest = np.nonzero(good)[0], np.nonzero(~good)[0]
    if len(best) == 0 or len(rest) == 0:
        return None
    mean, scale = x.mean(axis=0), x.std(axis=0)
    z = (x - mean) / np.where(scale > 0, scale, 1.0)
    draw = np.random.default_rng(9)
    diff = z[draw.choice(best, pairs)] - z[draw.choice(rest, pairs)]
    w = np.zeros(x.shape[1])
    for _ in range(25):
        wins = 1.0 / (1.0 + np.exp(-np.clip(diff @ w, -30, 30)))
        slope = diff.T @ (1.0 - wins) / pairs - ridge * w
        bend = (diff * (wins * (1 - wins))[:, None]).T @ diff / pairs + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    strength = z @ w
    levels = np.linspace(0.0, 1.0, 401)
    cuts = np.quantile(strength, levels)
    right = np.array([np.mean((strength >= c) == good) for c in cuts])
    cut = float(cuts[np.argmax(right >= right.max() - TOLERANCE)])
    return Ranking(mean, np.where(scale > 0, scale, 1.0), w, cut)


def first_by_hash(rows: DataFrame, count: int, hashed: str, *ties: str) -> DataFrame:
    """The first ``count`` rows by a 64-bit hash, without sorting many more.

    Hashes are even, so a bound at a share of their range leaves about that share of the rows. Should too few
    be left, the bound is moved up.
    """
    total = rows.count()
    share = 2.0 * count / max(total, 1)
    while share < 1.0:
        below = rows.where(F.col(hashed) < int(-(2**63) + share * 2**64))
        if below.count() >= count:
            rows = below
            break
        share *= 2
    return rows.orderBy(hashed, *ties).limit(count)


def fit(x: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ranking | None:
    """Learn from the labelled documents that are not held out, at most ``sample`` of them."""
    known = labels.select(labels["doc_id"].alias("_id"), labels["quality"].alias("_quality"))
    rows = (
        x.join(known.where(F.col("_quality").isin(0, 1)), F.col("doc_id") == F.col("_id"))
        .where(~held_out(F.col("doc_id")))
        .select("x", "_quality", F.xxhash64("doc_id").alias("_at"), "doc_id")
    )
    rows = first_by_hash(rows, sample, "_at", "doc_id", "_quality", "x").toPandas()
    if len(rows) == 0:
        return None
    return learn(np.array(rows["x"].tolist(), dtype=float), rows["_quality"].to_numpy() == 1)


def scored(x: DataFrame, model: Ranking | None) -> DataFrame:
    """doc_id and score for measured documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch.column("x").to_pylist(), dtype=float).reshape(batch.num_rows, -1)
            score = model.scores(rows) if model and len(rows) else np.full(len(rows), THRESHOLD)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return x.mapInArrow(run, "doc_id bigint, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of 0.7) of every document.

    The texts are read once; their measures are written and serve the fit and the scores.
    """
    x = written_table(measured(docs), "quality-measures")
    return scored(x, fit(x, labels)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score reaches the cut, with all their columns."""
    model = fit(written_table(measured(docs), "quality-measures"), labels)
    if model is None:
        return docs

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            rows = np.array([measures(t or b"")[0] for t in texts], dtype=float)
            good = model.scores(rows) >= THRESHOLD if len(rows) else []
            yield batch.filter(pa.array(good, pa.bool_()))

    at = docs.columns.index("text")
    return docs.mapInArrow(run, docs.schema)
