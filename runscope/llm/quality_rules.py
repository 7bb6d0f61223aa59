"""Operator 4: quality rules whose cutoffs come with a guarantee (risk control).

Every rule compares a measure of the text with a cutoff. Labelled documents of label 1
are the holdout: for each stratum (language) and rule the cutoffs are tested from the
most lenient to the strictest. A cutoff passes if the exact binomial test rejects "the rule
refuses more than ``alpha`` of the good documents of this stratum", that is if
``P(Binomial(n, alpha) <= refused)`` is at most ``delta`` divided by the number of rules
and strata (Bonferroni). Within one rule the tests stop at the first cutoff that fails
(fixed-sequence testing), which needs no further correction. Among the cutoffs that passed
the one is used that refuses most documents of label 0 less those of label 1, the most
lenient of them on a tie; a rule whose cutoffs gain nothing refuses nothing. With probability
``1 - delta`` no rule refuses more than ``alpha`` of the good documents of any stratum.

Defined cases: a null text has no words. A null language is a stratum of its own, and so is
a language without labels, where only the base rule applies. A null ``doc_id`` has no label. A document
with several label rows counts with each. Repeated rows give repeated results. Extra
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from runscope.llm.texts import map_texts, text_rows
from runscope.session import written_table

ALPHA = 0.005
DELTA = 0.05

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SYMBOLS = b"#*$%&|<>"
_SPACE = b"\t\n\x0b\x0c\r "
_CONTINUATION = bytes(range(0x80, 0xC0))
_STATS = "n_words bigint, word_chars bigint, n_symbols bigint, n_lines bigint, n_dup_lines bigint, n_repeat_words bigint, n_upper bigint, n_letters bigint, n_bangs bigint"

# Cutoffs from lenient to strict; a rule refuses values above (or below) its cutoff.
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols_per_word": ("above", [2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1]),
    "dup_line_share": ("above", [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2]),
    "repeat_word_share": ("above", [0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15]),
    "upper_share": ("above", [0.98, 0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3]),
    "bangs_per_word": ("above", [2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2]),
    "mean_word_above": ("above", [30.0, 20.0, 15.0, 12.0, 11.0, 10.0, 9.0, 8.5]),
    "mean_word_below": ("below", [1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.25]),
}


def _repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice in the text."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    seq = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    if len(ids) == n:
        return 0
    if len(ids) < 1 << 21:
        windows = (seq[:-2] << 42) | (seq[1:-1] << 21) | seq[2:]
    else:  # number the pairs first, so that a window still fits one integer
        _, pairs = np.unique((seq[:-2] << 32) | seq[1:-1], return_inverse=True)
        windows = (pairs.astype(np.int64) << 32) | seq[2:]
    _, where, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[where] > 1
    inside = np.zeros(n, dtype=bool)
    for shift in range(3):
        inside[shift : n - 2 + shift] |= again
    return int(inside.sum())


def _count(text: bytes, characters: bytes) -> int:
    return len(text) - len(text.translate(None, characters))


def statistics(text: bytes) -> tuple[int, ...]:
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    upper = _count(text, _UPPER)
    return (
        len(words),
        len(text.translate(None, _SPACE + _CONTINUATION)),
        _count(text, _SYMBOLS),
        len(lines),
        len(lines) - len(set(lines)),
        _repeated_words(words),
        upper,
        upper + _count(text, _UPPER.lower()),
        _count(text, b"!?"),
    )


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the counts of every text."""
    rows = text_rows(docs.select("doc_id", docs["lang"].cast("string").alias("lang"), "text"), "doc_id", "lang")
    return map_texts(rows, statistics, _STATS, "doc_id bigint, lang string")


def _value(rule: str) -> Column:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_word_share": F.col("n_repeat_words") / words,
        "upper_share": F.col("n_upper") / F.greatest(F.col("n_letters"), F.lit(1)),
        "bangs_per_word": F.col("n_bangs") / words,
        "mean_word_above": F.col("word_chars") / words,
        "mean_word_below": F.col("word_chars") / words,
    }[rule]


def _refused(rule: str, cutoff: Column) -> Column:
    return _value(rule) > cutoff if RULES[rule][0] == "above" else _value(rule) < cutoff


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= k), exact up to rounding.

    Where k lies below the mean the terms shrink quickly downwards from k; the sum stops
    when they no longer count. At or above the mean the tail is near or over one half,
    which no test accepts, and 1 is returned.
    """
    if k >= n * p:
        return 1.0
    term = math.exp(
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    )
    total = 0.0
    for j in range(k, -1, -1):
        total += term
        if term < total * 1e-17:
            break
        term *= j * (1 - p) / ((n - j + 1) * p)
    return total


def certified(refused: list[int], n: int, alpha: float, level: float) -> int:
    """How many cutoffs pass before the first failed test."""
    for j, k in enumerate(refused):
        if binomial_tail(int(k), n, alpha) > level:
            return j
    return len(refused)


def best_cutoff(good: list[int], bad: list[int], n: int, alpha: float, level: float) -> int | None:
    """Index of the certified cutoff with the largest gain, the first of equals; None without a gain."""
    gains = [int(b) - int(g) for g, b in zip(good[: certified(good, n, alpha, level)], bad)]
    return gains.index(max(gains)) if gains and max(gains) > 0 else None


def cutoffs(stats: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per stratum with a cutoff, or null, for each rule.

    One aggregation counts the labelled documents that every cutoff would refuse; the tests
    run on the rows of strata. Only the number of strata comes to the driver.
    """
    known = labels.where(F.col("quality").isin(0, 1)).select(labels["doc_id"].alias("_id"), (F.col("quality") == 1).alias("_good"))
    held = stats.join(known, F.col("doc_id") == F.col("_id"))

    def refused(good: Column) -> list[Column]:
        return [F.array(*[F.count_if(good & _refused(r, F.lit(c))) for c in grid]) for r, (_, grid) in RULES.items()]

    counts = written_table(
        held.groupBy("lang").agg(
            F.count_if("_good").alias("n"),
            *[c.alias(f"good_{r}") for c, r in zip(refused(F.col("_good")), RULES)],
            *[c.alias(f"bad_{r}") for c, r in zip(refused(~F.col("_good")), RULES)],
        ),
        "rule-counts",
    )
    level = delta / (len(RULES) * max(1, counts.count()))

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = {"stratum": frame["lang"]}
            for rule, (_, grid) in RULES.items():
                at = [
                    best_cutoff(good, bad, n, alpha, level)
                    for good, bad, n in zip(frame[f"good_{rule}"], frame[f"bad_{rule}"], frame["n"])
                ]
                out[rule] = pd.Series([None if j is None else grid[j] for j in at], index=frame.index, dtype="float64")
            yield pd.DataFrame(out)

    return counts.mapInPandas(choose, "stratum string, " + ", ".join(f"{r} double" for r in RULES))


def apply_rules(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Counts and verdict of every document; ``refused_by`` lists the rules that refused it."""
    stats = written_table(text_statistics(docs), "rule-statistics")
    chosen = written_table(cutoffs(stats, labels, alpha, delta), "rule-cutoffs")
    refused = F.array_compact(
        F.array(*[F.when(_refused(r, F.col(f"_c.{r}")), F.lit(r)) for r in RULES])
    )
    limits = chosen.select("stratum", F.struct(*RULES).alias("_c"))
    return (
        stats.join(limits, F.col("lang").eqNullSafe(F.col("stratum")), "left")
        .withColumn("refused_by", F.array_join(refused, ","))
        .withColumn("base_failed", base_failed())
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            (~F.col("base_failed") & (F.col("refused_by") == "")).alias("kept"), "refused_by",
        )
    )
