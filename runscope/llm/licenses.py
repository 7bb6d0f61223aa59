"""Operator 5: licence scan by ordered signature rules.

A text is reduced to its words. A rule is tried only if its keyword is among them. The
matches of all rules are intervals of words; a match that lies inside another one of the
same or a higher priority is suppressed, and of equal intervals the rule listed first
stays. The base phrases are found in any case and never suppressed.

The score is ``1 - prod(1 - w)`` over the labels found, with the weight ``w`` of the highest
priority among a label's matches.

Defined cases: a null text is an empty one; without a finding the places are null, the
labels empty and the score 0. Repeated rows give repeated results, a null ``doc_id`` is
passed on. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict

from pyspark.sql import DataFrame

from runscope.llm.license_rules import BASE, RULES
from runscope.llm.texts import map_texts, plain_words, text_rows

WEIGHTS = {1: 0.3, 2: 0.7, 3: 0.9}
_TOP = max(WEIGHTS)

_SCHEMA = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
    "score double, detections string"
)
_NOTHING = (0, None, None, "", "", 0.0, "")


def _compiled(rules: list[tuple[str, int, str, str]]) -> dict[bytes, list[tuple[int, str, int, re.Pattern]]]:
    """Rules by keyword, with their place in the order."""
    by_keyword = defaultdict(list)
    for order, (label, priority, keyword, expression) in enumerate(rules):
        whole = re.compile(rb"(?<![^ ])(?:" + expression.encode() + rb")(?![^ ])")
        by_keyword[keyword.encode()].append((order, label, priority, whole))
    return dict(by_keyword)


_BY_KEYWORD = _compiled(RULES)
_KEYWORDS = frozenset(_BY_KEYWORD)
_BASE = {
    phrase.split()[-1].encode(): (re.compile(rb"(?<![^ ])" + phrase.encode() + rb"(?![^ ])"), label)
    for phrase, label in BASE.items()
}
_BASE_WORDS = frozenset(_BASE)


def unsuppressed(found: list[tuple[int, int, int, int, str]]) -> list[tuple[int, int, str, int]]:
    """``found``: start, end, priority, order, label. Returns start, end, label, priority.

    In this order every interval that contains another one comes before it, so the
    farthest end seen per priority tells whether an interval is contained.
    """
    reach, kept = [-1] * (_TOP + 1), []
    for start, end, priority, _, label in sorted(found, key=lambda f: (f[0], -f[1], -f[2], f[3])):
        if max(reach[priority:]) < end:
            kept.append((start, end, label, priority))
        reach[priority] = max(reach[priority], end)
    return kept


class _Words:
    """Turns offsets in the joined words into word numbers; offsets must not decrease."""

    def __init__(self, joined: bytes):
        self._joined, self._at, self._word = joined, 0, 0

    def number(self, offset: int) -> int:
        self._word += self._joined.count(b" ", self._at, offset)
        self._at = offset
        return self._word


def scan(text: bytes) -> tuple:
    words = plain_words(text)
    present = set(words)
    keywords, phrases = present & _KEYWORDS, present & _BASE_WORDS
    if not keywords and not phrases:
        return (len(words), *_NOTHING)
    joined = b" ".join(words)
    base, offsets = [], []
    for word in phrases:
        expression, label = _BASE[word]
        base += [(m.start(), label) for m in expression.finditer(joined)]
    for word in keywords:
        for order, label, priority, expression in _BY_KEYWORD[word]:
            offsets += [(m.start(), m.end(), priority, order, label) for m in expression.finditer(joined)]
    if not base and not offsets:
        return (len(words), *_NOTHING)
    kept = unsuppressed(offsets)
    edges = sorted({o for o, _ in base} | {x for s, e, *_ in kept for x in (s, e)})
    walk = _Words(joined)
    number = {o: walk.number(o) for o in edges}
    places = [number[o] for o, _ in base]
    base_labels = {label for _, label in base}
    weight = dict.fromkeys(base_labels, WEIGHTS[2])
    for _, _, label, priority in kept:
        weight[label] = max(weight.get(label, 0.0), WEIGHTS[priority])
    doubt = 1.0
    for label in sorted(weight):
        doubt *= 1.0 - weight[label]
    return (
        len(words),
        len(base),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(base_labels)),
        ",".join(sorted(weight)),
        1.0 - doubt,
        ",".join(f"{label}:{number[s]}:{number[e] + 1}" for s, e, label, _ in kept),
    )


def find_licenses(docs: DataFrame) -> DataFrame:
    """Base places, labels, score and detections (label:first word:word after the last) of every document."""
    return map_texts(text_rows(docs, "doc_id"), scan, _SCHEMA, "doc_id bigint")
