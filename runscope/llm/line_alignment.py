"""Operator 7: line dedup by pairwise alignment.

Documents that share lines are aligned, and the blocks of lines they have in common are deleted
from the later one (the one with the larger doc_id).

1. Every line is hashed. From every line on, and up to every line, the shortest run of consecutive lines with
   ``MIN_WORDS`` words is hashed too. Every block of that many words is covered by such runs, and whoever holds the
   block holds these runs in one piece. Each run pairs the documents that hold it with the first of them. So the
   number of pairs is linear in the lines, however many documents share one, and every line that an earlier
   document holds in a long enough block has a partner that holds it in one.
2. A pair is aligned by patience diff: equal lines at both ends, then the longest increasing sequence of
   lines that occur once in either document, and the same again between them. Where no line occurs once in both, the longest
   common run of lines, by words, is aligned, and the same again before and behind it.
3. A block is a run of aligned lines that follow each other in both documents. It is deleted if it
   has at least ``MIN_WORDS`` words; shorter ones, such as headings, stay.
4. An alignment uses every line once and keeps the order. So what is left of the later document is aligned again, until the
   longest common run of lines left has fewer than ``MIN_WORDS`` words: passages that it repeats or has in another
   order go as well. Lines that were deleted count in no further block.

The earlier document of many pairs is sent once to each group of ``TOGETHER`` or so of its later ones.
Only hashes of lines are joined and aligned; texts are read twice and moved once, to meet
the lines that go.

Defined cases: null texts stay null, empty ones empty. Rows of the same id and text are one document and get
the same result; rows of one id with different texts are ordered by a hash of the text, and documents
without id come last. Other columns pass through ``drop_common_lines`` unchanged.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from runscope.llm.sketches import mixed
from runscope.llm.texts import arrow_batch, arrow_schema, text_key, text_rows
from runscope.session import written_table

MIN_WORDS = 10
BLANK = 0
#: Later documents that meet an earlier one in one row, on average.
TOGETHER = 32
#: Common runs that are searched one in another where no line is unique; further ones are paired by their number.
RUNS_DEEP = 48
#: Hashes of runs are sums of the lines' hashes times powers of an odd number, which has an inverse.
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)

_LINES = "doc_id bigint, key bigint, hashes array<bigint>, words array<int>"
_RUNS = "document struct<unnamed:boolean,doc_id:bigint,key:bigint>, runs array<bigint>"
_RANGES = "later struct<unnamed:boolean,doc_id:bigint,key:bigint>, ranges array<struct<start:int,end:int>>"


def _longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs, ordered by their first parts, with increasing second parts."""
    tails, at, before = [], [], [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(tails, j)
        if pile == len(tails):
            tails.append(j)
            at.append(k)
        else:
            tails[pile], at[pile] = j, k
        before[k] = at[pile - 1] if pile else -1
    found, k = [], at[-1] if at else -1
    while k >= 0:
        found.append(pairs[k])
        k = before[k]
    return found[::-1]


def _longest_common_run(a: list[int], b: list[int], total: list[int]) -> tuple[int, int, int]:
    """Start in ``a``, start in ``b`` and lines of the common run with the most words; ``total`` adds up the words of b.

    A suffix automaton of ``a`` follows ``b``, so the time is linear however often lines are repeated.
    """
    step, link, size, end = [{}], [-1], [0], [0]
    last = 0
    for k, x in enumerate(a, 1):
        new, p = len(step), last
        step.append({})
        link.append(0)
        size.append(size[last] + 1)
        end.append(k)
        while p >= 0 and x not in step[p]:
            step[p][x] = new
            p = link[p]
        if p >= 0:
            q = step[p][x]
            if size[q] == size[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                size.append(size[p] + 1)
                end.append(end[q])
                while p >= 0 and step[p].get(x) == q:
                    step[p][x] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    best, state, length = (0, 0, 0, 0), 0, 0
    for k, x in enumerate(b, 1):
        while state and x not in step[state]:
            state = link[state]
            length = size[state]
        if x in step[state]:
            state, length = step[state][x], length + 1
        words = total[k] - total[k - length]
        if words > best[0]:
            best = words, end[state] - length, k - length, length
    return best[1:]


def aligned(a: list[int], b: list[int], words: list[int] | None = None, least: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Pairs of positions of equal lines, increasing in both, by patience diff.

    ``words`` of each line of b; without them a line is a block by itself.
    """
    words = [least] * len(b) if words is None else words
    found, todo = [], [(0, len(a), 0, len(b), 0)]
    while todo:
        i, i_end, j, j_end, deep = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            found.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        in_a, in_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        place = {x: k for k, x in enumerate(b[j:j_end], j) if in_b[x] == 1 and x != BLANK}
        anchors = _longest_increasing([(k, place[x]) for k, x in enumerate(a[i:i_end], i) if in_a[x] == 1 and x in place])
        if not anchors:
            # What is too short for a block needs no search.
            if sum(w for x, w in zip(b[j:j_end], words[j:j_end]) if x in in_a) < least:
                continue
            if deep < RUNS_DEEP:
                p, q, n = _longest_common_run(a[i:i_end], b[j:j_end], list(accumulate(words[j:j_end], initial=0)))
                p, q = p + i, q + j
                if sum(words[q : q + n]) < least:
                    continue
                found += zip(range(p, p + n), range(q, q + n))
                todo += [(i, p, j, q, deep + 1), (p + n, i_end, q + n, j_end, deep + 1)]
                continue
            anchors = _longest_increasing(_numbered_pairs(a, i, i_end, b, j, j_end))
        for (p, q), (p_end, q_end) in zip([(i - 1, j - 1), *anchors], [*anchors, (i_end, j_end)]):
            if p >= i:
                found.append((p, q))
            todo.append((p + 1, p_end, q + 1, q_end, deep))
    return sorted(found)


def _numbered_pairs(a: list[int], i: int, i_end: int, b: list[int], j: int, j_end: int) -> list[tuple[int, int]]:
    """The first occurrence of a line in one document with the first in the other, the second with the second, and so on."""
    seen: Counter = Counter()
    place = {}
    for k, x in enumerate(b[j:j_end], j):
        place[x, seen[x]] = k
        seen[x] += 1
    seen.clear()
    pairs = []
    for k, x in enumerate(a[i:i_end], i):
        if x != BLANK and (x, seen[x]) in place:
            pairs.append((k, place[x, seen[x]]))
        seen[x] += 1
    return pairs


def aligned_blocks(a: list[int], b: list[int], words: list[int], least: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """Start in ``a``, start in ``b`` and lines of the pieces that are aligned and have at least ``least`` words."""
    blocks: list[list[int]] = []
    last = None
    for i, j in aligned(a, b, words, least):
        if last and (i, j) == (last[0] + 1, last[1] + 1):
            blocks[-1][2] += 1
        else:
            blocks.append([i, j, 1])
        last = (i, j)
    return [(i, j, n) for i, j, n in blocks if sum(words[j : j + n]) >= least]


def common_blocks(a: list[int], b: list[int], words: list[int], least: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Ranges of lines of ``b`` that alignments with ``a`` take in blocks (``words`` of each line of b)."""
    least, in_a = max(1, least), set(a) - {BLANK}
    left, gone = list(b), np.zeros(len(b), dtype=bool)
    while sum(w for x, w in zip(left, words) if x in in_a) >= least:
        blocks = aligned_blocks(a, left, words, least)
        if not blocks:
            # Short lines that keep the order may have stood against a block that does not.
            i, j, n = _longest_common_run(a, left, list(accumulate(words, initial=0)))
            if sum(words[j : j + n]) < least:
                break
            blocks = [(i, j, n)]
        now = _repetitions(np.array(b, dtype=np.int64), np.array(words, dtype=np.int64), blocks, gone, least)
        for _, j, n in blocks:
            now[j : j + n] = True
        for k in np.flatnonzero(now).tolist():
            # Equal to no line.
            left[k] = (1 << 64) + k
        gone |= now
    turns = np.diff(np.concatenate(([0], gone, [0])).astype(np.int8))
    return list(zip(np.nonzero(turns == 1)[0].tolist(), np.nonzero(turns == -1)[0].tolist()))


def _repetitions(b: np.ndarray, words: np.ndarray, blocks: list, gone: np.ndarray, least: int) -> np.ndarray:
    """Lines of b not gone yet that repeat parts of the blocks just aligned: all at once, not one in each alignment."""
    now = np.zeros(len(b), dtype=bool)
    inside = now.copy()
    for _, j, n in blocks:
        inside[j : j + n] = True
    held = np.isin(b, b[inside & (b != BLANK)])
    if not (held & ~inside & ~gone).any():
        return now
    known = np.concatenate([runs(b[j : j + n], words[j : j + n], least)[2] for _, j, n in blocks])
    turns = np.diff(np.concatenate(([0], ~gone, [0])).astype(np.int8))
    for s, e in zip(np.nonzero(turns == 1)[0].tolist(), np.nonzero(turns == -1)[0].tolist()):
        starts, ends, keys = runs(b[s:e], words[s:e], least)
        for k in np.flatnonzero(np.isin(keys, known)).tolist():
            now[s + starts[k] : s + ends[k]] = True
    return now


def runs(hashes: np.ndarray, words: np.ndarray, least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of the shortest runs of lines with ``least`` words: from every line on, and up to every line."""
    n, least = len(words), max(1, least)
    total = np.concatenate(([0], np.cumsum(words, dtype=np.int64)))
    end = np.searchsorted(total, total[:-1] + least)
    start = np.searchsorted(total, total[1:] - least, side="right") - 1
    at = np.arange(n + 1)
    starts = np.concatenate((at[:-1][end <= n], start[start >= 0]))
    ends = np.concatenate((end[end <= n], at[1:][start >= 0]))
    terms = mixed(hashes.view(np.uint64) + np.uint64(_STEP)) * np.cumprod(np.full(n, _STEP, dtype=np.uint64))
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(terms, dtype=np.uint64)))
    back = np.concatenate((np.ones(1, dtype=np.uint64), np.cumprod(np.full(n, _BACK, dtype=np.uint64))))
    keys = mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    return starts, ends, keys.view(np.int64)


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, key (hash of the text), and hash and number of words of every line."""
    schema = arrow_schema(_LINES)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, words = [], []
            for text in batch.column("_text").to_pylist():
                cut = [line.strip() for line in text.split(b"\n")]
                hashes.append(np.array([xxhash.xxh64_intdigest(x) if x else BLANK for x in cut], np.uint64).view(np.int64))
                words.append([len(x.split()) for x in cut])
            yield arrow_batch([batch.column("doc_id"), batch.column("key"), hashes, words], schema)

    rows = docs.select(docs["doc_id"], text_key(docs["text"]).alias("key"), docs["text"])
    return text_rows(rows, "doc_id", "key").mapInArrow(run, _LINES)


def _document() -> Column:
    """Orders documents: by id, those without one last, then by text."""
    return F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")


def _pairs(documents: DataFrame, min_words: int) -> DataFrame:
    """Distinct pairs (later, earlier): of each run of ``min_words`` words every later document with the first."""
    schema = arrow_schema(_RUNS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("hashes"), batch.column("words"))
            found = [np.unique(runs(np.asarray(h.values), np.asarray(w.values), min_words)[2]) for h, w in both]
            yield arrow_batch([batch.column("document"), found], schema)

    held = documents.mapInArrow(run, _RUNS).select(F.explode("runs").alias("run"), "document")
    shared = written_table(
        held.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.min("document").alias("first")).where("n > 1").drop("n"),
        "shared-runs",
    )
    holders = held.join(shared.withColumnRenamed("run", "_run"), F.col("run") == F.col("_run"))
    return (
        holders.where(F.col("document") != F.col("first"))
        .select(F.col("document").alias("later"), F.col("first").alias("earlier"))
        .distinct()
    )


def common_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, key and the ranges of lines to delete, of documents that lose some."""
    schema = arrow_schema(_RANGES)
    documents = written_table(lines(docs).distinct().withColumn("document", _document()), "lines")
    pairs = written_table(_pairs(documents, min_words), "line-pairs")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, group in zip(batch.column("a").to_pylist(), batch.column("group").to_pylist()):
                found = [(d["later"], common_blocks(a, d["b"], d["words"], min_words)) for d in group]
                found = [(later, [{"start": s, "end": e} for s, e in ranges]) for later, ranges in found if ranges]
                if found:
                    yield arrow_batch(zip(*found), schema)

    first = documents.select(F.col("document").alias("_a"), F.col("hashes").alias("a"))
    second = documents.select(F.col("document").alias("_b"), F.col("hashes").alias("b"), "words")
    # Later documents are dealt by their number for each earlier one, which then travels once to every group. Those with few are one group.
    many = pairs.groupBy("earlier").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > TOGETHER)
    many = written_table(many.withColumnRenamed("earlier", "_earlier"), "much-shared-documents")
    parts = F.coalesce(F.ceil(F.col("_n") / TOGETHER), F.lit(1))
    dealt = pairs.join(many, F.col("earlier") == F.col("_earlier"), "left").select(
        "later", "earlier", F.pmod(F.xxhash64("later"), parts).alias("_part")
    )
    groups = (
        dealt.join(second, F.col("later") == F.col("_b"))
        .groupBy("earlier", "_part")
        .agg(F.collect_list(F.struct("later", "b", "words")).alias("group"))
    )
    met = groups.join(first, F.col("earlier") == F.col("_a")).select("a", "group")
    return (
        met.mapInArrow(run, _RANGES)
        .select("later", F.explode("ranges").alias("range"))
        .groupBy("later")
        .agg(F.sort_array(F.collect_set("range")).alias("ranges"))
        .select("later.doc_id", "later.key", "ranges")
    )


def clean(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with all their columns, and ``_runscope_lines``, ``_runscope_removed``, ``_runscope_text``: number of
    lines, number of removed lines, text without them."""
    gone = written_table(common_lines(docs, min_words), "common-lines")
    gone = gone.select(F.col("doc_id").alias("_runscope_id"), F.col("key").alias("_runscope_gone"), F.col("ranges").alias("_runscope_ranges"))
    keyed = docs.withColumn("_runscope_key", text_key(docs["text"]))
    same = F.col("doc_id").eqNullSafe(F.col("_runscope_id")) & (F.col("_runscope_key") == F.col("_runscope_gone"))
    cut = F.split("text", "\n", -1)
    left = F.filter(cut, lambda line, i: ~F.exists("_runscope_ranges", lambda r: (r["start"] <= i) & (i < r["end"])))
    joined = keyed.join(gone, same, "left").withColumn("_runscope_left", F.when(F.col("_runscope_ranges").isNotNull(), left))
    lost = F.col("_runscope_ranges").isNotNull()
    return joined.select(
        *docs.columns,
        F.coalesce(F.size(cut), F.lit(0)).cast("long").alias("_runscope_lines"),
        F.when(lost, F.size(cut) - F.size("_runscope_left")).otherwise(0).cast("long").alias("_runscope_removed"),
        F.when(lost, F.array_join("_runscope_left", "\n")).otherwise(F.col("text")).alias("_runscope_text"),
    )


def summarise(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, number of lines and of removed ones, and length and hash of the remaining text."""
    done = clean(docs.select("doc_id", "text"), min_words)
    return done.select(
        "doc_id",
        F.col("_runscope_lines").alias("n_lines"),
        F.col("_runscope_removed").alias("n_removed"),
        F.coalesce(F.length("_runscope_text"), F.lit(0)).cast("long").alias("n_chars"),
        F.sha2(F.coalesce("_runscope_text", F.lit("")), 256).alias("text_sha256"),
    )


def drop_common_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with their remaining text; those of which nothing but blanks remains go."""
    done = clean(docs, min_words)
    emptied = (F.col("_runscope_removed") > 0) & (F.trim(F.regexp_replace("_runscope_text", r"[\x09-\x0D]", " ")) == "")
    return done.where(~emptied | F.col("_runscope_text").isNull()).select(
        *[(F.col("_runscope_text") if c == "text" else F.col(c)).alias(c) for c in docs.columns]
    )
