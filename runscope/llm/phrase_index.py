"""Operator 2: benchmark decontamination with a distributed positional inverted index.

*Index.* Documents are gathered into blocks of about ``BLOCK_WORDS`` words. The words of a
block are numbered through, with one number left out between documents, so that no
phrase reaches across. One row per block and term holds the sorted positions; the row of the
empty term holds the positions at which documents begin. The index covers every word of
every document and is stored as a table; it can serve any number of test sets.

*Search.* A test item is cut into windows of ``WINDOW`` consecutive words. The terms of a
window are ordered by their number of occurrences in the corpus, the rarest first. The rarest one
finds the blocks and the possible places; only there the lists of the others are brought in
by block and intersected, shifted by their offset in the window, until nothing or an exact
phrase is left. A block intersects all its windows at once, term by term in the order of rarity. With ``slack``
the same lists also give proximity matches: all words of
a window, in any order, within the window's length plus ``slack`` words to either side of the rarest one, in one document.

Terms wanted by the test set are numbered and joined to the index as a table; Spark broadcasts it
only if its size allows. Which items have a window is a table of its own, joined to what was found.
Blocks are units of bounded size, whatever sources or copies they hold.

Defined cases: null and empty texts have no words, are never contaminated and match nothing.
Items of fewer words than a window are one window. Items without an id count as hits, but
are not listed. Rows are followed by their place in the index, so repeated rows and null
ids get results of their own. Empty tables give empty or all-clean results; extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from runscope.llm.texts import arrow_batch, arrow_schema, plain_words, text_key, text_rows
from runscope.session import written_table

WINDOW = 10
SLACK = 5
BLOCK_WORDS = 500_000
#: Places of rarest terms that a block follows up at once.
ANCHORS = 500_000
#: Its positions are those at which documents begin; no word is empty.
STARTS = b""

_INDEX = "block bigint, term binary, n int, positions array<int>, doc_ids array<bigint>, lengths array<int>"


def _block_rows(block: int, ids: list[int | None], lengths: list[int], numbers: list[np.ndarray], terms: dict, schema):
    """Rows of one block: the documents under ``STARTS``, then one row per term."""
    sizes = np.array(lengths, dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    words = np.concatenate(numbers)
    places = np.arange(len(words)) + np.repeat(np.arange(len(sizes)), sizes)
    ordered = np.sort((words << 32) | places)
    counts = np.bincount(words, minlength=len(terms)).astype(np.int64)
    n = np.concatenate(([len(sizes)], counts))
    positions = np.concatenate((starts, ordered & 0xFFFFFFFF)).astype(np.int32)
    lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(n))).astype(np.int32), pa.array(positions))
    rest = [None] * len(terms)
    return arrow_batch(
        [
            pa.array(np.full(len(n), block)), pa.array([STARTS, *terms], pa.binary()), pa.array(n.astype(np.int32)), lists,
            [ids, *rest], [lengths, *rest],
        ],
        schema,
    )


def build_index(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Write the positional index of all documents and return it as a table."""
    schema = arrow_schema(_INDEX)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        terms: dict[bytes, int] = {}
        ids, lengths, numbers, held = [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("_text").to_pylist()):
                words = plain_words(text)
                numbers.append(np.fromiter((terms.setdefault(w, len(terms)) for w in words), np.int64, len(words)))
                ids.append(doc_id)
                lengths.append(len(words))
                held += len(words)
                if held >= block_words:
                    yield _block_rows(block, ids, lengths, numbers, terms, schema)
                    block, terms, ids, lengths, numbers, held = block + 1, {}, [], [], [], 0
        if ids:
            yield _block_rows(block, ids, lengths, numbers, terms, schema)

    return written_table(text_rows(docs, "doc_id").mapInArrow(run, _INDEX), "phrase-index")


def windows(items: DataFrame, length: int = WINDOW) -> DataFrame:
    """The windows of the items: item and terms."""
    out = arrow_schema("item string, terms array<binary>")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, found = [], []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("_text").to_pylist()):
                words = plain_words(text)
                cut = [words[i : i + length] for i in range(max(1, len(words) - length + 1))] if words else []
                names += [item] * len(cut)
                found += cut
            yield arrow_batch([names, found], out)

    rows = text_rows(items.select(items["item_id"].cast("string").alias("item"), "text"), "item")
    return rows.mapInArrow(run, "item string, terms array<binary>")


def _rarest_first(cut: DataFrame, postings: DataFrame, numbers: DataFrame) -> DataFrame:
    """Windows whose terms all occur, with the terms' numbers and offsets in the order of rarity."""
    frequency = postings.groupBy("number").agg(F.sum("n").alias("n")).join(numbers, "number")
    listed = cut.select("window", F.size("terms").alias("size"), F.posexplode("terms").alias("offset", "term"))
    return (
        listed.join(frequency, "term")
        .groupBy("window", "size")
        .agg(F.sort_array(F.collect_list(F.struct("n", "offset", "number"))).alias("order"))
        .where(F.size("order") == F.col("size"))
        .select("window", "order.number", "order.offset", F.get("order.number", F.lit(0)).alias("rarest"))
    )


class _Lists:
    """The position lists of one block, as one sorted array of term and position."""

    def __init__(self, numbers: np.ndarray, lists: pa.ListArray):
        order = np.argsort(numbers)
        self.numbers = numbers[order]
        lists = lists.take(pa.array(order))
        self.counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        self.positions = lists.flatten().to_numpy().astype(np.int64)
        self._keys = (np.repeat(np.arange(len(order)), self.counts) << 32) | self.positions

    def places(self, numbers: np.ndarray) -> np.ndarray:
        """Places of terms among those of the block, -1 for others."""
        at = np.minimum(np.searchsorted(self.numbers, numbers), len(self.numbers) - 1)
        return np.where(self.numbers[at] == numbers, at, -1)

    def any_between(self, terms: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether each term has a position from ``low`` to ``high``."""
        at = np.searchsorted(self._keys, (terms << 32) | low)
        return (at < len(self._keys)) & (self._keys[np.minimum(at, len(self._keys) - 1)] <= ((terms << 32) | high))


def _search_block(lists: _Lists, starts: np.ndarray, ends: np.ndarray, rows: pa.Table, slack: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Place of the document, window, start, end and exactness of the matches in one block."""
    window = rows.column("window").to_numpy()
    term_lists, offset_lists = (rows.column(c).combine_chunks() for c in ("number", "offset"))
    sizes = term_lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    terms, offsets = lists.places(term_lists.flatten().to_numpy()), offset_lists.flatten().to_numpy().astype(np.int64)
    there = np.flatnonzero(np.minimum.reduceat(terms, first) >= 0)
    n_anchors = lists.counts[terms[first[there]]]
    parts = np.cumsum(n_anchors) // ANCHORS
    for part in np.unique(parts):
        chosen, n = there[parts == part], n_anchors[parts == part]
        of = np.repeat(chosen, n)
        inside = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        anchor = lists.positions[lists.first[terms[first[of]]] + inside]
        document = np.searchsorted(starts, anchor, side="right") - 1
        size = sizes[of]
        begin = anchor - offsets[first[of]]
        low = np.maximum(anchor - size - slack, starts[document])
        high = np.minimum(anchor + size + slack, ends[document] - 1)
        exact, near = begin >= starts[document], np.ones(len(of), dtype=bool)
        for k in range(1, int(size.max(initial=1))):
            alive = np.flatnonzero(near & (size > k))
            at = first[of[alive]] + k
            near[alive] = lists.any_between(terms[at], low[alive], high[alive])
            exact &= near
            alive = np.flatnonzero(exact & (size > k))
            at = first[of[alive]] + k
            place = begin[alive] + offsets[at]
            exact[alive] = lists.any_between(terms[at], place, place)
        # Of the places near each other in a document the first one tells that there is one.
        found = np.flatnonzero(exact)
        close = np.flatnonzero(near & ~exact)
        pairs, firsts = np.unique(np.stack([document[close], of[close]]), axis=1, return_index=True)
        close = close[firsts]
        base_exact, base_close = starts[document[found]], starts[document[close]]
        yield document[found], window[of[found]], begin[found] - base_exact, begin[found] - base_exact + size[found], np.ones(len(found), bool)
        yield document[close], window[of[close]], low[close] - base_close, high[close] - base_close + 1, np.zeros(len(close), bool)


_MATCHES = "block bigint, place int, window bigint, start int, end int, exact boolean"


def search(index: DataFrame, items: DataFrame, length: int = WINDOW, slack: int = SLACK) -> tuple[DataFrame, DataFrame]:
    """Matches by block and place of the document in it, and the items of every window.

    Of an exact match start and end are the words of the document it covers. Of proximity matches a document has one for every window;
    start and end are the stretch around the first rarest term that has all the others.
    """
    raw = written_table(windows(items, length), "windows")
    cut = written_table(raw.select("terms").distinct().withColumn("window", F.monotonically_increasing_id()), "distinct-windows")
    of_items = written_table(raw.join(cut, "terms").select("window", "item").distinct(), "window-items")
    distinct_terms = cut.select(F.explode("terms").alias("term")).distinct()
    numbers = written_table(distinct_terms.withColumn("number", F.monotonically_increasing_id()), "window-terms")
    postings = index.select("block", "term", "n", "positions").join(numbers, "term").select("block", "number", "n", "positions")
    ranked = written_table(_rarest_first(cut, postings, numbers), "ranked-windows")
    present = index.select("block", "term").join(numbers, "term").select("block", F.col("number").alias("_rarest"))
    asked = present.join(ranked, F.col("_rarest") == F.col("rarest")).select(F.col("block").alias("in_block"), "window", "number", "offset")
    texts = index.where(F.col("term") == F.lit(STARTS))
    starts, lengths = (
        texts.select("block", F.lit(number).cast("bigint").alias("number"), F.col(c).alias("positions"))
        for number, c in ((-1, "positions"), (-2, "lengths"))
    )
    brought = postings.select("block", "number", "positions").unionByName(starts).unionByName(lengths)
    out = arrow_schema(_MATCHES)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_batches([], schema=out)
        block = left.column("in_block")[0].as_py()
        numbers, lists = right.column("number").to_numpy(), right.column("positions").combine_chunks()
        starts, sizes = (lists[int(np.flatnonzero(numbers == n)[0])].values.to_numpy().astype(np.int64) for n in (-1, -2))
        words = np.flatnonzero(numbers >= 0)
        if not len(words):
            return pa.Table.from_batches([], schema=out)
        lists = _Lists(numbers[words], lists.take(pa.array(words)))
        batches = [
            arrow_batch([pa.array(np.full(len(found[0]), block)), *map(pa.array, found)], out)
            for found in _search_block(lists, starts, starts + sizes, left, slack)
        ]
        return pa.Table.from_batches(batches, schema=out)

    return asked.groupBy("in_block").cogroup(brought.groupBy("block")).applyInArrow(run, _MATCHES), of_items


def _covered(spans: Column) -> Column:
    """Number of words in a sorted array of start and end."""
    zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("reached"))

    def add(state: Column, span: Column) -> Column:
        new = F.greatest(span["end"] - F.greatest(span["start"], state["reached"]), F.lit(0))
        return F.struct((state["total"] + new).alias("total"), F.greatest(state["reached"], span["end"]).alias("reached"))

    return F.aggregate(spans, zero, add, lambda state: state["total"])


def _documents(index: DataFrame) -> DataFrame:
    return index.where(F.col("term") == F.lit(STARTS)).select(
        "block", F.posexplode(F.arrays_zip("doc_ids", "lengths")).alias("place", "doc")
    )


def match_rows(
    docs: DataFrame, items: DataFrame, length: int = WINDOW, slack: int = SLACK, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """doc_id, item, start, end (words of the document from 0, end exclusive) and kind: exact or near."""
    index = build_index(docs, block_words)
    matches, of_items = search(index, items, length, slack)
    # Windows of one item may have the same stretch.
    named = matches.join(of_items, "window").drop("window").distinct().join(_documents(index), ["block", "place"])
    kind = F.when(F.col("exact"), "exact").otherwise("near").alias("kind")
    return named.select(F.col("doc.doc_ids").alias("doc_id"), "item", F.col("start").cast("long"), F.col("end").cast("long"), kind)


def contamination(
    docs: DataFrame, items: DataFrame, length: int = WINDOW, slack: int = SLACK, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Per document the words hit by windows of the items, and the items found.

    ``n_near`` counts the items with a proximity match; an exact match is one.
    """
    index = build_index(docs, block_words)
    matches, of_items = search(index, items, length, slack)
    matches = written_table(matches, "phrase-matches")
    covered = (
        matches.where("exact").groupBy("block", "place")
        .agg(_covered(F.sort_array(F.collect_set(F.struct("start", "end")))).cast("bigint").alias("n_hit"))
    )
    listed = (
        matches.select("block", "place", "window", "exact").distinct().join(of_items, "window")
        .groupBy("block", "place")
        .agg(
            F.sort_array(F.collect_set(F.when(F.col("exact"), F.col("item")))).alias("items"),
            F.countDistinct("item").alias("n_near"),
        )
    )
    none = F.array().cast("array<string>")
    joined = _documents(index).join(covered, ["block", "place"], "left").join(listed, ["block", "place"], "left")
    joined = joined.withColumn("items", F.coalesce("items", none))
    return joined.select(
        F.col("doc.doc_ids").alias("doc_id"),
        F.col("doc.lengths").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        "items",
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """The documents without any word hit, with all their columns.

    Contaminated documents are found by id and text: rows that share an id but not
    their text are judged each for itself.
    """
    texts = docs.select(text_key(docs["text"]).alias("doc_id"), "text")
    found = contamination(texts, items, length).where("contaminated").select(F.col("doc_id").alias("_runscope_dirty"))
    dirty = written_table(found.distinct(), "contaminated")
    keyed = docs.withColumn("_runscope_key", text_key(docs["text"]))
    return keyed.join(dirty, F.col("_runscope_key") == F.col("_runscope_dirty"), "left_anti").select(*docs.columns)
