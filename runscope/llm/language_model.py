"""Operator 6: language-model scores from a weighted backoff automaton.

*Model.* n-gram counts of all training documents, smoothed with a Dirichlet prior (MacKay
and Peto, "A Hierarchical Dirichlet Language Model", 1995): with context ``h``, ``h'`` being ``h`` without its
first word, ``P(w|h) = (c(hw) + MU * P(w|h')) / (c(h) + MU)``, and at the root
``P(w) = (c(w) + 1) / (N + V + 1)``. As an automaton, each n-gram seen in training as a
context is a state. An n-gram ``hw`` seen in training is an arc from ``h`` to the
longest suffix of ``hw`` that is a state, weighted ``log10 P(w|h)``. Every other state has a failure
arc to ``h'``, weighted ``log10(MU / (c(h) + MU))``, which consumes nothing. A text is read once
from left to right, from the state of the text's start to its end token.

*Distribution.* The model grows with the corpus, so no machine holds it. Documents are
gathered into chunks of bounded size, written once with their words numbered. Every chunk asks for the
counts of its own distinct n-grams; the questions are dealt by hash of the n-gram, so
each n-gram is added up in one place, after each chunk has pre-counted it, and the total
goes back to the chunks that asked. A chunk then has all states and arcs that its texts can
touch and walks them. Frequent n-grams cost one entry per chunk, never one per occurrence.

n-grams are told apart by 64-bit hashes of their words.

Defined cases: a null text is an empty one, which consists of the end token. A null ``doc_id`` is
not held out. Repeated rows count and are scored each. Without training documents every
token has probability 1. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from runscope.llm.quality_classifier import held_out
from runscope.llm.texts import arrow_batch, arrow_schema, packed_table, spaced_words, text_rows

ORDER = 2
MU = 4.0
CHUNK_TOKENS = 600_000
BUCKET_KEYS = 500_000

# No word contains white space, so no word has these hashes' texts.
_START, _END = (np.uint64(xxhash.xxh64_intdigest(mark)) for mark in (b"\nstart", b"\nend"))
_CHUNK = (
    "chunk bigint, doc_ids array<bigint>, held array<boolean>, lengths array<int>, words array<bigint>, "
    "tokens array<int>"
)
_ASKED = "chunk bigint, level int, bucket bigint, keys array<bigint>, counts array<int>"
_TOLD = "chunk bigint, level int, bucket bigint, totals array<bigint>"
_SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
)


def chunked(docs: DataFrame, parts: int = 7, tokens: int = CHUNK_TOKENS) -> DataFrame:
    """Write the documents as chunks of about ``tokens`` tokens with numbered words."""
    schema = arrow_schema(_CHUNK)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        number: dict[bytes, int] = {}
        ids, held, texts, size = [], [], [], 0

        def row() -> pa.RecordBatch:
            words = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number)).view(np.int64)
            lists = [[ids], [held], [[len(t) for t in texts]], [words], [np.concatenate(texts)]]
            return arrow_batch([[chunk], *lists], schema)

        for batch in batches:
            for doc_id, out, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held", "_text"))):
                words = spaced_words(text)
                texts.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words)))
                ids.append(doc_id)
                held.append(out)
                size += len(words) + 1
                if size >= tokens:
                    yield row()
                    chunk, number, ids, held, texts, size = chunk + 1, {}, [], [], [], 0
        if ids:
            yield row()

    rows = docs.select(docs["doc_id"], held_out(docs["doc_id"], parts).alias("held"), docs["text"])
    return packed_table(text_rows(rows, "doc_id", "held").mapInArrow(run, _CHUNK), "lm-chunks")


def _joined(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of an n-gram from the hash of its first n - 1 words and its last word."""
    h = context * np.uint64(0x9E3779B97F4A7C15) + word
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Grams:
    """The n-grams of a chunk, laid out along its texts.

    The stream of every text is the start mark, its words and the end mark. ``level(k)``
    has the hash of the k-gram that ends at each place, and which places have one.
    """

    def __init__(self, words: np.ndarray, tokens: np.ndarray, lengths: np.ndarray):
        sizes = lengths.astype(np.int64) + 2
        self.first = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
        self.sizes = sizes
        self.stream = np.empty(int(sizes.sum()), dtype=np.uint64)
        self.stream[self.first] = _START
        self.stream[self.first + sizes - 1] = _END
        self.place = np.arange(len(self.stream)) - np.repeat(self.first, sizes)
        inside = np.ones(len(self.stream), dtype=bool)
        inside[self.first] = inside[self.first + sizes - 1] = False
        self.stream[inside] = words.view(np.uint64)[tokens]
        self._levels = [self.stream]

    def level(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self._levels) < k:
            before = self._levels[-1]
            longer = np.zeros_like(before)
            longer[1:] = _joined(before[:-1], self.stream[1:])
            self._levels.append(longer)
        return self._levels[k - 1], self.place >= k - 1


def _grams(chunk: dict) -> Grams:
    return Grams(*(np.asarray(chunk[c].values) for c in ("words", "tokens", "lengths")))


def _distinct(grams: Grams, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct k-grams in order, the places that have one, and which one each has."""
    keys, there = grams.level(k)
    places = np.nonzero(there)[0]
    distinct, which = np.unique(keys[places], return_inverse=True)
    return distinct, places, which


def _questions(chunks: DataFrame, order: int, bits: int) -> DataFrame:
    schema = arrow_schema(_ASKED)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = {c: batch.column(c)[row] for c in batch.schema.names}
                grams = _grams(chunk)
                learnt = np.repeat(~np.asarray(chunk["held"].values.to_numpy(zero_copy_only=False)), grams.sizes)
                for k in range(1, order + 1):
                    keys, places, which = _distinct(grams, k)
                    counts = np.bincount(which, weights=learnt[places], minlength=len(keys)).astype(np.int32)
                    # Keys are in order, so the leading bits deal them out in slices.
                    bucket = keys >> np.uint64(64 - bits) if bits else np.zeros_like(keys)
                    at = np.concatenate(([0], np.nonzero(np.diff(bucket))[0] + 1)).astype(np.int32)
                    ends = np.append(at, len(keys)).astype(np.int32)
                    yield arrow_batch(
                        [
                            [chunk["chunk"].as_py()] * len(at), [k] * len(at), pa.array(bucket[at].astype(np.int64)),
                            pa.ListArray.from_arrays(ends, pa.array(keys.view(np.int64))),
                            pa.ListArray.from_arrays(ends, pa.array(counts)),
                        ],
                        schema,
                    )

    return chunks.mapInArrow(run, _ASKED)


def _answers(questions: DataFrame) -> DataFrame:
    """Totals in the order of the keys asked; of each bucket of words also N and V, as chunk -1."""
    schema = arrow_schema(_TOLD)

    def run(rows: pa.Table) -> pa.Table:
        keys = rows.column("keys").combine_chunks()
        level, bucket = rows.column("level")[0].as_py(), rows.column("bucket")[0].as_py()
        flat = np.asarray(keys.values).view(np.uint64)
        distinct, which = np.unique(flat, return_inverse=True)
        counts = np.asarray(rows.column("counts").combine_chunks().values)
        totals = np.bincount(which, weights=counts, minlength=len(distinct)).astype(np.int64)
        chunks = rows.column("chunk").to_pylist()
        lists = pa.ListArray.from_arrays(keys.offsets, pa.array(totals[which]))
        out = [arrow_batch([chunks, [level] * len(chunks), [bucket] * len(chunks), lists], schema)]
        if level == 1:
            words = totals[(distinct != _START) & (totals > 0)]
            out.append(arrow_batch([[-1], [level], [bucket], [[int(words.sum()), len(words)]]], schema))
        return pa.Table.from_batches(out)

    return packed_table(questions.groupBy("bucket", "level").applyInArrow(run, _TOLD), "lm-totals")


def walk(grams: Grams, counts: list[np.ndarray], n: int, v: int, mu: float) -> tuple[np.ndarray, np.ndarray]:
    """log10 probability of every token along the automaton, and at its root alone.

    ``counts[k - 1]`` has the training count of the k-gram that ends at each place. A
    context with a count is a state. The state carried to a place is its longest such
    context; from there failure arcs lead down to the first state with an arc for the token.
    All places are walked at once, from the root upwards: ``below`` is the weight that
    remains after a failure arc.
    """
    root = np.log10((counts[0] + 1.0) / (n + v + 1.0))
    below = root
    for k in range(2, len(counts) + 1):
        context = np.concatenate(([0], counts[k - 2][:-1])).astype(float)
        state = (grams.place >= k - 1) & (context > 0)
        arc = np.log10((counts[k - 1] + mu * 10.0**below) / (context + mu))
        failure = np.log10(mu / (context + mu)) + below
        below = np.where(state, np.where(counts[k - 1] > 0, arc, failure), below)
    return below, root


def score_documents(
    docs: DataFrame, order: int = ORDER, mu: float = MU, parts: int = 7, tokens: int = CHUNK_TOKENS
) -> DataFrame:
    """Score all documents with the model learnt from those that are not held out."""
    chunks = chunked(docs, parts, tokens)
    size = chunks.agg(F.sum(F.size("tokens")).alias("n")).first()["n"] or 0
    bits = max(0, int(size * order // BUCKET_KEYS).bit_length())
    totals = _answers(_questions(chunks, order, bits))
    whole = totals.where("chunk = -1").agg(F.sum(F.get("totals", F.lit(0))), F.sum(F.get("totals", F.lit(1)))).first()
    n, v = (int(x or 0) for x in whole)
    schema = arrow_schema(_SCORES)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.Table.from_batches([], schema)
        chunk = {c: left.column(c)[0] for c in left.schema.names}
        grams = _grams(chunk)
        told: dict[int, list] = {}
        for level, bucket, totals in zip(*(right.column(c) for c in ("level", "bucket", "totals"))):
            told.setdefault(level.as_py(), []).append((bucket.as_py(), totals))
        counts = []
        for k in range(1, order + 1):
            _, places, which = _distinct(grams, k)
            slices = [np.asarray(t.values) for _, t in sorted(told[k], key=lambda x: x[0])]
            each = np.zeros(len(grams.stream), dtype=np.int64)
            each[places] = np.concatenate(slices)[which]
            counts.append(each)
        score, root = walk(grams, counts, n, v, mu)
        # The start mark of each text is no token.
        token = grams.place > 0
        known = (counts[0] > 0) & token
        add = lambda x: np.add.reduceat(np.where(token, x, 0), grams.first)
        sums = [grams.sizes - 1, add(known.astype(np.int64)), add(root), add(score)]
        ids, held = (chunk[c].as_py() for c in ("doc_ids", "held"))
        return pa.Table.from_batches([arrow_batch([ids, held, *map(pa.array, sums)], schema)])

    scored = chunks.groupBy("chunk").cogroup(
        totals.where("chunk >= 0").withColumnRenamed("chunk", "of_chunk").groupBy("of_chunk")
    ).applyInArrow(run, _SCORES)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score"
    )
