"""Operator 3: encode texts with the pieces of a SentencePiece model, with the N best segmentations.

The vocabulary and its scores come from a model file; nothing is trained. The library
reads the file only; segmentation is done in ``piece_lattice``. A text gets
a blank in front and blanks become their mark, as the model does; other characters are
left as they are. Characters without a piece, and a literal mark in a text, become UTF-8
bytes, so every segmentation decodes to exactly the text.

The vocabulary (some ten thousand entries, whatever the data) is broadcast. A worker
keeps the words it has segmented from one task to the next, up to a fixed number of bytes. Texts are taken in
groups of some MB, whose new words are segmented together, and results leave a task in batches of about a MB of text. Of the next best
segmentations only the ids that differ from the best one are kept; ``with_all_ids`` restores them.

Defined cases: a null text is an empty one, which has one segmentation without ids and of score
0. Texts with fewer than ``n`` segmentations return those there are. Repeated rows give repeated
results, a null ``doc_id`` is passed on, extra columns are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from runscope.llm.piece_lattice import BLANK, Change, Found, Lattices, changed, decoded, decoded_bytes
from runscope.llm.texts import arrow_batch, arrow_schema, text_rows

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 3
#: Bytes of texts whose new words are segmented together, and after which results leave the task.
GROUP, EMIT = 4 << 20, 1 << 20


def vocabulary(spark: SparkSession, model_file: str = MODEL) -> Broadcast:
    """Pieces with id and score, the ids of the 256 bytes, and the bytes of every id."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces, byte_ids, table = {}, [0] * 256, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(piece[1:-1], 16)
            byte_ids[value] = i
            table.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i):
            table.append(b"")
        else:
            pieces[piece] = (i, model.get_score(i))
            table.append(piece.replace(BLANK, " ").encode())
    return spark.sparkContext.broadcast({"pieces": pieces, "bytes": byte_ids, "table": table})


def _lattices(shared: Broadcast) -> Lattices:
    """The worker's lattices; the broadcast value lives as long as the worker."""
    value = shared.value
    if "lattices" not in value:
        value["lattices"] = Lattices(value["pieces"], value["bytes"])
    return value["lattices"]


def _groups(texts: list[bytes], size: int) -> Iterator[tuple[int, list[str]]]:
    """Texts in groups of about ``size`` bytes, with the place of the first."""
    first, total = 0, 0
    for i, raw in enumerate(texts, 1):
        total += len(raw)
        if total >= size or i == len(texts):
            yield first, [t.decode("utf-8", "replace") for t in texts[first:i]]
            first, total = i, 0


def _map(docs: DataFrame, shared: Broadcast, n: int, measure: Callable[[str, Found, list[bytes]], tuple], schema: str) -> DataFrame:
    """doc_id and what ``measure`` makes of a text and its n best segmentations."""
    schema = f"doc_id bigint, {schema}"
    out = arrow_schema(schema)

    def column(values: tuple, kind: pa.DataType) -> pa.Array:
        if not (pa.types.is_list(kind) and pa.types.is_int32(kind.value_type)):
            return pa.array(values, kind)
        # Packed ids need not become Python numbers.
        ends = np.cumsum([0, *(len(v) // 4 for v in values)], dtype=np.int32)
        return pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(values), dtype=np.int32)))

    def emit(ids: pa.Array, found: list[tuple]) -> pa.RecordBatch:
        return arrow_batch([ids, *(column(c, f.type) for c, f in zip(zip(*found), list(out)[1:]))], out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices, table = _lattices(shared), shared.value["table"]
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("_text").to_pylist()
            for first, group in _groups(texts, GROUP):
                if len(group) > 1:
                    lattices.learn({w for text in group for w in text.split(" ")})
                found, start, size = [], first, 0
                for i, text in enumerate(group, first + 1):
                    found.append(measure(text, lattices.segmentations(text, n), table))
                    size += len(text)
                    if size >= EMIT:
                        yield emit(ids.slice(start, i - start), found)
                        found, start, size = [], i, 0
                if found:
                    yield emit(ids.slice(start, len(found)), found)

    return text_rows(docs, "doc_id").mapInArrow(run, schema)


def _same(text: str, found: Found, table: list[bytes]) -> bool:
    """Whether every segmentation decodes to the text: the best one as a whole, the others where they differ."""
    raw = text.encode("utf-8", "surrogatepass")
    return decoded_bytes(found.ids, table) == (b" " + raw if raw else b"") and all(
        decoded_bytes(c.ids, table) == decoded_bytes(found.ids[4 * c.at : 4 * (c.at + c.drop)], table)
        for _, changes in found.others
        for c in changes
    )


def encode(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """doc_id, ids and score of the best segmentation of every text."""
    return _map(docs, shared, 1, lambda _, found, __: (found.ids, found.score), "ids array<int>, score double")


def encode_n_best(docs: DataFrame, shared: Broadcast, n: int = N_BEST) -> DataFrame:
    """doc_id, ids and score of the best segmentation, the others, and whether each of them decodes to the text.

    ``others`` has the score of each and its changes from left to right: instead of ``drop`` ids of the best
    one from place ``at`` (from 0) on stand ``ids``.
    """

    def measure(text: str, found: Found, table: list[bytes]) -> tuple:
        others = [
            {"score": score, "changes": [{"at": c.at, "drop": c.drop, "ids": array("i", c.ids)} for c in changes]}
            for score, changes in found.others
        ]
        return found.ids, found.score, others, _same(text, found, table)

    schema = "ids array<int>, score double, others array<struct<score:double,changes:array<struct<at:int,drop:int,ids:array<int>>>>>"
    return _map(docs, shared, n, measure, f"{schema}, round_trip boolean")


def all_ids(ids: Column | str, changes: Column) -> Column:
    """The ids of another segmentation from those of the best one and the changes."""

    def apply(now: Column, change: Column) -> Column:
        behind = change["at"] + change["drop"]
        rest = F.slice(now, behind + 1, F.greatest(F.size(now) - behind, F.lit(0)))
        return F.concat(F.slice(now, F.lit(1), change["at"]), change["ids"], rest)

    # From the right, so that the places further left stay.
    return F.aggregate(F.reverse(changes), F.col(ids) if isinstance(ids, str) else ids, apply)


def with_all_ids(encoded: DataFrame) -> DataFrame:
    """``encode_n_best`` with ``segmentations``, the scores and ids of all segmentations, best first."""
    best = F.array(F.struct("score", "ids"))
    others = F.transform("others", lambda o: F.struct(o["score"].alias("score"), all_ids("ids", o["changes"]).alias("ids")))
    return encoded.withColumn("segmentations", F.concat(best, others))


def decode(encoded: DataFrame, shared: Broadcast) -> DataFrame:
    """doc_id and text of rows with ids; null ids give an empty text."""
    @F.udf("string")
    def text(ids):
        return decoded(ids or [], shared.value["table"])

    return encoded.select("doc_id", text("ids").alias("text"))


def _digests(found: Found) -> list[str]:
    """Hashes of the ids of all segmentations; what they share with the best one in front is hashed once."""
    firsts = sorted({changes[0].at for _, changes in found.others if changes})
    state, at, before = hashlib.sha256(), 0, {}
    for first in firsts:
        state.update(memoryview(found.ids)[4 * at : 4 * first])
        before[first], at = state.copy(), first
    state.update(memoryview(found.ids)[4 * at :])
    digests = [state.hexdigest()]
    for _, changes in found.others:
        first = changes[0].at
        state = before[first].copy()
        state.update(changed(found.ids, changes)[4 * first :])
        digests.append(state.hexdigest())
    return digests


def digests(encoded: DataFrame) -> DataFrame:
    """What ``encode_n_best`` has found, as counts, scores and hashes of its ids.

    ids_sha256 is the hash of the best ids as 32-bit little-endian integers, scores lists the
    scores best first, round_trip tells whether the ids decode to the text. segmentations_sha256 has the hashes
    of the ids of all segmentations, in the order of the scores.
    """
    schema = (
        "doc_id bigint, n_ids bigint, n_found int, score double, scores array<double>, ids_sha256 string, round_trip boolean, "
        "segmentations_sha256 array<string>"
    )
    out = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            columns = (batch.column("ids"), *(batch.column(c).to_pylist() for c in ("score", "others", "round_trip")))
            for ids, score, others, round_trip in zip(*columns):
                packed = ids.values.to_numpy().tobytes()
                rest = [(o["score"], [Change(c["at"], c["drop"], array("i", c["ids"]).tobytes()) for c in o["changes"]]) for o in others]
                hashes, scores = _digests(Found(score, packed, rest)), [score, *(s for s, _ in rest)]
                found.append((len(packed) // 4, len(scores), score, scores, hashes[0], round_trip, hashes))
            yield arrow_batch([batch.column("doc_id"), *(zip(*found) if found else [()] * (len(out) - 1))], out)

    return encoded.select("doc_id", "ids", "score", "others", "round_trip").mapInArrow(run, schema)


def summarise(docs: DataFrame, shared: Broadcast, n: int = N_BEST) -> DataFrame:
    """``digests`` of the n best segmentations of every text, taken from the ids that ``encode_n_best`` returns."""
    return digests(encode_n_best(docs, shared, n))
