"""Operator 13: how many tokens a tokenizer makes of every text, without its tokens.

Texts are cut into words with the white space in front of them, where no token can cross, so a text has the tokens
of its words. Tasks hand the library the words they have not met yet, in batches of about the same number of bytes, and return
lengths only; a worker keeps the counts of words up to a fixed number of bytes. A word longer than a piece is cut where no token can cross. The splitting pattern of the
tokenizer never takes a white space character behind another character into the same token, so
a cut in front of white space that follows anything else is always safe: what stands left
of it doesn't end in white space, and what stands right of it looks at nothing before. Texts without blanks are cut
where a letter meets a digit or a letter or digit meets a full stop or comma, which the pattern separates
as well. No special string contains such a place. A stretch without any of these places stays one piece.

The tokenizer's file is read on the driver and broadcast (its size is fixed); workers build the
tokenizer once. Every task runs one thread: Spark has a task for every core.

Defined cases: a null text is an empty one with 0 bytes and 0 tokens. Repeated rows give repeated
results, a null ``doc_id`` is passed on, extra columns are not read, an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import public_tokenizers
import pyarrow as pa
import tokenizers
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from runscope.llm.texts import arrow_batch, arrow_schema, text_rows

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
#: Characters after which a text is cut at the next safe place, and bytes that go to the library at once.
PIECE = 16_384
BATCH = 1 << 20
#: Bytes of texts whose new words go to the library together, and characters of words whose counts a worker keeps.
GROUP, KEPT = 4 << 20, 16 << 20
#: Python takes four control characters for white space that the tokenizer's pattern does not.
_WORD = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|\s+")

# Fixed places: white space after anything else; scripts whose letters no version of Unicode has changed.
_SAFE = re.compile(
    r"(?<=\S)\s"
    r"|(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]"
    r"|(?<=[A-Za-z0-9ぁ-ゖァ-ヺ一-龥])[,.;:!?、。，]"
)


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """Parts of a text, in order, whose tokens together are those of the text."""
    start = 0
    while len(text) - start > size:
        found = _SAFE.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


def _batches(texts: list[str], size: int, batch: int) -> Iterator[tuple[list[int], list[str]]]:
    """Pieces in batches of about ``batch`` bytes, with the number of the text of each."""
    owners, parts, total = [], [], 0
    for number, text in enumerate(texts):
        for part in pieces(text, size):
            owners.append(number)
            parts.append(part)
            total += len(part)
            if total >= batch:
                yield owners, parts
                owners, parts, total = [], [], 0
    if parts:
        yield owners, parts


def _groups(texts: list[bytes], size: int) -> Iterator[list[str]]:
    """Texts in groups of about ``size`` bytes."""
    group, total = [], 0
    for raw in texts:
        group.append(raw.decode("utf-8", "replace"))
        total += len(raw)
        if total >= size:
            yield group
            group, total = [], 0
    if group:
        yield group


class WordCounts(dict):
    """Tokens of the words met so far; forgets them all beyond ``kept`` characters."""

    def __init__(self, encode, kept: int = KEPT):
        super().__init__()
        self._encode, self._kept, self._size = encode, kept, 0

    def of_texts(self, texts: list[str], piece: int, batch: int) -> Iterator[int]:
        """How many tokens each text has."""
        if self._size > self._kept:
            self.clear()
            self._size = 0
        words = [_WORD.findall(text) for text in texts]
        new = list(set().union(*words).difference(self))
        self.update(dict.fromkeys(new, 0))
        for owners, parts in _batches(new, piece, batch):
            for owner, found in zip(owners, self._encode(parts, add_special_tokens=False)):
                self[new[owner]] += len(found)
        # A word takes some hundred bytes beside its characters.
        self._size += sum(map(len, new)) + 16 * len(new)
        for listed in words:
            yield sum(map(self.__getitem__, listed))


def tokenizer_file(spark: SparkSession, path: str = TOKENIZER) -> Broadcast:
    """The tokenizer's definition, for all workers; ``path`` is a file or a name that public_tokenizers knows."""
    with open(path if os.path.exists(path) else public_tokenizers.path(path), encoding="utf-8") as file:
        return spark.sparkContext.broadcast({"definition": file.read()})


def _tokenizer(shared: Broadcast) -> tokenizers.Tokenizer:
    """The worker's tokenizer; the broadcast value lives as long as the worker."""
    value = shared.value
    if "tokenizer" not in value:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        value["tokenizer"] = tokenizers.Tokenizer.from_str(value["definition"])
        value["tokenizer"].no_padding()
        value["tokenizer"].no_truncation()
    return value["tokenizer"]


def _counts(shared: Broadcast, kept: int) -> WordCounts:
    """The worker's word counts."""
    value = shared.value
    if "counts" not in value:
        value["counts"] = WordCounts(_tokenizer(shared).encode_batch_fast, kept)
    return value["counts"]


def count_tokens(docs: DataFrame, shared: Broadcast, limit: int = LIMIT, piece: int = PIECE, batch: int = BATCH) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, and over_limit: more than ``limit`` tokens."""
    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint"
    out = arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _counts(shared, KEPT)
        for rows in batches:
            raw = rows.column("_text").to_pylist()
            counts = [n for group in _groups(raw, GROUP) for n in known.of_texts(group, piece, batch)]
            yield arrow_batch([rows.column("doc_id"), list(map(len, raw)), counts], out)

    counted = text_rows(docs, "doc_id").mapInArrow(run, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
