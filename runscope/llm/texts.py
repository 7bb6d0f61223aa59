"""Words of a text, on its UTF-8 bytes, and the batches in which tasks meet texts.

Both word classes of this package are defined on ASCII characters only, so they can
be cut from the UTF-8 bytes: every byte of a non-ASCII character is 0x80 or above.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from runscope.session import fresh_path, shuffles_removed

#: Bytes of a row group of a packed table.
GROUP_BYTES = 8 << 20

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
_PLAIN = bytes(
    c if c >= 0x80 or c in _KEPT else c + 32 if chr(c) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else 0x20 for c in range(256)
)


def spaced_words(text: bytes) -> list[bytes]:
    """Runs of characters other than ASCII white space, with A-Z in lower case."""
    return text.lower().split()


def plain_words(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of non-ASCII characters, with A-Z in lower case."""
    return text.translate(_PLAIN).split()


class WordHashes(dict):
    """64-bit hash of each word, kept from one text to the next up to ``limit`` words."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self._limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self._limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def small_batches(spark: SparkSession, rows: int = 1000, size: str = "16m") -> None:
    """Limit the rows and bytes that a Python task receives at once: texts may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def text_key(text: Column) -> Column:
    """Tells apart rows that share an id but not their text; a missing text equals an empty one."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def text_rows(docs: DataFrame, *columns: str, text: str = "text") -> DataFrame:
    """``columns`` and the text as bytes; a missing text is empty."""
    small_batches(docs.sparkSession)
    kept = [docs[c] for c in columns]
    return docs.select(*kept, F.coalesce(docs[text].cast("binary"), F.lit(b"")).alias("_text"))


def packed_table(df: DataFrame, label: str) -> DataFrame:
    """``written_table`` for long arrays of numbers that deflate well.

    A task that writes or reads rows holds a row group of them. By default the writer looks at its size only
    after a hundred rows, and a reader takes all rows of a group at once, so groups are small here.
    """
    path = fresh_path(df.sparkSession, label)
    rows = {"parquet.block.size": GROUP_BYTES, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}
    with shuffles_removed(df.sparkSession):
        df.write.options(compression="zstd", **rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def arrow_batch(columns: Iterable, schema: pa.Schema) -> pa.RecordBatch:
    """A batch of arrays or plain sequences, in the order of ``schema``."""
    arrays = [
        c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def map_texts(rows: DataFrame, measure: Callable[[bytes], tuple], schema: str, keep: str) -> DataFrame:
    """One output row per text: the kept columns and what ``measure`` returns.

    ``rows`` comes from ``text_rows``. ``keep`` and ``schema`` are DDL; the text itself
    does not leave the task.
    """
    width, kept = len(arrow_schema(schema)), arrow_schema(keep).names
    out = arrow_schema(f"{keep}, {schema}")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(t) for t in batch.column("_text").to_pylist()]
            columns = list(zip(*found)) if found else [()] * width
            yield arrow_batch([*(batch.column(c) for c in kept), *columns], out)

    return rows.mapInArrow(run, f"{keep}, {schema}")
