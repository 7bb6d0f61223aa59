"""Operator 11: audit the structure of conversations and repair them by the cheapest edits.

Rows of a conversation are taken by turn, nulls first, ties by role and text. A row is blank (nothing but white
space), a duplicate (its role and text were seen before in the conversation) or truncated (it does not end in
a full stop, exclamation or question mark); its first fault counts. ``edit_paths`` then finds the
cheapest edits after which the roles spell an optional system turn and pairs of user and assistant.

Duplicates are found by a window over equal rows of a conversation. Then the rows are dealt by conversation
and sorted, and every task walks through its conversations in one pass with a row at a time: no conversation is
gathered. One conversation is one sequence and is read by one task, since a SHA-256 value has no parallel form.

Defined cases: a null role or text is one blank. Rows without ``conv_id`` are one conversation. A turn that is null counts
in no gap. Rows whose ``present`` is false only name their conversation; one without any other row has zeros, an empty
audit and the hash of nothing. Very long texts pass a few at a time. Columns besides the five are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from runscope.llm.edit_paths import DELETE, INSERT, KEEP, Audit
from runscope.llm.texts import arrow_batch, arrow_schema, small_batches

WHITE = b" \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")

SUMMARY = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)
TURNS = "conv_id bigint, place bigint, edit string, turn bigint, role string, text string"


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with faults by the CRC of conversation and turn, for tests of the repair.

    Of 20 remainders, 0 drops a row, 1 empties its text, 2 takes its sentence ends, 3 repeats it
    and 4 makes it a user's. A dropped row stays with ``present`` false, so that its conversation stays known.
    """
    blank = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), blank) for c in ("role", "text"))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind != 0).alias("present"),
        F.when(kind == 3, 2).otherwise(1).alias("_times"),
    )
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_times"))).drop("_times", "_copy")


def _ordered(turns: DataFrame) -> DataFrame:
    """Rows with ``_seen``, dealt by conversation and in order."""
    small_batches(turns.sparkSession)
    blank = F.lit(" ")
    present: Column = F.coalesce(F.col("present"), F.lit(False)) if "present" in turns.columns else F.lit(True)
    rows = turns.select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        F.coalesce(F.col("role"), blank).alias("role"),
        F.coalesce(F.col("text"), blank).cast("binary").alias("text"),
        present.alias("present"),
    )
    equal = Window.partitionBy("conv_id", "role", "text", "present").orderBy(F.asc_nulls_first("turn"))
    rows = rows.withColumn("_seen", F.row_number().over(equal) > 1)
    return rows.repartition("conv_id").sortWithinPartitions(
        F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text", "_seen"
    )


class _Conversation:
    """What is known of a conversation while its rows pass."""

    def __init__(self, conv_id: int | None, on_turn: Callable[..., None]):
        self.conv_id, self._on_turn = conv_id, on_turn
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self._least = self._last_turn = None
        self._turns, self._before = 0, None
        self._audit, self._edits = Audit(), []
        self._hash, self._places = hashlib.sha256(), 0

    def add(self, turn: int | None, role: str, text: bytes, seen: bool) -> None:
        if turn is not None and turn != self._last_turn:
            self._least = turn if self._least is None else self._least
            self._last_turn = turn
            self._turns += 1
        initial = role[:1]
        if self._before is not None and self._before + initial not in LEGAL:
            self.illegal += 1
        self._before = initial
        words = text.rstrip(WHITE)
        blank, truncated = not words, words[-1:] not in (b".", b"!", b"?")
        if blank:
            self.blank += 1
        elif seen:
            self.duplicate += 1
        elif truncated:
            self.truncated += 1
        must_go = blank or seen
        self._apply(self._audit.add((turn, role, text), initial, must_go, truncated and not must_go))

    def _apply(self, edits: Iterable[tuple]) -> None:
        for edit, row, written in edits:
            self._edits.append(edit)
            if edit == DELETE:
                continue
            turn, role, text = (None, written, b"") if edit == INSERT else row
            role = role if edit == KEEP else written
            if self._places:
                self._hash.update(b"\n")
            self._hash.update(role.encode() + b":")
            self._hash.update(text)
            self._on_turn(self.conv_id, self._places, edit, turn, role, text)
            self._places += 1

    def finish(self) -> tuple:
        cost, edits = self._audit.finish()
        self._apply(edits)
        gaps = self._last_turn - self._least + 1 - self._turns if self._turns else 0
        return (
            self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost,
            "".join(self._edits), self._hash.hexdigest(),
        )


def _walk(batches: Iterable[pa.RecordBatch], on_turn: Callable[..., None]) -> Iterator[tuple | None]:
    """A summary for every conversation that has ended; None after each batch."""
    now = None
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "present", "_seen"))
        for conv_id, turn, role, text, present, seen in zip(*columns):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield now.finish()
                now = _Conversation(conv_id, on_turn)
            if present:
                now.add(turn, role, text, seen)
        yield None
    if now is not None:
        yield now.finish()
    yield None


def audit_conversations(turns: DataFrame) -> DataFrame:
    """Per conversation its faults, the cheapest edits as letters, their cost, and the hash of what they give.

    ``gaps`` are the numbers missing between the least and the largest turn, ``illegal`` the neighbours that should not
    follow each other. The hash is of ``role:text`` of the repaired turns, joined by line feeds.
    """
    out = arrow_schema(SUMMARY)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for row in _walk(batches, lambda *_: None):
            if row is not None:
                found.append(row)
            elif found:
                yield arrow_batch(zip(*found), out)
                found = []

    return _ordered(turns).mapInArrow(run, SUMMARY)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: place from 0, edit, original turn (null if inserted), role and text."""
    out = arrow_schema(TURNS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []

        def keep(conv_id, place, edit, turn, role, text):
            found.append((conv_id, place, edit, turn, role, text.decode("utf-8", "replace")))

        for row in _walk(batches, keep):
            if row is None and found:
                yield arrow_batch(zip(*found), out)
                found.clear()

    return _ordered(turns).mapInArrow(run, TURNS)
