"""Random forests of any depth, for all groups of a table in one set of jobs.

Rows are dealt into blocks of bounded size by group and a hash of their content; a block is one row of packed columns.
A tree of a large group grows from the
top by histograms: the blocks are added up by tree, node, feature and bin, the sums of all tasks meet by node, where the split is
chosen, and the nodes go to a table. As soon as the rows of a node fit one task they meet there, and
the task finishes the subtree down to pure nodes or the depth asked for. A group that is small from the start is finished at once. So
there is no list of groups, no model and no loop over groups on the driver, and a group with a third of all
rows is split over as many tasks as it has blocks.

Every tree has its own sample. The rows of small groups are shuffled once, packed with their hashes, and all batches of trees
read that one shuffle. In large groups every tree also has its own nodes and needs its own copy of the rows it samples. Copies travel packed, and
trees are finished some at a time, so that there is room for a bounded number of copies at once
(``WAVE_VALUES``, ``WAVE_BYTES``), however many trees are asked for. Rows that ask for predictions are packed as well, with
all their columns, and travel once.

Which rows a tree samples, and how often, follows from a hash of the row, so cores, files and retries don't change a model.
Every split may use every column. The bins of a group are the same in all its nodes, whether it is large or small: they lie
between its values, or between 256 exact quantiles if a column has more of them. Rows of large groups travel as bins.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from runscope.functions import trees as tr
from runscope.functions.measures import present
from runscope.operators.filters import fill_missing_hp
from runscope.session import written_table

# Executors need not have this package installed: the few functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Tasks that finish the trees of a wave.
MOST_TASKS = 400
#: Values (rows times columns) of a node that one task finishes, and of a block.
LOCAL_VALUES = 24_000_000
BLOCK_VALUES = 1_000_000
#: Values that a task collects before it packs them by group and block.
PIECE_VALUES = 4_000_000
#: Different values of a column that a task lists before its quantiles are looked for.
LISTED = 4_096
#: Trees of a small group that one task grows, and values over all of them.
TOGETHER = 10
TASK_VALUES = 80_000_000
#: Values, over all trees, that are on their way to their nodes at once.
WAVE_VALUES = 2_000_000_000
#: Packed bytes, over all trees, that are on their way to their nodes at once.
WAVE_BYTES = 400_000_000
#: Values of a block of rows that asks for predictions, and nodes of a forest that one task walks.
ASK_VALUES = 4_000_000
WALK_NODES = 8_000_000

_SPLITS = "spark.sql.files.minPartitionNum"
#: Packed columns: hashes, values column by column, labels.
_PACKED = "grp string, block bigint, row binary, x binary, y binary"
#: ``w`` has the weights of the rows in the tree.
_MEETING = "grp string, tree int, node bigint, block bigint, w binary, x binary, y binary"
#: Sums of an open node over some blocks: of squares, then of weights and of weighted values by feature and bin.
_SUMS = "grp string, tree int, node bigint, block bigint, widths array<int>, sums binary"
#: The best split of an open node; feature -1: none.
_BEST = "grp string, tree int, node bigint, feature int, bin int, gain double, lw double, ls double, w double, s double"
#: Bounds of a column, or the 256 places of its quantiles: the leading bytes of each, and its place among the rows that begin with them.
_BOUNDS = "grp string, feature int, bounds array<double>, prefix binary, place binary"
_SUBTREES = (
    "grp string, tree int, node bigint, feature array<int>, threshold array<double>, left array<int>, right array<int>, "
    "value array<double>, gain array<double>"
)
#: Nodes above the finished subtrees; ``kind`` is split, leaf or open. Numbers are those of a heap, the root is 1.
_TOP = "grp string, tree int, node bigint, kind string, feature int, bin int, threshold double, value double, gain double, w double"


@dataclass(frozen=True)
class Forests:
    """One forest for every group: the splits of large nodes and the subtrees below them, as tables."""

    features: list[str]
    #: The columns that name a group, with their types.
    by: dict[str, str]
    trees: int
    top: DataFrame
    subtrees: DataFrame


def _group(by: list[str]) -> Column:
    """One text for the columns that name a group."""
    return F.to_json(F.struct(*by), {"ignoreNullFields": "false"}) if by else F.lit("")


def _blocks(rows: DataFrame, sizes: DataFrame, block_rows: int) -> DataFrame:
    """Deal the rows of a group into blocks by ranges of the hash that names them, so that blocks in order are rows in order."""
    blocks = sizes.select(F.col("grp").alias("_grp"), F.ceil(F.col("n") / block_rows).alias("_blocks"))
    high = F.shiftright("row", 32) + 2**31
    dealt = rows.join(blocks, F.col("grp") == F.col("_grp")).withColumn("block", F.shiftright(high * F.col("_blocks"), 32))
    return dealt.drop("_grp", "_blocks")


def _for_each(rows: DataFrame, part: str, table: DataFrame, *keys: str) -> DataFrame:
    """What ``table`` has for the keys of ``rows``, once for every part of them, which ``in_<part>`` names."""
    parts = rows.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(part).alias(f"in_{part}")).distinct()
    own = table.select([F.col(c).alias(c) for c in table.columns])
    return own.join(parts, [F.col(k) == F.col(f"_{k}") for k in keys]).drop(*[f"_{k}" for k in keys])


def _matrix(table: pa.Table) -> np.ndarray:
    return table.column("x").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)


def _numpy(table: pa.Table, *columns: str) -> list[np.ndarray]:
    return [table.column(c).to_numpy() for c in columns]


def _table(schema: pa.Schema, columns: list) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _pack(values: np.ndarray) -> bytes:
    """One or more columns as compressed bytes: codes where a column has few values, differences where whole numbers ascend."""
    if values.dtype.itemsize != 8:
        return _pack_columns([(None, values.ravel())])
    return _pack_columns([_coded(np.ascontiguousarray(c)) for c in np.atleast_2d(values)])


def _coded(column: np.ndarray) -> tuple[np.ndarray | None, np.ndarray]:
    """Codes and the values they stand for, or no codes and all values if too many differ."""
    if column.dtype.kind == "i" and (column[1:] >= column[:-1]).all():
        return None, column
    # By their bits, so that every value comes back as it was.
    codes, bits = pd.factorize(column.view(np.int64))
    return (codes.astype(np.uint8 if len(bits) <= 256 else np.uint16), bits.view(column.dtype)) if _worth(bits, codes) else (None, column)


def _worth(values: np.ndarray, codes: np.ndarray) -> bool:
    return len(values) <= min(65_536, len(codes) // 4)


def _pack_columns(columns: list[tuple[np.ndarray | None, np.ndarray]]) -> bytes:
    """Number of columns; rows, values and kind of each; compressed bytes behind their length."""
    head, body = [len(columns)], []
    for codes, values in columns:
        if codes is not None:
            head += [len(codes), len(values), codes.itemsize]
            body += [values.tobytes(), codes.tobytes()]
            continue
        ascending = values.dtype == np.int64 and len(values) > 0 and bool((values[1:] >= values[:-1]).all())
        head += [len(values), 0, -1 if ascending else values.itemsize]
        if ascending:
            # Differences are small, so their upper bytes are alike.
            steps = np.diff(values.view(np.uint64), prepend=np.uint64(0))
            values = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
        body.append(values.tobytes())
    raw = b"".join(body)
    return np.array([*head, len(raw)], dtype="<i8").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def _columns(packed: bytes, kind: type = np.float64) -> list[tuple[np.ndarray | None, np.ndarray]]:
    """The columns of packed bytes, still in codes."""
    n = int.from_bytes(packed[:8], "little")
    head = np.frombuffer(packed, dtype="<i8", count=3 * n + 2)
    raw = pa.decompress(packed[head.nbytes :], decompressed_size=int(head[-1]), codec="zstd", asbytes=True)
    found, at = [], 0
    for rows, different, width in head[1:-1].reshape(-1, 3).tolist():
        if width == -1:
            steps = np.frombuffer(raw, np.uint8, 8 * rows, at).reshape(8, rows).T
            found.append((None, np.cumsum(np.ascontiguousarray(steps).view(np.uint64).ravel(), dtype=np.uint64).view(np.int64)))
            at += 8 * rows
        elif different:
            values = np.frombuffer(raw, kind, different, at)
            at += values.nbytes
            found.append((np.frombuffer(raw, np.uint8 if width == 1 else np.uint16, rows, at), values))
            at += rows * width
        else:
            found.append((None, np.frombuffer(raw, kind, rows, at)))
            at += found[-1][1].nbytes
    return found


def _decoded(column: tuple[np.ndarray | None, np.ndarray]) -> np.ndarray:
    codes, values = column
    return values if codes is None else values.take(codes)


def _unpack(packed: bytes, kind: type = np.float64) -> np.ndarray:
    """The values, column by column."""
    columns = [_decoded(c) for c in _columns(packed, kind)]
    return columns[0] if len(columns) == 1 else np.concatenate(columns)


def _some(column: tuple[np.ndarray | None, np.ndarray], rows: np.ndarray) -> tuple[np.ndarray | None, np.ndarray]:
    """A column of some of the rows."""
    codes, values = column
    if codes is None:
        return None, values.take(rows)
    codes = codes.take(rows)
    return (codes, values) if _worth(values, codes) else (None, values.take(codes))


def _in_pieces(batches: Iterator[pa.RecordBatch], most_rows: int) -> Iterator[tuple[str, int, pa.Table]]:
    """The rows of a task by group and block, some batches at a time."""
    waiting: list[pa.RecordBatch] = []
    size, rows = 0, 0

    def parts() -> Iterator[tuple[str, int, pa.Table]]:
        table = pa.Table.from_batches(waiting)
        grp = table.column("grp").combine_chunks().dictionary_encode()
        code, block = grp.indices.to_numpy(), table.column("block").to_numpy()
        order = np.lexsort((block, code))
        code, block = code[order], block[order]
        ends = np.flatnonzero(np.concatenate((code[1:] != code[:-1], [True])) | np.concatenate((block[1:] != block[:-1], [True])))
        table = table.drop_columns(["grp", "block"]).take(pa.array(order))
        for first, last in zip(np.concatenate(([0], ends[:-1] + 1)).tolist(), ends.tolist()):
            yield grp.dictionary[int(code[first])].as_py(), int(block[first]), table.slice(first, last + 1 - first)

    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= most_rows or size >= 32 * PIECE_VALUES:
            yield from parts()
            waiting.clear()
            size, rows = 0, 0
    if waiting:
        yield from parts()


def _packed_pieces(rows: DataFrame, features: int) -> DataFrame:
    """The rows that a task has of a group and block, packed in the order of their hashes."""
    out = _schema(_PACKED)
    most_rows = max(1, PIECE_VALUES // features)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grp, block, piece in _in_pieces(batches, most_rows):
            row, y = _numpy(piece, "row", "y")
            x = np.stack(_numpy(piece, *(f"x{f}" for f in range(features))))
            order = np.argsort(row, kind="stable")
            yield from _table(out, [[grp], [block], *([_pack(c)] for c in (row[order], x[:, order], y[order]))]).to_batches()

    return rows.mapInArrow(pack, _PACKED)


def _packed_blocks(rows: DataFrame, features: int, tasks: int | None = None) -> DataFrame:
    """A row for every block, its rows in the order of their hashes; rows are packed before they are shuffled."""
    out = _schema(_PACKED)

    def merge(table: pa.Table) -> pa.Table:
        row, y = (np.concatenate([_unpack(p.as_py(), t) for p in table.column(c)]) for c, t in (("row", np.int64), ("y", float)))
        x = np.concatenate([_unpack(p.as_py()).reshape(features, -1) for p in table.column("x")], axis=1)
        order = np.argsort(row, kind="stable")
        return _table(out, [[table.column(c)[0].as_py()] for c in ("grp", "block")] + [[_pack(c)] for c in (row[order], x[:, order], y[order])])

    pieces = _packed_pieces(rows, features)
    dealt = pieces.repartition(tasks, "grp", "block") if tasks else pieces
    return dealt.groupBy("grp", "block").applyInArrow(merge, _PACKED)


@contextmanager
def _even_tasks(spark: SparkSession) -> Iterator[None]:
    """Tables read inside are dealt over some tasks for every core, so that no core waits long for the last one."""
    before = spark.conf.get(_SPLITS, None)
    spark.conf.set(_SPLITS, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(_SPLITS) if before is None else spark.conf.set(_SPLITS, before)


def _schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(ddl))


def _tops(top: DataFrame, cuts: DataFrame) -> DataFrame:
    """The nodes of a group in one row, with the bounds between bins."""
    nodes = F.collect_list(F.struct("tree", "node", "kind", "feature", "bin"))
    return top.groupBy("grp").agg(nodes.alias("nodes")).join(cuts, "grp")


class _Top(NamedTuple):
    """The nodes of a tree above its subtrees, in the order of their numbers, and behind them the roots of the subtrees."""

    number: np.ndarray
    split: np.ndarray
    open: np.ndarray
    below: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    child: np.ndarray


def _top_of(batch: pa.RecordBatch, k: int) -> dict[int, _Top]:
    nodes = pa.RecordBatch.from_struct_array(batch.column("nodes")[k].values)
    tree, node, feature, cut = (nodes.column(c).to_numpy() for c in ("tree", "node", "feature", "bin"))
    kind = np.array(nodes.column("kind").to_pylist())
    return {t: _top(*(c[tree == t] for c in (node, kind, feature, cut))) for t in np.unique(tree).tolist()}


def _top(node: np.ndarray, kind: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> _Top:
    order = np.argsort(node)
    node, kind, feature, cut = (c[order] for c in (node, kind, feature, cut))
    sides = (2 * node[kind == "split"][:, None] + np.arange(2)).ravel()
    roots = sides[~np.isin(sides, node)]
    number, sides = np.concatenate((node, roots)), 2 * np.concatenate((node, roots))[:, None] + np.arange(2)
    by_number = np.argsort(number)
    split, ids = np.concatenate((kind == "split", np.zeros(len(roots), dtype=bool))), np.arange(len(number))
    place = by_number.take(np.minimum(np.searchsorted(number, sides, sorter=by_number), len(number) - 1))
    more = lambda c, by: np.concatenate((c, np.full(len(roots), by)))
    return _Top(number, split, more(kind == "open", False), ids >= len(node), more(feature, -1), more(cut, 0), np.where(split[:, None], place, ids[:, None]).ravel())


def _reached(top: _Top, bins: np.ndarray) -> np.ndarray:
    """The place among the nodes of a top that every row reaches."""
    at, rows = np.empty(bins.shape[1], dtype=np.int64), np.arange(bins.shape[1])
    offset, cut = np.where(top.split, top.feature, 0) * bins.shape[1], top.bin.astype(np.uint8)
    for first in range(0, len(at), tr.SLICE):
        part = slice(first, first + tr.SLICE)
        at[part] = tr.reached(top.split, offset, cut, top.child, bins.ravel(), rows[part])
    return at


def _bounds_of(batch: pa.RecordBatch, k: int) -> list[np.ndarray]:
    return [np.array(c, dtype=float) for c in batch.column("cuts")[k].as_py()]


def _bins_of(packed: bytes, bounds: list[np.ndarray]) -> np.ndarray:
    """The bins of packed columns; where they have codes, only the values behind these are looked up."""
    return np.stack([_decoded((codes, np.searchsorted(b, values, side="left").astype(np.uint8))) for b, (codes, values) in zip(bounds, _columns(packed))])


def _ordered(values: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the values."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))


def _unordered(keys: np.ndarray) -> np.ndarray:
    return np.where(keys >> np.uint64(63), keys & np.uint64(2**63 - 1), ~keys).view(np.float64)


def _cuts(blocks: DataFrame, sizes: DataFrame, features: int, listed: int = LISTED) -> DataFrame:
    """The bounds between the bins of every group, from all its rows: what ``trees.cuts_of`` finds in one task.

    Tasks list values and their numbers. Where there are too many, the quantiles are found byte by byte, from the leading one on.
    """
    found = _listed(blocks, sizes, listed)
    for step in range(8):
        if found.where("bounds is null").isEmpty():
            break
        found = _next_bytes(blocks, found, step)
    cuts = F.transform(F.array_sort(F.collect_list(F.struct("feature", "bounds"))), lambda c: c["bounds"])
    return written_table(found.groupBy("grp").agg(cuts.alias("cuts")), "forest-cuts")


def _listed(blocks: DataFrame, sizes: DataFrame, listed: int) -> DataFrame:
    ddl = "grp string, feature int, n bigint, value binary, times binary"
    part, out = _schema(ddl), _schema(_BOUNDS)

    def add(found: dict, key: tuple[str, int], column: tuple[np.ndarray | None, np.ndarray]) -> None:
        if found.get(key, ()) is None:
            return
        values, times = tr.counted(column)
        have = found.get(key, (np.zeros(0), np.zeros(0, dtype=np.int64)))
        values, place = np.unique(np.concatenate((have[0], values)), return_inverse=True)
        found[key] = (values, np.bincount(place, np.concatenate((have[1], times))).astype(np.int64)) if len(values) <= listed else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict = {}
            n = {}
            for grp, rows, x in zip(batch.column("grp").to_pylist(), batch.column("n").to_pylist(), batch.column("x")):
                n[grp] = rows
                for f, column in enumerate(_columns(x.as_py())):
                    add(found, (grp, f), column)
            for (grp, f), counts in found.items():
                yield from _table(part, [[grp], [f], [n[grp]], *([c.tobytes()] if c is not None else [None] for c in counts or (None, None))]).to_batches()

    def merge(table: pa.Table) -> pa.Table:
        grp, f, n = (table.column(c)[0].as_py() for c in ("grp", "feature", "n"))
        if table.column("value").null_count:
            places = tr.quantile_places(n)
            return _table(out, [[grp], [f], [None], [np.zeros(len(places), dtype=np.uint64).tobytes()], [places.tobytes()]])
        values, times = (np.concatenate([np.frombuffer(v.as_py(), t) for v in table.column(c)]) for c, t in (("value", float), ("times", np.int64)))
        return _table(out, [[grp], [f], [tr.cuts_of_counts(values, times)], [None], [None]])

    parts = blocks.select("grp", "x").join(sizes.select("grp", "n"), "grp").mapInArrow(run, ddl)
    return written_table(parts.groupBy("grp", "feature").applyInArrow(merge, _BOUNDS), "forest-bounds")


def _next_bytes(blocks: DataFrame, found: DataFrame, step: int) -> DataFrame:
    """One more byte of the quantiles that are looked for; with the eighth they are known."""
    ddl = "grp string, feature int, prefix binary, place binary, times binary"
    part, out, shift = _schema(ddl), _schema(_BOUNDS), np.uint64(56 - 8 * step)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            times: dict = {}
            for grp, x, sought in zip(batch.column("grp").to_pylist(), batch.column("x"), batch.column("sought").to_pylist()):
                columns = _columns(x.as_py())
                for one in sought:
                    prefix = np.unique(np.frombuffer(one["prefix"], np.uint64))
                    values, n = tr.counted(columns[one["feature"]])
                    keys = _ordered(values)
                    high = keys >> shift >> np.uint64(8)
                    at = np.minimum(np.searchsorted(prefix, high), len(prefix) - 1)
                    hit = prefix[at] == high
                    cells = at[hit] * 256 + (keys[hit] >> shift & np.uint64(255)).astype(np.int64)
                    _, sums = times.setdefault((grp, one["feature"]), (one, np.zeros(256 * len(prefix), dtype=np.int64)))
                    sums += np.bincount(cells, n[hit], len(sums)).astype(np.int64)
            for (grp, f), (one, sums) in times.items():
                yield from _table(part, [[grp], [f], [one["prefix"]], [one["place"]], [sums.tobytes()]]).to_batches()

    def merge(table: pa.Table) -> pa.Table:
        grp, f, prefix, place = (table.column(c)[0].as_py() for c in ("grp", "feature", "prefix", "place"))
        prefix, place = np.frombuffer(prefix, np.uint64), np.frombuffer(place, np.int64)
        times = sum(np.frombuffer(t.as_py(), np.int64) for t in table.column("times"))
        different, at = np.unique(prefix, return_inverse=True)
        upto = np.cumsum(times.reshape(len(different), 256), axis=1)[at]
        byte = (upto <= place[:, None]).sum(axis=1)
        place = place - np.where(byte > 0, upto[np.arange(len(byte)), byte - 1], 0)
        prefix = prefix << np.uint64(8) | byte.astype(np.uint64)
        if shift:
            return _table(out, [[grp], [f], [None], [prefix.tobytes()], [place.tobytes()]])
        return _table(out, [[grp], [f], [tr.between(_unordered(np.unique(prefix)))], [None], [None]])

    sought = found.where("bounds is null").groupBy("grp").agg(F.collect_list(F.struct("feature", "prefix", "place")).alias("sought"))
    parts = blocks.select("grp", "x").join(sought, "grp").mapInArrow(run, ddl)
    more = parts.groupBy("grp", "feature").applyInArrow(merge, _BOUNDS)
    return written_table(found.where("bounds is not null").unionByName(more), "forest-bounds")


def _best(blocks: DataFrame, top: DataFrame, cuts: DataFrame, seed: int | None) -> DataFrame:
    """The best split of every open node, from sums over all blocks by node, feature and bin."""
    sums_out, best_out = _schema(_SUMS), _schema(_BEST)

    def add(found: dict, joints: list[tr.Joint], tops: dict[int, _Top], bins: np.ndarray, row: np.ndarray, y: np.ndarray) -> None:
        codes = tr.joint_codes(joints, bins)
        for tree, top in tops.items():
            opened = np.flatnonzero(top.open)
            if not len(opened):
                continue
            of = np.full(len(top.number), -1)
            of[opened] = np.arange(len(opened))
            w, at = tr.sample_weights(row, tree, seed), of.take(_reached(top, bins))
            inside = np.flatnonzero((at >= 0) & (w > 0))
            w, at = w.take(inside), at.take(inside)
            ys = y.take(inside)
            wy = w * ys
            parts = [None] * len(bins)
            for joint, code in zip(joints, codes):
                for f, pair in zip(joint.columns, tr.cell_sums(joint, code.take(inside), at, len(opened), w, wy)):
                    parts[f] = pair
            sums = np.concatenate([np.bincount(at, wy * ys, len(opened))[:, None], *(p[k] for k in (0, 1) for p in parts)], axis=1)
            found[tree] = found[tree] + sums if tree in found else sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places: dict[str, list[int]] = {}
            for k, grp in sorted(enumerate(batch.column("grp").to_pylist()), key=lambda k: batch.column("block")[k[0]].as_py()):
                places.setdefault(grp, []).append(k)
            for grp, ks in places.items():
                tops, bounds, middle = _top_of(batch, ks[0]), _bounds_of(batch, ks[0]), batch.column("middle")[ks[0]].as_py()
                widths, found = [len(b) + 1 for b in bounds], {}
                joints = tr.joints_of(widths)
                for k in ks:
                    row, y = _unpack(batch.column("row")[k].as_py(), np.int64), _unpack(batch.column("y")[k].as_py())
                    add(found, joints, tops, _bins_of(batch.column("x")[k].as_py(), bounds), row, y - middle)
                first = batch.column("block")[ks[0]].as_py()
                for tree, sums in found.items():
                    number = tops[tree].number[tops[tree].open]
                    columns = [[grp] * len(sums), [tree] * len(sums), number, [first] * len(sums), [widths] * len(sums), [_pack(s.view(np.uint8)) for s in sums]]
                    yield from _table(sums_out, columns).to_batches()

    def choose(table: pa.Table) -> pa.Table:
        # In the order of blocks, so that sums don't depend on how parts arrive.
        table = table.sort_by("block")
        sums = sum(_unpack(s.as_py(), np.uint8).view(np.float64) for s in table.column("sums"))
        widths = table.column("widths")[0].as_py()
        ends = np.cumsum(widths)[:-1]
        of_w, of_s = (np.split(c, ends) for c in np.split(sums[1:], 2))
        total_w, total_s = of_w[0].sum(keepdims=True), of_s[0].sum(keepdims=True)
        least = tr.least_gain(sums[0])
        best = (-1, -1, 0.0, 0.0, 0.0)
        if sums[0] - float(total_s[0]) ** 2 / float(total_w[0]) > least:
            for f, (w, s) in enumerate(zip(of_w, of_s)):
                gain, cut = (float(c[0]) for c in tr.best_of_sums(w[None], s[None], total_w, total_s))
                if gain > max(best[2], least):
                    best = (f, int(cut), gain, float(w[: int(cut) + 1].sum()), float(s[: int(cut) + 1].sum()))
        keys = [table.column(c)[0].as_py() for c in ("grp", "tree", "node")]
        return _table(best_out, [[v] for v in (*keys, *best, float(total_w[0]), float(total_s[0]))])

    tops = _tops(top, cuts).where(F.exists("nodes", lambda n: n["kind"] == "open"))
    return blocks.join(tops, "grp").mapInArrow(run, _SUMS).groupBy("grp", "tree", "node").applyInArrow(choose, _BEST)


def _grown(top: DataFrame, best: DataFrame, cuts: DataFrame, local_rows: int, depth: int | None) -> DataFrame:
    """The nodes after the open ones have been split by their best cut."""
    best = best.join(cuts, "grp")
    splits = F.col("feature") >= 0
    bound = F.get(F.get("cuts", F.col("feature")), F.col("bin"))
    none = F.lit(None).cast("double")
    done = best.select(
        "grp", "tree", "node", F.when(splits, "split").otherwise("leaf").alias("kind"), "feature", "bin", F.when(splits, bound).alias("threshold"),
        (F.col("s") / F.col("w") + F.col("middle")).alias("value"), "gain", "w",
    )
    child = lambda side, w, s: F.struct((F.col("node") * 2 + side).alias("node"), w.alias("w"), (s / w + F.col("middle")).alias("value"))
    rw, rs = F.col("w") - F.col("lw"), F.col("s") - F.col("ls")
    below = best.where(splits).select(
        "grp", "tree", F.explode(F.array(child(0, F.col("lw"), F.col("ls")), child(1, rw, rs))).alias("c")
    )
    # The highest bit of a node's number tells its level.
    level = F.length(F.bin("c.node")) - 1
    kind = F.when(level >= depth, "leaf") if depth is not None else F.lit(None).cast("string")
    kind = F.coalesce(kind, F.when(F.col("c.w") > local_rows, "open"))
    opened = below.select(
        "grp", "tree", "c.node", kind.alias("kind"), F.lit(-1).alias("feature"), F.lit(-1).alias("bin"), none.alias("threshold"), "c.value",
        F.lit(0.0).alias("gain"), "c.w",
    ).where("kind is not null")
    return top.where("kind <> 'open'").unionByName(done).unionByName(opened)


def fit_forests(
    runs: DataFrame,
    features: list[str],
    label: str = "val_accuracy",
    by: list[str] | None = None,
    trees: int = 100,
    depth: int | None = None,
    seed: int = 42,
    sample: bool = True,
    local_values: int = LOCAL_VALUES,
    block_values: int = BLOCK_VALUES,
    together: int = TOGETHER,
    wave_values: int = WAVE_VALUES,
    wave_bytes: int = WAVE_BYTES,
) -> Forests:
    """A forest of ``label`` on ``features`` for every group of ``by``; missing values count as 0, rows without a label don't count.

    ``depth`` None: no limit. Rows that are equal in every column are sampled alike; without ``sample`` every tree has all rows.
    """
    by, seed = by or [], seed if sample else None
    local_rows, block_rows = (max(1, n // len(features)) for n in (local_values, block_values))
    if depth is not None and not 1 <= depth <= 60:
        raise ValueError("depth is 1 to 60, or None for no limit")
    filled = fill_missing_hp(runs.withColumn("_row", F.xxhash64(*runs.columns)), features).where(present(label).isNotNull())
    values = [F.col(c).cast("double").alias(f"x{f}") for f, c in enumerate(features)]
    rows = filled.select(_group(by).alias("grp"), F.col("_row").alias("row"), *values, F.col(label).cast("double").alias("y"))
    # Around a value near the mean, sums of squares lose nothing to a large level.
    middle = F.avg("y").cast("float").cast("double").alias("middle")
    sizes = written_table(rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), middle), "forest-sizes")
    large, small = sizes.where(F.col("n") > local_rows), sizes.where(F.col("n") <= local_rows)
    no_large = large.isEmpty()
    parts = []
    if no_large or not small.isEmpty():
        own = rows if no_large else rows.join(small.select("grp"), "grp", "left_semi")
        parts.append(written_table(_finished_whole(own, small, len(features), trees, depth, seed, together), "forest-subtrees", compression="zstd"))
    numbers = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    top = written_table(
        large.select(
            "grp", numbers, F.lit(1).cast("bigint").alias("node"), F.lit("open").alias("kind"), F.lit(-1).alias("feature"), F.lit(-1).alias("bin"),
            F.lit(None).cast("double").alias("threshold"), F.lit(None).cast("double").alias("value"), F.lit(0.0).alias("gain"), F.col("n").cast("double").alias("w"),
        ),
        "forest-top",
    )
    if not no_large:
        many = large.agg(F.sum(F.ceil(F.col("n") / block_rows)).alias("blocks")).first()["blocks"]
        blocks = written_table(_packed_blocks(_blocks(rows, large, block_rows), len(features), min(many, MOST_TASKS)), "forest-blocks")
        with _even_tasks(runs.sparkSession):
            cuts = _cuts(blocks, large, len(features)).join(large.select("grp", "middle"), "grp")
            step = 0
            while not top.where("kind = 'open'").isEmpty():
                best = written_table(_best(blocks, top, cuts, seed), f"forest-best-{step}")
                top = written_table(_grown(top, best, cuts, local_rows, depth), f"forest-top-{step}")
                step += 1
            at_once, tasks = _wave(blocks, large, local_rows, len(features), trees, seed, wave_values, wave_bytes)
            for t in range(0, trees, at_once):
                finished = _finished(blocks, top, range(t, min(trees, t + at_once)), depth, seed, tasks, cuts)
                parts.append(written_table(finished, "forest-subtrees", compression="zstd"))
    subtrees = reduce(DataFrame.unionByName, parts)
    return Forests(features, {c: t for c, t in runs.dtypes if c in by}, trees, top, subtrees)


def _at_once(rows: int, features: int, trees: int, values: int, together: int = 1) -> int:
    """How many trees are finished at once: whole batches, one at least."""
    fitting = values // max(1, rows * features)
    return min(trees, max(1, fitting // together) * together)


def _wave(blocks: DataFrame, large: DataFrame, local_rows: int, features: int, trees: int, seed: int | None, values: int, most: int) -> tuple[int, int]:
    """How many trees of large groups are finished at once, and over how many tasks they go."""
    of_x, of_y = blocks.agg(F.sum(F.length("x")).alias("x"), F.sum(F.length("y")).alias("y")).first()
    found = large.agg(F.sum("n").alias("rows"), F.sum(2 * F.ceil(F.col("n") / local_rows)).alias("nodes")).first()
    # A sample has 0.632 of the rows; a packed weight takes about a quarter of a byte, a bin a byte at most.
    copy = (min(of_x, found["rows"] * features) + of_y + found["rows"] / 4) * (1.0 if seed is None else 0.64)
    at_once = min(_at_once(found["rows"], features, trees, values), max(1, int(most / copy)))
    return at_once, max(1, min(4 * at_once * found["nodes"], MOST_TASKS))


def _finished_whole(rows: DataFrame, sizes: DataFrame, features: int, trees: int, depth: int | None, seed: int | None, together: int) -> DataFrame:
    """The trees of small groups, some of a group grown by one task from all its rows.

    The rows are shuffled once: the branches of the union read the same exchange.
    """
    out = _schema(_SUBTREES)
    found = sizes.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.max("n"), F.lit(0)).alias("longest")).first()
    together = max(1, min(together, trees, TASK_VALUES // max(1, found["longest"] * features)))

    def finish_of(numbers: range):
        def finish(table: pa.Table) -> pa.Table:
            row, y = (np.concatenate([_unpack(p.as_py(), t) for p in table.column(c)]) for c, t in (("row", np.int64), ("y", float)))
            # In the order of the hashes, so that sums don't depend on how rows arrive.
            order = np.argsort(row, kind="stable")
            bins, bounds = _binned(table.column("x"), len(y))
            row, y = row.take(order), y.take(order)
            for f in range(features):
                bins[f] = bins[f].take(order)
            grown = [(t, tr.grow_binned(bins, bounds, y, tr.sample_weights(row, t, seed), depth)) for t in numbers]
            columns = [[table.column("grp")[0].as_py()] * len(grown), [t for t, _ in grown], [1] * len(grown)]
            return _table(out, [*columns, *([tree[k] for _, tree in grown] for k in range(6))])

        return finish

    pieces = _packed_pieces(rows.withColumn("block", F.lit(0).cast("bigint")), features)
    # Keys are few and long, so every one gets a task.
    dealt = pieces.repartition(max(1, min(4 * found["groups"], MOST_TASKS)), "grp")
    batches = [range(t, min(trees, t + together)) for t in range(0, trees, together)]
    return reduce(DataFrame.unionByName, [dealt.groupBy("grp").applyInArrow(finish_of(b), _SUBTREES) for b in batches])


def _finished(blocks: DataFrame, top: DataFrame, trees: range, depth: int | None, seed: int | None, tasks: int, cuts: DataFrame) -> DataFrame:
    """The subtrees below the nodes of ``top``, each grown by one task from the rows that reach it."""
    met_schema, out = _schema(_MEETING), _schema(_SUBTREES)

    def route(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            known: dict[str, tuple] = {}
            for k, (grp, block) in enumerate(zip(part.column("grp").to_pylist(), part.column("block").to_pylist())):
                tops, bounds = known.setdefault(grp, ()) or (_top_of(part, k), _bounds_of(part, k))
                known[grp] = tops, bounds
                row, bins, of_y = _unpack(part.column("row")[k].as_py(), np.int64), _bins_of(part.column("x")[k].as_py(), bounds), _columns(part.column("y")[k].as_py())
                for tree in trees:
                    at, w = _reached(tops[tree], bins), tr.sample_weights(row, tree, seed)
                    reach = np.flatnonzero((w > 0) & tops[tree].below.take(at))
                    at = at.take(reach)
                    reach = reach.take(np.argsort(at.astype(np.uint16 if len(tops[tree].number) <= 65_536 else np.int64), kind="stable"))
                    times = np.bincount(at, minlength=len(tops[tree].number))
                    here = np.flatnonzero(times)
                    groups = np.split(reach, np.cumsum(times[here])[:-1]) if len(here) else []
                    w, x = w.astype(np.uint8), [_pack(bins.take(g, axis=1)) for g in groups]
                    packed = [[_pack(w.take(g)) for g in groups], x, [_pack_columns([_some(c, g) for c in of_y]) for g in groups]]
                    routed = [[grp] * len(groups), [tree] * len(groups), tops[tree].number[here], [block] * len(groups), *packed]
                    yield from _table(met_schema, routed).to_batches()

    def bound(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bounds between bins, and the value around which sums are taken, as block -1 of every subtree."""
        for part in parts:
            for k, grp in enumerate(part.column("grp").to_pylist()):
                tops, bounds = _top_of(part, k), _pack_columns([(None, b) for b in (*_bounds_of(part, k), np.array([part.column("middle")[k].as_py()]))])
                for tree in trees:
                    nodes = tops[tree].number[tops[tree].below]
                    yield from _table(met_schema, [[grp] * len(nodes), [tree] * len(nodes), nodes, [-1] * len(nodes), *([v] * len(nodes) for v in (b"", bounds, b""))]).to_batches()

    every = _tops(top, cuts)
    met = blocks.join(every, "grp").mapInArrow(route, _MEETING).unionByName(every.mapInArrow(bound, _MEETING))

    def finish(table: pa.Table) -> pa.Table:
        grp, tree, node = (table.column(c)[0].as_py() for c in ("grp", "tree", "node"))
        # In the order of blocks and of the rows in them, so that sums don't depend on how rows arrive.
        table = table.sort_by("block")
        *bounds, middle = (b for _, b in _columns(table.column("x")[0].as_py()))
        table = table.slice(1)
        w, y = (np.concatenate([_unpack(p.as_py(), t) for p in table.column(c)]) for c, t in (("w", np.uint8), ("y", float)))
        bins = np.concatenate([_unpack(p.as_py(), np.uint8).reshape(len(bounds), -1) for p in table.column("x")], axis=1)
        left = None if depth is None else depth - (node.bit_length() - 1)
        grown = tr.grow_binned(bins, bounds, y, w.astype(float), left, float(middle[0]))
        return _table(out, [[grp], [tree], [node], *([grown[k]] for k in range(6))])

    # Keys are few and long, so every one gets a task.
    return met.repartition(tasks, "grp", "tree", "node").groupBy("grp", "tree", "node").applyInArrow(finish, _SUBTREES)


def _binned(packed: pa.ChunkedArray, rows: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bins and their bounds, from the values of all blocks, one column at a time."""
    parts = [_columns(p.as_py()) for p in packed]
    features = len(parts[0])
    bounds, bins = [], np.empty((features, rows), dtype=np.uint8)
    for f in range(features):
        column = [p[f] for p in parts]
        bounds.append(tr.cuts_of_codes(column))
        bins[f] = np.concatenate([_decoded((codes, tr.binned(values[:, None], bounds[-1:])[0])) for codes, values in column])
    return bins, bounds


def _trees_of(table: pa.Table) -> Iterator[tuple[int, int, tr.Tree]]:
    """Number, root and nodes of the subtrees."""
    columns = [table.column(c).combine_chunks() for c in tr.Tree._fields]
    for k, (tree, node) in enumerate(zip(table.column("tree").to_pylist(), table.column("node").to_pylist())):
        yield tree, node, tr.Tree(*(c[k].values.to_numpy() for c in columns))


def predict_forests(model: Forests, rows: DataFrame, block_values: int = ASK_VALUES, walk_nodes: int = WALK_NODES, wave_values: int = WAVE_VALUES) -> DataFrame:
    """The rows with ``prediction``, the mean over the trees of their group; NULL where a group has no forest.

    Rows travel once, packed with all their columns, to the whole forest of their group if it has at most ``walk_nodes`` nodes.
    Otherwise they walk through the top of every tree and then meet the subtree they have reached, in parts of bounded size
    and some trees at a time.
    """
    nodes = model.subtrees.groupBy("grp").agg(F.sum(F.size("feature")).alias("nodes"))
    large = written_table(nodes.where(F.col("nodes") > walk_nodes).select("grp"), "forest-large")
    block_rows = max(1, block_values // len(model.features))
    if large.isEmpty():
        return _predict_whole(model, rows, block_rows)
    every = _asking(model, rows)
    small = every.join(large, "grp", "left_anti").select("_all.*")
    every = every.join(large, "grp", "left_semi")
    asked = every.select("grp", "row", F.array(*[f"x{f}" for f in range(len(model.features))]).alias("x"))
    # Equal rows have equal predictions.
    asked = written_table(asked.dropDuplicates(["row"]), "forest-asked")
    sizes = asked.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    asked = _blocks(asked, written_table(sizes, "forest-asked-sizes"), block_rows)
    at_once = _at_once(asked.count(), len(model.features), model.trees, wave_values)
    parts = [written_table(_predict_large(model, asked, range(t, min(model.trees, t + at_once))), "forest-parts") for t in range(0, model.trees, at_once)]
    found = reduce(DataFrame.unionByName, parts).groupBy(F.col("row").alias("_row")).agg((F.sum("value") / model.trees).alias("prediction"))
    found = written_table(found, "forest-predictions")
    walked = every.join(found, F.col("row") == F.col("_row"), "left").select("_all.*", "prediction")
    return walked.unionByName(_predict_whole(model, small, block_rows))


def _asking(model: Forests, rows: DataFrame) -> DataFrame:
    """Group, hash and values of every row, and the row as it is in ``_all``."""
    filled = fill_missing_hp(rows.withColumn("_all", F.struct(*rows.columns)), model.features)
    values = [F.col(c).cast("double").alias(f"x{f}") for f, c in enumerate(model.features)]
    return filled.select(_group(list(model.by)).alias("grp"), F.xxhash64("_all").alias("row"), *values, "_all")


def _predict_whole(model: Forests, rows: DataFrame, block_rows: int) -> DataFrame:
    """Predictions where the forest of a group meets its rows as a whole."""
    features, model_trees, names = len(model.features), model.trees, rows.columns
    asked = _asking(model, rows)
    sizes = written_table(asked.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), "forest-asked-sizes")
    packed_ddl, found_ddl = "grp string, block bigint, x binary, rest binary", "rest binary, found binary"
    packed_schema, found_schema = _schema(packed_ddl), _schema(found_ddl)
    most_rows = max(1, PIECE_VALUES // features)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grp, block, piece in _in_pieces(batches, most_rows):
            x = np.stack(_numpy(piece, *(f"x{f}" for f in range(features))))
            rest = pa.Table.from_arrays(piece.column("_all").combine_chunks().flatten(), names=names)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rest.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_table(rest)
            yield from _table(packed_schema, [[grp], [block], [_pack(x)], [sink.getvalue().to_pybytes()]]).to_batches()

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        """Without a forest nothing is found."""
        if not left.num_rows:
            return found_schema.empty_table()
        forest = _forest_of(right)
        found = [_pack(tr.predict_all(forest, _unpack(x.as_py()).reshape(features, -1).T) / model_trees if forest else np.zeros(0)) for x in left.column("x")]
        return pa.table([left.column("rest"), pa.chunked_array([pa.array(found, pa.binary())])], schema=found_schema)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rest, found in zip(batch.column("rest"), batch.column("found")):
                rest, found = pa.ipc.open_stream(rest.as_buffer()).read_all(), _unpack(found.as_py())
                found = pa.array(found) if len(found) else pa.nulls(rest.num_rows, pa.float64())
                yield from rest.append_column("prediction", found).to_batches(max_chunksize=50_000)

    listed = F.array_sort(F.collect_list(F.struct("node", "feature", "threshold", "value")))
    none = lambda kind: F.lit(None).cast(kind)
    tops = model.top.groupBy("grp", "tree").agg(listed.alias("n")).select(
        "grp", "tree", F.lit(0).cast("bigint").alias("node"), "n.feature", "n.threshold", none("array<int>").alias("left"), none("array<int>").alias("right"),
        "n.value", none("array<double>").alias("gain"), F.col("n.node").alias("heap"),
    )
    forests = model.subtrees.withColumn("heap", none("array<bigint>")).unionByName(tops)
    pieces = _blocks(asked, sizes, block_rows).mapInArrow(pack, packed_ddl)
    parts = sizes.select(F.col("grp").alias("_grp"), F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / block_rows) - 1)).alias("in_block"))
    sides = forests.join(parts, F.col("grp") == F.col("_grp")).drop("_grp")
    found = pieces.groupBy("grp", "block").cogroup(sides.groupBy("grp", "in_block")).applyInArrow(meet, found_ddl)
    return found.mapInArrow(unpack, T.StructType([*rows.schema.fields, T.StructField("prediction", T.DoubleType())]))


def _forest_of(nodes: pa.Table) -> list[tr.Tree]:
    """The trees in order, whole: the subtrees, or the nodes above them, if any, with the subtrees below."""
    is_top = pa.compute.equal(nodes.column("node"), 0)
    top = nodes.filter(is_top).combine_chunks()
    tops = {
        t: [top.column(c)[k].values.to_numpy(zero_copy_only=False) for c in ("heap", "feature", "threshold", "value")]
        for k, t in enumerate(top.column("tree").to_pylist())
    }
    subtrees: dict[int, list] = {t: [] for t in tops}
    for tree, node, below in _trees_of(nodes.filter(pa.compute.invert(is_top))):
        subtrees.setdefault(tree, []).append((node, below))
    return [_whole(*tops[t], below) if t in tops else below[0][1] for t, below in sorted(subtrees.items(), key=lambda t: t[0])]


def _whole(heap: np.ndarray, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray, below: list[tuple[int, tr.Tree]]) -> tr.Tree:
    """One tree of the nodes above and the subtrees below them."""
    starts = len(heap) + np.cumsum([0, *(len(t.feature) for _, t in below)])
    place = dict(zip(heap.tolist(), range(len(heap)))) | {node: int(at) for (node, _), at in zip(below, starts)}
    split = feature >= 0
    sides = [np.array([place[2 * n + side] if s else -1 for n, s in zip(heap.tolist(), split.tolist())], dtype=np.int64) for side in (0, 1)]
    moved = [[np.where(t.feature >= 0, t[k] + at, -1) for (_, t), at in zip(below, starts)] for k in (2, 3)]
    above = [feature, np.where(split, threshold, 0.0), *sides, value, np.zeros(len(heap))]
    rest = [[t[k] for _, t in below] if k not in (2, 3) else moved[k - 2] for k in range(6)]
    return tr.Tree(*(np.concatenate([a, *r]) for a, r in zip(above, rest)))


def _standing(x: np.ndarray, top: pa.Table, tree: int) -> tuple[np.ndarray, pa.Table]:
    """The node that every row has reached in a tree, and the nodes of that tree."""
    nodes = top.filter(pa.compute.equal(top.column("tree"), tree)).sort_by("node")
    splits = nodes.filter(pa.compute.equal(nodes.column("kind"), "split"))
    return tr.walk(x, *_numpy(splits, "node", "feature", "threshold")), nodes


def _predict_large(model: Forests, asked: DataFrame, trees: range) -> DataFrame:
    """Sums of the values of some trees by row."""
    routed_schema = "grp string, tree int, node bigint, part bigint, row bigint, x array<double>, value double"
    value_schema = "row bigint, value double"
    routed_out, value_out = _schema(routed_schema), _schema(value_schema)
    parts = 16

    def route(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return routed_out.empty_table()
        x, row, found = _matrix(left), left.column("row"), []
        part = pa.array(np.abs(tr.mixed(row.to_numpy(), 3).astype(np.int64) % parts))
        for tree in trees:
            at, nodes = _standing(x, right, tree)
            leaves = nodes.filter(pa.compute.equal(nodes.column("kind"), "leaf"))
            number, value = _numpy(leaves, "node", "value")
            place = np.minimum(np.searchsorted(number, at), max(len(number) - 1, 0))
            ended = number[place] == at if len(number) else np.zeros(len(at), dtype=bool)
            known = pa.array(value[place] if len(number) else np.zeros(len(at)), mask=~ended)
            columns = [left.column("grp"), pa.array(np.full(len(at), tree), pa.int32()), pa.array(at), part, row, left.column("x"), known]
            found.append(pa.table(columns, schema=routed_out))
        return pa.concat_tables(found)

    def value_of(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return value_out.empty_table()
        _, _, tree = next(_trees_of(right))
        return _table(value_out, [left.column("row").combine_chunks(), tr.predict(tree, _matrix(left))])

    side = _for_each(asked, "block", model.top, "grp")
    routed = asked.groupBy("grp", "block").cogroup(side.groupBy("grp", "in_block")).applyInArrow(route, routed_schema)
    routed = written_table(routed, "forest-routed")
    keys = ["grp", "tree", "node"]
    waiting = routed.where("value is null")
    below = _for_each(waiting, "part", model.subtrees, *keys)
    values = waiting.groupBy(*keys, "part").cogroup(below.groupBy(*keys, "in_part")).applyInArrow(value_of, value_schema)
    every = routed.where("value is not null").select("row", "value").unionByName(values)
    return every.groupBy("row").agg(F.sum("value").alias("value"))


def forest_importance(model: Forests) -> DataFrame:
    """Importance of every column by group, summing to 1: the mean over trees of the share of the error its splits lower."""
    names = F.array(*[F.lit(c) for c in model.features])
    top = model.top.where("kind = 'split'").select("grp", "tree", "feature", "gain")
    pairs = F.explode(F.arrays_zip("feature", "gain")).alias("s")
    below = model.subtrees.select("grp", "tree", pairs).where("s.feature >= 0").select("grp", "tree", "s.feature", "s.gain")
    gains = top.unionByName(below).groupBy("grp", "tree", "feature").agg(F.sum("gain").alias("gain"))
    in_tree = Window.partitionBy("grp", "tree")
    shares = gains.withColumn("share", F.try_divide("gain", F.sum("gain").over(in_tree)))
    groups = model.top.select("grp").union(model.subtrees.select("grp")).distinct()
    every = groups.select("grp", F.posexplode(names).alias("feature", "hp"))
    found = every.join(shares.groupBy("grp", "feature").agg(F.sum("share").alias("share")), ["grp", "feature"], "left")
    share = F.coalesce("share", F.lit(0.0))
    whole = F.sum(share).over(Window.partitionBy("grp"))
    found = found.withColumn("importance", F.coalesce(F.try_divide(share, whole), F.lit(0.0)))
    return with_groups(model, found).select(*model.by, "hp", "importance")


def root_splits(model: Forests) -> DataFrame:
    """The first split of every tree; feature -1: none. Large groups have it above their subtrees."""
    above = model.top.where("node = 1").select("grp", "tree", "feature", F.coalesce("threshold", F.lit(0.0)).alias("threshold"), "gain")
    first = [F.get(c, F.lit(0)).alias(c) for c in ("feature", "threshold", "gain")]
    return above.unionByName(model.subtrees.where("node = 1").select("grp", "tree", *first))


def with_groups(model: Forests, table: DataFrame) -> DataFrame:
    """A table of the model with the columns that name a group."""
    return table.withColumns({c: F.get_json_object("grp", f"$.{c}").cast(kind) for c, kind in model.by.items()})
