"""Operator 12: a trie of the beginnings that conversations share.

A sequence is a list of turns; its prefixes are named by 128-bit digests, each of the one before and the next turn. The
trie is compacted: a node stands where sequences branch or end, and keeps the digests along the edge above it. It
is kept as a table, a z-fast trie: a node is found by its handle, the digest at the depth of its edge that the
most powers of two divide. A sequence looks for the deepest node on its path by fat binary search: each step
tries the handle at the fattest depth left, so all sequences are done after as many joins as the longest length has bits.

Sequences are inserted in batches. All that are not in the trie yet search, beginning at the node they found
last; where one leaves an edge, the edge is cut; and of those that leave at the same place by the same turn, one
chosen by a hash is inserted as a leaf. The others go on below it in the next batch. A random
one shares more than half of the others do with probability 1/2, so the number of batches grows with the logarithm of the input.

Equal sequences are one sequence with many members. Sums over subtrees take every node to its ancestors,
found by doubling. In the end edges are expanded: every prefix of a sequence is a node again.

A sequence's digests are one row, 24 bytes a turn. Texts never leave the first scan.

Defined cases: a null role or text is empty; rows without ``conv_id`` belong to no conversation and are left out; turns sort
nulls first, ties by digest of role and text. Conversations without turns end at the root. Columns besides the four are not read.
An empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from runscope.llm.texts import arrow_batch, arrow_schema, small_batches
from runscope.session import written_table

#: The digest of the empty prefix.
ROOT = bytes(16)
SEQUENCES = "conv_id bigint, n int, keys array<binary>, sizes array<bigint>, last binary"
#: ``top`` and ``depth``: depths of both ends of the edge. ``edge``: the digests in between, the own one last.
NODES = (
    "key binary, parent binary, first binary, top int, depth int, handle int, handle_key binary, "
    "edge array<binary>, sizes array<bigint>"
)
#: Bytes of ids that one block of members holds.
BLOCK = 65_536
_EMPTY = hashlib.sha256().hexdigest()


def turn_lists(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order, each as a digest of role and text and the bytes of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.octet_length(text).cast("bigint").alias("size"),
    )
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("bigint"), turn.alias("turn"))
    lists = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return lists.withColumn("turns", F.transform("turns", lambda t: F.struct(t["digest"], t["size"])))


def rebuilt(lists: DataFrame, group: int = 5, most: int = 8) -> DataFrame:
    """Give conversations common beginnings: the first turns of the first conversation of their group replace their own.

    How many, 0 to ``most``, is the CRC of the id modulo ``most`` + 1.
    """
    begin = lists.select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most).alias("_begin"))
    own = lists.withColumn("_base", F.col("conv_id") - F.col("conv_id") % group)
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    none = F.slice("turns", 1, 0)
    turns = F.concat(
        F.slice(F.coalesce("_begin", none), F.lit(1), taken),
        F.slice("turns", taken + 1, F.greatest(F.size("turns") - taken, F.lit(0))),
    )
    return own.join(begin, "_base", "left").select("conv_id", turns.alias("turns"))


def sequences(lists: DataFrame) -> DataFrame:
    """Digests of all prefixes of every list of turns, and the digest of the whole."""
    small_batches(lists.sparkSession)
    out = arrow_schema(SEQUENCES)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for digests in batch.column("digests").to_pylist():
                at, chain = ROOT, []
                for digest in digests:
                    at = hashlib.blake2b(at + digest, digest_size=16).digest()
                    chain.append(at)
                keys.append(chain)
            last = [chain[-1] if chain else ROOT for chain in keys]
            yield arrow_batch([batch.column("conv_id"), list(map(len, keys)), keys, batch.column("sizes"), last], out)

    rows = lists.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.size").alias("sizes"))
    return rows.mapInArrow(run, SEQUENCES)


def _at(keys: str, depth: Column) -> Column:
    """The digest at ``depth``; NULL beyond the end."""
    return F.when(depth == 0, F.lit(ROOT)).otherwise(F.get(keys, depth - 1))


def _fattest(low: Column, high: Column) -> Column:
    """The number above ``low``, up to ``high``, that the most powers of two divide; both are equal in the bits above the result's."""
    zeros = F.length(F.bin(low.bitwiseXOR(high).cast("bigint"))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", high, zeros), zeros)


def _as_nodes(rows: DataFrame) -> DataFrame:
    """Nodes from rows with parent, top, depth, edge and sizes."""
    handle = _fattest(F.col("top"), F.col("depth"))
    return rows.select(
        F.element_at("edge", -1).alias("key"), "parent", F.get("edge", F.lit(0)).alias("first"), "top", "depth",
        handle.alias("handle"), F.get("edge", handle - F.col("top") - 1).alias("handle_key"), "edge", "sizes",
    )


def _search(active: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """Fat binary search. ``low``: depth of the deepest node on the path; ``child``: the node below on whose edge the path ends or leaves.

    ``depth`` is how far the path follows the trie.
    """
    handles = nodes.select(
        F.col("handle").alias("_handle"), F.col("handle_key").alias("_handle_key"),
        F.col("depth").alias("_depth"), F.col("key").alias("_key"),
    )
    state = active.withColumn("_high", F.col("n") + 1).withColumn("_exit", F.lit(None).cast("binary"))
    for _ in range(longest.bit_length()):
        going = (F.col("_high") - F.col("low") > 1) & F.col("_exit").isNull()
        probe = F.when(going, _fattest(F.col("low"), F.col("_high") - 1)).otherwise(-1)
        state = state.withColumn("_probe", probe)
        # Rows that are done keep their place by a key of their own.
        state = state.withColumn("_probe_key", F.when(going, _at("keys", F.col("_probe"))).otherwise(F.col("last")))
        same = (F.col("_probe") == F.col("_handle")) & (F.col("_probe_key") == F.col("_handle_key"))
        found = F.col("_key").isNotNull()
        below = found & (F.col("_depth") <= F.col("n")) & F.coalesce(_at("keys", F.col("_depth")) == F.col("_key"), F.lit(False))
        state = state.join(handles, same, "left").select(
            *active.columns[:-1],
            F.when(below, F.col("_depth")).otherwise(F.col("low")).alias("low"),
            F.when((F.col("_probe") > 0) & ~found, F.col("_probe")).otherwise(F.col("_high")).alias("_high"),
            F.when(found & ~below, F.col("_key")).otherwise(F.col("_exit")).alias("_exit"),
        )
    children = nodes.select(F.col("first").alias("_first"), F.col("key").alias("child"), "edge")
    next_key = F.coalesce(_at("keys", F.col("low") + 1), F.col("last"))
    state = state.withColumn("_next", next_key)
    going_on = (F.col("_next") == F.col("_first")) & (F.col("low") < F.col("n"))
    along = F.slice("keys", F.col("low") + 1, F.greatest(F.size("edge"), F.lit(0)))
    agree = F.zip_with("edge", along, lambda a, b: F.coalesce(a == b, F.lit(False)).cast("int"))
    common = F.coalesce(F.aggregate(agree, F.lit(0), lambda a, x: a + x), F.lit(0))
    return state.join(children, going_on, "left").select(
        *active.columns[:-1], "low", "child", (F.col("low") + common).alias("depth")
    )


def _cut(nodes: DataFrame, cuts: DataFrame) -> DataFrame:
    """Nodes with their edges cut at the given depths."""
    several = cuts.groupBy("child").agg(F.sort_array(F.collect_set("depth")).alias("_cuts"))
    ends = F.concat(F.array("top"), F.coalesce("_cuts", F.array().cast("array<int>")), F.array("depth"))
    rows = nodes.join(several, F.col("key") == F.col("child"), "left").withColumn("_ends", ends)
    rows = rows.select("*", F.posexplode(F.slice("_ends", F.lit(2), F.size("_ends") - 1)).alias("_i", "_end"))
    rows = rows.withColumn("_begin", F.get("_ends", F.col("_i")))
    skip = F.col("_begin") - F.col("top")
    part = lambda c: F.slice(c, skip + 1, F.col("_end") - F.col("_begin"))
    parent = F.when(skip == 0, F.col("parent")).otherwise(F.get("edge", skip - 1))
    return _as_nodes(
        rows.select(
            parent.alias("parent"), F.col("_begin").alias("top"), F.col("_end").alias("depth"),
            part("edge").alias("edge"), part("sizes").alias("sizes"),
        )
    )


def build(different: DataFrame) -> DataFrame:
    """The nodes below the root of the trie of different sequences."""
    spark = different.sparkSession
    nodes = spark.createDataFrame([], NODES)
    active = different.where("n > 0").withColumn("low", F.lit(0))
    longest = different.agg(F.max("n")).first()[0] or 0
    batch = 0
    while True:
        found = _search(active, nodes, longest if batch else 0)
        exits = written_table(found, f"trie-exits-{batch}")
        leaving = exits.where(F.col("n") > F.col("depth")).withColumn("_next", _at("keys", F.col("depth") + 1))
        chosen = leaving.groupBy("_next").agg(F.min(F.struct(F.xxhash64("conv_id"), "conv_id"))["conv_id"].alias("_chosen"))
        sorted_out = written_table(
            leaving.join(chosen, "_next").withColumn("_leaf", F.col("conv_id") == F.col("_chosen")), f"trie-leaving-{batch}"
        )
        rest = F.col("n") - F.col("depth")
        leaves = _as_nodes(
            sorted_out.where("_leaf").select(
                _at("keys", F.col("depth")).alias("parent"), F.col("depth").alias("top"), F.col("n").alias("depth"),
                F.slice("keys", F.col("depth") + 1, rest).alias("edge"), F.slice("sizes", F.col("depth") + 1, rest).alias("sizes"),
            )
        )
        cuts = exits.where(F.col("depth") > F.col("low")).select("child", "depth")
        nodes = written_table(_cut(nodes, cuts).unionByName(leaves), f"trie-nodes-{batch}")
        # What was not chosen follows the chosen one from the place where it left.
        active = sorted_out.where("not _leaf").select(*different.columns, F.col("depth").alias("low"))
        batch += 1
        if active.isEmpty():
            return nodes


def _ancestors(nodes: DataFrame) -> DataFrame:
    """Pairs of a node and itself or an ancestor, the root included; paths double with every step."""
    pairs = written_table(nodes.select("key", F.col("parent").alias("above"), F.lit(1).alias("far")), "trie-pairs-0")
    reach = 1
    while True:
        jump = pairs.where((F.col("far") == reach) & (F.col("above") != F.lit(ROOT)))
        if jump.isEmpty():
            break
        on = pairs.select(F.col("key").alias("_via"), F.col("above").alias("_above"), F.col("far").alias("_far"))
        longer = jump.join(on, F.col("above") == F.col("_via")).select("key", F.col("_above").alias("above"), F.col("far") + F.col("_far"))
        pairs = written_table(pairs.union(longer), f"trie-pairs-{reach}")
        reach *= 2
    own = nodes.select("key", F.col("key").alias("above"))
    return pairs.select("key", "above").union(own)


def _member_hashes(members: DataFrame) -> DataFrame:
    """key, ends_sha256: of the ids of all members, ascending and joined by commas.

    Ranges of the sorted ids become blocks first, so what meets by key is a small part of the rows even for a sequence that
    very many conversations share.
    """
    blocks_schema, hash_schema = "key binary, least bigint, ids string", "key binary, ends_sha256 string"
    block_out, hash_out = arrow_schema(blocks_schema), arrow_schema(hash_schema)

    def to_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, size = None, [], 0
        for batch in batches:
            blocks = []
            for key, conv_id in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if ids and (key != now or size >= BLOCK):
                    blocks.append((now, int(ids[0]), ",".join(ids)))
                    ids, size = [], 0
                now = key
                ids.append(str(conv_id))
                size += len(ids[-1]) + 1
            if blocks:
                yield arrow_batch(zip(*blocks), block_out)
        if ids:
            yield arrow_batch([[now], [int(ids[0])], [",".join(ids)]], block_out)

    def to_hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, value = None, None
        for batch in batches:
            done = []
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if key != now:
                    if now is not None:
                        done.append((now, value.hexdigest()))
                    now, value = key, hashlib.sha256(ids.encode())
                else:
                    value.update(b"," + ids.encode())
            if done:
                yield arrow_batch(zip(*done), hash_out)
        if now is not None:
            yield arrow_batch([[now], [value.hexdigest()]], hash_out)

    order = ["key", "conv_id"]
    blocks = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(to_blocks, blocks_schema)
    return blocks.repartition("key").sortWithinPartitions("key", "least").mapInArrow(to_hashes, hash_schema)


def _expanded(tops: DataFrame) -> DataFrame:
    """A row for every prefix, from the nodes at the ends of edges."""
    schema = (
        "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
        "saved_tokens bigint, ends_sha256 string"
    )
    out = arrow_schema(schema)
    fields = ("sizes", "top", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_below", "ends_sha256")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for sizes, top, conv, parent, convs, children, leaves, below, ends in zip(*(batch.column(c).to_pylist() for c in fields)):
                saved = np.cumsum(np.array(sizes[::-1], dtype=np.int64))[::-1] * (convs - 1) + below
                last = len(sizes) - 1
                rows += [
                    (conv, top + i + 1, parent if i == 0 else conv, convs, children if i == last else 1, leaves, int(saved[i]), ends if i == last else _EMPTY)
                    for i in range(last + 1)
                ]
            yield arrow_batch(zip(*rows) if rows else [()] * len(out), out)

    return tops.select(*fields).mapInArrow(run, schema)


def trie_nodes(rows: DataFrame) -> DataFrame:
    """Every prefix of the sequences in ``rows`` (from ``sequences``) with what its subtree holds.

    conv_id: the smallest member; parent_conv_id: that of the prefix one turn shorter; n_convs: members; n_children;
    n_leaves: prefixes without children in the subtree; saved_tokens: bytes of texts that members share, counted for
    all but one of them, over the subtree; ends_sha256: hash of the ids of members that end here.
    """
    rows = written_table(rows, "trie-sequences")
    ends = written_table(
        rows.groupBy(F.col("last").alias("key")).agg(F.min("conv_id").alias("least"), F.count(F.lit(1)).alias("own")), "trie-ends"
    )
    nodes = build(rows.join(ends.select(F.col("least").alias("conv_id")), "conv_id", "left_semi"))
    pairs = _ancestors(nodes)
    children = nodes.groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))

    node_ends = nodes.select("key").join(ends, "key", "left").join(children, "key", "left")
    none = F.lit(0).cast("bigint")
    leaf = F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint")
    own = written_table(
        node_ends.select("key", "least", F.coalesce("own", none).alias("own"), F.coalesce("n_children", none).alias("n_children"), leaf.alias("leaf")),
        "trie-own",
    )
    sums = [F.min("least").alias("conv_id"), F.sum("own").alias("n_convs"), F.sum("leaf").alias("n_leaves")]
    members = written_table(pairs.join(own, "key").groupBy("above").agg(*sums).withColumnRenamed("above", "key"), "trie-members")
    total = F.aggregate("sizes", none, lambda a, x: a + x)
    saved = nodes.select("key", total.alias("_bytes")).join(members, "key").select("key", (F.col("_bytes") * (F.col("n_convs") - 1)).alias("_saved"))
    below = pairs.where(F.col("key") != F.col("above")).join(saved, "key").groupBy("above").agg(F.sum("_saved").alias("saved_below"))
    hashes = written_table(_member_hashes(rows.select(F.col("last").alias("key"), "conv_id")), "trie-hashes")
    below = written_table(below.withColumnRenamed("above", "key"), "trie-saved")

    parents = members.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # Members that end at the root are no one's descendants.
    turnless = ends.where(F.col("key") == F.lit(ROOT)).select("key", F.col("least").alias("conv_id"), F.col("own").alias("n_convs"), none.alias("n_leaves"))
    at_root = members.where(F.col("key") == F.lit(ROOT)).unionByName(turnless)
    at_root = at_root.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_leaves").alias("n_leaves"))
    first = at_root.select("conv_id").first()
    # Nodes below the root have nothing to look for; a key of their own deals them out.
    parent = F.when(F.col("parent") == F.lit(ROOT), F.concat("key", F.lit(ROOT))).otherwise(F.col("parent"))
    tops = (
        nodes.select("key", parent.alias("parent"), "top", "sizes")
        .join(members, "key")
        .join(own.select("key", "n_children"), "key")
        .join(below, "key", "left")
        .join(hashes, "key", "left")
        .join(parents, "parent", "left")
        .withColumns(
            {
                "parent_conv_id": F.coalesce("parent_conv_id", F.lit(first["conv_id"] if first else None).cast("bigint")),
                "saved_below": F.coalesce("saved_below", none),
                "ends_sha256": F.coalesce("ends_sha256", F.lit(_EMPTY)),
            }
        )
    )
    root = (
        at_root.join(children, "key", "left").join(below, "key", "left").join(hashes, "key", "left")
        .select(
            "conv_id", none.alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"), "n_convs",
            F.coalesce("n_children", none).alias("n_children"), F.greatest("n_leaves", F.lit(1).cast("bigint")).alias("n_leaves"),
            F.coalesce("saved_below", none).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
        )
    )
    return reduce(DataFrame.unionByName, [root, _expanded(tops)])


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations as they are."""
    return trie_nodes(sequences(turn_lists(conversations)))
