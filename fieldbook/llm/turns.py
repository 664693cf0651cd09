"""A trie of conversation prefixes from ROLLUPs over positional turn-id columns.

A turn's id is a 128-bit hash of its role and text. The turns of a conversation at positions 1 to ``width``
make the columns t1..tw of one row, those at the next positions a row of the next block. A block is rolled up
over (t1..tw): grouping_id tells how many positions a result row holds, so one ROLLUP gives the nodes of all
depths of the block. A node is known by a key, the chained hash of the ids on its path; the rows of a block
begin at the key of the block before, so blocks are rolled up one after the other, with ever fewer rows.
What a node sums over its subtree comes from ROLLUPs over the nodes themselves, from the last block to the first.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fieldbook.llm.tables import Scratch, numbered

WIDTH = 16
EVERY, MOST = 5, 9
_ROOT = bytes(16)
_CHUNK = 1 << 16


def _hash(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def positions(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, pos (from 0, by turn, null first; equal turns by role and text), id and bytes of every turn.

    All turns of the table are numbered in one order, range by range, so a very long conversation is not one task's work.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", text("role").alias("role"), text("text").alias("said")
    ).select(
        "conv_id", "turn", "role", F.md5("said").alias("tie"), F.octet_length("said").cast("long").alias("bytes"),
        _hash(F.octet_length("role").cast("string").cast("binary"), F.lit(b":"), F.col("role").cast("binary"), F.col("said").cast("binary")).alias("id"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("tie")]
    placed = scratch.put(numbered(scratch, turns, order, "place").select("conv_id", "place", "id", "bytes"), "placed")
    first = placed.groupBy("conv_id").agg(F.min("place").alias("first"))
    return placed.join(first, "conv_id").select("conv_id", (F.col("place") - F.col("first")).alias("pos"), "id", "bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations c whose first h = crc32(c) % 9 turns are those of conversation c - c % 5, if any: all ids, and the turns.

    Where that conversation has fewer turns, all of them come. Own turns follow after the first h.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST).alias("h")
    held = turns.groupBy("conv_id").agg(F.count("*").alias("held"))
    convs = held.select("conv_id", h, (F.col("conv_id") - F.col("conv_id") % EVERY).alias("base"))
    convs = convs.join(held.select(F.col("conv_id").alias("base"), F.col("held").alias("has")), "base", "left")
    convs = convs.select("conv_id", "base", "h", F.least("h", F.coalesce("has", F.lit(0))).alias("taken"))
    start = turns.where(F.col("pos") < MOST - 1).withColumnRenamed("conv_id", "base")
    taken = start.join(convs, "base").where("pos < taken").select("conv_id", "pos", "id", "bytes")
    own = turns.join(convs, "conv_id").where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "id", "bytes")
    return convs.select("conv_id"), taken.unionByName(own)


def _names(letter: str, width: int) -> list[str]:
    return [f"{letter}{k}" for k in range(1, width + 1)]


def blocks(turns: DataFrame, width: int) -> DataFrame:
    """One row a conversation and block: block, conv_id, t1..tw (ids) and b1..bw (bytes)."""
    slot, block = F.col("pos") % width + 1, F.floor(F.col("pos") / width).cast("int").alias("block")
    at = [F.max(F.when(slot == k, F.col(c))).alias(f"{letter}{k}") for c, letter in (("id", "t"), ("bytes", "b")) for k in range(1, width + 1)]
    return turns.groupBy(block, "conv_id").agg(*at)


def _key(width: int, level: Column) -> Column:
    """The key of the node ``level`` positions after ``start``."""
    ids = F.slice(F.array(*_names("t", width)), 1, level)
    return F.aggregate(ids, F.col("start"), lambda key, turn: _hash(key, turn))


def _rolled(rows: DataFrame, width: int, *sums: Column) -> DataFrame:
    """A block rolled up over start, t1..tw: ``level`` positions are held, of which the last is one."""
    ids = _names("t", width)
    level = (F.lit(width) - F.bit_count(F.grouping_id())).alias("level")
    held = F.when(F.col("level") > 0, F.element_at(F.array(*ids), F.greatest(F.col("level"), F.lit(1))).isNotNull()).otherwise(F.col("level") == 0)
    return rows.rollup("start", *ids).agg(level, *sums).where(held)


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of one end after the other, comma-joined in pieces."""
    end, first, held, size = None, None, [], 0

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([end], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(held)])], ["end", "first", "ids"])

    for batch in batches:
        for key, conv in zip(batch.column("end").to_pylist(), batch.column("conv_id").to_pylist()):
            if key != end or size >= _CHUNK:
                if held:
                    yield piece()
                end, first, held, size = key, conv, [], 0
            held.append(str(conv))
            size += len(held[-1]) + 1
    if held:
        yield piece()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each end's pieces, one after the other."""
    end, state = None, sha256()

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([end], pa.binary()), pa.array([state.hexdigest()])], ["end", "sha"])

    for batch in batches:
        for key, ids in zip(batch.column("end").to_pylist(), batch.column("ids").to_pylist()):
            if key != end:
                if end is not None:
                    yield row()
                end, state = key, sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
    if end is not None:
        yield row()


def digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined conv_ids of each end: end, sha.

    Ranges of (end, conv_id) are joined in pieces, so that of a very common end only a few long strings meet.
    """
    pieces = ends.repartitionByRange("end", "conv_id").sortWithinPartitions("end", "conv_id").mapInArrow(_joined_ids, "end binary, first long, ids string")
    return pieces.repartition("end").sortWithinPartitions("end", "first").mapInArrow(_digests, "end binary, sha string")


def prefix_trie(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row a node of the trie of the rebuilt conversations of ``rows`` (see ``rebuilt``).

    Columns used: conv_id, turn, role, text. Returns conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256 (of the members that end there). Null role or text is empty, a null turn comes first, turns of one
    number are ordered by role and text, and a repeated row is a turn of its own. Rows without conv_id belong to no conversation. A
    conversation without turns after rebuilding is a member of the root. Very long texts enter by their hash and length, very long
    conversations take further blocks of ``width`` turns, one round each. An empty table has no nodes, not even a root; further columns
    are not read.
    """
    scratch = Scratch(rows.sparkSession, "turns")
    convs, turns = rebuilt(positions(rows, scratch))
    cut = scratch.put(blocks(turns, width), "cut")
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    starts = scratch.put(convs.join(sizes, "conv_id", "left").select("conv_id", F.coalesce("n", F.lit(0)).alias("n"), F.lit(_ROOT).alias("start")), "starts")
    total = starts.agg(F.count("*"), F.min("conv_id"), F.max("n")).first()
    ids, sizes = _names("t", width), _names("b", width)
    ends = starts.where("n = 0").select("conv_id", F.col("start").alias("end"))
    nodes = []

    def written(name: str, one: DataFrame) -> DataFrame:
        """The tables of this name of all blocks as one scan, so that plans do not grow with the blocks."""
        return scratch.spark.read.schema(one.schema).parquet(*(scratch.paths[f"{name}{block}"] for block in range(len(nodes))))

    # From the first block on: nodes, ends, and the keys at which the next block starts.
    for block in range(-(-(total[2] or 0) // width)):
        inside = F.least(F.col("n") - block * width, F.lit(width)).cast("int")
        here = starts.where(F.col("n") > block * width).join(cut.where(F.col("block") == block), "conv_id")
        here = scratch.put(here.select("conv_id", "n", "start", F.lit(block).alias("block"), _key(width, inside).alias("end"), *ids, *sizes), f"rows{block}")
        starts = here.where(F.col("n") > (block + 1) * width).select("conv_id", "n", F.col("end").alias("start"))
        rolled = _rolled(here, width, F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), *(F.max(b).alias(b) for b in sizes)).where("level > 0")
        nodes.append(scratch.put(rolled.select(
            "start", *ids, _key(width, F.col("level")).alias("key"), _key(width, F.col("level") - 1).alias("parent"), "conv_id",
            (F.col("level") + block * width).cast("long").alias("depth"), "n_convs", F.element_at(F.array(*sizes), F.col("level")).alias("bytes"),
        ), f"nodes{block}"))
    if nodes:
        ends = ends.union(written("rows", here).where(F.col("n") <= (F.col("block") + 1) * width).select("conv_id", "end"))
    ends = scratch.put(digests(ends), "ends")
    below = None
    # From the last block back: what each node and all below it sum up to; level 0 is what lies below a start.
    for block in reversed(range(len(nodes))):
        parents = [n.select(F.col("parent").alias("key")) for n in nodes[block:block + 2]]
        children = reduce(DataFrame.unionByName, parents).groupBy("key").agg(F.count("*").alias("n_children"))
        own = nodes[block].join(children, "key", "left").select(
            "start", *ids, ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"), F.col("n_children").isNull().cast("long").alias("leaves")
        )
        if below is not None:
            # A start is the last node of its path in this block.
            lower = below.withColumnsRenamed({"key": "start_key"})
            deep = nodes[block].join(lower, nodes[block]["key"] == lower["start_key"]).select("start", *ids, "saved", "leaves")
            own = own.unionByName(deep)
        rolled = _rolled(own, width, F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
        done = scratch.put(rolled.select(_key(width, F.col("level")).alias("key"), "level", "saved", "leaves"), f"sums{block}")
        below = done.where("level = 0").drop("level")
    columns = ["key", "parent", "conv_id", "depth", "n_convs"]
    root = starts.sparkSession.createDataFrame(
        [(bytearray(_ROOT), None, total[1], 0, total[0])] if total[0] else [], "key binary, parent binary, conv_id long, depth long, n_convs long"
    )
    every = root.unionByName(written("nodes", nodes[0]).select(columns)) if nodes else root
    if below is None:
        summed = root.select("key", F.lit(0).cast("long").alias("saved"), F.lit(1).cast("long").alias("leaves"))
    else:
        summed = below.unionByName(written("sums", done).where("level > 0").drop("level"))
    children = every.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    parents = every.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    ended = ends.select(F.col("end").alias("key"), "sha")
    scratch.keep_only("ends", *(f"{name}{block}" for block in range(len(nodes)) for name in ("nodes", "sums")))
    return every.join(summed, "key").join(children, "key", "left").join(ended, "key", "left").join(parents, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(sha256().hexdigest())).alias("ends_sha256"),
    )
