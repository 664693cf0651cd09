"""Exact top-k search by inner product with a vector-approximation file.

Every vector has a coarse copy, the cell of each component. Blocks of queries scan blocks of
cells for bounds of the scores; the k-th largest lower bound of a query, over all blocks, is a threshold that
its best k scores reach. Rows whose upper bound reaches it are candidates. Exact vectors, of candidates only, are
then read in the order of their upper bounds, in steps of doubling length, until the k-th exact score is above
all upper bounds left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldbook.llm.tables import Scratch, partitions

SCALE = 64
CELL_BITS = 5
VECTORS, QUERIES = 2048, 1024
# Sums of so large products are exact in doubles.
EXACT = float(1 << 53)


def whole(vector: Column, scale: int = SCALE) -> Column:
    """Components as floor(scale * x), x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(vector: Column) -> Column:
    """Neither null nor holding a null, NaN or infinite component."""
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    return F.coalesce(~F.exists(vector, bad), F.lit(False))


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows packed as matrices of up to ``size`` vectors of one length: block, dims, rows, ids, vectors."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        held: dict[int, list[tuple[np.ndarray, ...]]] = {}

        def packed(dims: int, least: int) -> Iterator[pa.RecordBatch]:
            nonlocal block
            parts = tuple(np.concatenate(x) for x in zip(*held.pop(dims)))
            while len(parts[0]) >= least:
                block += 1
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([block], pa.int64()), "dims": pa.array([dims], pa.int32()),
                    **{c: pa.array([x[:size].tobytes()], pa.binary()) for c, x in zip(("rows", "ids", "vectors"), parts)},
                })
                parts = tuple(x[size:] for x in parts)
            if len(parts[0]):
                held[dims] = [parts]

        for batch in batches:
            lists = batch.column("vector")
            lengths = lists.value_lengths()
            for dims in lengths.unique().to_pylist():
                of = pc.equal(lengths, dims)
                matrix = lists.filter(of).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims) if dims else np.zeros((pc.sum(of).as_py(), 0))
                held.setdefault(dims, []).append((batch.column("row").filter(of).to_numpy(), batch.column("vec_id").filter(of).to_numpy(), matrix))
                if sum(len(part[0]) for part in held[dims]) >= size:
                    yield from packed(dims, size)
        for dims in list(held):
            yield from packed(dims, 1)

    return rows.select("row", "vec_id", "vector").mapInArrow(pack, "block bigint, dims int, rows binary, ids binary, vectors binary")


def _cells(vectors: np.ndarray, low: np.ndarray, width: np.ndarray) -> np.ndarray:
    return np.clip((vectors - low) // width, 0, (1 << CELL_BITS) - 1).astype(np.uint8)


def _with_cells(blocks: DataFrame) -> DataFrame:
    """Blocks with each component's cells in place of the vectors: the block's own grid, and its vectors' cells."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"low": [], "width": [], "cells": []}
            for dims, ids, raw in zip(batch.column("dims").to_pylist(), batch.column("ids"), batch.column("vectors")):
                vectors = np.frombuffer(raw.as_buffer(), np.float64).reshape(len(ids.as_buffer()) // 8, dims)
                low = vectors.min(axis=0)
                # Whole numbers, so that a cell's last value is one below the next cell's first.
                width = np.floor((vectors.max(axis=0) - low) / (1 << CELL_BITS)) + 1
                out["low"].append(low.tobytes())
                out["width"].append(width.tobytes())
                out["cells"].append(_cells(vectors, low, width).tobytes())
            yield pa.RecordBatch.from_pydict(
                {c: batch.column(c) for c in ("block", "dims", "rows", "ids")} | {c: pa.array(v, pa.binary()) for c, v in out.items()}
            )

    return blocks.mapInArrow(add, "block bigint, dims int, rows binary, ids binary, low binary, width binary, cells binary")


def _bounds(queries: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all scores of the queries with the vectors in the cells."""
    floor = cells * width + low
    span = width - 1
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    at_floor = queries @ floor.T
    # Doubles round only beyond EXACT; the bounds then give way by more than the sums can be off.
    largest = float(np.abs(queries).max(initial=0)) * float((np.abs(low) + width * (1 << CELL_BITS)).max(initial=0)) * max(1, queries.shape[1])
    slack = 0.0 if largest < EXACT else largest * 2.0 ** -40
    return at_floor + (down @ span)[:, None] - slack, at_floor + (up @ span)[:, None] + slack


def _open(row: dict) -> tuple[np.ndarray, ...]:
    dims = row["dims"]
    ids, q_ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["q_ids"], np.int64)
    matrix = lambda name, n, kind=np.float64: np.frombuffer(row[name], kind).reshape(n, dims)
    low, width = matrix("low", 1)[0], matrix("width", 1)[0]
    return ids, q_ids, matrix("q_vectors", len(q_ids)), matrix("cells", len(ids), np.uint8), low, width


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _thresholds(pairs: DataFrame, k: int) -> DataFrame:
    """Per block of queries, each query's k-th largest lower bound over all vectors but its own."""
    def lower(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            ids, q_ids, queries, cells, low, width = _open(row)
            bounds = _bounds(queries, cells, low, width)[0]
            bounds[q_ids[:, None] == ids[None, :]] = -np.inf
            best = np.full((len(q_ids), k), -np.inf)
            few = min(k, len(ids))
            best[:, :few] = -np.partition(-bounds, few - 1, axis=1)[:, :few]
            yield pa.RecordBatch.from_pydict({"q_block": pa.array([row["q_block"]]), "part": pa.array([row["block"] % 64]), "best": [best.tobytes()]})

    def merge(group: pa.Table) -> pa.Table:
        best = None
        for raw in group["best"]:
            part = np.frombuffer(raw.as_buffer(), np.float64).reshape(-1, k)
            best = part if best is None else -np.partition(-np.concatenate([best, part], axis=1), k - 1, axis=1)[:, :k]
        return pa.table({"q_block": group["q_block"].slice(0, 1), "part": group["part"].slice(0, 1), "best": [best.tobytes()]})

    kind = "q_block bigint, part bigint, best binary"
    merged = pairs.mapInArrow(lower, kind).groupBy("q_block", "part").applyInArrow(merge, kind)
    return merged.groupBy("q_block").applyInArrow(merge, kind).select("q_block", "best")


def _candidates(pairs: DataFrame, k: int) -> DataFrame:
    """``query`` and ``row`` of all pairs whose upper bound, ``upper``, reaches the query's threshold."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            ids, q_ids, queries, cells, low, width = _open(row)
            limit = np.frombuffer(row["best"], np.float64).reshape(-1, k).min(axis=1)
            upper = _bounds(queries, cells, low, width)[1]
            upper[q_ids[:, None] == ids[None, :]] = -np.inf
            q, v = np.nonzero((upper >= limit[:, None]) & (upper > -np.inf))
            number = lambda name, at: pa.array(np.frombuffer(row[name], np.int64)[at])
            yield pa.RecordBatch.from_pydict({"query": number("q_rows", q), "row": number("rows", v), "upper": pa.array(upper[q, v])})

    return pairs.mapInArrow(scan, "query bigint, row bigint, upper double")


def _scored(pairs: DataFrame) -> DataFrame:
    """``query``, ``vec_id`` and exact ``score`` of pairs that hold both vectors."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("q_vector", "vector"))
            largest = float(np.abs(one).max(initial=0)) * float(np.abs(other).max(initial=0))
            lengths = batch.column("vector").value_lengths().to_numpy()
            if largest * max(1, lengths.max(initial=0)) >= float(1 << 62):
                raise ValueError("components are too large for scores of 64 bits")
            # The running sum may pass 64 bits, but then differences of it are still right.
            sums = np.concatenate([[0], np.cumsum(one * other)])
            edges = np.concatenate([[0], np.cumsum(lengths)])
            yield pa.RecordBatch.from_pydict({"query": batch.column("query"), "vec_id": batch.column("vec_id"), "score": pa.array(sums[edges[1:]] - sums[edges[:-1]], pa.int64())})

    return pairs.select("query", "vec_id", "q_vector", "vector").mapInArrow(score, "query bigint, vec_id bigint, score bigint")


def _best(scored: DataFrame, key: str, k: int) -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = SCALE) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of each query's k largest scores.

    Columns used: vec_id, embedding. Candidates of a query are all rows but those of its own vec_id, of its
    vector's length; ties go to the smaller vec_id. Vectors that are null or hold null or non-finite
    components, and rows without vec_id, take no part. Rows that repeat both columns count once. A query
    with fewer candidates gets them all; an empty table gives an empty one. Of equal vectors only the k + 1
    smallest vec_ids enter the file, since no query can want another one. Every block of queries meets
    every block of cells in a task of its own, so memory is bounded by the blocks; what is read of exact vectors
    grows with the candidates, not with the meetings.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vafile")
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole(F.col("embedding"), scale).alias("vector")).distinct()
    numbered = lambda df: df.withColumn("row", F.monotonically_increasing_id())
    rows = scratch.put(rows, "all")
    queries = scratch.put(numbered(rows.where(is_query)), "queries")
    # The cut is made in each task before the shuffle, so a vector of very many rows is no hot group.
    same = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    rows = scratch.put(numbered(rows.withColumn("same", same).where(F.col("same") <= k + 1).drop("same")), "rows")
    file = scratch.put(_with_cells(_blocks(rows, VECTORS)), "file")
    asked = _blocks(queries, QUERIES).select("dims", *(F.col(old).alias(new) for old, new in (
        ("block", "q_block"), ("rows", "q_rows"), ("ids", "q_ids"), ("vectors", "q_vectors")
    )))
    asked = scratch.put(asked, "asked")
    # Which blocks meet is known from their numbers alone; each meeting is one row, dealt to a task by its own number.
    plan = asked.select("q_block", "dims").join(file.select("block", "dims"), "dims")
    plan = scratch.put(plan.withColumn("meeting", F.monotonically_increasing_id()), "plan")
    tasks = partitions(spark)

    def meetings(asked: DataFrame) -> DataFrame:
        left = plan.select("meeting", "block").join(file, "block").repartition(tasks, "meeting")
        right = plan.select("meeting", "q_block").join(asked.drop("dims"), "q_block").repartition(tasks, "meeting")
        return left.join(right.hint("merge"), "meeting")

    kept = ("rows", "queries", "file", "asked", "plan")
    scratch.keep_only(*kept)
    limits = scratch.put(_thresholds(meetings(asked), k), "limits")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("upper"), "row"))
    near = scratch.put(_candidates(meetings(asked.join(limits, "q_block")), k).withColumn("place", place), "near")
    scratch.keep_only("rows", "queries", "near")

    exact = rows.select("row", "vec_id", "vector")
    asking = queries.select(F.col("row").alias("query"), F.col("vector").alias("q_vector"))
    read, step = 0, 2 * k
    best, left = None, near
    while read == 0 or left.limit(1).count():
        new = _scored(left.where(F.col("place") <= read + step).join(exact, "row").join(asking, "query"))
        best = scratch.put(_best(new if best is None else best.drop("rank").unionByName(new), "query", k), "best")
        read, step = read + step, 2 * step
        certain = best.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") == k)
        left = near.where(F.col("place") > read).join(certain, "query", "left").where(F.col("least").isNull() | (F.col("upper") >= F.col("least"))).drop("n", "least")
    scratch.keep_only("queries", "best")
    found = best.drop("rank").join(queries.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id")), "query")
    return _best(found, "query_id", k).select("query_id", "rank", "vec_id", "score")
