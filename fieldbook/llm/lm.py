"""A hashed maximum-entropy language model, trained and applied in sparse numpy batches.

A token belongs to a leaf: each of the most frequent tokens has its own, the others share leaves by their last
two bytes. Leaves form classes. The model gives the class from features of the tokens before (last token,
last pair, and the skips to the second and third before), then the leaf in the class from class-wise
features, by two small softmaxes; inside a shared leaf a token has its add-one share of the counts, and
tokens never seen have one share in every leaf.

Single tokens before are features by their leaf; the last pair is one by the two tokens themselves, whatever
their number. Pairs and class-wise features are hashed into tables whose rows grow with the square root of the
distinct tokens counted in training (``table_rows``).

Counts cover all training texts. Gradient steps run in the tasks, from shared weights; after a round, each
feature's changes are averaged over tasks by how often a task met the feature. A round steps on every
``rounds``-th position of a text, each round from another one, so that the rounds together step once on
every position of every training text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from fieldbook.llm.tables import Scratch, partitions
from fieldbook.llm.words import BLANKS, Splitter, mixed, pieces

CLASSES = MEMBERS = 32
SHARED = 64
OWN = CLASSES * MEMBERS - SHARED
START = CLASSES * MEMBERS
SINGLES = 3 * (START + 1)
LEAST_PAIRS, LEAST_CLASSWISE = 1 << 13, 1 << 14
ROWS_BY_ROOT = 8
BLOCK = 256
# Features of up to so many positions of a batch are summed position by position.
SHORT = 8
# Tokens whose counts every task holds; the counts of all others are looked up by bucket.
CACHED = 1 << 16
PREFIX = 17
END = np.uint64(0x0E9D0F7E870F7E87)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all tokens, each text's closed by END; their last two bytes; where each text begins."""
    words = Splitter(BLANKS)(texts)
    counts = words.counts()
    first = np.concatenate([[0], np.cumsum(counts + 1)])
    keys = np.full(first[-1], END, np.uint64)
    last = np.zeros(first[-1], np.uint16)
    at = np.arange(len(words.key)) + np.repeat(np.arange(len(counts)), counts)
    keys[at] = words.key
    tail = words.data[words.end - 1].astype(np.uint16)
    before = np.where(words.end - words.start > 1, words.data[np.maximum(words.end - 2, 0)], 0).astype(np.uint16)
    lower = lambda b: np.where((b >= 65) & (b <= 90), b + 32, b)
    last[at] = lower(before) << 8 | lower(tail)
    return keys, last, first


def shared_leaf(last: np.ndarray) -> np.ndarray:
    """Which of the shared leaves a token with these last bytes is in."""
    return (mixed(last.astype(np.uint64)) % np.uint64(SHARED)).astype(np.uint8)


def table_rows(n_distinct: int, least: int) -> int:
    """Rows of a hashed table: the power of two from ``ROWS_BY_ROOT`` times the root of the distinct tokens up.

    A row has 128 bytes: 10^7 distinct tokens give 4 MB a table, 10^9 give 32 MB.
    """
    rows = least
    while rows * rows < ROWS_BY_ROOT ** 2 * n_distinct:
        rows *= 2
    return rows


def _by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def counted(training: DataFrame, buckets: int) -> DataFrame:
    """One row a bucket: its tokens' keys, counts and shared leaves, packed, and sums over them.

    A task sends each distinct token of about 2 MB of text once. Tokens are known by 64-bit keys.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, n in pieces(batch.column("text")):
                keys, last, _ = tokens(batch.column("text").slice(a, n))
                keys, at, times = np.unique(keys, return_index=True, return_counts=True)
                leaf = shared_leaf(last[at])
                order, cuts = _by_bucket(keys, buckets)
                parts = [order[cuts[b]:cuts[b + 1]] for b in range(buckets)]
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([b for b, p in enumerate(parts) if len(p)], pa.int32()),
                    **{
                        name: pa.array([column[p].tobytes() for p in parts if len(p)], pa.binary())
                        for name, column in (("keys", keys), ("times", times.astype(np.int64)), ("leaves", leaf))
                    },
                })

    def merge(group: pa.Table) -> pa.Table:
        whole = lambda name, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in group[name]])
        keys, at, which = np.unique(whole("keys", np.uint64), return_index=True, return_inverse=True)
        times = np.bincount(which, whole("times", np.int64)).astype(np.int64)
        leaves = whole("leaves", np.uint8)[at]
        size = np.zeros(64, np.int64)
        np.add.at(size, np.int64(np.log2(times)), 1)
        return pa.table({
            "bucket": group["bucket"].slice(0, 1), "keys": [keys.tobytes()], "times": [times.tobytes()], "leaves": [leaves.tobytes()],
            "n_tokens": [int(times.sum())], "n_distinct": [len(keys)], "sizes": [size.tolist()],
            "leaf_tokens": [np.bincount(leaves, times, SHARED).astype(np.int64).tolist()],
            "leaf_distinct": [np.bincount(leaves, minlength=SHARED).tolist()],
        })

    packed = training.select("text").mapInArrow(pack, "bucket int, keys binary, times binary, leaves binary")
    return packed.groupBy("bucket").applyInArrow(
        merge, "bucket int, keys binary, times binary, leaves binary, n_tokens bigint, n_distinct bigint, sizes array<bigint>, "
        "leaf_tokens array<bigint>, leaf_distinct array<bigint>",
    )


@dataclass(frozen=True)
class Model:
    """Cached tokens with counts and leaves, the leaves' priors, and the weights of all feature rows.

    Rows of weights: three times the leaves, ``pairs``, then the class-wise rows.
    """

    keys: np.ndarray
    times: np.ndarray
    leaf: np.ndarray
    shared_total: np.ndarray
    class_prior: np.ndarray
    member_prior: np.ndarray
    weights: np.ndarray
    pairs: int
    n_tokens: int
    n_distinct: int

    @cached_property
    def prefixes(self) -> np.ndarray:
        """Where the cached tokens of each prefix of ``PREFIX`` bits begin; a last entry closes them."""
        return np.searchsorted(self.keys >> np.uint64(64 - PREFIX), np.arange((1 << PREFIX) + 1, dtype=np.uint64))

    def look(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among the cached tokens, and whether the token is one of them."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        prefix = (keys >> np.uint64(64 - PREFIX)).astype(np.int64)
        at, stop = self.prefixes[prefix], self.prefixes[prefix + 1]
        at = np.minimum(at, len(self.keys) - 1)
        cached = self.keys[at] == keys
        # Keys are hashes: a prefix has few of them, and most tokens are found at once.
        left = np.flatnonzero(~cached & (at + 1 < stop))
        while len(left):
            at[left] += 1
            cached[left] = self.keys[at[left]] == keys[left]
            left = left[~cached[left] & (at[left] + 1 < stop[left])]
        return at, cached

    def leaves(self, keys: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, cached = self.look(keys)
        leaf = OWN + shared_leaf(last).astype(np.int64)
        own = cached & (self.leaf[at] >= 0) if len(self.keys) else cached
        leaf[own] = self.leaf[at[own]]
        return leaf, at, cached


def prepared(counts: DataFrame) -> Model:
    """An untrained model: counts and priors. What reaches the driver has a fixed bound."""
    length = lambda name: [F.sum(F.get(name, F.lit(k))) for k in range(64)]
    row = list(counts.agg(F.sum("n_tokens"), F.sum("n_distinct"), *length("sizes"), *length("leaf_tokens"), *length("leaf_distinct")).first())
    n_tokens, n_distinct = row[0] or 0, row[1] or 0
    sizes, leaf_tokens, leaf_distinct = (np.array([x or 0 for x in part], np.int64) for part in np.split(np.array(row[2:], object), 3))
    # The smallest power of two with at most CACHED tokens of so many occurrences or more.
    least = next((k for k in range(64) if sizes[k:].sum() <= CACHED), 63)
    # If that leaves too few for the leaves, as with very many words of like counts, a hashed share of the next power fills up.
    room, band = CACHED // 2, max(0, least - 1)
    share = room / sizes[band] if sizes[least:].sum() < OWN and least > 0 and sizes[band] else 0.0
    under = np.uint64(min(share, 0.5) * 2.0 ** 64)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, t, s in zip(batch.column("keys"), batch.column("times"), batch.column("leaves")):
                keys, times = np.frombuffer(k.as_buffer(), np.uint64), np.frombuffer(t.as_buffer(), np.int64)
                keep = (times >= 1 << least) | ((times >= 1 << band) & (mixed(keys) < under))
                leaves = np.frombuffer(s.as_buffer(), np.uint8)[keep]
                yield pa.RecordBatch.from_pydict({"key": pa.array(keys[keep].view(np.int64)), "times": pa.array(times[keep]), "leaf": pa.array(leaves.astype(np.int32))})

    top = counts.select("keys", "times", "leaves").mapInArrow(frequent, "key bigint, times bigint, leaf int").toArrow()
    keys, times, shared = top["key"].to_numpy().view(np.uint64), top["times"].to_numpy(), top["leaf"].to_numpy()
    order = np.argsort(keys)
    keys, times, shared = keys[order], times[order], shared[order]
    leaf = np.full(len(keys), -1, np.int64)
    own = np.lexsort((keys, -times))[:OWN]
    leaf[own] = np.arange(len(own))
    total = (leaf_tokens - np.bincount(shared[own], times[own], SHARED) + leaf_distinct - np.bincount(shared[own], minlength=SHARED) + 1).astype(float)
    mass = np.concatenate([np.pad(times[own].astype(float), (0, OWN - len(own))), total]).reshape(CLASSES, MEMBERS)
    with np.errstate(divide="ignore"):
        logs = np.log(mass)
        classes = np.log(mass.sum(axis=1))
    floor = lambda x: np.maximum(x, -1e4).astype(np.float32)
    pairs, inner = table_rows(n_distinct, LEAST_PAIRS), table_rows(n_distinct, LEAST_CLASSWISE)
    weights = np.zeros((SINGLES + pairs + inner, CLASSES), np.float32)
    return Model(keys, times, leaf, total, floor(classes), floor(logs), weights, pairs, n_tokens, n_distinct)


def features(model: Model, keys: np.ndarray, leaf: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Class feature rows of every position: last, second and third token before, and the last pair."""
    place = np.arange(len(leaf)) - np.repeat(first[:-1], np.diff(first))

    def back(k: int, values: np.ndarray, none) -> np.ndarray:
        before = np.full(len(values), none, values.dtype)
        if k < len(values):
            before[k:] = values[:-k]
        before[place < k] = none
        return before

    singles = [back(k, leaf, START) + (k - 1) * (START + 1) for k in (1, 2, 3)]
    pair = mixed(mixed(back(1, keys, 0)) + back(2, keys, 0)) % np.uint64(model.pairs)
    return np.stack([*singles, pair.astype(np.int64) + SINGLES])


def classwise(model: Model, rows: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Leaf feature rows: the last and the second token before, with the class."""
    before = SINGLES + model.pairs
    hashed = mixed((rows[:2] * CLASSES + of).astype(np.uint64)) % np.uint64(len(model.weights) - before)
    return hashed.astype(np.int64) + before


def _logits(model: Model, weights: np.ndarray, rows: np.ndarray, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leaf feature rows; logits per class, then per leaf of the right class, less the largest of a position; what is right."""
    n, of = len(leaf), leaf // MEMBERS
    inner = classwise(model, rows, of)
    z, more = np.empty((2 * n, CLASSES), weights.dtype), np.empty((n, CLASSES), weights.dtype)
    for part, found, prior in ((z[:n], rows, model.class_prior), (z[n:], inner, model.member_prior[of])):
        # Rows are within the weights; "clip" only spares numpy a copy.
        np.take(weights, found[0], axis=0, out=part, mode="clip")
        for r in found[1:]:
            part += np.take(weights, r, axis=0, out=more, mode="clip")
        part += prior
    # Numpy finds the largest of many short rows faster down the columns of their transpose.
    z -= np.ascontiguousarray(z.T).max(axis=0)[:, None]
    return inner, z, np.concatenate([of, leaf % MEMBERS])


def _log_sums(z: np.ndarray) -> np.ndarray:
    return np.log(np.exp(z).sum(axis=1, keepdims=True))


def _step(model: Model, weights: np.ndarray, rows: np.ndarray, leaf: np.ndarray) -> tuple[list, np.ndarray]:
    """Log-probabilities per class and per leaf of the right class, and the right leaf's."""
    inner, z, right = _logits(model, weights, rows, leaf)
    z -= _log_sums(z)
    n = len(leaf)
    own = z[np.arange(2 * n), right]
    return [(rows, z[:n], right[:n]), (inner, z[n:], right[n:])], own[:n] + own[n:]


def _order(rows: np.ndarray) -> np.ndarray:
    """The stable order of row numbers below 2**32. Numpy sorts numbers of 16 bits by radix, wider ones slower."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    high = (rows >> 16).astype(np.uint16)
    return order[np.argsort(high[order], kind="stable")] if high.any() else order


def _summed(values: np.ndarray, of: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values[of]`` over the runs that begin at ``starts``.

    ``reduceat`` takes its time per run and column, so only runs of more than ``SHORT`` go there; of all shorter
    ones the second rows are added at once, then the third, and so on.
    """
    length = np.diff(np.append(starts, len(of)))
    sums = np.take(values, of[starts], axis=0, mode="clip")
    several = np.flatnonzero((length > 1) & (length <= SHORT))
    several = several[np.argsort(-length[several].astype(np.int8), kind="stable")]
    begin, rest = starts[several], np.searchsorted(-length[several], -np.arange(2, SHORT + 1), "right")
    added = np.take(values, of[begin + 1], axis=0, mode="clip")
    for k, n in enumerate(rest[1:], 2):
        added[:n] += np.take(values, of[begin[:n] + k], axis=0, mode="clip")
    sums[several] += added
    many = np.flatnonzero(length > SHORT)
    if len(many):
        ends = np.cumsum(length[many])
        places = np.arange(ends[-1]) + np.repeat(starts[many] - ends + length[many], length[many])
        sums[many] = np.add.reduceat(np.take(values, of[places], axis=0, mode="clip"), ends - length[many], axis=0)
    return sums


def descend(model: Model, parts: Iterator[pa.Array], turn: int, rounds: int, rate: float, batch: int = 1024, first_square: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Weights after AdaGrad steps over a task's texts, less those before; how often each row was met.

    The steps are on the places of each text that leave ``turn`` by ``rounds``.
    """
    weights, squares = model.weights.copy(), np.full(len(model.weights), first_square, np.float32)
    met = np.zeros(len(weights), np.int64)
    for texts in parts:
        for a, n in pieces(texts):
            keys, last, first = tokens(texts.slice(a, n))
            leaf = model.leaves(keys, last)[0]
            rows = features(model, keys, leaf, first)
            place = np.arange(len(leaf)) - np.repeat(first[:-1], np.diff(first))
            chosen = np.flatnonzero(place % rounds == turn)
            for b in range(0, len(chosen), batch):
                at = chosen[b:b + batch]
                n, outer = len(at), rows[:, at]
                inner, pull, right = _logits(model, weights, outer, leaf[at])
                pull -= _log_sums(pull)
                np.negative(np.exp(pull, out=pull), out=pull)
                pull[np.arange(2 * n), right] += 1
                # Class-wise rows are never the others, so one pass serves both.
                flat = np.concatenate([outer.ravel(), inner.ravel()])
                order = _order(flat)
                ids = flat[order]
                starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
                sums = _summed(pull, order % n + n * (order >= 4 * n), starts)
                ids = ids[starts]
                met[ids] += np.diff(np.append(starts, len(flat)))
                squares[ids] += (sums ** 2).mean(axis=1)
                sums *= rate
                sums /= np.sqrt(squares[ids])[:, None]
                sums += np.take(weights, ids, axis=0, mode="clip")
                weights[ids] = sums
    return weights - model.weights, met


def _averaged(group: pa.Table) -> pa.Table:
    """The mean change of a block's rows, weighted by how often each was met."""
    met = np.stack([np.frombuffer(x.as_buffer(), np.int64) for x in group["met"]])
    total, change = met.sum(axis=0), np.zeros((BLOCK, CLASSES))
    for m, x in zip(met, group["change"]):
        change += m[:, None] * np.frombuffer(x.as_buffer(), np.float32).reshape(BLOCK, CLASSES)
    change /= np.maximum(total, 1)[:, None]
    return pa.table({
        "block": group["block"].slice(0, 1), "task": pa.array([group["task"][0].as_py() // BLOCK], pa.int64()),
        "met": [total.tobytes()], "change": [change.astype(np.float32).tobytes()],
    })


CHANGES = "block int, task bigint, met binary, change binary"


def trained(training: DataFrame, model: Model, rounds: int = 2, rate: float = 0.3) -> Model:
    """The model after ``rounds`` of gradient steps, each from the shared weights of the round before.

    Every position of ``training`` is stepped on in one of the rounds.

    A task reports its changes by blocks of rows; blocks are averaged 256 tasks at a time until one
    is left, so no task gathers more. The weights grow as ``table_rows`` says.
    """
    spark = training.sparkSession
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], turn=turn, shared=shared) -> Iterator[pa.RecordBatch]:
            task = TaskContext.get().partitionId()
            change, met = descend(shared.value, (b.column("text") for b in batches), turn, rounds, rate)
            for block in range(-(-len(met) // BLOCK)):
                part = slice(block * BLOCK, (block + 1) * BLOCK)
                if met[part].any():
                    fill = BLOCK - len(met[part])
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array([block], pa.int32()), "task": pa.array([task], pa.int64()),
                        "met": [np.pad(met[part], (0, fill)).tobytes()], "change": [np.pad(change[part], ((0, fill), (0, 0))).tobytes()],
                    })

        texts = training.select("text")
        changes, tasks = texts.mapInArrow(run, CHANGES), max(1, texts.rdd.getNumPartitions())
        while tasks > BLOCK:
            tasks = -(-tasks // BLOCK)
            changes = changes.groupBy("block", F.floor(F.col("task") / BLOCK).alias("part")).applyInArrow(_averaged, CHANGES)
        weights = model.weights.copy()
        for row in changes.groupBy("block").applyInArrow(_averaged, CHANGES).collect():
            part = slice(row.block * BLOCK, min(len(weights), (row.block + 1) * BLOCK))
            weights[part] += np.frombuffer(row.change, np.float32).reshape(BLOCK, CLASSES)[:part.stop - part.start]
        model = replace(model, weights=weights)
    return model


def leaf_scores(model: Model, keys: np.ndarray, leaf: np.ndarray, first: np.ndarray, batch: int = 1 << 10) -> np.ndarray:
    """The model's log-probability of every position's leaf."""
    rows = features(model, keys, leaf, first)
    scores = np.zeros(len(leaf), model.weights.dtype)
    for b in range(0, len(leaf), batch):
        part = slice(b, min(len(leaf), b + batch))
        _, z, right = _logits(model, model.weights, rows[:, part], leaf[part])
        own = z[np.arange(len(z)), right] - _log_sums(z)[:, 0]
        scores[part] = own[:len(own) // 2] + own[len(own) // 2:]
    return scores


def held_out(doc_id: Column) -> Column:
    """Whether the doc_id is kept from learning: its CRC-32 as text leaves 2 by 7. False for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.float64)])[first])


def scored(docs: DataFrame, rounds: int = 2) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10).

    Columns used: doc_id, text. A null text is empty: its only token is the end. Repeated rows are
    scored and, unless held out, learned from as often as they occur. With nothing to learn from, every
    base probability is 1. ``docs`` must give the same rows in the same order when a task is
    repeated, as files do.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    buckets = 2 * partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
    training = rows.where("not held_out")
    counts = scratch.put(counted(training, buckets), "counts")
    model = trained(training, prepared(counts), rounds)
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for a, n in pieces(batch.column("text")):
                keys, last, first = tokens(batch.column("text").slice(a, n))
                leaf, at, cached = model.leaves(keys, last)
                share = np.where(leaf >= OWN, -np.log10(model.shared_total[np.maximum(leaf - OWN, 0)]), 0.0)
                times = np.where(cached, model.times[at] if len(model.times) else 0, 0)
                seen = np.log10(times + 1.0)
                share += np.where(leaf >= OWN, seen, 0.0)
                model_sum = _sums(leaf_scores(model, keys, leaf, first) / np.log(10) + share, first)
                part = batch.slice(a, n)
                info = pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "n_tokens": pa.array(np.diff(first)),
                    "known": pa.array(_sums(cached, first).astype(np.int64)), "seen": pa.array(_sums(seen, first)), "model": pa.array(model_sum),
                })
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, info.schema) as writer:
                    writer.write_batch(info)
                of = np.repeat(np.arange(n, dtype=np.uint32), np.diff(first))[~cached]
                rare = keys[~cached]
                order, cuts = _by_bucket(rare, buckets)
                some = [b for b in range(buckets) if cuts[b] < cuts[b + 1] or b == chunk % buckets]
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(some, pa.int32()), "chunk": pa.array([chunk] * len(some), pa.int64()),
                    "keys": pa.array([rare[order[cuts[b]:cuts[b + 1]]].tobytes() for b in some], pa.binary()),
                    "docs": pa.array([of[order[cuts[b]:cuts[b + 1]]].tobytes() for b in some], pa.binary()),
                    "info": pa.array([sink.getvalue().to_pybytes() if b == chunk % buckets else None for b in some], pa.binary()),
                })
                chunk += 1

    def look(asked: pa.Table, known: pa.Table) -> pa.Table:
        keys = np.frombuffer(known["keys"][0].as_buffer(), np.uint64) if known.num_rows else np.zeros(0, np.uint64)
        times = np.frombuffer(known["times"][0].as_buffer(), np.int64) if known.num_rows else np.zeros(0, np.int64)
        out = {"ids": [], "known": [], "seen": []}
        for k, d in zip(asked["keys"], asked["docs"]):
            want, of = np.frombuffer(k.as_buffer(), np.uint64), np.frombuffer(d.as_buffer(), np.uint32)
            found = np.zeros(len(want), np.int64)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                found = np.where(keys[at] == want, times[at], 0)
            ids, which = np.unique(of, return_inverse=True)
            out["ids"].append(ids.tobytes())
            out["known"].append(np.bincount(which, found > 0, len(ids)).astype(np.uint32).tobytes())
            out["seen"].append(np.bincount(which, np.log10(found + 1.0), len(ids)).tobytes())
        return pa.table({"chunk": asked["chunk"], **{c: pa.array(v, pa.binary()) for c, v in out.items()}, "info": asked["info"]})

    def gather(group: pa.Table) -> pa.Table:
        info = pa.ipc.open_stream(next(x for x in group["info"].to_pylist() if x is not None)).read_all()
        columns = {c: info[c].to_numpy().copy() for c in ("known", "seen", "model", "n_tokens")}
        for i, k, s in zip(group["ids"], group["known"], group["seen"]):
            ids, seen = np.frombuffer(i.as_buffer(), np.uint32), np.frombuffer(s.as_buffer(), np.float64)
            columns["known"][ids] += np.frombuffer(k.as_buffer(), np.uint32).astype(np.int64)
            columns["seen"][ids] += seen
            columns["model"][ids] += seen
        base = columns["seen"] - columns["n_tokens"] * np.log10(n_tokens + n_distinct + 1.0)
        return pa.table({
            "doc_id": info["doc_id"], "held_out": info["held_out"], "n_tokens": info["n_tokens"], "n_known": pa.array(columns["known"], pa.int64()),
            "train_tokens": pa.array([n_tokens] * info.num_rows, pa.int64()), "base_score": base, "score": columns["model"],
        })

    n_tokens, n_distinct = model.n_tokens, model.n_distinct
    asked = rows.mapInArrow(score, "bucket int, chunk bigint, keys binary, docs binary, info binary")
    answered = asked.groupBy("bucket").cogroup(counts.select("bucket", "keys", "times").groupBy("bucket")).applyInArrow(
        look, "chunk bigint, ids binary, known binary, seen binary, info binary"
    )
    return answered.groupBy("chunk").applyInArrow(
        gather, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )
