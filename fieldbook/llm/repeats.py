"""Removing long byte strings that occur more than once, by run-length indexes dealt by content.

1. Every window of ``least`` bytes has an anchor: of its substrings of about a third of that length, the
   leftmost with the smallest hash. Equal windows have equal anchors at the same place, so only windows
   of an anchor that occurs again can repeat. Tasks list the anchors; Spark counts them.
2. The windows of one such anchor place follow each other and make one context, so every window lies in one
   context. Equal contexts, as copies have, are one entry with a count; if it is 2 or more, all of their bytes go.
3. Unlike contexts of an anchor meet in one task, which builds a run-length index of about a megabyte of them
   (see ``runindex``), streams the matching statistics over it and reports the matches that are long enough.
   An anchor with more contexts than fit is dealt by single windows instead, whose copies collapse in the
   tasks that list them.
4. Spans come back to the texts by the hash of a text; bytes in none of them are joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from fieldbook.llm import runindex
from fieldbook.llm.tables import Scratch
from fieldbook.llm.words import buffer_of, mixed, pieces

LEAST = 200
INDEX_BYTES = 1 << 20
GROUP_BYTES = 4 << 20
_CHUNK = 1 << 16
_SEEN = 500_000
_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_PLACE = np.uint64((1 << 21) - 1)


def anchor_bytes(least: int) -> int:
    return 1 << ((least // 2).bit_length() - 1)


def anchors(data: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of each anchor place, that place and its 64-bit hash; places count from the buffer's start.

    A place whose windows cross a chunk of the buffer comes twice, with its windows divided.
    """
    width = anchor_bytes(least)
    found = [[np.zeros(0, np.int64)] for _ in range(3)] + [[np.zeros(0, np.uint64)]]
    for at in range(int(bounds[0]), int(bounds[-1]) - least + 1, _CHUNK):
        part = data[at:min(at + _CHUNK + least - 1, int(bounds[-1]))]
        n = len(part) - least + 1
        lo, hi = np.searchsorted(bounds, at, "right") - 1, np.searchsorted(bounds, at + n, "left")
        ends = bounds[lo + 1:hi + 1]
        stop = np.repeat(ends, np.diff(np.clip(np.append(at, ends), at, at + n)))
        inside = stop - np.arange(at, at + n) >= least
        if not inside.any():
            continue
        h, step = _VALUES[part], 1
        while step < width:
            h = h[:-step] * np.uint64(0xD6E8FEB86659FD93 + 2 * step) + h[step:]
            h ^= h >> np.uint64(29)
            step *= 2
        h = mixed(h)
        low = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        size, span = 1, least - width + 1
        while 2 * size <= span:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        place = (np.minimum(low[:n], low[span - size:span - size + n]) & _PLACE).astype(np.int64)
        opens = inside.copy()
        opens[1:] &= ~inside[:-1] | (place[1:] != place[:-1])
        closes = inside.copy()
        closes[:-1] &= ~inside[1:] | (place[1:] != place[:-1])
        first = np.flatnonzero(opens)
        for into, values in zip(found, (first + at, np.flatnonzero(closes) + at, place[first] + at, h[place[first]])):
            into.append(values)
    return tuple(np.concatenate(x) for x in found)


def _listed(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in pieces(batch.column("text")):
                part = batch.slice(at, n)
                data, bounds = buffer_of(part.column("text"))
                first, _, place, key = anchors(data, bounds, least)
                text = np.searchsorted(bounds, first, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [part.column("h1").take(pa.array(text)), part.column("h2").take(pa.array(text)),
                     pa.array((place - bounds[text]).astype(np.int32)), pa.array(key.view(np.int64))],
                    ["h1", "h2", "place", "anchor"],
                )

    return run


def _contexts(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for at, n in pieces(batch.column("text")):
                part = batch.slice(at, n)
                data, bounds = buffer_of(part.column("text"))
                first, last, place, key = anchors(data, bounds, least)
                again = part.column("places")
                owner = np.repeat(bounds[:-1], again.value_lengths().to_numpy())
                known = np.isin(place, again.flatten().to_numpy() + owner)
                first, last, key = first[known], last[known] + least, key[known]
                raw, digests, bodies = memoryview(data), [], []
                for lo, hi in zip(first.tolist(), last.tolist()):
                    body = raw[lo:hi]
                    digest = xxhash.xxh3_128_digest(body)
                    digests.append(digest)
                    if digest in seen:
                        bodies.append(None)
                    else:
                        if len(seen) >= _SEEN:
                            seen.clear()
                        seen.add(digest)
                        bodies.append(bytes(body))
                text = np.searchsorted(bounds, first, "right") - 1
                names = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [part.column("h1").take(pa.array(text)), part.column("h2").take(pa.array(text)),
                     pa.array((first - bounds[text]).astype(np.int32)), pa.array((last - bounds[text]).astype(np.int32)),
                     pa.array(names[:, 0].copy()), pa.array(names[:, 1].copy()), pa.array(key.view(np.int64)), pa.array(bodies, pa.binary())],
                    ["h1", "h2", "lo", "hi", "c1", "c2", "anchor", "body"],
                )

    return run


def _matched(least: int, most: int):
    """Over rows ordered by anchor and context: the long matches between unlike contexts of an anchor."""

    def report(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        index = runindex.build([h[2] for h in held], least)
        string, lo, hi = runindex.long_matches(index, least)
        names = np.array([h[:2] for h in held], np.int64)[string]
        return pa.RecordBatch.from_arrays(_match_rows(names[:, 0], names[:, 1], lo, hi), ["c1", "c2", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group, size, anchor = [], [], 0, None
        for batch in batches:
            for key, c1, c2, body in zip(*(batch.column(c).to_pylist() for c in ("anchor", "c1", "c2", "body"))):
                if key != anchor:
                    if len(group) > 1:
                        held += group
                        size += sum(len(g[2]) for g in group)
                    group, anchor = [], key
                    if size >= most:
                        yield report(held)
                        held, size = [], 0
                if not group or group[-1][:2] != (c1, c2):
                    group.append((c1, c2, body))
        if len(group) > 1:
            held += group
        if held:
            yield report(held)

    return run


_RECORD = np.dtype([("w1", "<u8"), ("w2", "<u8"), ("c1", "<i8"), ("c2", "<i8"), ("at", "<i4"), ("copies", "<i4")])
MATCH = "c1 long, c2 long, lo int, hi int"


def _match_rows(c1: np.ndarray, c2: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[pa.Array]:
    return [pa.array(np.ascontiguousarray(x)) for x in (c1, c2, lo.astype(np.int32), hi.astype(np.int32))]


def _windows(least: int, buckets: int, most: int):
    """Packed records of every unlike window in ``most`` bytes of contexts, by bucket of the window's hash."""

    def records(bodies: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, bytes]]:
        sizes = np.array([len(b) - least + 1 for _, _, b in bodies])
        found = np.zeros(sizes.sum(), _RECORD)
        digests = b"".join(xxhash.xxh3_128_digest(memoryview(b)[i:i + least]) for _, _, b in bodies for i in range(len(b) - least + 1))
        found["w1"], found["w2"] = np.frombuffer(digests, "<u8").reshape(-1, 2).T
        for k in (0, 1):
            found[("c1", "c2")[k]] = np.repeat([b[k] for b in bodies], sizes)
        found["at"] = np.arange(len(found)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        found = found[np.lexsort((found["w2"], found["w1"]))]
        fresh = np.ones(len(found), bool)
        fresh[1:] = (found["w1"][1:] != found["w1"][:-1]) | (found["w2"][1:] != found["w2"][:-1])
        copies = np.diff(np.append(np.flatnonzero(fresh), len(found)))
        found["copies"] = np.repeat(np.minimum(copies, 2), copies)
        # Windows that meet here already repeat; of them one record tells the others.
        yield -1, found[found["copies"] > 1].tobytes()
        found = found[fresh]
        bucket = (found["w1"] % np.uint64(buckets)).astype(np.int64)
        found, bucket = found[by := np.argsort(bucket, kind="stable")], bucket[by]
        for part in np.split(np.arange(len(found)), np.flatnonzero(np.diff(bucket)) + 1):
            yield int(bucket[part[0]]), found[part].tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("c1", "c2", "body"))):
                held.append(row)
                size += len(row[2])
                if size >= most:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)

    def packed(held) -> pa.RecordBatch:
        bucket, data = zip(*records(held))
        return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(data, pa.binary())], ["bucket", "records"])

    return run


def _repeated(least: int):
    """Windows of a bucket with two records or with copies where they come from."""

    def marks(held: list[bytes], here: bool) -> pa.RecordBatch:
        found = np.frombuffer(b"".join(held), _RECORD)
        if not here:
            found = found[np.lexsort((found["w2"], found["w1"]))]
            fresh = np.ones(len(found), bool)
            fresh[1:] = (found["w1"][1:] != found["w1"][:-1]) | (found["w2"][1:] != found["w2"][:-1])
            first = np.flatnonzero(fresh)
            size = np.diff(np.append(first, len(found)))
            found = found[np.repeat(size > 1, size) & (found["copies"] == 1)]
        # Windows of a context that follow each other are one match.
        found = found[np.lexsort((found["at"], found["c2"], found["c1"]))]
        opens = np.ones(len(found), bool)
        opens[1:] = (found["c1"][1:] != found["c1"][:-1]) | (found["c2"][1:] != found["c2"][:-1]) | (np.diff(found["at"]) > 1)
        first = np.flatnonzero(opens)
        last = np.append(first[1:], len(found)) - 1 if len(found) else first
        return pa.RecordBatch.from_arrays(
            _match_rows(found["c1"][first], found["c2"][first], found["at"][first], found["at"][last] + least), ["c1", "c2", "lo", "hi"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("records").to_pylist()):
                if bucket == -1:
                    yield marks([data], True)
                    continue
                if bucket != last and held:
                    yield marks(held, False)
                    held = []
                last = bucket
                held.append(data)
        if held:
            yield marks(held, False)

    return run


CUT = "struct<n_bytes:bigint, n_removed:bigint, n_spans:bigint, removed:array<struct<begin:int,end:int>>, text:binary>"
_CUT = pa.struct([
    ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
    ("removed", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))), ("text", pa.binary()),
])


def _cutter():
    @F.arrow_udf(CUT)
    def cut(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in parts:
            found = []
            for text, marks in zip(texts.cast(pa.large_binary()), spans.to_pylist()):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                gone: list[list[int]] = []
                for mark in sorted((m["lo"], m["hi"]) for m in marks or ()):
                    if gone and mark[0] <= gone[-1][1]:
                        gone[-1][1] = max(gone[-1][1], mark[1])
                    else:
                        gone.append([*mark])
                edges = [0, *(x for g in gone for x in g), len(raw)]
                found.append({
                    "n_bytes": len(raw), "n_removed": sum(e - b for b, e in gone), "n_spans": len(gone),
                    "removed": [{"begin": b, "end": e} for b, e in gone],
                    "text": b"".join(raw[b:e] for b, e in zip(edges[::2], edges[1::2])),
                })
            yield pa.array(found, _CUT)

    return cut


def without_repeats(docs: DataFrame, least: int = LEAST, index_bytes: int = INDEX_BYTES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``docs`` (as the struct ``row``) with ``cut``: n_bytes, n_removed, n_spans, the spans removed and the bytes left.

    Column used: text, as UTF-8 bytes. A byte goes if a string of ``least`` bytes around it also starts anywhere
    else, in this row or another; matches may overlap and are judged on the input. Spans that touch
    are one. A null or empty text has no bytes and loses none, as any text shorter than ``least``. Rows
    are told apart by nothing but their text: repeated rows of ``least`` bytes or more lose all of it. A very long
    text is hashed a megabyte at a time, but must fit into a worker like any cell. An empty table gives
    an empty table; columns of any name stay inside ``row``.
    An index holds ``index_bytes`` of contexts and whole groups of an anchor; groups of more than ``group_bytes`` are dealt by
    single windows.
    """
    if least < 2:
        raise ValueError("a match has two bytes at least")
    scratch = Scratch(docs.sparkSession, "repeats")
    hashes = [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")]
    texts = docs.where(F.octet_length("text") >= least).select(*hashes, "text")
    listed = scratch.put(
        texts.mapInArrow(_listed(least), "h1 long, h2 long, place int, anchor long"), "anchors"
    )
    # Written, so that the join sorts two plain shuffles and Spark can split those of a very common anchor.
    again = scratch.put(listed.groupBy("anchor").count().where("count > 1").select("anchor"), "again")
    places = listed.join(again, "anchor").groupBy("h1", "h2").agg(F.collect_set("place").alias("places"))
    uses = scratch.put(
        texts.join(places, ["h1", "h2"]).mapInArrow(
            _contexts(least), "h1 long, h2 long, lo int, hi int, c1 long, c2 long, anchor long, body binary"
        ), "uses",
    )
    bodies = uses.where("body is not null")
    sizes = scratch.put(bodies.groupBy("anchor").agg(F.sum(F.col("hi") - F.col("lo")).alias("bytes")).where(F.col("bytes") > group_bytes), "sizes")
    bodies = bodies.select("anchor", "c1", "c2", "body")
    ordered = bodies.join(sizes, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor", "c1", "c2")
    matches = ordered.mapInArrow(_matched(least, index_bytes), MATCH)
    hot = sizes.agg(F.sum("bytes")).first()[0]
    if hot:
        # A window takes 40 bytes and a bucket some 16 MB; a context repeated by another task is one.
        buckets = 1 + hot * 40 // (16 << 20)
        unlike = bodies.join(sizes, "anchor", "left_semi").dropDuplicates(["c1", "c2"]).sortWithinPartitions("c1", "c2").select("c1", "c2", "body")
        windows = unlike.mapInArrow(_windows(least, buckets, index_bytes // 4), "bucket long, records binary")
        deal = F.when(F.col("bucket") < 0, F.xxhash64("records")).otherwise(F.col("bucket"))
        dealt = windows.repartition(deal).sortWithinPartitions("bucket")
        matches = matches.unionByName(dealt.mapInArrow(_repeated(least), MATCH))
    matches = scratch.put(matches, "matches")
    copies = uses.groupBy("c1", "c2").count().where("count > 1").select("c1", "c2", F.lit(0).alias("begin"), F.lit(None).cast("int").alias("end"))
    marks = copies.unionByName(matches.withColumnsRenamed({"lo": "begin", "hi": "end"}))
    span = F.struct((F.col("lo") + F.col("begin")).alias("lo"), F.coalesce(F.col("lo") + F.col("end"), "hi").alias("hi"))
    spans = uses.join(marks, ["c1", "c2"]).groupBy("h1", "h2").agg(F.collect_set(span).alias("spans"))
    spans = scratch.put(spans, "spans")
    scratch.keep_only("spans")
    rows = docs.select(F.struct("*").alias("row"), "text", *hashes)
    return rows.join(spans, ["h1", "h2"], "left").select("row", _cutter()("text", "spans").alias("cut"))
