"""Dropping lines that repeat across documents.

Every document's distinct long lines become 128-bit hashes of their keys, without their text. A hash
of two documents or more is repeated; the documents are then read once more and put together by
position from the lines that stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from fieldbook.llm.tables import Scratch
from fieldbook.llm.words import BLANKS

LEAST = 10


def line_keys(text: bytes, least: int) -> list[bytes]:
    """The hash of each line's key; empty for keys of fewer than ``least`` code points."""
    keys = []
    for line in text.lower().split(b"\n"):
        key = line.strip(BLANKS)
        # A code point has one to four bytes.
        long = len(key) >= 4 * least or len(key) >= least and sum((b & 0xC0) != 0x80 for b in key) >= least
        keys.append(xxhash.xxh3_128_digest(key) if long else b"")
    return keys


def _hashes(least: int):
    @F.arrow_udf("array<binary>")
    def hashes(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            raw = texts.cast(pa.large_binary())
            yield pa.array([sorted({*line_keys(t.as_buffer().to_pybytes(), least)} - {b""}) if t.is_valid else [] for t in raw], pa.list_(pa.binary()))

    return hashes


KEPT = "struct<n_lines:bigint, n_dropped:bigint, text:string>"


def _rebuilt(least: int):
    kind = pa.struct([("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("text", pa.string())])

    @F.arrow_udf(KEPT)
    def rebuilt(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, drops in parts:
            found = []
            for text, drop in zip(texts.cast(pa.large_binary()), drops):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                lines, gone = raw.split(b"\n"), {*(drop.as_py() or ())}
                kept = [line for line, key in zip(lines, line_keys(raw, least)) if key not in gone] if gone else lines
                found.append({"n_lines": len(lines), "n_dropped": len(lines) - len(kept), "text": b"\n".join(kept).decode()})
            yield pa.array(found, kind)

    return rebuilt


def without_repeated_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` (as the struct ``row``) with ``kept``: n_lines, n_dropped and the text of the lines that stay.

    Columns used: doc_id, text. A line's key is the line without blanks at its ends, A-Z lower-cased.
    Keys of at least ``least`` code points in two documents or more stay only in the smallest doc_id
    that holds them. A null or empty text is one empty line. Rows of one doc_id are one document,
    as are all rows without a doc_id, which comes after all others. Hashes are counted as one row
    a hash and task before the shuffle; the join that gives every row its repeated hashes has
    narrow rows, and Spark splits the partitions of a very common line. The hashes to drop are
    collected by doc_id and hash of the text, so a set has no more than one text's lines; texts of
    one doc_id that share a hash only get lines that the whole document loses.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    own = F.xxhash64("text")
    lines = scratch.put(docs.select("doc_id", own.alias("own"), F.explode(_hashes(least)("text")).alias("line")), "lines")
    holders = lines.groupBy("line").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count_if(F.col("doc_id").isNull()).alias("unnamed")
    )
    repeated = holders.where("first < last or (first is not null and unnamed > 0)").select("line", "first")
    drops = (
        lines.join(repeated, "line").where(~F.col("doc_id").eqNullSafe(F.col("first")))
        .groupBy(F.col("doc_id").alias("id"), F.col("own").alias("part")).agg(F.collect_set("line").alias("lines"))
    )
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text", own.alias("own"))
    joined = rows.join(drops, rows["doc_id"].eqNullSafe(drops["id"]) & (rows["own"] == drops["part"]), "left")
    return joined.select("row", _rebuilt(least)("text", "lines").alias("kept"))
