"""Benchmark decontamination by one Aho-Corasick automaton.

Benchmark texts become windows of 13 words. The automaton reads word numbers: a word that no window
has is number 0, and only runs of numbered words can hold a window. Every text is split into words
once; words keep their bounds in the original text, so hits come back as spans of it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fieldbook.llm.tables import small_batches
from fieldbook.llm.words import NOT_ALNUM, Splitter, buffer_of, pieces

WINDOW = 13
# Bytes of benchmark text that one automaton holds, in some 270 MB of a Python worker; a larger benchmark is scanned in blocks.
BLOCK_BYTES = 4 << 20
REPORT = "struct<n_words:bigint, n_hit:bigint, items:array<bigint>, spans:array<struct<start:bigint, end:bigint>>>"


class Windows:
    """A block of benchmark texts as word numbers, and the automaton of their windows.

    Only the numbers travel. A broadcast gives all batches and tasks of a Python worker the same object, so a
    worker builds the automaton once, when it first needs it.
    """

    def __init__(self, items: list[tuple[int | None, str]], width: int):
        words = Splitter(NOT_ALNUM)(pa.array([text for _, text in items], pa.large_string()))
        self.vocabulary, numbers = np.unique(words.key, return_inverse=True)
        self.numbers, self.first = (numbers + 1).astype(np.int32), words.first
        self.items, self.width = [item for item, _ in items], width
        sizes = np.diff(words.first)
        self.shortest = min(width, int(sizes[sizes > 0].min())) if np.any(sizes > 0) else 0
        self._built = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_built": None}

    def automaton(self) -> ahocorasick.Automaton:
        if self._built is None:
            self._built = self._build()
        return self._built

    def _build(self) -> ahocorasick.Automaton:
        built = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        numbers = self.numbers.tolist()
        for item, first, last in zip(self.items, self.first[:-1].tolist(), self.first[1:].tolist()):
            size = min(self.width, last - first)
            # An item's windows share its holder; one that several items have gets a set of its own.
            alone = (size, frozenset([item]))
            for at in range(first, last - size + 1 if size else first):
                window = tuple(numbers[at:at + size])
                held = built.get(window, None)
                if held is None:
                    built.add_word(window, alone)
                elif isinstance(held[1], set):
                    held[1].add(item)
                elif item not in held[1]:
                    built.add_word(window, (size, {*held[1], item}))
        built.make_automaton()
        return built

    def number(self, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocabulary, keys), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == keys, at + 1, 0)


def _runs(known: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of at least ``least`` known words, none across two texts."""
    begins, ends = known.copy(), known.copy()
    begins[1:] &= ~known[:-1]
    ends[:-1] &= ~known[1:]
    edges = np.unique(first[(first > 0) & (first < len(known))])
    begins[edges] = known[edges]
    ends[edges - 1] = known[edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    long = end - start >= least
    return start[long], end[long]


def scan(parts: Iterable[tuple[pa.Array, list | None]], windows: Windows) -> Iterator[list[dict]]:
    """Reports for batches of texts; the hits of an earlier block's report are kept."""
    split = Splitter(NOT_ALNUM)
    for texts, earlier in parts:
        words = split(texts)
        counts = words.counts()
        delta = np.zeros(len(words.key) + 1, np.int32)
        items: dict[int, set] = {}
        if windows.shortest and len(words.key):
            numbers = windows.number(words.key)
            for start, end in zip(*_runs(numbers > 0, words.first, windows.shortest)):
                for last, (size, held) in windows.automaton().iter(tuple(numbers[start:end].tolist())):
                    delta[start + last + 1 - size] += 1
                    delta[start + last + 1] -= 1
                    items.setdefault(int(np.searchsorted(words.first, start, "right")) - 1, set()).update(held)
        data, bounds = words.data, buffer_of(texts)[1]
        hit = np.cumsum(delta[:-1]) > 0
        reports = []
        for d in range(len(counts)):
            a, z = words.first[d], words.first[d + 1]
            report = {"n_words": int(counts[d]), "n_hit": 0, "items": [], "spans": []}
            old = earlier[d] if earlier else None
            if d in items or old and old["n_hit"]:
                mask = hit[a:z].copy()
                text = data[bounds[d]:bounds[d + 1]].tobytes().decode()
                if old:
                    # An earlier block's spans, in characters, back as words.
                    starts = _characters(text, words.start[a:z] - bounds[d])
                    for span in old["spans"]:
                        mask[np.searchsorted(starts, span["start"]):np.searchsorted(starts, span["end"])] = True
                on = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
                begin = _characters(text, words.start[a + on[::2]] - bounds[d])
                cease = _characters(text, words.end[a + on[1::2] - 1] - bounds[d])
                report["n_hit"] = int(mask.sum())
                report["items"] = sorted({*(x for x in items.get(d, ()) if x is not None), *(old["items"] if old else ())})
                report["spans"] = [{"start": int(s), "end": int(e)} for s, e in zip(begin, cease)]
            reports.append(report)
        yield reports


def _characters(text: str, offsets: np.ndarray) -> np.ndarray:
    """Byte offsets as character offsets."""
    lead = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(lead)])[offsets]


def scanner(windows, chained: bool):
    """An Arrow function from texts (and an earlier block's reports) to reports."""

    def reports(parts: Iterator) -> Iterator[pa.Array]:
        kind = pa.struct([
            ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.int64())),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ])
        for part in parts:
            texts, earlier = part if chained else (part, None)
            cuts = [(texts.slice(a, n), earlier.slice(a, n).to_pylist() if chained else None) for a, n in pieces(texts)]
            yield pa.array([report for found in scan(cuts, windows.value) for report in found], kind)

    if chained:
        def two(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            yield from reports(parts)

        return F.arrow_udf(two, REPORT)

    def one(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from reports(parts)

    return F.arrow_udf(one, REPORT)


def scanned(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (as the struct ``row``) with ``report``: n_words, n_hit, items and hit spans (characters).

    The benchmark's bytes are counted first. Up to ``block_bytes`` of it make one automaton, sent to the
    tasks as word numbers; a larger benchmark is dealt out by item into blocks, one automaton after the
    other over the same words. A null text has no words; benchmark texts without words have no
    window; a null item_id marks words hit but is not among the items; repeated items count once. A very long
    text is a batch of its own and scanned whole. Without documents there are no rows, without benchmark no hits.
    """
    spark = docs.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    out = docs.select(F.struct("*").alias("row"))
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        windows = spark.sparkContext.broadcast(Windows([(r.item_id, r.text) for r in part], width))
        find = scanner(windows, block > 0)
        out = out.withColumn("report", find("row.text", "report") if block else find("row.text"))
    return out


def contaminated(n_hit, n_words):
    """At least a twentieth of the words, and at least one, is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with the columns of ``docs``."""
    found = scanned(docs, benchmark)
    return found.where(~contaminated(F.col("report.n_hit"), F.col("report.n_words"))).select("row.*")
