"""Language identification: spans of languages by Viterbi over word scores.

A word's script, from fixed ranges of code points, leaves the languages that write in it. Their scores
for the word come from how often it, its first and its last bytes were seen in texts of each language.
The best sequence of labels pays a penalty for every switch, so short loans stay inside a span.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fieldbook.llm.tables import small_batches
from fieldbook.llm.words import Splitter, Words, buffer_of, mixed, pieces

NOT_LETTER = bytes(b for b in range(128) if not chr(b).isalpha())
# First code points of scripts' ranges, each to the next one's start; "" is no script.
SCRIPTS = [
    (0x0000, ""), (0x0041, "latin"), (0x005B, ""), (0x0061, "latin"), (0x007B, ""), (0x00AA, "latin"), (0x00AB, ""),
    (0x00B5, ""), (0x00BA, "latin"), (0x00BB, ""), (0x00C0, "latin"), (0x0250, ""), (0x0370, "greek"),
    (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, ""),
    (0x0750, "arabic"), (0x0780, ""), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"),
    (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
    (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
    (0x1000, "burmese"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, ""),
    (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, ""), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, ""),
    (0x3040, "kana"), (0x3100, ""), (0x3400, "han"), (0xA000, ""), (0xAC00, "hangul"), (0xD800, ""),
    (0xF900, "han"), (0xFB00, ""), (0x20000, "han"), (0x40000, ""),
]
STARTS = np.array([s for s, _ in SCRIPTS])
NAMES = sorted({name for _, name in SCRIPTS})
SCRIPT_OF = np.array([NAMES.index(name) for _, name in SCRIPTS])

WORD_SLOTS, AFFIX_SLOTS = 1 << 15, 1 << 13
SLOTS = WORD_SLOTS + 2 * AFFIX_SLOTS + len(NAMES)
UNKNOWN = "und"
RESULT = "struct<lang:string, score:double, spans:array<struct<start:bigint, end:bigint, lang:string>>>"


def _edge(words: Words, at: np.ndarray, back: bool) -> np.ndarray:
    """The first (or last) three bytes of words as one number, A-Z lower-cased."""
    out = np.zeros(len(at), np.uint64)
    start, end = words.start[at], words.end[at]
    for k in range(3):
        place = end - 1 - k if back else start + k
        inside = (place >= start) & (place < end)
        byte = words.data[np.where(inside, place, start)].astype(np.uint64)
        byte = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
        out = out * np.uint64(256) + np.where(inside, byte, 0)
    return out


def _script(words: Words, at: np.ndarray) -> np.ndarray:
    """The script of words' first characters."""
    start, end = words.start[at], words.end[at]
    b = [words.data[np.minimum(start + k, end - 1)].astype(np.int64) for k in range(4)]
    point = np.select(
        [b[0] < 0x80, b[0] < 0xE0, b[0] < 0xF0],
        [b[0], (b[0] & 0x1F) << 6 | b[1] & 0x3F, (b[0] & 0x0F) << 12 | (b[1] & 0x3F) << 6 | b[2] & 0x3F],
        (b[0] & 0x07) << 18 | (b[1] & 0x3F) << 12 | (b[2] & 0x3F) << 6 | b[3] & 0x3F,
    )
    return SCRIPT_OF[np.searchsorted(STARTS, point, "right") - 1]


def slots_of(words: Words, at: np.ndarray) -> np.ndarray:
    """Table places of words: the word, its first bytes, its last bytes, its script."""
    affix = lambda back: mixed(_edge(words, at, back)) % np.uint64(AFFIX_SLOTS)
    return np.stack([
        words.key[at] % np.uint64(WORD_SLOTS), affix(False) + np.uint64(WORD_SLOTS),
        affix(True) + np.uint64(WORD_SLOTS + AFFIX_SLOTS), (_script(words, at) + WORD_SLOTS + 2 * AFFIX_SLOTS).astype(np.uint64),
    ], axis=1).astype(np.int64)


def _counts(texts: pa.Array) -> np.ndarray:
    found = np.zeros(SLOTS, np.int64)
    for a, n in pieces(texts):
        words = Splitter(NOT_LETTER)(texts.slice(a, n))
        _, at, times = np.unique(words.key, return_index=True, return_counts=True)
        for column in slots_of(words, at).T:
            found += np.bincount(column, times, SLOTS).astype(np.int64)
    return found


@dataclass(frozen=True)
class Model:
    """Log-probabilities of table places per language, and the languages that each script may be."""

    languages: list[str]
    table: np.ndarray
    writes: np.ndarray
    switch: float = 5.0
    most: float = 6.0

    def scores(self, words: Words, at: np.ndarray) -> np.ndarray:
        """Per word and language, 0 for the likeliest and below it for others; all 0 without evidence."""
        slots = slots_of(words, at)
        raw = self.table[slots[:, 0]] + 0.5 * (self.table[slots[:, 1]] + self.table[slots[:, 2]])
        raw = np.maximum(raw - raw.max(axis=1, keepdims=True), -self.most)
        may = self.writes[slots[:, 3] - WORD_SLOTS - 2 * AFFIX_SLOTS]
        return np.where(may.any(axis=1, keepdims=True), np.where(may, raw, -3 * self.most), 0.0).astype(np.float32)


def fit(rows: DataFrame, per_language: int = 4000) -> Model | None:
    """A model from ``text`` and ``lang``; rows without either are left out. None if no row is left.

    Bounded sample: a text counts once a language, however many copies it has, and languages of more than
    ``per_language`` texts are thinned to about so many by a number hashed from the text. So copies neither fill the sample nor
    leave a language without one, and only hashes are shuffled to count. What reaches the driver is
    a table of fixed height with one column a language.
    """
    named = rows.where("text is not null and lang is not null and lang <> ''").select("text", "lang", F.xxhash64("text").alias("hash"))
    sizes = {r["lang"]: r["count"] for r in named.select("lang", "hash").distinct().groupBy("lang").count().collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    share = F.create_map(*[F.lit(x) for name in languages for x in (name, min(1.0, per_language / sizes[name]))])
    number = F.shiftrightunsigned(F.xxhash64("text", F.lit("fit")), 11) / float(1 << 53)
    sample = named.where(number < share[F.col("lang")]).dropDuplicates(["lang", "hash"]).select("text", "lang")

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            lang = np.array(batch.column("lang").to_pylist(), object)
            for name in set(lang):
                counts = _counts(batch.column("text").filter(pa.array(lang == name)))
                totals[name] = totals.get(name, 0) + counts
        for name, counts in totals.items():
            slot = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(slot)), "slot": pa.array(slot), "n": pa.array(counts[slot])})

    found = sample.mapInArrow(partial, "lang string, slot bigint, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((SLOTS, len(languages)))
    counts[found["slot"].to_numpy(), [languages.index(x) for x in found["lang"].to_pylist()]] = found["n"].to_numpy()
    parts = np.split(counts, [WORD_SLOTS, WORD_SLOTS + AFFIX_SLOTS, WORD_SLOTS + 2 * AFFIX_SLOTS])
    table = np.concatenate([np.log((p + 0.5) / (p + 0.5).sum(axis=0)) for p in parts[:3]]).astype(np.float32)
    # A language writes in a script that has a hundredth of its words.
    return Model(languages, table, parts[3] >= 0.01 * np.maximum(1, parts[3].sum(axis=0)))


def viterbi(scores: np.ndarray, which: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """The best labels of all texts' words at once: one step takes the next word of every text.

    ``scores[which[i]]`` are word i's scores, and text d has the words first[d] up to first[d + 1].
    """
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    labels = np.zeros(len(which), np.int16)
    if not len(order):
        return labels
    begin, lengths = first[:-1][order], counts[order]
    alive = len(order) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), "right")
    stays, bests = [], []
    best = np.zeros((len(order), scores.shape[1]), np.float32)
    for t, n in enumerate(alive):
        if t:
            peak = best[:n].argmax(axis=1)
            other = best[np.arange(n), peak][:, None] - switch
            stay = best[:n] >= other
            stays.append(np.packbits(stay, axis=1))
            bests.append(peak.astype(np.int16))
            best[:n] = np.maximum(best[:n], other)
        best[:n] += scores[which[begin[:n] + t]]
    final = best.argmax(axis=1)
    state = np.zeros(len(order), np.int64)
    below = 0
    for t in range(len(alive) - 1, -1, -1):
        n = alive[t]
        state[below:n] = final[below:n]
        labels[begin[:n] + t] = state[:n]
        below = n
        if t:
            bits = stays[t - 1][np.arange(n), state[:n] >> 3] >> (7 - (state[:n] & 7)) & 1
            state[:n] = np.where(bits, state[:n], bests[t - 1])
    return labels


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode())


def label(texts: pa.Array, model: Model | None) -> list[dict]:
    """Language, score and spans (characters) of each text."""
    none = {"lang": UNKNOWN, "score": 0.0, "spans": []}
    if model is None:
        return [none] * len(texts)
    words = Splitter(NOT_LETTER)(texts)
    data, bounds = buffer_of(texts)
    _, at, which = np.unique(words.key, return_index=True, return_inverse=True)
    scores = model.scores(words, at)
    labels = viterbi(scores, which, words.first, model.switch)
    telling = (scores < 0).any(axis=1)[which]
    ascii_word = data[words.start] < 0x80
    out = []
    for d in range(len(texts)):
        a, z = words.first[d], words.first[d + 1]
        raw = data[bounds[d]:bounds[d + 1]].tobytes()
        if a == z or not ascii_word[a:z].any() and not _has_letter(raw):
            out.append(none)
            continue
        per = np.bincount(labels[a:z], minlength=len(model.languages))
        lang = int(per.argmax())
        cuts = np.concatenate([[a], np.flatnonzero(np.diff(labels[a:z])) + a + 1, [z]])
        places = np.concatenate([words.start[cuts[:-1]], [words.end[z - 1]]]) - bounds[d]
        if not raw.isascii():
            lead = (data[bounds[d]:bounds[d + 1]] & 0xC0) != 0x80
            places = np.concatenate([[0], np.cumsum(lead)])[places]
        spans = [
            {"start": int(s), "end": int(e), "lang": model.languages[labels[c]]}
            for s, e, c in zip(places[:-1], places[1:], cuts[:-1])
        ]
        agree = float(((labels[a:z] == lang) & telling[a:z]).sum())
        out.append({"lang": model.languages[lang], "score": agree / int(z - a), "spans": spans})
    return out


def identifier(model: Model | None, shared=None):
    """An Arrow function from texts to their language, score and spans."""
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("spans", spans)])

    def one(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = model if shared is None else shared.value
        for texts in parts:
            yield pa.array([x for a, n in pieces(texts) for x in label(texts.slice(a, n), known)], kind)

    return F.arrow_udf(one, RESULT)


def held_out(doc_id: Column) -> Column:
    """Whether the doc_id is kept from learning: its CRC-32 as text is a multiple of 5. False for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identified(docs: DataFrame, per_language: int = 4000) -> DataFrame:
    """``docs`` (as the struct ``row``) with ``found``: lang, score and spans.

    Learns from text and lang of rows that are not held out; predicts from texts alone. A null text or
    one without letters is ``und`` with the score 0 and no spans, as are all texts if nothing can be
    learned. The language is that of most words, of equals the first by name; the score is the share
    of all words that are labelled with it and tell languages apart. Repeated rows get equal results.
    """
    small_batches(docs.sparkSession)
    model = fit(docs.where(~held_out(F.col("doc_id"))), per_language)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.struct("*").alias("row")).withColumn("found", identifier(None, shared)("row.text"))


def recognised(docs: DataFrame, least: float = 0.05) -> DataFrame:
    """Documents in a language that the model knows, with the columns of ``docs``.

    Rejected are texts without letters and those of which less than a twentieth of the words is
    evidence for any one language.
    """
    return identified(docs).where((F.col("found.lang") != UNKNOWN) & (F.col("found.score") >= least)).select("row.*")
