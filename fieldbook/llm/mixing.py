"""Mixing sources to target weights (DataFrame functions only).

Words are summed per source; every source gets a target; target over size is its repetition rate. A
document appears floor(rate) times, and once more if a number hashed from its doc_id falls below the
rate's fraction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fieldbook.llm.tables import Scratch, numbered

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    scratch: Scratch, sized: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """One row a source: ``source``, ``source_size``, ``target``.

    ``sized`` has ``source`` and ``size``. Sources in code point order, null last, weigh ``weights``,
    repeating. They share ``share`` times all words; a target stops at ``most`` times its source's
    words and what is left is shared by weight among the others, until none is above. A source
    without words has the target 0, as have all of an empty table.

    Every pass adds up one row a source. ``level``, the words a unit of weight gets, only grows, so
    a source at its limit stays there and the passes end.
    """
    totals = sized.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("source_size"))
    ranked = numbered(scratch, totals, [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = scratch.put(ranked.withColumns({"weight": weight, "limit": F.col("source_size") * most}), "sources")
    whole = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level, at_limit = 0.0, -1
    while True:
        full = F.col("limit") <= F.col("weight") * F.lit(level)
        used, count, left = sources.agg(
            F.coalesce(F.sum(F.when(full, F.col("limit"))), F.lit(0.0)),
            F.count_if(full),
            F.sum(F.when(~full, F.col("weight"))),
        ).first()
        if count == at_limit or not left:
            break
        level, at_limit = (whole - used) / left, count
    return sources.select("source", "source_size", F.least("limit", F.col("weight") * F.lit(level)).alias("target"))


def coin(doc_id: Column, text: Column | None = None, seed: str = "mix") -> Column:
    """A number in [0, 1) that the doc_id and the seed decide (for a null doc_id, the text does)."""
    name = F.coalesce(doc_id.cast("string"), *([F.md5(text)] if text is not None else []), F.lit(""))
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), name)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 52)


def mixed(rows: DataFrame, goals: DataFrame, seed: str = "mix") -> DataFrame:
    """``rows`` (``source`` and ``coin`` among the columns) with ``source_size``, ``target``, ``copies``.

    The one row a source joins null-safely; Spark broadcasts the written table if it is small and
    else splits hot sources' partitions.
    """
    goals = goals.withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    extra = (F.col("coin") < rate - F.floor(rate)).cast("long")
    joined = rows.join(goals, rows["source"].eqNullSafe(goals["_source"]), "left").drop("_source")
    return joined.withColumn("copies", F.floor(rate) + extra)


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``.

    Columns used: doc_id, text, source. Documents without words are as likely taken as others.
    Repeated rows of a doc_id share its number and so its copies. An empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    sized = docs.select("source", word_count(F.col("text")).alias("size"))
    goals = scratch.put(targets(scratch, sized, weights, share, most), "targets")
    scratch.keep_only("targets")
    rows = docs.select(F.struct("*").alias("row"), "source", coin(F.col("doc_id"), F.col("text")).alias("coin"))
    taken = mixed(rows, goals).where("copies > 0")
    return taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")


def mix_plan(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """What the mix takes of every document: doc_id, size, source_size, target, copies, taken (words)."""
    scratch = Scratch(docs.sparkSession, "mix")
    sized = scratch.put(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), coin(F.col("doc_id"), F.col("text")).alias("coin")),
        "sized",
    )
    goals = scratch.put(targets(scratch, sized, weights, share, most), "targets")
    scratch.keep_only("sized", "targets")
    return mixed(sized, goals).select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )
