"""Sharding by sampled splitters (DataFrame functions only).

Rows are drawn with a chance in proportion to their bytes; quantiles of the drawn keys cut the key
order into many more ranges than shards. Ranges that turn out overfull are cut again by a sample of
their own rows. Exact bytes per range then place the ranges, in order, into shards of near equal bytes.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldbook.llm.tables import Scratch

KEY = "struct<a:bigint,b:bigint,c:bigint>"
LEAST = -(1 << 63)


def range_of(key: Column, bounds: list[tuple[int, int, int]]) -> Column:
    """Number of bounds at or below the key, by binary search in a literal array."""
    if not bounds:
        return F.lit(0)
    literal = F.from_json(F.lit(json.dumps([dict(zip("abc", b)) for b in bounds])), f"array<{KEY}>")
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: at + F.when(F.get(literal, at + step - 1) <= key, step).otherwise(0)
    )


def quantiles(rows: DataFrame, group: Column, bytes_of: Column, pieces: Column, points: int) -> DataFrame:
    """Keys that cut each group's rows into about ``pieces`` pieces of equal bytes.

    ``points`` rows are drawn for a piece on average, each with a chance of its size; a row of more
    than a point's bytes counts as several. So the sample has a bounded size whatever the table's.
    """
    expected = F.col("size") * pieces * points / bytes_of
    chance = F.shiftrightunsigned(F.xxhash64("key", F.lit("splitters")), 11) / float(1 << 53)
    weight = F.floor(expected) + (chance < expected - F.floor(expected)).cast("long")
    drawn = rows.select(group.alias("group"), "key", pieces.alias("pieces"), weight.alias("weight")).where("weight > 0")
    order = Window.partitionBy("group").orderBy("key")
    upto = F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("weight").over(Window.partitionBy("group"))
    piece = F.floor(F.col("before") * F.col("pieces") / F.col("total"))
    cut = drawn.select("group", "key", "pieces", (upto - F.col("weight")).alias("before"), total.alias("total")).withColumn("piece", piece)
    return cut.withColumn("last", F.lag("piece").over(order)).where("piece > last").select("key")


def shard(
    docs: DataFrame, key: Column, tie: Column, size: Column, shards: int = 8, ranges: int = 512, points: int = 32, range_bytes: int = 128 << 20
) -> DataFrame:
    """``docs`` as the struct ``row``, with ``size``, ``shard`` and ``slot`` (gapless from 0 in the shard).

    ``key`` and ``tie`` are longs. Rows go to shards in the order of key, tie and place in the table, so
    rows of equal key lie side by side: a bound inside a key moves to the key's first row unless the
    key fills more than a whole range. A shard's bytes differ from an equal share by about one range
    (a 64th of a shard or less), or by a row if that is larger. There are ``ranges`` ranges, and more where each
    would pass ``range_bytes``; what is ordered in a range are keys, the rows join their numbers afterwards. Null keys count as one
    key. An empty table gives an empty one; identical rows take neighbouring slots; very long texts only weigh more.
    """
    scratch = Scratch(docs.sparkSession, "shard")
    place = F.struct(
        F.coalesce(key, F.lit(LEAST)).alias("a"), F.coalesce(tie, F.lit(LEAST)).alias("b"), F.monotonically_increasing_id().alias("c")
    )
    rows = scratch.put(docs.select(F.struct("*").alias("row"), place.alias("key"), size.cast("long").alias("size")), "rows")
    narrow = rows.select("key", "size")
    whole = narrow.agg(F.sum("size")).first()[0] or 1
    ranges = max(ranges, -(-whole // range_bytes))
    fair = whole / ranges
    found = {tuple(r.key) for r in quantiles(narrow, F.lit(0), F.lit(whole), F.lit(ranges), points).collect()}
    bounds: list[tuple[int, int, int]] = []
    while True:
        # A bound inside a key moves to the key's first row, unless two bounds lie in it.
        drawn = sorted(found)
        spans = {a for (a, _, _), (b, _, _) in zip(drawn, drawn[1:]) if a == b}
        grown = sorted({*bounds, *(k if k[0] in spans else (k[0], LEAST, LEAST) for k in drawn)})
        if bounds and len(grown) == len(bounds):
            break
        # The counts are always those of the last bounds.
        bounds = grown
        counted = narrow.groupBy(range_of(F.col("key"), bounds).alias("range")).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        counted = scratch.put(counted, "ranges")
        overfull = counted.where((F.col("bytes") > 2 * fair) & (F.col("rows") > 1)).withColumn("pieces", F.ceil(F.col("bytes") / fair))
        crowded = {r.range: r for r in overfull.collect()}
        if not crowded:
            break
        # At most as many overfull ranges as ranges in all, so the map of them is small.
        inside = range_of(F.col("key"), bounds)
        of = lambda name: F.create_map(*[F.lit(x) for r in crowded.values() for x in (r.range, r[name])])[inside]
        more = quantiles(narrow.where(inside.isin(list(crowded))), inside, of("bytes"), of("pieces"), points)
        found |= {tuple(r.key) for r in more.collect()}
        if not found:
            break
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.coalesce(F.sum("bytes").over(before), F.lit(0)) + F.col("bytes") / 2
    placed = counted.withColumn("shard", F.least(F.floor(middle * shards / whole), F.lit(shards - 1)).cast("int"))
    earlier = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    placed = scratch.put(
        placed.select("range", "shard", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start")).coalesce(1), "placed"
    )
    within = F.row_number().over(Window.partitionBy("range").orderBy("key")) - 1
    ranged = narrow.select("key", range_of(F.col("key"), bounds).alias("range")).withColumn("within", within)
    numbers = ranged.join(placed, "range").select(F.col("key.c").alias("id"), "shard", (F.col("start") + F.col("within")).alias("slot"))
    scratch.keep_only("rows", "placed")
    return rows.join(numbers, F.col("key.c") == F.col("id")).select("row", "size", "shard", "slot")


def by_text(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Documents in shards of near equal bytes; equal texts share a shard unless they overfill a range."""
    return shard(docs, F.xxhash64("text"), F.xxhash64("doc_id"), text_bytes(F.col("text")), shards)


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes plus 1; 1 for null."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


__all__ = ["by_text", "quantiles", "range_of", "shard", "text_bytes"]
