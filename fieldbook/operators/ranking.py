"""Top-k with and without ties, first rows, extremes.

Ties can be any share of a table, so rows are never ranked in one task: the cut value is
found first (from at most n rows per task and group) and the rows are then filtered by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldbook.operators.joins import equi_join, read_by_all


def _order(by: str, ascending: bool) -> Column:
    return F.asc_nulls_last(by) if ascending else F.desc_nulls_last(by)


def _cut(by: str, ascending: bool) -> Column:
    return F.max(by) if ascending else F.min(by)


def _reaches(by: str, cut: Column, ascending: bool) -> Column:
    """Without a cut (too few values) every row stays, missing values included."""
    inside = F.col(by) <= cut if ascending else F.col(by) >= cut
    return F.coalesce(inside, cut.isNull())


def top_n(df: DataFrame, by: str, n: int = 1, ascending: bool = False) -> DataFrame:
    """Rows with the n largest values, ties kept."""
    cut = (
        df.select(by).where(F.col(by).isNotNull())
        .orderBy(_order(by, ascending)).limit(n)
        .agg(F.when(F.count(by) == n, _cut(by, ascending)).alias("cut"))
    )
    return df.where(_reaches(by, cut.scalar(), ascending))


def top_n_ranked(df: DataFrame, by: str, n: int = 1) -> DataFrame:
    """As ``top_n``, from a single evaluation of ``df``; for aggregates, of which few rows tie.

    A sum of doubles may differ in its last bits when evaluated again, so a cut found in a second
    evaluation could miss the very row it came from. Here each task keeps its own rows of rank n or
    better, and only these meet.
    """
    order = Window.orderBy(F.desc_nulls_last(by))
    # Missing values rank after all others, so they stay only where fewer than n others are.
    return df.withColumn("__rank", F.rank().over(order)).where(F.col("__rank") <= n).drop("__rank")


def bottom_n(df: DataFrame, by: str, n: int = 1) -> DataFrame:
    """Rows with the n smallest values, ties kept."""
    return top_n(df, by, n, ascending=True)


def top_n_per_group(df: DataFrame, keys: Sequence[str], by: str, n: int = 1,
                    ascending: bool = False) -> DataFrame:
    """Rows with the n largest values of each group, ties kept."""
    values = df.select(*keys, by)
    if n == 1:
        cuts = values.groupBy(*keys).agg((F.min(by) if ascending else F.max(by)).alias("__cut"))
    else:
        window = Window.partitionBy(*keys).orderBy(_order(by, ascending))
        cuts = (
            values.withColumn("__pos", F.row_number().over(window)).where(F.col("__pos") <= n)
            .groupBy(*keys)
            .agg(F.when(F.count(by) == n, _cut(by, ascending)).alias("__cut"))
        )
    return (
        equi_join(df, cuts, list(keys))
        .where(_reaches(by, F.col("__cut"), ascending))
        .drop("__cut")
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row of every key in a stated order, all columns.

    The ``= 1`` filter makes Spark keep one row per key and task before the shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__pos", F.row_number().over(window)).where("__pos = 1").drop("__pos")


def top_one_per_group(df: DataFrame, keys: Sequence[str], by: str, tie_break: Sequence[str]) -> DataFrame:
    """Largest row of each group, ties broken by the given columns."""
    return first_per_key(df, keys, [F.desc_nulls_last(by), *[F.asc_nulls_last(c) for c in tie_break]])


RANGES = 256


def with_position(df: DataFrame, keys: Sequence[str], by: str, item: str, name: str, ascending: bool = False, ranges: int = RANGES) -> DataFrame:
    """Running position in each group by value, equal values by item; missing values and items come last.

    For lists cut to their top values, of which any number of rows may tie: ties are never ordered in
    one task. Items are cut into ranges at bounds drawn from the items themselves, by their hash, so that
    every reader of the plan sees the same ones. A row's position is the number of rows at better
    values and in earlier ranges, from one count a value and range, and its place in its own range. Bounds that
    miss a crowded stretch cost time, never correctness.
    """
    x, size = F.col(item), 1 << 20
    # Four readers of the list: its size, the bounds, the counts and the rows.
    df, always = read_by_all(df)
    share = df.agg((F.lit(float(size * ranges)) / F.greatest(F.count_if(always), F.lit(1))).alias("share")).scalar()
    drawn = F.when(always & (F.pmod(F.xxhash64(item), F.lit(size)) < share), x)
    bounds = df.agg(F.sort_array(F.collect_set(drawn)).alias("bounds")).scalar()
    place = F.when(x.isNull(), F.size("__bounds")).otherwise(F.size(F.filter("__bounds", lambda b: b <= x)))
    rows = df.withColumn("__bounds", bounds).withColumn("__range", place).drop("__bounds")

    groups = [*keys, by, "__range"]
    upto = F.sum("__size").over(Window.partitionBy(*keys).orderBy(_order(by, ascending), "__range").rowsBetween(Window.unboundedPreceding, 0))
    starts = rows.groupBy(*groups).agg(F.count_if(always).alias("__size")).withColumn("__start", upto - F.col("__size")).drop("__size")
    within = F.row_number().over(Window.partitionBy(*groups).orderBy(F.asc_nulls_last(item)))
    return equi_join(rows, starts, groups).withColumn(name, (F.col("__start") + within).cast("int")).drop("__start", "__range")


def at_extremes(df: DataFrame, by: str) -> DataFrame:
    """Rows at the global minimum or maximum of a column."""
    ends = df.agg(F.struct(F.min(by).alias("low"), F.max(by).alias("high")).alias("ends")).scalar()
    return df.where((F.col(by) == ends["low"]) | (F.col(by) == ends["high"]))


def latest(df: DataFrame, by: str, tie_break: Sequence[str], n: int = 1) -> DataFrame:
    """The n newest rows (a top-k report, no ties)."""
    return df.orderBy(F.desc_nulls_last(by), *[F.asc_nulls_last(c) for c in tie_break]).limit(n)
