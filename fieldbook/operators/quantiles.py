"""Exact quantiles without gathering a group in one task, and quantile bins.

Spark's exact ``percentile`` holds all distinct values of a group in one buffer. Here the rows are read
once, into a histogram of (value, copies) that every later pass reads from the same shuffle. The
wanted ranks are then found digit by digit: the first digit of a value is its binary exponent with
the sign, the second its place among slices between the smallest and largest value of that digit. Both
grow with the value, so counts per digit tell which digit holds a rank, and only the values of such a digit are
looked at again. In the end the few values that share both digits with a rank are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldbook.functions.nulls import as_col
from fieldbook.operators.joins import equi_join

SLICES = 1 << 14


def histogram(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Every value of each group once, as double, with its number of rows; missing values are left out.

    Copies of a value collapse in the tasks that read them, so a very common value is one row a task.
    """
    rows = df.select(*by, F.col(value).cast("double").alias("__x")).where(F.col("__x").isNotNull())
    return rows.groupBy(*by, "__x").agg(F.count(F.lit(1)).alias("__copies"))


def exponent(x: Column) -> Column:
    """A whole number that never falls as x grows: the binary exponent, negative for values below 0."""
    size = F.abs(x)
    finite = F.floor(F.log2(size)) + 2000
    by_size = F.when(F.isnan(x), 5000).when(size == float("inf"), 4000).when(size == 0, 0).otherwise(finite)
    return F.when(x < 0, -by_size).otherwise(by_size).cast("int")


def slice_of(x: Column, low: Column, high: Column) -> Column:
    """The place of x among equal slices between low and high; it never falls as x grows."""
    place = F.floor((x - low) / (high - low) * SLICES)
    return F.when((low < high) & ~F.isnan(high) & (F.abs(high - low) < float("inf")), F.least(place, F.lit(SLICES - 1))).otherwise(0).cast("int")


def _holding(counted: DataFrame, groups: Sequence[str], digit: str, probs: Sequence[float]) -> DataFrame:
    """Of (groups, digit) with __size, __start and __n: the digits that hold a wanted rank, and the rank of their first value.

    __start is the first rank of the group as a whole.
    """
    upto = F.sum("__size").over(Window.partitionBy(*groups).orderBy(digit).rowsBetween(Window.unboundedPreceding, 0))
    placed = counted.withColumn("__start", F.col("__start") + upto - F.col("__size"))
    low = [F.floor((F.col("__n") - 1) * float(p)) for p in probs]
    held = [(F.col("__start") <= rank + 1) & (rank < F.col("__start") + F.col("__size")) for rank in low]
    any_held = held[0]
    for one in held[1:]:
        any_held |= one
    return placed.where(any_held)


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                    name: str = "quantiles") -> DataFrame:
    """One row per group: array of quantiles, linearly interpolated between order values.

    Groups without any value have no row; without grouping there is then no row at all. NaN is the largest value.
    """
    by = list(by)
    x = F.col("__x")
    values = histogram(df, value, by).withColumn("__d1", exponent(x))
    ends = F.min(x).alias("__low"), F.max(x).alias("__high")

    # First digit: a few thousand counts a group at most.
    first = values.groupBy(*by, "__d1").agg(F.sum("__copies").alias("__size"), *ends)
    total = F.sum("__size").over(Window.partitionBy(*by))
    first = _holding(first.withColumns({"__n": total, "__start": F.lit(0)}), by, "__d1", probs)

    # Second digit, of the values with such a first one.
    inside = equi_join(values, first.drop("__size"), [*by, "__d1"])
    inside = inside.withColumn("__d2", slice_of(x, F.col("__low"), F.col("__high"))).drop("__low", "__high")
    second = inside.groupBy(*by, "__d1", "__d2").agg(
        F.sum("__copies").alias("__size"), F.max("__start").alias("__start"), F.max("__n").alias("__n")
    )
    second = _holding(second, [*by, "__d1"], "__d2", probs).select(*by, "__d1", "__d2", F.col("__start").alias("__from"))

    # The values that are left are ordered, each pair of digits on its own.
    running = F.sum("__copies").over(Window.partitionBy(*by, "__d1", "__d2").orderBy("__x"))
    placed = equi_join(inside, second, [*by, "__d1", "__d2"]).withColumn("__upto", F.col("__from") + running)
    found = []
    for i, p in enumerate(probs):
        rank = F.floor((F.col("__n") - 1) * float(p))
        for step in (0, 1):
            here = (F.col("__upto") > rank + step) & (F.col("__upto") - F.col("__copies") <= rank + step)
            found.append(F.max(F.when(here, x)).alias(f"__v{i}_{step}"))
    points = placed.groupBy(*by).agg(F.max("__n").alias("__n"), *found)

    def point(i: int, p: float) -> Column:
        place = (F.col("__n") - 1) * float(p)
        low, high = F.col(f"__v{i}_0"), F.col(f"__v{i}_1")
        # Equal neighbours need no step between them, which infinities could not give.
        step = F.when(low == high, 0.0).otherwise((high - low) * (place - F.floor(place)))
        return F.when(place == F.floor(place), low).otherwise(low + F.coalesce(step, F.lit(0.0)))

    done = points.select(*by, F.array(*[point(i, p) for i, p in enumerate(probs)]).alias(name), "__n")
    return done.where(F.col("__n") > 0).drop("__n")


def exact_median(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "median") -> DataFrame:
    quantile = exact_quantiles(df, value, [0.5], by, "__q")
    return quantile.select(*by, F.col("__q")[0].alias(name))


def quantile_breaks(df: DataFrame, value: str, bins: int) -> Column:
    """Bin edges as one array value; duplicate edges are an error, as bins would be empty."""
    edges = exact_quantiles(df, value, [i / bins for i in range(bins + 1)], name="edges")
    checked = F.when(
        F.size(F.array_distinct("edges")) == bins + 1, F.col("edges")
    ).otherwise(F.raise_error(F.lit("duplicate breaks")))
    return edges.select(checked.alias("edges")).scalar()


def right_closed_bin(value: str | Column, breaks: str | Column) -> Column:
    """1-based bin whose right edge is included; the lowest value belongs to bin 1."""
    v = as_col(value).cast("double")
    return F.greatest(F.lit(1), F.size(F.filter(as_col(breaks), lambda edge: edge < v)))


def with_quantile_bin(df: DataFrame, value: str, bins: int, label: str, name: str) -> DataFrame:
    """Add the equal-frequency bin as an ordering integer and a label."""
    number = f"{name}_number"
    return (
        df.withColumn("__breaks", quantile_breaks(df, value, bins))
        .withColumn(number, right_closed_bin(value, "__breaks")).drop("__breaks")
        .withColumn(name, F.concat(F.lit(label + " "), F.col(number).cast("string")))
    )
