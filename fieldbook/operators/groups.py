"""Group values on every row.

A window over the rows would send each whole group to one task. Instead the group is
aggregated (map-side first) and the small result joined back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fieldbook.operators.joins import equi_join, read_by_all


def with_group_values(df: DataFrame, keys: Sequence[str], **values: Column) -> DataFrame:
    """Add aggregates of each row's group as columns."""
    per_group = df.groupBy(*keys).agg(*[v.alias(name) for name, v in values.items()])
    return equi_join(df, per_group, list(keys))


def with_group_sizes(df: DataFrame, keys: Sequence[str], sizes: Mapping[str, Sequence[str]], once: bool = False) -> DataFrame:
    """Add the sizes of several nested groupings as columns.

    ``keys`` is the finest grouping; ``sizes`` names a column for each subset of it. One
    count at the finest level feeds all of them. Coarser sizes are summed from it, map-side first,
    and joined back to it, so a coarse key with most of the finest groups stays spread. With ``once`` the count
    and the join back share one evaluation of the rows, which pays where they are costly to make.
    """
    df, always = read_by_all(df) if once else (df, F.lit(True))
    counts = df.groupBy(*keys).agg(F.count_if(always).alias("__n"))
    finest = counts
    for name, subset in sizes.items():
        if set(subset) == set(keys):
            finest = finest.withColumn(name, F.col("__n"))
        else:
            finest = equi_join(finest, counts.groupBy(*subset).agg(F.sum("__n").alias(name)), list(subset))
    return equi_join(df, finest.drop("__n"), list(keys))


def with_first_value(df: DataFrame, keys: Sequence[str], day: str, value: str,
                     first_day: str, first_value: str) -> DataFrame:
    """Earliest day of each group and the (smallest) value on it, on every row.

    A missing value on the first day makes the first value unknown.
    """
    if dict(df.dtypes)[value] in ("tinyint", "smallint", "int"):
        return with_group_values(df, keys, **first_of_group(day, value, first_day, first_value))
    # Other types do not fit beside the day in one number; a struct orders by day, then NULL, then value.
    order = F.when(F.col(day).isNotNull(), F.struct(day, value))
    return with_group_values(df, keys, **{first_day: F.min(day), first_value: F.min(order)[value]})


def first_of_group(day: str, value: str, first_day: str, first_value: str) -> dict[str, Column]:
    """The same as aggregates, for whole numbers of 32 bits; any other value is an error.

    Day and value share one long, so that the aggregate keeps a fixed-width buffer and stays a hash
    aggregate; ``min_by`` over a struct would sort.
    """
    packed = F.min(packed_day_value(day, value))
    low = packed.bitwiseAND(F.lit(_LOW))
    return {first_day: F.min(day), first_value: F.when(low > 0, (low - F.lit(_SHIFT)).cast("int"))}


# The low 33 bits hold 0 for a missing value, which comes first, or the value moved above 0.
_LOW, _SHIFT = 2**33 - 1, 2**31 + 1


def packed_day_value(day: str, value: str) -> Column:
    v, whole = F.col(value), F.col(value).cast("long")
    fits = (v == whole) & whole.between(-(2**31), 2**31 - 1)
    refused = F.raise_error(F.concat(F.lit(f"{value} is not a whole number of 32 bits: "), v.cast("string"))).cast("long")
    low = F.when(v.isNull(), F.lit(0).cast("long")).when(fits, whole + F.lit(_SHIFT)).otherwise(refused)
    return F.shiftleft(F.unix_date(F.col(day)).cast("long"), 33).bitwiseOR(low)
