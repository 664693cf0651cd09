"""Unions, set operations, completeness."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from fieldbook.operators.literals import literal_table


def bind_rows(*frames: DataFrame) -> DataFrame:
    """Union by column name; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def bind_same(*frames: DataFrame) -> DataFrame:
    """Union by column name of frames that must have the same columns."""
    for other in frames[1:]:
        if set(other.columns) != set(frames[0].columns):
            raise ValueError("column names differ")
    return reduce(DataFrame.unionByName, frames)


def intersect(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.intersect(right)


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.subtract(right)


def missing_keys(found: DataFrame, column: str, expected: Iterable[int]) -> DataFrame:
    """Expected integer keys that do not occur in a column."""
    wanted = literal_table(found.sparkSession, [(int(k),) for k in expected], f"{column}:int")
    return wanted.join(found.select(column).distinct(), column, "left_anti")


def require_complete(found: DataFrame, column: str, expected: Iterable[int]) -> DataFrame:
    """The frame itself, or an error that names the missing keys."""
    gaps = sorted(row[0] for row in missing_keys(found, column, expected).collect())
    if gaps:
        raise ValueError(f"no rows for {column}: {', '.join(map(str, gaps))}")
    return found


def years(start: int, end: int, without: Iterable[int] = ()) -> list[int]:
    skipped = set(without)
    return [y for y in range(start, end + 1) if y not in skipped]


def count_groups(df: DataFrame, column: str, name: str) -> DataFrame:
    """Number of groups of a column, NULL being one of them."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("__n")).agg(F.count(F.lit(1)).alias(name))
