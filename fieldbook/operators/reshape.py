"""Column and row reshaping."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fieldbook.functions.numbers import text_to_int
from fieldbook.functions.text import tidy_name, title_case_name

# Month column headers of a calendar matrix.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def rename_all(df: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    return df.toDF(*[fn(c) for c in df.columns])


def lower_names(df: DataFrame) -> DataFrame:
    return rename_all(df, str.lower)


def tidy_names(df: DataFrame) -> DataFrame:
    return rename_all(df, tidy_name)


def format_titles(df: DataFrame) -> DataFrame:
    """Headers for a report: blanks for underscores, title case."""
    return rename_all(df, title_case_name)


def drop_prefixed(df: DataFrame, start: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(start)])


def relocate(df: DataFrame, *first: str) -> DataFrame:
    """Move columns to the front."""
    return df.select(*first, *[c for c in df.columns if c not in first])


def across(df: DataFrame, chosen: Callable[[str], bool], fn: Callable[[Column], Column]) -> DataFrame:
    """Apply one function to every chosen column."""
    return df.withColumns({c: fn(F.col(c)) for c in df.columns if chosen(c)})


def ints_where_named(df: DataFrame, piece: str) -> DataFrame:
    return across(df, lambda c: piece in c, text_to_int)


def split_to_rows(df: DataFrame, column: str, separator: str = r",\s*") -> DataFrame:
    """One row per part of a delimited cell; a NULL cell keeps its row."""
    return df.withColumn(column, F.explode_outer(F.split(column, separator)))


def months_to_rows(df: DataFrame, ids: Sequence[str], name: str = "month", value: str = "level") -> DataFrame:
    return df.unpivot(list(ids), MONTHS, name, value)


def counts_wide(df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str]) -> DataFrame:
    """Row counts per key, one column per listed value, 0 where there are none."""
    return df.groupBy(*keys).agg(*[F.count_if(F.col(column) == v).cast("long").alias(v) for v in values])


def to_long(df: DataFrame, names: dict[str, str], name: str, value: str) -> DataFrame:
    """One-row statistics as (name, value) rows; ``names`` maps columns to shown names."""
    pairs = [
        F.struct(F.lit(shown).alias(name), F.col(c).cast("double").alias(value)) for c, shown in names.items()
    ]
    return df.select(F.inline(F.array(*pairs)))


def bin_label(value: str | Column, ranges: Sequence[tuple[float, float, str]], default: str) -> Column:
    """Label of the first inclusive range that holds the value; NULL gets the default."""
    v = F.col(value) if isinstance(value, str) else value
    chain = None
    for low, high, label in ranges:
        test = (v >= low) & (v <= high)
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain.otherwise(default)


def report(df: DataFrame, n: int, order: Sequence[Column], shown: dict[str, Column] | None = None) -> DataFrame:
    """First n rows of an ordered table with report headers; ``shown`` replaces columns by
    rounded numbers or texts."""
    return format_titles(df.orderBy(*order).limit(n).withColumns(shown or {}))
