"""Text expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from fieldbook.functions.nulls import as_col


def remove_first(value: str | Column, pattern: str) -> Column:
    """Drop the first match of a regular expression only."""
    c = as_col(value)
    start = F.regexp_instr(c, F.lit(pattern))
    return F.when(
        start > 0,
        F.overlay(c, F.lit(""), start, F.length(F.regexp_extract(c, pattern, 0))),
    ).otherwise(c)


def remove_first_text(value: str | Column, piece: str | Column) -> Column:
    """Drop the first occurrence of the text held in another column."""
    c, p = as_col(value), as_col(piece)
    start = F.position(p, c)
    return F.when(start > 0, F.overlay(c, F.lit(""), start, F.length(p))).otherwise(c)


def remove_all(value: str | Column, piece: str) -> Column:
    return F.replace(as_col(value), F.lit(piece), F.lit(""))


def trim_space(value: str | Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(as_col(value), r"^\s+|\s+$", "")


def extract(value: str | Column, pattern: str, group: int = 1) -> Column:
    """Regex group, NULL (not '') where the pattern does not match."""
    c = as_col(value)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def state_code(area_name: str | Column) -> Column:
    """The two characters after the first ', ' of an area name."""
    return extract(area_name, r", (.{2})")


def prefix(value: str | Column, length: int) -> Column:
    return F.substring(as_col(value), 1, length)


def title_case_name(name: str) -> str:
    return " ".join(part[:1].upper() + part[1:].lower() for part in name.replace("_", " ").split(" "))


def tidy_name(name: str) -> str:
    """Header made safe for Spark: runs of other characters become one underscore."""
    return re.sub(r"[^A-Za-z0-9]+", "_", name).strip("_")
