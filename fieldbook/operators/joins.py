"""Joins whose keys match NULL with NULL, natural full joins, suffixes and lookups.

No join here is hinted: Spark broadcasts a side only below its own size limit, measured at
run time by AQE, and otherwise sort-merges with hot partitions split. The one exception is
``lookup`` over a literal dictionary, whose size is fixed in the program.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from fieldbook.operators.literals import literal_table

Key = str | tuple[str, str]


def _pairs(keys: Sequence[Key]) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else k for k in keys]


def equi_join(left: DataFrame, right: DataFrame, keys: Sequence[Key], how: str = "inner",
              null_safe: bool = True) -> DataFrame:
    """Join on keys that may be named differently; only the left key names are kept.

    ``null_safe`` lets NULL match NULL. Not for full joins (see ``natural_full_join``).
    """
    pairs = _pairs(keys)
    renamed = {r: f"__right_{i}" for i, (_, r) in enumerate(pairs)}
    right = right.withColumnsRenamed(renamed)
    clash = set(left.columns) & set(right.columns)
    if clash and how not in ("left_semi", "left_anti"):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    if clash:
        right = right.select(*renamed.values())

    def match(l: str, r: str) -> Column:
        a, b = F.col(l), F.col(renamed[r])
        return a.eqNullSafe(b) if null_safe else a == b

    joined = left.join(right, reduce(Column.__and__, [match(l, r) for l, r in pairs]), how)
    return joined.drop(*renamed.values())


def suffix_join(left: DataFrame, right: DataFrame, keys: Sequence[Key], suffixes: tuple[str, str],
                how: str = "left") -> DataFrame:
    """Join where clashing non-key columns of both sides get a suffix."""
    pairs = _pairs(keys)
    left_keys, right_keys = {l for l, _ in pairs}, {r for _, r in pairs}
    clash = (set(left.columns) - left_keys) & (set(right.columns) - right_keys)
    return equi_join(
        left.withColumnsRenamed({c: c + suffixes[0] for c in clash}),
        right.withColumnsRenamed({c: c + suffixes[1] for c in clash}),
        keys, how,
    )


def natural_full_join(left: DataFrame, right: DataFrame, right_unique: bool = False, spread: bool = False) -> DataFrame:
    """Full outer join on all shared columns, NULL matching NULL.

    Written as matched rows plus the unmatched rows of each side: Spark can split a hot key
    in inner and anti joins but not in a full outer join. The anti joins look up distinct
    keys, so copies of a key collapse before the shuffle. If the right side is known to hold
    each key once or rarely more, only the left side can be hot and one left join replaces two
    of the parts. If keys are ``spread`` on both sides, as where they name a row, no split is needed
    and one full outer join reads each side once.
    """
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("no shared columns")
    types = dict(left.dtypes), dict(right.dtypes)
    differing = [c for c in shared if types[0][c] != types[1][c]]
    if differing:
        raise ValueError(f"types differ in {differing}")
    if spread:
        other = {c: f"__right_{i}" for i, c in enumerate(shared)}
        match = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(r)) for c, r in other.items()])
        joined = left.join(right.withColumnsRenamed(other), match, "full")
        return joined.withColumns({c: F.coalesce(c, r) for c, r in other.items()}).drop(*other.values())
    if right_unique:
        kept = equi_join(left, right, shared, "left")
    else:
        left_only = equi_join(left, right.select(*shared).distinct(), shared, "left_anti")
        kept = equi_join(left, right, shared).unionByName(left_only, allowMissingColumns=True)
    right_only = equi_join(right, left.select(*shared).distinct(), shared, "left_anti")
    return kept.unionByName(right_only, allowMissingColumns=True)


def read_by_all(df: DataFrame) -> tuple[DataFrame, Column]:
    """For a frame that two branches of one plan read: the frame dealt anew, and a condition that is always true.

    A branch that reads fewer columns than the other would be planned, and so evaluated, on its own. With the
    condition it reads all of them; then both branches share one exchange, and what lies below it runs once.
    Spark evens out the sizes of the exchange's partitions at run time, whatever the keys.
    """
    return df.hint("rebalance"), F.xxhash64(*df.columns).bitwiseOR(F.lit(1)) != 0


def lookup(df: DataFrame, key: str, names: Mapping[str, str], new: str) -> DataFrame:
    """Name for a key from a literal dictionary; NULL if it has none."""
    table = literal_table(df.sparkSession, names.items(), f"__key:string, {new}:string")
    return df.join(F.broadcast(table), F.col(key).cast("string") == F.col("__key"), "left").drop("__key")


def map_lookup(key: Column, names: Mapping[str, str]) -> Column:
    """The same as an expression, for a few entries."""
    literal = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.try_element_at(literal, key)
