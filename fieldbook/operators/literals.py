"""Small tables written in the program."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def literal_table(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """Rows as literals inside the plan: no Python conversion, and a size Spark knows.

    ``schema`` is ``name:type, name:type``.
    """
    literals = [F.struct(*[F.lit(v) for v in row]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*literals).cast(f"array<struct<{schema}>>")))
