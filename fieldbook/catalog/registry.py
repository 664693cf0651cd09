"""Registry of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from fieldbook.session import apply_skew_settings


_SCHEMAS: dict[tuple[str, int], StructType] = {}


def _changed(spark: SparkSession, path: str) -> int:
    """When the table was last written."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).getModificationTime()


class Tables:
    """The parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        # The schema is read from a file's footer once per state of the table, not by every query.
        path = f"{self.folder}/{name}.parquet"
        key = path, _changed(self.spark, path)
        if key not in _SCHEMAS:
            _SCHEMAS[key] = self.spark.read.parquet(path).schema
        table = self.spark.read.schema(_SCHEMAS[key]).parquet(path)
        setattr(self, name, table)
        return table


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(apply_skew_settings(spark), folder))


REGISTRY: dict[str, Query] = {}


def query(sql: str):
    """Register a function of the tables under its own name, with the SQL to compare."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if build.__name__ in REGISTRY:
            raise ValueError(f"registered twice: {build.__name__}")
        REGISTRY[build.__name__] = Query(build, sql)
        return build

    return register


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Doubles rounded for comparison: sums depend on the order of their inputs."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def with_views(select: str, **views: str) -> str:
    """A SELECT over named subqueries."""
    parts = ",\n".join(f"{name} AS ({text})" for name, text in views.items())
    return f"WITH {parts}\n{select}"


# The distribution function of Student's t from 0 to 20 by the trapezoid rule on a fine grid, for the
# statistic and the degrees of freedom in a view ``test``.
T_GRID = """grid AS (SELECT k, k * 0.0005 AS x, statistic, t_df,
                exp(lgamma((t_df + 1) / 2) - lgamma(t_df / 2)) / sqrt(t_df * pi())
                  * pow(1 + (k * 0.0005) * (k * 0.0005) / t_df, -(t_df + 1) / 2) AS density
         FROM test, (SELECT unnest(range(0, 40001)) AS k)),
area AS (SELECT k, x, statistic, 0.5 + sum(density) OVER (ORDER BY k) * 0.0005 - 0.00025 * (density + first_value(density) OVER (ORDER BY k)) AS cdf FROM grid)"""
