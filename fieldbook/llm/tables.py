"""Intermediate tables in the folder all executors share, and small DataFrame helpers."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fieldbook.session import shared_folder


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_DEFAULT_BATCH, SMALL_BATCH = "67108864b", "4m"


def small_batches(spark: SparkSession) -> None:
    """Batches for Python of a few megabytes, unless the session has a size of its own.

    Spark's default of 64 MB is held more than once by the task and by its worker.
    """
    if spark.conf.get(_BATCH) == _DEFAULT_BATCH:
        spark.conf.set(_BATCH, SMALL_BATCH)


class Scratch:
    """Tables of one run of an operator under ``spark.checkpoint.dir``.

    A written table cuts the lineage: after a lost executor Spark rereads files, and plans see real
    sizes. ``keep_only`` deletes the tables that nothing reads any more; those that the lazy result of an
    operator reads stay in the folder until its owner clears it.
    """

    def __init__(self, spark: SparkSession, label: str):
        small_batches(spark)
        self.spark = spark
        self.folder = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        self.paths: dict[str, str] = {}
        self.old: list[str] = []

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        if name in self.paths:
            self.old.append(self.paths[name])
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_only(self, *names: str) -> None:
        """Deletes all tables but the last of each of these names."""
        gone = self.old + [path for name, path in self.paths.items() if name not in names]
        for path in map(self.spark._jvm.org.apache.hadoop.fs.Path, gone):
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.paths, self.old = {name: self.paths[name] for name in names if name in self.paths}, []


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


BITS = 1 << 25
_WORD_BYTES = 4096


def maybe_among(keys: DataFrame, key: Column) -> Callable[[Column], Column]:
    """A test of long keys that is true for all in ``keys`` and false for most others.

    The keys, which must be hashes, set bits in a map of fixed size (4 MB), whatever their number; more keys
    let more others through. So large rows that cannot match a join stay where they are, and
    only the others are shuffled to the exact one.
    """
    place = F.pmod(key, F.lit(BITS)) + 1
    words = keys.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("word")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")
    )
    bits = np.zeros(BITS // 8, np.uint8)
    for row in words.collect():
        at = (row.word - 1) * _WORD_BYTES
        bits[at:at + _WORD_BYTES] = np.frombuffer(row.bits, np.uint8)
    shared = keys.sparkSession.sparkContext.broadcast(bits)

    @F.arrow_udf("boolean")
    def test(hashes: pa.Array) -> pa.Array:
        at = hashes.to_numpy() % BITS
        return pa.array(shared.value[at >> 3] >> (at & 7) & 1 == 1)

    return test


def numbered(scratch: Scratch, df: DataFrame, order: list[Column], position: str) -> DataFrame:
    """Rows of unlike ``order`` with their gapless place from 0, without ordering all rows in one task.

    Ranges of the order are numbered on their own and shifted by the counts of the ranges before;
    only those counts, one row a range, meet in one task.
    """
    ranged = scratch.put(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), f"ranged-{position}")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_range").count().select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.join(starts, "_range").withColumn(position, F.col("_start") + within - 1).drop("_range", "_start")
