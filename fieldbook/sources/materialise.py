"""Compute once, write, check what landed, read back."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from fieldbook.session import shared_folder


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to the path has been committed (its success marker is there)."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def fingerprint(spark: SparkSession, paths: str | list[str], timed: bool = True) -> dict | None:
    """Number, bytes and a digest of names, sizes and (if ``timed``) times of files; None if none is there.

    Only the file listing is read.
    """
    try:
        files = spark.read.format("binaryFile").load(paths)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    name = F.element_at(F.split("path", "/"), -1)
    known = [name, F.col("length"), *([F.col("modificationTime")] if timed else [])]
    digest = F.sum(F.xxhash64(*known).cast("decimal(20,0)")).cast("string")
    return files.agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), digest.alias("digest")).first().asDict()


def _manifest(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path, "_manifest")
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def manifest(spark: SparkSession, path: str) -> dict | None:
    """What was noted when the table was written: ``rows``, ``table`` and ``inputs``."""
    place, system = _manifest(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def land(spark: SparkSession, path: str, df: DataFrame, inputs: dict | None = None) -> None:
    """Write a table, compare the rows that landed with those that were sent, and note both beside it."""
    sent = Observation()
    df.observe(sent, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    rows, expected = spark.read.schema(df.schema).parquet(path).count(), sent.get["rows"]
    if rows != expected:
        raise ValueError(f"{path}: {rows} of {expected} rows landed")
    note = {"rows": rows, "table": fingerprint(spark, path, timed=False), "inputs": inputs}
    place, system = _manifest(spark, path)
    stream = system.create(place, True)
    try:
        stream.write(bytearray(json.dumps(note).encode()))
    finally:
        stream.close()


def _still_good(spark: SparkSession, path: str, inputs: dict | None) -> bool:
    if not is_complete(spark, path):
        return False
    noted = manifest(spark, path)
    if noted is None:
        # Written by other means, with no word on what it was made from.
        return inputs is None
    if noted["table"] != fingerprint(spark, path, timed=False):
        return False
    return inputs is None or noted["inputs"] == inputs


def read_through(spark: SparkSession, path: str, build: Callable[[], DataFrame], inputs: str | list[str] | None = None) -> DataFrame:
    """The table at ``path``, built and written there first if it is not there as it was written.

    The path belongs on storage all executors share. A half-written table of a lost run has no success
    marker and is built anew, as is one that has lost a part or whose ``inputs`` (files) have changed since in
    number, name, size or time. Inputs that are gone altogether change nothing.
    """
    seen = fingerprint(spark, inputs) if inputs else None
    if not _still_good(spark, path, seen):
        land(spark, path, build(), seen)
    return spark.read.parquet(path)


def keep(df: DataFrame) -> DataFrame:
    """The frame written to the shared checkpoint folder and read back.

    Cuts the lineage of a costly frame that is used several times: a lost executor then
    rereads files instead of repeating joins, and later plans see real sizes and columns.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
