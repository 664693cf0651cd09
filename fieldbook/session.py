"""Session helpers.

On a cluster the session comes from the platform; only runtime SQL settings that
matter for skewed groups are switched on here. ``local_session`` is for tests and the
bench.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime settings the operators rely on for hot keys: plain joins are left unhinted, so
# that AQE picks a broadcast only under the measured size limit and splits hot partitions
# of sort-merge joins otherwise (also where an aggregate on the same key follows).
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def apply_skew_settings(spark: SparkSession) -> SparkSession:
    for key, value in SKEW_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", name: str = "fieldbook") -> SparkSession:
    partitions = "8" if cpus == "*" else str(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in SKEW_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Where none is named, the checkpoint folder of the context, or in local mode a private one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="fieldbook-"))
    return context.getCheckpointDir()
