"""Delimited text, year-sliced folders and their writers.

Schemas are always given: inference would read the data twice and differ between slices.
"""

from __future__ import annotations

import csv
import warnings
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from fieldbook.functions.text import tidy_name


def _wanted(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def headers(spark: SparkSession, paths: str | list[str], sep: str = ",") -> dict[tuple[str, ...], list[str]]:
    """Files by their header, each read to the end of its first line only; files without a line are left out."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(file: str) -> str | None:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        codec = codecs.getCodec(path)
        stream = path.getFileSystem(conf).open(path)
        try:
            raw = codec.createInputStream(stream) if codec else stream
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(raw, "UTF-8")).readLine()
        finally:
            stream.close()

    files = sorted(spark.read.text(paths).inputFiles())
    found: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for file, line in zip(files, pool.map(first_line, files)):
            if line is not None:
                found.setdefault(tuple(next(csv.reader([line.lstrip("\ufeff")], delimiter=sep))), []).append(file)
    return found


def _by_header(spark: SparkSession, paths: str | list[str], schema: StructType | str, extra: bool, tidy: bool, warn: bool = False, **options) -> DataFrame:
    """Columns by their header names, in the order of the schema.

    Files are grouped by their header, one scan a group, so files of one call may order their columns in their own way.
    """
    wanted = _wanted(schema)
    options = {"header": True, "mode": "PERMISSIVE", "ignoreCorruptFiles": False, "enforceSchema": False, **options}
    kinds = {tidy_name(f.name) if tidy else f.name: f.dataType for f in wanted.fields}
    parts = []
    for header, files in headers(spark, paths, options.get("sep", ",")).items():
        names = [tidy_name(c) for c in header] if tidy else list(header)
        if absent := [c for c in kinds if c not in names]:
            raise ValueError(f"columns {absent} are not in the header {list(header)} of {files}")
        full = StructType([StructField(c, kinds.get(name, StringType())) for c, name in zip(header, names)])
        rows = spark.read.schema(full).options(**options).csv(files).withColumnsRenamed(dict(zip(header, names)))
        parts.append(rows.select(*[f"`{c}`" for c in [*kinds, *([c for c in names if c not in kinds] if extra else [])]]))
    if not parts:
        raise ValueError(f"no header in {paths}")
    if warn:
        for row in count_malformed(spark, paths, schema, tidy, **options).collect():
            warnings.warn(f"{row.file}: {row.lines} lines with cells that do not fit", stacklevel=3)
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=extra), parts)


def read_csv(spark: SparkSession, paths: str | list[str], schema: StructType | str, extra: bool = False, warn: bool = False, **options) -> DataFrame:
    """CSV with a header, plain or gzip (one task per gzip file), columns chosen by name.

    Files may order their columns unlike each other. A column of the schema that a header lacks is an error;
    other columns of a file are left out, or with ``extra`` follow as text, missing where a file lacks them. Files
    that cannot be read to their end are an error, files without a line have no rows. A cell that
    does not fit its type is NULL; ``malformed`` shows the lines with such cells, and with ``warn`` files
    that have some are named in a warning, for which the files are read once more.
    """
    return _by_header(spark, paths, schema, extra, False, warn, **options)


def malformed(spark: SparkSession, paths: str | list[str], schema: StructType | str, tidy: bool = False, **options) -> DataFrame:
    """The lines of CSVs (as ``line``, with ``file``) with a cell that does not fit its type or too few or many cells."""
    wanted = _wanted(schema)
    options = {"header": True, "enforceSchema": False, **options, "mode": "PERMISSIVE"}
    kinds = {tidy_name(f.name) if tidy else f.name: f.dataType for f in wanted.fields}
    parts = []
    for header, files in headers(spark, paths, options.get("sep", ",")).items():
        typed = [StructField(c, kinds.get(tidy_name(c) if tidy else c, StringType())) for c in header]
        rows = spark.read.schema(StructType([*typed, StructField("_line", StringType())])).options(**options, columnNameOfCorruptRecord="_line").csv(files)
        # The cells are named too: Spark parses, and so checks, only cells that are asked for.
        cells = F.to_json(F.struct(*[f"`{c}`" for c in header])).alias("cells")
        parts.append(rows.where(F.col("_line").isNotNull()).select(F.col("_metadata.file_path").alias("file"), cells, F.col("_line").alias("line")))
    return reduce(DataFrame.unionByName, parts)


def count_malformed(spark: SparkSession, paths: str | list[str], schema: StructType | str, tidy: bool = False, **options) -> DataFrame:
    """Files with malformed lines, and how many."""
    return malformed(spark, paths, schema, tidy, **options).groupBy("file").agg(F.count("cells").alias("lines"))


def read_tsv(spark: SparkSession, paths: str | list[str], schema: StructType | str,
             null_marker: str | None = None, extra: bool = False, warn: bool = False) -> DataFrame:
    """TSV with a header; the null marker, if given, stands for a missing value."""
    options = {"sep": "\t"}
    if null_marker is not None:
        options["nullValue"] = null_marker
    return read_csv(spark, paths, schema, extra, warn, **options)


def read_csv_tidy(spark: SparkSession, paths: str | list[str], schema: StructType | str, extra: bool = False, warn: bool = False,
                  **options) -> DataFrame:
    """CSV whose headers (``ZipCode(s)``) are made safe (``ZipCode_s``) and matched with the schema's names made safe."""
    return _by_header(spark, paths, schema, extra, True, warn, **options)


def with_slice_year(df: DataFrame, column: str = "year") -> DataFrame:
    """The four-digit year in the name of the file a row came from."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return df.withColumn(column, F.regexp_extract(name, r"(\d{4})", 1).try_cast("int"))


def read_year_folders(spark: SparkSession, root: str, schema: StructType | str, years: Iterable[int]) -> DataFrame:
    """Parquet written as ``year=YYYY`` folders; other years are not even listed as input."""
    full = StructType.fromDDL(schema) if isinstance(schema, str) else StructType(list(schema.fields))
    if "year" not in full.fieldNames():
        full = StructType([*full.fields, StructField("year", IntegerType())])
    return spark.read.schema(full).parquet(root).where(F.col("year").isin([int(y) for y in years]))


def write_csv(df: DataFrame, path: str, gzip: bool = False) -> None:
    df.write.mode("overwrite").csv(path, header=True, compression="gzip" if gzip else "none")


def write_parquet(df: DataFrame, path: str, by: Iterable[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
