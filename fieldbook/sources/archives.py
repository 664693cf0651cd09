"""CSV tables inside zip archives.

Spark has no zip codec. Each archive is opened in one task, which reads its central directory and then only the
members it wants, by ranges of the file, and streams them out as Arrow batches with only the wanted
columns. So a task holds one block of rows at a time, whatever the archive's size. Files are opened by
Arrow, so they must lie where it can read (a local path, s3, gs, hdfs). Rewrite archives once as Parquet
(``write_parquet(..., by=["year"])``) before repeated use.
"""

from __future__ import annotations

import zipfile
import zlib
from collections.abc import Iterator, Sequence
from typing import BinaryIO

import pyarrow as pa
import pyarrow.csv as pa_csv
import pyarrow.fs as pa_fs
from pyspark.sql import DataFrame, SparkSession, functions as F

_FAULTS = (zipfile.BadZipFile, EOFError, zlib.error, pa.ArrowInvalid, NotImplementedError)


def _open(path: str) -> BinaryIO:
    """A landed file for reading by ranges."""
    if path.startswith("file:"):
        return pa_fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    system, place = pa_fs.FileSystem.from_uri(path)
    return system.open_input_file(place)


def _listed(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The archives, a task for about each by their sizes; their content is not read here."""
    return spark.read.format("binaryFile").load(paths).select("path", "length")


def read_zipped_csv(
    spark: SparkSession, paths: str | list[str], columns: Sequence[str], skip_broken: bool = False, fault: str | None = None
) -> DataFrame:
    """Columns (as text) of every CSV in the archives, plus ``path`` of the archive.

    An archive that is no zip file or has a damaged member is an error. With ``skip_broken``, one that is no zip file
    yields no rows, and ``broken`` lists it. With a column name for ``fault``, both kinds yield a row that holds
    only the path and the fault, beside the rows read before it, so one reading gives data and faults.
    """
    wanted = list(columns)
    extra = [fault] if fault else []
    schema = pa.schema([pa.field(c, pa.string()) for c in ["path", *wanted, *extra]])

    def rows_of(path: str, columns: list[pa.Array], count: int, found: str | None) -> pa.RecordBatch:
        more = [pa.array([found] * count, pa.string())] if fault else []
        return pa.RecordBatch.from_arrays([pa.array([path] * count, pa.string()), *columns, *more], schema=schema)

    def tables(path: str) -> Iterator[pa.RecordBatch]:
        options = pa_csv.ConvertOptions(
            include_columns=wanted, include_missing_columns=True,
            column_types={c: pa.string() for c in wanted}, strings_can_be_null=True,
        )
        with _open(path) as file:
            try:
                archive = zipfile.ZipFile(file)
            except (zipfile.BadZipFile, pa.ArrowInvalid):
                if skip_broken:
                    return
                raise
            for member in archive.namelist():
                if member.lower().endswith(".csv"):
                    with archive.open(member) as text:
                        for rows in pa_csv.open_csv(text, convert_options=options):
                            yield rows_of(path, [rows.column(c) for c in wanted], rows.num_rows, None)

    def unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                try:
                    yield from tables(path)
                except _FAULTS as found:
                    if not fault:
                        raise ValueError(f"{path}: {found}") from found
                    yield rows_of(path, [pa.nulls(1, pa.string())] * len(wanted), 1, str(found))

    ddl = ", ".join(f"`{c}` string" for c in schema.names)
    return _listed(spark, paths).mapInArrow(unzip, ddl)


def undersized(spark: SparkSession, paths: str | list[str], minimum: int) -> DataFrame:
    """Landed files smaller than expected (only the file listing is read)."""
    return _listed(spark, paths).where(F.col("length") < minimum)


def broken(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path`` and ``fault`` of archives that are no zip files or have a damaged member."""
    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                try:
                    with _open(path) as file:
                        damaged = zipfile.ZipFile(file).testzip()
                    found += [(path, f"damaged member {damaged}")] if damaged else []
                except _FAULTS as fault:
                    found.append((path, str(fault)))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.string()) for k in (0, 1)], ["path", "fault"])

    return _listed(spark, paths).mapInArrow(test, "path string, fault string")
