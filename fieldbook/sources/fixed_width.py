"""Fixed-width text and sheets with leading lines to skip.

Line order exists only inside a file, so a file is one row (``wholetext``) and its lines an
array: skipping and pairing by position need no shuffle and no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldbook.functions.numbers import text_to_double, text_to_int
from fieldbook.functions.nulls import as_col


def read_whole_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Columns ``path`` and ``value`` (the whole text of a file)."""
    df = spark.read.text(paths, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("path"), "value")


def lines_of(text: str | Column, skip: int = 0) -> Column:
    """The lines of a text as an array, without the first ``skip`` and without a last empty one."""
    body = F.regexp_replace(as_col(text), r"\r?\n$", "")
    lines = F.split(body, r"\r?\n")
    return F.slice(lines, skip + 1, F.greatest(F.size(lines) - skip, F.lit(0))) if skip else lines


def cut(line: Column, start: int, end: int) -> Column:
    """Characters start..end, both counted from 1 and included."""
    return F.substring(line, start, end - start + 1)


def pair_by_position(df: DataFrame, first: Column, second: Column, names: tuple[str, str]) -> DataFrame:
    """Pair two lists of the same row by position; the shorter is padded with NULL."""
    pairs = F.arrays_zip(first.alias(names[0]), second.alias(names[1]))
    others = df.columns
    return (
        df.select(*others, F.posexplode(pairs).alias("position", "__pair"))
        .select(*others, (F.col("position") + 1).alias("position"),
                *[F.col("__pair")[n].alias(n) for n in names])
    )


def permit_table(files: DataFrame) -> DataFrame:
    """Area code (characters 5-10) and unit count (characters 48-53) of permit listings.

    Eleven lines precede the table. Codes and counts stand on separately chosen lines and
    belong together by position, so both lists must be equally long.
    """
    lines = files.withColumn("__lines", lines_of("value", skip=11))
    codes = F.transform(
        F.filter("__lines", lambda l: l.rlike("^[0-9]")), lambda l: text_to_int(cut(l, 5, 10)).cast("long")
    )
    counts = F.transform(
        F.filter("__lines", lambda l: cut(l, 48, 53).rlike("[0-9]")), lambda l: text_to_int(cut(l, 48, 53))
    )
    listed = lines.select("path", codes.alias("__codes"), counts.alias("__counts")).withColumn(
        "__counts",
        F.when(F.size("__codes") == F.size("__counts"), F.col("__counts"))
        .otherwise(F.raise_error(F.concat(F.lit("codes and counts differ in number: "), F.col("path")))),
    )
    names = ("cbsa", "new_housing_units_permitted")
    paired = pair_by_position(listed, F.col("__codes"), F.col("__counts"), names)
    file_name = F.element_at(F.split("path", "/"), -1)
    return paired.select(*names, F.regexp_extract(file_name, r"(\d{4})", 1).try_cast("int").alias("year"))


def csv_cells(line: str | Column) -> Column:
    """The cells of a comma-separated line; a quoted cell may hold commas and doubled quotes."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), as_col(line)), F.lit(r',(\s*"(?:[^"]|"")*"\s*|[^,]*)'), F.lit(1))

    def plain(cell: Column) -> Column:
        inner = F.trim(cell)
        return F.when(inner.startswith('"'), F.replace(F.substring(inner, 2, F.length(inner) - 2), F.lit('""'), F.lit('"'))).otherwise(inner)

    return F.transform(cells, plain)


def sheet_table(files: DataFrame, skip: int, columns: dict[str, str | int], year: Column) -> DataFrame:
    """Rows of a sheet saved as comma-separated text: header after ``skip`` lines, rows with
    any empty cell left out, columns kept by their header (or by place, from 1).

    A header that a sheet lacks is an error.
    """
    lines = files.select("path", lines_of("value", skip=skip).alias("__lines"))
    sheet = lines.select("path", csv_cells(F.get("__lines", F.lit(0))).alias("__header"), F.explode(F.slice("__lines", 2, F.greatest(F.size("__lines"), F.lit(1)))).alias("__line"))
    cells = sheet.select("path", "__header", csv_cells("__line").alias("__cells"))
    complete = cells.where(~F.exists("__cells", lambda c: F.trim(c) == ""))

    def place(wanted: str | int) -> Column:
        if isinstance(wanted, int):
            return F.lit(wanted)
        at = F.array_position("__header", F.lit(wanted)).cast("int")
        absent = F.raise_error(F.concat(F.lit(f"no column {wanted} in "), F.col("path"))).cast("int")
        return F.when(at > 0, at).otherwise(absent)

    return complete.select(
        *[F.trim(F.try_element_at("__cells", place(wanted))).alias(name) for name, wanted in columns.items()],
        year.alias("year"),
    )


def permit_sheet(files: DataFrame, code_place: str | int = "CBSA", total_place: str | int = "Total") -> DataFrame:
    """The newer permit listings: area code and total from a sheet with five leading lines."""
    file_name = F.element_at(F.split("path", "/"), -1)
    year = F.regexp_extract(file_name, r"(\d{4})", 1).try_cast("int")
    rows = sheet_table(files, 5, {"cbsa": code_place, "total": total_place}, year)
    return rows.select(
        text_to_double("cbsa").cast("long").alias("cbsa"),
        text_to_int("total").alias("new_housing_units_permitted"),
        "year",
    )
