"""Delimited file drops: landing as text, export-date folders, inventories."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from waitlens.sources.files import files, first_line, partition_values


def _text_reader(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    """CSV as text: nothing becomes NULL by its spelling, bad bytes are replaced.

    Headers are checked in every file: files whose columns differ or are in another
    order fail instead of landing under the wrong names.
    """
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("pathGlobFilter", "*.[cC][sS][vV]")
        .option("nullValue", "\u0000")
        .option("emptyValue", "")
    )


def _text(name: str, empty_as_null: bool = False) -> Column:
    kept = F.coalesce(F.col(f"`{name}`"), F.lit(""))
    return (F.nullif(kept, F.lit("")) if empty_as_null else kept).alias(name)


def land_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str] | None = None,
    empty_as_null: bool = False,
    recursive: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Every column as text, named by the header, plus the ``file_name`` of each row.

    Undecodable bytes are replaced, quoted line breaks kept, and files that are not CSV
    ignored. Without ``columns`` the header of the drop names them, so a file with a
    header only lands as no rows with the right columns. Empty fields stay empty text
    unless ``empty_as_null``. Large files are split among tasks; files with quoted line
    breaks cannot be, and need ``multi_line=True``.
    """
    reader = _text_reader(spark, multi_line).option("recursiveFileLookup", recursive)
    if columns is not None:
        reader = reader.schema(", ".join(f"`{c}` STRING" for c in columns))
    rows = reader.csv(path)
    name = F.col("_metadata.file_name").alias("file_name")
    return rows.select(*[_text(c, empty_as_null) for c in rows.columns], name)


def land_mixed_csv(
    spark: SparkSession, path: str, empty_as_null: bool = False, multi_line: bool = False
) -> DataFrame | None:
    """A drop whose files differ in columns or their order, landed under one set of columns.

    Only the first line of each file is read to tell the headers apart; files of one header
    are landed together. A column a file lacks is NULL in its rows. None for no files.
    """
    by_header: dict[str, list[str]] = {}
    for name in files(spark, path):
        if name.lower().endswith(".csv"):
            by_header.setdefault(first_line(spark, f"{path}/{name}"), []).append(f"{path}/{name}")
    landed = [
        land_csv(spark, found, None, empty_as_null, False, multi_line) for header, found in by_header.items() if header
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), landed) if landed else None


def export_dates(spark: SparkSession, root: str) -> list[date]:
    """Dates of the ``export_date=YYYYMMDD`` folders, ascending."""
    found = [v for v in partition_values(spark, root, "export_date") if len(v) == 8 and v.isdigit()]
    return sorted(date(int(v[:4]), int(v[4:6]), int(v[6:])) for v in found)


def land_exports(
    spark: SparkSession, root: str, only: date | None = None, multi_line: bool = False
) -> DataFrame | None:
    """All exports (or one), each row under its export date as ``ingest_date``.

    None when there is nothing to land: the caller records the source as skipped.
    """
    days = [d for d in export_dates(spark, root) if only is None or d == only]
    if not days:
        return None
    pattern = f"{root.rstrip('/')}/export_date={{{','.join(d.strftime('%Y%m%d') for d in days)}}}"
    rows = _text_reader(spark, multi_line).csv(pattern)
    if not rows.columns:
        return None
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"export_date=([0-9]{8})/", 1)
    return rows.select(
        *[_text(c) for c in rows.columns], F.to_date(folder, "yyyyMMdd").alias("ingest_date")
    )


def inventory(spark: SparkSession, path: str, with_path: bool = False) -> DataFrame:
    """Name, size and SHA-256 of every file, hashed where the file is read.

    A file passes through one task whole, so it must be smaller than 2 GB.
    """
    found = spark.read.format("binaryFile").load(path)
    return found.select(
        *["path"] * with_path,
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("bytes"),
        F.sha2("content", 256).alias("sha256"),
    )
