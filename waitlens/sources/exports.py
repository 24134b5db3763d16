"""Gold exports (``table=/export_date=``) and the data-test result table."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitlens.contracts import GOLD_TABLES
from waitlens.sources.files import partition_values, subfolders
from waitlens.sources.lake import write_partitions


def table_path(root: str, table: str) -> str:
    if table not in GOLD_TABLES:
        raise ValueError(f"{table!r} is not an exported table")
    return f"{root.rstrip('/')}/table={table}"


def export_gold(tables: Mapping[str, DataFrame], root: str, export_date: date | str) -> None:
    """Write each table under its export date; a repeated export replaces that date only."""
    day = date.fromisoformat(export_date) if isinstance(export_date, str) else export_date
    for name, df in tables.items():
        write_partitions(
            df.withColumn("export_date", F.lit(day)), table_path(root, name), "export_date", one_value=True
        )


def list_exports(spark: SparkSession, root: str, table: str | None = None) -> list[str]:
    """Export dates, newest first, of one table or of any."""
    folders = (
        [table_path(root, table)]
        if table
        else [f"{root.rstrip('/')}/{n}" for n in subfolders(spark, root)]
    )
    dates = {d for f in folders for d in partition_values(spark, f, "export_date")}
    return sorted(dates, reverse=True)


def read_export(
    spark: SparkSession, root: str, table: str, export_date: str | None = None, every: bool = False
) -> DataFrame:
    """One export of a table: the named date, else the newest; ``every`` reads all dates."""
    df = spark.read.parquet(table_path(root, table))
    if every:
        return df
    available = list_exports(spark, root, table)
    chosen = export_date or available[0]
    if chosen not in available:
        raise ValueError(f"no export of {table} on {chosen}")
    return df.where(F.col("export_date") == F.lit(date.fromisoformat(chosen))).drop("export_date")


def write_runs(runs: DataFrame, root: str) -> None:
    """Store data-test runs: the table keeps the latest run of a day, the JSON every run."""
    write_partitions(runs, f"{root.rstrip('/')}/results", "run_date")
    runs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "run_id"
    ).json(f"{root.rstrip('/')}/runs")


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/results")
