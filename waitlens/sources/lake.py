"""Bronze: partitioned scans, business-date slices, snapshots, historical loads."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waitlens.contracts import ENTITIES, Entity
from waitlens.functions.parsing import parse_as
from waitlens.sources.files import exists, partition_values


def bronze_path(lake: str, entity: Entity) -> str:
    return f"{lake.rstrip('/')}/bronze/{entity.path}"


def read_bronze(
    spark: SparkSession, lake: str, entity: Entity, dates: Iterable[date] | None = None
) -> DataFrame:
    """Scan an entity with its declared schema; ``dates`` prunes partitions.

    An entity that never landed reads as empty.
    """
    path = bronze_path(lake, entity)
    if not exists(spark, path):
        return spark.createDataFrame([], entity.schema())
    df = spark.read.schema(entity.schema()).parquet(path)
    return df if dates is None else df.where(F.col("ingest_date").isin(list(dates)))


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Scan files whose schemas differ, as the union of their columns."""
    return spark.read.option("mergeSchema", True).parquet(path)


#: Types in order: each can hold the values of those before it in its line.
_LINES = (("byte", "short", "integer", "long", "double"), ("float", "double"), ("date", "timestamp_ntz"))


def joined_type(one: str, two: str) -> str:
    """The narrowest type for the values of both; text holds any.

    Whole numbers and fractions meet in ``double``, which rounds beyond 2^53.
    """
    if one == two:
        return one
    for line in _LINES:
        if one in line and two in line:
            return max(one, two, key=line.index)
    if "float" in (one, two) and {one, two} & set(_LINES[0]):
        return "double"
    return "string"


def reconcile(frames: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(rows of all frames under one schema, report) of files that disagree on types.

    Each column takes the narrowest type that holds all its types, over the schemas alone;
    a column a frame lacks is NULL in its rows. The report has one row per column and
    frame: (column, source, given, taken, widened_to_text). Nested columns must agree.
    """
    # Decimals differ by their digits too.
    named = lambda t: t.simpleString() if t.typeName() == "decimal" else t.typeName()
    types: dict[str, str] = {}
    for df in frames.values():
        for f in df.schema:
            types[f.name] = joined_type(types.get(f.name, named(f.dataType)), named(f.dataType))
    spark = next(iter(frames.values())).sparkSession
    nested = {"struct", "array", "map"}
    parts, told = [], []
    for source, df in frames.items():
        given = {f.name: f.dataType for f in df.schema}
        columns = []
        for name, kind in types.items():
            has = given.get(name)
            if has is not None and has.typeName() in nested and kind == "string":
                raise ValueError(f"{name} of {source} is nested and cannot be joined with other types")
            if has is not None and named(has) == kind:
                columns.append(F.col(f"`{name}`"))
            else:
                target = next(f.dataType for d in frames.values() for f in d.schema if f.name == name) if kind in nested else kind
                columns.append((F.lit(None) if has is None else F.col(f"`{name}`")).cast(target).alias(name))
            told.append((name, source, None if has is None else named(has), kind, kind == "string" and has is not None and has.typeName() != "string"))
        parts.append(df.select(*columns))
    report = spark.createDataFrame(told, "column string, source string, given string, taken string, widened_to_text boolean")
    return reduce(DataFrame.unionByName, parts), report


def read_reconciled(spark: SparkSession, paths: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """Parquet folders whose types differ, read as one; see ``reconcile``.

    Only footers are read for the schemas.
    """
    return reconcile({p: spark.read.parquet(p) for p in paths})


def slice_by_date(df: DataFrame, date_col: str, run_date: date) -> DataFrame:
    """Rows whose ``date_col`` falls on ``run_date``.

    Written as a half-open range, not as a function of the column, so file statistics
    and source databases can use it.
    """
    kind = df.schema[date_col].dataType.simpleString()
    low, high = (F.lit(d).cast(kind) for d in (run_date, run_date + timedelta(days=1)))
    return df.where((F.col(date_col) >= low) & (F.col(date_col) < high))


def read_table_slice(
    spark: SparkSession,
    url: str,
    table: str,
    date_col: str | None,
    run_date: date,
    partition: tuple[str, int, int, int] | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A source table over JDBC, its date slice pushed to the database.

    ``partition`` is (column, lower, upper, parts) for parallel reading.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition:
        column, lower, upper, parts = partition
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", parts)
        )
    df = reader.load()
    return slice_by_date(df, date_col, run_date) if date_col else df


def snapshot(df: DataFrame, run_date: date) -> DataFrame:
    """The whole table as of the run date."""
    return df.withColumn("ingest_date", F.lit(run_date))


def write_partitions(
    df: DataFrame, path: str, column: str = "ingest_date", one_value: bool = False
) -> None:
    """Replace exactly the partitions present in ``df``, in one job.

    REBALANCE groups rows by partition value for well-sized files and splits a value
    that holds too much for one task, such as the start date old rows are clamped to.
    ``one_value``: all rows are of one partition, so each task writes what it has.
    """
    (
        (df if one_value else df.hint("rebalance", column))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def write_bronze(df: DataFrame, lake: str, entity: Entity) -> None:
    names = [f.name for f in entity.schema() if f.name in df.columns]
    write_partitions(df.select(*names), bronze_path(lake, entity))


def coerce(
    df: DataFrame,
    types: Mapping[str, str],
    mode: str = "permissive",
    now: Column | None = None,
) -> DataFrame:
    """Cast delivered columns to declared kinds.

    Permissive: a value that does not parse becomes NULL. Strict: it fails the run.
    A timestamp column that was not delivered takes the load time.
    """
    stamp = (F.current_timestamp() if now is None else now).cast("timestamp_ntz")
    columns = [
        parse_as(F.col(c), types[c], mode).alias(c) if c in types else F.col(c) for c in df.columns
    ]
    absent = [
        stamp.alias(c) for c, kind in types.items() if c not in df.columns and kind == "timestamp"
    ]
    return df.select(*columns, *absent)


def clamp_to(day: Column, start: date) -> Column:
    """Dates before ``start`` become ``start``; NULL stays NULL."""
    return F.when(day < F.lit(start), F.lit(start)).otherwise(day)


def backfill(df: DataFrame, date_col: str, start: date) -> tuple[DataFrame, DataFrame]:
    """(rows with their ``ingest_date``, rows without a business date)."""
    day = F.col(date_col).cast("date")
    return (
        df.where(day.isNotNull()).withColumn("ingest_date", clamp_to(day, start)),
        df.where(day.isNull()),
    )


def file_date(name: Column) -> Column:
    """Date in the first eight characters of a file name; NULL when there is none."""
    stem = F.substring(name, 1, 8)
    return F.when(stem.rlike("^[0-9]{8}$"), F.try_to_timestamp(stem, F.lit("yyyyMMdd"))).cast("date")


def backfill_by_file_name(
    df: DataFrame, start: date, name_col: str = "file_name"
) -> tuple[DataFrame, DataFrame]:
    """(rows dated by the file they came from, rows of files whose name holds no date)."""
    day = file_date(F.col(name_col))
    return (
        df.where(day.isNotNull()).withColumn("ingest_date", clamp_to(day, start)).drop(name_col),
        df.where(day.isNull()),
    )


def landed_dates(spark: SparkSession, lake: str, entity: Entity) -> list[date]:
    """Dates of an entity's landed partitions, from folder names alone."""
    found = partition_values(spark, bronze_path(lake, entity), "ingest_date")
    return [date.fromisoformat(d) for d in found if d[:1].isdigit()]


def listed_partitions(
    spark: SparkSession, lake: str, entities: Iterable[Entity] = tuple(ENTITIES.values())
) -> DataFrame:
    """(entity, ingest_date) of every landed partition, from folder names alone."""
    found = [
        (e.name, d) for e in entities for d in landed_dates(spark, lake, e)
    ]
    return spark.createDataFrame(found, "entity string, ingest_date date")


def missing_partitions(
    present: DataFrame, names: Sequence[str], first: date | None = None, last: date | None = None
) -> DataFrame:
    """Entity x day cells of the range without a partition; by default the last 365 days.

    ``present`` has (entity, ingest_date). The grid is as large as the range asked for,
    whatever the data.
    """
    spark = present.sparkSession
    last = last or date.today()
    first = first or last - timedelta(days=364)
    grid = spark.range(1).select(
        F.explode(F.array(*[F.lit(n) for n in names])).alias("entity")
    ).select(
        "entity", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("ingest_date")
    )
    return grid.join(present.select("entity", "ingest_date").distinct(), ["entity", "ingest_date"], "left_anti")
