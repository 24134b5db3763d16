"""Reference tables stored in buckets of their key, so that joins need not move them.

A bucketed table is written once per refresh and joined many times: to resolve keys and to
check references. Its rows lie where a shuffle by the key would put them, so only the other
side is shuffled. The key that many rows of that side share is found beforehand by a sketch
of bounded size and joined by broadcast, since the stored side cannot be split for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys with more than one row in so many are joined apart; no more than twice as many can be.
HOT_SHARE = 200


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` under ``path`` in buckets of ``key``, one file each, as table ``table``."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )
    return spark.table(table)


def open_bucketed(spark: SparkSession, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """A table written in another session, made known to this one."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)


def hot_keys(df: DataFrame, key: Column, share: int = HOT_SHARE) -> list:
    """Keys that may hold more than one row in ``share``, from a sketch of fixed size.

    The sketch's counts are bounds from above, so no hot key is missed.
    """
    found = df.select(key.alias("_k")).where("_k IS NOT NULL").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(_k, {2 * share}, {64 * share})").alias("top")
    ).first()
    return [t["item"] for t in found.top or [] if t["count"] * share > found.n]


def join_stored(df: DataFrame, stored: DataFrame, key: Column, stored_key: str, columns: Sequence[str]) -> DataFrame:
    """``df`` with ``columns`` of the stored row of its key, NULL where there is none.

    Rows without a key meet nothing and are not shuffled; hot keys meet a broadcast of as
    many rows; the rest is shuffled to the stored buckets. Keys of the stored table are
    unique.
    """
    rows = df.withColumn("_key", key.cast(stored.schema[stored_key].dataType))
    right = stored.select(F.col(stored_key).alias("_key"), *columns)
    hot = hot_keys(rows, F.col("_key"))
    none = [F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in columns]
    without = rows.where("_key IS NULL").select("*", *none)
    few = F.col("_key").isin(hot) if hot else F.lit(False)
    usual = rows.where(F.col("_key").isNotNull() & ~few).join(right, "_key", "left")
    parts = usual.unionByName(without)
    if hot:
        parts = parts.unionByName(rows.where(few).join(F.broadcast(right.where(few)), "_key", "left"))
    return parts.drop("_key")


def orphans(child: DataFrame, column: str, stored: DataFrame, stored_key: str) -> DataFrame:
    """(total, orphans): distinct child keys, and those without a stored parent.

    Distinct keys come partially aggregated and land where the parents lie, so a key that
    many rows share is one row a task before anything moves.
    """
    kind = stored.schema[stored_key].dataType
    keys = child.where(F.col(column).isNotNull()).select(F.col(column).cast(kind).alias("_key")).distinct()
    known = stored.select(F.col(stored_key).alias("_key"), F.lit(True).alias("_known"))
    return keys.join(known, "_key", "left").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("_known").isNull()).alias("orphans")
    )
