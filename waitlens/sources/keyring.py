"""Uniqueness of a key over all batches so far, without reading the history again.

The keys seen are stored once each, with the batch they came in first, in buckets of the key.
A batch's keys are counted, then compared with the buckets they fall into: keys handed out in
order touch the last buckets only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitlens.session import settle
from waitlens.sources.keyed import Bucket, KeyedTable


class Keyring:
    """All keys of a table seen so far. ``bucket`` is a rule on the key column."""

    def __init__(self, spark: SparkSession, path: str, key: str, bucket: Bucket):
        self.key = key
        self.table = KeyedTable(spark, path, [key], bucket)

    def add(self, batch: DataFrame, name: str) -> DataFrame:
        """Record a batch under its name; returns its repeated keys.

        One row (key, n, seen_in) per key that occurs more than once in the batch, or came
        in an earlier one, ``seen_in`` (else NULL). Missing keys are not judged. A batch
        that is added again under its name gets the same answer and changes nothing.
        """
        key = self.key
        counts = settle(batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")))
        if self.table.exists():
            met = self.table.near(counts).select(key, F.col("batch").alias("_before"))
            counts = settle(counts.join(met, key, "left"))
        else:
            counts = counts.withColumn("_before", F.lit(None).cast("string"))
        fresh = counts.where("_before IS NULL").select(key, F.lit(name).alias("batch"))
        # Fresh keys are one row each, and none of them is stored.
        self.table.merge(settle(fresh), [key], batch_id=name, unique=True)
        earlier = F.when(F.col("_before") != name, F.col("_before"))
        return counts.withColumn("seen_in", earlier).where("n > 1 OR seen_in IS NOT NULL").select(key, "n", "seen_in")
