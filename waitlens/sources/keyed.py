"""Tables merged by key: Parquet partitions of key buckets, of which a batch rewrites few.

A table is a folder of partitions ``_bucket=3``. A merge joins the partitions its batch
falls into with the batch and puts them back by dynamic partition overwrite; the others are
not read. Whole numbers and ids with a running number make good buckets by range (new rows
touch the last ones), other keys by hash. The rule is chosen with the first batch and
written beside the partitions, since a key must go on to the bucket its old row is in.

The merged partitions are written aside first. An overwrite that a driver's death cut short
is repeated from there by the next merge, whatever was already replaced, and the batch is
then recorded as loaded; so a batch that is replayed under its number changes nothing. One
writer at a time; readers come between merges.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waitlens.functions.identifiers import digits_only
from waitlens.operators.conform import dedup_latest, require_unique, sync_schema, upsert
from waitlens.sources.files import create_text, delete, exists, files, read_text, subfolders

#: Rows of a bucket aimed at when the first batch chooses the bucket size.
BUCKET_ROWS = 5_000_000
#: A partition without rows: its file holds the schema of a table that is empty otherwise.
NO_ROWS = -2
#: Where a batch without a number is written aside.
NAMELESS = "_nameless"


@dataclass(frozen=True)
class Bucket:
    """A rule from key to bucket number. Size 0: the first batch chooses it."""

    kind: str = "whole"
    key: str = ""
    size: int = 0

    def _number(self) -> Column:
        if self.kind == "digits":
            return digits_only(F.col(self.key)).try_cast("bigint")
        return F.col(self.key).cast("bigint")

    def column(self) -> Column:
        if self.kind == "whole":
            return F.lit(0).cast("bigint")
        if self.kind == "hash":
            return F.pmod(F.xxhash64(self.key), F.lit(self.size)).cast("bigint")
        return F.coalesce(F.floor(self._number() / self.size), F.lit(-1)).cast("bigint")

    def sized_for(self, df: DataFrame) -> Bucket:
        """The rule with a size for these rows."""
        if self.size or self.kind == "whole":
            return self
        if self.kind == "hash":
            return replace(self, size=max(1, math.ceil(df.count() / BUCKET_ROWS)))
        rows, low, high = df.agg(F.count("*"), F.min(self._number()), F.max(self._number())).first()
        span = 1 if low is None else high - low + 1
        return replace(self, size=max(1, math.ceil(span / max(1, math.ceil(rows / BUCKET_ROWS)))))


def range_bucket(key: str, width: int = 0) -> Bucket:
    """Ranges of a whole-number key."""
    return Bucket("range", key, width)


def digits_bucket(key: str, width: int = 0) -> Bucket:
    """Ranges of the running number in a text key such as ``A000123``."""
    return Bucket("digits", key, width)


def hash_bucket(key: str, count: int = 0) -> Bucket:
    return Bucket("hash", key, count)


class KeyedTable:
    def __init__(
        self, spark: SparkSession, path: str, sort_by: Sequence[str] = (), bucket: Bucket | None = None
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.sort_by = tuple(sort_by)
        self.bucket = bucket or Bucket()

    def exists(self) -> bool:
        return exists(self.spark, f"{self.path}/_rule.json")

    def rule(self) -> Bucket:
        """The stored bucket rule, or the one a first batch would start from.

        A stored size stands whatever size was asked for; another key or kind is refused.
        """
        if not self.exists():
            return self.bucket
        stored = Bucket(**json.loads(read_text(self.spark, f"{self.path}/_rule.json")))
        asked = self.bucket
        if asked.kind != "whole" and (asked.kind, asked.key) != (stored.kind, stored.key):
            raise ValueError(f"{self.path} is bucketed by {stored}, not {asked}")
        return stored

    def read(self) -> DataFrame | None:
        """All rows; None before the first batch."""
        return self._rows().drop("_bucket") if self.exists() else None

    def _rows(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def near(self, batch: DataFrame) -> DataFrame:
        """Stored rows of the partitions a batch falls into, with ``_bucket``; no other is read."""
        # As many numbers as buckets at most: rows of the table by BUCKET_ROWS.
        touched = [r[0] for r in batch.select(self.rule().column().alias("b")).distinct().collect()]
        return self._rows().where(F.col("_bucket").isin(touched))

    def loaded(self) -> list[str]:
        """Names of the batches and source partitions recorded as loaded."""
        return files(self.spark, f"{self.path}/_loaded")

    def record(self, names: Iterable[str]) -> None:
        for name in names:
            create_text(self.spark, f"{self.path}/_loaded/{name}", "")

    def merge(
        self,
        batch: DataFrame,
        keys: Sequence[str],
        order_by: Sequence[str] = (),
        tiebreak: Sequence[str] = (),
        batch_id: str | None = None,
        unique: bool = False,
    ) -> bool:
        """Merge a batch by key; False if this ``batch_id`` was merged before.

        With ``order_by`` the newest of the stored row and the batch's rows stays, so it
        does not matter in which order batches come. Without it the batch's row replaces
        the stored one; its keys must then be unique, and ``unique`` says that they are so
        by the way the batch was made, which spares the check. No key may be NULL.
        Partitions without batch rows stay in the files they are in, unless the batch has
        other columns or types than the table: then all are rewritten in its form.
        """
        self._finish_interrupted()
        if batch_id is not None and batch_id in self.loaded():
            return False
        require_unique(batch, keys, known=unique or bool(order_by))
        if not self.exists():
            rule = self.bucket.sized_for(batch)
            self._shape_like(batch)
            create_text(self.spark, f"{self.path}/_rule.json", json.dumps(asdict(rule)))
        rule = self.rule()
        old = self._rows()
        if _types(old) == _types(batch):
            old = self.near(batch)
        rows = _newest(sync_schema(old.drop("_bucket"), batch), batch, keys, order_by, tiebreak)
        rows = rows.withColumn("_bucket", rule.column()).hint("rebalance", "_bucket")
        aside = f"{self.path}/_staged/{batch_id or NAMELESS}"
        (
            rows.sortWithinPartitions("_bucket", *self.sort_by)
            .write.mode("overwrite")
            # A static overwrite marks its end by a file, which a dynamic one does not.
            .option("partitionOverwriteMode", "static")
            .partitionBy("_bucket")
            .parquet(aside)
        )
        self._put(aside)
        if batch_id is not None:
            self.record([batch_id])
        delete(self.spark, aside)
        return True

    def _shape_like(self, df: DataFrame) -> None:
        df.limit(0).write.mode("overwrite").parquet(f"{self.path}/_bucket={NO_ROWS}")

    def _put(self, aside: str) -> None:
        """Replace the partitions that were written aside, and no other."""
        if not any(n.startswith("_bucket=") for n in subfolders(self.spark, aside)):
            return
        rows = self.spark.read.parquet(aside)
        if _types(rows) != _types(self._rows()):
            self._shape_like(rows.drop("_bucket"))
        (
            rows.sortWithinPartitions("_bucket", *self.sort_by)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("_bucket")
            .parquet(self.path)
        )

    def _finish_interrupted(self) -> None:
        """Repeat an overwrite that was cut short; what was not even written aside goes."""
        for name in subfolders(self.spark, f"{self.path}/_staged"):
            aside = f"{self.path}/_staged/{name}"
            if exists(self.spark, f"{aside}/_SUCCESS"):
                self._put(aside)
                if name != NAMELESS:
                    self.record([name])
            delete(self.spark, aside)


def _types(df: DataFrame) -> dict:
    return {f.name: f.dataType for f in df.schema if f.name != "_bucket"}


def _newest(
    old: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str], tiebreak: Sequence[str]
) -> DataFrame:
    """The rows that stay of both; of rows that tie the batch's does."""
    if not order_by:
        return upsert(old, batch, keys)
    both = old.withColumn("_side", F.lit(0)).unionByName(batch.withColumn("_side", F.lit(1)))
    return dedup_latest(both, keys, order_by, [*tiebreak, "_side"]).drop("_side")
