"""Conforming operators: increments, latest-per-key, quarantine, key resolution, upsert."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitlens.session import settle


class DuplicateKeyError(ValueError):
    """An upsert batch holds the same key more than once."""


class MissingKeyError(ValueError):
    """An upsert batch holds a row without a key."""


def high_water_mark(target: DataFrame | None, col: str = "_ingest_date") -> date | None:
    """Largest loaded partition date; None for a missing or an empty target."""
    return None if target is None else target.agg(F.max(col)).first()[0]


def increment(
    source: DataFrame,
    mark: date | None,
    col: str = "ingest_date",
    lookback_days: int = 0,
) -> DataFrame:
    """Source rows newer than the mark.

    The mark enters the plan as a literal, so the scan skips whole partitions.
    ``lookback_days`` re-reads recent partitions for late arrivals; the strict default
    reads only later dates. Without a mark everything is new.
    """
    if mark is None:
        return source
    return source.where(F.col(col) > F.lit(mark - timedelta(days=lookback_days)))


def new_partitions(
    available: Iterable[date], loaded: Iterable[date], lookback_days: int = 0
) -> list[date]:
    """Landed partitions not loaded yet, however late they landed, oldest first.

    ``lookback_days`` adds loaded ones of that many days before the newest loaded, for
    partitions that were landed again.
    """
    done = set(loaded)
    since = max(done) - timedelta(days=lookback_days) if done and lookback_days else None
    return sorted(d for d in set(available) if d not in done or (since is not None and d > since))


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tiebreak: Sequence[str],
) -> DataFrame:
    """One row per key: the highest ``order_by``, then the highest ``tiebreak``.

    NULL sorts as the highest value. ``row_number() = 1`` is a pattern the optimizer
    knows: each map task keeps one row per key before the shuffle (WindowGroupLimit),
    so a key with a third of all rows does not reach one task whole.
    """
    if not tiebreak:
        raise ValueError("name tiebreak columns, or the surviving row is arbitrary")
    order = [F.col(c).desc_nulls_first() for c in (*order_by, *tiebreak)]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def split_by_reason(df: DataFrame, reason: str) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) halves of a classified frame.

    The frame is settled first: both halves read it, and a filter on a settled column
    does not evaluate the classification again.
    """
    settled = settle(df)
    return settled.where(F.col(reason).isNull()), settled.where(F.col(reason).isNotNull())


def latest_valid(
    df: DataFrame, reason: str, keys: Sequence[str], order_by: Sequence[str], tiebreak: Sequence[str]
) -> DataFrame:
    """Drop rejected rows, then keep the latest per key: an older valid row survives.

    Said the other way round: valid rows rank above rejected ones, and a key whose first
    row is rejected has no valid row. That keeps the reason out of a filter below the
    window, where the optimizer would inline its long expression once per use.
    """
    ranked = df.withColumn("_valid", F.col(reason).isNull().cast("int"))
    best = dedup_latest(ranked, keys, ["_valid", *order_by], tiebreak)
    return best.where("_valid = 1").drop(reason, "_valid")


def latest_rejected(
    df: DataFrame, reason: str, keys: Sequence[str], order_by: Sequence[str], tiebreak: Sequence[str]
) -> DataFrame:
    """Keep the latest per key, then the rejected ones: what is wrong with a key *now*."""
    return dedup_latest(df, keys, order_by, tiebreak).where(F.col(reason).isNotNull())


def left_join_on(
    left: DataFrame,
    right: DataFrame,
    left_key: Column,
    right_key: str,
    spread_by: Sequence[str],
) -> DataFrame:
    """Left equi-join that never sends all NULL keys to one task.

    Rows without a key cannot match, yet hash alike. A second join key scatters them by
    ``spread_by``; rows with a key keep it constant, so they still meet their match. A
    hot non-NULL key is left to the adaptive skew join. The right key is dropped.

    The right side's constant is computed from its key, because the optimizer would move a
    literal out of the join keys and hash by the first key alone.
    """
    scatter = F.when(left_key.isNull(), F.xxhash64(*spread_by)).otherwise(F.lit(0).cast("bigint"))
    keyed_left = left.withColumn("_key", left_key).withColumn("_scatter", scatter)
    keyed_right = right.withColumnRenamed(right_key, "_key").withColumn(
        "_scatter", F.pmod(F.xxhash64("_key"), F.lit(1).cast("bigint"))
    )
    return keyed_left.join(keyed_right, ["_key", "_scatter"], "left").drop("_key", "_scatter")


def resolve_key(
    df: DataFrame,
    vault: DataFrame,
    source_id: Column,
    spread_by: Sequence[str],
    vault_id: str = "patient_id",
    surrogate: str = "patient_sk",
) -> DataFrame:
    """Attach the surrogate of ``source_id``; unmatched rows keep NULL. Drops the raw id."""
    keys = vault.select(F.col(vault_id).alias("_vault_id"), surrogate)
    return left_join_on(df, keys, source_id, "_vault_id", spread_by).drop(vault_id)


def lookup(df: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Left-join a reference table on a shared column name."""
    return df.join(reference, key, "left")


def with_audit(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Carry the partition date as ``_ingest_date`` and stamp ``_loaded_at``."""
    stamp = F.current_timestamp() if as_of is None else as_of
    return df.withColumnRenamed("ingest_date", "_ingest_date").withColumn("_loaded_at", stamp)


def sync_schema(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The target with the batch's columns: new ones NULL, vanished ones dropped."""
    types = {f.name: f.dataType for f in batch.schema}
    present = set(target.columns)
    return target.select(
        *[
            (F.col(c) if c in present else F.lit(None)).cast(types[c]).alias(c)
            for c in batch.columns
        ]
    )


def require_unique(df: DataFrame, keys: Sequence[str], known: bool = False) -> None:
    """Raise when a key is missing or repeats. Looks at one offending key only.

    ``known``: the keys are unique by the way the frame was made, so no shuffle is spent on
    that and only missing ones are looked for.
    """
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    if not df.where(missing).isEmpty():
        raise MissingKeyError(f"a row has no key {tuple(keys)}")
    clash = [] if known else df.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if clash:
        raise DuplicateKeyError(f"key {tuple(keys)} repeats, for instance {clash[0].asDict()}")


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows replace target rows of the same key; everything else stays."""
    kept = sync_schema(target.join(batch.select(*keys), list(keys), "left_anti"), batch)
    return kept.unionByName(batch)


def pick(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep exactly the named columns: the contract of what may leave a layer."""
    return df.select(*columns)
