"""Fact measures: first matching event, milestones, stage times, status flags, quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitlens.functions.temporal import (
    days_between,
    epoch_micros,
    from_epoch,
    minutes_crossed,
    over_threshold,
)


def first_match(
    requests: DataFrame,
    events: DataFrame,
    key: str,
    request_day: str,
    event_at: str,
    reported_gap: str,
    slack: int = 7,
) -> DataFrame:
    """Earliest event per request whose day gap lies in ``[reported_gap, reported_gap + slack]``.

    Adds ``matched_at`` and ``matched_gap`` (NULL without a match; among events at the
    same instant the smallest reported gap wins).

    Joining on the key and filtering the gap would pair every request of a busy key with
    every event of it. Turned around, one event can only answer requests made on
    ``slack + 1`` known days, the last of which is its own day less its reported gap. Events
    are shuffled once, by key and block of days, and reduced there to the earliest per last
    day. The join by key and block has at most one partner per request: the few candidates
    of the block, of which the request picks the earliest that fits its day. An event whose
    days cross into the next block is listed in both, one in some seventy. Blocks are long, so
    that events of a key that lie together go to the same task and its text is compressed.

    Requests without a key or day cannot match; they are scattered by their other columns,
    so they do not meet in one task. A busy key is spread over its blocks.

    For one instant the latest last day is the smallest gap, so the candidates order by
    instant and by last day descending; the gap follows from both.
    """
    span = 64 * (slack + 1)
    block = lambda day: F.floor(day / F.lit(span))
    day_number = lambda c: F.unix_date(c.cast("date")).cast("bigint")
    last = F.col("_last")
    candidates = (
        events.where(
            F.col(key).isNotNull() & F.col(event_at).isNotNull() & F.col(reported_gap).isNotNull()
        )
        .select(
            F.col(key).alias("_key"),
            epoch_micros(F.col(event_at)).alias("_micros"),
            (day_number(F.col(event_at)) - F.col(reported_gap).cast("int")).alias("_last"),
        )
        .select("*", F.explode(F.sequence(block(last - slack), block(last))).alias("_dayblock"))
        .repartition("_key", "_dayblock")
        .groupBy("_key", "_dayblock", "_last")
        .agg(F.min("_micros").alias("_micros"))
        .groupBy("_key", "_dayblock")
        .agg(F.collect_list(F.struct(F.col("_micros"), (-last).alias("_before"))).alias("_offers"))
    )
    # A request that cannot match has a hash in place of its block.
    loose = [F.col(c) for c in requests.columns if c != key]
    asked_on = day_number(F.col(request_day))
    can_match = F.col(key).isNotNull() & F.col(request_day).isNotNull()
    asked = requests.withColumn("_scatter", F.when(can_match, block(asked_on)).otherwise(F.xxhash64(*loose)))
    on = (asked[key] == candidates["_key"]) & (asked["_scatter"] == candidates["_dayblock"])
    fits = lambda offer: (-offer["_before"]).between(asked_on, asked_on + slack)
    joined = asked.join(candidates, on, "left").withColumn("_best", F.array_min(F.filter("_offers", fits)))
    matched_at = from_epoch("MICROSECOND", F.col("_best._micros"))
    return joined.select(
        *requests.columns,
        matched_at.alias("matched_at"),
        (day_number(matched_at) + F.col("_best._before")).cast("int").alias("matched_gap"),
    )


def milestones(df: DataFrame, key: str, required: str, firsts: dict[str, str]) -> DataFrame:
    """Earliest value of several columns per key; rows without ``required`` do not count."""
    return (
        df.where(F.col(required).isNotNull())
        .groupBy(key)
        .agg(*[F.min(c).alias(name) for name, c in firsts.items()])
    )


def interval_breach(df: DataFrame, start: str, end: str, limit: int, wait: str, flag: str) -> DataFrame:
    """Day interval and whether it exceeds the limit."""
    return df.withColumn(wait, days_between(F.col(start), F.col(end))).withColumn(
        flag, over_threshold(F.col(wait), limit)
    )


def stage_minutes(df: DataFrame, start: str, stages: dict[str, str]) -> DataFrame:
    """Minutes from ``start`` to each stage column, named by the mapping's keys."""
    return df.select(
        "*", *[minutes_crossed(F.col(start), F.col(end)).alias(name) for name, end in stages.items()]
    )


def status_flag(col: Column, *values: str, ignore_case: bool = False) -> Column:
    """Never-NULL membership flag."""
    return F.coalesce((F.lower(col) if ignore_case else col).isin(*values), F.lit(False))


def contains_flag(col: Column, fragment: str) -> Column:
    """Never-NULL, case-sensitive substring flag."""
    return F.coalesce(col.contains(fragment), F.lit(False))


def share(flag: Column) -> Column:
    """Fraction of rows where the flag holds, as a double."""
    return F.avg(F.when(flag, F.lit(1.0)).otherwise(F.lit(0.0)))


def quantiles(
    df: DataFrame, groups: Sequence[str | Column], value: str, points: dict[str, float], weight: Column | None = None
) -> DataFrame:
    """Exact continuous quantiles per group; a row counts ``weight`` times.

    The rows are first reduced to one count per (group, value), before the shuffle as far
    as possible; the quantiles are then read from those counts. The working set is the
    number of distinct values of a group, never its number of rows.
    """
    names = [f"_g{i}" for i in range(len(groups))]
    columns = [F.col(g) if isinstance(g, str) else g for g in groups]
    labels = df.select(*columns).columns
    counts = (
        df.select(
            *[c.alias(n) for c, n in zip(columns, names)], F.col(value).alias("_v"), (F.lit(1) if weight is None else weight).alias("_w")
        )
        .groupBy(*names, "_v")
        .agg(F.sum("_w").alias("_n"))
    )
    result = counts.groupBy(*names).agg(
        *[F.percentile("_v", F.lit(p), F.col("_n")).alias(name) for name, p in points.items()]
    )
    return result.select(*[F.col(n).alias(l) for n, l in zip(names, labels)], *points)
