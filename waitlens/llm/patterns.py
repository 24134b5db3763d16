"""Where a pattern matches, in DataFrame expressions: Spark's functions return texts, not places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def matches(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches, as strings."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def gaps(text: Column, pattern: str) -> Column:
    """What stands before, between and after the matches: one string more than matches."""
    return F.split(text, pattern, -1)


def gap_lengths(text: Column, pattern: str) -> Column:
    return F.transform(gaps(text, pattern), lambda g: F.length(g).cast("long"))


def located(hits: DataFrame, row: str, kind: str, lengths: str, found: str, carry: list[str]) -> DataFrame:
    """(row, kind, start, end, value, carried columns): code points from 0, end exclusive.

    ``lengths`` and ``found`` are the arrays of the functions above. A running sum over the
    matches of one text places them, so the work is linear in their number.
    """
    pairs = F.arrays_zip(F.col(lengths).alias("_gap"), F.col(found).alias("_value"))
    rows = hits.select(row, kind, *carry, F.posexplode(pairs).alias("_pos", "_pair")).select(
        row, kind, *carry, "_pos", F.col("_pair._gap").alias("_gap"), F.col("_pair._value").alias("value")
    )
    length = F.length("value").cast("long")
    order = Window.partitionBy(row, kind).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("_gap") + length).over(order)
    # The last gap has no match after it.
    return rows.where("value IS NOT NULL").withColumn("end", end).select(
        row, kind, *carry, (F.col("end") - length).alias("start"), "end", "value"
    )
