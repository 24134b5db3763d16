"""Casts from delivered text: permissive (bad value -> NULL) or strict (bad value fails)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words a boolean may arrive as.
TRUE_WORDS = ("True", "true", "1")
FALSE_WORDS = ("False", "false", "0")


def parse_boolean(col: Column) -> Column:
    text = col.cast("string")
    return F.when(text.isin(*TRUE_WORDS), True).when(text.isin(*FALSE_WORDS), False)


def parse_whole_number(col: Column) -> Column:
    """Whole numbers, also when written ``7.0``; anything else -> NULL.

    The text decides: a fraction counts however small it is, so nothing is rounded.
    """
    text = F.trim(col.cast("string"))
    return F.when(text.rlike(r"^[+-]?[0-9]+(\.0*)?$"), F.substring_index(text, ".", 1)).try_cast("bigint")


def parse_as(col: Column, kind: str, mode: str = "permissive") -> Column:
    """Cast to ``timestamp``, ``date``, ``int64``, ``bool`` or ``str``."""
    if mode not in ("permissive", "strict"):
        raise ValueError(f"unknown mode: {mode!r}")
    targets = {
        "timestamp": "timestamp_ntz",
        "date": "date",
        "int64": "bigint",
        "bool": "boolean",
        "str": "string",
    }
    if kind not in targets:
        raise ValueError(f"unknown kind: {kind!r}")
    if mode == "strict":
        return col.cast(targets[kind])
    if kind == "bool":
        return parse_boolean(col)
    if kind == "int64":
        return parse_whole_number(col)
    if kind == "str":
        return col.cast("string")
    if kind == "date":
        return col.cast("string").try_cast("timestamp_ntz").cast("date")
    return col.cast("string").try_cast("timestamp_ntz")
