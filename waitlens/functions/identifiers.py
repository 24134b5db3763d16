"""Identifier expressions: checksum classes, keyed hash, digit extraction, domains."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def digits_only(col: Column) -> Column:
    return F.regexp_replace(col, "[^0-9]", "")


def digits_to_bigint(col: Column) -> Column:
    """``'DX-0042'`` -> 42; text without digits -> NULL."""
    return F.nullif(digits_only(col), F.lit("")).cast("bigint")


def mod11_reason(col: Column, missing_reason: str | None = None) -> Column:
    """Why a ten-digit check number is unusable, or NULL when it is valid.

    A number is valid when its digits, weighted 10 down to 1, sum to a multiple of
    eleven. When the nine body digits alone leave remainder one, no single digit can
    complete them (``mod11_invalid``). A missing number counts as valid unless
    ``missing_reason`` names a reason for it.

    The text is parsed to a long once and its digits are taken by division, so the
    whole test is plain arithmetic in generated code. Compute it as a column: a
    projection shares the parsed number among its uses, a filter does not.
    """
    digits = digits_only(col)
    number = digits.try_cast("bigint")
    body = F.lit(0).cast("bigint")
    for power in range(9, 0, -1):
        body = body + _digit(number, power) * F.lit(power + 1)
    check = _digit(number, 0)
    reason = (
        F.when(F.length(digits) != 10, F.lit("invalid_format"))
        .when(body % 11 == 1, F.lit("mod11_invalid"))
        .when((body + check) % 11 != 0, F.lit("mod11_mismatch"))
    )
    if missing_reason is None:
        return reason
    return F.when(col.isNull(), F.lit(missing_reason)).otherwise(reason)


def _digit(number: Column, power: int) -> Column:
    """Decimal digit of ``number`` at ``10 ** power``."""
    return F.call_function("div", number, F.lit(10**power)) % 10


def hmac_sha256(col: Column, key: bytes) -> Column:
    """HMAC-SHA-256 (RFC 2104) of the text as 64 lowercase hex digits; NULL stays NULL.

    The two key pads are computed here, the two digests are the built-in ``sha2``.
    The pads are key material: see ``session.SETTINGS`` for how plan text hides them.
    """
    if not key:
        raise ValueError("the pseudonymisation key is empty")
    block = hashlib.sha256(key).digest() if len(key) > 64 else key
    block = block.ljust(64, b"\0")
    inner_pad = F.lit(bytes(b ^ 0x36 for b in block))
    outer_pad = F.lit(bytes(b ^ 0x5C for b in block))
    inner = F.unhex(F.sha2(F.concat(inner_pad, col.cast("string").cast("binary")), 256))
    return F.sha2(F.concat(outer_pad, inner), 256)


def packed(col: Column) -> Column:
    """Text as bytes, lowercase hex at half its length; no two texts give the same bytes.

    For keys that only travel and are compared: a shuffle cannot compress hex digits.
    """
    raw = F.unhex(col)
    return F.when(F.lower(F.hex(raw)) == col, F.concat(F.lit(b"\x01"), raw)).otherwise(
        F.concat(F.lit(b"\x00"), col.cast("binary"))
    )


def unpacked(col: Column) -> Column:
    """The text that ``packed`` made into bytes."""
    rest = F.substring(col, F.lit(2), F.length(col))
    return F.when(F.substring(col, F.lit(1), F.lit(1)) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(
        rest.cast("string")
    )


def in_domain(col: Column, allowed: Iterable[str], default: str) -> Column:
    """The value when allowed, else the default; NULL becomes the default."""
    return F.when(col.isin(*allowed), col).otherwise(F.lit(default))
