from __future__ import annotations

import hashlib
import hmac
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from waitlens.functions.identifiers import digits_to_bigint, hmac_sha256, in_domain, mod11_reason, packed, unpacked
from waitlens.functions.parsing import parse_as
from waitlens.functions.temporal import (
    hour_start,
    minutes_crossed,
    month_label,
    month_start,
    over_threshold,
    to_utc,
)


def values(spark, items, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, x {kind}")
    return [r.y for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


# Published check-number cases.
MOD11_CASES = {
    "9434765919": None,
    "1234567881": None,
    "1000000060": None,
    "9434765910": "mod11_mismatch",
    "1000000010": "mod11_invalid",
    "12345678901": "invalid_format",
    "": "invalid_format",
    "123 456 78": "invalid_format",
    "123456789A": "invalid_format",
    "123456789": "invalid_format",
    "943 476 5919": None,
    "99999999999999999999999": "invalid_format",
}


def test_mod11_vectors(spark):
    assert values(spark, list(MOD11_CASES), "string", mod11_reason) == list(MOD11_CASES.values())


def test_mod11_missing_number(spark):
    assert values(spark, [None], "string", mod11_reason) == [None]
    assert values(spark, [None], "string", lambda c: mod11_reason(c, "missing")) == ["missing"]


def test_mod11_agrees_with_a_plain_definition(spark):
    numbers = [f"{n * 7919 % 10**10:010d}" for n in range(4000)]

    def plain(text):
        expected = (11 - sum(int(d) * w for d, w in zip(text, range(10, 1, -1))) % 11) % 11
        if expected == 10:
            return "mod11_invalid"
        return None if expected == int(text[9]) else "mod11_mismatch"

    assert values(spark, numbers, "string", mod11_reason) == [plain(n) for n in numbers]


@pytest.mark.parametrize("size", [1, 32, 64, 65, 200])
def test_keyed_hash_equals_the_standard_library(spark, size):
    key = bytes((7 * i + 1) % 256 for i in range(size))
    items = ["9434765919", "1234567881", "5555555555", "", "é", None]
    want = [i if i is None else hmac.new(key, i.encode(), hashlib.sha256).hexdigest() for i in items]
    assert values(spark, items, "string", lambda c: hmac_sha256(c, key)) == want


def test_keyed_hash_needs_a_key():
    with pytest.raises(ValueError):
        hmac_sha256(F.lit("x"), b"")


def test_the_key_is_not_in_the_plan(spark):
    key = b"do not show this"
    df = spark.range(1).select(F.col("id").cast("string").alias("x")).select(hmac_sha256(F.col("x"), key))
    pads = [bytes(b ^ p for b in key.ljust(64, b"\0")).hex() for p in (0x36, 0x5C)]
    plan = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    flat = plan.replace(" ", "").lower()
    assert not any(p[:40] in flat for p in pads)


def test_digits_and_domain(spark):
    assert values(spark, ["DX-0042", "none", "", None], "string", digits_to_bigint) == [42, None, None, None]
    domain = lambda c: in_domain(c, ["M", "F"], "U")
    assert values(spark, ["M", "x", None], "string", domain) == ["M", "U", "U"]


def test_minutes_are_boundaries(spark):
    pairs = [
        ("2024-01-01 00:00:59", "2024-01-01 00:01:00", 1),
        ("2024-01-01 00:00:00", "2024-01-01 00:00:59", 0),
        ("2024-01-01 00:01:00", "2024-01-01 00:00:59", -1),
        ("1969-12-31 23:59:30", "1970-01-01 00:00:10", 1),
        ("2024-01-01 00:00:00", None, None),
    ]
    df = spark.createDataFrame(pairs, "a string, b string, want int")
    rows = df.select(
        "want", minutes_crossed(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")).alias("got")
    ).collect()
    assert all(r.got == r.want for r in rows)


def test_local_time_to_utc(spark):
    cases = {
        "2024-01-15 12:00:00": datetime(2024, 1, 15, 12),
        "2024-07-15 12:00:00": datetime(2024, 7, 15, 11),
        "2024-07-01 00:00:00": datetime(2024, 6, 30, 23),
        "2024-03-31 01:30:00": datetime(2024, 3, 31, 1, 30),
        "2024-10-27 01:30:00": datetime(2024, 10, 27, 0, 30),
    }
    got = values(spark, list(cases), "string", lambda c: to_utc(c.cast("timestamp_ntz")))
    assert got == list(cases.values())


def test_times_do_not_depend_on_the_session_zone(spark):
    text = ["2024-03-31 02:30:00", "2024-07-01 00:00:00"]
    before = spark.conf.get("spark.sql.session.timeZone")
    results = []
    for zone in ("UTC", "Europe/Berlin", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        results.append(
            values(
                spark, text, "string",
                lambda c: F.struct(
                    to_utc(c.cast("timestamp_ntz")).cast("string"),
                    month_start(c.cast("timestamp_ntz")),
                    hour_start(c.cast("timestamp_ntz")).cast("string"),
                ),
            )
        )
    spark.conf.set("spark.sql.session.timeZone", before)
    assert results[0] == results[1] == results[2]


def test_month_labels_and_thresholds(spark):
    assert values(spark, ["2024-03-01", "March", None], "string", month_label) == ["2024-03", "March", None]
    over = lambda c: over_threshold(c, 240)
    assert values(spark, [239, 240, 241, None], "int", over) == [False, False, True, False]


def test_permissive_parsing(spark):
    permissive = lambda kind: (lambda c: parse_as(c, kind))
    assert values(spark, ["7", "7.0", "7.5", "x", "", None], "string", permissive("int64")) == [
        7, 7, None, None, None, None,
    ]
    words = ["True", "true", "1", "False", "false", "0", "yes", None]
    assert values(spark, words, "string", permissive("bool")) == [True] * 3 + [False] * 3 + [None] * 2
    assert values(spark, ["2024-02-30", "2024-02-29"], "string", permissive("date")) == [None, date(2024, 2, 29)]
    assert values(spark, ["nan", None], "string", permissive("str")) == ["nan", None]


def test_strict_parsing_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, ["soon"], "string", lambda c: parse_as(c, "date", "strict"))


def test_packed_text_is_read_back_and_differs_where_texts_differ(spark):
    texts = ["ab" * 32, "AB" * 32, "61616161", "aaaa", "\u0001", "abc", "0abc", "", "p1", "é€", "00", "\x00", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", packed(F.col("t")).alias("p")).select("*", unpacked(F.col("p")).alias("back")).collect()
    assert all(r.back == r.t for r in rows)
    assert len({bytes(r.p) for r in rows if r.p is not None}) == len(texts) - 1
    assert len(rows[0].p) == 33
