import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallystar.functions import (
    epoch_seconds,
    instant_to_wall_clock,
    normalize_ts,
    null_to_zero,
    parse_float,
    safe_float,
    surrogate_key,
    time_bucket_key,
    wall_clock_to_instant,
)
from tests.util import RUN_TS, at

NOW = at(RUN_TS)


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Kolkata"])
def zone(spark, request):
    """No result may depend on the session's time zone."""
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def evaluate(spark, kind, values, build):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in frame.orderBy("i").select(build(F.col("v"))).collect()]


FLOATS = [
    (None, 0.0),
    ("", 0.0),
    ("abc", 0.0),
    ("0x10", 0.0),
    ("0x1p3", 0.0),
    (" 1.5 ", 1.5),
    ("1e3", 1000.0),
    (".5", 0.5),
    ("5.", 5.0),
    ("-2", -2.0),
    ("inf", math.inf),
    ("-Infinity", -math.inf),
    ("1_000", 1000.0),
    ("1__0", 0.0),
    ("_1", 0.0),
    ("1d", 0.0),
    ("1f", 0.0),
    ("1.5F ", 0.0),
    ("1,5", 0.0),
    ("1 2", 0.0),
    ("true", 0.0),
]


def test_safe_float_edge_table(spark):
    got = evaluate(spark, "string", [v for v, _ in FLOATS], safe_float)
    assert got == [want for _, want in FLOATS]


def test_safe_float_nan_and_default(spark):
    assert all(math.isnan(v) for v in evaluate(spark, "string", ["nan", "NaN", "+nan"], safe_float))
    assert evaluate(spark, "string", [None, "x"], lambda c: safe_float(c, -1.0)) == [-1.0, -1.0]


def test_parse_float_matches_python(spark):
    texts = [v for v, _ in FLOATS if v is not None] + ["1e-3", "1E+2", "12345678901234567890", "\t7\n"]

    def python(text):
        try:
            return float(text)
        except ValueError:
            return None

    assert evaluate(spark, "string", texts, parse_float) == [python(t) for t in texts]


def test_null_to_zero(spark):
    got = evaluate(spark, "string", [None, "", "0", "2.5", "n/a"], null_to_zero)
    assert got == [0.0, 0.0, 0.0, 2.5, None]


TEXTS = [
    (None, NOW),
    ("soon", NOW),
    ("", NOW),
    ("2025-01-02 03:04:05", at("2025-01-02 03:04:05")),
    ("2025-01-02 03:04:05.987", at("2025-01-02 03:04:05")),
    ("2025-01-02 03:04:05+05:30", at("2025-01-02 03:04:05")),
    ("2025-01-02 03:04:05 and more", at("2025-01-02 03:04:05")),
    ("2025-01-02T03:04:05Z", at("2025-01-02 03:04:05")),
    ("2025-01-02T03:04:05+05:30", at("2025-01-02 03:04:05")),
    ("2025-01-02T03:04:05.999999Z", at("2025-01-02 03:04:05")),
    ("2025-01-02T03:04:05 and more", NOW),
    ("2025-01-02", at("2025-01-02 00:00:00")),
    ("2025-01-02 03:04", at("2025-01-02 03:04:00")),
    ("2025-03-09 02:30:00", at("2025-03-09 02:30:00")),  # a gap in New York
    ("2025-13-02 03:04:05", NOW),
    ("2025-02-30T03:04:05", NOW),
    ("20250101", NOW),
    ("2025", NOW),
    ("2025-01", NOW),
    ("1735689600", NOW),
]


def test_normalize_text(spark, zone):
    got = evaluate(spark, "string", [v for v, _ in TEXTS], lambda c: normalize_ts(c, RUN_TS))
    assert got == [want for _, want in TEXTS]


NUMBERS = [
    (None, NOW),
    (1735689600.0, at("2025-01-01 00:00:00")),
    (1735689600.9, at("2025-01-01 00:00:00")),
    (1735689600500.0, at("2025-01-01 00:00:00")),
    (1e12, NOW),  # seconds, past the last year
    (1e12 + 1000, at("2001-09-09 01:46:41")),
    (0.0, at("1970-01-01 00:00:00")),
    (-1.5, at("1969-12-31 23:59:58")),
    (float("nan"), NOW),
    (float("inf"), NOW),
    (1e300, NOW),
]


def test_normalize_numbers(spark, zone):
    got = evaluate(
        spark, "double", [v for v, _ in NUMBERS], lambda c: normalize_ts(c, RUN_TS, "number")
    )
    assert got == [want for _, want in NUMBERS]


def test_normalize_datetimes(spark, zone):
    gap = datetime(2025, 3, 9, 2, 30, 59, 999999)
    got = evaluate(
        spark, "timestamp_ntz", [None, gap], lambda c: normalize_ts(c, RUN_TS, "wall_clock")
    )
    assert got == [NOW, gap.replace(microsecond=0)]
    with pytest.raises(ValueError):
        normalize_ts(F.lit(1), RUN_TS, "calendar")


def test_instants_round_trip(spark, zone):
    values = [at("2025-03-09 02:30:00"), at("2025-11-02 01:30:00"), at("1969-12-31 23:59:59")]
    got = evaluate(
        spark, "timestamp_ntz", values, lambda c: instant_to_wall_clock(wall_clock_to_instant(c))
    )
    assert got == values
    assert evaluate(spark, "timestamp_ntz", values[2:], epoch_seconds) == [-1]


def test_keys(spark, zone):
    ts = [datetime(2025, 3, 9, 2, 44, 59, 5), at("2025-01-01 00:00:00"), None]
    assert evaluate(spark, "timestamp_ntz", ts, time_bucket_key) == [
        "202503090230",
        "202501010000",
        None,
    ]
    # SHA-1 of 'U1|2025-01-01 00:00:00'
    import hashlib

    want = hashlib.sha1(b"U1|2025-01-01 00:00:00").hexdigest()
    got = evaluate(spark, "timestamp_ntz", ts[1:], lambda c: surrogate_key(F.lit("U1"), c))
    assert got == [want, None]
