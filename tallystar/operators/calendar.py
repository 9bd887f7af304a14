"""The two 15-minute time dimensions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.functions.keys import digits
from tallystar.functions.timestamps import as_wall_clock, floor_to_quarter
from tallystar.sources.rows import one_row

BUCKETS_PER_DAY = 96


def _quarters(bounds: DataFrame, start: Column, stop: Column) -> DataFrame:
    """One row per quarter hour from start to stop, both included."""
    step = F.expr("INTERVAL 15 MINUTES")
    return bounds.select(F.explode(F.sequence(start, stop, step)).alias("bucket"))


def _time_rows(quarters: DataFrame) -> DataFrame:
    start = F.col("bucket")
    day, clock = digits(start, 10), F.substring(digits(start, 16), 9, 4)
    return quarters.select(
        start.alias("time_bucket_start"),
        (start + F.expr("INTERVAL 15 MINUTES")).alias("time_bucket_end"),
        F.concat(day, F.lit("_"), clock).alias("time_key"),
    )


def dim_time(
    spark: SparkSession, start: datetime | str = "2025-01-01 00:00:00", days: int = 30
) -> DataFrame:
    """``days`` of 15-minute buckets, key ``yyyyMMdd_HHmm``."""
    first = as_wall_clock(start)
    last = first + F.expr(f"INTERVAL {15 * (days * BUCKETS_PER_DAY - 1)} MINUTES")
    return _time_rows(_quarters(one_row(spark), first, last))


def dim_time_spanning(events: DataFrame, ts: str = "event_ts") -> DataFrame:
    """The same table over the whole days the events cover."""
    bounds = events.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).where("lo IS NOT NULL")
    first = F.col("lo").cast("date").cast("timestamp_ntz")
    last = F.col("hi").cast("date").cast("timestamp_ntz") + F.expr("INTERVAL 1425 MINUTES")
    return _time_rows(_quarters(bounds, first, last))


def dim_time_calendar(anchors: DataFrame, anchor: str, days: int = 30) -> DataFrame:
    """Buckets of anchor +/- ``days`` with calendar parts, end included.

    ``anchors`` holds one row, whose ``anchor`` is the run's time.
    """
    around = F.expr(f"INTERVAL {days} DAYS")
    first = floor_to_quarter(F.col(anchor) - around)
    ts = F.col("bucket")
    return _quarters(anchors, first, F.col(anchor) + around).select(
        digits(ts, 16).alias("time_15min_sk"),
        ts.alias("bucket_start_ts"),
        F.substring(ts.cast("string"), 1, 10).alias("day"),
        F.hour(ts).alias("hour"),
        F.minute(ts).alias("minute"),
        (F.weekday(ts) + 1).alias("dow"),
        F.weekofyear(ts).alias("week"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
    )
