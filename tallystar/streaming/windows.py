"""Event-time jobs over RAW-like streams.

Event-time watermarks take zoned timestamps only, so the wall clock is lifted to
its UTC instant for the stateful operator and put back afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.functions.timestamps import instant_to_wall_clock, wall_clock_to_instant

INSTANT = "_instant"


def _watermarked(events: DataFrame, delay: str) -> DataFrame:
    return events.withColumn(INSTANT, wall_clock_to_instant(F.col("event_ts"))).withWatermark(
        INSTANT, delay
    )


def stream_dedupe(events: DataFrame, delay: str = "1 hour", key: str = "event_id") -> DataFrame:
    """The first copy of each non-NULL key that is not too late; a later copy within ``delay`` is dropped.

    All copies of a key meet in one state partition.  Nothing is dropped before the
    stateful operator: which copy of a key is too late is known there only.
    """
    keyed = events.where(F.col(key).isNotNull())
    return _watermarked(keyed, delay).dropDuplicatesWithinWatermark([key]).drop(INSTANT)


def stream_watch_15min(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Events and watch time per 15-minute window; a window closes past ``delay``."""
    return (
        _watermarked(events, delay)
        .groupBy(F.window(INSTANT, "15 minutes").alias("w"))
        .agg(F.count("*").alias("events"), F.round(F.sum("watch_time"), 2).alias("watch_time"))
        .select(
            instant_to_wall_clock(F.col("w.start")).alias("time_bucket_start"),
            "events",
            "watch_time",
        )
    )
