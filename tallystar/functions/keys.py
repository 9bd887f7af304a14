"""Key builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallystar.functions.timestamps import floor_to_quarter, truncate_to_second


def surrogate_key(natural_key: Column, effective_from: Column) -> Column:
    """SHA-1 hex of ``key|yyyy-MM-dd HH:mm:ss``; a NULL part gives a NULL key."""
    second = truncate_to_second(effective_from)
    return F.sha1(F.concat(natural_key, F.lit("|"), second.cast("string")))


def digits(ts: Column, length: int) -> Column:
    """Leading ``length`` characters of the wall clock text, digits only."""
    return F.translate(F.substring(ts.cast("string"), 1, length), "-: ", "")


def time_bucket_key(ts: Column) -> Column:
    """15-minute bucket of a wall clock as ``yyyyMMddHHmm``."""
    return digits(floor_to_quarter(ts), 16)
