"""High-water marks of batch runs, and the incremental load they drive."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar import schemas
from tallystar.functions.timestamps import as_wall_clock, normalize_ts
from tallystar.operators.dims import dim_upsert
from tallystar.sources.rows import one_row
from tallystar.sources.tables import EVENT_DATE, EVENT_SECOND, not_before

# Pipeline names and the mark of a pipeline that never ran.
LIVE_STREAM = "live_stream"
RAW_TO_SILVER = "raw_to_silver"
USER_HISTORY = "raw_to_user_history"  # not among the fixed ones
EPOCH = "1970-01-01 00:00:00"


def watermark_read(marks: DataFrame, pipeline: str = LIVE_STREAM) -> DataFrame:
    """One row: the pipeline's mark, or the epoch when it has none."""
    return marks.where(F.col("pipeline_name") == pipeline).agg(
        F.lit(pipeline).alias("pipeline_name"),
        F.coalesce(F.max("last_run_ts"), as_wall_clock(EPOCH)).alias("last_run_ts"),
    )


def watermark_write(
    marks: DataFrame, value: DataFrame, run_ts: datetime | str, kind: str = "wall_clock"
) -> DataFrame:
    """Replace the marks of the pipelines in ``value``; the other pipelines are kept."""
    clean = value.select(
        "pipeline_name", normalize_ts(F.col("last_run_ts"), run_ts, kind).alias("last_run_ts")
    )
    return dim_upsert(marks, clean, "pipeline_name")


def watermark_next(batch: DataFrame, pipeline: str = LIVE_STREAM) -> DataFrame:
    """The batch's highest event time as the pipeline's next mark."""
    return batch.agg(
        F.lit(pipeline).alias("pipeline_name"), F.max("event_ts").alias("last_run_ts")
    )


def watermark_init(spark, at: datetime | str = EPOCH, pipeline: str = LIVE_STREAM) -> DataFrame:
    """First mark of a pipeline: the epoch loads all history, the setup time none of it."""
    return one_row(spark).select(
        F.lit(pipeline).alias("pipeline_name"), as_wall_clock(at).alias("last_run_ts")
    )


def since(raw: DataFrame, mark: Column | datetime | str) -> DataFrame:
    """Rows strictly after the mark; a NULL event_ts never qualifies."""
    mark = as_wall_clock(mark)
    return not_before(raw, mark).where(F.col("event_ts") > mark)


def incremental_load(raw: DataFrame, mark, lateness: str | None = None) -> DataFrame:
    """New RAW rows since the mark, unordered: 25 columns, and those to prune by.

    ``lateness`` (an interval such as ``'10 minutes'``) reads that far behind the
    mark again; combine it with ``dedupe_by_key`` against the fact.
    """
    mark = as_wall_clock(mark)
    if lateness is not None:
        mark = mark - F.expr(f"INTERVAL {lateness}")
    pruning = [c for c in (EVENT_DATE, EVENT_SECOND) if c in raw.columns]
    return since(raw, mark).select(*schemas.RAW.names, *pruning)


def incremental_load_14col(raw: DataFrame, mark) -> DataFrame:
    """The same over the user-event shape; user_id becomes text."""
    return since(raw, mark).select(
        *[F.col(c).cast("string") if c == "user_id" else F.col(c) for c in schemas.RAW_USER.names]
    )
