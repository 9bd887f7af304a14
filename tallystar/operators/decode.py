"""Message payload -> typed rows, with every rejected message kept.

A payload ends in exactly one of three states:

``ok``          a JSON object; goes to RAW
``error``       a JSON object whose event_ts is present but is not a timestamp
``quarantine``  not a JSON object at all
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tallystar import schemas
from tallystar.functions.numbers import parse_float
from tallystar.functions.timestamps import as_wall_clock, event_time, instant_to_wall_clock

# Field of the element that follows a whole payload.
END = "_end_of_payload"
OK, ERROR, QUARANTINE = "ok", "error", "quarantine"

# The metric row written for a rejected event.
STREAM_ERROR_METRIC = "stream_insert_error"
STREAM_ERROR_FORMULA = "safe_float(None) → default"


def json_decode(messages: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Decode ``value`` (text or binary) into ``data``, a struct of ``schema``.

    ``reason`` is NULL for a decoded object and says what is wrong otherwise.
    The payload is parsed as the first of two elements of an array.  Only a payload
    that ends with its object lets the parser reach the second one, so trailing
    text is malformed instead of silently ignored.
    """
    text = F.col(value).cast("string")
    options = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}
    marked = StructType(schema.fields + [StructField(END, StringType())])
    closed = F.concat(F.lit("["), text, F.lit(f',{{"{END}":"1"}}]'))
    wrapped = F.from_json(closed, ArrayType(marked), options)
    # A filter on ``data`` cannot move below the generator, so it never makes
    # Spark parse the payload once more.
    whole = (F.size("_parsed") == 2) & (F.get("_parsed", F.lit(1))[END] == "1")
    only = F.when(whole, F.slice("_parsed", 1, 1))
    fields = F.struct(*[F.col("data")[f].alias(f) for f in schema.names])
    return (
        messages.withColumn("_parsed", wrapped)
        .select(*messages.columns, F.explode_outer(only).alias("data"))
        .withColumn("data", F.when(F.col("data").isNotNull(), fields))
        .withColumn(
            "reason",
            F.when(F.col(value).isNull(), "null payload")
            .when(~F.is_valid_utf8(text), "not utf-8")
            .when(F.col("data").isNotNull(), F.lit(None).cast("string"))
            .when(F.ltrim(text).startswith("{"), "malformed json")
            .when(F.try_parse_json(text).isNotNull(), "not a json object")
            .otherwise("not json"),
        )
    )


def decoded(messages: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """The well-formed rows only, one column per field of ``schema``."""
    return json_decode(messages, schema, value).where(F.col("reason").isNull()).select("data.*")


def quarantine(messages: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """The payloads that are no JSON object, with the reason."""
    return (
        json_decode(messages, schema, value)
        .where(F.col("reason").isNotNull())
        .select(F.col(value).cast("string").alias("value"), "reason")
    )


def measure(name: str) -> Column:
    """A measure decoded as text -> double; bare NaN/Infinity arrive in quotes."""
    text = F.col(name)
    bare = F.when(
        text.isin('"NaN"', '"Infinity"', '"-Infinity"'),
        F.translate(text, '"', "").try_cast("double"),
    )
    return F.coalesce(parse_float(text), bare, F.lit(0.0))


def ingest_stamp(at: datetime | str | Column | None = None) -> Column:
    """The ingestion time: ``at`` when given, else now, in UTC at second precision."""
    return instant_to_wall_clock(F.current_timestamp()) if at is None else as_wall_clock(at)


def classify(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add ``status`` and the parsed ``_event_ts`` to decoded organisation events."""
    event_ts = F.col("data.event_ts")
    return (
        json_decode(messages, schemas.EVENT_TEXT, value)
        .withColumn("_event_ts", event_time(event_ts))
        .withColumn(
            "status",
            F.when(F.col("reason").isNotNull(), QUARANTINE)
            .when(event_ts.isNotNull() & F.col("_event_ts").isNull(), ERROR)
            .otherwise(OK),
        )
    )


def outcome(messages: DataFrame, value: str = "value") -> DataFrame:
    """``classify`` with what its outputs need, to be kept: the text of a decoded payload is not held beside its fields."""
    refused = F.when(F.col("status") == QUARANTINE, F.col(value).cast("string")).alias(value)
    return classify(messages, value).select(refused, "data", "reason", "_event_ts", "status")


def raw_rows(classified: DataFrame, ingested_at=None) -> DataFrame:
    """Accepted messages as RAW rows."""
    measures = {"watch_time", "lat", "lon"}
    columns = []
    for field in schemas.RAW.names:
        if field == "event_ts":
            column = F.col("_event_ts")
        elif field == "ingestion_ts":
            column = ingest_stamp(ingested_at)
        elif field in measures:
            column = measure(f"data.{field}")
        else:
            column = F.col(f"data.{field}")
        columns.append(column.alias(field))
    return classified.where(F.col("status") == OK).select(*columns)


def stream_errors(classified: DataFrame) -> DataFrame:
    """One metric row per event whose timestamp the table would refuse."""
    return classified.where(F.col("status") == ERROR).select(
        F.lit(STREAM_ERROR_METRIC).alias("metric_name"),
        F.lit(STREAM_ERROR_FORMULA).alias("metric_formula"),
        F.concat(
            F.lit("Failed to insert event "),
            F.coalesce("data.event_id", F.lit("None")),
            F.lit(" | Error: event_ts is not a timestamp: "),
            F.col("data.event_ts"),
        ).alias("description"),
    )


def quarantined(classified: DataFrame, value: str = "value") -> DataFrame:
    return classified.where(F.col("status") == QUARANTINE).select(
        F.col(value).cast("string").alias("value"), "reason"
    )


def batch_counts(classified: DataFrame, *keys: str) -> DataFrame:
    """Rows inserted, skipped and quarantined per ``keys`` (one row without keys)."""
    status = F.col("status")
    return classified.groupBy(*keys).agg(
        F.count_if(status == OK).alias("inserted"),
        F.count_if(status == ERROR).alias("skipped"),
        F.count_if(status == QUARANTINE).alias("quarantined"),
    )


def split_required(rows: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """NOT NULL contract: (rows that keep it, rows that break it)."""
    missing = F.lit(False)
    for column in columns:
        missing = missing | F.col(column).isNull()
    return rows.where(~missing), rows.where(missing)


def strict_measures(typed: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """Strict mode of typed events: a row with a missing or bad measure is skipped.

    Returns (kept rows, metric rows of the skipped ones).
    """
    kept, skipped = split_required(typed, *columns)
    errors = skipped.select(
        F.lit(STREAM_ERROR_METRIC).alias("metric_name"),
        F.lit("float(value)").alias("metric_formula"),
        F.concat(
            F.lit("Failed to insert event "), F.coalesce("event_id", F.lit("None"))
        ).alias("description"),
    )
    return kept, errors
