"""Column contracts of every event shape and table."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TEXT, REAL, CLOCK = StringType(), DoubleType(), TimestampNTZType()


def _table(text: str, **typed) -> StructType:
    """Columns in order, all text unless named in ``typed``."""
    return StructType([StructField(c, typed.get(c, TEXT)) for c in text.split()])


# Names and order of all columns below.
# -- event shapes -----------------------------------------------------------
EVENT_FIELDS = (
    "event_id event_ts user_id username session_id device_type app_version watch_time "
    "country city region_code lat lon company_id company_name branch_id branch_name "
    "department manager_id manager_name employee_id employee_name project_code project_name"
)
# The three measures are decoded as text first, so that a quoted or broken
# number spoils one field and not the whole record.
EVENT_TEXT = _table(EVENT_FIELDS)
EVENT_TYPED = _table(EVENT_FIELDS, watch_time=REAL, lat=REAL, lon=REAL)
USER_EVENT = _table(
    "event_id event_ts user_id username session_id device_type app_version watch_time "
    "country city region_code lat lon",
    watch_time=REAL,
    lat=REAL,
    lon=REAL,
)
LIVE_EVENT = _table(
    "id username watch_time country timestamp", id=IntegerType(), watch_time=REAL
)
SENSOR_EVENT = _table(
    "timestamp location temperature humidity wind_speed",
    temperature=REAL,
    humidity=REAL,
    wind_speed=REAL,
)

# -- tables -----------------------------------------------------------------
RAW = _table(
    "event_id event_ts ingestion_ts user_id username session_id device_type app_version "
    "watch_time country city region_code lat lon company_id company_name branch_id "
    "branch_name department manager_id manager_name employee_id employee_name "
    "project_code project_name",
    event_ts=CLOCK,
    ingestion_ts=CLOCK,
    watch_time=REAL,
    lat=REAL,
    lon=REAL,
)
RAW_USER = _table(
    "event_id event_ts user_id username session_id device_type app_version watch_time "
    "country city region_code lat lon ingestion_ts",
    event_ts=CLOCK,
    ingestion_ts=CLOCK,
    watch_time=REAL,
    lat=REAL,
    lon=REAL,
)
DIM_COMPANY = _table("company_id company_name industry")
DIM_BRANCH = _table("branch_id branch_name company_id region_code")
DIM_MANAGER = _table("manager_id manager_name branch_id department")
DIM_EMPLOYEE = _table("employee_id employee_name manager_id branch_id project_code")
DIM_PROJECT = _table("project_code project_name company_id department")
DIM_REGION = _table("region_code region_name")
DIM_REGION_BOX = _table(
    "region_code region_name city min_lat max_lat min_lon max_lon",
    min_lat=REAL,
    max_lat=REAL,
    min_lon=REAL,
    max_lon=REAL,
)
DIM_TIME = _table(
    "time_bucket_start time_bucket_end time_key", time_bucket_start=CLOCK, time_bucket_end=CLOCK
)
DIM_TIME_15MIN = _table(
    "time_15min_sk bucket_start_ts day hour minute dow week month year",
    bucket_start_ts=CLOCK,
    **{c: IntegerType() for c in ("hour", "minute", "dow", "week", "month", "year")},
)
DIM_USER_SCD2 = _table(
    "user_sk user_id username device_type app_version region_code city "
    "effective_from effective_to is_current",
    effective_from=CLOCK,
    effective_to=CLOCK,
    is_current=BooleanType(),
)
FACT_USER_ACTIVITY = _table(
    "event_id user_id employee_id project_code watch_time session_id event_ts ingestion_ts "
    "company_id branch_id manager_id region_code",
    watch_time=REAL,
    event_ts=CLOCK,
    ingestion_ts=CLOCK,
)
FACT_USER_WATCH = _table(
    "event_id event_ts time_15min_sk user_sk region_code lat lon watch_time device_type "
    "app_version ingestion_ts",
    event_ts=CLOCK,
    lat=REAL,
    lon=REAL,
    watch_time=REAL,
    ingestion_ts=CLOCK,
)
DIM_EMPLOYEE_WIDE = _table(
    "employee_sk employee_id employee_name manager_id manager_name department branch_id "
    "branch_name company_name effective_from",
    effective_from=CLOCK,
)
DIM_PROJECT_FIRST_SEEN = _table(
    "project_code project_name company_name created_at", created_at=CLOCK
)
EMPLOYEE_FIRST_SEEN = _table("employee_id effective_from", effective_from=CLOCK)
FACT_ORG_WATCH = _table(
    "event_id event_ts time_15min_sk employee_sk project_code region_code lat lon watch_time "
    "device_type app_version ingestion_ts manager_id branch_id department company_name",
    event_ts=CLOCK,
    lat=REAL,
    lon=REAL,
    watch_time=REAL,
    ingestion_ts=CLOCK,
)
META_TABLE = _table(
    "table_name type description created_ts updated_ts", created_ts=CLOCK, updated_ts=CLOCK
)
META_TABLE_COUNTS = _table(
    "table_name schema_name table_type description record_count last_updated",
    record_count=LongType(),
    last_updated=CLOCK,
)
META_COLUMN = _table("table_name column_name data_type is_nullable description")
METRIC_DEFINITION = _table("metric_name sql_definition business_definition category")
META_METRIC = _table("metric_name metric_formula description")
METRIC_DEFINITIONS = _table("metric_name sql_definition business_definition category")
ETL_WATERMARKS = _table("pipeline_name last_run_ts", last_run_ts=CLOCK)
QUARANTINE = _table("value reason")
BATCH_COUNTS = StructType(
    [
        StructField("batch_id", LongType()),
        StructField("inserted", LongType()),
        StructField("skipped", LongType()),
        StructField("quarantined", LongType()),
    ]
)
RUN_COUNTS = StructType([StructField("step", TEXT), StructField("row_count", LongType())])
