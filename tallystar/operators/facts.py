"""Event-grain facts of the organisation star."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar import schemas
from tallystar.functions.keys import surrogate_key, time_bucket_key
from tallystar.functions.numbers import null_to_zero
from tallystar.functions.timestamps import normalize_ts
from tallystar.operators.rank import first_by_key

# The metric row written for a rejected fact.
FACT_ERROR_METRIC = "fact_insert_error"
FACT_ERROR_FORMULA = "cast(float)"

_KINDS = {"string": "text", "timestamp_ntz": "wall_clock", "timestamp": "instant"}


def _clock(events: DataFrame, name: str, run_ts) -> Column:
    kind = _KINDS.get(events.schema[name].dataType.simpleString(), "number")
    return normalize_ts(F.col(name), run_ts, kind)


def _watch_time(events: DataFrame) -> Column:
    """The measure as double; NULL marks a row that the fact refuses."""
    column = F.col("watch_time")
    if events.schema["watch_time"].dataType.simpleString() == "string":
        return null_to_zero(column)
    return F.coalesce(column.cast("double"), F.lit(0.0))


def fact_project(events: DataFrame, run_ts: datetime | str | Column) -> DataFrame:
    """RAW rows -> fact rows, without the refused ones; no lookup, no aggregation."""
    coerced = {
        "watch_time": _watch_time(events),
        "event_ts": _clock(events, "event_ts", run_ts),
        "ingestion_ts": _clock(events, "ingestion_ts", run_ts),
    }
    return events.select(
        *[coerced.get(c, F.col(c)).alias(c) for c in schemas.FACT_USER_ACTIVITY.names]
    ).where(F.col("watch_time").isNotNull())


def fact_errors(events: DataFrame) -> DataFrame:
    """One metric row per refused row; the complement of ``fact_project``."""
    return events.where(_watch_time(events).isNull()).select(
        F.lit(FACT_ERROR_METRIC).alias("metric_name"),
        F.lit(FACT_ERROR_FORMULA).alias("metric_formula"),
        F.concat(
            F.coalesce("event_id", F.lit("None")),
            F.lit(" failed: could not convert string to float: '"),
            F.col("watch_time").cast("string"),
            F.lit("'"),
        ).alias("description"),
    )


def project_first_seen(events: DataFrame) -> DataFrame:
    """Projects with the time of their first event."""
    first = first_by_key(events, "project_code", ["project_name", "company_name"], skip_empty=False)
    created = first_seen(events, "project_code", "created_at")
    return first.join(created, "project_code").select("project_code", "project_name", "company_name", "created_at")


def earliest(held: DataFrame, new: DataFrame, key: str, time: str) -> DataFrame:
    """Rows (key, ..., time) of both, the earlier one of each key; what is held stays on equal times."""
    rows = held.withColumn("_held", F.lit(0)).unionByName(new.select(*held.columns).withColumn("_held", F.lit(1)))
    turn = F.row_number().over(Window.partitionBy(key).orderBy(F.asc_nulls_last(time), "_held"))
    return rows.withColumn("_turn", turn).where("_turn = 1").select(*held.columns)


def dim_employee_wide(
    employees: DataFrame,
    managers: DataFrame,
    branches: DataFrame,
    companies: DataFrame,
    effective_from: DataFrame,
) -> DataFrame:
    """Employees with the names of their manager, branch and company.

    ``effective_from`` gives (employee_id, effective_from); the surrogate key is
    made of the two.
    """
    m = managers.select("manager_id", "manager_name", "department")
    b = branches.select("branch_id", "branch_name", "company_id")
    c = companies.select("company_id", "company_name")
    return (
        employees.join(m, "manager_id", "left")
        .join(b, "branch_id", "left")
        .join(c, "company_id", "left")
        .join(effective_from, "employee_id", "left")
        .withColumn("employee_sk", surrogate_key(F.col("employee_id"), F.col("effective_from")))
        .select(*schemas.DIM_EMPLOYEE_WIDE.names)
    )


def first_seen(events: DataFrame, key: str, name: str = "effective_from") -> DataFrame:
    return events.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("event_ts").alias(name))


def fact_org_watch(raw: DataFrame, employees_wide: DataFrame) -> DataFrame:
    """RAW with the employee's surrogate key; organisation columns come from the event.

    An event of an unknown employee stays, with a NULL key.  Spark broadcasts
    the two-column key table when its statistics allow and sort-merges otherwise.
    """
    keys = employees_wide.select("employee_id", "employee_sk")
    return (
        raw.join(keys, "employee_id", "left")
        .withColumn("time_15min_sk", time_bucket_key(F.col("event_ts")))
        .select(*schemas.FACT_ORG_WATCH.names)
    )
