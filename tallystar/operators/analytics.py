"""Roll-ups of the star schema.

Every roll-up aggregates the fact on its own keys first and joins the names to
the few rows that remain, so no join sees event-grain rows.  Averages are the
rounded total over the count, which makes them repeatable whatever the order of
addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.functions.timestamps import floor_to_quarter

GRID = 0.05
# Cells a side of a box.
CELLS = 8


def _total(column: str = "watch_time") -> Column:
    return F.round(F.sum(column), 2)


def watch_by_org(fact: DataFrame, companies: DataFrame, branches: DataFrame) -> DataFrame:
    """Events and watch time per company and branch, with ROLLUP subtotals.

    Groups are ids, so namesakes stay apart; an unknown id has no name and counts in
    every total.
    """
    per_branch = fact.groupBy("company_id", "branch_id").agg(
        F.count("*").alias("n"), F.sum("watch_time").alias("w")
    )
    named = per_branch.join(
        companies.select("company_id", "company_name"), "company_id", "left"
    ).join(branches.select("branch_id", "branch_name"), "branch_id", "left")
    total = named.rollup("company_id", "branch_id").agg(
        F.max("company_name").alias("_company"),
        F.max("branch_name").alias("_branch"),
        F.sum("n").alias("events"),
        _total("w").alias("watch_time"),
        F.grouping_id().alias("grouping_level"),
    )
    level = F.col("grouping_level")
    return total.select(
        "company_id",
        F.when(level < 3, F.col("_company")).alias("company_name"),
        "branch_id",
        F.when(level < 1, F.col("_branch")).alias("branch_name"),
        "events",
        "watch_time",
        "grouping_level",
        (F.col("watch_time") / F.col("events")).alias("avg_watch_time"),
    )


def watch_by_department(fact: DataFrame, managers: DataFrame) -> DataFrame:
    """Events, distinct users and watch time per department of the manager; an unknown manager
    counts under no department."""
    per_user = fact.groupBy("manager_id", "user_id").agg(
        F.count("*").alias("n"), F.sum("watch_time").alias("w")
    )
    return (
        per_user.join(managers.select("manager_id", "department"), "manager_id", "left")
        .groupBy("department", "user_id")
        .agg(F.sum("n").alias("n"), F.sum("w").alias("w"))
        .groupBy("department")
        .agg(
            F.sum("n").alias("events"),
            F.count("user_id").alias("users"),
            _total("w").alias("watch_time"),
        )
    )


def watch_by_project(fact: DataFrame, projects: DataFrame, companies: DataFrame) -> DataFrame:
    """Events and watch time per project, with its company; an unknown project has no names."""
    per_project = fact.groupBy("project_code").agg(
        F.count("*").alias("events"), _total().alias("watch_time")
    )
    return (
        per_project.join(
            projects.select("project_code", "project_name", "company_id"), "project_code", "left"
        )
        .join(companies.select("company_id", "company_name"), "company_id", "left")
        .select("project_code", "project_name", "company_name", "events", "watch_time")
    )


def watch_15min(fact: DataFrame, times: DataFrame) -> DataFrame:
    """Events and watch time per bucket of the time dimension, zero-filled."""
    per_bucket = (
        fact.groupBy(floor_to_quarter(F.col("event_ts")).alias("time_bucket_start"))
        .agg(F.count("*").alias("n"), _total().alias("w"))
    )
    return times.join(per_bucket, "time_bucket_start", "left").select(
        "time_key",
        "time_bucket_start",
        F.coalesce("n", F.lit(0)).alias("events"),
        F.coalesce("w", F.lit(0.0)).alias("watch_time"),
    )


def top_employees(fact: DataFrame, employees: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` employees with the most watch time in each branch of the fact."""
    totals = fact.groupBy("branch_id", "employee_id").agg(
        F.count("*").alias("events"), _total().alias("watch_time")
    )
    in_branch = Window.partitionBy("branch_id").orderBy(F.desc("watch_time"), "employee_id")
    best = totals.withColumn("place", F.row_number().over(in_branch)).where(F.col("place") <= n)
    return best.join(employees.select("employee_id", "employee_name"), "employee_id", "left").select(
        "branch_id", "place", "employee_id", "employee_name", "events", "watch_time"
    )


def session_summary(fact: DataFrame) -> DataFrame:
    """First and last event, events and watch time per session."""
    return fact.groupBy("session_id").agg(
        F.min("event_ts").alias("first_event"),
        F.max("event_ts").alias("last_event"),
        F.count("*").alias("events"),
        _total().alias("watch_time"),
    )


def _cell(column: Column, size: Column | float) -> Column:
    return F.floor(column / size)


def region_by_box(events: DataFrame, boxes: DataFrame) -> DataFrame:
    """Events with the region whose closed box holds the point, NULL when none does.

    Boxes are spread over grid cells so that the match is an equi join on the
    cell; the bounds are the residual.  A box takes a grid of its own size, a power of two times
    ``GRID``, on which it has ``CELLS`` + 1 cells a side at most; there is one join for each size.  Boxes must not overlap.
    """
    extent = F.greatest(F.col("max_lat") - F.col("min_lat"), F.col("max_lon") - F.col("min_lon"))
    size = F.lit(GRID) * F.pow(F.lit(2.0), F.greatest(F.lit(0), F.ceil(F.log2(extent / (GRID * CELLS)))))
    sized = boxes.withColumn("_size", F.when(extent > GRID * CELLS, size).otherwise(F.lit(GRID)))
    lat, lon = F.col("lat"), F.col("lon")
    found = events.withColumn("box_region", F.lit(None).cast("string"))
    # From one degree's twentieth to the whole earth there are some fifteen sizes.
    for r in sized.where("max_lat >= min_lat AND max_lon >= min_lon").select("_size").distinct().orderBy("_size").collect():
        grid = F.lit(r["_size"])
        side = lambda low, high: F.explode(F.sequence(_cell(F.col(low), grid), _cell(F.col(high), grid)))  # noqa: B023, E731
        cells = (
            sized.where((F.col("_size") == grid) & (F.col("max_lat") >= F.col("min_lat")) & (F.col("max_lon") >= F.col("min_lon")))
            .withColumn("_lat", side("min_lat", "max_lat"))
            .withColumn("_lon", side("min_lon", "max_lon"))
            .select("_lat", "_lon", F.col("region_code").alias("_region"), "min_lat", "max_lat", "min_lon", "max_lon")
        )
        found = found.join(
            cells,
            (_cell(lat, grid) == F.col("_lat"))
            & (_cell(lon, grid) == F.col("_lon"))
            & lat.between(F.col("min_lat"), F.col("max_lat"))
            & lon.between(F.col("min_lon"), F.col("max_lon")),
            "left",
        ).select(*events.columns, F.coalesce("box_region", "_region").alias("box_region"))
    return found
