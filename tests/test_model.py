"""Time dimensions, facts, catalog and roll-ups on small literal input."""

import random

import pytest
from pyspark.sql import functions as F

from tallystar import schemas
from tallystar.operators import analytics, calendar, catalog, facts, seeds
from tests.util import RUN_TS, at, raw_frame, rows_of


def test_dim_time(spark):
    times = calendar.dim_time(spark)
    assert times.columns == schemas.DIM_TIME.names
    assert times.count() == 2880
    ends = times.agg(F.min("time_key"), F.max("time_key"), F.max("time_bucket_end")).first()
    assert tuple(ends) == ("20250101_0000", "20250130_2345", at("2025-01-31 00:00:00"))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_calendar(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        anchor = spark.createDataFrame([(at("2024-12-30 10:07:09"),)], "now timestamp_ntz")
        rows = calendar.dim_time_calendar(anchor, "now", days=15)
        assert rows.schema.names == schemas.DIM_TIME_15MIN.names
        # Start floored to 10:00, end 10:07:09 included: 30 days and one bucket.
        assert rows.count() == 30 * 96 + 1
        iso = rows.where("time_15min_sk = '202412301000'").first()
        assert (iso.day, iso.hour, iso.minute, iso.dow, iso.week, iso.month, iso.year) == (
            "2024-12-30", 10, 0, 1, 1, 12, 2024,
        )
        sunday = rows.where("time_15min_sk = '202501050000'").first()
        assert (sunday.dow, sunday.week) == (7, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_fact_and_its_errors_split_the_batch(spark):
    raw = raw_frame(
        spark, *[{"event_id": str(n), "event_ts": "2025-01-01 00:00:00"} for n in range(5)]
    )
    texts = F.element_at(F.array(*[F.lit(v) for v in ("1.5", "", "n/a", "0")]), F.col("event_id").cast("int") + 1)
    text = raw.where("event_id < 4").withColumn("watch_time", texts)
    fact = facts.fact_project(text, RUN_TS)
    assert fact.schema.names == schemas.FACT_USER_ACTIVITY.names
    assert rows_of(fact, "event_id", "watch_time") == [("0", 1.5), ("1", 0.0), ("3", 0.0)]
    errors = facts.fact_errors(text)
    assert rows_of(errors, "metric_name", "description") == [
        ("fact_insert_error", "2 failed: could not convert string to float: 'n/a'")
    ]
    # A table of doubles refuses nothing; a NULL counts as zero.
    doubles = raw.withColumn("watch_time", F.lit(None).cast("double"))
    assert facts.fact_errors(doubles).count() == 0
    assert facts.fact_project(doubles, RUN_TS).agg(F.sum("watch_time")).first()[0] == 0.0


def test_fact_normalizes_text_times(spark):
    raw = raw_frame(spark, {"event_id": "1", "event_ts": "2025-01-01 00:00:00"}).withColumn(
        "event_ts", F.lit("2025-01-01T10:00:00+05:30")
    ).withColumn("ingestion_ts", F.lit(1735689600500))
    row = facts.fact_project(raw, RUN_TS).first()
    assert (row.event_ts, row.ingestion_ts) == (at("2025-01-01 10:00:00"), at("2025-01-01 00:00:00"))


def test_catalog(spark):
    raw = raw_frame(spark, {"event_id": "1", "event_ts": "2025-01-01 00:00:00", "city": None})
    registry = catalog.meta_table(spark, RUN_TS)
    assert registry.count() == 9 and registry.columns == schemas.META_TABLE.names
    counts = catalog.meta_table_counts({"raw_user_stream_events": raw}, RUN_TS)
    assert counts.columns == schemas.META_TABLE_COUNTS.names
    assert rows_of(counts, "table_name", "record_count") == [("etl.raw_user_stream_events", 1)]
    declared = catalog.meta_column({"raw": raw})
    assert rows_of(declared.select("is_nullable").distinct(), "is_nullable") == [("YES",)]
    observed = catalog.meta_column({"raw": raw}, observed=True)
    assert rows_of(observed.where("is_nullable = 'YES'"), "column_name") == [("city",)]
    metrics = catalog.metric_eval(raw, {"n": "count(*)", "most": "max(watch_time)"})
    assert rows_of(metrics, "metric_name", "metric_value") == [("most", 1.0), ("n", 1.0)]
    assert catalog.meta_metric(spark).count() == len(catalog.METRICS)
    definitions = catalog.metric_definitions(spark, "watch")
    assert definitions.columns == schemas.METRIC_DEFINITION.names


def test_region_box_bounds_are_closed(spark):
    points = [
        ("in", 28.62, 77.21),
        ("edge", 28.61, 77.20),
        ("corner", 28.64, 77.24),
        ("gap", 28.60, 77.21),
        ("far", 0.0, 0.0),
        ("none", None, 77.2),
        ("noida", 28.65, 77.45),
    ]
    frame = spark.createDataFrame(points, "id string, lat double, lon double")
    found = analytics.region_by_box(frame, seeds.seed_region_boxes(spark))
    assert dict(rows_of(found, "id", "box_region")) == {
        "in": "NCR-CP",
        "edge": "NCR-CP",
        "corner": "NCR-CP",
        "gap": None,
        "far": None,
        "none": None,
        "noida": "NCR-NOIDA",
    }


def test_rollup_levels(spark):
    raw = raw_frame(
        spark,
        {"event_id": "1", "event_ts": RUN_TS, "watch_time": 2.0},
        {"event_id": "2", "event_ts": RUN_TS, "watch_time": 4.0, "branch_id": "B2", "branch_name": "South"},
    )
    companies = raw.select("company_id", "company_name").distinct()
    branches = raw.select("branch_id", "branch_name").distinct()
    rows = analytics.watch_by_org(raw, companies, branches)
    got = {
        (r.company_name, r.branch_name): (r.grouping_level, r.events, r.avg_watch_time)
        for r in rows.collect()
    }
    assert got == {
        ("Acme", "North"): (0, 1, 2.0),
        ("Acme", "South"): (0, 1, 4.0),
        ("Acme", None): (1, 2, 3.0),
        (None, None): (3, 2, 3.0),
    }


def test_watch_15min_fills_empty_buckets(spark):
    raw = raw_frame(spark, {"event_id": "1", "event_ts": "2025-01-01 00:29:59", "watch_time": 2.5})
    times = calendar.dim_time(spark, "2025-01-01 00:00:00", days=1)
    rows = analytics.watch_15min(raw, times)
    assert rows.count() == 96
    assert rows_of(rows.where("events > 0"), "time_key", "events", "watch_time") == [
        ("20250101_0015", 1, 2.5)
    ]


def test_top_employees_ties_by_id(spark):
    raw = raw_frame(
        spark,
        *[
            {"event_id": str(n), "event_ts": RUN_TS, "employee_id": f"E{n}", "watch_time": float(n // 2)}
            for n in range(6)
        ],
    )
    employees = raw.select("employee_id", "employee_name").distinct()
    top = analytics.top_employees(raw, employees, n=3)
    assert rows_of(top, "place", "employee_id") == [(1, "E4"), (2, "E5"), (3, "E2")]


def test_a_country_sized_box_makes_few_cells(spark):
    boxes = spark.createDataFrame(
        [("IN", "n", "c", 6.5, 35.5, 68.1, 97.4), ("TINY", "n", "c", 50.0, 50.01, 10.0, 10.01), ("POINT", "n", "c", 1.0, 1.0, 1.0, 1.0),
         ("EARTH-S", "n", "c", -90.0, 0.0, -180.0, 180.0), ("NONE", "n", "c", 60.0, 59.0, 0.0, 1.0)],
        schemas.DIM_REGION_BOX,
    )
    rng = random.Random(1)
    points = [(str(n), rng.uniform(-90, 60), rng.uniform(-180, 180)) for n in range(500)]
    points += [(f"i{n}", rng.uniform(6, 36), rng.uniform(68, 98)) for n in range(300)]
    points += [("edge", 35.5, 97.4), ("tiny", 50.005, 10.01), ("point", 1.0, 1.0), ("none", None, 1.0), ("nan", float("nan"), 1.0)]
    frame = spark.createDataFrame(points, "id string, lat double, lon double")
    found = dict(rows_of(analytics.region_by_box(frame, boxes), "id", "box_region"))
    assert len(found) == len(points)
    every = boxes.collect()
    for name, lat, lon in points:
        inside = [b.region_code for b in every if lat is not None and b.min_lat <= lat <= b.max_lat and b.min_lon <= lon <= b.max_lon]
        assert found[name] == (inside[0] if inside else None), name
    plan = analytics.region_by_box(frame, boxes)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 3
