from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallystar.operators import facts, quality, seeds
from tallystar.operators.dims import (
    BRANCH,
    COMPANY,
    EMPLOYEE,
    ORGANISATION,
    dim_upsert,
    last_rows,
    org_columns_select,
)
from tests.util import raw_frame, rows_of

T1, T2 = "2025-01-01 00:00:00", "2025-01-01 00:00:01"


def test_last_and_first_event_win(spark):
    raw = raw_frame(
        spark,
        {"event_id": "b", "event_ts": T1, "branch_name": "old", "region_code": "R1"},
        {"event_id": "a", "event_ts": T2, "branch_name": "new", "region_code": "R2"},
    )
    assert rows_of(BRANCH.latest(raw), *BRANCH.schema.names) == [("B1", "new", "C1", "R2")]
    assert rows_of(BRANCH.first(raw), *BRANCH.schema.names) == [("B1", "old", "C1", "R1")]


def test_same_second_is_settled_by_event_id(spark):
    raw = raw_frame(
        spark,
        {"event_id": "x1", "event_ts": T1, "branch_name": "one"},
        {"event_id": "x2", "event_ts": T1, "branch_name": "two"},
    )
    assert BRANCH.latest(raw).first().branch_name == "two"
    assert BRANCH.first(raw).first().branch_name == "one"


@pytest.mark.parametrize("dimension", ORGANISATION, ids=lambda d: d.table)
def test_null_and_empty_keys(spark, dimension):
    raw = raw_frame(
        spark,
        {"event_id": "1", "event_ts": T1, dimension.key: None},
        {"event_id": "2", "event_ts": T1, dimension.key: ""},
        {"event_id": "3", "event_ts": T1},
    )
    known = raw.where("event_id = '3'").first()[dimension.key]
    assert rows_of(dimension.latest(raw), dimension.key) == [("",), (known,)]
    assert rows_of(dimension.first(raw), dimension.key) == [(known,)]


def test_null_attributes_of_the_last_event_stay_null(spark):
    raw = raw_frame(
        spark,
        {"event_id": "1", "event_ts": T1, "company_name": "Acme"},
        {"event_id": "2", "event_ts": T2, "company_name": None},
    )
    assert rows_of(COMPANY.latest(raw), *COMPANY.schema.names) == [("C1", None, "General")]


def test_upsert_twice_is_once(spark):
    old = spark.createDataFrame([("C1", "a", "x"), ("C9", "keep", "y")], COMPANY.schema)
    new = spark.createDataFrame([("C1", "b", "z"), ("C2", "n", "z")], COMPANY.schema)
    once = dim_upsert(old, new, "company_id")
    assert rows_of(once, *once.columns) == [("C1", "b", "z"), ("C2", "n", "z"), ("C9", "keep", "y")]
    assert rows_of(dim_upsert(once, new, "company_id"), *once.columns) == rows_of(once, *once.columns)


def test_org_columns_keep_event_grain(spark, sf):
    from checks import fixtures

    raw = fixtures.raw(spark, sf)
    for name, rows in org_columns_select(raw).items():
        assert rows.count() == raw.count(), name


def test_last_rows_change_no_dimension(spark, sf):
    from checks import fixtures

    raw = fixtures.raw(spark, sf)
    heads, count, upto = last_rows(raw, ORGANISATION)
    assert heads.count() < raw.count() / 2
    assert count == raw.count() and upto == raw.agg(F.max("event_ts")).first()[0]
    assert last_rows(raw.where("false"), ORGANISATION)[1:] == (0, None)
    for d in ORGANISATION:
        assert rows_of(d.latest(heads), *d.schema.names) == rows_of(d.latest(raw), *d.schema.names)


def test_extremes_are_hashed(spark, sf):
    from checks import fixtures

    raw = fixtures.raw(spark, sf)
    plans = [d.latest(raw) for d in ORGANISATION] + [d.first(raw) for d in ORGANISATION]
    plans += [quality.dedupe_by_key(raw), facts.project_first_seen(raw)]
    for rows in plans:
        rows.collect()
        assert "SortAggregate" not in rows._jdf.queryExecution().toString()


def test_ties_beyond_the_number_are_settled(spark):
    """Fractions of a second, long ids with one beginning, ids that begin each other, and no id at all."""
    base = datetime(2025, 1, 1, 0, 0, 0, 5)
    ids = ["event-000000001", "event-000000002", "event-0", "event-", None, "\u00e9vent", "\U0001f999"]
    rows = [{"event_id": i, "event_ts": base, "branch_name": repr(i)} for i in ids]
    rows += [{"event_id": "z", "event_ts": base.replace(microsecond=4), "branch_name": "before"}]
    for n in range(len(ids)):
        some = raw_frame(spark, *rows[n:])
        known = [i for i in ids[n:] if i is not None]
        last = max(known, key=lambda i: i.encode())
        assert BRANCH.latest(some).first().branch_name == repr(last)
        assert BRANCH.first(some).first().branch_name == "before"
        first = None if None in ids[n:] else min(known, key=lambda i: i.encode())
        assert BRANCH.first(raw_frame(spark, *rows[n:-1])).first().branch_name == repr(first)
    old = raw_frame(spark, {"event_id": "1", "event_ts": datetime(1, 1, 1)}, {"event_id": "2", "event_ts": None})
    assert facts.project_first_seen(old).first().created_at == datetime(1, 1, 1)


def test_seeds(spark):
    seeded = seeds.seed_dims(spark)
    sizes = {name: rows.count() for name, rows in seeded.items()}
    assert sizes == {
        "dim_region": 5,
        "dim_company": 3,
        "dim_branch": 4,
        "dim_manager": 4,
        "dim_project": 3,
        "dim_employee": 20,
    }
    report = quality.fk_orphans(seeded).collect()
    assert len(report) == 6 and all(r.orphan_rows == 0 for r in report)
    assert seeds.seed_region_boxes(spark).count() == 5
    first = rows_of(seeded["dim_employee"], *EMPLOYEE.schema.names)[0]
    assert first == ("E1001", "Employee_1", "M002", "B002", "P002")


def test_orphans_and_regions(spark):
    raw = raw_frame(
        spark,
        {"event_id": "1", "event_ts": T1, "region_code": "NCR-CP", "branch_id": "B9"},
        {"event_id": "2", "event_ts": T1, "region_code": "NCR", "branch_id": "B9"},
        {"event_id": "3", "event_ts": T1, "region_code": None, "branch_id": None},
    )
    known = seeds.seed_regions(spark)
    assert rows_of(quality.region_conformance(raw, known), "region_code", "events") == [("NCR-CP", 1)]
    branches = spark.createDataFrame([("B1", "n", "C1", "R")], BRANCH.schema)
    report = quality.fk_orphans(
        {"fact": raw, "dim_branch": branches}, [("fact", "branch_id", "dim_branch")]
    ).first()
    assert (report.orphan_rows, report.orphan_keys) == (2, 1)


def test_dedupe_first_wins_and_null_key_is_refused(spark):
    raw = raw_frame(
        spark,
        {"event_id": "1", "event_ts": T2, "username": "late"},
        {"event_id": "1", "event_ts": T1, "username": "early"},
        {"event_id": "2", "event_ts": T1},
        {"event_id": None, "event_ts": T1},
        {"event_id": "", "event_ts": T1},
    )
    held = raw.where("event_id = '2'")
    unique = quality.dedupe_by_key(raw, "event_id", held)
    assert rows_of(unique, "event_id", "username") == [("", "ann"), ("1", "early")]


def test_first_events_are_among_the_last_ones_if_asked(spark, sf):
    from checks import fixtures

    raw = fixtures.raw(spark, sf)
    heads, count, _ = last_rows(raw, ORGANISATION, ("employee_id", "project_code"))
    assert count == raw.count() and heads.count() < raw.count() / 2
    for first in (facts.project_first_seen, lambda rows: facts.first_seen(rows, "employee_id")):
        assert rows_of(first(heads), *first(raw).columns) == rows_of(first(raw), *first(raw).columns)
    for d in ORGANISATION:
        assert rows_of(d.latest(heads), *d.schema.names) == rows_of(d.latest(raw), *d.schema.names)


def test_exported_dimensions_do_not_read_the_events_again(spark, sf):
    from checks.queries import _exported

    _, tables = _exported(spark, sf)
    for d in ORGANISATION:
        assert not [f for f in tables[d.table].inputFiles() if "events.parquet" in f]
