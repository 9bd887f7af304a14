"""Whole runs: bootstrap, incremental silver runs, the user star."""

import pytest
from pyspark.sql import functions as F

from checks import fixtures
from tallystar import schemas
from tallystar.operators import watermark
from tallystar.operators.dims import ORGANISATION
from tallystar.plans import silver
from tallystar.plans.silver import silver_run, user_star_run
from tallystar.plans.warehouse import Warehouse, bootstrap
from tallystar.sources import files
from tests.util import RUN_TS, at, raw_frame, rows_of


def contents(warehouse):
    tables = {d.table: rows_of(warehouse.dims[d.table].read(), *d.schema.names) for d in ORGANISATION}
    fact = warehouse.fact.read()
    return {**tables, "fact": rows_of(fact, *fact.columns)}


def mark(warehouse, pipeline=watermark.LIVE_STREAM):
    return watermark.watermark_read(warehouse.watermarks.read(), pipeline).first()["last_run_ts"]


@pytest.fixture(scope="module")
def one_run(spark, sf, tmp_path_factory):
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("one")))
    warehouse.raw.write_run(fixtures.raw(spark, sf), "t", 0)
    counts = silver_run(warehouse, RUN_TS)
    assert counts["raw_loaded"] == counts["fact_user_activity"] == 1000
    assert counts["dim_branch"] == warehouse.dims["dim_branch"].read().count() == 5
    assert rows_of(warehouse.run_counts.read(), "step", "row_count") == sorted(counts.items())
    return contents(warehouse)


def test_bootstrap(spark, root):
    warehouse = Warehouse(spark, root)
    bootstrap(warehouse, RUN_TS)
    assert len(warehouse.tables) == 13
    assert warehouse.dims["dim_time"].read().count() == 2880
    assert warehouse.meta_table.read().count() == 9
    assert warehouse.region_boxes.read().count() == 5
    assert warehouse.calendar.read().count() == 60 * 96 + 1
    assert warehouse.meta_column.read().where("table_name = 'etl.dim_time'").count() == 3
    assert mark(warehouse) == at(watermark.EPOCH)
    # A second bootstrap keeps data and doubles nothing; overwrite drops it.
    warehouse.raw.write_run(raw_frame(spark, {"event_id": "1", "event_ts": "2025-01-01 00:00:00"}), "t", 0)
    bootstrap(warehouse, RUN_TS, watermark=RUN_TS)
    assert warehouse.raw.read().count() == 1
    assert warehouse.dims["dim_employee"].read().count() == 20
    assert mark(warehouse) == at(watermark.EPOCH)
    bootstrap(warehouse, RUN_TS, overwrite=True, watermark=RUN_TS)
    assert warehouse.raw.read().count() == 0
    assert mark(warehouse) == at(RUN_TS)


def test_incremental_runs_equal_one_run(spark, sf, root, one_run):
    warehouse = Warehouse(spark, root)
    raw = fixtures.raw(spark, sf)
    cuts = ["2023-12-31", "2024-01-08", "2024-01-15", "2024-01-23", "2024-02-01"]
    loaded = 0
    for n, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        part = raw.where(f"event_ts > timestamp_ntz'{lo}' AND event_ts <= timestamp_ntz'{hi}'")
        warehouse.raw.write_run(part, "t", n)
        loaded += silver_run(warehouse, RUN_TS)["raw_loaded"]
    assert loaded == 1000
    assert contents(warehouse) == one_run
    assert mark(warehouse) == raw.agg(F.max("event_ts")).first()[0]


def test_no_news_writes_nothing(spark, root):
    warehouse = Warehouse(spark, root)
    assert silver_run(warehouse, RUN_TS) == {}
    assert not files.exists(spark, warehouse.fact.path)
    assert not files.exists(spark, warehouse.watermarks.path)


def test_event_in_the_marks_own_second_is_lost_unless_late_rows_are_read(spark, root):
    same = "2025-01-01 00:00:00"
    warehouse = Warehouse(spark, root)
    warehouse.raw.write_run(raw_frame(spark, {"event_id": "1", "event_ts": same}), "t", 0)
    silver_run(warehouse, RUN_TS)
    warehouse.raw.write_run(raw_frame(spark, {"event_id": "2", "event_ts": same}), "t", 1)
    assert silver_run(warehouse, RUN_TS) == {}
    assert rows_of(warehouse.fact.read(), "event_id") == [("1",)]
    assert silver_run(warehouse, RUN_TS, lateness="1 hour")["raw_loaded"] == 1
    # Still late: the next such run finds it again in RAW and keeps it once.
    later = {"event_id": "3", "event_ts": "2025-01-01 00:30:00"}
    warehouse.raw.write_run(raw_frame(spark, later), "t", 2)
    silver_run(warehouse, RUN_TS, lateness="1 hour")
    assert rows_of(warehouse.fact.read(), "event_id") == [("1",), ("2",), ("3",)]


@pytest.mark.parametrize("lateness", [None, "1 day"])
def test_crash_before_the_watermark_doubles_nothing(spark, sf, root, one_run, lateness, monkeypatch):
    warehouse = Warehouse(spark, root)
    warehouse.raw.write_run(fixtures.raw(spark, sf), "t", 0)
    with monkeypatch.context() as patch:
        patch.setattr(silver, "_save_mark", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            silver_run(warehouse, RUN_TS, lateness=lateness)
    silver_run(warehouse, RUN_TS, lateness=lateness)
    assert contents(warehouse) == one_run


def test_null_event_ts_is_never_loaded(spark, root):
    warehouse = Warehouse(spark, root)
    raw = raw_frame(spark, {"event_id": "1", "event_ts": None}, {"event_id": "2", "event_ts": RUN_TS})
    warehouse.raw.write_run(raw, "t", 0)
    assert silver_run(warehouse, RUN_TS)["raw_loaded"] == 1


def test_export_skips_nothing_but_empty_tables(spark, root, sf):
    warehouse = Warehouse(spark, f"{root}/w")
    warehouse.raw.write_run(fixtures.raw(spark, sf), "t", 0)
    silver_run(warehouse, RUN_TS, export_dir=f"{root}/csv")
    assert sorted(files.children(spark, f"{root}/csv")) == sorted(
        [f"{d.table}.csv" for d in ORGANISATION] + ["fact_user_activity.csv"]
    )


def test_watermarks_keep_other_pipelines(spark):
    marks = spark.createDataFrame(
        [("live_stream", at("2025-01-01 00:00:00")), ("other", at("2024-01-01 00:00:00"))],
        schemas.ETL_WATERMARKS,
    )
    value = spark.createDataFrame([("live_stream", "2025-02-01T00:00:00Z")], "pipeline_name string, last_run_ts string")
    after = watermark.watermark_write(marks, value, RUN_TS, kind="text")
    assert rows_of(after, *after.columns) == [
        ("live_stream", at("2025-02-01 00:00:00")),
        ("other", at("2024-01-01 00:00:00")),
    ]
    assert watermark.watermark_read(marks, "none").first().last_run_ts == at(watermark.EPOCH)


def users_of(warehouse):
    users = warehouse.users()
    fact = warehouse.user_fact.read()
    return rows_of(users, *users.columns), rows_of(fact, *fact.columns)


def test_user_star_in_two_batches_and_a_crash(spark, root, monkeypatch):
    raw = fixtures.raw(spark, "/root/testdata/sf0.01")
    first, _ = fixtures.two_batches(raw)
    whole, broken = Warehouse(spark, f"{root}/a"), Warehouse(spark, f"{root}/b")
    for warehouse in (whole, broken):
        user_star_run(warehouse, first, RUN_TS)
        if warehouse is broken:
            with monkeypatch.context() as patch:
                patch.setattr(silver, "_save_mark", lambda *a: (_ for _ in ()).throw(OSError("lost")))
                with pytest.raises(OSError):
                    user_star_run(warehouse, raw, RUN_TS)
        counts = user_star_run(warehouse, raw, RUN_TS)
        assert counts["updates"] > 0
        assert user_star_run(warehouse, raw, RUN_TS) == {}
    assert users_of(whole) == users_of(broken)
    users, fact = users_of(whole)
    assert len({row[0] for row in users}) == len(users)
    assert len({row[0] for row in fact}) == len(fact)


def test_command_line(spark, root):
    import json

    from tallystar.__main__ import arguments, run

    line = json.dumps({"event_id": "1", "event_ts": "2025-01-01 00:00:00", "company_id": "C1"})
    spark.createDataFrame([(line,)], "value string").write.text(f"{root}/inbox")
    place = ["--root", f"{root}/w", "--run-ts", RUN_TS]
    run(arguments(["bootstrap", *place]))
    stream = ["--format", "text", "--path", f"{root}/inbox", "--checkpoint", f"{root}/c"]
    run(arguments(["ingest", *place, *stream, "--available-now"]))
    assert run(arguments(["silver", *place, "--export", f"{root}/csv"]))["raw_loaded"] == 1
    assert run(arguments(["users", *place])) == {"inserts": 0, "updates": 0}
    warehouse = Warehouse(spark, f"{root}/w")
    assert warehouse.dims["dim_company"].read().count() == 4
    assert "dim_company.csv" in files.children(spark, f"{root}/csv")


def test_late_facts_survive_later_runs(spark, root):
    """Runs from one mark, with and without lateness, never replace each other."""
    warehouse = Warehouse(spark, root)
    steps = [
        ({"event_id": "1", "event_ts": "2025-01-01 10:00:00"}, None),
        ({"event_id": "2", "event_ts": "2025-01-01 05:30:00"}, "10 hours"),
        ({"event_id": "3", "event_ts": "2025-01-01 09:45:00"}, "1 hour"),
        ({"event_id": "4", "event_ts": "2025-01-01 10:30:00"}, None),
    ]
    for n, (event, lateness) in enumerate(steps):
        warehouse.raw.write_run(raw_frame(spark, event), "t", n)
        assert silver_run(warehouse, RUN_TS, lateness=lateness)["fact_user_activity"] == 1
    assert rows_of(warehouse.fact.read(), "event_id") == [("1",), ("2",), ("3",), ("4",)]


def test_a_fraction_of_a_second_is_loaded_once(spark, root):
    warehouse, instant = Warehouse(spark, root), at("2025-01-01 10:00:00").replace(microsecond=750000)
    warehouse.raw.write_run(raw_frame(spark, {"event_id": "1", "event_ts": instant}), "t", 0)
    assert silver_run(warehouse, RUN_TS)["raw_loaded"] == 1
    assert silver_run(warehouse, RUN_TS) == {}
    assert mark(warehouse) == instant


def test_events_without_an_id_count_with_lateness_too(spark, root):
    warehouse = Warehouse(spark, root)
    rows = [{"event_id": i, "event_ts": "2025-01-01 10:00:00"} for i in (None, "1")]
    warehouse.raw.write_run(raw_frame(spark, *rows), "t", 0)
    assert silver_run(warehouse, RUN_TS, lateness="1 hour")["raw_loaded"] == 2
    assert silver_run(warehouse, RUN_TS, lateness="1 hour") == {}
    assert warehouse.fact.read().count() == 2


def test_readers_see_whole_runs_only(spark, root):
    warehouse = Warehouse(spark, root)
    for n in range(2):
        warehouse.raw.write_run(raw_frame(spark, {"event_id": str(n), "event_ts": "2025-01-01 10:00:00"}), "t", n)
    first, second = sorted(files.children(spark, f"{warehouse.raw.path}/_runs"))
    files.remove(spark, f"{warehouse.raw.path}/_runs/{second}")
    assert rows_of(warehouse.raw.read(), "event_id") == [("0",)]
    files.remove(spark, f"{warehouse.raw.path}/_runs/{first}")
    assert warehouse.raw.read().count() == 0


def test_overwriting_bootstrap_leaves_no_user_star(spark, root):
    warehouse = Warehouse(spark, root)
    bootstrap(warehouse, RUN_TS)
    raw = fixtures.raw(spark, "/root/testdata/sf0.001")
    warehouse.raw.write_run(raw, "t", 0)
    silver_run(warehouse, RUN_TS)
    user_star_run(warehouse, raw, RUN_TS)
    assert warehouse.users().count() and warehouse.user_fact.read().count()
    bootstrap(warehouse, RUN_TS, overwrite=True)
    for table in (warehouse.user_current, warehouse.user_closed, warehouse.user_fact, warehouse.run_counts, warehouse.fact):
        assert table.read().count() == 0
    assert mark(warehouse, watermark.RAW_TO_SILVER) == at(watermark.EPOCH)


def test_many_failed_tries_lose_no_version(spark, root, monkeypatch):
    raw = fixtures.raw(spark, "/root/testdata/sf0.01")
    first, _ = fixtures.two_batches(raw)
    whole, broken = Warehouse(spark, f"{root}/a"), Warehouse(spark, f"{root}/b")
    for warehouse in (whole, broken):
        user_star_run(warehouse, first, RUN_TS)
    with monkeypatch.context() as patch:
        patch.setattr(silver.scd2, "fact_user_watch", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        for _ in range(5):
            with pytest.raises(OSError):
                user_star_run(broken, raw, RUN_TS)
    for warehouse in (whole, broken):
        user_star_run(warehouse, raw, RUN_TS)
    assert users_of(whole) == users_of(broken)
