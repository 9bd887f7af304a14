from types import SimpleNamespace

import pytest

from tallystar import schemas
from tallystar.functions.timestamps import as_wall_clock
from tallystar.operators.dims import COMPANY
from tallystar.operators.facts import fact_project
from tallystar.sources import files
from tallystar.sources.csv_snapshots import csv_export, csv_export_days, csv_scan
from tallystar.sources.tables import KEPT_VERSIONS, AppendTable, SnapshotTable, not_before
from tests.util import raw_frame, rows_of

ROW = ("C1", "Acme", "General")


def companies(spark, *rows):
    return spark.createDataFrame(list(rows), COMPANY.schema)


def test_snapshot_may_replace_what_it_reads(spark, root):
    table = SnapshotTable(spark, root, "dim_company", COMPANY.schema)
    assert table.read().count() == 0
    table.replace(companies(spark, ROW))
    for n in range(5):
        more = companies(spark, (f"X{n}", "x", "y"))
        table.replace(table.read().unionByName(more))
    assert table.read().count() == 6
    kept = [c for c in files.children(spark, table.path) if c.startswith("v=")]
    assert len(kept) == KEPT_VERSIONS


def test_broken_snapshot_is_not_seen(spark, root):
    table = SnapshotTable(spark, root, "dim_company", COMPANY.schema)
    table.replace(companies(spark, ROW))
    companies(spark, ROW, ROW).write.parquet(f"{table.path}/v=00000002")
    files.remove(spark, f"{table.path}/v=00000002/_SUCCESS")
    assert table.read().count() == 1
    table.replace(companies(spark, ROW, ROW, ROW))
    assert table.read().count() == 3


def test_snapshot_before_a_run(spark, root):
    table = SnapshotTable(spark, root, "dim_company", COMPANY.schema)
    table.replace(companies(spark, ROW))
    table.replace(companies(spark, ROW, ROW), "r1")
    table.replace(companies(spark, ROW, ROW, ROW), "r1")
    assert table.read().count() == 3
    assert table.read(before_run="r1").count() == 1


def test_ensure_keeps_and_recreate_drops(spark, root):
    for table, fill in (
        (snapshot := SnapshotTable(spark, root, "s", COMPANY.schema), lambda t, r: t.replace(r)),
        (AppendTable(spark, root, "a", COMPANY.schema), lambda t, r: t.write_run(r, "r1")),
    ):
        table.ensure()
        assert table.read().count() == 0
        fill(table, companies(spark, ROW))
        table.ensure()
        assert rows_of(table.read(), *COMPANY.schema.names) == [ROW]
        table.recreate()
        assert table.read().count() == 0
        assert table.read().schema.names == COMPANY.schema.names
    assert snapshot.name == "s"


def test_run_is_replaced_and_dates_prune(spark, root):
    table = AppendTable(
        spark, root, "raw", schemas.RAW, ("source", "batch_id"), date_from="event_ts"
    )
    raw = raw_frame(
        spark,
        {"event_id": "1", "event_ts": "2025-01-01 10:00:00"},
        {"event_id": "2", "event_ts": "2025-01-02 10:00:00"},
        {"event_id": "3", "event_ts": None},
    )
    table.write_run(raw, "s", 1)
    table.write_run(raw, "s", 1)
    table.write_run(raw.where("event_id = '1'"), "s", 2)
    assert table.read().count() == 4
    assert table.read(without_run="s").count() == 0
    assert table.read().columns == schemas.RAW.names
    late = not_before(table.read(prunable=True), as_wall_clock("2025-01-02 00:00:00"))
    assert rows_of(late, "event_id") == [("2",)]
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "GreaterThanOrEqual(event_second,1735776000)" in plan
    with pytest.raises(ValueError):
        table.write_run(raw, "s")


def test_csv_dialect(spark, root):
    rows = companies(spark, ("C1", 'say "hi", all', " padded "), ("C2", "a\nb", None))
    written = csv_export({"etl.dim_company": rows, "dim_none": rows.where("false")}, root, one_file={"etl.dim_company"})
    assert written == [f"{root}/dim_company.csv"]
    assert not files.exists(spark, f"{root}/dim_none.csv")
    text = b"".join(r.content for r in spark.read.format("binaryFile").load(written[0]).collect())
    assert text == (
        b"company_id,company_name,industry\r\n"
        b'C1,"say ""hi"", all", padded \r\n'
        b'C2,"a\r\nb",\r\n'
    )
    again = csv_scan(spark, written[0], COMPANY.schema)
    assert rows_of(again, *again.columns) == rows_of(rows, *rows.columns)


def test_csv_round_trip(spark, root, sf):
    from checks import fixtures
    from tallystar.operators.facts import fact_project

    fact = fact_project(fixtures.raw(spark, sf), "2024-02-01 00:00:00")
    csv_export({"fact": fact}, root)
    again = csv_scan(spark, f"{root}/fact.csv", schemas.FACT_USER_ACTIVITY)
    assert rows_of(again, *fact.columns) == rows_of(fact, *fact.columns)


def test_shared_dir_follows_the_session(spark):
    assert files.shared_dir(spark, "a") != files.shared_dir(spark, "a")

    def session(master, base):
        settings = {"spark.checkpoint.dir": base} if base else {}
        return SimpleNamespace(
            conf=SimpleNamespace(get=settings.get), sparkContext=SimpleNamespace(master=master)
        )

    named = files.shared_dir(session("yarn", "hdfs://x/shared/"), "job")
    assert named.startswith("hdfs://x/shared/job-")
    with pytest.raises(ValueError):
        files.shared_dir(session("yarn", None), "job")


def test_exports_write_changed_days_only(spark, root):
    table = AppendTable(spark, f"{root}/w", "fact", schemas.FACT_USER_ACTIVITY, date_from="event_ts")

    def run(name, *days):
        events = [{"event_id": f"{name}{d}", "event_ts": f"2025-01-{d:02d} 10:00:00", "username": 'a "b"\nc'} for d in days]
        table.write_run(fact_project(raw_frame(spark, *events), "2025-02-01 00:00:00"), name)

    def exported():
        path = f"{root}/csv/fact.csv"
        rows = csv_scan(spark, path, schemas.FACT_USER_ACTIVITY)
        assert rows_of(rows, *rows.columns) == rows_of(table.read(), *rows.columns)
        return {d: files.children(spark, f"{path}/{d}") for d in files.children(spark, path) if d.startswith("event_date=")}

    assert csv_export_days(table, f"{root}/csv") == 0
    run("a", 1, 2, 3)
    run("b", 3, 4)
    assert csv_export_days(table, f"{root}/csv") == 4
    before = exported()
    assert csv_export_days(table, f"{root}/csv") == 0
    run("c", 4, 5)
    run("d", 4)
    assert csv_export_days(table, f"{root}/csv") == 2
    after = exported()
    assert {d for d in after if after[d] != before.get(d)} == {"event_date=2025-01-04", "event_date=2025-01-05"}
    # A replay may have changed any day; compaction changes files, not rows.
    run("a", 2, 3)
    run("e", 1)
    table.compact()
    assert csv_export_days(table, f"{root}/csv") == 5
    exported()
