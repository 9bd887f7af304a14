"""Day-first tables, compaction, replays; tables by buckets."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from checks import fixtures
from tallystar import schemas
from tallystar.operators import scd2
from tallystar.operators.watermark import incremental_load
from tallystar.plans import silver
from tallystar.plans.silver import silver_run, user_history_run, user_star_run
from tallystar.plans.warehouse import Warehouse
from tallystar.sources import files
from tallystar.sources.tables import AppendTable, BucketTable
from tests.util import RUN_TS, at, raw_frame, rows_of

COLUMNS = ("event_id", "event_ts")


def table_of(spark, root, *columns):
    return AppendTable(spark, root, "raw", schemas.RAW, columns or ("source", "batch_id"), date_from="event_ts")


def event(n, day, hour=0, **more):
    return {"event_id": str(n), "event_ts": f"2025-01-{day:02d} {hour:02d}:00:00", **more}


def days_of(rows):
    return {p.split("event_date=")[1].split("/")[0] for p in rows.inputFiles()}


def test_a_load_lists_the_days_after_the_mark_only(spark, root):
    """40 runs of three days each, over 20 days."""
    table = table_of(spark, root)
    for n in range(40):
        table.write_run(raw_frame(spark, *[event(3 * n + k, 1 + (n + k) % 20, n % 24) for k in range(3)]), "s", n)
    whole = rows_of(table.read(), *COLUMNS)
    assert len(whole) == 120
    mark = at("2025-01-19 12:00:00")
    load = lambda: incremental_load(table.read(prunable=True, since=mark), mark)
    new = rows_of(load(), *COLUMNS)
    assert new == [r for r in whole if r[1] > mark]
    assert days_of(load()) == {"2025-01-19", "2025-01-20"}
    assert table.compact(date(2025, 1, 19)) == 18
    assert rows_of(table.read(), *COLUMNS) == whole and rows_of(load(), *COLUMNS) == new
    # A file a closed day; runs that lie in closed days only have left the list.
    assert len(table.read().inputFiles()) == 18 + sum(r[1] >= at("2025-01-19 00:00:00") for r in whole)
    assert len(files.children(spark, f"{table.path}/_runs")) < 20
    # Nothing new, nothing to do; then the rest.
    assert table.compact(date(2025, 1, 19)) == 0
    assert table.compact() == 2
    assert rows_of(table.read(), *COLUMNS) == whole
    table.write_run(raw_frame(spark, event(1000, 3)), "s", 1000)
    assert table.compact() == 1
    assert len(rows_of(table.read(), *COLUMNS)) == 121
    # What a base replaces goes with the next one.
    assert len([n for n in files.children(spark, f"{table.path}/event_date=2025-01-03") if n.startswith("rows=")]) == 3


def test_a_replay_never_hides_its_run(spark, root, monkeypatch):
    table = table_of(spark, root)
    table.write_run(raw_frame(spark, event(1, 1, username="old"), event(2, 2, username="old")), "s", 0)
    again = raw_frame(spark, event(1, 1, username="new"), event(3, 3, username="new"))
    with monkeypatch.context() as patch:
        patch.setattr(files, "create", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.write_run(again, "s", 0)
    assert rows_of(table.read(), "event_id", "username") == [("1", "old"), ("2", "old")]
    table.write_run(again, "s", 0)
    assert rows_of(table.read(), "event_id", "username") == [("1", "new"), ("3", "new")]


@pytest.mark.parametrize("closed", [None, date(2025, 1, 3)])
def test_a_replay_replaces_what_was_merged(spark, root, closed):
    table = table_of(spark, root, "run_id")
    old = [event(1, 1), event(2, 2), event(3, 5)]
    table.write_run(raw_frame(spark, *old), "a")
    table.write_run(raw_frame(spark, event(4, 1)), "b")
    table.compact(closed)
    table.write_run(raw_frame(spark, event(5, 2)), "c")
    assert rows_of(table.read(without_run="a"), "event_id") == [("4",), ("5",)]
    table.write_run(raw_frame(spark, event(1, 1), event(6, 2)), "a")
    want = [("1",), ("4",), ("5",), ("6",)]
    assert rows_of(table.read(), "event_id") == want
    for _ in range(2):
        table.compact(closed)
        assert rows_of(table.read(), "event_id") == want
        assert rows_of(table.read(since=at("2025-01-02 00:00:00")), "event_id") == [("5",), ("6",)]
    table.write_run(raw_frame(spark, event(7, 1)), "a")
    assert rows_of(table.read(), "event_id") == [("4",), ("5",), ("7",)]
    table.compact()
    assert rows_of(table.read(), "event_id") == [("4",), ("5",), ("7",)]
    assert rows_of(table.read(without_run="a"), "event_id") == [("4",), ("5",)]


def test_names_of_runs_may_hold_anything(spark, root):
    table = table_of(spark, root)
    odd = ["a/b", "a,b", "a~b", "é %2F", "-", ""]
    for n, name in enumerate(odd):
        table.write_run(raw_frame(spark, event(n, 1)), name, "x,y")
    table.write_run(raw_frame(spark, event(99, 1)), "a", "b,x,y")
    assert table.read().count() == len(odd) + 1
    table.compact()
    assert rows_of(table.read(without_run="a,b"), "event_id") == sorted([("0",), ("2",), ("3",), ("4",), ("5",), ("99",)])


def test_rows_without_a_time_and_tables_without_days(spark, root):
    table = table_of(spark, root)
    table.write_run(raw_frame(spark, event(1, 1), {"event_id": "2", "event_ts": None}), "s", 0)
    table.write_run(raw_frame(spark, {"event_id": "3", "event_ts": None}), "s", 1)
    assert table.compact(date(2025, 1, 1)) == 1
    assert rows_of(table.read(), "event_id") == [("1",), ("2",), ("3",)]
    assert rows_of(table.read(since=at("2025-01-01 00:00:00")), "event_id") == [("1",)]
    counts = AppendTable(spark, root, "counts", schemas.RUN_COUNTS)
    assert counts.read().count() == 0 and counts.compact() == 0
    for n in range(3):
        counts.write_run(spark.createDataFrame([("step", n)], schemas.RUN_COUNTS), f"r{n}")
    assert counts.compact() == 1 and len(counts.read().inputFiles()) == 1
    counts.write_run(spark.createDataFrame([("step", 9)], schemas.RUN_COUNTS), "r1")
    assert rows_of(counts.read(), "row_count") == [(0,), (2,), (9,)]


def test_silver_runs_between_compactions(spark, sf, root):
    raw = fixtures.raw(spark, sf)
    cuts = ["2023-12-31", "2024-01-10", "2024-01-20", "2024-02-01"]
    plain, merged = Warehouse(spark, f"{root}/a"), Warehouse(spark, f"{root}/b")
    for n, (low, high) in enumerate(zip(cuts, cuts[1:])):
        part = raw.where(f"event_ts > timestamp_ntz'{low}' AND event_ts <= timestamp_ntz'{high}'")
        for warehouse in (plain, merged):
            warehouse.raw.write_run(part, "t", n)
            silver_run(warehouse, RUN_TS)
        merged.compact(date.fromisoformat(high))
    assert merged.raw.read().count() == 1000
    for name in ("fact", "run_counts"):
        a, b = getattr(plain, name).read(), getattr(merged, name).read()
        assert rows_of(a, *a.columns) == rows_of(b, *b.columns)


# -- buckets ----------------------------------------------------------------------
def versions(spark, *users, name="n"):
    rows = [(f"k{u}", u, name, "d", "a", "r", "c", at("2025-01-01 00:00:00"), at("9999-12-31 23:59:59"), True) for u in users]
    return spark.createDataFrame(rows, schemas.DIM_USER_SCD2)


def test_a_small_batch_rewrites_few_buckets(spark, root):
    table = BucketTable(spark, root, "users", schemas.DIM_USER_SCD2, "user_id")
    assert table.read().count() == 0
    every = versions(spark, *[f"u{n}" for n in range(3000)])
    table.replace(every, table.touched(every), "r1")
    before = table._last(None)
    assert 900 < len(before) <= 1000
    batch = versions(spark, *[f"u{n}" for n in range(10)], name="changed")
    touched = table.touched(batch)
    held = table.read(touched)
    size = held.count()
    assert size < 100
    kept = held.join(batch.select("user_id"), "user_id", "left_anti").select(*held.columns)
    for _ in range(2):  # a retry has the versions from before its first try
        assert table.read(touched, before_run="r2").where("username = 'changed'").count() == 0
        table.replace(kept.unionByName(batch), touched, "r2")
    after = table._last(None)
    assert sum(after[b] != before[b] for b in before) == len(touched) <= 10
    assert table.read().count() == 3000 and table.read().where("username = 'changed'").count() == 10
    for n in range(5):  # older versions go, the rows that are needed stay
        table.replace(table.read(touched), touched, f"s{n}")
    assert len(files.children(spark, f"{table.path}/_versions")) <= 4
    assert table.read().count() == 3000
    table.replace(versions(spark), touched, "none")
    assert table.read().count() == 3000 - size


def test_user_star_rewrites_the_batchs_buckets_only(spark, root):
    warehouse = Warehouse(spark, root)
    first = raw_frame(spark, *[event(n, 1, user_id=f"U{n}", username="a") for n in range(300)])
    user_star_run(warehouse, first, RUN_TS)
    before = warehouse.user_current._last(None)
    more = first.unionByName(raw_frame(spark, *[event(1000 + n, 2, user_id=f"U{n}", username="b") for n in range(10)]))
    assert user_star_run(warehouse, more, RUN_TS) == {"inserts": 10, "updates": 10}
    after = warehouse.user_current._last(None)
    assert sum(after[b] != before[b] for b in before) <= 10
    assert warehouse.users().count() == 310


# -- event-grain versions in batches ------------------------------------------------
def history(rows):
    return rows_of(rows, *schemas.DIM_USER_SCD2.names)


def test_history_does_not_depend_on_batches(spark, root, monkeypatch):
    raw = fixtures.raw(spark, "/root/testdata/sf0.001").where("event_ts IS NOT NULL")
    first, second = fixtures.two_batches(raw)
    late = F.pmod(F.xxhash64("event_id"), F.lit(7)) == 0
    steps = [first.where(~late), first.where(~late).unionByName(second.where(~late)), raw]
    warehouse = Warehouse(spark, root, user_buckets=16)
    for n, rows in enumerate(steps):
        with monkeypatch.context() as patch:
            patch.setattr(silver, "_save_mark", lambda *a: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                user_history_run(warehouse, rows, RUN_TS, lateness="60 days")
        assert user_history_run(warehouse, rows, RUN_TS, lateness="60 days")["events"] > 0
        assert history(warehouse.user_versions.read()) == history(scd2.scd2_history(rows))
    assert user_history_run(warehouse, raw, RUN_TS, lateness="60 days") == {}
    assert warehouse.user_events.read().count() == raw.count()
    want = scd2.fact_user_watch(raw, scd2.scd2_history(raw))
    assert rows_of(warehouse.user_facts(), "event_id", "user_sk") == rows_of(want, "event_id", "user_sk")


@pytest.mark.parametrize("seed", range(3))
def test_late_events_split_and_remove_versions(spark, root, seed):
    import random

    rng = random.Random(seed)
    events = [
        event(n, rng.randint(1, 4), rng.randint(0, 5), user_id=rng.choice(["U1", "U2", None]), username=rng.choice("ab"))
        for n in range(40)
    ]
    rng.shuffle(events)
    warehouse = Warehouse(spark, root, user_buckets=4)
    for cut in (10, 20, 40):
        rows = raw_frame(spark, *events[:cut])
        user_history_run(warehouse, rows, RUN_TS, lateness="30 days")
        assert history(warehouse.user_versions.read()) == history(scd2.scd2_history(rows))


# -- what the runs cost --------------------------------------------------------------
def test_a_bucket_table_has_files_by_size_and_sheds_what_is_replaced(spark, root):
    table = BucketTable(spark, root, "users", schemas.DIM_USER_SCD2, "user_id", 100)
    every = versions(spark, *[f"u{n}" for n in range(1000)])
    table.replace(every, table.touched(every), "r0")
    for n in range(1, 12):  # each run replaces a sixth of the buckets, other ones each time
        some = table.touched(every)[n % 6 :: 6]
        rows = table.read(some).withColumn("username", F.lit(f"r{n}"))
        table.replace(rows, some, f"r{n}")
        assert table.read().count() == table.read().distinct().count() == 1000
        assert table.read(some).where(f"username = 'r{n}'").count() == table.read(some).count() > 0
        tokens = set(table._last(None).values())
        # of what is stored, at least half is needed
        assert sum(int(t.rpartition("-")[2]) for t in tokens) <= 2 * len(table._last(None))
        size = sum(1 for f in table.read().inputFiles())
        assert size <= 2 * len(tokens)


def test_user_facts_of_a_run_are_joined(spark):
    """Users of a run have two versions at most: no window over their events, and the result of the sorted pass."""
    from datetime import timedelta

    first = at("2025-01-01 00:00:00")
    rows = [event(n, 1, n % 20, user_id=None if n % 11 == 0 else f"U{n % 3}") for n in range(60)]
    events = raw_frame(spark, *rows)
    lows = [(f"U{u}", first + timedelta(days=d)) for u in range(2) for d in (-1, 0)]
    held = [(f"{u}-{low}", u, low, low + timedelta(days=1)) for u, low in lows]
    held = spark.createDataFrame(held, "user_sk string, user_id string, effective_from timestamp_ntz, effective_to timestamp_ntz")
    few = scd2.fact_user_watch(events, held, few=True)
    assert "Window" not in few._jdf.queryExecution().optimizedPlan().toString()
    sorted_ = scd2.fact_user_watch(events, held)
    assert rows_of(few, "event_id", "user_sk") == rows_of(sorted_, "event_id", "user_sk")
