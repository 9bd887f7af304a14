import json
from datetime import timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallystar import schemas
from tallystar.plans.warehouse import Warehouse
from tallystar.sources import files
from tallystar.sources.streams import stream_source
from tallystar.sources.tables import AppendTable
from tallystar.streaming.ingest import RawIngest, ShapeIngest, start_ingest
from tallystar.streaming.windows import stream_dedupe, stream_watch_15min
from tests.util import at, rows_of


def message(n, **more):
    return json.dumps({"event_id": f"e{n}", "event_ts": f"2025-01-01 00:00:{n:02d}", **more})


def drop(spark, inbox, *lines):
    """One more text file for the stream."""
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    frame.coalesce(1).write.mode("append").text(inbox)


def test_ingest_restarts_without_doubling(spark, root):
    inbox, warehouse = f"{root}/inbox", Warehouse(spark, f"{root}/w")

    def run():
        source = stream_source(spark, "text", path=inbox)
        start_ingest(
            source, RawIngest(warehouse), f"{root}/check", available_now=True
        ).awaitTermination()

    drop(spark, inbox, message(1), message(2, event_ts="never"), "junk")
    run()
    run()
    drop(spark, inbox, message(3), message(1))
    run()
    assert rows_of(warehouse.raw.read(), "event_id") == [("e1",), ("e1",), ("e3",)]
    assert warehouse.errors.read().count() == 1
    assert rows_of(warehouse.quarantine.read(), "value", "reason") == [("junk", "not json")]
    counts = warehouse.batch_counts.read()
    assert rows_of(counts, "inserted", "skipped", "quarantined") == [(1, 1, 1), (2, 0, 0)]


def test_replayed_batch_adds_nothing_and_empty_batch_writes_nothing(spark, root):
    warehouse = Warehouse(spark, root)
    writer = RawIngest(warehouse, source="s")
    batch = spark.createDataFrame([(message(1),), ("junk",)], "value string")
    writer(batch.where("false"), 0)
    assert not files.exists(spark, warehouse.raw.path)
    for _ in range(2):
        writer(batch, 1)
    assert warehouse.raw.read().count() == 1
    assert warehouse.quarantine.read().count() == 1
    writer(batch, 2)
    assert warehouse.raw.read().count() == 2
    assert warehouse.meta_counts.read().count() == 0


def test_batch_size_is_registered_on_request(spark, root):
    warehouse = Warehouse(spark, root)
    writer = RawIngest(warehouse, source="s", register_size=True)
    for n, lines in enumerate(([message(1), message(2)], [message(3)])):
        writer(spark.createDataFrame([(v,) for v in lines], "value string"), n)
    row = warehouse.meta_counts.read().collect()
    assert [(r.table_name, r.record_count) for r in row] == [("etl.raw_user_stream_events", 1)]
    warehouse.register_counts("2025-01-01 00:00:00")
    counts = warehouse.meta_counts.read()
    assert counts.count() == 9
    assert rows_of(counts.where("table_type = 'raw'"), "record_count") == [(3,)]


def test_a_new_query_never_overwrites_an_older_one(spark, root):
    inbox, warehouse = f"{root}/inbox", Warehouse(spark, f"{root}/w")
    drop(spark, inbox, message(1))
    for n in range(2):
        source = stream_source(spark, "text", path=inbox)
        start_ingest(
            source, RawIngest(warehouse), f"{root}/check{n}", available_now=True
        ).awaitTermination()
    assert warehouse.raw.read().count() == 2


def test_other_shapes_with_required_columns(spark, root):
    table = AppendTable(spark, root, "live", schemas.LIVE_EVENT, ("source", "batch_id"))
    rejects = AppendTable(spark, root, "rejects", schemas.LIVE_EVENT, ("source", "batch_id"))
    broken = AppendTable(spark, root, "broken", schemas.QUARANTINE, ("source", "batch_id"))
    names = schemas.LIVE_EVENT.names
    writer = ShapeIngest(table, rejects, broken, schemas.LIVE_EVENT, names, source="test")
    good = {"id": 1, "username": "u", "watch_time": 2.0, "country": "IN", "timestamp": "t"}
    lines = [json.dumps(good), json.dumps({**good, "country": None}), "junk"]
    for _ in range(2):
        counts = writer(spark.createDataFrame([(v,) for v in lines], "value string"), 0)
    assert counts == {"live": 1, "rejects": 1, "broken": 1}
    assert rows_of(table.read(), "id") == [(1,)]
    assert rejects.read().count() == 1
    assert rows_of(broken.read(), "value") == [("junk",)]


def test_kafka_is_only_an_option_away(spark):
    try:
        source = stream_source(spark, topic="live_stream", servers="localhost:9092")
    except AnalysisException as error:
        assert "kafka" in str(error).lower()  # no connector on this classpath
    else:
        assert source.columns == ["value"]


EVENT = "event_id string, event_ts timestamp_ntz, watch_time double"


def collect_stream(spark, root, build, *batches):
    """Feed one file per batch, in order, and return what the sink holds after each."""
    inbox, out, seen = f"{root}/inbox", f"{root}/out", []
    schema = None
    for n, batch in enumerate(batches):
        rows = [(i, at(ts), w) for i, ts, w in batch]
        spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(inbox)
        stream = build(stream_source(spark, "parquet", path=inbox, schema=EVENT))
        schema = stream.schema
        stream.writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", f"{root}/check"
        ).trigger(availableNow=True).start().awaitTermination()
        seen.append(spark.read.schema(schema).parquet(out))
        seen[n] = rows_of(seen[n], *seen[n].columns)
    return seen


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_windows_close_past_the_delay_and_late_rows_are_dropped(spark, root, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        seen = collect_stream(
            spark,
            root,
            lambda s: stream_watch_15min(s, "10 minutes"),
            [("1", "2025-03-09 02:01:00", 1.5), ("2", "2025-03-09 02:14:59", 2.0)],
            [("3", "2025-03-09 02:40:00", 4.0)],
            [("late", "2025-03-09 02:02:00", 9.0), ("4", "2025-03-09 04:00:00", 1.0)],
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    first = (at("2025-03-09 02:00:00"), 2, 3.5)
    assert seen[0] == []
    assert seen[1] == [first]
    assert seen[2] == [first, (at("2025-03-09 02:30:00"), 1, 4.0)]


def test_dedupe_keeps_an_id_whose_first_copy_is_too_late(spark, root):
    seen = collect_stream(
        spark,
        root,
        lambda s: stream_dedupe(s, "10 minutes"),
        [("a", "2025-01-01 10:00:00", 1.0)],
        [("z", "2025-01-01 08:00:00", 1.0), ("z", "2025-01-01 10:01:00", 2.0)],
    )
    assert [r[0] for r in seen[-1]] == ["a", "z"]


def test_dedupe_within_the_delay(spark, root):
    seen = collect_stream(
        spark,
        root,
        lambda s: stream_dedupe(s, "10 minutes"),
        [("1", "2025-01-01 00:00:00", 1.0), ("1", "2025-01-01 00:00:00", 1.0), (None, "2025-01-01 00:00:00", 1.0)],
        [("1", "2025-01-01 00:05:00", 1.0), ("2", "2025-01-01 00:05:00", 1.0)],
        [("2", "2025-01-01 00:06:00", 1.0)],
    )
    assert [[r[0] for r in rows] for rows in seen] == [["1"], ["1", "2"], ["1", "2"]]


def test_trigger_interval(spark, root):
    inbox, warehouse = f"{root}/inbox", Warehouse(spark, f"{root}/w")
    drop(spark, inbox, message(1))
    query = start_ingest(
        stream_source(spark, "text", path=inbox),
        RawIngest(warehouse),
        f"{root}/check",
        interval="1 second",
        output_mode="append",
    )
    query.processAllAvailable()
    query.stop()
    assert warehouse.raw.read().select(F.max("event_ts")).first()[0] == at(
        "2025-01-01 00:00:01"
    ) + timedelta(0)


def test_replayed_batches_are_cut_without_a_join_and_kept_once(spark, sf):
    from checks import fixtures
    from tallystar.operators import decode

    whole = fixtures.messages(spark, sf)
    parts = fixtures.two_batches(fixtures.messages(spark, sf, timed=True))
    assert sum(p.count() for p in parts) == whole.count()
    for part in parts:
        kept = decode.outcome(part.select("value"))
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan
        assert kept.where("status = 'ok' AND value IS NOT NULL").isEmpty()
        assert not kept.where("status = 'quarantine' AND value IS NOT NULL").isEmpty()
