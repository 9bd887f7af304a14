import json

import pytest

from tallystar import schemas
from tallystar.operators import decode
from tests.util import rows_of

GOOD = {"event_id": "e1", "event_ts": "2025-01-01 10:00:00", "watch_time": 2.5, "lat": "1.5"}


def payloads(spark, *values):
    rows = [(v.encode() if isinstance(v, str) else v,) for v in values]
    return spark.createDataFrame(rows, "value binary")


@pytest.mark.parametrize(
    ("payload", "reason"),
    [
        ("not json", "not json"),
        ("", "not json"),
        ("[1,2]", "not a json object"),
        ('[{"event_id":"x"}]', "not a json object"),
        ("123", "not a json object"),
        ("null", "not a json object"),
        ('"text"', "not a json object"),
        (None, "null payload"),
        (b"\xff{}", "not utf-8"),
        ('{"event_id":"x"', "malformed json"),
        ('{"event_id":"x"} tail', "malformed json"),
        ('{"event_id":"x"}{"event_id":"y"}', "malformed json"),
        ("{'event_id':'x'}", "malformed json"),
        ('{"event_id":"x"},{"event_id":"y"}', "malformed json"),
        ('{"event_id":"x"}', None),
        (' {"event_id":"x"} ', None),
        ("{}", None),
    ],
)
def test_one_object_per_payload(spark, payload, reason):
    rows = decode.json_decode(payloads(spark, payload), schemas.EVENT_TEXT).collect()
    assert [r["reason"] for r in rows] == [reason]
    kept = decode.quarantine(payloads(spark, payload), schemas.EVENT_TEXT).count()
    assert kept == (reason is not None)


def test_fields_and_measures(spark):
    lines = [
        json.dumps({**GOOD, "extra": 1}),
        json.dumps({**GOOD, "event_id": "e2", "watch_time": "x", "lat": None}),
        '{"event_id": "e3", "event_ts": "2025-01-01 10:00:00", "watch_time": NaN, "lat": -Infinity}',
    ]
    raw = decode.raw_rows(decode.classify(payloads(spark, *lines)), "2025-01-02 00:00:00")
    assert raw.columns == schemas.RAW.names
    got = {r["event_id"]: r for r in raw.collect()}
    assert (got["e1"].watch_time, got["e1"].lat, got["e1"].lon) == (2.5, 1.5, 0.0)
    assert (got["e2"].watch_time, got["e2"].lat) == (0.0, 0.0)
    assert got["e3"].watch_time != got["e3"].watch_time and got["e3"].lat == float("-inf")
    assert str(got["e1"].ingestion_ts) == "2025-01-02 00:00:00"
    assert got["e1"].user_id is None


def test_bad_timestamp_is_an_error_and_null_is_not(spark):
    lines = [
        json.dumps({"event_id": "bad", "event_ts": "yesterday"}),
        json.dumps({"event_id": None, "event_ts": "never"}),
        json.dumps({"event_id": "none", "event_ts": None}),
        json.dumps({"event_ts": "2025-01-01 00:00:00"}),
        "oops",
    ]
    found = decode.classify(payloads(spark, *lines))
    assert decode.batch_counts(found).first().asDict() == {
        "inserted": 2,
        "skipped": 2,
        "quarantined": 1,
    }
    texts = [r.description for r in decode.stream_errors(found).collect()]
    assert any("event bad" in t for t in texts) and any("event None" in t for t in texts)


def test_every_message_has_one_state(spark, sf):
    from checks import fixtures

    messages = fixtures.messages(spark, sf, bad_times=True)
    found = decode.classify(messages).persist()
    counts = decode.batch_counts(found).first()
    assert sum(counts) == messages.count()
    assert decode.raw_rows(found).count() == counts["inserted"]
    assert decode.stream_errors(found).count() == counts["skipped"]
    assert decode.quarantined(found).count() == counts["quarantined"]
    found.unpersist()


def test_ingest_stamp_now_is_whole_seconds(spark):
    stamp = spark.range(1).select(decode.ingest_stamp().alias("t"))
    assert dict(stamp.dtypes)["t"] == "timestamp_ntz" and stamp.first().t.microsecond == 0


def test_strict_measures_skip_the_row(spark):
    lines = [
        json.dumps({"event_id": "ok", "watch_time": 1, "lat": 2, "lon": 3}),
        json.dumps({"event_id": "missing", "watch_time": 1, "lat": 2}),
        json.dumps({"event_id": "text", "watch_time": "x", "lat": 2, "lon": 3}),
    ]
    typed = decode.decoded(payloads(spark, *lines), schemas.EVENT_TYPED)
    kept, errors = decode.strict_measures(typed, "watch_time", "lat", "lon")
    assert rows_of(kept, "event_id") == [("ok",)]
    assert errors.count() == 2


def test_required_columns(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (None, None)], "id int, name string")
    kept, rejected = decode.split_required(rows, "id", "name")
    assert (kept.count(), rejected.count()) == (1, 2)


def test_payload_is_parsed_once(spark):
    plan = decode.raw_rows(decode.classify(payloads(spark, "{}")))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == 1


def test_older_shapes(spark):
    sensor = {"timestamp": "t", "location": "x", "temperature": 1.0, "humidity": 2, "wind_speed": 3}
    live = {"id": 7, "username": "u", "watch_time": 1.5, "country": "IN", "timestamp": "t"}
    one = decode.decoded(payloads(spark, json.dumps(sensor)), schemas.SENSOR_EVENT).first()
    two = decode.decoded(payloads(spark, json.dumps(live)), schemas.LIVE_EVENT).first()
    assert (one.location, one.humidity) == ("x", 2.0)
    assert (two.id, two.watch_time) == (7, 1.5)
    assert len(schemas.USER_EVENT) == 13 and len(schemas.EVENT_TEXT) == 24


@pytest.mark.parametrize("tail", ["]garbage", "]", "},{", "]]", ",", '],["x"', "]}", ",{}", '],[{"event_id":"x"}' ])
def test_text_after_the_object_is_malformed(spark, tail):
    rows = spark.createDataFrame([('{"event_id":"g"}' + tail,), ('{"event_id":"h"} \n',)], "value string")
    assert rows_of(decode.decoded(rows, schemas.EVENT_TEXT), "event_id") == [("h",)]


def test_times_that_no_wall_clock_holds_are_errors(spark):
    times = ["+12345-01-01 00:00:00", "2025", "2025-01", "0000-01-01 00:00:00", "12345-01-01", "yesterday"]
    good = ["2025-01-01", "2025-1-2 3:04:05", "2025-01-01T00:00:00.750Z", "2025-01-01 10:00:00+05:30", "9999-12-31 23:59:59"]
    rows = spark.createDataFrame([('{"event_id":"%s","event_ts":"%s"}' % (t, t),) for t in times + good], "value string")
    kinds = {r.data.event_id: r.status for r in decode.classify(rows).collect()}
    assert kinds == {t: decode.ERROR for t in times} | {t: decode.OK for t in good}
    stored = {r.event_id: r.event_ts for r in decode.raw_rows(decode.classify(rows), "2025-01-01").collect()}
    assert all(t.microsecond == 0 for t in stored.values())
