"""Registered queries: one per operator, each over the whole ``events`` table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures
from tallystar import schemas
from tallystar.functions import (
    epoch_seconds,
    normalize_ts,
    safe_float,
    surrogate_key,
    time_bucket_key,
)
from tallystar.operators import (
    analytics,
    calendar,
    catalog,
    decode,
    dims,
    facts,
    quality,
    scd2,
    seeds,
    watermark,
)
from tallystar.operators.rank import written
from tallystar.plans import silver
from tallystar.plans.silver import silver_run
from tallystar.plans.warehouse import Warehouse, bootstrap
from tallystar.sources import csv_snapshots, files
from tallystar.sources.streams import stream_source
from tallystar.sources.tables import AppendTable, SnapshotTable
from tallystar.streaming.ingest import RawIngest, start_ingest
from tallystar.streaming.windows import stream_dedupe, stream_watch_15min

RUN_TS = "2024-02-01 00:00:00"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def text(column: str) -> Column:
    """A wall clock as text: the open end of a version lies past what pandas holds."""
    return F.col(column).cast("string").alias(column)


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def organisation(events: DataFrame) -> dict[str, DataFrame]:
    return {d.table: d.latest(events) for d in dims.ORGANISATION}


def facts_of(spark, sf) -> DataFrame:
    return facts.fact_project(fixtures.raw(spark, sf), RUN_TS)


def as_files(spark, rows: DataFrame, name: str) -> str:
    """Rows as a directory of Parquet files for a stream to read."""
    path = files.shared_dir(spark, name)
    rows.write.parquet(path)
    return path


def ingested(spark, sf, bad_times=True) -> Warehouse:
    """A warehouse whose RAW was filled by the streaming job."""
    payloads = fixtures.messages(spark, sf, bad_times).select("value")
    inbox = as_files(spark, payloads, "inbox")
    warehouse = Warehouse(spark, files.shared_dir(spark, "warehouse"))
    source = stream_source(spark, "parquet", path=inbox, schema="value string")
    writer = RawIngest(warehouse, ingested_at=RUN_TS)
    start_ingest(
        source, writer, files.shared_dir(spark, "checkpoint"), available_now=True
    ).awaitTermination()
    return warehouse


# -- 2.1 scans, sources, sinks ------------------------------------------------
@query
def stream_source_rows(spark, sf):
    inbox = as_files(spark, fixtures.messages(spark, sf), "inbox")
    out = files.shared_dir(spark, "landed")
    stream = stream_source(spark, "parquet", path=inbox, schema="i bigint, value string")
    stream.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", files.shared_dir(spark, "checkpoint")
    ).trigger(availableNow=True).start().awaitTermination()
    landed = spark.read.schema("i bigint, value string").parquet(out)
    return landed.select("i", "value")


@query
def json_decode(spark, sf):
    rows = decode.decoded(fixtures.messages(spark, sf), schemas.EVENT_TEXT)
    return rows.select(
        *[
            decode.measure(c).alias(c) if c in ("watch_time", "lat", "lon") else F.col(c)
            for c in schemas.EVENT_TEXT.names
        ]
    )


@query
def raw_append(spark, sf):
    return ingested(spark, sf).raw.read()


@query
def raw_append_idempotent(spark, sf):
    warehouse = Warehouse(spark, files.shared_dir(spark, "warehouse"))
    first, second = fixtures.two_batches(fixtures.messages(spark, sf, timed=True))
    writer = RawIngest(warehouse, source="replay", ingested_at=RUN_TS)
    for batch_id, part in ((0, first), (1, second), (1, second), (0, first)):
        writer(part.select("value"), batch_id)
    return warehouse.raw.read(prunable=True).select(*schemas.RAW.names, text("event_date"))


@query
def raw_compact(spark, sf):
    """Runs over all days, a replay, compaction of the closed days, a replay of a merged run, compaction of the rest."""
    table = AppendTable(
        spark, files.shared_dir(spark, "warehouse"), "raw", schemas.RAW, ("source", "batch_id"), date_from="event_ts"
    )
    raw = fixtures.raw(spark, sf)
    part = F.pmod(F.xxhash64("event_id"), F.lit(4))
    for n in (0, 1, 2, 0):
        table.write_run(raw.where(part == n), "test", n)
    table.compact(date(2024, 1, 16))
    for n in (1, 3):
        table.write_run(raw.where(part == n), "test", n)
    table.compact()
    return table.read(prunable=True).select(*schemas.RAW.names, text("event_date"))


@query
def ingest_stamp(spark, sf):
    rows = fixtures.raw(spark, sf).select("event_id", "event_ts")
    stamped = rows.withColumn("ingestion_ts", decode.ingest_stamp(RUN_TS))
    lag = epoch_seconds(F.col("ingestion_ts")) - epoch_seconds(F.col("event_ts"))
    return stamped.select("event_id", "ingestion_ts", lag.alias("lag_seconds"))


@query
def ingest_shapes(spark, sf):
    rows = fixtures.numbered(spark, sf).withColumn(
        "watch_time", F.col("watch_time_raw").try_cast("double")
    )
    stamp = F.col("event_ts").cast("string")

    def payload(*fields):
        return rows.select(
            F.when(F.col("i") % 113 == 0, "not json")
            .otherwise(F.to_json(F.struct(*fields)))
            .alias("value")
        )

    sensor = payload(
        stamp.alias("timestamp"),
        F.col("city").alias("location"),
        F.col("lat").alias("temperature"),
        F.col("lon").alias("humidity"),
        F.col("watch_time").alias("wind_speed"),
    )
    live = payload(
        F.col("i").alias("id"), "username", "watch_time", "country", stamp.alias("timestamp")
    )
    user = payload(
        *[stamp.alias(c) if c == "event_ts" else F.col(c) for c in schemas.USER_EVENT.names]
    )

    def shape(name, messages, schema, key, measure):
        return decode.decoded(messages, schema).select(
            F.lit(name).alias("shape"),
            F.col(key).cast("string").alias("item"),
            F.col(measure).alias("measure"),
        )

    return union(
        [
            shape("sensor", sensor, schemas.SENSOR_EVENT, "location", "temperature"),
            shape("live", live, schemas.LIVE_EVENT, "id", "watch_time"),
            shape("user", user, schemas.USER_EVENT, "event_id", "watch_time"),
        ]
    )


@query
def incremental_load(spark, sf):
    return watermark.incremental_load(fixtures.raw(spark, sf), fixtures.CUT)


@query
def incremental_load_14col(spark, sf):
    raw = fixtures.raw(spark, sf)
    numeric = raw.withColumn("user_id", F.substring("user_id", 2, 20).cast("bigint"))
    return watermark.incremental_load_14col(numeric, fixtures.CUT)


def _exported(spark, sf) -> tuple[str, dict]:
    raw = fixtures.raw(spark, sf)
    tables = organisation(written(dims.last_rows(raw)[0], "heads"))
    tables["fact_user_activity"] = facts.fact_project(raw, RUN_TS)
    tables["dim_nothing"] = raw.where("event_id IS NULL").select("event_id")
    directory = files.shared_dir(spark, "export")
    csv_snapshots.csv_export(tables, directory)
    return directory, tables


def _csv_lines(spark, path: str) -> DataFrame:
    """Lines of a snapshot, each file's header among them."""
    return spark.read.option("lineSep", "\r\n").option("recursiveFileLookup", True).text(path)


@query
def csv_export(spark, sf):
    """Headers, the dimensions' lines as they stand, and how many lines the fact has."""
    directory, tables = _exported(spark, sf)
    reports = []
    for name, rows in tables.items():
        if not files.exists(spark, f"{directory}/{name}.csv"):
            continue
        header = ",".join(rows.columns)
        lines = _csv_lines(spark, f"{directory}/{name}.csv")
        count = lines.agg(F.count_if(F.col("value") != header).alias("row_count"))
        reports.append(count.select(F.lit(name).alias("table_name"), F.lit(header).alias("line"), "row_count"))
        if name != "fact_user_activity":
            reports.append(
                lines.where(F.col("value") != header).select(
                    F.lit(name).alias("table_name"), F.col("value").alias("line"), F.lit(1).cast("long").alias("row_count")
                )
            )
    return union(reports)


@query
def csv_scan(spark, sf):
    """All tables of a snapshot read back."""
    directory, _ = _exported(spark, sf)
    parts = []
    for d in dims.ORGANISATION:
        rows = csv_snapshots.csv_scan(spark, f"{directory}/{d.table}.csv", d.schema)
        parts.append((d.table, rows, d.schema.names, F.lit(0.0)))
    fact = csv_snapshots.csv_scan(spark, f"{directory}/fact_user_activity.csv", schemas.FACT_USER_ACTIVITY)
    described = [c for c in schemas.FACT_USER_ACTIVITY.names if c != "watch_time"]
    parts.append(("fact_user_activity", fact, described, F.col("watch_time")))
    return union(
        [
            rows.select(F.lit(name).alias("table_name"), F.concat_ws("|", *columns).alias("content"), measure.alias("watch_time"))
            for name, rows, columns, measure in parts
        ]
    )


@query
def csv_export_by_days(spark, sf):
    """The fact's snapshot after two runs that export and one between that does not."""
    warehouse = Warehouse(spark, files.shared_dir(spark, "warehouse"))
    directory = files.shared_dir(spark, "export")
    first, second = fixtures.two_batches(fixtures.raw(spark, sf))
    later = F.col("event_ts") > F.lit("2024-01-25").cast("timestamp_ntz")
    for n, (batch, export) in enumerate(((first, directory), (second.where(~later), None), (second.where(later), directory))):
        warehouse.raw.write_run(batch, "test", n)
        silver_run(warehouse, RUN_TS, export_dir=export)
    return csv_snapshots.csv_scan(spark, f"{directory}/fact_user_activity.csv", schemas.FACT_USER_ACTIVITY)


def _table_sizes(table, *steps) -> DataFrame:
    sizes = []
    for name, step in steps:
        step()
        sizes.append((name, table.read().count()))
    return table.spark.createDataFrame(sizes, "step string, row_count bigint")


@query
def table_recreate(spark, sf):
    table = SnapshotTable(
        spark, files.shared_dir(spark, "warehouse"), "dim_employee", schemas.DIM_EMPLOYEE
    )
    rows = dims.EMPLOYEE.latest(fixtures.raw(spark, sf))
    return _table_sizes(
        table, ("filled", lambda: table.replace(rows)), ("recreated", table.recreate)
    )


@query
def table_ensure(spark, sf):
    root = files.shared_dir(spark, "warehouse")
    table = AppendTable(spark, root, "fact", schemas.FACT_USER_ACTIVITY, date_from="event_ts")
    rows = facts_of(spark, sf)
    return _table_sizes(
        table,
        ("missing", table.ensure),
        ("filled", lambda: table.write_run(rows, "r1")),
        ("ensured", table.ensure),
    )


# -- 2.2 projections, filters, cleaning -----------------------------------------
@query
def safe_float_column(spark, sf):
    rows = fixtures.numbered(spark, sf)
    return rows.select("event_id", safe_float(F.col("watch_time_raw")).alias("watch_time"))


@query
def strict_float(spark, sf):
    rows = fixtures.numbered(spark, sf).withColumn(
        "watch_time", F.col("watch_time_raw").try_cast("double")
    )
    payload = F.to_json(F.struct("event_id", "watch_time", "lat", "lon")).alias("value")
    typed = decode.decoded(rows.select(payload), schemas.EVENT_TYPED)
    kept, _ = decode.strict_measures(typed, "watch_time", "lat", "lon")
    return kept.select("event_id", "watch_time", "lat", "lon")


@query
def null_to_zero(spark, sf):
    rows = facts.fact_project(fixtures.raw_text(spark, sf), RUN_TS)
    return rows.select("event_id", "watch_time")


@query
def normalize_ts_column(spark, sf):
    rows = fixtures.numbered(spark, sf)
    stamp = F.col("event_ts").cast("string")
    iso = F.replace(stamp, F.lit(" "), F.lit("T"))
    kind = F.col("i") % 7
    written = (
        F.when(kind == 0, stamp)
        .when(kind == 1, F.concat(iso, F.lit("Z")))
        .when(kind == 2, F.concat(iso, F.lit("+05:30")))
        .when(kind == 3, epoch_seconds(F.col("event_ts")).cast("string"))
        .when(kind == 4, F.lit(None))
        .when(kind == 5, F.concat(stamp, F.lit("+05:30")))
        .otherwise(F.concat(iso, F.lit(".75Z")))
    )
    seconds = epoch_seconds(F.col("event_ts"))
    number = F.when(kind < 4, seconds * 1000 + 500).otherwise(seconds)
    return rows.select(
        "event_id",
        normalize_ts(written, RUN_TS).alias("from_text"),
        normalize_ts(number, RUN_TS, "number").alias("from_number"),
        normalize_ts(F.col("event_ts"), RUN_TS, "wall_clock").alias("from_clock"),
    )


@query
def fact_project(spark, sf):
    return facts.fact_project(fixtures.raw_text(spark, sf), RUN_TS)


@query
def org_columns_select(spark, sf):
    parts = []
    for name, rows in dims.org_columns_select(fixtures.raw(spark, sf)).items():
        parts.append(
            rows.groupBy(*rows.columns)
            .count()
            .select(
                F.lit(name).alias("table_name"),
                F.concat_ws("|", *rows.columns).alias("columns"),
                F.col("count").alias("events"),
            )
        )
    return union(parts)


@query
def required_columns(spark, sf):
    rows = fixtures.raw_text(spark, sf).select("event_id", "username", "watch_time", "country")
    kept, rejected = decode.split_required(rows, "event_id", "username", "watch_time", "country")
    return union(
        [
            part.select("event_id", F.lit(verdict).alias("verdict"))
            for verdict, part in (("kept", kept), ("rejected", rejected))
        ]
    )


# -- 2.3 data quality -------------------------------------------------------------
@query
def stream_errors(spark, sf):
    return decode.stream_errors(decode.classify(fixtures.messages(spark, sf, bad_times=True)))


@query
def quarantine(spark, sf):
    return decode.quarantine(fixtures.messages(spark, sf), schemas.EVENT_TEXT)


@query
def fact_errors(spark, sf):
    return facts.fact_errors(fixtures.raw_text(spark, sf))


@query
def batch_counts(spark, sf):
    rows = fixtures.messages(spark, sf, bad_times=True).withColumn(
        "batch_id", F.floor(F.col("i") / 1000)
    )
    return decode.batch_counts(decode.classify(rows), "batch_id")


@query
def run_counts(spark, sf):
    raw = fixtures.raw(spark, sf)
    steps = {"raw_loaded": raw, **organisation(raw)}
    return quality.run_counts({**steps, "fact_user_activity": facts.fact_project(raw, RUN_TS)})


def _with_copies(spark, sf) -> DataFrame:
    rows = fixtures.numbered(spark, sf)
    later = F.col("ingestion_ts") + F.expr("INTERVAL 1 MINUTE")
    return rows.unionByName(rows.where(F.col("i") % 10 == 0).withColumn("ingestion_ts", later))


@query
def dedupe_by_key(spark, sf):
    held, _ = fixtures.two_batches(fixtures.raw(spark, sf))
    rows = _with_copies(spark, sf).select("event_id", "event_ts", "ingestion_ts", "user_id")
    return quality.dedupe_by_key(rows, "event_id", held)


@query
def stream_dedupe_rows(spark, sf):
    rows = _with_copies(spark, sf).select("event_id", "event_ts", "ingestion_ts", "user_id")
    inbox, out = as_files(spark, rows, "inbox"), files.shared_dir(spark, "unique")
    schema = "event_id string, event_ts timestamp_ntz, ingestion_ts timestamp_ntz, user_id string"
    stream = stream_source(spark, "parquet", path=inbox, schema=schema)
    stream_dedupe(stream).writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", files.shared_dir(spark, "checkpoint")
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schema).parquet(out).select("event_id", "event_ts", "user_id")


@query
def fk_orphans(spark, sf):
    raw = fixtures.numbered(spark, sf)
    tables = organisation(raw)
    strayed = F.when(F.col("i") % 211 == 0, F.lit("B9")).otherwise(F.col("branch_id"))
    tables["fact_user_activity"] = raw.withColumn("branch_id", strayed)
    return quality.fk_orphans(tables)


@query
def region_conformance(spark, sf):
    return quality.region_conformance(fixtures.raw(spark, sf), seeds.seed_regions(spark))


# -- 2.4 dimensions, type 1 ---------------------------------------------------------
def _register_dimensions():
    for d in dims.ORGANISATION:
        QUERIES[d.table] = lambda spark, sf, d=d: d.latest(fixtures.raw(spark, sf))
        QUERIES[f"{d.table}_first"] = lambda spark, sf, d=d: d.first(fixtures.raw(spark, sf))


_register_dimensions()


@query
def dim_upsert(spark, sf):
    """All five dimensions of the first batch, replaced by those of the second."""
    first, second = fixtures.two_batches(fixtures.raw(spark, sf))
    return union(
        [
            dims.dim_upsert(d.latest(first), d.latest(second), d.key).select(
                F.lit(d.table).alias("table_name"), F.concat_ws("|", *d.schema.names).alias("columns")
            )
            for d in dims.ORGANISATION
        ]
    )


@query
def seed_dims(spark, sf):
    streamed = organisation(fixtures.raw(spark, sf))
    seeded = seeds.seed_dims(spark)
    return union(
        [
            dims.dim_upsert(streamed[d.table], seeded[d.table], d.key).select(
                F.lit(d.table).alias("table_name"),
                F.concat_ws("|", *d.schema.names).alias("columns"),
            )
            for d in dims.ORGANISATION
            if d is not dims.EMPLOYEE
        ]
    )


@query
def seed_employees(spark, sf):
    streamed = dims.EMPLOYEE.latest(fixtures.raw(spark, sf))
    return dims.dim_upsert(streamed, seeds.seed_employees(spark), "employee_id")


@query
def seed_region_boxes(spark, sf):
    boxes = seeds.seed_region_boxes(spark)
    inside = (
        analytics.region_by_box(fixtures.raw(spark, sf).select("lat", "lon"), boxes)
        .groupBy("box_region")
        .agg(F.count("*").alias("n"))
        .withColumnRenamed("box_region", "region_code")
    )
    return boxes.join(inside, "region_code", "left").select(
        *boxes.columns, F.coalesce("n", F.lit(0)).alias("events")
    )


# -- 2.5 time -------------------------------------------------------------------------
@query
def dim_time(spark, sf):
    """The seeded form, from the first day of the events for as many days as they cover."""
    days = fixtures.raw(spark, sf).agg(
        F.min("event_ts").cast("date").alias("first"), F.max("event_ts").cast("date").alias("last")
    )
    first, last = days.first()
    return calendar.dim_time(spark, f"{first} 00:00:00", (last - first).days + 1)


@query
def dim_time_calendar(spark, sf):
    anchor = fixtures.raw(spark, sf).agg(F.max("event_ts").alias("now"))
    return calendar.dim_time_calendar(anchor, "now")


@query
def time_bucket_key_column(spark, sf):
    rows = fixtures.raw(spark, sf)
    return rows.select("event_id", time_bucket_key(F.col("event_ts")).alias("time_15min_sk"))


# -- 2.6 type 2 -------------------------------------------------------------------------
@query
def surrogate_key_column(spark, sf):
    key = surrogate_key(F.col("user_id"), F.col("event_ts"))
    return fixtures.raw(spark, sf).select("event_id", key.alias("user_sk"))


def _after_each_batch(spark, sf):
    first, second = fixtures.two_batches(fixtures.raw(spark, sf))
    empty = spark.createDataFrame([], schemas.DIM_USER_SCD2)
    one = scd2.scd2_apply(empty, first)
    return (empty, first, one), (one, second, scd2.scd2_apply(one, second))


def _versions(rows):
    return rows.select(*[text(c) if c == "effective_to" else F.col(c) for c in rows.columns])


@query
def scd2_apply(spark, sf):
    _, (_, _, two) = _after_each_batch(spark, sf)
    return _versions(two)


@query
def scd2_counts(spark, sf):
    steps = _after_each_batch(spark, sf)
    return union(
        [
            scd2.scd2_counts(before, batch).withColumn("batch", F.lit(n))
            for n, (before, batch, _) in enumerate(steps, 1)
        ]
    )


@query
def scd2_history(spark, sf):
    return _versions(scd2.scd2_history(fixtures.raw(spark, sf)))


@query
def asof_lookup(spark, sf):
    raw = fixtures.raw(spark, sf).select("event_id", "event_ts", "user_id")
    found = scd2.asof_lookup(raw, scd2.scd2_history(fixtures.raw(spark, sf)))
    return found.select("event_id", "user_sk", "effective_from", text("effective_to"))


@query
def fact_user_watch(spark, sf):
    return union(
        [
            scd2.fact_user_watch(batch, after)
            for _, batch, after in _after_each_batch(spark, sf)
        ]
    )


def _wide(raw: DataFrame) -> DataFrame:
    d = organisation(raw)
    return facts.dim_employee_wide(
        d["dim_employee"],
        d["dim_manager"],
        d["dim_branch"],
        d["dim_company"],
        facts.first_seen(raw, "employee_id"),
    )


@query
def dim_employee_wide(spark, sf):
    return _wide(fixtures.raw(spark, sf))


@query
def fact_org_watch(spark, sf):
    raw = fixtures.raw(spark, sf)
    return facts.fact_org_watch(raw, _wide(raw))


@query
def project_first_seen(spark, sf):
    return facts.project_first_seen(fixtures.raw(spark, sf))


# -- 2.7 watermark and run ----------------------------------------------------------------
def _marks(spark, sf) -> DataFrame:
    first, _ = fixtures.two_batches(fixtures.raw(spark, sf))
    return union(
        [watermark.watermark_next(first, p) for p in (watermark.LIVE_STREAM, "other")]
    )


@query
def watermark_read(spark, sf):
    marks = _marks(spark, sf)
    return union([watermark.watermark_read(marks, p) for p in (watermark.LIVE_STREAM, "never_ran")])


@query
def watermark_write(spark, sf):
    _, second = fixtures.two_batches(fixtures.raw(spark, sf))
    return watermark.watermark_write(_marks(spark, sf), watermark.watermark_next(second), RUN_TS)


@query
def watermark_next(spark, sf):
    first, second = fixtures.two_batches(fixtures.raw(spark, sf))
    return union([watermark.watermark_next(b, n) for n, b in (("one", first), ("two", second))])


@query
def watermark_init(spark, sf):
    raw = fixtures.raw(spark, sf)
    reports = []
    for name, at in (("epoch", watermark.EPOCH), ("setup", fixtures.CUT)):
        mark = watermark.watermark_init(spark, at).first()["last_run_ts"]
        reports.append(
            watermark.incremental_load(raw, mark)
            .agg(F.count("*").alias("loadable"))
            .withColumn("init", F.lit(name))
        )
    return union(reports)


@query
def silver_run_twice(spark, sf):
    """Bootstrap, two batches with a run after each, one run without news."""
    warehouse = Warehouse(spark, files.shared_dir(spark, "warehouse"))
    bootstrap(warehouse, RUN_TS, first_day="2024-01-01 00:00:00")
    for n, batch in enumerate(fixtures.two_batches(fixtures.raw(spark, sf))):
        warehouse.raw.write_run(batch, "test", n)
        silver_run(warehouse, RUN_TS)
    silver_run(warehouse, RUN_TS)
    parts = [
        warehouse.dims[d.table]
        .read()
        .select(
            F.lit(d.table).alias("table_name"),
            F.concat_ws("|", *d.schema.names).alias("content"),
            F.lit(0.0).alias("watch_time"),
        )
        for d in dims.ORGANISATION
    ]
    described = [c for c in schemas.FACT_USER_ACTIVITY.names if c != "watch_time"]
    parts.append(
        warehouse.fact.read().select(
            F.lit("fact_user_activity").alias("table_name"),
            F.concat_ws("|", *described).alias("content"),
            "watch_time",
        )
    )
    parts.append(
        warehouse.watermarks.read().select(
            F.lit("etl_watermarks").alias("table_name"),
            F.concat_ws("|", "pipeline_name", "last_run_ts").alias("content"),
            F.lit(0.0).alias("watch_time"),
        )
    )
    return union(parts)


@query
def silver_run_late(spark, sf):
    """A plain run, late events under two different lateness values, a plain run: each event once."""
    warehouse = Warehouse(spark, files.shared_dir(spark, "warehouse"))
    bootstrap(warehouse, RUN_TS, first_day="2024-01-01 00:00:00")
    first, second = fixtures.two_batches(fixtures.raw(spark, sf))
    day = f"timestamp_ntz'{fixtures.CUT}' - INTERVAL 1 DAY"
    late, hour = f"event_ts > {day}", F.minute("event_ts") % 3
    steps = [
        (first.where(f"NOT ({late}) OR minute(event_ts) % 3 = 0"), None),
        (first.where(late).where(hour == 1), "2 days"),
        (first.where(late).where(hour == 2), "30 hours"),
        (second, None),
    ]
    for n, (batch, lateness) in enumerate(steps):
        warehouse.raw.write_run(batch, "test", n)
        silver_run(warehouse, RUN_TS, lateness=lateness)
    return warehouse.fact.read()


@query
def user_star_run(spark, sf):
    """Two batches, with four failed tries of the second: users and facts as if none had failed."""
    warehouse = Warehouse(spark, files.shared_dir(spark, "warehouse"))
    raw = fixtures.raw(spark, sf)
    first, _ = fixtures.two_batches(raw)
    silver.user_star_run(warehouse, first, RUN_TS)

    def lost(*_):
        raise OSError("lost before the mark")

    save, tries = silver._save_mark, 4
    for n in range(tries + 1):
        silver._save_mark = lost if n < tries else save
        try:
            silver.user_star_run(warehouse, raw, RUN_TS)
        except OSError:
            continue
        finally:
            silver._save_mark = save
    users, fact = warehouse.users(), warehouse.user_fact.read()
    return _versions(users).select(
        F.lit("user").alias("kind"), "user_sk", F.concat_ws("|", "user_id", *scd2.TRACKED).alias("content"),
        text("effective_from"), "effective_to",
    ).unionByName(
        fact.select(
            F.lit("fact").alias("kind"), "user_sk", F.col("event_id").alias("content"),
            text("event_ts").alias("effective_from"), F.lit(None).cast("string").alias("effective_to"),
        )
    )


@query
def user_history_run(spark, sf):
    """Three batches, the last one with late events all over the time before: versions as if there had been one batch."""
    warehouse = Warehouse(spark, files.shared_dir(spark, "warehouse"), user_buckets=32)
    raw = fixtures.raw(spark, sf)
    first, second = fixtures.two_batches(raw)
    late = F.pmod(F.xxhash64("event_id"), F.lit(5)) == 0
    for rows in (first.where(~late), first.where(~late).unionByName(second.where(~late)), raw):
        silver.user_history_run(warehouse, rows, RUN_TS, lateness="400 days")
    return _versions(warehouse.user_versions.read())


def _declared(spark, sf) -> Warehouse:
    warehouse = Warehouse(spark, files.shared_dir(spark, "warehouse"))
    for n, batch in enumerate(fixtures.two_batches(fixtures.raw(spark, sf))):
        warehouse.raw.write_run(batch, "test", n)
        silver_run(warehouse, RUN_TS, declared=True)
    return warehouse


@query
def dim_employee_wide_run(spark, sf):
    return _declared(spark, sf).employee_wide.read()


@query
def fact_org_watch_run(spark, sf):
    return _declared(spark, sf).org_fact.read()


@query
def project_first_seen_run(spark, sf):
    return _declared(spark, sf).project_seen.read()


@query
def metric_definitions(spark, sf):
    """The metrics of the definitions table over the fact of two runs."""
    warehouse = Warehouse(spark, files.shared_dir(spark, "warehouse"))
    bootstrap(warehouse, RUN_TS)
    for n, batch in enumerate(fixtures.two_batches(fixtures.raw(spark, sf))):
        warehouse.raw.write_run(batch, "test", n)
        silver_run(warehouse, RUN_TS)
    return warehouse.metrics()


@query
def empty_batch_guard(spark, sf):
    warehouse = Warehouse(spark, files.shared_dir(spark, "warehouse"))
    writer = RawIngest(warehouse, source="guard", ingested_at=RUN_TS)
    payloads = fixtures.messages(spark, sf)
    reports = []
    for n, (name, batch) in enumerate((("none", payloads.where("i < 0")), ("all", payloads))):
        writer(batch.select("value"), n)
        reports.append((name, files.exists(spark, warehouse.raw.path), warehouse.raw.read().count()))
    return spark.createDataFrame(reports, "batch string, written boolean, raw_rows bigint")


# -- 2.8 catalog ------------------------------------------------------------------------------
@query
def meta_table(spark, sf):
    lo, hi = (
        fixtures.raw(spark, sf).agg(F.min("ingestion_ts"), F.max("ingestion_ts")).first()
    )
    return catalog.meta_table(spark, lo, hi)


@query
def meta_table_counts(spark, sf):
    raw = fixtures.raw(spark, sf)
    tables = {"raw_user_stream_events": raw, **organisation(raw)}
    tables["fact_user_activity"] = facts.fact_project(raw, RUN_TS)
    return catalog.meta_table_counts(tables, RUN_TS)


@query
def meta_column(spark, sf):
    return catalog.meta_column(
        {
            "raw_user_stream_events": fixtures.raw_text(spark, sf).select(*schemas.RAW.names),
            "fact_user_activity": facts_of(spark, sf),
        },
        observed=True,
    )


@query
def metric_eval(spark, sf):
    return catalog.metric_eval(facts_of(spark, sf))


# -- 2.9 analytics ------------------------------------------------------------------------------
@query
def watch_by_org(spark, sf):
    raw = fixtures.raw(spark, sf)
    # A company nobody knows, and two branches of one name.
    companies = dims.COMPANY.latest(raw).where("company_id <> 'C2'")
    branches = dims.BRANCH.latest(raw).replace({"Gurgaon": "Noida"}, subset=["branch_name"])
    return analytics.watch_by_org(facts.fact_project(raw, RUN_TS), companies, branches)


@query
def watch_by_department(spark, sf):
    raw = fixtures.raw(spark, sf)
    return analytics.watch_by_department(
        facts.fact_project(raw, RUN_TS), dims.MANAGER.latest(raw).where("manager_id <> 'M_C1_1'")
    )


@query
def watch_by_project(spark, sf):
    raw = fixtures.raw(spark, sf)
    return analytics.watch_by_project(
        facts.fact_project(raw, RUN_TS),
        dims.PROJECT.latest(raw).where("project_code <> 'P_C1_1'"),
        dims.COMPANY.latest(raw),
    )


@query
def watch_15min(spark, sf):
    raw = fixtures.raw(spark, sf)
    return analytics.watch_15min(
        facts.fact_project(raw, RUN_TS), calendar.dim_time_spanning(raw)
    )


@query
def top_employees(spark, sf):
    raw = fixtures.raw(spark, sf)
    return analytics.top_employees(facts.fact_project(raw, RUN_TS), dims.EMPLOYEE.latest(raw))


@query
def session_summary(spark, sf):
    return analytics.session_summary(facts_of(spark, sf))


@query
def region_by_box(spark, sf):
    rows = fixtures.raw(spark, sf).select("event_id", "lat", "lon")
    return analytics.region_by_box(rows, seeds.seed_region_boxes(spark))


@query
def stream_watch(spark, sf):
    """All windows of the events; one row far ahead closes them and stays open itself."""
    rows = fixtures.raw(spark, sf).select("event_ts", "watch_time")
    ahead = rows.agg(
        (F.max("event_ts") + F.expr("INTERVAL 10 DAYS")).alias("event_ts"),
        F.lit(0.0).alias("watch_time"),
    )
    inbox = as_files(spark, rows.unionByName(ahead), "inbox")
    out = files.shared_dir(spark, "windows")
    stream = stream_source(
        spark, "parquet", path=inbox, schema="event_ts timestamp_ntz, watch_time double"
    )
    stream_watch_15min(stream).writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", files.shared_dir(spark, "checkpoint")
    ).trigger(availableNow=True).start().awaitTermination()
    schema = "time_bucket_start timestamp_ntz, events bigint, watch_time double"
    return spark.read.schema(schema).parquet(out)


# A query is registered under its operator's name.
for _function, _id in (
    ("stream_source_rows", "stream_source"),
    ("safe_float_column", "safe_float"),
    ("normalize_ts_column", "normalize_ts"),
    ("stream_dedupe_rows", "stream_dedupe"),
    ("time_bucket_key_column", "time_bucket_key"),
    ("surrogate_key_column", "surrogate_key"),
    ("silver_run_twice", "silver_run"),
    ("stream_watch", "stream_watch_15min"),
):
    QUERIES[_id] = QUERIES.pop(_function)
