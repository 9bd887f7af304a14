"""The tables of the star schema under one root, and their first contents."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField, StructType

from tallystar import schemas
from tallystar.functions.timestamps import as_wall_clock
from tallystar.operators import calendar, catalog, seeds
from tallystar.operators.dims import ORGANISATION, dim_upsert
from tallystar.operators.scd2 import fact_user_watch
from tallystar.operators.watermark import EPOCH, LIVE_STREAM, watermark_init
from tallystar.sources.rows import empty, one_row
from tallystar.sources.tables import AppendTable, BucketTable, SnapshotTable


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, user_buckets: int = 1_000):
        self.spark, self.root = spark, root

        def snapshot(name, schema):
            return SnapshotTable(spark, root, name, schema)

        def append(name, schema, *run, date_from=None):
            return AppendTable(spark, root, name, schema, run, date_from)

        self.raw = append(
            "raw_user_stream_events", schemas.RAW, "source", "batch_id", date_from="event_ts"
        )
        self.fact = append(
            "fact_user_activity", schemas.FACT_USER_ACTIVITY, "run_id", date_from="event_ts"
        )
        self.errors = append("meta_metric", schemas.META_METRIC, "run_id")
        self.quarantine = append("quarantine", schemas.QUARANTINE, "source", "batch_id")
        self.batch_counts = append("batch_counts", schemas.BATCH_COUNTS, "source", "batch")
        self.run_counts = append("run_counts", schemas.RUN_COUNTS, "run_id")
        self.dims = {d.table: snapshot(d.table, d.schema) for d in ORGANISATION}
        self.dims["dim_region"] = snapshot("dim_region", schemas.DIM_REGION)
        self.dims["dim_time"] = snapshot("dim_time", schemas.DIM_TIME)
        self.meta_table = snapshot("meta_table", schemas.META_TABLE)
        self.meta_column = snapshot("meta_column", schemas.META_COLUMN)
        self.meta_counts = snapshot("meta_table_counts", schemas.META_TABLE_COUNTS)
        # Stored next to each mark: the number of the last run that moved it.
        marks = StructType(schemas.ETL_WATERMARKS.fields + [StructField("run_number", LongType())])
        self.watermarks = snapshot("etl_watermarks", marks)
        # Declared beside the star: employees with names and surrogate keys, the fact that carries these, first events of
        # projects, and the metrics' definitions.
        self.employee_seen = snapshot("employee_first_seen", schemas.EMPLOYEE_FIRST_SEEN)
        self.employee_wide = snapshot("dim_employee_wide", schemas.DIM_EMPLOYEE_WIDE)
        self.project_seen = snapshot("dim_project_first_seen", schemas.DIM_PROJECT_FIRST_SEEN)
        self.org_fact = append("fact_org_watch", schemas.FACT_ORG_WATCH, "run_id", date_from="event_ts")
        self.metric_definitions = snapshot("metric_definitions", schemas.METRIC_DEFINITIONS)
        # Older dimensions of the user star: region boxes and the 15-minute calendar.
        self.region_boxes = snapshot("dim_region_box", schemas.DIM_REGION_BOX)
        self.calendar = snapshot("dim_time_15min", schemas.DIM_TIME_15MIN)
        # User star: closed versions only grow, current ones are replaced, by the buckets of a batch's users.
        self.user_current = BucketTable(spark, root, "dim_user_current", schemas.DIM_USER_SCD2, "user_id", user_buckets)
        self.user_closed = append("dim_user_closed", schemas.DIM_USER_SCD2, "run_id")
        self.user_fact = append(
            "fact_user_watch_activity", schemas.FACT_USER_WATCH, "run_id", date_from="event_ts"
        )
        # User star with event-grain versions: the events loaded so far, and all versions.
        self.user_events = append("user_events", schemas.RAW_USER, "run_id", date_from="event_ts")
        self.user_versions = BucketTable(spark, root, "dim_user_versions", schemas.DIM_USER_SCD2, "user_id", user_buckets)

    @property
    def tables(self) -> list[SnapshotTable | AppendTable]:
        """The thirteen tables of the live schema."""
        return [
            self.raw,
            *self.dims.values(),
            self.fact,
            self.meta_table,
            self.meta_column,
            self.errors,
            self.watermarks,
        ]

    @property
    def others(self) -> list[SnapshotTable | AppendTable | BucketTable]:
        """The tables around them: counts, rejects, older dimensions, the user star."""
        return [
            self.quarantine,
            self.batch_counts,
            self.run_counts,
            self.meta_counts,
            self.region_boxes,
            self.calendar,
            self.user_current,
            self.user_closed,
            self.user_fact,
            self.user_events,
            self.user_versions,
            self.employee_seen,
            self.employee_wide,
            self.project_seen,
            self.org_fact,
            self.metric_definitions,
        ]

    def users(self):
        """The whole type-2 user dimension."""
        return self.user_closed.read().unionByName(self.user_current.read())

    def user_facts(self) -> DataFrame:
        """Point-in-time facts of the star with event-grain versions.  A late event may give earlier ones another version,
        so they are looked up when read."""
        return fact_user_watch(self.user_events.read(), self.user_versions.read())

    def metrics(self) -> DataFrame:
        """Every metric of the definitions table, over the fact: (metric_name, metric_value)."""
        defined = self.metric_definitions.read().select("metric_name", "sql_definition").collect()  # a few rows
        return catalog.metric_eval(self.fact.read(), {r[0]: r[1] for r in defined})

    def compact(self, before: date | None = None) -> dict[str, int]:
        """Merge the runs of closed days; days written by table."""
        tables = [t for t in (*self.tables, *self.others) if isinstance(t, AppendTable)]
        return {t.name: t.compact(before) for t in tables}

    def register_counts(self, run_ts: datetime | str) -> None:
        """Count the star's tables and replace their catalog rows."""
        tables = {t.name: t.read() for t in (self.raw, *self.dims.values(), self.fact)}
        counts = catalog.meta_table_counts(tables, run_ts).persist()
        self.meta_counts.replace(dim_upsert(self.meta_counts.read(), counts, "table_name"))
        counts.unpersist()


def bootstrap(
    warehouse: Warehouse,
    run_ts: datetime | str,
    overwrite: bool = False,
    first_day: datetime | str = "2025-01-01 00:00:00",
    days: int = 30,
    watermark: datetime | str = EPOCH,
) -> None:
    """Create the tables and seed them.

    ``overwrite`` drops what is there; otherwise existing tables keep their data
    and seeds are upserted.  ``watermark`` is the first mark: the epoch loads all
    history, ``run_ts`` leaves out whatever arrived before setup.
    """
    spark = warehouse.spark
    with ThreadPoolExecutor(8) as pool:  # the tables do not depend on each other
        if overwrite:  # a mark that starts anew must find no row of an earlier life
            list(pool.map(lambda t: t.recreate(), [*warehouse.tables, *warehouse.others]))
        else:
            list(pool.map(lambda t: t.ensure(), warehouse.tables))
    keys = {d.table: d.key for d in ORGANISATION} | {
        "dim_region": "region_code",
        "dim_time": "time_key",
        "dim_region_box": "region_code",
        "dim_time_15min": "time_15min_sk",
    }
    anchor = one_row(spark).select(as_wall_clock(run_ts).alias("run_ts"))
    seeded = seeds.seed_dims(spark) | {
        "dim_time": calendar.dim_time(spark, first_day, days),
        "dim_region_box": seeds.seed_region_boxes(spark),
        "dim_time_15min": calendar.dim_time_calendar(anchor, "run_ts"),
    }
    older = {t.name: t for t in (warehouse.region_boxes, warehouse.calendar)}

    def fill(name: str) -> None:
        table = (warehouse.dims | older)[name]
        table.replace(dim_upsert(table.read(), seeded[name], keys[name]))

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(fill, seeded))
    marks = warehouse.watermarks.read()
    if marks.where(marks.pipeline_name == LIVE_STREAM).isEmpty():
        warehouse.watermarks.replace(
            marks.unionByName(
                watermark_init(spark, watermark, LIVE_STREAM), allowMissingColumns=True
            )
        )
    warehouse.meta_table.replace(catalog.meta_table(spark, run_ts))
    warehouse.metric_definitions.replace(
        dim_upsert(
            warehouse.metric_definitions.read(), catalog.metric_definitions(spark, "activity"), "metric_name"
        )
    )
    warehouse.meta_column.replace(
        catalog.meta_column(
            {
                t.name: empty(spark, schemas.ETL_WATERMARKS if t is warehouse.watermarks else t.schema)
                for t in warehouse.tables
            }
        )
    )
