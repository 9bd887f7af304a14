"""RAW -> star schema, incrementally."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallystar import schemas
from tallystar.functions.timestamps import as_wall_clock
from tallystar.operators import facts, scd2
from tallystar.operators.dims import ORGANISATION, Dimension, dim_upsert, last_rows
from tallystar.operators.quality import dedupe_by_key
from tallystar.operators.watermark import (
    LIVE_STREAM,
    RAW_TO_SILVER,
    USER_HISTORY,
    incremental_load,
    incremental_load_14col,
    watermark_read,
)
from tallystar.plans.warehouse import Warehouse
from tallystar.sources.csv_snapshots import csv_export, csv_export_days
from tallystar.sources.rows import literal_rows, one_row
from tallystar.sources.tables import not_before

EXPORTED = tuple(d.table for d in ORGANISATION)
# Keys whose first events the declared tables hold.
FIRST_KEYS = ("employee_id", "project_code")


def _begin(warehouse: Warehouse, pipeline: str) -> tuple[datetime, int, str]:
    """(mark, number, id) of the run that is due.

    The number stands beside the mark and rises with it in one write, when a run is
    done: a retry has the number of its first try and replaces what that wrote,
    and no other run can have it, whichever events it loads.
    """
    marks = warehouse.watermarks.read()
    mark = watermark_read(marks, pipeline).first()["last_run_ts"]
    last = marks.where(F.col("pipeline_name") == pipeline).agg(F.max("run_number")).first()[0]
    number = (last or 0) + 1
    return mark, number, f"run-{number:08d}"


def _begin_of(warehouse: Warehouse, mark: datetime, lateness: str | None) -> datetime:
    """The time from which events may be news."""
    if lateness is None:
        return mark
    return one_row(warehouse.spark).select(as_wall_clock(mark) - F.expr(f"INTERVAL {lateness}")).first()[0]


def due_from(warehouse: Warehouse, pipeline: str, lateness: str | None = None) -> datetime:
    """From when on a pipeline's next run reads its input."""
    return _begin_of(warehouse, _begin(warehouse, pipeline)[0], lateness)


def _save_mark(warehouse: Warehouse, pipeline: str, upto: datetime, number: int) -> None:
    """The mark keeps its fraction of a second: an event is after it, or was loaded."""
    mark = one_row(warehouse.spark).select(
        F.lit(pipeline).alias("pipeline_name"),
        as_wall_clock(upto).alias("last_run_ts"),
        F.lit(number).cast("long").alias("run_number"),
    )
    marks = warehouse.watermarks
    marks.replace(dim_upsert(marks.read(), mark, "pipeline_name"))


def _late(batch: DataFrame, mark: datetime, held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a run with lateness loads: events the fact does not hold, once each; and the kept rows that this reads, to be
    let go of at the end.

    Without an id nothing tells a late event from a loaded one: those count from
    the mark on, as in any other run.
    """
    fresh = batch.join(held.select("event_id"), "event_id", "left_anti").select(*batch.columns).persist()
    has_id = F.col("event_id").isNotNull()
    plain = fresh.where(~has_id & (F.col("event_ts") > as_wall_clock(mark)))
    return dedupe_by_key(fresh.where(has_id), "event_id").unionByName(plain), fresh


def _declared(warehouse: Warehouse, batch: DataFrame, heads: DataFrame, run_id: str) -> None:
    """Employees with the names above them, keyed by their first event; projects by theirs; and facts with the employee's
    key.  First events are minima of what is held and the batch, whose own ones are among ``heads``, so a retry changes nothing."""
    held = warehouse.employee_seen
    held.replace(facts.earliest(held.read(), facts.first_seen(heads, "employee_id"), "employee_id", "effective_from"))
    projects = warehouse.project_seen
    projects.replace(facts.earliest(projects.read(), facts.project_first_seen(heads), "project_code", "created_at"))
    names = ("dim_employee", "dim_manager", "dim_branch", "dim_company")
    wide = facts.dim_employee_wide(*[warehouse.dims[n].read() for n in names], held.read())
    # Seeded employees have no event yet, and so no key.
    warehouse.employee_wide.replace(wide.where(F.col("effective_from").isNotNull()))
    warehouse.org_fact.write_run(facts.fact_org_watch(batch, warehouse.employee_wide.read()), run_id)


def silver_run(
    warehouse: Warehouse,
    run_ts: datetime | str,
    export_dir: str | None = None,
    lateness: str | None = None,
    register: bool = False,
    declared: bool = False,
) -> dict[str, int]:
    """One incremental run: dimensions, then the fact, then the watermark, then CSV.

    The batch is read three times, each time its own columns of the files of the days after the mark: narrowly
    for the number of each key's last event, once more for those events, whole, and for the fact.
    Without new rows no table is written.  ``lateness`` re-reads that interval
    behind the mark and keeps only events the fact does not hold yet; copies of
    an event carry the same event_ts.  ``declared`` fills the employee and project tables
    with first events, and the fact with employee keys.  ``register`` counts the star's tables
    into the catalog afterwards.
    """
    spark = warehouse.spark
    mark, number, run_id = _begin(warehouse, LIVE_STREAM)
    oldest = _begin_of(warehouse, mark, lateness)
    batch = incremental_load(warehouse.raw.read(prunable=True, since=oldest), mark, lateness)
    if lateness is not None:
        held = warehouse.fact.read(prunable=True, without_run=run_id, since=oldest)
        batch, fresh = _late(batch, mark, not_before(held, as_wall_clock(oldest)))
    heads, row_count, upto = last_rows(batch, ORGANISATION, FIRST_KEYS if declared else ())
    heads = heads.persist()
    try:
        if not row_count:
            return {}

        def save(dimension: Dimension) -> int:
            """Upsert one dimension; its few new rows are kept, as the upsert reads them twice."""
            table, new = warehouse.dims[dimension.table], dimension.latest(heads).persist()
            try:
                table.replace(dim_upsert(table.read(), new, dimension.key))
                return new.count()
            finally:
                new.unpersist()

        heads.count()
        # The five writes are independent; side by side they fill the cluster.
        with ThreadPoolExecutor(len(ORGANISATION)) as pool:
            upserted = list(pool.map(save, ORGANISATION))

        written = Observation()
        fact = facts.fact_project(batch, run_ts).observe(written, F.count(F.lit(1)).alias("rows"))
        warehouse.fact.write_run(fact, run_id)
        if declared:
            _declared(warehouse, batch, heads, run_id)
    finally:
        heads.unpersist()
        if lateness is not None:
            fresh.unpersist()
    # RAW holds doubles, so no row can be refused by the fact's cast here; text
    # sources go through facts.fact_errors.
    _save_mark(warehouse, LIVE_STREAM, max(upto, mark), number)
    counts = {
        "raw_loaded": row_count,
        **{d.table: n for d, n in zip(ORGANISATION, upserted)},
        "fact_user_activity": written.get["rows"],
    }
    warehouse.run_counts.write_run(
        literal_rows(spark, list(counts.items()), schemas.RUN_COUNTS), run_id
    )
    if register:
        warehouse.register_counts(run_ts)
    if export_dir:
        tables = {name: warehouse.dims[name].read() for name in EXPORTED}
        csv_export(tables, export_dir, one_file=EXPORTED)
        csv_export_days(warehouse.fact, export_dir)
    return counts


def user_star_run(warehouse: Warehouse, raw: DataFrame, run_ts: datetime | str) -> dict[str, int]:
    """One incremental run of the user star: type-2 users, then the watch fact.

    ``raw`` holds the user-event columns.  The fact looks up the dimension as it
    stands after the batch; a version that starts after an event cannot match it.
    """
    mark, number, run_id = _begin(warehouse, RAW_TO_SILVER)
    batch = incremental_load_14col(raw, mark)
    sums = warehouse.user_current.summed(batch, F.max("event_ts").alias("upto"))
    if not sums:
        return {}
    upto = max(r["upto"] for r in sums)
    # Only the buckets of the batch's users are read and rewritten.  A retry must compare with the versions from
    # before its first try.
    touched = warehouse.user_current.of(sums)
    current = warehouse.user_current.read(touched, before_run=run_id)
    delta = scd2.scd2_delta(current, batch).persist()
    # Versions opened by this batch start after the mark, older ones do not.
    opened = F.col("is_current") & (F.col("effective_from") > as_wall_clock(mark))
    inserts, updates = delta.agg(F.count_if(opened), F.count_if(~F.col("is_current"))).first()
    warehouse.user_closed.write_run(delta.where(~F.col("is_current")), run_id)
    warehouse.user_current.replace(delta.where("is_current"), touched, run_id)
    # Versions closed by earlier batches end before this one begins: the delta holds
    # every version that can match, two per user at most.
    versions = delta.select("user_sk", "user_id", "effective_from", "effective_to")
    warehouse.user_fact.write_run(scd2.fact_user_watch(batch, versions, few=True), run_id)
    delta.unpersist()
    _save_mark(warehouse, RAW_TO_SILVER, upto, number)
    return {"inserts": inserts, "updates": updates}


def user_history_run(
    warehouse: Warehouse, raw: DataFrame, run_ts: datetime | str, lateness: str | None = None
) -> dict[str, int]:
    """One incremental run of the user star with event-grain versions, which do not depend on how events are cut into
    batches.

    ``lateness`` reads that interval behind the mark again, and keeps the events that no run has loaded; events without an id count
    from the mark on.  Only the buckets of the batch's users are read and rewritten.
    """
    mark, number, run_id = _begin(warehouse, USER_HISTORY)
    oldest = _begin_of(warehouse, mark, lateness)
    batch = incremental_load_14col(raw, as_wall_clock(oldest))
    if lateness is not None:
        held = warehouse.user_events.read(prunable=True, without_run=run_id, since=oldest)
        batch, kept = _late(batch, mark, not_before(held, as_wall_clock(oldest)))
    else:
        kept = batch.persist()
    try:
        sums = warehouse.user_versions.summed(
            batch, F.count("*").alias("events"), F.max("event_ts").alias("upto"), F.min("event_ts").alias("begin")
        )
        if not sums:
            return {}
        events, upto, begin = sum(r["events"] for r in sums), max(r["upto"] for r in sums), min(r["begin"] for r in sums)
        # Events that other runs have loaded, from the batch's first one on.
        held = warehouse.user_events.read(without_run=run_id, since=begin)
        touched = warehouse.user_versions.of(sums)
        versions = warehouse.user_versions.read(touched, before_run=run_id)
        warehouse.user_versions.replace(scd2.scd2_splice(versions, held, batch), touched, run_id)
        warehouse.user_events.write_run(batch, run_id)
    finally:
        kept.unpersist()
    _save_mark(warehouse, USER_HISTORY, max(upto, mark), number)
    return {"events": events, "buckets": len(touched)}
