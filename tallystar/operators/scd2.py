"""Type-2 user dimension and point-in-time facts.

Two ways to build versions, never mixed:

* ``scd2_apply``   per batch, one version per changed user, starting at the
  user's last event in the batch (earlier events of a new user find no version);
* ``scd2_history`` event grain, a version at every change of an attribute.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar import schemas
from tallystar.functions.keys import surrogate_key, time_bucket_key
from tallystar.functions.numbers import parse_float
from tallystar.functions.timestamps import FIRST_SECOND, as_wall_clock, epoch_seconds, truncate_to_second
from tallystar.operators.rank import (
    MAX_ROWS_PER_GROUP,
    SLICE,
    add_slices,
    join_edges,
    latest_by_key,
    with_next,
    with_previous,
    written,
)

# Tracked attributes, and the open end of a version.
TRACKED = ("username", "device_type", "app_version", "region_code", "city")
END_OF_TIME = "9999-12-31 23:59:59"


def _changed(left: str, right: str) -> Column:
    same = F.lit(True)
    for name in TRACKED:
        same = same & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return ~same


def _version(source: str) -> Column:
    """A new open version starting at the event of struct column ``source``."""
    at = F.col(f"{source}.event_ts")
    return F.struct(
        surrogate_key(F.col("user_id"), at).alias("user_sk"),
        F.col("user_id"),
        *[F.col(f"{source}.{name}").alias(name) for name in TRACKED],
        at.alias("effective_from"),
        as_wall_clock(END_OF_TIME).alias("effective_to"),
        F.lit(True).alias("is_current"),
    )


def latest_users(events: DataFrame) -> DataFrame:
    return latest_by_key(events, "user_id", ["event_ts", *TRACKED])


def _compared(current: DataFrame, events: DataFrame) -> DataFrame:
    """Current version and last event side by side, one row per user."""
    names = schemas.DIM_USER_SCD2.names
    old = current.where("is_current").select("user_id", F.struct(*names).alias("old"))
    new = latest_users(events)
    new = new.select("user_id", F.struct("event_ts", *TRACKED).alias("new"))
    both = old.join(new, "user_id", "full_outer")
    is_new = F.col("old").isNull()
    differs = F.col("old").isNotNull() & F.col("new").isNotNull() & _changed("old", "new")
    return both.withColumn("inserted", is_new | differs).withColumn("closed", differs)


def scd2_delta(current: DataFrame, events: DataFrame) -> DataFrame:
    """Versions that are current after the batch, plus those the batch closed.

    Closed history takes no part, so a run rewrites the current versions and
    appends the closed ones.
    """
    names = schemas.DIM_USER_SCD2.names
    kept = F.struct(
        *[
            F.when(F.col("closed"), F.col("new.event_ts")).otherwise(F.col("old.effective_to"))
            .alias(n)
            if n == "effective_to"
            else (~F.col("closed")).alias(n)
            if n == "is_current"
            else F.col(f"old.{n}").alias(n)
            for n in names
        ]
    )
    rows = F.array_compact(
        F.array(
            F.when(F.col("old").isNotNull(), kept),
            F.when(F.col("inserted"), _version("new")),
        )
    )
    return _compared(current, events).select(F.inline(rows)).select(*names)


def scd2_apply(dim: DataFrame, events: DataFrame) -> DataFrame:
    """The whole dimension after one batch of events."""
    history = dim.where(~F.col("is_current"))
    return history.select(*schemas.DIM_USER_SCD2.names).unionByName(scd2_delta(dim, events))


def scd2_counts(dim: DataFrame, events: DataFrame) -> DataFrame:
    """(inserts, updates) of a batch; a changed user counts in both."""
    return _compared(dim, events).agg(
        F.count_if("inserted").alias("inserts"), F.count_if("closed").alias("updates")
    )


def scd2_history(events: DataFrame, max_rows: int = MAX_ROWS_PER_GROUP) -> DataFrame:
    """Every attribute change opens a version, whatever the batch cuts.

    Keys have second precision: of the states of one user in one second the last
    counts.  Where no user has more than ``max_rows`` events, one sort by user and time answers all; else that last state is
    an aggregation, so that a crowded second is combined before the shuffle, and hot users are cut into slices.
    """
    known = events.where(F.col("user_id").isNotNull() & F.col("event_ts").isNotNull())
    second, attributes = truncate_to_second(F.col("event_ts")), F.struct(*TRACKED)
    changed = F.col("_previous").isNull() | _changed("_previous", "_now")
    if known.groupBy("user_id").count().where(F.col("count") > max_rows).isEmpty():
        turn = Window.partitionBy("user_id").orderBy("event_ts", "event_id")
        rows = known.select("user_id", "event_ts", "event_id", *TRACKED, second.alias("_second"))
        rows = rows.withColumn("_then", F.lead("_second").over(turn)).where("_then IS NULL OR _then <> _second")
        changes = rows.withColumns({"_previous": F.lag(attributes).over(turn), "_now": attributes}).where(changed)
        closed = changes.withColumn("_next", F.lead(F.struct(F.col("_second").alias("event_ts"))).over(turn))
        closed = closed.withColumn("event_ts", F.col("_second"))
    else:
        last = F.max_by(attributes, F.struct("event_ts", "event_id")).alias("_last")
        rows = known.groupBy("user_id", second.alias("event_ts")).agg(last).select("user_id", "event_ts", "_last.*")
        sliced, hot = add_slices(rows, "user_id", "event_ts", max_rows)
        steps = with_previous(sliced, "user_id", attributes, ("event_ts",), hot)
        changes = steps.withColumn("_now", attributes).where(changed)
        closed = with_next(changes, "user_id", F.struct("event_ts"), ("event_ts",), hot)
    end = F.coalesce("_next.event_ts", as_wall_clock(END_OF_TIME))
    return closed.select(
        surrogate_key(F.col("user_id"), F.col("event_ts")).alias("user_sk"),
        "user_id",
        *TRACKED,
        F.col("event_ts").alias("effective_from"),
        end.alias("effective_to"),
        F.col("_next").isNull().alias("is_current"),
    )


def scd2_splice(versions: DataFrame, held: DataFrame, batch: DataFrame, **history) -> DataFrame:
    """``scd2_history`` of all events, from that of the events ``held`` and the events of a ``batch``, late ones included.

    ``versions`` holds those of the batch's users at least; users without a batch event keep theirs.  Of the
    others, versions that end before the user's first batch second stay as they are.  The one
    that holds just before it is an event again, at its start, and what follows is made anew from it, the held events from that second on,
    and the batch.  ``held`` may be narrowed to the days from the batch's first second on.
    """
    known = F.col("user_id").isNotNull() & F.col("event_ts").isNotNull()
    columns = ["event_id", "event_ts", "user_id", *TRACKED]
    batch = batch.where(known).select(*columns)
    begins = batch.groupBy(F.col("user_id").alias("_user")).agg(
        truncate_to_second(F.min("event_ts")).alias("_from")
    )
    begins = written(begins, "begins")
    sided = versions.join(begins, F.col("user_id") == F.col("_user"), "left")
    kept = sided.where(F.col("_from").isNull() | (F.col("effective_to") < F.col("_from")))
    open_ = sided.where((F.col("effective_from") < F.col("_from")) & (F.col("effective_to") >= F.col("_from")))
    again = open_.select(F.lit("").alias("event_id"), F.col("effective_from").alias("event_ts"), "user_id", *TRACKED)
    later = held.where(known).join(
        begins, (F.col("user_id") == F.col("_user")) & (F.col("event_ts") >= F.col("_from"))
    )
    events = again.unionByName(later.select(*columns)).unionByName(batch)
    return kept.select(*versions.columns).unionByName(scd2_history(events, **history))


# -- point-in-time lookup ----------------------------------------------------
# Powers of two seconds that a time from the year 1 on has, at most.
LEVELS = 39


def _second(ts: str) -> Column:
    return epoch_seconds(F.col(ts)) - FIRST_SECOND


def _blocks(low: Column, high: Column) -> Column:
    """The time from ``low`` to ``high`` (exclusive) as (level, block): blocks of 2^level seconds that start at a multiple of
    their length, two of a level at most."""
    edges = []
    for level in range(LEVELS):
        first, end = F.ceil(low / F.lit(1 << level)), F.floor(high / F.lit(1 << level))
        edges += [
            F.when((first < end) & (first % 2 == 1), F.struct(F.lit(level).alias("level"), first.alias("block"))),
            F.when((first < end) & (end % 2 == 1), F.struct(F.lit(level).alias("level"), (end - 1).alias("block"))),
        ]
    return F.array_compact(F.array(*edges))


def _open_at(events: DataFrame, versions: DataFrame) -> DataFrame:
    """Of versions that may overlap, the last started one that holds at an event; no pair of an event and a version is made.

    Every version is cut into blocks of time, and of the versions of a block the last started one is kept, by an aggregation.  An
    event's second lies in one block of each level, and the best of these is its version.  Parts of a second at the ends of a
    version, where times have fractions, are matched within that second.
    """
    version = F.struct("user_sk", "effective_from", "effective_to")
    order = F.struct("_version.effective_from", "_version.user_sk")
    known = versions.where(F.col("user_id").isNotNull() & (F.col("effective_from") < F.col("effective_to"))).select(
        "user_id",
        version.alias("_version"),
        _second("effective_from").alias("_low"),
        _second("effective_to").alias("_high"),
        (truncate_to_second(F.col("effective_from")) < F.col("effective_from")).alias("_late"),
        (truncate_to_second(F.col("effective_to")) < F.col("effective_to")).alias("_over"),
    )
    whole = known.select(
        "user_id", "_version", F.explode(_blocks(F.col("_low") + F.col("_late").cast("int"), F.col("_high"))).alias("b")
    )
    best = (
        whole.groupBy(F.col("user_id").alias("_user"), "b.level", "b.block")
        .agg(F.max_by("_version", order).alias("_version"))
    )
    best = written(best, "blocks")
    levels = [r[0] for r in best.select("level").distinct().collect()]  # LEVELS at most
    seconds = events.where(F.col("user_id").isNotNull()).select("user_id", _second("event_ts").alias("_at")).distinct()
    places = F.array(
        *[F.struct(F.lit(n).alias("_level"), F.floor(F.col("_at") / F.lit(1 << n)).alias("_block")) for n in levels]
    ) if levels else F.array().cast("array<struct<_level:int,_block:bigint>>")
    asked = seconds.select("user_id", "_at", F.explode(places).alias("p")).select("user_id", "_at", "p.*")
    found = asked.join(
        best, (F.col("user_id") == F.col("_user")) & (F.col("_level") == F.col("level")) & (F.col("_block") == F.col("block"))
    )
    found = found.groupBy("_user", "_at").agg(F.max_by("_version", order).alias("_version"))
    timed = events.withColumn("_second", _second("event_ts"))
    hit = timed.join(found, (F.col("user_id") == F.col("_user")) & (F.col("_second") == F.col("_at")))
    parts = F.array_distinct(F.array_compact(F.array(F.when(F.col("_late"), F.col("_low")), F.when(F.col("_over"), F.col("_high")))))
    edges = known.select(F.col("user_id").alias("_user"), "_version", F.explode(parts).alias("_at"))
    edges = timed.join(
        edges,
        (F.col("user_id") == F.col("_user"))
        & (F.col("_second") == F.col("_at"))
        & (F.col("event_ts") >= F.col("_version.effective_from"))
        & (F.col("event_ts") < F.col("_version.effective_to")),
    )
    columns = [*events.columns, "_version.*"]
    return hit.select(*columns).unionByName(edges.select(*columns))


def _last_started(events: DataFrame, versions: DataFrame, max_rows: int) -> DataFrame:
    """Sorted form: one ordered pass over events and version starts together."""
    version = F.struct("user_sk", "effective_from", "effective_to")
    starts = versions.select(
        "user_id",
        F.col("effective_from").alias("_time"),
        F.lit(0).alias("_kind"),
        version.alias("_version"),
        F.lit(None).cast(events.schema).alias("_event"),
    )
    lookups = events.where(F.col("user_id").isNotNull()).select(
        "user_id",
        F.col("event_ts").alias("_time"),
        F.lit(1).alias("_kind"),
        F.lit(None).cast(starts.schema["_version"].dataType).alias("_version"),
        F.struct(*events.columns).alias("_event"),
    )
    sliced, hot = add_slices(starts.unionByName(lookups), "user_id", "_time", max_rows)
    so_far = (
        Window.partitionBy("user_id", SLICE)
        .orderBy("_time", "_kind", "_version.effective_to")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = sliced.withColumn("_found", F.last("_version", ignorenulls=True).over(so_far))
    if hot:
        # A slice starts with the last version of the slices before it.
        earlier = (
            Window.partitionBy("_key").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        )
        order = F.struct("_time", "_version.effective_to")
        edges = (
            sliced.where(F.col(SLICE).isNotNull())
            .groupBy(F.col("user_id").alias("_key"), F.col(SLICE).alias("_at"))
            .agg(F.max_by("_version", F.when(F.col("_kind") == 0, order)).alias("_edge"))
            .withColumn("_carry", F.last("_edge", ignorenulls=True).over(earlier))
        )
        found = join_edges(found, "user_id", edges)
        found = found.withColumn("_found", F.coalesce("_found", "_carry"))
    return found.where(
        (F.col("_kind") == 1) & (F.col("_time") < F.col("_found.effective_to"))
    ).select("_event.*", "_found.*")


def asof_lookup(
    events: DataFrame,
    versions: DataFrame,
    disjoint: bool = True,
    max_rows: int = MAX_ROWS_PER_GROUP,
    few: bool = False,
) -> DataFrame:
    """Events with the version valid at event_ts; an event without one is dropped.

    Adds user_sk, effective_from and effective_to.  One ordered pass over events and
    version starts, linear in both.  ``disjoint=False`` allows
    overlapping versions of a user: the latest start wins, and the result holds
    one row per event_id, its first, as the fact's primary key demands.  It costs a
    factor of the logarithm of time, whatever overlaps.  ``few`` says that no user has more than a few
    versions, disjoint ones: events are joined with all of their user's, and nothing is sorted by time.
    """
    if few:
        version = [F.col(c).alias(f"_{c}") for c in ("user_id", "user_sk", "effective_from", "effective_to")]
        holds = (
            (F.col("user_id") == F.col("_user_id"))
            & (F.col("event_ts") >= F.col("_effective_from"))
            & (F.col("event_ts") < F.col("_effective_to"))
        )
        found = [F.col(f"_{c}").alias(c) for c in ("user_sk", "effective_from", "effective_to")]
        return events.join(versions.select(*version), holds).select(*events.columns, *found)
    if not disjoint:
        version = ("user_sk", "effective_from", "effective_to")
        order = F.struct(-epoch_seconds(F.col("event_ts")), "effective_from", "user_sk")
        best = F.max_by(F.struct(*events.columns, *version), order).alias("_best")
        return _open_at(events, versions).groupBy("event_id").agg(best).select("_best.*")
    return _last_started(events, versions, max_rows)


def fact_user_watch(events: DataFrame, versions: DataFrame, text: bool = False, **lookup) -> DataFrame:
    """Point-in-time fact; a row whose lat, lon or watch_time is no number is dropped.

    ``text`` says that the three measures are still text.
    """
    measures = ("lat", "lon", "watch_time")
    rows = events.select(
        *[
            (parse_float(F.col(c)) if text else F.col(c)).alias(c) if c in measures else F.col(c)
            for c in events.columns
        ]
    ).dropna(subset=list(measures))
    return (
        asof_lookup(rows, versions, **lookup)
        .withColumn("time_15min_sk", time_bucket_key(F.col("event_ts")))
        .select(*schemas.FACT_USER_WATCH.names)
    )
