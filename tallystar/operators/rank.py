"""First/last row per key, and neighbours in a per-key order.

``latest_by_key``/``first_by_key`` aggregate the time of the order by key, a hash aggregation of one
bigint over narrow rows: a hot key is combined on the map side.  The table of extremes is stored, so that its size is
known when it is joined back; the few rows at such a time are stored too, and only if some share their key's time,
the first two columns of the order, packed into one number of fixed width, say which of them to settle.  No wide row is
sorted or shuffled but those.

A per-key *order* (previous row, next row, last known value) does need a key's
rows together.  ``add_slices`` cuts the time line of a hot key into slices of
bounded expected size; the window then runs per (key, slice) and the slice edges
are stitched with one summary row per slice.  Ordinary keys have no slice (NULL)
and pay nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.functions.timestamps import FIRST_SECOND, epoch_seconds
from tallystar.sources.files import shared_dir

EVENT_ORDER = ("event_ts", "event_id")
SLICE = "_slice"
# Before the year 1, where wall clocks begin.
BEFORE_ALL = "0000-01-01 00:00:00"
# Rows of one key that one task may sort; above it the key is sliced.
MAX_ROWS_PER_GROUP = 1_000_000


def _number(rows: DataFrame, name: str) -> Column | None:
    """An order column as a whole number from 0 to 10^18 that never orders wrongly: microseconds, or the first seven bytes of a
    text; NULL is 0.  None where the type has no such number."""
    kind = rows.schema[name].dataType.simpleString()
    if kind == "timestamp_ntz":
        ts = F.col(name)
        fraction = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long") % 1_000_000
        number = (epoch_seconds(ts) - FIRST_SECOND) * 1_000_000 + fraction + 1
    elif kind == "string":
        head = F.rpad(F.substring(F.hex(name), 1, 14), 14, "0")
        number = F.conv(head, 16, 10).cast("long") + 1
    else:
        return None
    return F.coalesce(number, F.lit(0)).cast("decimal(18,0)")


def order_number(rows: DataFrame, order: Sequence[str]) -> tuple[Column, list[str]]:
    """One number for the first columns of the order, two at most, and the names of these."""
    packed, named = F.lit(0).cast("decimal(18,0)"), []
    for name in order[:2]:
        number = _number(rows, name)
        if number is None:
            break
        packed = (packed * F.lit(10**18).cast("decimal(19,0)")).cast("decimal(38,0)") + number
        named.append(name)
    return packed.cast("decimal(38,0)"), named


def settle(near: DataFrame, key: str, order: Sequence[str], last: bool) -> DataFrame:
    """One row of each key of ``near``; equal rows are as good as each other."""
    rest = [c for c in near.columns if c != key and c not in order]
    by = [F.desc(c) if last else F.asc(c) for c in (*order, *rest)]
    turn = F.row_number().over(Window.partitionBy(key).orderBy(*by))
    return near.withColumn("_turn", turn).where("_turn = 1").drop("_turn")


def timed(rows: DataFrame, name: str) -> Column | None:
    """A wall clock in which NULL is before all times; None for a column of another type."""
    if rows.schema[name].dataType.simpleString() != "timestamp_ntz":
        return None
    return F.coalesce(F.col(name), F.lit(BEFORE_ALL).cast("timestamp_ntz"))


def _extreme(rows: DataFrame, key: str, columns: Sequence[str], order: Sequence[str], last: bool) -> DataFrame:
    needed = list(dict.fromkeys([key, *columns, *order]))
    best, near = F.max if last else F.min, rows.select(*needed)
    at = timed(near, order[0])
    if at is not None:
        heads = written(near.groupBy(F.col(key).alias("_of")).agg(best(at).alias("_head")), "heads")
        near = near.join(heads, (F.col(key) == F.col("_of")) & (at == F.col("_head"))).select(*needed)
        near = written(near, "near")
        if near.groupBy(key).count().where("count > 1").isEmpty():
            return near.select(key, *columns)
    number, _ = order_number(near, order)
    numbered = near.withColumn("_number", number)
    heads = written(numbered.groupBy(F.col(key).alias("_of")).agg(best("_number").alias("_head")), "heads")
    ties = numbered.join(heads, (F.col(key) == F.col("_of")) & (F.col("_number") == F.col("_head")))
    return settle(ties.select(*needed), key, order, last).select(key, *columns)


def latest_by_key(
    rows: DataFrame,
    key: str,
    columns: Sequence[str],
    order: Sequence[str] = EVENT_ORDER,
) -> DataFrame:
    """The last row of each non-NULL key, as (key, columns...)."""
    return _extreme(rows.where(F.col(key).isNotNull()), key, columns, order, last=True)


def first_by_key(
    rows: DataFrame,
    key: str,
    columns: Sequence[str],
    order: Sequence[str] = EVENT_ORDER,
    skip_empty: bool = True,
) -> DataFrame:
    """The first row of each non-NULL key; an empty key counts as NULL by default."""
    keyed = rows.where(F.col(key) != "") if skip_empty else rows.where(F.col(key).isNotNull())
    return _extreme(keyed, key, columns, order, last=False)


def add_slices(
    rows: DataFrame, key: str, ts: str, max_rows: int = MAX_ROWS_PER_GROUP
) -> tuple[DataFrame, bool]:
    """Cut the time line of hot keys; the flag says whether there are any.

    A slice is named by its first second.  A group above ``max_rows`` is cut into
    slices of equal width, and a slice that is still above (a burst) is cut again,
    down to single seconds.  There are at most total_rows / max_rows such groups,
    whatever the data; the stored table of them is broadcast if its size allows.
    ``key`` holds no NULL.
    """
    second = epoch_seconds(F.col(ts))
    sliced, hot = rows.withColumn(SLICE, F.lit(None).cast("long")), False
    while True:
        cuts = F.ceil(F.col("_n") / max_rows)
        crowded = (
            sliced.groupBy(key, SLICE)
            .agg(F.count("*").alias("_n"), F.min(second).alias("_lo"), F.max(second).alias("_hi"))
            .where((F.col("_n") > max_rows) & (F.col("_hi") > F.col("_lo")))
            .select(
                F.col(key).alias("_hot"),
                F.col(SLICE).alias("_from"),
                "_lo",
                F.ceil((F.col("_hi") - F.col("_lo") + 1) / cuts).alias("_width"),
            )
        )
        if crowded.isEmpty():
            return sliced, hot
        # Written out, so that the next round's plan does not hold this round's twice.
        hot, crowded = True, written(crowded, "slices")
        first_second = (
            F.col("_lo") + F.floor((second - F.col("_lo")) / F.col("_width")) * F.col("_width")
        )
        sliced = (
            sliced.join(
                crowded,
                (F.col(key) == F.col("_hot")) & F.col(SLICE).eqNullSafe(F.col("_from")),
                "left",
            )
            .withColumn(SLICE, F.coalesce(first_second, SLICE))
            .select(*rows.columns, SLICE)
        )


def written(rows: DataFrame, name: str) -> DataFrame:
    """A small table stored and read back: its size is known, and decides whether it is broadcast."""
    path = shared_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def join_edges(rows: DataFrame, key: str, edges: DataFrame) -> DataFrame:
    """Attach ``_carry`` of (_key, _at) to the rows of that key and slice.

    There is one edge per slice, so the table keeps the bound of the hot keys.
    """
    known = edges.where(F.col("_carry").isNotNull()).select("_key", "_at", "_carry")
    return rows.join(
        written(known, "edges"),
        (F.col(key) == F.col("_key")) & (F.col(SLICE) == F.col("_at")),
        "left",
    ).drop("_key", "_at")


def _stitched(
    rows: DataFrame, key: str, value: Column, order: Sequence[str], hot: bool, name: str, back: bool
) -> DataFrame:
    """Add ``name``: ``value`` (a struct) of the previous (back) or next row of the key."""
    window = Window.partitionBy(key, SLICE).orderBy(*order)
    neighbour = (F.lag if back else F.lead)(value).over(window)
    if not hot:
        return rows.withColumn(name, neighbour)
    pick = (F.max_by if back else F.min_by)(value, F.struct(*order))
    per_key = Window.partitionBy("_key").orderBy("_at")
    edges = (
        rows.where(F.col(SLICE).isNotNull())
        .groupBy(F.col(key).alias("_key"), F.col(SLICE).alias("_at"))
        .agg(pick.alias("_edge"))
        .withColumn("_carry", (F.lag if back else F.lead)("_edge").over(per_key))
    )
    joined = join_edges(rows.withColumn(name, neighbour), key, edges)
    return joined.withColumn(name, F.coalesce(name, "_carry")).drop("_carry")


def with_previous(rows, key, value, order, hot, name="_previous") -> DataFrame:
    return _stitched(rows, key, value, order, hot, name, back=True)


def with_next(rows, key, value, order, hot, name="_next") -> DataFrame:
    return _stitched(rows, key, value, order, hot, name, back=False)
