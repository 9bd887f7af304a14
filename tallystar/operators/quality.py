"""Duplicates, orphans and region codes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.operators.rank import order_number, settle, written


def dedupe_by_key(
    rows: DataFrame,
    key: str = "event_id",
    existing: DataFrame | None = None,
    order: Sequence[str] = ("event_ts", "ingestion_ts"),
) -> DataFrame:
    """Primary-key insert: the first row of each key wins, stored keys stay as they are.

    A row with a NULL key is refused, as a primary key refuses it.

    ``existing`` may be narrowed by the caller to the partitions that can hold
    the batch's keys.
    """
    # Remaining columns end the order, so that equal times give one fixed answer.
    full_order = [*order, *[c for c in rows.columns if c != key and c not in order]]
    keyed = rows.where(F.col(key).isNotNull())
    # Keys that repeat, from narrow rows; the wide ones of all other keys pass as they are.
    repeated = keyed.groupBy(F.col(key).alias("_of")).agg(F.count("*").alias("_n")).where("_n > 1").select("_of")
    repeated, unique = written(repeated, "repeated"), keyed
    if not repeated.isEmpty():
        number, _ = order_number(rows, full_order)
        same = F.col(key) == F.col("_of")
        numbered = keyed.withColumn("_number", number)
        heads = numbered.join(repeated, same, "left_semi").groupBy(F.col(key).alias("_of")).agg(F.min("_number").alias("_head"))
        known = numbered.join(written(heads, "heads"), same, "left")
        single = known.where(F.col("_of").isNull()).select(*rows.columns)
        near = known.where(F.col("_number") == F.col("_head")).select(*rows.columns)
        unique = single.unionByName(settle(near, key, full_order, last=False))
    if existing is None:
        return unique
    return unique.join(existing.select(key), key, "left_anti").select(*rows.columns)


# Child table, its column, parent table: the relations the column names declare.
RELATIONS = (
    ("dim_branch", "company_id", "dim_company"),
    ("dim_manager", "branch_id", "dim_branch"),
    ("dim_employee", "manager_id", "dim_manager"),
    ("dim_employee", "branch_id", "dim_branch"),
    ("dim_employee", "project_code", "dim_project"),
    ("dim_project", "company_id", "dim_company"),
    ("fact_user_activity", "company_id", "dim_company"),
    ("fact_user_activity", "branch_id", "dim_branch"),
    ("fact_user_activity", "manager_id", "dim_manager"),
    ("fact_user_activity", "employee_id", "dim_employee"),
    ("fact_user_activity", "project_code", "dim_project"),
)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """(key value, rows) of child keys the parent lacks.

    The child is counted per key first, so the join sees one row per key.
    """
    per_key = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("orphan_rows"))
    return per_key.join(parent.select(key), key, "left_anti")


def fk_orphans(tables: dict[str, DataFrame], relations=RELATIONS) -> DataFrame:
    """Per relation: orphan rows and distinct orphan keys (zero rows included).

    Every table is read once: its rows give its own key, as a parent, and the keys
    they point to, as a child.  All of them are counted per (parent, value), where a
    value without a parent's row is an orphan of the relations that hold it.
    """
    known = [r for r in relations if r[0] in tables and r[2] in tables]
    keys = {parent: key for _, key, parent in known}

    def values(name: str, rows: DataFrame) -> DataFrame:
        found = [(name, keys[name], -1)] if name in keys else []
        found += [(parent, key, n) for n, (child, key, parent) in enumerate(known) if child == name]
        pairs = [
            F.struct(F.lit(p).alias("parent"), F.col(k).alias("value"), F.lit(n).alias("relation"))
            for p, k, n in found
        ]
        return rows.select(F.explode(F.array(*pairs)).alias("v")).select("v.*")

    used = {t for child, _, parent in known for t in (child, parent)}
    every = reduce(DataFrame.unionByName, [values(n, r) for n, r in tables.items() if n in used])
    per_value = (
        every.where(F.col("value").isNotNull())
        .groupBy("parent", "value")
        .agg(
            F.count_if(F.col("relation") == -1).alias("there"),
            *[F.count_if(F.col("relation") == n).alias(f"n{n}") for n in range(len(known))],
        )
    )
    totals = per_value.where("there = 0").agg(
        *[F.coalesce(F.sum(f"n{n}"), F.lit(0)).alias(f"n{n}") for n in range(len(known))],
        *[F.count_if(F.col(f"n{n}") > 0).alias(f"k{n}") for n in range(len(known))],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(child).alias("child_table"),
                F.lit(key).alias("fk_column"),
                F.lit(parent).alias("parent_table"),
                F.col(f"n{n}").alias("orphan_rows"),
                F.col(f"k{n}").alias("orphan_keys"),
            )
            for n, (child, key, parent) in enumerate(known)
        ]
    )
    return totals.select(F.inline(lines))


def region_conformance(events: DataFrame, regions: DataFrame) -> DataFrame:
    """Region codes of the events that the region dimension does not know."""
    return orphans(events, regions, "region_code").select(
        "region_code", F.col("orphan_rows").alias("events")
    )


def run_counts(steps: dict[str, DataFrame]) -> DataFrame:
    """One metric row per step: how many rows it holds."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(step).alias("step"), "row_count")
        for step, df in steps.items()
    ]
    return reduce(DataFrame.unionByName, counts)
