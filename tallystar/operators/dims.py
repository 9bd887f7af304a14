"""Type-1 dimensions: extraction from denormalised events, and the upsert."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallystar import schemas
from tallystar.operators.rank import BEFORE_ALL, first_by_key, latest_by_key, written


@dataclass(frozen=True)
class Dimension:
    """A natural-keyed table filled from event columns of the same names."""

    table: str
    key: str
    schema: StructType
    constants: tuple[tuple[str, str], ...] = ()

    @property
    def carried(self) -> list[str]:
        """Non-key columns that come from the event."""
        fixed = {name for name, _ in self.constants}
        return [c for c in self.schema.names if c != self.key and c not in fixed]

    def shape(self, rows: DataFrame) -> DataFrame:
        for name, value in self.constants:
            rows = rows.withColumn(name, F.lit(value))
        return rows.select(*self.schema.names)

    def subset(self, events: DataFrame) -> DataFrame:
        """Event-grain projection onto the dimension's columns."""
        return self.shape(events.select(self.key, *self.carried))

    def latest(self, events: DataFrame) -> DataFrame:
        """Last event of each key wins; a NULL key makes no row."""
        return self.shape(latest_by_key(events, self.key, self.carried))

    def first(self, events: DataFrame) -> DataFrame:
        """First event of each key wins; a NULL or empty key makes no row."""
        return self.shape(first_by_key(events, self.key, self.carried))


COMPANY = Dimension(
    "dim_company", "company_id", schemas.DIM_COMPANY, (("industry", "General"),)
)
BRANCH = Dimension("dim_branch", "branch_id", schemas.DIM_BRANCH)
MANAGER = Dimension("dim_manager", "manager_id", schemas.DIM_MANAGER)
EMPLOYEE = Dimension("dim_employee", "employee_id", schemas.DIM_EMPLOYEE)
PROJECT = Dimension("dim_project", "project_code", schemas.DIM_PROJECT)

ORGANISATION = (COMPANY, BRANCH, MANAGER, EMPLOYEE, PROJECT)


def org_columns_select(events: DataFrame) -> dict[str, DataFrame]:
    """Each dimension's column subset of the events, at event grain."""
    return {d.table: d.subset(events) for d in ORGANISATION}


def dim_upsert(existing: DataFrame, new: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Full-row replace per key; other keys are kept; nothing is deleted."""
    keys = [key] if isinstance(key, str) else list(key)
    kept = existing.join(new.select(*keys), keys, "left_anti")
    return kept.select(*existing.columns).unionByName(new.select(*existing.columns))


def last_rows(
    events: DataFrame, dimensions: Sequence[Dimension] = ORGANISATION, first: Sequence[str] = ()
) -> tuple[DataFrame, int, datetime | None]:
    """The events among which the last one of every key of every dimension is: ``Dimension.latest`` over them
    equals ``latest`` over all events.  And how many events there are, up to when.  The first events of the keys ``first``
    are among them too, with a time and without.

    One narrow hash aggregation finds the times of all keys together; of its few rows come those of each key, and one join by
    time alone reads the wide rows.
    """
    at = F.coalesce("event_ts", F.lit(BEFORE_ALL).cast("timestamp_ntz"))
    lasting = [d.key for d in dimensions]
    keys = list(dict.fromkeys([*lasting, *first]))
    ends = {"_last": F.max(at), "_first": F.min(at), "_begin": F.min("event_ts"), "_upto": F.max("event_ts")}
    together = written(events.groupBy(*keys).agg(F.count("*").alias("_n"), *[c.alias(n) for n, c in ends.items()]), "heads")
    total = together.agg(F.sum("_n"), F.max("_upto")).first()
    wanted = [(k, F.max("_last")) for k in lasting] + [(k, F.min(c)) for k in first for c in ("_first", "_begin")]
    heads = [together.where(F.col(k).isNotNull()).groupBy(k).agg(c.alias("_head")).select("_head") for k, c in wanted]
    heads = written(reduce(DataFrame.unionByName, heads).where(F.col("_head").isNotNull()).distinct(), "times")
    return events.join(heads, at == F.col("_head"), "left_semi"), total[0] or 0, total[1]
