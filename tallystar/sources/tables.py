"""Parquet tables of three kinds.

``SnapshotTable`` is replaced as a whole.  Each replacement is a new ``v=<n>``
directory and readers take the newest one that carries ``_SUCCESS``, so a run
may read the table it is about to replace and a broken write is never seen.

``BucketTable`` holds rows by key in a fixed number of buckets.  A run replaces the buckets it touches; a
version is one small file that names for each bucket the directory of the run that wrote it last.

``AppendTable`` grows by named runs.  A table with an event time has a directory for each of its
days first, in which every run has one of its own; a reader that asks for the time since a
mark lists the days after it only.  A run is committed by one small file, which also says what earlier tries
of the same run it replaces: a replay is written beside them and switched in at once.
``compact`` merges the runs of closed days.  The epoch second of the event is stored too, as
Parquet row groups are skipped by the statistics of a bigint, not of a TIMESTAMP_NTZ.

    <table>/_runs/<number>-<token>~<name>~<replaced numbers>     a committed run
    <table>/event_date=<day>/rows=<number>-<token>/              its rows of a day
    <table>/event_date=<day>/rows=<number>-<token>-base/         rows of all runs up to that number
    <table>/event_date=<day>/_base~<number>-<token>              commits the one above
    <table>/_folded/<name>/<number>                              a run that lies in bases only
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Collection, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType

from tallystar.functions.timestamps import epoch_seconds
from tallystar.sources import files
from tallystar.sources.rows import empty

KEPT_VERSIONS = 3
# Stored next to the rows of a table with an event time, to prune by.
EVENT_DATE, EVENT_SECOND = "event_date", "event_second"
# The number of the run that wrote a row, and the directory level of runs.
RUN_NUMBER, ROWS = "run_number", "rows"
# Bytes of a file that ``compact`` writes.
FILE_BYTES = 128 << 20
NO_DAY = f"{EVENT_DATE}=__HIVE_DEFAULT_PARTITION__"


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str, name: str, schema: StructType):
        self.spark, self.name, self.schema = spark, name, schema
        self.path = f"{root.rstrip('/')}/{name}"

    def _versions(self) -> list[str]:
        """Version directories, oldest first: ``v=<number>`` or ``v=<number>.<run>``."""
        return sorted(n for n in files.children(self.spark, self.path) if n.startswith("v="))

    def _committed(self, before_run: str | None = None) -> list[str]:
        return [
            v
            for v in self._versions()
            if not (before_run and v.endswith(f".{before_run}"))
            and files.exists(self.spark, f"{self.path}/{v}/_SUCCESS")
        ]

    def read(self, before_run: str | None = None) -> DataFrame:
        """The newest version; ``before_run`` skips what an earlier try of that run wrote."""
        versions = self._committed(before_run)
        if not versions:
            return empty(self.spark, self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{versions[-1]}")

    def replace(self, rows: DataFrame, run: str | None = None) -> None:
        """Write a new version.  A run owns one version: its retries write over their own.

        ``rows`` of a retry must not read that version (``read(before_run=run)``).
        """
        versions = self._versions()
        last = max((int(v[2:].split(".")[0]) for v in versions), default=0)
        own = [v for v in versions if run and v.endswith(f".{run}")]
        version = own[-1] if own else f"v={last + 1:08d}" + (f".{run}" if run else "")
        rows.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/{version}")
        # Readers may still hold the versions before this one.
        older = [v for v in self._committed() if v < version]
        for old in older[: 1 - KEPT_VERSIONS]:
            files.remove(self.spark, f"{self.path}/{old}")

    def ensure(self) -> None:
        """Create the table when missing, keeping data."""
        if not self._committed():
            self.recreate()

    def recreate(self) -> None:
        """Drop and create empty."""
        self.replace(empty(self.spark, self.schema))


class BucketTable:
    """``<table>/_versions/<number>~<run>`` lists ``<bucket> <token>``; the rows lie in ``<table>/token=<token>``, ordered by
    their bucket, in as many files as they need.  A token ends with the number of buckets it was written with."""

    BUCKET, TOKEN = "bucket", "token"

    def __init__(self, spark: SparkSession, root: str, name: str, schema: StructType, key: str, buckets: int = 1_000):
        self.spark, self.name, self.schema = spark, name, schema
        self.path, self.key, self.buckets = f"{root.rstrip('/')}/{name}", key, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias(self.BUCKET)

    def summed(self, rows: DataFrame, *measures: Column) -> list[Row]:
        """Measures of the rows by their bucket, NULL for rows without a key: as many as there are buckets, and one more."""
        bucket = F.when(F.col(self.key).isNotNull(), self._bucket()).alias(self.BUCKET)
        return rows.groupBy(bucket).agg(*(measures or [F.count("*")])).collect()

    def touched(self, keys: DataFrame) -> list[int]:
        """Buckets of the keys, as many as there are buckets at most."""
        return self.of(self.summed(keys))

    def of(self, sums: Sequence[Row]) -> list[int]:
        """The buckets of ``summed``."""
        return sorted(r[self.BUCKET] for r in sums if r[self.BUCKET] is not None)

    def _versions(self, before_run: str | None = None) -> list[str]:
        versions = sorted(files.children(self.spark, f"{self.path}/_versions"))
        return [v for v in versions if not (before_run and v.endswith(f"~{before_run}"))]

    def _places(self, version: str | None) -> dict[int, str]:
        if version is None:
            return {}
        lines = files.read_text(self.spark, f"{self.path}/_versions/{version}").split("\n")
        return {int(b): token for b, _, token in (line.partition(" ") for line in lines if line)}

    def _last(self, before_run: str | None) -> dict[int, str]:
        return self._places(next(iter(self._versions(before_run)[::-1]), None))

    def _place(self, token: str) -> str:
        return f"{self.path}/{self.TOKEN}={token}"

    def read(self, buckets: Sequence[int] | None = None, before_run: str | None = None) -> DataFrame:
        """The newest version, or some of its buckets; ``before_run`` skips what an earlier try of that run wrote."""
        places = self._last(before_run)
        wanted = places if buckets is None else {b: places[b] for b in buckets if b in places}
        if not wanted:
            return empty(self.spark, self.schema)
        tokens = sorted(set(wanted.values()))
        stored = StructType([*self.schema.fields, StructField(self.BUCKET, IntegerType()), StructField(self.TOKEN, StringType())])
        rows = self.spark.read.schema(stored).option("basePath", self.path).parquet(*[self._place(t) for t in tokens])
        if len(wanted) < len(places):  # row groups of other buckets are skipped
            rows = rows.where(F.col(self.BUCKET).isin(*wanted))
        if len(wanted) < sum(map(_written_buckets, tokens)):  # buckets that a later run has taken elsewhere
            holders = F.lit([wanted.get(b, "") for b in range(self.buckets)])
            rows = rows.where(F.get(holders, F.col(self.BUCKET)) == F.col(self.TOKEN))
        return rows.select(*self.schema.names)

    def replace(self, rows: DataFrame, buckets: Sequence[int], run: str) -> None:
        """A version in which ``buckets`` hold ``rows``, and the others what they held before the run.

        Of tokens of which less than half would be left, the rest is written anew too: what no version needs takes no more room
        than what it needs.
        """
        places, mine = self._last(run), set(buckets)
        left = Counter(t for b, t in places.items() if b not in mine)
        thin = [b for b, t in places.items() if b not in mine and 2 * left[t] < _written_buckets(t)]
        if thin:
            rows = rows.select(*self.schema.names).unionByName(self.read(thin, before_run=run))
        mine |= set(thin)
        now = {b: t for b, t in places.items() if b not in mine}
        if mine:
            token = f"{uuid.uuid4().hex[:12]}-{len(mine)}"
            # As many files as the rows need: a large bucket is split, small ones share a task.
            rows = rows.select(*self.schema.names, self._bucket()).hint("rebalance", self.BUCKET)
            rows.sortWithinPartitions(self.BUCKET).write.parquet(self._place(token))
            now |= dict.fromkeys(mine, token)
        versions = self._versions()
        number = int(versions[-1].partition("~")[0]) + 1 if versions else 1
        text = "\n".join(f"{b} {t}" for b, t in sorted(now.items()))
        files.create(self.spark, f"{self.path}/_versions/{number:012d}~{run}", text)
        # Readers may still hold the versions before this one, and a retry needs the last of another run.
        older = [v for v in versions if not v.endswith(f"~{run}")][: 1 - KEPT_VERSIONS]
        if older:
            kept = {t for v in self._versions() if v not in older for t in self._places(v).values()}
            for version in older:
                for token in set(self._places(version).values()) - kept:
                    files.remove(self.spark, self._place(token))
                files.remove(self.spark, f"{self.path}/_versions/{version}")

    def ensure(self) -> None:
        if not files.exists(self.spark, self.path):
            self.recreate()

    def recreate(self) -> None:
        files.remove(self.spark, self.path)
        files.make_dir(self.spark, f"{self.path}/_versions")


@dataclass(frozen=True, order=True)
class Run:
    """A committed run as its file's name tells: number, token of the try, name, numbers of the tries it replaces."""

    number: int
    token: str
    name: str
    replaces: tuple[int, ...] = ()

    @property
    def place(self) -> str:
        return f"{ROWS}={self.number:012d}-{self.token}"

    @property
    def file(self) -> str:
        return f"{self.number:012d}-{self.token}~{self.name}~{'.'.join(map(str, self.replaces))}"

    @classmethod
    def read(cls, file: str) -> Run:
        place, name, replaces = file.split("~")
        number, token = place.split("-")
        return cls(int(number), token, name, tuple(int(n) for n in replaces.split(".") if n))


def _number(place: str) -> int:
    """The run number in the name of a ``rows`` directory or of a base's mark."""
    return int(place.partition("=")[2].partition("-")[0] or place.partition("~")[2].partition("-")[0])


class AppendTable:
    """One writer at a time; ``compact`` may run beside it."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        name: str,
        schema: StructType,
        run_columns: Sequence[str] = ("run_id",),
        date_from: str | None = None,
    ):
        self.spark, self.name, self.schema = spark, name, schema
        self.path = f"{root.rstrip('/')}/{name}"
        self.run_columns, self.date_from = tuple(run_columns), date_from

    @property
    def _stored(self) -> StructType:
        fields = [StructField(EVENT_SECOND, LongType())] if self.date_from else []
        fields.append(StructField(RUN_NUMBER, LongType()))
        if self.date_from:
            fields.append(StructField(EVENT_DATE, DateType()))
        return StructType([*self.schema.fields, *fields, StructField(ROWS, StringType())])

    def _children(self, *below: str) -> list[str]:
        return files.children(self.spark, "/".join([self.path, *[b for b in below if b]]))

    def _runs(self) -> list[Run]:
        """Committed runs that are not in bases only, in order; the last one of a name is valid."""
        return sorted(Run.read(f) for f in self._children("_runs"))

    def _days(self, since: date | None = None) -> list[str]:
        """Directories of days from ``since`` on; a table without event time has one for all rows."""
        if not self.date_from:
            return [""]
        days = sorted(d for d in self._children() if d.startswith(f"{EVENT_DATE}="))
        if since is None:
            return days
        return [d for d in days if d != NO_DAY and d >= f"{EVENT_DATE}={since.isoformat()[:10]}"]

    def _parts(self, inside: list[str], valid: dict[str, Run]) -> tuple[list[str], int]:
        """What a day consists of, whose directory lists ``inside``: its base and the later runs; and the number the
        base reaches to."""
        base = max((n for n in inside if n.startswith("_base~")), default=None)
        upto = _number(base) if base else 0
        parts = [f"{ROWS}={base.partition('~')[2]}-base"] if base else []
        return parts + [n for n in inside if n in valid and valid[n].number > upto], upto

    def _scan(self, paths: list[str], hidden: set[int]) -> DataFrame:
        # The declared schema spares the inference job.
        rows = self.spark.read.schema(self._stored).option("basePath", self.path).parquet(*paths)
        return rows.where(~F.col(RUN_NUMBER).isin(*sorted(hidden))) if hidden else rows

    def _named(self, runs: list[Run], first: str) -> set[int]:
        """Numbers of all tries of the runs whose first column is ``first``, those in bases too."""
        mine = {_quoted(first)} if len(self.run_columns) == 1 else {
            n for n in [*self._children("_folded"), *[r.name for r in runs]] if n.split(",")[0] == _quoted(first)
        }
        found = {x for r in runs if r.name in mine for x in (r.number, *r.replaces)}
        return found | {int(n) for name in mine for n in self._children("_folded", name)}

    def changed_days(self, after: int) -> tuple[list[str], int]:
        """Directories of the days that runs with a number above ``after`` may have changed, and the last run's number."""
        runs = self._runs()
        late = [r for r in runs if r.number > after]
        days = self._days()
        if not any(r.replaces for r in late):  # what a replaced run held may be on any day
            days = [d for d in days if any(n.startswith(f"{ROWS}=") and _number(n) > after for n in self._children(d))]
        return days if late else [], runs[-1].number if runs else after

    def read(
        self,
        prunable: bool = False,
        without_run: str | None = None,
        since: date | None = None,
        days: Collection[str] | None = None,
    ) -> DataFrame:
        """All rows, or those of the days from ``since`` on or of the directories ``days``, of which alone files are listed.

        ``prunable`` adds event_date and event_second of a table with an event
        time.  ``without_run`` leaves out one run, for a retry that replaces it.
        """
        pruning = [EVENT_DATE, EVENT_SECOND] if prunable and self.date_from else []
        columns = [*self.schema.names, *pruning]
        runs = self._runs()
        hidden = {n for r in runs for n in r.replaces}
        if without_run is not None:
            hidden |= self._named(runs, without_run)
        valid = {r.place: r for r in runs if r.number not in hidden}
        paths = [
            "/".join([p for p in (self.path, day, part) if p])
            for day in self._days(since)
            if days is None or day in days
            for part in self._parts(self._children(day), valid)[0]
        ]
        if not paths:
            return empty(self.spark, self._stored).select(*columns)
        # Directories of replaced runs are not read; only bases may hold rows of such.
        merged = any(p.endswith("-base") for p in paths)
        return self._scan(paths, hidden if merged else set()).select(*columns)

    def write_run(self, rows: DataFrame, *run: object) -> None:
        """Write the rows of one run, replacing what that run wrote before.  Readers see
        the earlier rows until the new ones are whole."""
        if len(run) != len(self.run_columns):
            raise ValueError(f"{self.name} needs {self.run_columns}")
        name = ",".join(map(_quoted, run))
        runs = self._runs()
        earlier = {x for r in runs if r.name == name for x in (r.number, *r.replaces)}
        earlier |= {int(n) for n in self._children("_folded", name)}
        # A token keeps apart what a broken try of the same number has left.
        last = runs[-1].number if runs else 0
        new = Run(last + 1, uuid.uuid4().hex[:12], name, tuple(sorted(earlier)))
        stored = {RUN_NUMBER: F.lit(new.number).cast("long"), ROWS: F.lit(new.place.partition("=")[2])}
        if self.date_from:
            event_ts = F.col(self.date_from)
            stored |= {EVENT_SECOND: epoch_seconds(event_ts), EVENT_DATE: event_ts.cast("date")}
        levels = [EVENT_DATE, ROWS] if self.date_from else [ROWS]
        rows = rows.select(*self.schema.names).withColumns(stored)
        rows.write.mode("append").partitionBy(*levels).parquet(self.path)
        files.create(self.spark, f"{self.path}/_runs/{new.file}")

    def compact(self, before: date | None = None) -> int:
        """Merge the runs of each day before ``before`` (of all days without it) to one base; returns how many
        days were written.

        Readers see a day's runs or its base.  What a base replaces stays until the next call, for those
        who still read it.  A run whose rows lie in bases only leaves the list that every reader reads.
        """
        runs = self._runs()
        if not runs:
            return 0
        upto = runs[-1].number
        hidden = {n for r in runs for n in r.replaces}
        valid = {r.place: r for r in runs if r.number not in hidden}
        replays = [(old, r.number) for r in runs for old in r.replaces]
        inside = {day: self._children(day) for day in self._days()}
        reached: dict[str, int] = {}
        todo = []
        for day, names in inside.items():
            parts, base = self._parts(names, valid)
            closed = before is None or day in ("", NO_DAY) or day < f"{EVENT_DATE}={before.isoformat()[:10]}"
            stale = any(old <= base < new for old, new in replays)
            reached[day] = base
            if closed and parts and (stale or len(parts) > (base > 0)):
                todo.append((day, parts, base))

        def merge(day: str, parts: list[str], base: int) -> None:
            where = "/".join([p for p in (self.path, day) if p])
            paths = [f"{where}/{p}" for p in parts]
            count = -(-sum(files.size(self.spark, p) for p in paths) // FILE_BYTES)
            rows = self._scan(paths, hidden).drop(EVENT_DATE, ROWS)
            if self.date_from:
                rows = rows.repartitionByRange(count, EVENT_SECOND) if count > 1 else rows.coalesce(1)
                rows = rows.sortWithinPartitions(EVENT_SECOND)
            else:
                rows = rows.repartition(count) if count > 1 else rows.coalesce(1)
            place = f"{upto:012d}-{uuid.uuid4().hex[:12]}"
            rows.write.parquet(f"{where}/{ROWS}={place}-base")
            files.create(self.spark, f"{where}/_base~{place}")
            reached[day] = upto
            # What the base before this one had replaced, and what broken tries have left.
            for name in inside[day]:
                if name.startswith((f"{ROWS}=", "_base~")) and name not in parts and _number(name) <= base:
                    files.remove(self.spark, f"{where}/{name}")

        with ThreadPoolExecutor(4) as pool:  # days do not depend on each other
            list(pool.map(lambda x: merge(*x), todo))
        # A run that lies outside bases, or replaces rows in one, stays in the list.  So does the last one: it numbers the next.
        for r in runs[:-1]:
            outside = any(r.place in names and reached[day] < r.number for day, names in inside.items())
            needed = any(old <= base < r.number for old in r.replaces for base in reached.values())
            if r.number not in hidden and (outside or needed):
                continue
            if r.number not in hidden:
                files.create(self.spark, f"{self.path}/_folded/{r.name}/{r.number:012d}")
            files.remove(self.spark, f"{self.path}/_runs/{r.file}")
        return len(todo)

    def ensure(self) -> None:
        if not files.exists(self.spark, self.path):
            self.recreate()

    def recreate(self) -> None:
        files.remove(self.spark, self.path)
        files.make_dir(self.spark, f"{self.path}/_runs")


def _written_buckets(token: str) -> int:
    """How many buckets a token of a ``BucketTable`` was written with."""
    return int(token.rpartition("-")[2])


def _quoted(value: object) -> str:
    """A run's column as part of a file name."""
    return quote(str(value), safe="").replace("~", "%7E")


def not_before(rows: DataFrame, ts: Column) -> DataFrame:
    """Skip days, files and row groups that end before ``ts``, where the rows allow it.

    Keeps the whole second of ``ts``; the exact condition stays with the caller.
    """
    if EVENT_DATE in rows.columns:
        rows = rows.where(F.col(EVENT_DATE) >= ts.cast("date"))
    if EVENT_SECOND in rows.columns:
        rows = rows.where(F.col(EVENT_SECOND) >= epoch_seconds(ts))
    return rows
