"""Type-2 users and the point-in-time lookup, against plain row-by-row replays."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks import fixtures
from tallystar import schemas
from tallystar.operators import rank, scd2
from tests.util import at, raw_frame, rows_of

START = at("2025-01-01 00:00:00")
OPEN = at("9999-12-31 23:59:59")
NAMES = schemas.DIM_USER_SCD2.names


def skewed_events(spark, n=600, seed=3):
    """One user holds half of the rows, most of them in a burst; many share a second."""
    rng = random.Random(seed)
    events = []
    for i in range(n):
        user = "U1" if rng.random() < 0.5 else f"U{rng.randint(2, 9)}"
        events.append(
            {
                "event_id": f"e{i:05d}",
                "event_ts": START
                + timedelta(
                    seconds=rng.randint(290, 310)
                    if user == "U1" and rng.random() < 0.7
                    else rng.randint(0, n)
                ),
                "user_id": user,
                "device_type": rng.choice(["Web", "iOS", None]),
                "city": rng.choice(["CP", "GGN"]),
            }
        )
    return raw_frame(spark, *events)


def replay_history(events):
    """Versions by walking each user's last event of every second in order."""
    versions, current = [], {}
    last_of = {(e.user_id, e.event_ts): e for e in sorted(events, key=lambda e: e.event_id)}
    for e in sorted(last_of.values(), key=lambda e: (e.user_id, e.event_ts)):
        attributes = tuple(e[c] for c in scd2.TRACKED)
        last = current.get(e.user_id)
        if last is None or last[1] != attributes:
            if last is not None:
                last[3] = e.event_ts
            current[e.user_id] = [e.user_id, attributes, e.event_ts, OPEN]
            versions.append(current[e.user_id])
    return sorted((u, f, t) for u, _, f, t in versions)


@pytest.fixture(scope="module")
def skewed(spark):
    return skewed_events(spark).persist()


@pytest.mark.parametrize("max_rows", [10_000, 50])
def test_history_equals_replay_whatever_the_slices(spark, skewed, max_rows):
    got = scd2.scd2_history(skewed, max_rows=max_rows)
    want = replay_history(skewed.collect())
    assert rows_of(got, "user_id", "effective_from", "effective_to") == want
    assert got.where("is_current").count() == skewed.select("user_id").distinct().count()


def test_slices_bound_a_hot_key(spark, skewed):
    sliced, hot = rank.add_slices(skewed, "user_id", "event_ts", 50)
    assert hot
    sizes = sliced.groupBy("user_id", rank.SLICE).count()
    assert sizes.agg(F.max("count")).first()[0] <= 50
    assert sizes.count() < 40
    plain, hot = rank.add_slices(skewed, "user_id", "event_ts", 10_000)
    assert not hot and plain.select(rank.SLICE).distinct().count() == 1


def test_intervals_are_disjoint_contiguous_with_one_current(spark, skewed):
    by_user = {}
    for r in scd2.scd2_history(skewed).collect():
        by_user.setdefault(r.user_id, []).append((r.effective_from, r.effective_to, r.is_current))
    for versions in by_user.values():
        versions.sort(key=lambda v: (v[0], v[1]))
        assert sum(v[2] for v in versions) == 1 and versions[-1][1] == OPEN
        assert all(a[1] == b[0] for a, b in zip(versions, versions[1:]))


def replay_lookup(events, versions):
    found = []
    for e in events:
        valid = [
            v
            for v in versions
            if v.user_id == e.user_id and v.effective_from <= e.event_ts < v.effective_to
        ]
        if valid:
            found.append((e.event_id, max(v.effective_from for v in valid)))
    return sorted(found)


@pytest.mark.parametrize(
    "how",
    [{}, {"max_rows": 40}, {"disjoint": False}],
    ids=["sorted", "sliced", "overlapping"],
)
def test_lookup_equals_replay(spark, skewed, how):
    events = skewed.select("event_id", "event_ts", "user_id")
    # Versions of the later half only: earlier events find none.
    late = skewed.where(F.col("event_ts") > F.lit(START + timedelta(seconds=300)).cast("timestamp_ntz"))
    versions = scd2.scd2_history(late)
    want = replay_lookup(events.collect(), versions.collect())
    assert 0 < len(want) < events.count()
    got = scd2.asof_lookup(events, versions, **how)
    assert rows_of(got, "event_id", "effective_from") == want


def test_overlapping_versions_latest_start_wins(spark):
    events = raw_frame(spark, {"event_id": "e", "event_ts": "2025-01-05 00:00:00"})
    versions = spark.createDataFrame(
        [
            ("sk1", "U1", at("2025-01-01 00:00:00"), OPEN),
            ("sk2", "U1", at("2025-01-03 00:00:00"), OPEN),
            ("sk3", "U1", at("2025-01-04 00:00:00"), at("2025-01-05 00:00:00")),
        ],
        "user_sk string, user_id string, effective_from timestamp_ntz, effective_to timestamp_ntz",
    )
    assert rows_of(scd2.asof_lookup(events, versions, disjoint=False), "user_sk") == [("sk2",)]


def replay_batches(batches):
    """The per-batch rule, user by user."""
    dim, counts = {}, []
    for batch in batches:
        latest = {}
        for e in sorted(batch, key=lambda e: (e.event_ts, e.event_id)):
            latest[e.user_id] = e
        inserts = updates = 0
        for user, e in latest.items():
            attributes = tuple(e[c] for c in scd2.TRACKED)
            versions = dim.setdefault(user, [])
            if versions and versions[-1][0] == attributes:
                continue
            if versions:
                versions[-1][2] = e.event_ts
                updates += 1
            versions.append([attributes, e.event_ts, OPEN])
            inserts += 1
        counts.append((inserts, updates))
    rows = sorted((u, f, t) for u, versions in dim.items() for _, f, t in versions)
    return rows, counts


def test_apply_equals_replay_over_batches(spark, skewed):
    cuts = [START + timedelta(seconds=s) for s in (-1, 150, 300, 450, 10_000)]
    dim = spark.createDataFrame([], schemas.DIM_USER_SCD2)
    batches, counts = [], []
    for lo, hi in zip(cuts, cuts[1:]):
        batch = skewed.where(
            (F.col("event_ts") > F.lit(lo).cast("timestamp_ntz"))
            & (F.col("event_ts") <= F.lit(hi).cast("timestamp_ntz"))
        )
        counts.append(tuple(scd2.scd2_counts(dim, batch).first()))
        after = scd2.scd2_apply(dim, batch)
        dim = spark.createDataFrame(after.collect(), schemas.DIM_USER_SCD2)
        batches.append(batch.collect())
    rows, want = replay_batches(batches)
    assert counts == want
    assert rows_of(dim, "user_id", "effective_from", "effective_to") == rows
    assert dim.select("user_sk").distinct().count() == len(rows)


def test_unchanged_user_keeps_its_version(spark):
    first = raw_frame(spark, {"event_id": "1", "event_ts": "2025-01-01 00:00:00", "city": None})
    again = raw_frame(spark, {"event_id": "2", "event_ts": "2025-01-02 00:00:00", "city": None})
    dim = scd2.scd2_apply(spark.createDataFrame([], schemas.DIM_USER_SCD2), first)
    assert tuple(scd2.scd2_counts(dim, again).first()) == (0, 0)
    assert rows_of(scd2.scd2_apply(dim, again), *NAMES) == rows_of(dim, *NAMES)


def test_fact_drops_rows_without_numbers(spark):
    raw = raw_frame(
        spark,
        {"event_id": "1", "event_ts": "2025-01-01 00:16:00"},
        {"event_id": "2", "event_ts": "2025-01-01 00:16:00", "lat": None},
    ).withColumn("watch_time", F.lit("7.5"))
    fact = scd2.fact_user_watch(raw, scd2.scd2_history(raw), text=False)
    assert fact.columns == schemas.FACT_USER_WATCH.names
    text = raw.select(*[F.col(c).cast("string") if c in ("lat", "lon") else F.col(c) for c in raw.columns])
    got = scd2.fact_user_watch(text, scd2.scd2_history(raw), text=True)
    assert rows_of(got, "event_id", "watch_time", "time_15min_sk") == [("1", 7.5, "202501010015")]


def test_published_counts(spark):
    """Counts of the two-batch replay at sf0.01, known from an independent replay."""
    raw = fixtures.raw(spark, "/root/testdata/sf0.01")
    one, two = fixtures.two_batches(raw)
    empty = spark.createDataFrame([], schemas.DIM_USER_SCD2)
    after_one = scd2.scd2_apply(empty, one)
    after_two = scd2.scd2_apply(after_one, two)
    assert (one.count(), two.count()) == (4668, 5332)
    assert tuple(scd2.scd2_counts(empty, one).first()) == (150, 0)
    assert tuple(scd2.scd2_counts(after_one, two).first()) == (150, 150)
    assert scd2.fact_user_watch(one, after_one).count() == 150
    assert scd2.fact_user_watch(two, after_two).count() == 5332
    history = scd2.scd2_history(raw)
    assert (after_two.count(), history.count()) == (300, 1777)
    assert scd2.fact_user_watch(raw, history).count() == 10_000


def overlapping(spark, n, seed=1, fractions=True):
    """Versions of one user that overlap, with odd ends, and events all over them."""
    rng = random.Random(seed)
    begin = datetime(2025, 1, 1)

    def instant():
        at_ = begin + timedelta(seconds=rng.randint(0, 5_000))
        return at_ + timedelta(microseconds=rng.choice([0, 0, 250_000, 999_999])) if fractions else at_

    versions = []
    for k in range(n):
        low = instant()
        high = rng.choice([low, instant(), low + timedelta(seconds=rng.randint(0, 3)), datetime(9999, 12, 31, 23, 59, 59)])
        versions.append((f"sk{k}", rng.choice(["U1", "U1", "U2", None]), low, high))
    events = [(f"e{k % (n - 5)}", rng.choice(["U1", "U2", None]), instant()) for k in range(n)]
    return (
        versions,
        events,
        spark.createDataFrame(versions, "user_sk string, user_id string, effective_from timestamp_ntz, effective_to timestamp_ntz"),
        spark.createDataFrame(events, "event_id string, user_id string, event_ts timestamp_ntz"),
    )


@pytest.mark.parametrize("fractions", [False, True])
def test_overlapping_versions_equal_brute_force(spark, fractions):
    versions, events, v, e = overlapping(spark, 120, fractions=fractions)
    best = {}
    for name, user, ts in events:
        for sk, of, low, high in versions:
            if user is not None and of == user and low <= ts < high:
                order = (-int((ts - datetime(1970, 1, 1)).total_seconds() // 1), low, sk)
                if name not in best or order > best[name][0]:
                    best[name] = (order, (name, sk, low, high))
    found = scd2.asof_lookup(e, v, disjoint=False)
    assert rows_of(found, "event_id", "user_sk", "effective_from", "effective_to") == sorted(r for _, r in best.values())


def test_a_hundred_thousand_overlapping_versions_make_no_pairs(spark):
    seconds = "timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, 0, 0, {})"
    versions = spark.range(100_000).selectExpr(
        "concat('sk', id) AS user_sk", "'U1' AS user_id", f"{seconds.format('id % 60000')} AS effective_from",
        f"{seconds.format('id % 60000 + 30000')} AS effective_to",
    )
    events = spark.range(100_000).selectExpr(
        "concat('e', id) AS event_id", "'U1' AS user_id", f"{seconds.format('id')} AS event_ts"
    )
    found = scd2.asof_lookup(events, versions, disjoint=False)
    # The last start up to the event, and of two that start together the greater key.
    got = found.select("event_id", "user_sk").collect()
    assert len(got) == 89_999
    for r in got[::997]:
        n = min(int(r.event_id[1:]), 59_999)
        assert r.user_sk == max(f"sk{k}" for k in (n, n + 60_000) if k < 100_000)


def test_history_of_ordinary_users_takes_one_shuffle(spark, skewed):
    plan = scd2.scd2_history(skewed, max_rows=10_000)
    plan.collect()
    final = plan._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in final
    sliced = scd2.scd2_history(skewed, max_rows=50)
    assert rows_of(plan, *plan.columns) == rows_of(sliced, *plan.columns)
