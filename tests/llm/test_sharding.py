import random
import zlib
from itertools import groupby

from pyspark.sql import functions as F

from tallystar.llm import sharding
from tests.llm.util import documents, odd_rows, sentence


def least_capacity(sizes, shards):
    """By trying: the smallest capacity that greedy filling gets by with."""

    def fits(capacity):
        used, load = 1, 0
        for s in sizes:
            if load + s > capacity:
                used, load = used + 1, 0
            load += s
        return used <= shards

    low = max(sizes)
    while not fits(low):
        low += 1
    return low


def test_cuts_are_minimax_and_leave_no_shard_empty():
    rng = random.Random(5)
    for _ in range(1500):
        n, shards = rng.randint(1, 40), rng.randint(1, 8)
        sizes = sorted((rng.choice([rng.randint(1, 9), rng.randint(1, 200), 8]) for _ in range(n)), reverse=True)
        ends = sharding.Groups([(s, len(list(g))) for s, g in groupby(sizes)]).cuts(shards)
        assert len(ends) == shards and ends == sorted(ends) and ends[-1] == n
        loads = [sum(sizes[a:b]) for a, b in zip([0, *ends], ends)]
        assert max(loads) == least_capacity(sizes, shards)
        assert n < shards or min(loads) > 0


def check(spark, rows, shards):
    out = sharding.assign(documents(spark, rows), shards).collect()
    assert len(out) == len(rows)
    texts = dict(rows)
    by_text, loads, slots = {}, [0] * shards, {}
    for r in out:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        raw = (texts[r.doc_id] or "").encode()
        if r.doc_id is not None:
            assert r["size"] == len(raw) + 8 and r.text_crc32 == zlib.crc32(raw)
            by_text.setdefault(raw, set()).add(r.shard)
        loads[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = {}
    for i, t in rows:
        groups[t or ""] = groups.get(t or "", 0) + len((t or "").encode()) + 8
    assert max(loads) == least_capacity(sorted(groups.values(), reverse=True), shards)
    return loads


def test_odd_table(spark):
    check(spark, odd_rows(), 24)
    assert sharding.assign(documents(spark, odd_rows()).where(F.lit(False))).count() == 0


def test_even_loads_beside_a_giant_group(spark):
    rows = [(k, sentence(k % 97, 5 + k % 13)) for k in range(600)]
    rows += [(1000 + k, "the same text " * 8) for k in range(400)]
    loads = check(spark, rows, 8)
    rest = sorted(loads)[:-1]
    assert max(rest) - min(rest) <= 0.05 * max(rest)


def test_no_python_in_the_plan(spark):
    plan = sharding.assign(documents(spark, odd_rows()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
