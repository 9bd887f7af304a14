import math
import random

import numpy as np
from pyspark.sql import functions as F

from tallystar.llm import negatives as N

SCHEMA = "vec_id bigint, embedding array<float>, label int, id bigint, q int, row string, place int, shard int, rank int"


def vectors(spark, rows):
    """Embeddings with further columns whose names the operator uses inside."""
    return spark.createDataFrame([(*r, *[None] * 6) for r in rows], SCHEMA)


def brute(rows, every=N.EVERY):
    """Rows of the result, straight from the rule."""
    part = []
    for name, vector, label in rows:
        if name is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if name % 7 == 0 else label
        part.append((name, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for k, (name, label, q) in enumerate(part):
        if name % every:
            continue
        scored = [
            (-sum(a * b for a, b in zip(q, other)), i, lab) for j, (i, lab, other) in enumerate(part) if j != k
        ]
        for score, positive, _ in sorted(s for s in scored if s[2] == label)[: N.POSITIVES]:
            found = [s for s in scored if s[2] != label and 30 * -score <= 100 * -s[0] <= 90 * -score]
            out += [(name, positive, r + 1, s[1], -score, -s[0]) for r, s in enumerate(sorted(found)[: N.NEGATIVES])]
    return sorted(out)


def mined(spark, rows, **sizes):
    found = N.hard_negatives(N.quantised(vectors(spark, rows)), F.col("id") % N.EVERY == 0, **sizes)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


def table(seed, n, width=6):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    rows = []
    for k in range(n):
        c = rng.choice(centres)
        # Few values, so that scores tie.
        rows.append((k, [round(x + rng.gauss(0, 0.4), 1) for x in c], rng.randrange(3)))
    return rows


def test_equals_brute_force_over_blocks_and_shards(spark):
    rows = table(3, 900)
    want = brute(rows)
    assert len(want) > 200
    assert mined(spark, rows) == want
    assert mined(spark, rows, shard_values=700, block_values=25) == want


def test_odd_rows(spark):
    rows = table(5, 260)
    nan, inf = float("nan"), float("inf")
    rows += [(None, [1.0] * 6, 1), (300, None, 1), (400, [1.0] * 6, None), (500, [1.0, None] * 3, 1)]
    rows += [(600, [nan] + [0.0] * 5, 2), (700, [inf] * 6, 2), (800, [], 1), (900, [0.0] * 6, 0), (1000, [2.0, 1.0], 1)]
    # Repeated rows, an anchor among them, and a label that only one row has.
    rows += [rows[100], rows[100], rows[7], (1100, [1.0] * 6, 99)]
    assert mined(spark, rows, shard_values=300, block_values=20) == brute(rows)
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (3, [1.0], 2)]) == []
    assert mined(spark, [(100, [1.0], 1)]) == []


def test_scores_beyond_floating_point_are_exact():
    rng = np.random.default_rng(1)
    big = rng.integers(-(1 << 29), 1 << 29, (50, 8))
    vector = rng.integers(-(1 << 29), 1 << 29, 8)
    assert N.products(big, vector).tolist() == [sum(int(a) * int(b) for a, b in zip(r, vector)) for r in big]
    huge = np.full((1, 8), 1 << 62)
    assert N.products(huge, huge[0]).tolist() == [(1 << 63) - 1]


def test_bounds_hold_and_spare_scores():
    """Every score lies within its bounds, and rows outside the window are not scored again."""
    rng = np.random.default_rng(2)
    centre = rng.normal(0, 200, 16)
    anchors = np.floor(centre + rng.normal(0, 3, (40, 16))).astype(np.int64)
    order, parent, edge = N.spanning_tree(anchors)
    assert sorted(order) == list(range(40)) and parent[0] == -1 and all(parent[k] < k for k in range(1, 40))
    anchors = anchors[order]
    for k in range(1, 40):
        assert math.isclose(edge[k], math.dist(anchors[k], anchors[parent[k]]))
    q = np.floor(rng.normal(0, 200, (500, 16))).astype(np.int64)
    shard = N.Shard(np.arange(500), np.arange(500), np.zeros(500, np.int64), q)
    scored = 0

    def wanted(place, low, high):
        exact = q @ anchors[place]
        assert (low <= exact).all() and (exact <= high).all()
        best = N.can_be_first(np.arange(500), low, high, np.arange(500), 5)
        assert set(np.argsort(-exact, kind="stable")[:5]) <= set(best)
        return best

    for place, rows, scores in N.walk(anchors, parent, edge, shard, wanted):
        assert (scores == q[rows] @ anchors[place]).all()
        scored += len(rows) if place else 0
    assert scored < 39 * 500 / 3
