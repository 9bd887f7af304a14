"""Hard negatives of anchor vectors, by score bounds along a spanning tree of the anchors.

Scores are integer inner products.  The anchors come in blocks and all rows in shards, both of bounded size, and every
block meets every shard: a stated set of queries against all rows.  The anchors of a block span a tree of least
distances.  The root's scores in a shard are computed; for any other anchor c with parent p, and a row x,

    score(p, x) - |c - p| |x|  <=  score(c, x)  <=  score(p, x) + |c - p| |x|,

where a parent's own score may be a pair of bounds again.  Only rows whose bounds meet the wanted window, and can be among the
first ones in it, are scored again.  A shard returns its first few rows of each anchor, and the first of these over all
shards are the result: the positives, and with their scores known, in a second pass, the negatives.

Cases: a row with a null id, label or vector, or with a null or non-finite component, takes no part; shorter vectors count as
filled up with zeros; components beyond 64 bits are the nearest 64-bit number, and so are scores; repeated rows are rows of their own,
each of them an anchor where one is, and a copy of an anchor is another row; ties go by id; an anchor without positives, or a positive without
negatives, has no rows; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.llm.common import kept

POSITIVES, NEGATIVES = 5, 10
#: A negative's score in hundredths of the positive's: from, to.
LOW, HIGH = 30, 90
#: Labels of rows whose id is divisible by ``TURN`` move on by one of ``LABELS``; anchors are rows with an id divisible by ``EVERY``.
TURN, LABELS, EVERY, SCALE = 7, 10, 100, 256
#: Components of a shard of rows and of a block of anchors, on average.
SHARD_VALUES, BLOCK_VALUES = 1 << 20, 1 << 16

_EXACT = 1 << 53
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def quantised(embeddings: DataFrame) -> DataFrame:
    """(id, label, q) of the rows that take part: labels moved on, components times ``SCALE`` rounded down."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    label = F.col("label").cast("long")
    return embeddings.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite
    ).select(
        F.col("vec_id").alias("id"),
        F.when(F.col("vec_id") % TURN == 0, (label + 1) % LABELS).otherwise(label).alias("label"),
        F.transform("embedding", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double"))).alias("q"),
    )


def matrix(vectors, width: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


def products(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Inner products as 64-bit integers, exact; beyond 64 bits the nearest."""
    if not rows.size:
        return np.zeros(len(rows), np.int64)
    most = max(abs(int(rows.max())), abs(int(rows.min()))) * max(abs(int(vector.max())), abs(int(vector.min())))
    if most * len(vector) < _EXACT:
        return (rows.astype(np.float64) @ vector.astype(np.float64)).astype(np.int64)
    found = rows.astype(object) @ vector.astype(object)
    return np.array([min(max(int(x), _LEAST), _MOST) for x in found], np.int64)


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge): points in an order in which each comes after its parent, the parent's place in it (-1 for
    the root), and the distance to it.  Prim's algorithm, from the first point."""
    n = len(points)
    real = points.astype(np.float64)
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n)
    nearest, through = np.full(n, np.inf), np.full(n, -1)
    free = np.ones(n, bool)
    at = 0
    for place in range(n):
        if place:
            at = int(np.where(free, nearest, np.inf).argmin())
            if not free[at]:  # distances beyond floating point
                at = int(free.argmax())
            parent[place], edge[place] = through[at], nearest[at]
        order[place], free[at] = at, False
        distance = np.sqrt(((real - real[at]) ** 2).sum(axis=1))
        closer = free & ((distance < nearest) | (through < 0))
        nearest[closer], through[closer] = distance[closer], place
    return order, parent, edge


@dataclass
class Shard:
    """Rows of a shard: ids, row numbers, labels, vectors and their lengths."""

    id: np.ndarray
    row: np.ndarray
    label: np.ndarray
    q: np.ndarray

    def __post_init__(self):
        self.norm = np.sqrt((self.q.astype(np.float64) ** 2).sum(axis=1))


def walk(
    anchors: np.ndarray,
    parent: np.ndarray,
    edge: np.ndarray,
    shard: Shard,
    wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray],
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place, rows, scores) of each anchor, in the tree's order: the rows that ``wanted`` picks by their lower and upper bounds,
    scored.  Bounds are wider than rounding errors."""
    last = np.arange(len(anchors))
    for place in range(1, len(anchors)):
        last[parent[place]] = place
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for place, vector in enumerate(anchors):
        if place:
            low, high = held[parent[place]]
            reach = edge[place] * shard.norm
            reach = reach * (1 + 1e-9) + 1e-9 * np.maximum(np.abs(low), np.abs(high)) + 1
            most = np.sqrt((vector.astype(np.float64) ** 2).sum()) * shard.norm * (1 + 1e-9) + 1
            low, high = np.maximum(low - reach, -most), np.minimum(high + reach, most)
            rows = wanted(place, low, high)
            scores = products(shard.q[rows], vector)
            low[rows] = high[rows] = scores
        else:
            all_scores = products(shard.q, vector)
            low, high = all_scores.astype(np.float64), all_scores.astype(np.float64)
            rows = wanted(place, low, high)
            scores = all_scores[rows]
        held[place] = (low, high)
        for done in {place, int(parent[place])}:
            if done >= 0 and last[done] <= place:
                held.pop(done, None)
        yield place, rows, scores


def first(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places in ``rows`` of the ``n`` best: higher scores first, then smaller ids."""
    if len(rows) > n:
        least = np.partition(scores, len(rows) - n)[len(rows) - n]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(rows))
    return some[np.lexsort((ids[rows[some]], ~scores[some]))][:n]


def can_be_first(rows: np.ndarray, low: np.ndarray, high: np.ndarray, sure: np.ndarray, n: int) -> np.ndarray:
    """Of ``rows`` those that can be among the ``n`` best, where ``sure`` ones are in the running."""
    if len(sure) < n:
        return rows
    least = np.partition(low[sure], len(sure) - n)[len(sure) - n]
    return rows[high[rows] >= least]


def _frames(left: pd.DataFrame, right: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, Shard]:
    left = left.sort_values("place")
    width = max([0, *map(len, left["q"]), *map(len, right["q"])])
    shard = Shard(
        right["id"].to_numpy(), right["row"].to_numpy(), right["label"].to_numpy(), matrix(right["q"].to_list(), width)
    )
    return left, matrix(left["q"].to_list(), width), shard


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    shard_values: int = SHARD_VALUES,
    block_values: int = BLOCK_VALUES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows (id, label, q array<bigint>).

    For each row with ``anchor``, its first ``positives`` other rows of the same label, and for each of these the first
    ``negatives`` rows of another label that score between ``low`` and ``high`` hundredths of the positive's score."""
    # Written, so that a row's number is the same whoever reads it.
    rows = kept(rows.withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    is_anchor = F.coalesce(anchor, F.lit(False))
    size = F.size("q").cast("long") + 1
    sizes = rows.agg(F.sum(size).alias("all"), F.sum(F.when(is_anchor, size)).alias("anchors")).first()
    shards = -(-(sizes["all"] or 0) // shard_values) or 1
    blocks = -(-(sizes["anchors"] or 0) // block_values) or 1
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    of = lambda n, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n)).cast("int")
    answering = rows.withColumn("shard", of(shards, 1)).withColumn("block", each(blocks)).groupBy("block", "shard")

    def span(frame: pd.DataFrame) -> pd.DataFrame:
        width = max(map(len, frame["q"]))
        frame = frame.sort_values("row")
        order, parent, edge = spanning_tree(matrix(frame["q"].to_list(), width))
        return frame.iloc[order].assign(place=np.arange(len(order)), parent=parent, edge=edge)[tree_columns]

    tree_schema = "block int, row bigint, id bigint, label bigint, q array<bigint>, place int, parent int, edge double"
    tree_columns = [f.split()[0] for f in tree_schema.split(", ")]
    tree = rows.where(is_anchor).withColumn("block", of(blocks, 2)).groupBy("block").applyInPandas(span, tree_schema)
    tree = kept(tree, "negatives-tree")

    def nearest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left, vectors, shard = _frames(left, right)
        labels, numbers, names = left["label"].to_numpy(), left["row"].to_numpy(), left["id"].to_numpy()

        def wanted(place: int, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
            own = np.flatnonzero((shard.label == labels[place]) & (shard.row != numbers[place]))
            return can_be_first(own, lower, upper, own, positives)

        out = [(np.empty(0, np.int64),) * 4]
        for place, some, scores in walk(vectors, left["parent"].to_numpy(), left["edge"].to_numpy(), shard, wanted):
            best = first(some, scores, shard.id, positives)
            number = np.full(len(best), numbers[place])
            out.append((number, np.full(len(best), names[place]), shard.id[some[best]], scores[best]))
        columns = ["row", "anchor_id", "positive_id", "positive_score"]
        return pd.DataFrame(dict(zip(columns, map(np.concatenate, zip(*out)))))

    asking = tree.withColumn("shard", each(shards))
    found = asking.groupBy("block", "shard").cogroup(answering).applyInPandas(
        _if_both(nearest, ["row", "anchor_id", "positive_id", "positive_score"]),
        "row bigint, anchor_id bigint, positive_id bigint, positive_score bigint",
    )
    order = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id")
    best = found.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= positives)
    per_anchor = kept(
        best.groupBy("row").agg(
            F.array_sort(F.collect_list(F.struct("turn", "positive_id", "positive_score"))).alias("positives")
        ),  # at most ``positives`` entries
        "negatives-positives",
    )

    def harder(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left, vectors, shard = _frames(left, right)
        labels, numbers, names = left["label"].to_numpy(), left["row"].to_numpy(), left["id"].to_numpy()
        goals: list[list[tuple[int, int, int, int, int]]] = []
        for turns, ids, scores in zip(left["turns"], left["positive_ids"], left["positive_scores"]):
            ranges = [
                (int(t), int(i), int(s), -(-low * int(s) // 100), high * int(s) // 100)
                for t, i, s in zip(turns, ids, scores)
            ]
            goals.append([r for r in ranges if r[3] <= r[4]])

        def wanted(place: int, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
            other = shard.label != labels[place]
            take = np.zeros(len(other), bool)
            for *_, least, most in goals[place]:
                meets = np.flatnonzero(other & (upper >= least) & (lower <= most))
                sure = meets[(lower[meets] >= least) & (upper[meets] <= most)]
                take[can_be_first(meets, lower, upper, sure, negatives)] = True
            return np.flatnonzero(take)

        out = [(np.empty(0, np.int64),) * 7]
        for place, some, scores in walk(vectors, left["parent"].to_numpy(), left["edge"].to_numpy(), shard, wanted):
            for turn, positive, score, least, most in goals[place]:
                inside = np.flatnonzero((scores >= least) & (scores <= most))
                best = inside[first(some[inside], scores[inside], shard.id, negatives)]
                fixed = (numbers[place], names[place], turn, positive, score)
                out.append((*(np.full(len(best), x) for x in fixed), shard.id[some[best]], scores[best]))
        return pd.DataFrame(dict(zip(columns, map(np.concatenate, zip(*out)))))

    columns = ["row", "anchor_id", "turn", "positive_id", "positive_score", "negative_id", "negative_score"]
    asking = (
        tree.join(per_anchor.withColumnRenamed("row", "row__"), F.col("row") == F.col("row__"), "left")
        .select(
            *tree_columns,
            *[
                F.coalesce(f"positives.{c}", F.array().cast(f"array<{t}>")).alias(n)
                for c, t, n in (
                    ("turn", "int", "turns"),
                    ("positive_id", "bigint", "positive_ids"),
                    ("positive_score", "bigint", "positive_scores"),
                )
            ],
        )
        .withColumn("shard", each(shards))
    )
    found = asking.groupBy("block", "shard").cogroup(answering).applyInPandas(
        _if_both(harder, columns), ", ".join(f"{c} bigint" for c in columns)
    )
    order = Window.partitionBy("row", "turn").orderBy(F.desc("negative_score"), "negative_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def _if_both(match: Callable, columns: list[str]) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """``match`` of a block and a shard; a shard without anchors, or a block without rows, has no result."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({c: np.empty(0, np.int64) for c in columns})
        return match(left, right)

    return run
