import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystar.llm import quality as Q
from tests.llm.util import documents, odd_rows, sentence


def auc(score, label):
    good, bad = score[label == 1], score[label == 0]
    return ((good[:, None] > bad[None, :]).mean() + 0.5 * (good[:, None] == bad[None, :]).mean())


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    out = Q.classify(docs, labels).join(labels, "doc_id").toPandas()
    held = out[out.held_out]
    assert set(out.held_out) == {True, False}
    assert auc(held.score.to_numpy(), held.quality.to_numpy()) > 0.98
    assert ((held.predicted == held.quality).mean()) > 0.95
    assert [zlib.crc32(str(i).encode()) % 3 == 1 for i in out.doc_id] == out.held_out.tolist()


def test_score_is_the_difference_of_log_densities():
    rng = np.random.default_rng(1)
    d = len(Q.NAMES)
    x = {c: rng.normal(c, 1 + c / 2, (200, d)) for c in (0, 1)}
    model = Q.Discriminant({c: (len(v), v.sum(0), v.T @ v) for c, v in x.items()})
    cov = {c: np.cov(v.T, bias=True) for c, v in x.items()}
    pooled = (cov[0] + cov[1]) / 2
    pooled = (1 - Q.TO_DIAGONAL) * pooled + Q.TO_DIAGONAL * np.diag(np.diag(pooled)) + Q.LEAST_VARIANCE * np.eye(d)
    point = rng.normal(0.4, 1, d)

    def density(c):
        s = (1 - Q.TO_POOLED) * cov[c] + Q.TO_POOLED * pooled
        r = point - x[c].mean(0)
        return -0.5 * r @ np.linalg.solve(s, r) - 0.5 * np.linalg.slogdet(s)[1]

    odds = density(1) - density(0)
    odds /= 1 + abs(odds) / Q.FULL_ODDS
    assert model.score(point[None])[0] == pytest.approx(1 / (1 + math.exp(-odds)))


def test_odd_tables(spark):
    rows = [*odd_rows(), *((100 + k, sentence(k, 60)) for k in range(20))]
    docs = documents(spark, rows)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    out = Q.classify(docs, none).collect()
    assert len(out) == len(rows) and {r.score for r in out} == {0.5}
    one = spark.createDataFrame([(100, 1, 0), (102, 1, 0), (None, 0, 0), (103, None, 0)], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in Q.classify(docs, one).collect()} == {1.0}
    both = spark.createDataFrame(
        [(i, int(i >= 100), None) for i, _ in rows if i is not None] * 2, "doc_id bigint, quality int, toxic int"
    )
    scored = Q.classify(docs, both).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)
    assert Q.classify(docs.where(F.lit(False)), both).count() == 0
