"""Quality classifier: regularised quadratic discriminant analysis over statistics of a text.

Each class is a normal distribution over transformed statistics.  Its covariance is shrunk towards the
pooled one and that towards its diagonal, so that small classes and statistics that hardly vary stay
invertible.  The score comes from the difference of the log densities, whose Mahalanobis distances
are solved with Cholesky factors made once per model.  The model is fitted from sums over all labelled
training rows: Spark adds them up, the driver sees one row per class.

Cases: a null text counts as an empty one; repeated rows count each and give repeated rows; label rows
that repeat count each, those without a label or a document not at all; a row without an id is scored and not held
out; with fewer than two classes in training every score is the share of label 1 (one half without
labels); very long texts are steps of their own; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import kept, per_text

#: Shrinkage of a class covariance to the pooled one, of the pooled one to its diagonal, and the least
#: variance of a statistic.
TO_POOLED, TO_DIAGONAL, LEAST_VARIANCE = 0.3, 0.1, 1e-4
#: Log odds count fully up to about this size and are compressed beyond it, without ties.
FULL_ODDS = 20.0

_DELETE = {
    "capitals": bytes(range(65, 91)),
    "digits": b"0123456789",
    "stops": b".",
    "commas": b",;:",
    "marks": b"!?",
    "symbols": b"#*$%&<>@^~=+_\\/{}[]",
    "bars": b"|",
    "high": bytes(range(128, 256)),
}
#: Order of the statistics.
NAMES = (
    "length", "word_length", "longest", "distinct", "repeated", "dup_lines", "line_length", *_DELETE,
)


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of a text: logarithms of sizes, square roots of shares."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = max(1, len(words)), max(1, len(raw))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    triples = max(1, len(words) - 2)
    out = [
        math.log1p(len(words)),
        math.log1p(sum(map(len, words)) / n),
        math.log1p(max(map(len, words), default=0)),
        math.sqrt(len(set(words)) / n),
        math.sqrt(1 - len(set(zip(words, words[1:], words[2:]))) / triples) if len(words) > 2 else 0.0,
        math.sqrt(1 - len(set(lines)) / max(1, len(lines))) if lines else 0.0,
        math.log1p(len(words) / max(1, len(lines))),
    ]
    out += [math.sqrt((len(raw) - len(raw.translate(None, d))) / size) for d in _DELETE.values()]
    return out


class Discriminant:
    """Means, cached Cholesky factors and log determinants of both classes, and the prior log odds."""

    def __init__(self, sums: dict[int, tuple[float, np.ndarray, np.ndarray]]):
        d = len(NAMES)
        n = {c: sums[c][0] for c in (0, 1) if c in sums}
        total = sum(n.values())
        self.ready = len(n) == 2
        self.share = n.get(1, 0) / total if total else 0.5
        if not self.ready:
            return
        mean = {c: sums[c][1] / n[c] for c in (0, 1)}
        cov = {c: sums[c][2] / n[c] - np.outer(mean[c], mean[c]) for c in (0, 1)}
        pooled = (n[0] * cov[0] + n[1] * cov[1]) / total
        pooled = (1 - TO_DIAGONAL) * pooled + TO_DIAGONAL * np.diag(np.diag(pooled)) + LEAST_VARIANCE * np.eye(d)
        self.parts = []
        for c in (1, 0):
            shrunk = (1 - TO_POOLED) * cov[c] + TO_POOLED * pooled
            factor = np.linalg.cholesky(shrunk)
            self.parts.append((mean[c], np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum()))
        self.prior = math.log(n[1] / n[0])

    def score(self, x: np.ndarray) -> np.ndarray:
        """Near the probability of label 1, in strict order of the log odds."""
        if not self.ready:
            return np.full(len(x), self.share)
        density = [
            -0.5 * (((x - mean) @ inverse.T) ** 2).sum(axis=1) - 0.5 * log_det
            for mean, inverse, log_det in self.parts
        ]
        odds = self.prior + density[0] - density[1]
        odds = odds / (1 + np.abs(odds) / FULL_ODDS)
        return 1 / (1 + np.exp(-odds))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of each text."""
    return per_text(docs, ["doc_id"], lambda texts: {"x": [statistics(t) for t in texts]}, "x array<double>")


def fit(seen: DataFrame, labels: DataFrame) -> Discriminant:
    """The model of all labelled rows that are not held out."""
    d = len(NAMES)
    known = labels.select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    train = seen.join(known, seen["doc_id"] == known["label_id"])
    at = lambda i: F.get("x", F.lit(i))
    rows = train.groupBy("label").agg(
        F.count("*").alias("n"),
        F.array(*(F.sum(at(i)) for i in range(d))).alias("s"),
        F.array(*(F.sum(at(i) * at(j)) for i in range(d) for j in range(i, d))).alias("ss"),
    )
    sums = {}
    for r in rows.collect():  # one row per class
        square = np.zeros((d, d))
        square[np.triu_indices(d)] = r["ss"]
        sums[r["label"]] = (float(r["n"]), np.array(r["s"]), np.triu(square) + np.triu(square, 1).T)
    return Discriminant(sums)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each document."""
    seen = kept(features(docs), "quality")
    model = docs.sparkSession.sparkContext.broadcast(fit(seen, labels))
    scored = _scored(seen, model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def _scored(seen: DataFrame, model) -> DataFrame:
    import pyarrow as pa
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([seen.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batches):
        kinds = to_arrow_schema(schema)
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.value.score(x))], schema=kinds)

    return seen.mapInArrow(run, schema)
