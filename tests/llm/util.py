"""Awkward tables: nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""

import random

from pyspark.sql import DataFrame, SparkSession

#: Columns beside those of a documents table, of names that operators use inside.
EXTRA = (
    "n_words bigint, names string, part int, key string, votes int, rank int, spans string, fp string, x double, "
    "shard int, text_key string, label int, one int, start int, named string, text_now string, id bigint, drop boolean, "
    "times bigint, least bigint, node bigint, wanted bigint, items string, more_id bigint, token bigint, n bigint, size bigint, group bigint"
)
SCHEMA = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {EXTRA}"


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A documents table of (doc_id, text) with the further columns."""
    none = [None] * (EXTRA.count(",") + 1)
    return spark.createDataFrame(
        [(i, t, "en", None, None if t is None else len(t), *none) for i, t in rows], SCHEMA
    )


def sentence(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))


def odd_rows() -> list[tuple]:
    long = sentence(1, 20_000)
    shared = sentence(2, 80)
    return [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, long),
        (5, long),
        (6, shared),
        (6, shared),
        (7, "Lead in. " + shared + " and out"),
        (8, "word"),
        (9, "a b c"),
        (10, "é ü 字 🦙 \x00   x"),
        (11, "na " * 300),
        (12, "na " * 300 + "end"),
        (None, shared),
        (None, None),
        (13, sentence(3, 120)),
        (14, sentence(3, 120).upper()),
    ]


def by_id(rows: DataFrame) -> dict:
    """Rows of the documents with ids; repeated ids must have equal rows."""
    out = {}
    for r in rows.collect():
        key = r[0]
        if key is not None:
            assert out.setdefault(key, r) == r
    return out
