"""Helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallystar.sources.files import remove, shared_dir

#: Runs of these characters are words; the complement is ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = r"[\x20\x09-\x0D]+"

#: UTF-8 bytes of text that one step of a Python worker holds; a longer text is a step of its own.
STEP_BYTES = 2_000_000


#: Tables that ``kept`` has written and ``discard`` has not removed.
_written: list[str] = []


def kept(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written once in the shared folder and read back: a cut of the lineage that
    outlives lost executors.  The table stays until ``discard``."""
    spark = rows.sparkSession
    path = shared_dir(spark, name)
    rows.write.parquet(path)
    _written.append(path)
    return spark.read.schema(rows.schema).parquet(path)


def written() -> int:
    """How many tables ``kept`` has written that are still there."""
    return len(_written)


def discard(spark: SparkSession, since: int = 0, but: int = 0) -> None:
    """Remove what ``kept`` wrote after the first ``since`` tables, but for the last ``but``.  No result
    may need them any more."""
    gone = _written[since : len(_written) - but]
    del _written[since : len(_written) - but]
    for path in gone:
        remove(spark, path)


def words(text: Column | str) -> Column:
    """The words of a text as an array; a null text has none."""
    column = F.col(text) if isinstance(text, str) else text
    return F.filter(
        F.split(F.coalesce(column, F.lit("")), WHITE), lambda w: w != F.lit("")
    )


def steps(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """An Arrow batch cut to steps of bounded text, so that memory follows ``STEP_BYTES`` and the
    longest single text, not the number of rows of a batch."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    step = np.cumsum(size, dtype=np.int64) // STEP_BYTES
    cut = np.flatnonzero(np.diff(step)) + 1
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
        if a < b:
            yield batch.slice(a, b - a)


def per_text(
    docs: DataFrame,
    carried: list[str],
    produce: Callable[[list[str | None]], dict[str, object]],
    fields: str,
    text: str = "text",
) -> DataFrame:
    """``carried`` columns as they are, and what ``produce`` makes of the texts of a step: a dict of
    lists or arrays, one entry per text, of the types that ``fields`` names."""
    narrow = docs.select(*(F.col(c) for c in carried), F.col(text).alias("text__"))
    schema = T.StructType(narrow.schema.fields[:-1] + T.StructType.fromDDL(fields).fields)
    names = schema.fieldNames()[len(carried) :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = to_arrow_schema(schema)
        for batch in batches:
            for part in steps(batch, "text__"):
                made = produce(part.column("text__").to_pylist())
                columns = part.columns[:-1] + [pa.array(made[n], kinds.field(n).type) for n in names]
                yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    return narrow.mapInArrow(run, schema)


def rewrite(docs: DataFrame, change: Callable[[list[str | None]], list[str | None]]) -> DataFrame:
    """``docs`` with ``text`` as ``change`` returns it and ``n_chars`` counted anew where it differs;
    all other columns are passed on untouched."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                old = part.column("text").to_pylist()
                new = change(old)
                sizes = part.column("n_chars").to_pylist()
                sizes = [n if a == b else len(b) for n, a, b in zip(sizes, old, new)]
                swapped = {"text": new, "n_chars": sizes}
                columns = [
                    pa.array(swapped[n], part.schema.field(n).type) if n in swapped else part.column(n)
                    for n in names
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(run, docs.schema)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
