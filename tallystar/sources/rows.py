"""Small literal tables, built by the JVM in one partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def one_row(spark: SparkSession) -> DataFrame:
    return spark.range(0, 1, 1, 1)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return one_row(spark).where(F.lit(False)).select(*columns)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: StructType) -> DataFrame:
    """A handful of rows known when the plan is made."""
    if not rows:
        return empty(spark, schema)
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema)])
        for row in rows
    ]
    return one_row(spark).select(F.inline(F.array(*structs)))
