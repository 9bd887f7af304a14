"""Catalog tables and metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallystar import schemas
from tallystar.functions.timestamps import as_wall_clock
from tallystar.sources.rows import literal_rows, one_row

NAMESPACE = "etl"

# Catalogued tables, their type and description.
TABLES = [
    ("raw_user_stream_events", "RAW", "Ingested user events"),
    ("dim_company", "DIM", "Company hierarchy"),
    ("dim_branch", "DIM", "Branch mapping"),
    ("dim_manager", "DIM", "Manager dimension"),
    ("dim_employee", "DIM", "Employee details"),
    ("dim_project", "DIM", "Project information"),
    ("dim_region", "DIM", "Region mapping"),
    ("dim_time", "DIM", "Time dimension"),
    ("fact_user_activity", "FACT", "Aggregated user activity"),
]

# Metric name -> SQL expression over the fact.
METRICS = {
    "events": "count(*)",
    "watch_time_total": "round(sum(watch_time), 2)",
    "watch_time_per_event": "round(sum(watch_time), 2) / count(*)",
    "active_users": "count(DISTINCT user_id)",
    "active_employees": "count(DISTINCT employee_id)",
    "idle_events": "count_if(watch_time = 0)",
}


def meta_table(spark: SparkSession, created_ts, updated_ts=None) -> DataFrame:
    """The table registry."""
    created = as_wall_clock(created_ts)
    named = StructType(schemas.META_TABLE.fields[:3])
    return literal_rows(spark, TABLES, named).select(
        F.concat(F.lit(f"{NAMESPACE}."), "table_name").alias("table_name"),
        "type",
        "description",
        created.alias("created_ts"),
        (created if updated_ts is None else as_wall_clock(updated_ts)).alias("updated_ts"),
    )


def meta_table_counts(tables: dict[str, DataFrame], run_ts) -> DataFrame:
    """Row count per table; upsert the result on table_name to register it."""
    described = {name: (kind.lower(), text) for name, kind, text in TABLES}
    rows = []
    for name, df in tables.items():
        kind, text = described.get(name, ("raw", f"{name} table"))
        rows.append(
            df.agg(F.count("*").alias("record_count")).select(
                F.lit(f"{NAMESPACE}.{name}").alias("table_name"),
                F.lit(NAMESPACE).alias("schema_name"),
                F.lit(kind).alias("table_type"),
                F.lit(text).alias("description"),
                "record_count",
                as_wall_clock(run_ts).alias("last_updated"),
            )
        )
    return reduce(DataFrame.unionByName, rows)


def batch_size_entry(spark: SparkSession, name: str, size: int, run_ts) -> DataFrame:
    """Catalog row of a table whose record_count is the size of its last batch."""
    kind, text = next((kind.lower(), text) for table, kind, text in TABLES if table == name)
    row = (f"{NAMESPACE}.{name}", NAMESPACE, kind, text, size, run_ts)
    return literal_rows(spark, [row], schemas.META_TABLE_COUNTS)


def meta_column(tables: dict[str, DataFrame], observed: bool = False) -> DataFrame:
    """One row per column of each table.

    ``is_nullable`` is the declared nullability, or with ``observed`` whether the
    data holds a NULL, found in one aggregation per table.
    """
    parts = []
    for name, df in tables.items():
        if observed:
            flags = [
                F.when(F.count_if(F.col(f.name).isNull()) > 0, "YES").otherwise("NO")
                for f in df.schema
            ]
            source = df.agg(*[flag.alias(f.name) for flag, f in zip(flags, df.schema)])
            nullable = [F.col(f.name) for f in df.schema]
        else:
            source = one_row(df.sparkSession)
            nullable = [F.lit("YES" if f.nullable else "NO") for f in df.schema]
        rows = F.array(
            *[
                F.struct(
                    F.lit(f"{NAMESPACE}.{name}").alias("table_name"),
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("data_type"),
                    flag.alias("is_nullable"),
                    F.lit(f"{f.name} of {name}").alias("description"),
                )
                for flag, f in zip(nullable, df.schema)
            ]
        )
        parts.append(source.select(F.inline(rows)))
    return reduce(DataFrame.unionByName, parts).select(*schemas.META_COLUMN.names)


def meta_metric(spark: SparkSession, metrics: dict[str, str] = METRICS) -> DataFrame:
    """The metric registry as rows."""
    return literal_rows(
        spark,
        [(name, formula, f"{name} over the fact") for name, formula in metrics.items()],
        schemas.META_METRIC,
    )


def metric_definitions(
    spark: SparkSession, category: str, metrics: dict[str, str] = METRICS
) -> DataFrame:
    """The same registry in its older, four-column form."""
    return meta_metric(spark, metrics).select(
        "metric_name",
        F.col("metric_formula").alias("sql_definition"),
        F.col("description").alias("business_definition"),
        F.lit(category).alias("category"),
    )


def metric_eval(fact: DataFrame, metrics: dict[str, str] = METRICS) -> DataFrame:
    """Evaluate every metric in one aggregation of the fact: (metric_name, metric_value)."""
    values = fact.agg(
        *[F.expr(formula).cast("double").alias(name) for name, formula in metrics.items()]
    )
    return values.unpivot([], list(metrics), "metric_name", "metric_value")
