"""RAW rows derived from the ``events`` table, in SQL both engines run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CUT = "2024-01-15 00:00:00"

# Names of companies, branches, cities and regions, and the forms of ids, as the event producer gives them.
_ADAPTER = """
WITH b AS (
  SELECT event_id AS i, user_id AS u, {trunc} AS event_ts, value,
         1 + mod(user_id, 3) AS c,
         mod(user_id + CAST(floor(event_id / 3000) AS BIGINT), 5) AS r,
         mod(user_id + CAST(floor(event_id / 1000) AS BIGINT), 3) AS d,
         mod(CAST(floor(event_id / 2500) AS BIGINT), 4) AS a
  FROM {events})
SELECT i,
       concat('EV', CAST(i AS STRING)) AS event_id,
       event_ts,
       event_ts + INTERVAL '5' SECOND AS ingestion_ts,
       concat('U', CAST(20000 + u AS STRING)) AS user_id,
       concat('Employee_C', CAST(c AS STRING), '_', CAST(1 + mod(u, 50) AS STRING)) AS username,
       concat('S', CAST(mod(i, 997) AS STRING)) AS session_id,
       CASE d WHEN 0 THEN 'Android' WHEN 1 THEN 'iOS' ELSE 'Web' END AS device_type,
       CASE a WHEN 0 THEN '1.20' WHEN 1 THEN '1.21' WHEN 2 THEN '1.22' ELSE '2.0' END AS app_version,
       CASE WHEN mod(i, 97) = 0 THEN NULL WHEN mod(i, 101) = 0 THEN 'n/a'
            ELSE CAST(value AS STRING) END AS watch_time_raw,
       'IN' AS country,
       CASE r WHEN 0 THEN 'NOIDA' WHEN 1 THEN 'GGN' WHEN 2 THEN 'SAKET' WHEN 3 THEN 'DWARKA' ELSE 'CP' END AS city,
       concat('NCR-', CASE r WHEN 0 THEN 'NOIDA' WHEN 1 THEN 'GGN' WHEN 2 THEN 'SAKET' WHEN 3 THEN 'DWARKA' ELSE 'CP' END) AS region_code,
       CAST(28.38 AS DOUBLE) + CAST(mod(i, 270) AS DOUBLE) / 1000 AS lat,
       CAST(76.90 AS DOUBLE) + CAST(mod(i, 550) AS DOUBLE) / 1000 AS lon,
       concat('C', CAST(c AS STRING)) AS company_id,
       CASE c WHEN 1 THEN 'AcmeCorp' WHEN 2 THEN 'BlueStone' ELSE 'HarborTech' END AS company_name,
       CASE WHEN c = 3 THEN 'B5' ELSE concat('B', CAST(2 * c - 1 + mod(i, 2) AS STRING)) END AS branch_id,
       CASE WHEN c = 3 THEN 'Bengaluru' WHEN c = 1 AND mod(i, 2) = 0 THEN 'Noida' WHEN c = 1 THEN 'Gurgaon'
            WHEN mod(i, 2) = 0 THEN 'Mumbai' ELSE 'Pune' END AS branch_name,
       CASE mod(i, 4) WHEN 0 THEN 'Sales' WHEN 1 THEN 'Engineering' WHEN 2 THEN 'Support' ELSE 'Operations' END AS department,
       concat('M_C', CAST(c AS STRING), '_', CAST(1 + mod(i + u, 4) AS STRING)) AS manager_id,
       concat('Manager_C', CAST(c AS STRING), '_', CAST(1 + mod(i + u, 4) AS STRING)) AS manager_name,
       concat('E_C', CAST(c AS STRING), '_', CAST(1 + mod(u, 50) AS STRING)) AS employee_id,
       concat('Employee_C', CAST(c AS STRING), '_', CAST(1 + mod(u, 50) AS STRING)) AS employee_name,
       concat('P_C', CAST(c AS STRING), '_', CAST(1 + mod(i, 8) AS STRING)) AS project_code,
       concat('Project_C', CAST(c AS STRING), '_', CAST(1 + mod(i, 8) AS STRING)) AS project_name
FROM b
"""

DUCK_ADAPTER = _ADAPTER.replace("{trunc}", "date_trunc('second', ts)").replace("{events}", "events")
_SPARK_ADAPTER = _ADAPTER.replace(
    "{trunc}", "CAST(date_trunc('second', ts) AS TIMESTAMP_NTZ)"
)


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter rows with the event number ``i`` and the text measure ``watch_time_raw``."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return spark.sql(_SPARK_ADAPTER, events=events)


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW with watch_time still text, NULLs and bad values included."""
    return numbered(spark, sf_dir).drop("i").withColumnRenamed("watch_time_raw", "watch_time")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    watch = F.coalesce(F.col("watch_time_raw").try_cast("double"), F.lit(0.0))
    return numbered(spark, sf_dir).withColumn("watch_time", watch).drop("i", "watch_time_raw")


def two_batches(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    cut = F.lit(CUT).cast("timestamp_ntz")
    return events.where(F.col("event_ts") <= cut), events.where(F.col("event_ts") > cut)


def messages(spark: SparkSession, sf_dir: str, bad_times: bool = False, timed: bool = False) -> DataFrame:
    """One JSON payload per event; some are broken on purpose.

    ``bad_times`` also gives every 89th event a timestamp that is none.  ``timed`` adds the event's time, to cut batches by.
    """
    from tallystar.schemas import EVENT_TEXT

    rows = numbered(spark, sf_dir)
    fields = []
    for name in EVENT_TEXT.names:
        if name == "watch_time":
            column = F.col("watch_time_raw")
        elif name == "event_ts":
            column = F.col("event_ts").cast("string")
            if bad_times:
                column = F.when(F.col("i") % 89 == 0, F.lit("yesterday")).otherwise(column)
        else:
            column = F.col(name)
        fields.append(column.alias(name))
    value = (
        F.when(F.col("i") % 113 == 0, F.lit("not json"))
        .when(F.col("i") % 127 == 0, F.lit("[1,2]"))
        .when(F.col("i") % 131 == 0, F.lit(None))
        .otherwise(F.to_json(F.struct(*fields)))
    )
    return rows.select("i", value.alias("value"), *(["event_ts"] if timed else []))
