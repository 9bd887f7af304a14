"""Stream sources: one ``value`` column, whatever the transport."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FILE_FORMATS = {"text", "parquet", "json", "csv", "orc"}


def stream_source(
    spark: SparkSession,
    format: str = "kafka",
    topic: str | None = None,
    servers: str | None = None,
    path: str | None = None,
    schema: str | None = None,
    starting: str = "latest",
    **options,
) -> DataFrame:
    """A streaming DataFrame over a topic or a directory.

    Kafka needs the ``spark-sql-kafka-0-10`` connector of the running Spark
    version on the classpath and yields the record value as binary.  A file
    source takes ``path`` and, but for ``text``, a ``schema``.
    """
    reader = spark.readStream.format(format)
    if format == "kafka":
        settings = {
            "kafka.bootstrap.servers": servers,
            "subscribe": topic,
            "startingOffsets": starting,
            # Offsets that aged out end the query; skipping them must be asked for.
            "failOnDataLoss": "true",
        }
        return reader.options(**{**settings, **options}).load().select("value")
    if format in FILE_FORMATS and format != "text":
        reader = reader.schema(schema or "value string")
    return reader.options(**options).load(path)
