"""Messages -> RAW, one micro-batch at a time.

The batch is decoded once and kept while its three outputs are written; only
three counters reach the driver.  Every output is a run of its table named by
(query, batch id), so a replayed batch replaces what it wrote before.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from tallystar import schemas
from tallystar.operators import catalog, decode
from tallystar.operators.dims import dim_upsert
from tallystar.sources.rows import one_row
from tallystar.sources.tables import AppendTable


def run_source(batch: DataFrame) -> str:
    """The id of the streaming query this batch belongs to."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if query is None:
        raise ValueError("outside a stream the source of a batch must be named")
    return query


class RawIngest:
    """The foreachBatch writer of organisation events.

    ``source`` names the stream in the run directories; by default it is the id
    Spark gives the query, which its checkpoint keeps across restarts.
    ``ingested_at`` fixes the ingestion time, for repeatable runs.
    ``register_size`` keeps the size of the last batch in the catalog.
    """

    def __init__(
        self,
        warehouse,
        value: str = "value",
        source: str | None = None,
        ingested_at: datetime | str | None = None,
        register_size: bool = False,
    ):
        self.warehouse, self.value = warehouse, value
        self.register_size = register_size
        self.source, self.ingested_at = source, ingested_at

    def _register(self, spark, size: int) -> None:
        now = self.ingested_at or datetime.now(timezone.utc).replace(tzinfo=None)
        entry = catalog.batch_size_entry(spark, self.warehouse.raw.name, size, now)
        table = self.warehouse.meta_counts
        table.replace(dim_upsert(table.read(), entry, "table_name"))

    def __call__(self, batch: DataFrame, batch_id: int) -> dict[str, int]:
        source = self.source or run_source(batch)
        kept = decode.outcome(batch, self.value).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counts = decode.batch_counts(kept).first().asDict()
            if not any(counts.values()):
                return counts
            w = self.warehouse
            if counts["inserted"]:
                w.raw.write_run(decode.raw_rows(kept, self.ingested_at), source, batch_id)
            if counts["skipped"]:
                w.errors.write_run(decode.stream_errors(kept), f"{source}-{batch_id}")
            if counts["quarantined"]:
                w.quarantine.write_run(decode.quarantined(kept, self.value), source, batch_id)
            report = one_row(batch.sparkSession).select(
                F.lit(batch_id).cast("long").alias("batch_id"),
                *[F.lit(counts[c]).cast("long").alias(c) for c in schemas.BATCH_COUNTS.names[1:]],
            )
            w.batch_counts.write_run(report, source, batch_id)
            if self.register_size:
                self._register(batch.sparkSession, counts["inserted"])
            return counts
        finally:
            kept.unpersist()


class ShapeIngest:
    """The same writer for any flat event shape, typed, with NOT NULL columns.

    ``rejects`` takes the rows that lack one of ``required``, ``quarantine`` the
    payloads that are no JSON object.
    """

    def __init__(
        self,
        table: AppendTable,
        rejects: AppendTable,
        quarantine: AppendTable,
        shape: StructType,
        required: Sequence[str] = (),
        value: str = "value",
        source: str | None = None,
    ):
        self.source = source
        self.table, self.rejects, self.quarantine = table, rejects, quarantine
        self.shape, self.required, self.value = shape, tuple(required), value

    def __call__(self, batch: DataFrame, batch_id: int) -> dict[str, int]:
        kept = decode.json_decode(batch, self.shape, self.value).persist()
        try:
            objects = kept.where(F.col("reason").isNull()).select("data.*")
            good, bad = decode.split_required(objects, *self.required)
            broken = kept.where(F.col("reason").isNotNull()).select(
                F.col(self.value).cast("string").alias("value"), "reason"
            )
            counts = {}
            for table, rows in (
                (self.table, good), (self.rejects, bad), (self.quarantine, broken)
            ):
                counts[table.name] = rows.count()
                if counts[table.name]:
                    table.write_run(rows, self.source or run_source(batch), batch_id)
            return counts
        finally:
            kept.unpersist()


def start_ingest(
    messages: DataFrame,
    writer,
    checkpoint: str,
    interval: str | None = None,
    available_now: bool = False,
    output_mode: str = "update",
) -> StreamingQuery:
    """Start the ingest query: back-to-back batches, or one every ``interval``."""
    stream = (
        messages.writeStream.foreachBatch(lambda df, n: writer(df, n) and None)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        stream = stream.trigger(availableNow=True)
    elif interval:
        stream = stream.trigger(processingTime=interval)
    return stream.start()
