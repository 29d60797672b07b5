"""Streaming fraud detection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tellerlake.operators.kpis import flag_transactions, fraud_batch_metric
from tellerlake.streaming.sinks import Sinks, kept


def process_batch(batch: DataFrame, batch_id: int, sinks: Sinks) -> None:
    """Write the flagged rows, their alert messages and the batch metric.

    The batch is kept while its outputs are written, so the source is read once. The
    flagged rows are kept as well, so that rows, alerts and the mean latency of the
    metric show one detection time.
    """
    with kept(batch) as rows:
        if rows.isEmpty():
            return
        with kept(flag_transactions(rows, F.current_timestamp())) as flagged:
            if sinks.rows:
                sinks.rows(flagged, batch_id)
            if sinks.alerts:
                sinks.alerts(flagged, batch_id)
            if sinks.metrics:
                latency = flagged.agg(F.avg("detectionLatencyMs")).scalar()
                metric = fraud_batch_metric(rows, batch_id).withColumn("avgLatencyMs", latency)
                sinks.metrics(metric.withColumn("recordedAt", F.current_timestamp()), batch_id)


def start_fraud(
    stream: DataFrame,
    sinks: Sinks,
    checkpoint: str,
    trigger: str = "5 seconds",
    once: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Start the job; ``once`` drains what is available and stops."""
    when = {"availableNow": True} if once else {"processingTime": trigger}
    writer = stream.writeStream.foreachBatch(lambda df, n: process_batch(df, n, sinks))
    writer = writer.option("checkpointLocation", checkpoint).trigger(**when)
    return (writer.queryName(name) if name else writer).start()
