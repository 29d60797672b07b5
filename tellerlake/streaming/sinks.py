"""Micro-batch output that a retry cannot duplicate.

``foreachBatch`` may run a batch again after a failure. Every batch therefore owns one
directory per output, ``run=<query>/batch_id=<n>``, and overwrites it: writing a batch
twice leaves one copy. The query id lives in the checkpoint. A restarted job goes on in its
own ``run``; a job with a new checkpoint, which counts its batches from 0 again, gets
another one and cannot touch what earlier jobs wrote to the same path. Readers get ``run``
and ``batch_id`` as columns through partition discovery.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tellerlake.sources.writers import to_kv

BatchWriter = Callable[[DataFrame, int], None]


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """A frame that is computed once while several outputs are written from it."""
    df = df.persist()
    try:
        yield df
    finally:
        df.unpersist()


#: The run of rows that are written outside of a streaming query.
NO_QUERY = "none"


def batch_path(df: DataFrame, path: str, batch_id: int) -> str:
    query = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{path}/run={query or NO_QUERY}/batch_id={batch_id}"


def batch_parquet(path: str) -> BatchWriter:
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(batch_path(df, path, batch_id))

    return write


def batch_messages(path: str) -> BatchWriter:
    """JSON messages (key, value) as files, the stand-in for an outgoing topic."""

    def write(df: DataFrame, batch_id: int) -> None:
        to_kv(df, *df.columns).write.mode("overwrite").json(batch_path(df, path, batch_id))

    return write


def kafka_messages(servers: str, topic: str) -> BatchWriter:
    """Messages to Kafka: at least once, so a retried batch may be sent again."""

    def write(df: DataFrame, batch_id: int) -> None:
        messages = to_kv(df, *df.columns).write.format("kafka")
        messages.option("kafka.bootstrap.servers", servers).option("topic", topic).save()

    return write


@dataclass(frozen=True)
class Sinks:
    """Where a job's rows, alert messages and per-batch metrics go; each is optional."""

    rows: BatchWriter | None = None
    alerts: BatchWriter | None = None
    metrics: BatchWriter | None = None
