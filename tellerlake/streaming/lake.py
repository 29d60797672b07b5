"""Landing a stream in the lake, and replaying the lake as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def land_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str = "30 seconds",
    once: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Append the stream to the ``step=<N>/`` Parquet lake.

    The file sink commits through its own log, so a restart from the checkpoint adds
    nothing twice.
    """
    when = {"availableNow": True} if once else {"processingTime": trigger}
    writer = stream.drop("kafkaTimestamp").writeStream.format("parquet").outputMode("append")
    writer = writer.partitionBy("step").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint).trigger(**when)
    return (writer.queryName(name) if name else writer).start()


def replay(txns: DataFrame, directory: str, n_files: int) -> None:
    """Write transactions as JSON files that a file stream reads in step order.

    One range partitioning by step makes one file per slice of time, in parallel. A
    file stream orders files by modification time, so these are set to follow the file
    names, which follow the slices.
    """
    slices = txns.repartitionByRange(n_files, "step").sortWithinPartitions("step")
    slices.write.mode("overwrite").json(directory)

    context = txns.sparkSession.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(directory)
    fs = hadoop_path.getFileSystem(context._jsc.hadoopConfiguration())
    files = [status.getPath() for status in fs.listStatus(hadoop_path)]
    parts = sorted((p for p in files if p.getName().startswith("part-")), key=lambda p: p.getName())
    start = fs.getFileStatus(hadoop_path).getModificationTime() - 1000 * len(parts)
    for position, part in enumerate(parts):
        fs.setTimes(part, start + 1000 * position, -1)


def replay_messages(txns: DataFrame) -> DataFrame:
    """Transactions as flat JSON message values."""
    return txns.select(F.to_json(F.struct("*")).alias("value"))
