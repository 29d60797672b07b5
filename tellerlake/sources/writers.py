"""Sinks for reports, the lake and messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_kv(df: DataFrame, *columns: str) -> DataFrame:
    """Message shape: the first column as the key, all given columns as a JSON value."""
    return df.select(
        F.col(columns[0]).cast("string").alias("key"),
        F.to_json(F.struct(*columns)).alias("value"),
    )


def append_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV directory with a header in every part; parallel, for any size."""
    df.write.mode("overwrite").option("header", True).csv(path)


def _filesystem(df: DataFrame, path: str):
    context = df.sparkSession.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path
    return hadoop_path(path).getFileSystem(context._jsc.hadoopConfiguration()), hadoop_path


def _part_number(path) -> int:
    return int(path.getName().split("-")[1].split(".")[0])


def write_single_csv(df: DataFrame, path: str, order_by: Sequence[Column | str] = ()) -> None:
    """Exactly one CSV file called ``path``, whatever its size; rows keep their order.

    The rows are computed, sorted and written by all tasks, as parts in the order of the
    report; the parts are then joined behind a header line on the file system. HDFS does that
    by moving blocks. Elsewhere the bytes are copied one part after the other, in a buffer;
    ``write_csv``, which always makes a directory, is the form without this step.
    """
    fs, hadoop_path = _filesystem(df, path)
    staging, target = f"{path}__staging", hadoop_path(path)
    rows = df.orderBy(*order_by) if order_by else df
    try:
        rows.write.mode("overwrite").csv(f"{staging}/rows")
        write_csv(df.sparkSession.createDataFrame([], df.schema).coalesce(1), f"{staging}/head")
        parts = []
        for name in ("head", "rows"):
            found = [s.getPath() for s in fs.listStatus(hadoop_path(f"{staging}/{name}"))]
            parts += sorted((p for p in found if p.getName().startswith("part-")), key=_part_number)
        _join_files(df, fs, parts)
        fs.delete(target, True)
        if not fs.rename(parts[0], target):
            raise OSError(f"could not move {parts[0]} to {path}")
    finally:
        fs.delete(hadoop_path(staging), True)


def _join_files(df: DataFrame, fs, parts: list) -> None:
    """Append all other files to the first."""
    context = df.sparkSession.sparkContext
    jvm, first, rest = context._jvm, parts[0], parts[1:]
    if fs.getScheme() == "hdfs" and rest:
        others = context._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(rest))
        for i, p in enumerate(rest):
            others[i] = p
        fs.concat(first, others)
        return
    whole = first.suffix("-joined")
    out = fs.create(whole, True)
    try:
        for part in parts:
            source = fs.open(part)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
            finally:
                source.close()
    finally:
        out.close()
    fs.delete(first, False)
    if not fs.rename(whole, first):
        raise OSError(f"could not move {whole} to {first}")


def write_blend(blend: DataFrame, rollup: DataFrame, directory: str) -> None:
    """Customer detail and segment rollup, as Parquet plus CSV copies."""
    overwrite_parquet(blend, f"{directory}/customer_risk")
    overwrite_parquet(rollup, f"{directory}/segment_rollup")
    spark = blend.sparkSession
    detail = spark.read.schema(blend.schema).parquet(f"{directory}/customer_risk")
    write_csv(detail, f"{directory}/customer_risk_csv")
    segments = spark.read.schema(rollup.schema).parquet(f"{directory}/segment_rollup")
    write_single_csv(segments, f"{directory}/segment_rollup.csv", [F.desc("customers")])
