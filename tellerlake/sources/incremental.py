"""Stored results that follow a partitioned lake, recomputing only what changed.

A result is stored by a unit of steps, as ``<unit>=<n>/`` directories. ``refresh`` lists the
lake's files (names, sizes and times; nothing is opened), compares each unit with the listing
of the last refresh, and recomputes the units that differ. Spark replaces only their
directories (dynamic partition overwrite); those that got no row go. The listing is kept
beside the data and is replaced last, so a refresh that failed is made again by the next one.
It was taken before the lake was read: files that arrive meanwhile make their unit differ
the next time.

Listings and units are as many as the lake's files and partitions, not its rows. One refresh
of a result may run at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake import schemas as S
from tellerlake.sources.readers import read_transactions

_MARK = "unit int, files long, mark long"


@dataclass(frozen=True)
class Target:
    """Where a result is stored and how it is made.

    ``unit`` names its partition column and ``unit_of`` takes the lake's step to it; ``build``
    makes the rows of whole units, with the unit as a column.
    """

    path: str
    unit: str
    unit_of: Callable[[Column], Column]
    build: Callable[[DataFrame], DataFrame]

    @property
    def data(self) -> str:
        return f"{self.path}/data"

    def state(self, name: str) -> str:
        return f"{self.path}/state/{name}"


def _paths(spark: SparkSession, path: str):
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path
    return hadoop_path(path).getFileSystem(context._jsc.hadoopConfiguration()), hadoop_path


def _exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _paths(spark, path)
    return fs.exists(hadoop_path(path))


def listing(spark: SparkSession, path: str, partition: str, unit_of: Callable[[Column], Column] | None = None) -> DataFrame:
    """unit, files, mark: a number that changes with the files of each unit.

    ``binaryFile`` without its content column lists files and opens none.
    """
    if not _exists(spark, path):
        return spark.createDataFrame([], _MARK)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    if partition not in files.columns:
        return spark.createDataFrame([], _MARK)
    unit = F.col(partition).cast("int")
    mark = F.xxhash64("path", "length", F.unix_millis("modificationTime"))
    return files.groupBy((unit_of(unit) if unit_of else unit).alias("unit")).agg(
        F.count(F.lit(1)).alias("files"), F.bit_xor(mark).alias("mark")
    )


def differing(now: DataFrame, before: DataFrame) -> DataFrame:
    """unit of all units that are new, gone, or made of other files."""
    both = now.alias("n").join(before.alias("b"), F.col("n.unit") == F.col("b.unit"), "full")
    same = F.col("n.files").eqNullSafe(F.col("b.files")) & F.col("n.mark").eqNullSafe(F.col("b.mark"))
    return both.where(~same).select(F.coalesce("n.unit", "b.unit").alias("unit"))


def _stored(listed: DataFrame, path: str) -> DataFrame:
    listed.coalesce(1).write.mode("overwrite").parquet(path)
    return listed.sparkSession.read.schema(listed.schema).parquet(path)


def refresh(spark: SparkSession, lake: str, target: Target) -> DataFrame:
    """Bring the result up to date; the units that were recomputed (``unit``)."""
    now = _stored(listing(spark, lake, "step", target.unit_of), target.state("next"))
    done = target.state("done")
    before = spark.read.schema(_MARK).parquet(done) if _exists(spark, done) else spark.createDataFrame([], _MARK)
    changed = _stored(differing(now, before), target.state("changed"))
    if not changed.isEmpty():
        old = _stored(listing(spark, target.data, target.unit), target.state("old"))
        txns = read_transactions(spark, lake)
        # Spark prunes partitions by a join only if the other side is filtered; this keeps all
        wanted = changed.select(F.col("unit").alias("__unit")).where(F.col("__unit") > -(1 << 31))
        txns = txns.join(wanted, target.unit_of(F.col("step")) == F.col("__unit"), "left_semi")
        # large units are split into files and small ones written by one task
        rows = target.build(txns).hint("rebalance", target.unit)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(target.unit).parquet(target.data)
        # what a changed unit still has of its old files is of a unit without rows
        new = listing(spark, target.data, target.unit)
        left = new.join(old, ["unit", "files", "mark"], "left_semi").join(changed, "unit", "left_semi")
        fs, hadoop_path = _paths(spark, target.data)
        for row in left.select("unit").toLocalIterator():
            fs.delete(hadoop_path(f"{target.data}/{target.unit}={row.unit}"), True)
    fs, hadoop_path = _paths(spark, done)
    fs.delete(hadoop_path(done), True)
    if not fs.rename(hadoop_path(target.state("next")), hadoop_path(done)):
        raise OSError(f"could not move the listing to {done}")
    return changed


def read_target(spark: SparkSession, target: Target) -> DataFrame:
    """The stored result; no rows, with its columns, before there is any."""
    empty = target.build(spark.createDataFrame([], S.TRANSACTION_SCHEMA))
    columns = [*[c for c in empty.columns if c != target.unit], target.unit]
    schema = empty.select(columns).schema
    if not _exists(spark, target.data):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(target.data)
