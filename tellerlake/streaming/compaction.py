"""Folding the many small batches of a stream into larger files, under running readers.

A sink writes ``run=<query>/batch_id=<n>`` directories. ``fold`` copies a stretch of finished
batches of one run into larger files, which carry run and batch as columns, and gives them
their final name by one rename: ``_folded/<run>,<first>-<last>``. That rename is the only
moment at which anything changes. ``read_batches`` lists the batches first and the folds
after them, and leaves out every batch that a fold has, and every fold that a larger one has.
So it sees each batch once, before and after the rename and whatever has been removed.
``remove_folded`` deletes what folds have replaced, once they are older than the longest
read. A fold that failed leaves a hidden directory that no reader looks at.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER = "_folded"
#: Batches at the end of a run that are left: the last one may still be retried.
KEEP_LAST = 1


@dataclass(frozen=True, order=True)
class Fold:
    run: str
    first: int
    last: int

    @property
    def name(self) -> str:
        return f"{self.run},{self.first}-{self.last}"

    def has(self, other: Fold) -> bool:
        return self.run == other.run and self.first <= other.first and other.last <= self.last

    def batches(self) -> Column:
        return (F.col("run") == self.run) & F.col("batch_id").between(self.first, self.last)


def _filesystem(spark: SparkSession, path: str):
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path
    return hadoop_path(path).getFileSystem(context._jsc.hadoopConfiguration()), hadoop_path


def _folds(spark: SparkSession, path: str) -> list[tuple[Fold, int]]:
    """All folds and when they were made."""
    fs, hadoop_path = _filesystem(spark, path)
    folder = hadoop_path(f"{path}/{FOLDER}")
    found = []
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        run, comma, span = status.getPath().getName().rpartition(",")
        if comma:
            first, last = span.split("-")
            found.append((Fold(run, int(first), int(last)), status.getModificationTime()))
    return found


def _largest(folds: list[Fold]) -> list[Fold]:
    return [f for f in folds if not any(g.has(f) and g != f for g in folds)]


def _with_batch(schema: str) -> str:
    return f"{schema}, run string, batch_id long"


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all batches with run and batch_id, each batch once."""
    batches = spark.read.schema(_with_batch(schema)).parquet(path)  # lists the batches now
    folds = _largest([f for f, _ in _folds(spark, path)])
    if not folds:
        return batches
    left = batches.where(~reduce(or_, [f.batches() for f in folds]))
    paths = [f"{path}/{FOLDER}/{f.name}" for f in folds]
    return left.unionByName(spark.read.schema(_with_batch(schema)).parquet(*paths))


def fold(
    spark: SparkSession, path: str, schema: str, run: str, keep_last: int = KEEP_LAST, files: int | None = None
) -> Fold | None:
    """Fold all finished batches of a run, and its earlier folds, into one; None if there are none new.

    Spark chooses the number of files by size if ``files`` is not given.
    """
    rows = read_batches(spark, path, schema).where(F.col("run") == run)
    first, last = rows.agg(F.min("batch_id"), F.max("batch_id")).head()
    if last is None or last - keep_last < first:
        return None
    made = Fold(run, first, last - keep_last)
    if made in [f for f, _ in _folds(spark, path)]:
        return None
    chosen = rows.where(F.col("batch_id") <= made.last)
    chosen = chosen.repartitionByRange(files, "batch_id") if files else chosen.hint("rebalance", "batch_id")
    staging = f"{path}/{FOLDER}/.{uuid.uuid4().hex}"
    chosen.sortWithinPartitions("batch_id").write.parquet(staging)
    fs, hadoop_path = _filesystem(spark, path)
    target = hadoop_path(f"{path}/{FOLDER}/{made.name}")
    if fs.exists(target) or not fs.rename(hadoop_path(staging), target):
        raise OSError(f"could not move {staging} to {target}")
    return made


def remove_folded(spark: SparkSession, path: str, older_than_ms: int) -> None:
    """Delete batches and folds that a fold of at least that age has replaced."""
    fs, hadoop_path = _filesystem(spark, path)
    now = spark.sparkContext._jvm.System.currentTimeMillis()
    folds = _folds(spark, path)
    settled = [f for f, made in folds if now - made >= older_than_ms]
    for f, _ in folds:
        if any(g.has(f) and g != f for g in settled):
            fs.delete(hadoop_path(f"{path}/{FOLDER}/{f.name}"), True)
    for f in _largest(settled):
        folder = hadoop_path(f"{path}/run={f.run}")
        for status in fs.listStatus(folder) if fs.exists(folder) else []:
            name = status.getPath().getName()
            if name.startswith("batch_id=") and f.first <= int(name.split("=")[1]) <= f.last:
                fs.delete(status.getPath(), True)
