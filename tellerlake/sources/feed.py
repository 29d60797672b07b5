"""The live feed from stored batches, newest first, without reading all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.operators.kpis import live_feed

#: Files of the first attempt; every further one takes twice as many.
FIRST_FILES = 16
#: How much later than its file a row may say it was flagged: clocks of machines differ.
CLOCK_SKEW_MS = 60_000


def newest_feed(
    spark: SparkSession, path: str, schema: str, n: int = 250, status: str = "all",
    first_files: int = FIRST_FILES, skew_ms: int = CLOCK_SKEW_MS,
) -> DataFrame:
    """``kpis.live_feed`` of the batches under ``path``, from as few files as that takes.

    A row is flagged before its file is finished, so no row of a file is newer than the file.
    Files are taken from the newest backwards until the last of the n rows is newer than all
    files that are left: these hold nothing that could be shown. Few rows of the wanted status
    only mean more files. Without a detection time in the schema all files are read. Folded
    batches (``streaming.compaction``) are not looked at: a feed shows what is recent.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    files = listed.load(path).select("path", F.unix_millis("modificationTime").alias("written"))
    if "flaggedAt" not in spark.createDataFrame([], schema).columns:
        return live_feed(spark.read.schema(schema).parquet(path), n, status)
    taken = first_files
    while True:
        newest = files.orderBy(F.desc("written"), "path").limit(taken + 1).toArrow()
        paths, written = newest["path"].to_pylist(), newest["written"].to_pylist()
        if not paths:
            return live_feed(spark.createDataFrame([], schema), n, status)
        rows = spark.read.schema(schema).parquet(*paths[:taken])
        if len(paths) <= taken:
            return live_feed(rows, n, status)
        shown = live_feed(rows, n, status, also=["flaggedAt"])
        found = shown.agg(F.count(F.lit(1)), F.min("flaggedAt")).head()
        if found[0] == n and found[1] > written[taken] + skew_ms:
            return shown.drop("flaggedAt")
        taken *= 2
