"""Session defaults shared by the jobs.

Only planner switches that every job wants are set here. The number of shuffle
partitions is left to the cluster: it should be chosen so that one partition of the
largest shuffle stays in the low hundreds of megabytes, and adaptive execution then
merges what turned out to be small.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.task.maxFailures": "8",
}


def build_session(app_name: str, hive: bool = False, **conf: str) -> SparkSession:
    """A session named after its job, so that concurrent jobs can be told apart.

    ``hive`` keeps tables in the cluster's metastore; without it the catalog lives as
    long as the session.
    """
    builder = SparkSession.builder.appName(app_name)
    if hive:
        builder = builder.enableHiveSupport()
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_own_dirs: dict[str, str] = {}


def work_path(spark: SparkSession, name: str) -> str:
    """A new path for stored intermediate tables, in the folder ``spark.checkpoint.dir`` names.

    Driver and executors have to share it. Only where it is unset and all tasks run on this
    machine a local folder is made instead.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        master, app = spark.sparkContext.master, spark.sparkContext.applicationId
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        if app not in _own_dirs:
            _own_dirs[app] = tempfile.mkdtemp(prefix="tellerlake-")
        base = f"file://{_own_dirs[app]}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
