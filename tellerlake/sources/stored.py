"""Results kept up to date beside the lake: the mart by step, and activity by slice."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.operators import activity as A
from tellerlake.operators.mart import txn_summary_mart
from tellerlake.sources.catalog import recover_partitions
from tellerlake.sources.incremental import Target, read_target, refresh


# --- mart -------------------------------------------------------------------------

def mart_target(path: str) -> Target:
    return Target(path, "step", lambda step: step, txn_summary_mart)


def update_mart(
    spark: SparkSession, lake: str, path: str, database: str | None = None, name: str = "txn_summary_mart"
) -> DataFrame:
    """Recompute the mart's steps whose input changed; these steps (``unit``).

    Rows of a step depend on that step alone, so no other partition is touched. With a
    database the mart is also an external table, partitioned by step.
    """
    target = mart_target(path)
    changed = refresh(spark, lake, target)
    if database:
        register_mart(spark, path, database, name)
    return changed


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    return read_target(spark, mart_target(path))


def register_mart(spark: SparkSession, path: str, database: str, name: str) -> None:
    mart = read_mart(spark, path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in mart.schema)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    spark.sql(
        f"CREATE TABLE {database}.{name} ({columns}) USING PARQUET "
        f"PARTITIONED BY (step) LOCATION '{mart_target(path).data}'"
    )
    recover_partitions(spark, f"{database}.{name}")


# --- activity ---------------------------------------------------------------------

@dataclass(frozen=True)
class ActivityStore:
    """Activity of customers in three tables: slices, receivers by slice, and all merged.

    Reports take ``activity()``. Their bounds (last step, maxima) are aggregates of that small
    table, and the lake is read only where ``refresh`` finds that it changed.
    """

    spark: SparkSession
    path: str
    width: int = A.SLICE_STEPS

    def _target(self, name: str, build) -> Target:
        return Target(
            f"{self.path}/{name}-{self.width}", "slice", partial(A.slice_of, width=self.width),
            partial(build, width=self.width),
        )

    @property
    def slices_target(self) -> Target:
        return self._target("slices", A.activity_slices)

    @property
    def receivers_target(self) -> Target:
        return self._target("receivers", A.counterparties)

    def refresh(self, lake: str) -> DataFrame:
        """Recompute the slices whose steps changed, and merge again if there are any."""
        changed = refresh(self.spark, lake, self.slices_target)
        also = refresh(self.spark, lake, self.receivers_target)
        if not (changed.isEmpty() and also.isEmpty()):
            self.merged().write.mode("overwrite").parquet(f"{self.path}/merged")
        return changed

    def slices(self) -> DataFrame:
        return read_target(self.spark, self.slices_target)

    def receivers(self) -> DataFrame:
        return read_target(self.spark, self.receivers_target)

    def merged(self, first: int | None = None, last: int | None = None) -> DataFrame:
        """Activity over slices ``first`` to ``last``, all if not given; others are not read."""
        parts = []
        for table in (self.slices(), self.receivers()):
            lower = F.lit(True) if first is None else F.col("slice") >= first
            upper = F.lit(True) if last is None else F.col("slice") <= last
            parts.append(table.where(lower & upper))
        return A.merged_activity(*parts)

    def activity(self) -> DataFrame:
        """The merged table as it was stored last."""
        return self.spark.read.schema(self.merged().schema).parquet(f"{self.path}/merged")

    def baseline_accounts(self) -> DataFrame:
        return A.baseline_accounts(self.slices())
