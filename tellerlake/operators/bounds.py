"""Whole-table bounds as scalar subqueries.

A bound such as ``max(step)`` or a column's range is one value for the whole table.
``DataFrame.scalar()`` keeps it inside the same lazy plan: Spark computes it with a
map-side combined aggregate and inlines the value, so there is no extra driver job,
no join, and no window that would pull all rows into one task. Filters on a scalar
still prune ``step=`` partitions of the lake.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerlake import schemas as S


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def anchored(df: DataFrame) -> DataFrame:
    """``df`` with its numeric columns safe from pruning; no row is left out.

    A report and its bounds share the shuffle below them only if they need the same columns.
    What a reader of the report selects later must not take one away, so a filter that every
    row passes mentions them all. Spark does not know the range of a hash and keeps it.
    """
    return df.where(F.hash(*_numeric(df)) >= F.lit(-(1 << 31)))


def extent(df: DataFrame) -> Column:
    """``<col>_lo`` and ``<col>_hi`` of every numeric column, as one scalar struct.

    All numeric columns are read, not only the ones the caller needs: the subquery
    then has exactly the same aggregate below it as the main query, and Spark reuses
    that shuffle instead of scanning and shuffling the table a second time. For the
    same reason the main query goes on from ``anchored(df)``.
    """
    numeric = _numeric(df)
    ends = [F.min(c).alias(f"{c}_lo") for c in numeric]
    ends += [F.max(c).alias(f"{c}_hi") for c in numeric]
    return df.agg(F.struct(*ends)).scalar()


def last_step(txns: DataFrame) -> Column:
    return F.coalesce(txns.agg(F.max("step")).scalar(), F.lit(0))


def last_active(activity: DataFrame) -> Column:
    """The last step of the data, from activity per account."""
    return F.coalesce(extent(activity)["last_active_step_hi"], F.lit(0))


def step_window(
    txns: DataFrame, steps: int = S.REPORT_WINDOW_STEPS, end_step: int | None = None
) -> tuple[Column, Column]:
    """(start, end] of the trailing window.

    With a known ``end_step`` both ends are literals and the lake is pruned at
    planning time; without one they come from a subquery.
    """
    end = F.lit(end_step) if end_step is not None else last_step(txns)
    return F.greatest(F.lit(0), end - steps), end


def rolling_window(
    txns: DataFrame, steps: int = S.REPORT_WINDOW_STEPS, end_step: int | None = None
) -> DataFrame:
    start, end = step_window(txns, steps, end_step)
    return txns.where((F.col("step") > start) & (F.col("step") <= end))


def minmax_normalise(df: DataFrame, columns: Iterable[str], suffix: str = "_norm") -> DataFrame:
    """Scale columns to [0, 1] over the whole table; a constant column becomes 0."""
    df = anchored(df)
    scaled = {}
    for c in columns:
        lo, hi = F.col(f"_ends.{c}_lo"), F.col(f"_ends.{c}_hi")
        share = F.try_divide((F.col(c) - lo).cast("double"), (hi - lo).cast("double"))
        scaled[c + suffix] = F.when(hi <= lo, 0.0).otherwise(share)
    return df.withColumn("_ends", extent(df)).withColumns(scaled).drop("_ends")


def max_normalise(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Scale columns by their maximum (``{source: output}``); a maximum <= 0 gives 0."""
    return scaled_by_maximum(anchored(df), columns)


def scaled_by_maximum(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The same for a frame that is anchored already."""
    scaled = {}
    for c, output in columns.items():
        top = F.col(f"_ends.{c}_hi").cast("double")
        scaled[output] = F.when(top <= 0, 0.0).otherwise(F.try_divide(F.col(c).cast("double"), top))
    return df.withColumn("_ends", extent(df)).withColumns(scaled).drop("_ends")
