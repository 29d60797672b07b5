"""Mergeable activity: partial aggregates per customer and range of steps.

``activity_slices`` reduces the lake to one row per customer and slice, and ``counterparties``
to the distinct receivers of each customer and slice. Everything in them can be merged: counts
and whole cents add up, sets of types are joined by bits, first and last steps are minima and
maxima, receivers are distinct again. So a slice is computed once, when its steps are complete,
and reports read the slices instead of the lake. ``merged_activity`` has the columns of
``reports.customer_activity``; any range of whole slices can be merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerlake import schemas as S
from tellerlake.functions import rules
from tellerlake.functions.exact import CENTS, cents, whole_sum
from tellerlake.operators.reports import sent

SLICE_STEPS = S.REPORT_WINDOW_STEPS


def slice_of(step: Column | str, width: int = SLICE_STEPS) -> Column:
    """Number of the slice a step is in; steps count from 1."""
    column = F.col(step) if isinstance(step, str) else step
    return F.floor((column - 1) / width).cast("int")


def activity_slices(txns: DataFrame, width: int = SLICE_STEPS) -> DataFrame:
    return sent(txns).groupBy(
        F.col("nameOrig").alias("customerId"), slice_of("step", width).alias("slice")
    ).agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.count("amount").alias("amounts"),
        whole_sum(cents("amount")).cast("bigint").alias("total_cents"),
        F.sum("isFraud").alias("fraud_count"),
        F.bit_or(rules.type_bit()).alias("types"),
        F.min("step").alias("first_active_step"),
        F.max("step").alias("last_active_step"),
    )


def counterparties(txns: DataFrame, width: int = SLICE_STEPS) -> DataFrame:
    """The distinct receivers of each customer and slice."""
    return sent(txns).where(F.col("nameDest").isNotNull()).select(
        F.col("nameOrig").alias("customerId"), slice_of("step", width).alias("slice"), "nameDest"
    ).distinct()


def merged_totals(slices: DataFrame) -> DataFrame:
    """One row per customer over all given slices, money still in whole cents."""
    return slices.groupBy("customerId").agg(
        F.sum("txn_count").alias("txn_count"),
        F.sum("amounts").alias("amounts"),
        whole_sum(F.col("total_cents")).alias("total_cents"),
        F.sum("fraud_count").alias("fraud_count"),
        F.bit_or("types").alias("types"),
        F.min("first_active_step").alias("first_active_step"),
        F.max("last_active_step").alias("last_active_step"),
    )


def merged_activity(slices: DataFrame, receivers: DataFrame) -> DataFrame:
    """``reports.customer_activity`` from slices and their receivers.

    Both sides are grouped by customer, so their join needs no shuffle of its own.
    """
    destinations = receivers.groupBy("customerId").agg(F.count_distinct("nameDest").alias("unique_destinations"))
    total = F.col("total_cents").cast("double") / CENTS
    return merged_totals(slices).join(destinations, "customerId", "left").select(
        "customerId", "txn_count",
        total.alias("total_amount"),
        F.round(F.try_divide(total, F.col("amounts")), 2).alias("avg_amount"),
        "fraud_count",
        F.coalesce("unique_destinations", F.lit(0)).alias("unique_destinations"),
        F.bit_count("types").cast("bigint").alias("distinct_types"),
        "first_active_step", "last_active_step",
        rules.is_customer("customerId").cast("int").alias("is_customer"),
    )


def baseline_accounts(slices: DataFrame) -> DataFrame:
    """What ``scoring.baseline_of`` needs, from slices."""
    mean = F.try_divide(F.col("total_cents").cast("double") / CENTS, F.col("amounts"))
    return merged_totals(slices).select(
        "customerId", mean.alias("baselineAvgAmount"), F.col("txn_count").alias("history"),
        F.col("first_active_step").alias("firstStep"), F.col("last_active_step").alias("lastStep"),
    )
