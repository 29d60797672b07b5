"""Customer x step mart and the reports that read it."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake import schemas as S
from tellerlake.functions import rules
from tellerlake.functions.exact import CENTS, cents, money_mean, money_sum, percent, whole_sum

# A row with n types gives each of them 1/n of its totals. Counting in units of
# 1/lcm(1..10) keeps every share a whole number, so shares add up exactly. That leaves room
# for as many new types as there are known ones.
MOST_TYPES = 2 * len(S.TXN_TYPES)
SHARE_UNITS = math.lcm(*range(1, MOST_TYPES + 1))


def _latest(value: str):
    """Value of the newest transaction; amount, then the value itself, break ties.

    ``max_by`` combines on the map side, so unlike a ranking window it never has to
    sort all rows of one busy customer in a single task.
    """
    return F.max_by(value, F.struct("ingestedAt", "amount", value))


def latest_balance(txns: DataFrame) -> DataFrame:
    """Balance after the newest transaction of each customer and step."""
    return txns.groupBy(F.col("nameOrig").alias("customerId"), "step").agg(
        _latest("newbalanceOrig").alias("last_balance")
    )


def txn_summary_mart(txns: DataFrame) -> DataFrame:
    """One row per customer and step, the input of the summaries below."""
    return txns.groupBy(F.col("nameOrig").alias("customerId"), "step").agg(
        F.count(F.lit(1)).alias("txn_count"),
        money_sum("amount").alias("total_amount"),
        F.round(money_mean("amount"), 2).alias("avg_amount"),
        F.round(F.max("amount"), 2).alias("max_amount"),
        F.sum("isFraud").alias("fraud_count"),
        F.array_join(F.sort_array(F.collect_set("type")), ",").alias("txn_types"),
        _latest("newbalanceOrig").alias("last_balance"),
    )


def mart_inventory(mart: DataFrame) -> DataFrame:
    return mart.agg(
        F.count(F.lit(1)).alias("mart_rows"),
        F.count_distinct("customerId").alias("customers"),
        F.min("step").alias("min_step"),
        F.max("step").alias("max_step"),
        F.sum("fraud_count").alias("total_fraud"),
    )


def _finish_summary(summary: DataFrame, lo: int, hi: int, ordered: bool) -> DataFrame:
    kept = summary.where(rules.step_between(lo, hi))
    return kept.orderBy("step", "transaction_type") if ordered else kept


def transaction_summary(
    mart: DataFrame, lo: int = 1, hi: int = S.REPORT_WINDOW_STEPS, ordered: bool = True
) -> DataFrame:
    """Volume and fraud per (type, step), attributed from the mart.

    The mart does not say which of a row's types an amount belongs to, so totals are
    split evenly. ``avg_amount`` is the unweighted mean of the customers' means.
    ``customers`` is a distinct count, so a mart that holds a customer and step twice
    does not count the customer twice.
    """
    types = F.filter(F.split("txn_types", ","), lambda t: F.length(t) > 0)
    n = F.size(types)
    whole = F.assert_true(n <= MOST_TYPES, "more transaction types than the share unit allows")
    units = F.when(whole.isNull(), (SHARE_UNITS / n).cast("int"))
    shares = (
        mart.where(F.length("txn_types") > 0)
        .withColumn("units", units)
        .select(
            "step", "customerId", "avg_amount", "max_amount",
            F.explode(types).alias("transaction_type"),
            (cents("total_amount") * F.col("units")).alias("cent_units"),
            (F.col("txn_count") * F.col("units")).alias("txn_units"),
            (F.col("fraud_count") * F.col("units")).alias("fraud_units"),
        )
        .groupBy(F.trim("transaction_type").alias("transaction_type"), "step")
        .agg(
            whole_sum(F.col("cent_units")).cast("double").alias("cent_units"),
            F.sum("txn_units").alias("txn_units"),
            F.sum("fraud_units").alias("fraud_units"),
            F.round(money_mean("avg_amount"), 2).alias("avg_amount"),
            F.max("max_amount").alias("max_amount"),
            F.count_distinct("customerId").alias("customers"),
        )
    )
    rate = F.coalesce(percent(F.col("fraud_units"), F.col("txn_units")), F.lit(0.0))
    summary = shares.select(
        "transaction_type", "step",
        F.round(F.col("cent_units") / (SHARE_UNITS * CENTS), 2).alias("total_volume"),
        F.round(F.col("txn_units") / SHARE_UNITS).cast("bigint").alias("txn_count"),
        "avg_amount", "max_amount",
        F.round(F.col("fraud_units") / SHARE_UNITS).cast("bigint").alias("fraud_count"),
        "customers",
        F.round(rate, 2).alias("fraud_rate_pct"),
    )
    return _finish_summary(summary, lo, hi, ordered)


def transaction_summary_from_daily(
    daily: DataFrame, lo: int = 1, hi: int = S.REPORT_WINDOW_STEPS, ordered: bool = True
) -> DataFrame:
    """The same report when only the daily summary is at hand (no max, no customers)."""
    rate = F.coalesce(percent(F.col("fraud_count"), F.col("txn_volume")), F.lit(0.0))
    summary = daily.select(
        F.col("type").alias("transaction_type"), "step",
        F.round("total_amount", 2).alias("total_volume"),
        F.col("txn_volume").alias("txn_count"),
        F.round("avg_amount", 2).alias("avg_amount"),
        "fraud_count",
        F.round(rate, 2).alias("fraud_rate_pct"),
    )
    return _finish_summary(summary, lo, hi, ordered)


def summary_by_type(summary: DataFrame, ordered: bool = True) -> DataFrame:
    """Rollup of the transaction summary over all its steps."""
    rollup = (
        summary.groupBy("transaction_type")
        .agg(
            F.count_distinct("step").alias("steps"),
            F.sum("txn_count").alias("txn_count"),
            money_sum("total_volume").alias("total_volume"),
            F.sum("fraud_count").alias("fraud_count"),
        )
        .withColumn("fraud_rate_pct", rules.fraud_rate(F.col("fraud_count"), F.col("txn_count"), 2))
    )
    return rollup.orderBy(F.desc("total_volume")) if ordered else rollup
