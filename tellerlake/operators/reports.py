"""Regulatory and activity reports over transactions.

Every report is one map-side combined aggregation, so a customer, type or step that
holds a large share of the rows is reduced before it is shuffled. Distinct counts go
through Spark's two-stage distinct plan, which shuffles on (key, value) first and
therefore also spreads a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake import schemas as S
from tellerlake.functions import rules
from tellerlake.functions.exact import money_mean, money_sum, percent
from tellerlake.operators.bounds import anchored, last_active, step_window

CONFIRMED_FRAUD_COLUMNS = S.TRANSACTION_SCHEMA.fieldNames()[:-1]


def confirmed_fraud(txns: DataFrame) -> DataFrame:
    """Rows whose ground-truth label is fraud; the one shared definition of it."""
    return txns.where(F.col("isFraud") == 1).select(CONFIRMED_FRAUD_COLUMNS)


def compliance_summary(
    txns: DataFrame,
    window_steps: int = S.REPORT_WINDOW_STEPS,
    end_step: int | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Volume, fraud and risk class per transaction type over the trailing window."""
    start, end = step_window(txns, window_steps, end_step)
    fraud_amount = F.when(F.col("isFraud") == 1, F.col("amount")).otherwise(0.0)
    summary = (
        txns.where((F.col("step") > start) & (F.col("step") <= end))
        .groupBy(F.col("type").alias("transaction_type"))
        .agg(
            F.count(F.lit(1)).alias("txn_count"),
            money_sum("amount").alias("total_volume"),
            F.round(money_mean("amount"), 2).alias("avg_amount"),
            F.round(F.max("amount"), 2).alias("max_amount"),
            F.sum("isFraud").alias("fraud_count"),
            F.sum("isFlaggedFraud").alias("system_flagged_count"),
            money_sum(fraud_amount).alias("fraud_volume"),
        )
        .withColumn("fraud_rate_pct", rules.fraud_rate(F.col("fraud_count"), F.col("txn_count")))
        .withColumn("window_start_step", start)
        .withColumn("window_end_step", end)
        .withColumn("risk_classification", rules.compliance_class(F.col("fraud_rate_pct")))
    )
    return summary.orderBy(F.desc("total_volume")) if ordered else summary


def sent(txns: DataFrame) -> DataFrame:
    """Transactions with a sender, the only ones that reports by customer are about."""
    return txns.where(F.col("nameOrig").isNotNull())


def customer_activity(txns: DataFrame) -> DataFrame:
    """One row per originating account with everything the customer reports need.

    The customer fraud summary, lifetime value and dormancy all aggregate by the same
    key. Taking them from this frame means one scan and one shuffle of the lake;
    measures a caller does not use are pruned from the aggregation. The few types of an
    account are one bit each: with one distinct count only, the rows need not be expanded.

    Spark reuses the shuffle for the bounds of a report (``bounds.extent``) only if both
    plans are the same down to the scan. Rows without a sender are therefore left out
    here, not by a join further up, and ``is_customer`` is a measure, since a filter on it
    stays above the aggregation.
    """
    return sent(txns).groupBy(F.col("nameOrig").alias("customerId")).agg(
        F.count(F.lit(1)).alias("txn_count"),
        money_sum("amount").alias("total_amount"),
        F.round(money_mean("amount"), 2).alias("avg_amount"),
        F.sum("isFraud").alias("fraud_count"),
        F.count_distinct("nameDest").alias("unique_destinations"),
        F.bit_count(F.bit_or(rules.type_bit())).cast("bigint").alias("distinct_types"),
        F.min("step").alias("first_active_step"),
        F.max("step").alias("last_active_step"),
        F.max(rules.is_customer("nameOrig").cast("int")).alias("is_customer"),
    )


def fraud_measures(activity: DataFrame) -> DataFrame:
    return activity.select(
        "customerId", "txn_count", "total_amount", "avg_amount", "fraud_count",
        rules.fraud_rate(F.col("fraud_count"), F.col("txn_count")).alias("fraud_rate_pct"),
        "unique_destinations", "last_active_step",
    )


def customer_fraud_summary(txns: DataFrame, ordered: bool = True) -> DataFrame:
    """Per originating account: volume, fraud rate and number of counterparties."""
    return fraud_summary_of(customer_activity(txns), ordered)


def fraud_summary_of(activity: DataFrame, ordered: bool = True) -> DataFrame:
    summary = fraud_measures(activity)
    # The id ends every customer-level order: most customers share the leading values,
    # and a range partition cannot split rows whose sort keys are equal.
    order = [F.desc("fraud_count"), F.desc("total_amount"), "customerId"]
    return summary.orderBy(*order) if ordered else summary


def dormancy_measures(
    activity: DataFrame,
    last,
    inactive: int = S.DORMANT_AFTER_STEPS,
    severe: int = S.SEVERE_AFTER_STEPS,
    min_txns: int = S.DORMANCY_MIN_TXNS,
) -> DataFrame:
    idle = last - F.col("last_active_step")
    dormant = (F.col("is_customer") == 1) & (idle > inactive) & (F.col("txn_count") >= min_txns)
    return activity.where(dormant).select(
        "customerId", "last_active_step", "first_active_step", "txn_count",
        "total_amount", "avg_amount", "fraud_count",
        last.alias("dataset_max_step"),
        idle.alias("steps_inactive"),
        rules.dormancy_severity(idle, severe).alias("dormancy_severity"),
    )


def dormancy_report(
    txns: DataFrame,
    inactive: int = S.DORMANT_AFTER_STEPS,
    severe: int = S.SEVERE_AFTER_STEPS,
    min_txns: int = S.DORMANCY_MIN_TXNS,
    ordered: bool = True,
) -> DataFrame:
    """Customer accounts with enough history that have been silent for long.

    Merchants are left out, but they still count towards the last step of the data.
    """
    return dormancy_of(customer_activity(txns), inactive, severe, min_txns, ordered)


def dormancy_of(
    activity: DataFrame,
    inactive: int = S.DORMANT_AFTER_STEPS,
    severe: int = S.SEVERE_AFTER_STEPS,
    min_txns: int = S.DORMANCY_MIN_TXNS,
    ordered: bool = True,
) -> DataFrame:
    """The report from activity per account, computed or stored."""
    activity = anchored(activity.drop("unique_destinations", "distinct_types"))
    report = dormancy_measures(activity, last_active(activity), inactive, severe, min_txns)
    return report.orderBy(F.desc("steps_inactive"), "customerId") if ordered else report


def daily_summary(txns: DataFrame, ordered: bool = True) -> DataFrame:
    """Volume and fraud per (type, step)."""
    summary = (
        txns.groupBy("type", "step")
        .agg(
            F.count(F.lit(1)).alias("txn_volume"),
            money_sum("amount").alias("total_amount"),
            F.round(money_mean("amount"), 2).alias("avg_amount"),
            F.sum("isFraud").alias("fraud_count"),
        )
        .withColumn(
            "fraud_rate_pct", F.round(percent(F.col("fraud_count"), F.col("txn_volume")), 4)
        )
    )
    return summary.orderBy("step", "type") if ordered else summary


def distinct_accounts(txns: DataFrame) -> DataFrame:
    """Every account that sent or received: one scan, exploded to both ends."""
    ends = F.explode(F.array("nameOrig", "nameDest")).alias("accountId")
    return txns.select(ends).where(F.col("accountId").isNotNull()).distinct()
