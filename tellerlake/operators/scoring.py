"""Customer risk, lifetime value and behavioural baseline."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerlake import schemas as S
from tellerlake.functions import rules
from tellerlake.functions.exact import money_mean, money_sum
from tellerlake.operators.bounds import anchored, extent, last_active, minmax_normalise, scaled_by_maximum, step_window
from tellerlake.operators.reports import customer_activity, sent


def weighted_score(weights: dict[str, float], suffix: str = "") -> Column:
    terms = [F.col(name + suffix) * weight for name, weight in weights.items()]
    return F.round(reduce(add, terms), 4)


def _stamped(df: DataFrame, as_of: Column | None) -> DataFrame:
    return df if as_of is None else df.withColumn("scoredAt", as_of)


def risk_scores(
    txns: DataFrame,
    weights: dict[str, float] = S.RISK_WEIGHTS,
    window_steps: int = S.REPORT_WINDOW_STEPS,
    end_step: int | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Composite risk per account over the trailing window.

    Four behaviours are scaled to [0, 1] across all accounts and mixed. An account
    without any TRANSFER has no average; it reads as zero transfer risk.
    """
    start, end = step_window(txns, window_steps, end_step)
    is_cash_out = (F.col("type") == "CASH_OUT").cast("int")
    transfer_amount = F.when(F.col("type") == "TRANSFER", F.col("amount"))
    behaviour = (
        txns.where((F.col("step") > start) & (F.col("step") <= end))
        .groupBy(F.col("nameOrig").alias("customerId"))
        .agg(
            F.count(F.lit(1)).alias("txnCount"),
            money_sum("amount").alias("totalAmount"),
            F.coalesce(money_mean(transfer_amount), F.lit(0.0)).alias("avgTransferAmount"),
            F.try_divide(F.sum(is_cash_out), F.count(F.lit(1))).alias("cashOutRatio"),
            F.count_distinct("nameDest").alias("uniqueDestinations"),
            F.sum("isFraud").alias("fraudCount"),
        )
    )
    scored = (
        minmax_normalise(behaviour, weights)
        .withColumn("risk_score", weighted_score(weights, "_norm"))
        .select(
            "customerId", "risk_score",
            rules.risk_tier(F.col("risk_score")).alias("risk_tier"),
            "txnCount", "totalAmount", "avgTransferAmount", "cashOutRatio",
            "uniqueDestinations", "fraudCount",
            start.alias("windowStartStep"), end.alias("windowEndStep"),
        )
    )
    return _stamped(scored, as_of)


def clv_measures(
    activity: DataFrame,
    weights: dict[str, float] = S.CLV_WEIGHTS,
    cutoff: int = S.CLV_RECENCY_STEPS,
) -> DataFrame:
    """Add the lifetime-value components, score and tier to per-account activity.

    The last step and the maxima come from the activity itself, whose shuffle they share.
    """
    activity = anchored(activity)
    idle = last_active(activity) - F.col("last_active_step")
    recency = F.when(idle > cutoff, 0.0).otherwise((cutoff - idle) / F.lit(float(cutoff)))
    shares = {"total_amount": "volumeScore", "txn_count": "frequencyScore"}
    scaled = scaled_by_maximum(activity, shares)
    return (
        scaled.withColumn("stepsSinceLastTxn", idle)
        .withColumn("diversityScore", F.col("distinct_types") / F.lit(float(len(S.TXN_TYPES))))
        .withColumn("recencyScore", recency)
        .withColumn("clv_score", weighted_score(weights))
        .withColumn("clv_tier", rules.clv_tier(F.col("clv_score")))
    )


def clv_scores(
    txns: DataFrame,
    weights: dict[str, float] = S.CLV_WEIGHTS,
    cutoff: int = S.CLV_RECENCY_STEPS,
    as_of: Column | None = None,
) -> DataFrame:
    """Lifetime value per account: volume, frequency, product diversity and recency."""
    return clv_of(customer_activity(txns), weights, cutoff, as_of)


def clv_of(
    activity: DataFrame,
    weights: dict[str, float] = S.CLV_WEIGHTS,
    cutoff: int = S.CLV_RECENCY_STEPS,
    as_of: Column | None = None,
) -> DataFrame:
    """The scores from activity per account, computed or stored."""
    activity = activity.select("customerId", "total_amount", "txn_count", "distinct_types", "last_active_step")
    scored = clv_measures(activity, weights, cutoff).select(
        "customerId", "clv_score", "clv_tier",
        "volumeScore", "frequencyScore", "diversityScore", "recencyScore",
        F.col("total_amount").alias("totalAmount"),
        F.col("txn_count").alias("txnCount"),
        F.col("distinct_types").alias("distinctTypes"),
        F.col("last_active_step").alias("lastActiveStep"),
        "stepsSinceLastTxn",
    )
    return _stamped(scored, as_of)


def customer_baseline(txns: DataFrame, rate_steps: int = S.CHURN_RATE_STEPS) -> DataFrame:
    """All-time mean amount and transactions per ``rate_steps`` steps, per account.

    The rate divides by the length of the whole history, so an account that joined
    late has a low baseline. The history includes the period being judged.
    """
    accounts = sent(txns).groupBy(F.col("nameOrig").alias("customerId")).agg(
        money_mean("amount").alias("baselineAvgAmount"),
        F.count(F.lit(1)).alias("history"),
        F.min("step").alias("firstStep"),
        F.max("step").alias("lastStep"),
    )
    return baseline_of(accounts, rate_steps)


def baseline_of(accounts: DataFrame, rate_steps: int = S.CHURN_RATE_STEPS) -> DataFrame:
    """The baseline from each account's mean, number of transactions and first and last step."""
    accounts = anchored(accounts)
    ends = extent(accounts)
    span = ends["lastStep_hi"] - ends["firstStep_lo"] + 1
    periods = F.greatest(F.lit(1), span) / F.lit(float(rate_steps))
    return accounts.select(
        "customerId", "baselineAvgAmount",
        (F.col("history") / periods).alias("baselineFreqPer12"),
    )
