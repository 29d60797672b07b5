"""Aggregates behind the fraud, customer and compliance report pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellerlake import schemas as S
from tellerlake.functions import rules
from tellerlake.functions.exact import SCORE, floored_percent, money_mean, money_sum, percent, score_mean
from tellerlake.operators.blend import select_present
from tellerlake.operators.bounds import extent
from tellerlake.operators.quantile import exact_median


def row_count() -> Column:
    return F.count(F.lit(1))


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


# --- fraud page -------------------------------------------------------------------

def flag_transactions(txns: DataFrame, flagged_at: Column | None = None) -> DataFrame:
    """Transactions caught by the fraud rule, with the reason.

    With ``flagged_at`` (a timestamp) the detection latency in milliseconds is added.
    """
    flagged = txns.where(rules.fraud_rule()).withColumn("fraudReason", rules.fraud_reason())
    if flagged_at is not None:
        flagged = with_latency(flagged, flagged_at)
    return select_present(flagged, S.FLAGGED_COLUMNS)


def with_latency(df: DataFrame, flagged_at: Column) -> DataFrame:
    """``flaggedAt`` in epoch milliseconds and its distance to ``ingestedAt``."""
    return df.withColumn("flaggedAt", F.unix_millis(flagged_at)).withColumn(
        "detectionLatencyMs", F.col("flaggedAt") - F.col("ingestedAt")
    )


def flagged_by_day(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy(rules.day_of().alias("day")).agg(
        row_count().alias("flagged_count"),
        money_sum("amount").alias("value"),
        F.count_if(rules.is_false_positive()).alias("false_positives"),
    )


def kpi_fraud_board(
    flagged: DataFrame, txns: DataFrame, legacy: float = S.LEGACY_FALSE_POSITIVE_PCT
) -> DataFrame:
    """Headline numbers of the fraud page, one row.

    Both inputs are first reduced to one row per day or step, which are few; the
    comparisons (latest day, halves of the period) are made on those.
    """
    days = flagged_by_day(flagged)
    latest = extent(days)["day_hi"]
    on_latest = F.col("day") == latest
    on_previous = F.col("day") == latest - 1

    steps = txns.groupBy("step").agg(row_count().alias("n"), F.sum("isFraud").alias("fraud"))
    late = F.col("step") > extent(steps)["step_hi"] / 2

    def rate(part: Column) -> Column:
        return floored_percent(
            F.sum(F.when(part, F.col("fraud"))), _zero(F.sum(F.when(part, F.col("n"))))
        )

    rates = steps.agg(
        F.struct(
            percent(F.sum("fraud"), F.sum("n")).alias("overall"),
            (rate(late) - rate(~late)).alias("change"),
        )
    ).scalar()

    def on(day: Column, column: str) -> Column:
        return _zero(F.sum(F.when(day, F.col(column))))

    board = days.agg(
        F.max("day").alias("latest_day"),
        on(on_latest, "flagged_count").alias("flagged_today"),
        on(on_previous, "flagged_count").alias("flagged_yesterday"),
        money_sum(F.when(on_latest, F.col("value"))).alias("value_today"),
        money_mean("value").alias("daily_avg_value"),
        _zero(F.sum("false_positives")).alias("false_positives"),
        _zero(F.sum("flagged_count")).alias("flagged_total"),
    )
    change = F.col("flagged_today") - F.col("flagged_yesterday")
    fp_rate = floored_percent(F.col("false_positives"), F.col("flagged_total"))
    return board.select(
        "latest_day", "flagged_today", "flagged_yesterday",
        _zero(percent(change, F.col("flagged_yesterday"))).alias("dod_pct"),
        rates["overall"].alias("fraud_rate_pct"),
        rates["change"].alias("fraud_rate_change_pp"),
        "value_today", "daily_avg_value",
        (F.col("value_today") - F.col("daily_avg_value")).alias("value_vs_avg"),
        "flagged_total", "false_positives",
        fp_rate.alias("false_positive_pct"),
        (fp_rate - legacy).alias("false_positive_vs_legacy_pp"),
    )


def flagged_by_step(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("step", "type").agg(
        row_count().alias("flagged_count"), money_sum("amount").alias("value")
    )


def flagged_by_type(flagged: DataFrame, ordered: bool = True) -> DataFrame:
    counts = flagged.groupBy("type").agg(
        row_count().alias("flagged"),
        F.sum("isFraud").alias("confirmed"),
        money_sum("amount").alias("value"),
    )
    return counts.orderBy(F.desc("flagged")) if ordered else counts


def latency_sla(flagged: DataFrame, sla_ms: int = S.LATENCY_SLA_MS) -> DataFrame:
    """Median detection latency and whether it meets the target, one row."""
    median = exact_median(flagged, "detectionLatencyMs")
    return flagged.agg(F.count("detectionLatencyMs").alias("records")).select(
        "records",
        median.alias("median_latency_ms"),
        (median <= sla_ms).alias("within_sla"),
    )


def live_feed(flagged: DataFrame, n: int = 250, status: str = "all", also: Sequence[str] = ()) -> DataFrame:
    """Newest flagged rows. Only the n rows that are shown are ever ordered and kept.

    Rows without a detection time are ordered by step and amount instead. ``also`` names
    columns to show besides those of the feed.
    """
    order = [F.desc("step"), F.desc("amount"), "nameOrig", "nameDest"]
    if "flaggedAt" in flagged.columns:
        order = [F.desc("flaggedAt"), *order]
    newest = flagged.where(rules.confirmation(status)).orderBy(*order).limit(n)
    return select_present(newest, [*S.FEED_COLUMNS, *also])


def fraud_batch_metric(batch: DataFrame, batch_id: int) -> DataFrame:
    """Size, hits and hit rate of one micro-batch, counted in a single pass."""
    return batch.agg(row_count().alias("totalCount"), F.count_if(rules.fraud_rule()).alias("flaggedCount")).select(
        F.lit(batch_id).cast("bigint").alias("batchId"),
        "totalCount", "flaggedCount",
        _zero(percent(F.col("flaggedCount"), F.col("totalCount"))).alias("fraudRatePct"),
    )


# --- customer page ----------------------------------------------------------------

def segment_distribution(profiles: DataFrame, ordered: bool = True) -> DataFrame:
    groups = profiles.groupBy("segment").agg(
        row_count().alias("customers"),
        score_mean("risk_score").alias("avg_risk"),
        score_mean("churn_probability").alias("avg_churn"),
    )
    return groups.orderBy(F.desc("customers")) if ordered else groups


def portfolio_kpis(profiles: DataFrame) -> DataFrame:
    products = F.coalesce(F.size("products"), F.lit(0))
    return profiles.agg(
        row_count().alias("customers"),
        F.count_if(F.col("kyc_status") == "verified").alias("verified"),
        score_mean("risk_score").alias("avg_risk"),
        score_mean("churn_probability").alias("avg_churn"),
        F.try_divide(F.sum(products), row_count()).alias("avg_products"),
    )


def kpi_customer_360(blend: DataFrame) -> DataFrame:
    return blend.agg(
        row_count().alias("total_customers"),
        F.count_if(F.col("kyc_status") == "verified").alias("verified"),
        score_mean("risk_score").alias("avg_risk"),
        score_mean("churn_probability").alias("avg_churn"),
        F.try_divide(F.sum("product_count"), row_count()).alias("avg_products"),
        score_mean("composite_risk_score").alias("avg_composite_risk"),
    )


def segment_bars(blend: DataFrame, ordered: bool = True) -> DataFrame:
    bars = blend.groupBy("segment").agg(
        F.count("customerId").alias("customers"), score_mean("risk_score").alias("avg_risk")
    )
    return bars.orderBy("customers") if ordered else bars


def churn_heatmap(blend: DataFrame, channels: Sequence[str] = S.CHANNELS) -> DataFrame:
    """Mean churn probability, segments down and channels across.

    The channels are listed, so no extra job has to discover the column names.
    """
    return (
        blend.groupBy("segment")
        .pivot("preferred_channel", list(channels))
        .agg(score_mean("churn_probability"))
    )


def clv_tier_counts(blend: DataFrame, ordered: bool = True) -> DataFrame:
    counts = blend.groupBy("clv_tier").agg(row_count().alias("customers"))
    if not ordered:
        return counts
    known = F.array(*map(F.lit, S.CLV_TIER_ORDER))
    place = F.nullif(F.array_position(known, F.col("clv_tier")), F.lit(0))
    return counts.orderBy(place.asc_nulls_last(), "clv_tier")


def risk_churn_quadrant(blend: DataFrame) -> DataFrame:
    """Each customer against the portfolio's mean risk and mean churn."""
    guides = blend.agg(
        F.struct(
            score_mean("risk_score").alias("risk"), score_mean("churn_probability").alias("churn")
        )
    ).scalar()
    risky = F.when(F.col("risk_score") > guides["risk"], "high risk").otherwise("low risk")
    leaving = F.when(F.col("churn_probability") > guides["churn"], "high churn").otherwise("low churn")
    return blend.select(
        "customerId", "segment", "risk_score", "churn_probability",
        F.concat_ws(" / ", risky, leaving).alias("quadrant"),
    )


def risk_band_counts(blend: DataFrame) -> DataFrame:
    return blend.groupBy("risk_band").agg(row_count().alias("customers"))


def top_priority_customers(blend: DataFrame, k: int = 50) -> DataFrame:
    ranked = blend.orderBy(F.desc("composite_risk_score"), "customerId").limit(k)
    return select_present(ranked, S.PRIORITY_COLUMNS)


# --- compliance page --------------------------------------------------------------

def type_slice(df: DataFrame, types: Sequence[str] | None) -> DataFrame:
    return df.where(rules.one_of("transaction_type", types))


def kpi_compliance(
    compliance: DataFrame, dormancy: DataFrame, types: Sequence[str] | None = None
) -> DataFrame:
    """Headline numbers of the compliance page for the selected types, one row."""
    severe = F.col("dormancy_severity") == "Severely Dormant"
    accounts = dormancy.agg(
        F.struct(row_count().alias("dormant"), F.count_if(severe).alias("severe"))
    ).scalar()
    totals = type_slice(compliance, types).agg(
        _zero(F.sum("txn_count")).alias("total_txns"),
        F.coalesce(money_sum("total_volume"), F.lit(0.0)).alias("total_volume"),
        _zero(F.sum("fraud_count")).alias("total_fraud"),
        F.min("window_start_step").alias("window_start_step"),
        F.max("window_end_step").alias("window_end_step"),
    )
    return totals.select(
        "total_txns", "total_volume", "total_fraud",
        floored_percent(F.col("total_fraud"), F.col("total_txns")).alias("fraud_rate_pct"),
        accounts["dormant"].alias("dormant_accounts"),
        accounts["severe"].alias("severely_dormant"),
        "window_start_step", "window_end_step",
    )


def fraud_rate_trend(
    summary: DataFrame,
    types: Sequence[str] | None = None,
    rows: int = 12,
    target: float = S.FRAUD_RATE_TARGET_PCT,
) -> DataFrame:
    """Fraud rate per step, its rolling mean over the last ``rows`` rows, and breaches.

    The rolling window has no partition key, so it runs in one task; its input is the
    finished series of one row per step, 8,760 rows for a year of hours.
    """
    series = (
        type_slice(summary, types)
        .groupBy("step")
        .agg(F.sum("txn_count").alias("txn_count"), F.sum("fraud_count").alias("fraud_count"))
        .withColumn("fraud_rate_pct", floored_percent(F.col("fraud_count"), F.col("txn_count")))
    )
    recent = Window.orderBy("step").rowsBetween(1 - rows, Window.currentRow)
    exact_rate = F.col("fraud_rate_pct").cast(SCORE)
    rolling = F.sum(exact_rate).over(recent).cast("double") / F.count(exact_rate).over(recent)
    return series.withColumn("rolling_rate_pct", rolling).withColumn(
        "breach", F.col("rolling_rate_pct") > target
    )


def dormancy_tier_counts(dormancy: DataFrame) -> DataFrame:
    return dormancy.groupBy("dormancy_severity").agg(row_count().alias("accounts"))


def longest_dormant(dormancy: DataFrame, k: int = 25) -> DataFrame:
    ranked = dormancy.orderBy(F.desc("steps_inactive"), "customerId").limit(k)
    return ranked.select(
        "customerId", "dormancy_severity", "steps_inactive",
        "last_active_step", "txn_count", "total_amount",
    )


def risk_tier_counts(risk: DataFrame) -> DataFrame:
    return risk.groupBy("risk_tier").agg(row_count().alias("customers"))


def audit_table(compliance: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    return (
        type_slice(compliance, types)
        .select(
            "transaction_type", "txn_count", "total_volume", "avg_amount", "max_amount",
            "fraud_count", "fraud_volume", "fraud_rate_pct",
            "system_flagged_count", "risk_classification",
        )
        .orderBy(F.desc("total_volume"))
    )
