"""Customer 360: profiles joined with activity, lifetime value and dormancy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake import schemas as S
from tellerlake.functions import rules
from tellerlake.functions.exact import score_mean
from tellerlake.operators.reports import customer_activity
from tellerlake.operators.scoring import clv_measures

_NUMERIC_DEFAULTS = {
    "txn_count": "bigint",
    "total_amount": "double",
    "avg_amount": "double",
    "fraud_count": "bigint",
    "fraud_rate_pct": "double",
    "unique_destinations": "bigint",
    "last_active_step": "int",
    "clv_score": "double",
    "steps_inactive": "int",
}


_FRAUD_COLUMNS = [
    "customerId", "txn_count", "total_amount", "avg_amount", "fraud_count", "unique_destinations", "last_active_step",
]


def core_activity(activity: DataFrame) -> DataFrame:
    """What scores, tiers and bands are made of."""
    return activity.drop("unique_destinations", "avg_amount")


def select_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The given columns in the given order, without those the frame lacks."""
    return df.select([c for c in columns if c in df.columns])


def cleanse(df: DataFrame) -> DataFrame:
    """Read measures as numbers (bad text becomes 0) and name the missing tiers."""
    fixed = {
        name: F.coalesce(F.col(name).try_cast(kind), F.lit(0).cast(kind))
        for name, kind in _NUMERIC_DEFAULTS.items()
        if name in df.columns
    }
    no_tier = F.lit("No Activity")
    fixed["clv_tier"] = F.coalesce("clv_tier", no_tier) if "clv_tier" in df.columns else no_tier
    severity = F.coalesce(F.col("dormancy_severity"), F.lit("Active"))
    fixed["dormancy_severity"] = severity
    fixed["is_dormant"] = severity != "Active"
    return df.withColumns(fixed)


def product_fields(df: DataFrame) -> DataFrame:
    """Number of products held and their names as one string."""
    held = F.coalesce(F.col("products"), F.array().cast("array<string>"))
    return df.withColumns({"product_count": F.size(held), "products": F.array_join(held, ", ")})


def _finish(joined: DataFrame, ordered: bool) -> DataFrame:
    scored = cleanse(joined).withColumn("composite_risk_score", rules.composite_risk())
    banded = scored.withColumn("risk_band", rules.risk_band(F.col("composite_risk_score")))
    blend = select_present(product_fields(banded), S.BLEND_COLUMNS)
    return blend.orderBy(F.desc("composite_risk_score"), "customerId") if ordered else blend


def customer_risk_blend(
    profiles: DataFrame,
    fraud: DataFrame,
    clv: DataFrame | None = None,
    dormancy: DataFrame | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Blend of finished reports. Profiles are the spine, so inactive customers stay.

    Lifetime value and dormancy are optional: without them every customer reads as
    having no activity tier, or as active.
    """
    spark = profiles.sparkSession
    if clv is None:
        clv = spark.createDataFrame([], "customerId string, clv_score double, clv_tier string")
    if dormancy is None:
        dormancy = spark.createDataFrame(
            [], "customerId string, dormancy_severity string, steps_inactive int"
        )
    joined = (
        profiles.join(fraud, "customerId", "left")
        .join(clv.select("customerId", "clv_score", "clv_tier"), "customerId", "left")
        .join(
            dormancy.select("customerId", "dormancy_severity", "steps_inactive"),
            "customerId",
            "left",
        )
    )
    return _finish(joined, ordered)


def customer_risk_blend_from(
    profiles: DataFrame, txns: DataFrame, ordered: bool = True
) -> DataFrame:
    """The same blend straight from transactions.

    The three reports share their grouping key, so they are computed as one wide
    aggregate and joined once: one shuffle of the lake instead of three, and one join
    instead of three.
    """
    return blend_of(profiles, customer_activity(txns), ordered)


def blend_of(profiles: DataFrame, activity: DataFrame, ordered: bool = True) -> DataFrame:
    """The blend from activity per account, computed or stored.

    Without ``unique_destinations`` and ``avg_amount`` (``core_activity``) their columns are
    missing from the blend, and no distinct count has to be made.
    """
    names = [c for c in _FRAUD_COLUMNS if c in activity.columns]
    activity = clv_measures(activity.drop("first_active_step", "is_customer"))
    fraud = {c: F.col(c) for c in names}
    fraud["fraud_rate_pct"] = rules.fraud_rate(F.col("fraud_count"), F.col("txn_count"))
    idle = F.col("stepsSinceLastTxn")
    dormant = (
        rules.is_customer("customerId")
        & (idle > S.DORMANT_AFTER_STEPS)
        & (F.col("txn_count") >= S.DORMANCY_MIN_TXNS)
    )
    measures = activity.select(
        *[c.alias(name) for name, c in fraud.items()],
        "clv_score", "clv_tier",
        F.when(dormant, rules.dormancy_severity(idle)).alias("dormancy_severity"),
        F.when(dormant, idle).alias("steps_inactive"),
    )
    return _finish(profiles.join(measures, "customerId", "left"), ordered)


def segment_rollup(blend: DataFrame, ordered: bool = True) -> DataFrame:
    rollup = blend.groupBy("segment").agg(
        F.count("customerId").alias("customers"),
        F.round(score_mean("risk_score"), 4).alias("avg_risk_score"),
        F.round(score_mean("churn_probability"), 4).alias("avg_churn_probability"),
        F.round(score_mean("composite_risk_score"), 4).alias("avg_composite_risk"),
        F.round(score_mean("clv_score"), 4).alias("avg_clv"),
        F.sum("fraud_count").alias("total_fraud"),
        F.sum(F.col("is_dormant").cast("int")).alias("dormant_accounts"),
    )
    return rollup.orderBy(F.desc("customers")) if ordered else rollup


def customer_slice(
    blend: DataFrame,
    segments: Sequence[str] | None = None,
    channels: Sequence[str] | None = None,
    kyc: Sequence[str] | None = None,
) -> DataFrame:
    """Rows that pass every slicer; ``None`` means "all values"."""
    return blend.where(
        rules.one_of("segment", segments)
        & rules.one_of("preferred_channel", channels)
        & rules.one_of("kyc_status", kyc)
    )


def flagged_enriched(
    flagged: DataFrame, blend: DataFrame, attributes: Sequence[str] | None = None
) -> DataFrame:
    """Flagged transactions with their sender's customer attributes (left, many to one).

    No broadcast is forced: the customer side grows with the bank, so its size decides.
    """
    attributes = attributes or ["name", "segment", "kyc_status", "risk_band", "clv_tier"]
    dimension = blend.select(F.col("customerId").alias("nameOrig"), *attributes)
    return flagged.join(dimension, "nameOrig", "left")
