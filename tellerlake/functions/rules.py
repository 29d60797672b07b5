"""Business rules as pure Column expressions, used unchanged in batch and streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tellerlake import schemas as S
from tellerlake.functions.exact import percent


# --- fraud ------------------------------------------------------------------------

def fraud_rule(amount_min: int = S.FRAUD_AMOUNT) -> Column:
    """Account emptying: a large TRANSFER or CASH_OUT that leaves a zero balance."""
    emptied = F.col("newbalanceDest") == 0
    return F.col("type").isin(S.FRAUD_TYPES) & (F.col("amount") > amount_min) & emptied


def fraud_reason(amount_min: int = S.FRAUD_AMOUNT) -> Column:
    fixed_part = F.lit(f" + amount>{amount_min:,.0f} + newbalanceDest=0")
    return F.concat(F.lit("type="), F.col("type"), fixed_part)


def type_bit(kind: str = "type") -> Column:
    """A bit for each transaction type, so that a set of types is one whole number.

    Types beyond the known ones share the remaining bits by hash; null has no bit.
    """
    known = len(S.TXN_TYPES)
    bit = F.expr(f"shiftleft(1L, CAST({known} + pmod(xxhash64(`{kind}`), {63 - known}) AS INT))")
    for position, name in enumerate(S.TXN_TYPES):
        bit = F.when(F.col(kind) == name, F.lit(1 << position).cast("bigint")).otherwise(bit)
    return F.when(F.col(kind).isNotNull(), bit).otherwise(F.lit(0).cast("bigint"))


def is_false_positive() -> Column:
    """For flagged rows: the rule fired but the label says legitimate."""
    return F.col("isFraud") == 0


# --- time -------------------------------------------------------------------------

def day_of(step: str = "step") -> Column:
    return (F.floor((F.col(step) - 1) / S.STEPS_PER_DAY) + 1).cast("int")


def event_time(
    step: Column | str = "step", epoch_seconds: int = S.STEP_EPOCH_SECONDS
) -> Column:
    steps = F.col(step) if isinstance(step, str) else step
    return F.timestamp_seconds(F.lit(epoch_seconds) + steps.cast("bigint") * 3600)


def step_between(lo: int = 1, hi: int = S.REPORT_WINDOW_STEPS) -> Column:
    return F.col("step").between(lo, hi)


# --- accounts ---------------------------------------------------------------------

def is_customer(account: str = "nameOrig") -> Column:
    return F.col(account).startswith("C")


def account_type(account: str) -> Column:
    return F.when(F.col(account).startswith("M"), "MERCHANT").otherwise("CUSTOMER")


# --- tiers ------------------------------------------------------------------------

def risk_tier(score: Column, cuts: tuple = S.RISK_TIER_CUTS) -> Column:
    """Low below the first cut, Medium up to and including the second, else High."""
    low, medium = cuts
    return F.when(score < low, "Low").when(score <= medium, "Medium").otherwise("High")


def clv_tier(score: Column, cuts: tuple = S.CLV_TIER_CUTS) -> Column:
    """High Value above the upper cut, Growth Potential from the lower one on.

    Everything else is At Risk, a missing score included.
    """
    growth, high = cuts
    return (
        F.when(score > high, "High Value")
        .when(score >= growth, "Growth Potential")
        .otherwise("At Risk")
    )


def risk_band(score: Column, cuts: tuple = S.RISK_BAND_CUTS) -> Column:
    """Right-closed bins: a score equal to a cut belongs to the lower band.

    A missing score has no band.
    """
    low, medium = cuts
    return F.when(score > medium, "High").when(score > low, "Medium").when(score <= low, "Low")


def compliance_class(rate_pct: Column, cuts: tuple = S.COMPLIANCE_CUTS) -> Column:
    medium, high = cuts
    return F.when(rate_pct >= high, "HIGH").when(rate_pct >= medium, "MEDIUM").otherwise("LOW")


def dormancy_severity(inactive: Column, severe: int = S.SEVERE_AFTER_STEPS) -> Column:
    return F.when(inactive > severe, "Severely Dormant").otherwise("Dormant")


# --- scores -----------------------------------------------------------------------

def fraud_rate(fraud: Column, txns: Column, digits: int = 4) -> Column:
    return F.round(percent(fraud, txns), digits)


def composite_risk(
    w_fraud: float = S.COMPOSITE_FRAUD_WEIGHT, w_churn: float = S.COMPOSITE_CHURN_WEIGHT
) -> Column:
    """Weighted mix of a 0-100 rate and a 0-1 probability; the scales differ on purpose."""
    mix = F.col("fraud_rate_pct") * w_fraud + F.col("churn_probability") * w_churn
    return F.round(mix, 4)


# --- slicers ----------------------------------------------------------------------

def one_of(column: str, allowed: Sequence[str] | None) -> Column:
    """Slicer on one column; ``None`` leaves the column unrestricted."""
    return F.lit(True) if allowed is None else F.col(column).isin(list(allowed))


def confirmation(status: str) -> Column:
    """Slicer on the label: ``all``, ``confirmed`` or ``false_positive``."""
    wanted = {"all": None, "confirmed": 1, "false_positive": 0}[status]
    return F.lit(True) if wanted is None else F.col("isFraud") == wanted
