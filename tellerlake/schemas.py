"""Schemas and domain constants.

Everything under "fixed values" is part of the data contract: field names, domain
lists, thresholds and weights have to be exactly these for results to agree with
existing reports. Operators take the thresholds as keyword arguments and use these
as defaults.
"""

from pyspark.sql import types as T

# --- fixed values: record layouts -------------------------------------------------

_STRING, _INT, _LONG, _DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _record(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TRANSACTION_SCHEMA = _record({
    "step": _INT, "type": _STRING, "amount": _DOUBLE,
    "nameOrig": _STRING, "oldbalanceOrg": _DOUBLE, "newbalanceOrig": _DOUBLE,
    "nameDest": _STRING, "oldbalanceDest": _DOUBLE, "newbalanceDest": _DOUBLE,
    "isFraud": _INT, "isFlaggedFraud": _INT, "ingestedAt": _LONG,
})

CUSTOMER_SCHEMA = _record({
    "customerId": _STRING, "name": _STRING, "age": _INT, "segment": _STRING,
    "products": T.ArrayType(_STRING), "kyc_status": _STRING,
    "risk_score": _DOUBLE, "churn_probability": _DOUBLE,
    "account_opened": _STRING, "preferred_channel": _STRING,
})

# A message is the flat record or an envelope around it; one schema reads both.
MESSAGE_SCHEMA = T.StructType(
    [*TRANSACTION_SCHEMA.fields, T.StructField("payload", TRANSACTION_SCHEMA)]
)

# Graph import files; the headers carry the type.
GRAPH_ACCOUNT_SCHEMA = _record({
    "accountId:ID": _STRING, "accountType": _STRING, ":LABEL": _STRING,
})
GRAPH_TRANSACTION_SCHEMA = _record({
    "txnId:ID": _STRING, "step:int": _INT, "type": _STRING,
    "amount:float": _DOUBLE, "isFraud:int": _INT, ":LABEL": _STRING,
})
GRAPH_SENT_SCHEMA = _record({
    ":START_ID": _STRING, ":END_ID": _STRING, "amount:float": _DOUBLE,
    "timestamp:int": _INT, "transactionType": _STRING, ":TYPE": _STRING,
})
GRAPH_RECEIVED_SCHEMA = _record({
    ":START_ID": _STRING, ":END_ID": _STRING, "newbalanceDest:float": _DOUBLE,
    "isFraud:int": _INT, ":TYPE": _STRING,
})

FLAGGED_COLUMNS = [
    "step", "type", "amount",
    "nameOrig", "oldbalanceOrg", "newbalanceOrig",
    "nameDest", "oldbalanceDest", "newbalanceDest",
    "isFraud", "isFlaggedFraud",
    "detectionLatencyMs", "flaggedAt", "fraudReason",
]

ALERT_COLUMNS = [
    "customerId", "windowStart", "windowEnd",
    "signals", "signalCount", "txnCount",
    "windowAvgAmount", "baselineAvgAmount", "baselineFreqPer12",
    "lowBalanceEvents", "cashOutOnly", "detectedAt",
]

BLEND_COLUMNS = [
    # profile
    "customerId", "name", "age", "segment", "kyc_status", "preferred_channel",
    "product_count", "products", "account_opened",
    # activity
    "txn_count", "total_amount", "avg_amount", "fraud_count", "fraud_rate_pct",
    "unique_destinations", "last_active_step",
    # scores
    "risk_score", "churn_probability", "composite_risk_score", "risk_band",
    "clv_score", "clv_tier",
    # dormancy
    "dormancy_severity", "steps_inactive", "is_dormant",
]

PRIORITY_COLUMNS = [
    "customerId", "name", "segment", "kyc_status", "preferred_channel",
    "product_count", "risk_score", "churn_probability",
    "composite_risk_score", "risk_band", "clv_score", "clv_tier",
    "dormancy_severity", "fraud_count",
]

FEED_COLUMNS = [
    "step", "type", "amount", "nameOrig", "nameDest",
    "newbalanceDest", "isFraud", "fraudReason", "detectionLatencyMs",
]

# --- fixed values: domains --------------------------------------------------------

TXN_TYPES = ["PAYMENT", "TRANSFER", "CASH_OUT", "CASH_IN", "DEBIT"]
FRAUD_TYPES = ["TRANSFER", "CASH_OUT"]
SEGMENTS = ["Standard", "Basic", "Premium", "Student", "Private Banking"]
PRODUCTS = [
    "savings", "current", "mortgage", "credit_card",
    "personal_loan", "car_loan", "fixed_deposit", "investment_fund",
]
CHANNELS = ["mobile", "web", "branch", "atm", "phone"]
CLV_TIER_ORDER = ["High Value", "Growth Potential", "At Risk", "No Activity"]

# --- fixed values: thresholds and weights -----------------------------------------

STEPS_PER_DAY = 24
STEP_EPOCH_SECONDS = 1_704_067_200  # 2024-01-01 00:00:00 UTC, the start of step 0

FRAUD_AMOUNT = 200_000
LATENCY_SLA_MS = 2_000
LEGACY_FALSE_POSITIVE_PCT = 62.0
FRAUD_RATE_TARGET_PCT = 8.0

REPORT_WINDOW_STEPS = 168

DORMANT_AFTER_STEPS = 72
SEVERE_AFTER_STEPS = 120
DORMANCY_MIN_TXNS = 5

RISK_WEIGHTS = {
    "txnCount": 0.25,
    "avgTransferAmount": 0.30,
    "cashOutRatio": 0.25,
    "uniqueDestinations": 0.20,
}
RISK_TIER_CUTS = (0.25, 0.60)

CLV_WEIGHTS = {
    "volumeScore": 0.30,
    "frequencyScore": 0.25,
    "diversityScore": 0.25,
    "recencyScore": 0.20,
}
CLV_RECENCY_STEPS = 48
CLV_TIER_CUTS = (0.40, 0.70)

COMPOSITE_FRAUD_WEIGHT = 0.6
COMPOSITE_CHURN_WEIGHT = 0.4
RISK_BAND_CUTS = (2.0, 6.0)

COMPLIANCE_CUTS = (2, 10)

CHURN_WINDOW_STEPS = 24
CHURN_RATE_STEPS = 12
CHURN_WATERMARK = "2 hours"
FREQUENCY_FLOOR = 1.0
FREQUENCY_BASELINE = 3.0
SPEND_COLLAPSE_RATIO = 0.20
LOW_BALANCE = 500
LOW_BALANCE_EVENTS = 2
MIN_SIGNALS = 2

MULE_MIN_SENDERS = 4
MULE_FLOOR = 5
RING_MIN_SHARED = 2
LAYERING_MIN_IN = 3
LAYERING_MIN_OUT = 2
