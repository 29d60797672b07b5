"""Edges of the business rules."""

import pytest
from pyspark.sql import functions as F

from tellerlake.functions import exact, rules
from tellerlake.operators import kpis


def tiers(spark, make, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    return [r[0] for r in df.select(make(F.col("v"))).collect()]


@pytest.mark.parametrize("make, values, expected", [
    (rules.risk_tier, [0.2499, 0.25, 0.60, 0.6001], ["Low", "Medium", "Medium", "High"]),
    (rules.clv_tier, [0.3999, 0.40, 0.70, 0.7001],
     ["At Risk", "Growth Potential", "Growth Potential", "High Value"]),
    (rules.risk_band, [-1, 2.0, 2.0001, 6.0, 6.0001], ["Low", "Low", "Medium", "Medium", "High"]),
    (rules.compliance_class, [1.9999, 2, 9.9999, 10], ["LOW", "MEDIUM", "MEDIUM", "HIGH"]),
    (rules.dormancy_severity, [73, 120, 121], ["Dormant", "Dormant", "Severely Dormant"]),
])
def test_tier_edges(spark, make, values, expected):
    assert tiers(spark, make, values) == expected


def test_fraud_rule_edges(txns):
    base = {"type": "TRANSFER", "amount": 200000.01, "newbalanceDest": 0.0}
    rows = [
        base,
        {**base, "amount": 200000.0},
        {**base, "newbalanceDest": 0.01},
        {**base, "newbalanceDest": None},
        *[{**base, "type": t} for t in ["CASH_OUT", "PAYMENT", "CASH_IN", "DEBIT"]],
    ]
    numbered = [{**r, "step": i} for i, r in enumerate(rows)]
    flagged = kpis.flag_transactions(txns(*numbered)).collect()
    assert [r.step for r in flagged] == [0, 4]
    assert flagged[0].fraudReason == "type=TRANSFER + amount>200,000 + newbalanceDest=0"


def test_day_and_event_time(spark):
    df = spark.createDataFrame([(1,), (24,), (25,), (720,)], "step int")
    got = df.select(rules.day_of(), F.unix_seconds(rules.event_time())).collect()
    assert [r[0] for r in got] == [1, 1, 2, 30]
    assert [r[1] - 1_704_067_200 for r in got] == [3600, 86400, 90000, 720 * 3600]


def test_latency_is_in_milliseconds(txns):
    df = txns({"ingestedAt": 1_700_000_000_250})
    row = kpis.with_latency(df, F.timestamp_millis(F.lit(1_700_000_001_000))).first()
    assert (row.flaggedAt, row.detectionLatencyMs) == (1_700_000_001_000, 750)


def test_exact_sum_beats_floating_point(spark):
    values = [0.1] * 1000 + [1e12 + 0.01, -0.1]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
    assert df.agg(exact.money_sum("v")).first()[0] == 1_000_000_000_099.91
    assert df.where("v < 0").agg(exact.money_sum("v"), exact.money_mean("v")).first()[:] == (-0.1, -0.1)
    assert df.where("v > 1e13").agg(exact.money_mean("v"), exact.score_mean("v")).first()[:] == (None, None)


def test_whole_sum_does_not_overflow(spark):
    big = (1 << 62) + 12345
    total = spark.range(100).agg(exact.whole_sum(F.lit(big))).first()[0]
    assert int(total) == 100 * big
    total = spark.range(100).agg(exact.whole_sum(F.lit(-big))).first()[0]
    assert int(total) == -100 * big


def test_confirmation_slicer(txns):
    df = txns({"isFraud": 1}, {"isFraud": 0}, {"isFraud": 0})
    count = {s: df.where(rules.confirmation(s)).count() for s in ("all", "confirmed", "false_positive")}
    assert count == {"all": 3, "confirmed": 1, "false_positive": 2}
