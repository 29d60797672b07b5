import pytest
from pyspark.sql import functions as F

from tellerlake.operators import bounds, scoring


def test_constant_and_single_columns_normalise_to_zero(spark):
    same = spark.createDataFrame([("a", 5.0), ("b", 5.0)], "id string, v double")
    assert [r.v_norm for r in bounds.minmax_normalise(same, ["v"]).collect()] == [0.0, 0.0]
    assert bounds.minmax_normalise(same.limit(1), ["v"]).first().v_norm == 0.0


def test_normalise_to_max_of_nothing_positive(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", -3.0)], "id string, v double")
    assert {r.s for r in bounds.max_normalise(df, {"v": "s"}).collect()} == {0.0}


def test_normalise_to_the_maximum(spark):
    df = spark.createDataFrame([("a", 1.0, 9), ("b", 4.0, 8)], "id string, v double, x int")
    assert sorted(r.s for r in bounds.max_normalise(df, {"v": "s"}).collect()) == [0.25, 1.0]


def test_risk_window_ends_where_it_says(txns):
    df = txns({"step": 300, "amount": 1.0}, {"step": 400, "amount": 2.0},
              {"step": 500, "amount": 4.0}, {"step": 501, "amount": 8.0}, {"step": 700, "amount": 16.0})
    row = scoring.risk_scores(df, end_step=500).first()
    assert (row.txnCount, row.totalAmount, row.windowStartStep, row.windowEndStep) == (2, 6.0, 332, 500)


def test_customers_without_amounts_are_at_risk(txns):
    got = {r.customerId: r for r in scoring.clv_scores(
        txns({"nameOrig": "C1", "amount": None}, {"nameOrig": "C2"})).collect()}
    assert got["C1"].clv_score is None and got["C1"].clv_tier == "At Risk"


def test_risk_without_transfers_reads_as_zero(txns):
    df = txns(
        {"nameOrig": "C1", "type": "CASH_OUT"},
        {"nameOrig": "C2", "type": "TRANSFER", "amount": 50.0},
        {"nameOrig": "C2", "type": "TRANSFER", "amount": 70.0, "nameDest": "C9"},
    )
    got = {r.customerId: r for r in scoring.risk_scores(df).collect()}
    assert got["C1"].avgTransferAmount == 0.0 and got["C2"].avgTransferAmount == 60.0
    assert got["C1"].risk_score == 0.25           # cash-out ratio only
    assert got["C2"].risk_score == 0.75 and got["C2"].risk_tier == "High"


def test_risk_window_is_the_last_168_steps(txns):
    df = txns({"step": 1}, {"step": 32}, {"step": 33}, {"step": 200})
    row = scoring.risk_scores(df).first()
    assert (row.txnCount, row.windowStartStep, row.windowEndStep) == (2, 32, 200)
    fixed = scoring.risk_scores(df, end_step=200, as_of=F.current_timestamp()).first()
    assert fixed.txnCount == 2 and fixed.scoredAt is not None


@pytest.mark.parametrize("silent, expected", [(0, 1.0), (48, 0.0), (49, 0.0), (24, 0.5)])
def test_recency_edges(txns, silent, expected):
    df = txns({"nameOrig": "C1", "step": 100 - silent}, {"nameOrig": "C2", "step": 100})
    got = {r.customerId: r.recencyScore for r in scoring.clv_scores(df).collect()}
    assert got["C1"] == expected


def test_clv_of_the_best_customer(txns):
    kinds = ["PAYMENT", "TRANSFER", "CASH_OUT", "CASH_IN", "DEBIT"]
    df = txns(*[{"nameOrig": "C1", "type": t, "step": 9} for t in kinds], {"nameOrig": "C2", "step": 9})
    got = {r.customerId: r for r in scoring.clv_scores(df).collect()}
    assert (got["C1"].clv_score, got["C1"].clv_tier) == (1.0, "High Value")
    assert got["C2"].clv_score == round(0.3 / 5 + 0.25 / 5 + 0.25 / 5 + 0.2, 4)


def test_baseline_rate_uses_the_length_of_history(txns):
    df = txns(*[{"nameOrig": "C1", "step": s} for s in (1, 2, 3, 24)], {"nameOrig": "C2", "step": 24})
    got = {r.customerId: r for r in scoring.customer_baseline(df).collect()}
    assert got["C1"].baselineFreqPer12 == 2.0 and got["C2"].baselineFreqPer12 == 0.5
