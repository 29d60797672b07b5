from pyspark.sql import functions as F

from tellerlake.operators import mart


def test_latest_balance_breaks_ties(txns):
    df = txns(
        {"ingestedAt": 5, "amount": 10.0, "newbalanceOrig": 1.0},
        {"ingestedAt": 9, "amount": 10.0, "newbalanceOrig": 2.0},
        {"ingestedAt": 9, "amount": 20.0, "newbalanceOrig": 3.0},
        {"ingestedAt": 9, "amount": 20.0, "newbalanceOrig": 4.0},
        {"ingestedAt": None, "amount": 99.0, "newbalanceOrig": 5.0},
    )
    assert mart.latest_balance(df).first().last_balance == 4.0
    row = mart.txn_summary_mart(df).first()
    assert (row.txn_count, row.last_balance, row.max_amount) == (5, 4.0, 99.0)


def test_types_are_listed_in_order_without_repeats(txns):
    df = txns(*[{"type": t} for t in ["TRANSFER", "CASH_IN", "TRANSFER", "DEBIT"]])
    assert mart.txn_summary_mart(df).first().txn_types == "CASH_IN,DEBIT,TRANSFER"


def test_attribution_splits_evenly_and_keeps_totals(txns):
    df = txns(
        {"type": "TRANSFER", "amount": 100.01, "isFraud": 1},
        {"type": "CASH_IN", "amount": 0.0},
        {"type": "DEBIT", "amount": 0.0},
        {"nameOrig": "C2", "type": "TRANSFER", "amount": 10.0},
    )
    m = mart.txn_summary_mart(df)
    got = {r.transaction_type: r for r in mart.transaction_summary(m).collect()}
    assert got["CASH_IN"].total_volume == got["DEBIT"].total_volume == 33.34
    assert got["TRANSFER"].total_volume == 43.34
    assert got["TRANSFER"].txn_count == 2 and got["TRANSFER"].customers == 2
    assert got["TRANSFER"].avg_amount == round((33.34 + 10.0) / 2, 2)   # mean of the two means
    assert got["TRANSFER"].fraud_rate_pct == round(100 * (1 / 3) / 2, 2)  # before rounding counts
    assert got["TRANSFER"].fraud_count == 0


def test_summary_keeps_only_the_asked_steps(txns):
    m = mart.txn_summary_mart(txns({"step": 0}, {"step": 1}, {"step": 168}, {"step": 169}))
    assert [r.step for r in mart.transaction_summary(m).collect()] == [1, 168]


def test_customer_count_equals_distinct_count(spark, txns):
    rows = [
        {"nameOrig": f"C{i % 7}", "step": 1 + i % 3, "type": t}
        for i in range(60) for t in (["DEBIT", "TRANSFER"] if i % 2 else ["CASH_IN"])
    ]
    df = txns(*rows)
    got = {(r.transaction_type, r.step): r.customers
           for r in mart.transaction_summary(mart.txn_summary_mart(df)).collect()}
    plain = df.groupBy("type", "step").agg(F.count_distinct("nameOrig").alias("n")).collect()
    assert got == {(r.type, r.step): r.n for r in plain}


def test_new_types_share_a_row_too(spark, txns):
    kinds = ["PAYMENT", "TRANSFER", "CASH_OUT", "CASH_IN", "DEBIT", "FEE", "REFUND"]
    rows = mart.txn_summary_mart(txns(*[{"type": k, "amount": 7.0} for k in kinds]))
    found = mart.transaction_summary(rows).collect()
    assert sorted(r.transaction_type for r in found) == sorted(kinds)
    assert {(r.total_volume, r.txn_count) for r in found} == {(7.0, 1)}
