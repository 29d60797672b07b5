from pyspark.sql import functions as F

from tellerlake.operators import blend, reports, scoring
from tellerlake.schemas import BLEND_COLUMNS
from tellerlake.sources import testtables
from conftest import SF_DIR


def test_one_pass_blend_equals_the_blend_of_finished_reports(spark):
    t, c = testtables.transactions(spark, SF_DIR), testtables.customers(spark, SF_DIR)
    from_reports = blend.customer_risk_blend(
        c, reports.customer_fraud_summary(t), scoring.clv_scores(t), reports.dormancy_report(t)
    )
    direct = blend.customer_risk_blend_from(c, t)
    assert direct.columns == from_reports.columns == BLEND_COLUMNS
    assert sorted(direct.collect()) == sorted(from_reports.collect())


def test_inactive_customers_stay_and_optional_inputs_may_be_missing(txns, profiles):
    fraud = reports.customer_fraud_summary(txns({"nameOrig": "C1", "isFraud": 1}))
    customers = profiles({"customerId": "C1"}, {"customerId": "C2", "products": None})
    got = {r.customerId: r for r in blend.customer_risk_blend(customers, fraud).collect()}
    assert got["C1"].composite_risk_score == 60.08 and got["C1"].risk_band == "High"
    idle = got["C2"]
    assert (idle.txn_count, idle.clv_tier, idle.dormancy_severity, idle.is_dormant) == (
        0, "No Activity", "Active", False)
    assert (idle.product_count, idle.products, idle.composite_risk_score) == (0, "", 0.08)


def test_cleansing_turns_bad_text_into_zero(spark, profiles):
    schema = "customerId string, txn_count string, total_amount string, fraud_rate_pct string"
    text = spark.createDataFrame([("C1", "7", "n/a", "12.5")], schema)
    row = blend.customer_risk_blend(profiles({"customerId": "C1"}), text).first()
    assert (row.txn_count, row.total_amount, row.fraud_rate_pct) == (7, 0.0, 12.5)
    assert "avg_amount" not in row.asDict()


def test_slicers_combine(profiles):
    df = profiles(
        {"customerId": "C1"},
        {"customerId": "C2", "segment": "Premium"},
        {"customerId": "C3", "preferred_channel": "atm"},
        {"customerId": "C4", "kyc_status": "expired"},
    )
    ids = lambda **k: sorted(r.customerId for r in blend.customer_slice(df, **k).collect())
    assert ids() == ["C1", "C2", "C3", "C4"]
    assert ids(segments=["Basic"], channels=["web"], kyc=["verified"]) == ["C1"]
    assert ids(segments=[]) == []


def test_dormancy_edges(txns):
    def account(name, last, n=5):
        return [{"nameOrig": name, "step": last}] * n

    df = txns(
        *account("C72", 128), *account("C73", 127), *account("C120", 80), *account("C121", 79),
        *account("C4txns", 1, 4), *account("M1", 1), {"nameOrig": "M2", "step": 200},
    )
    got = {r.customerId: r.dormancy_severity for r in reports.dormancy_report(df).collect()}
    assert got == {"C73": "Dormant", "C120": "Dormant", "C121": "Severely Dormant"}


def test_flagged_rows_keep_their_count_when_enriched(txns, profiles):
    flagged = txns({"nameOrig": "C1"}, {"nameOrig": "C1"}, {"nameOrig": "C9"})
    customers = profiles({"customerId": "C1"})
    rich = blend.flagged_enriched(flagged, customers, ["segment"])
    assert rich.count() == 3 and rich.where(F.col("segment").isNull()).count() == 1
