from pyspark.sql import functions as F

from tellerlake import jobs
from tellerlake.operators import quality as Q
from tellerlake.plans.registry import MARKET_SEGMENTS, QUERIES
from tellerlake.sources import testtables
from tellerlake.sources.readers import read_transactions
from conftest import SF_DIR


def statuses(df):
    return {r.check: r.status for r in df.collect()}


def test_each_kind_of_check_can_pass_and_fail(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 4.0), (3, None)], "k int, v double")
    got = statuses(Q.expectations(df, "d", [
        Q.equals("rows", F.count("*"), 3),
        Q.equals("rows wrong", F.count("*"), 4),
        Q.equals("mean", F.avg("v"), 3.04, 0.05),
        Q.equals("mean wrong", F.avg("v"), 3.06, 0.05),
        Q.at_least("floor", F.max("k"), 3),
        Q.at_least("floor wrong", F.max("k"), 4),
        Q.every_row("positive", F.col("k") > 0),
        Q.every_row("null is a violation", F.col("v") > 0),
        Q.equals("not computable", F.max(F.when(F.col("k") > 9, 1)), 1),
    ]))
    assert got == {
        "rows": "PASS", "rows wrong": "FAIL", "mean": "PASS", "mean wrong": "FAIL",
        "floor": "PASS", "floor wrong": "FAIL", "positive": "PASS",
        "null is a violation": "FAIL", "not computable": "SKIP",
    }


def test_missing_dataset_is_skipped_and_the_gate_adds_up(spark):
    ok = Q.expectations(spark.range(3), "d", [Q.equals("rows", F.count("*"), 3)])
    bad = Q.expectations(spark.range(2), "e", [Q.equals("rows", F.count("*"), 3)])
    gone = Q.skipped(spark, "f", [Q.equals("a", F.count("*"), 1), Q.equals("b", F.count("*"), 1)])
    assert Q.gate(Q.all_results([ok, gone])).first()[:] == (1, 0, 2, True)
    assert Q.gate(Q.all_results([ok, bad, gone])).first()[:] == (1, 1, 2, False)


def test_bad_flagged_rows_fail_the_gate(txns):
    good = {"type": "TRANSFER", "amount": 300000.0}
    checks = Q.flagged_checks()
    assert set(statuses(Q.expectations(txns(good), "flagged", checks)).values()) == {"PASS"}
    bad = Q.expectations(txns(good, {**good, "amount": 1.0}), "flagged", checks)
    assert statuses(bad)["flagged amounts"] == "FAIL"


def test_wrong_composite_score_fails(spark):
    schema = "fraud_rate_pct double, churn_probability double, composite_risk_score double"
    good = spark.createDataFrame([(10.0, 0.5, 6.2)], schema)
    bad = spark.createDataFrame([(10.0, 0.5, 6.2), (10.0, 0.5, 6.3)], schema)
    assert statuses(Q.expectations(good, "b", Q.blend_checks(1)))["composite formula"] == "PASS"
    assert statuses(Q.expectations(bad, "b", Q.blend_checks(2)))["composite formula"] == "FAIL"


def test_segment_mix_reports_missing_and_unexpected_segments(spark, profiles):
    df = profiles({"customerId": "C1"}, {"customerId": "C2", "segment": "Gold"})
    expected = spark.createDataFrame([("Basic", 1), ("Student", 4)], "segment string, expected bigint")
    got = {r.segment: (r.customers, r.matches) for r in Q.dq_segment_mix(df, expected).collect()}
    assert got == {"Basic": (1, True), "Gold": (1, False), "Student": (0, False)}


def test_unique_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "id string")
    assert Q.dq_unique(df, "id", "d").first()[:] == ("d", "id", 4, 2, 1, 1)


def test_orphans_and_mule_floor(spark, txns):
    df = txns({"nameOrig": "C1", "nameDest": "M1"})
    pool = spark.createDataFrame([("C1",), ("M1",), ("C7",)], "accountId string")
    assert [r.accountId for r in Q.dq_orphans(pool, df).collect()] == ["C7"]
    nothing = spark.createDataFrame([], "src string, dst string, amount double, isFraud int")
    assert Q.dq_mule_floor(nothing).first().status == "FAIL"


def test_checks_are_measured_by_the_write(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0), (2, 4.0), (3, None)], "k int, v double")
    checks = [Q.equals("rows", Q.row_count(), 3), Q.equals("mean", F.avg("v"), 9), Q.every_row("no null", F.col("v") > 0),
              Q.at_least("floor", F.max("k"), 3), Q.equals("constant", F.lit(5), 5)]
    m = Q.measured_write(df, "d", checks, lambda d: d.repartition(3).write.parquet(str(tmp_path / "d")))
    assert spark.read.parquet(str(tmp_path / "d")).count() == 3
    assert sorted(Q.verdicts(spark, [m]).collect()) == sorted(Q.expectations(df, "d", checks).collect())
    assert m.value("rows") is not None
    none = Q.measured_write(df.limit(0), "d", checks[:2], lambda d: d.write.parquet(str(tmp_path / "e")))
    assert statuses(Q.verdicts(spark, [none])) == {"rows": "FAIL", "mean": "SKIP"}


def test_gated_job_judges_what_it_writes(spark, tmp_path):
    txns, people = testtables.transactions(spark, SF_DIR), testtables.customers(spark, SF_DIR)

    def profile_checks(customers):
        return Q.profile_checks(
            expected_rows=customers, segments=MARKET_SEGMENTS, share=0.2, verified_share=0.92, avg_risk=0.495,
            avg_churn=0.495, avg_products=2.5, share_tolerance=0.02, tolerance=0.005)

    results = jobs.run_gated(spark, people, txns, str(tmp_path), profile_checks)
    expected = {(r.dataset, r.check): r[2:] for r in QUERIES["dq_expectations"](spark, SF_DIR).collect()}
    found = {(r.dataset, r.check): r[2:] for r in results.collect()}
    assert len(found) == 35 and found == expected
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Scan parquet" not in plan
    assert read_transactions(spark, str(tmp_path / "transactions")).count() == txns.count()
