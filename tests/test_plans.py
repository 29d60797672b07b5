"""Plans that have to hold at scale, checked on the physical plan."""

import re
from pathlib import Path

import pytest

from tellerlake.operators import bounds, graph, reports, scoring
from tellerlake.operators.kpis import flag_transactions, flagged_by_type
from tellerlake.plans.registry import QUERIES
from tellerlake.sources.readers import read_transactions
from tellerlake.sources.testtables import stream_transactions, transactions
from tellerlake.sources.writers import overwrite_parquet
from tellerlake.streaming import churn
from conftest import ROOT, SF_DIR


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    plan = physical(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas"):
        assert bad not in plan


def test_windows_without_a_key_only_order_small_aggregates(spark):
    allowed = {"fraud_rate_trend", "latency_sla"}
    for name, make in QUERIES.items():
        if name not in allowed:
            plan = physical(make(spark, SF_DIR))
            assert not re.search(r"Window \[[^\n]*\], \[[^\]]+\]\n", plan) or "fraud_rings" in name


def executed(df):
    df.collect()
    return physical(df)


@pytest.mark.parametrize("score", [scoring.risk_scores, scoring.clv_scores])
def test_score_bounds_reuse_the_customer_aggregation(spark, score):
    plan = executed(score(transactions(spark, SF_DIR)))
    assert "ReusedExchange" in plan


def test_hot_keys_are_combined_before_they_are_shuffled(spark):
    plan = physical(reports.customer_fraud_summary(transactions(spark, SF_DIR)))
    assert "partial_count" in plan
    assert re.search(r"hashpartitioning\(nameOrig#\d+, nameDest#\d+", plan)


def test_a_known_end_step_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "lake")
    overwrite_parquet(transactions(spark, SF_DIR).where("step <= 20").drop("txnId"), path, ["step"])
    lake = read_transactions(spark, path)
    literal = physical(bounds.rolling_window(lake, 5, end_step=20))
    assert re.search(r"PartitionFilters: \[[^\]]*step#\d+ > 15", literal)
    lazy = physical(bounds.rolling_window(lake, 5))
    assert re.search(r"PartitionFilters: \[[^\]]*ubquery", lazy)
    assert sorted(bounds.rolling_window(lake, 5).collect()) == sorted(
        bounds.rolling_window(lake, 5, end_step=20).collect())


def test_fraud_rule_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "lake")
    overwrite_parquet(transactions(spark, SF_DIR).where("step <= 20").drop("txnId"), path, ["step"])
    df = flagged_by_type(flag_transactions(read_transactions(spark, path)))
    explain = spark.sparkContext._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString
    plan = explain(df._jdf.queryExecution(), "formatted")
    pushed = re.search(r"PushedFilters: ([^\n]*)", plan)[1]
    assert "GreaterThan(amount,200000.0)" in pushed and "EqualTo(newbalanceDest,0.0)" in pushed
    assert "nameOrig" not in re.search(r"ReadSchema: ([^\n]*)", plan)[1]


def test_windows_are_expanded_after_the_last_shuffle(spark):
    windows = churn.churn_windows(stream_transactions(spark, SF_DIR)).drop("txnTypes")
    plan = physical(windows)
    assert plan.index("Generate explode") < plan.index("Exchange hashpartitioning(customerId")
    assert plan.count("Exchange hashpartitioning") == 2 and "ObjectHashAggregate" not in plan


def test_ring_sample_is_limited_before_the_shuffle(spark):
    plan = physical(graph.fraud_rings(graph.payments(transactions(spark, SF_DIR))))
    assert "WindowGroupLimit" in plan and "TakeOrderedAndProject" in plan


def test_library_has_no_udf_and_no_driver_side_rows():
    library = Path(ROOT) / "tellerlake"
    for file in library.rglob("*.py"):
        # optional operators have rules of their own; one custom state is kept in pandas
        if library / "llm" in file.parents or file == library / "streaming" / "keyed.py":
            continue
        text = file.read_text()
        for bad in ("udf(", "InPandas", ".collect()", ".toPandas(", "localCheckpoint", "crossJoin", ".rdd"):
            assert bad not in text, f"{bad} in {file}"
