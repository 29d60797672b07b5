"""Every operator on empty inputs: its schema and no rows, or one row of zeros."""

import pytest
from pyspark.sql import functions as F

from tellerlake.operators import blend, graph, kpis, mart, reports, scoring
from tellerlake.sources.testtables import customers, transactions
from tellerlake.streaming import churn
from conftest import SF_DIR

PER_GROUP = {
    "confirmed": lambda t, c: reports.confirmed_fraud(t),
    "compliance": lambda t, c: reports.compliance_summary(t),
    "customer": lambda t, c: reports.customer_fraud_summary(t),
    "dormancy": lambda t, c: reports.dormancy_report(t),
    "daily": lambda t, c: reports.daily_summary(t),
    "accounts": lambda t, c: reports.distinct_accounts(t),
    "risk": lambda t, c: scoring.risk_scores(t),
    "clv": lambda t, c: scoring.clv_scores(t),
    "baseline": lambda t, c: scoring.customer_baseline(t),
    "mart": lambda t, c: mart.txn_summary_mart(t),
    "summary": lambda t, c: mart.transaction_summary(mart.txn_summary_mart(t)),
    "by type": lambda t, c: mart.summary_by_type(mart.transaction_summary(mart.txn_summary_mart(t))),
    "from daily": lambda t, c: mart.transaction_summary_from_daily(reports.daily_summary(t)),
    "blend": lambda t, c: blend.customer_risk_blend_from(c, t),
    "rollup": lambda t, c: blend.segment_rollup(blend.customer_risk_blend_from(c, t)),
    "heatmap": lambda t, c: kpis.churn_heatmap(blend.customer_risk_blend_from(c, t)),
    "quadrant": lambda t, c: kpis.risk_churn_quadrant(blend.customer_risk_blend_from(c, t)),
    "flagged": lambda t, c: kpis.flag_transactions(t),
    "feed": lambda t, c: kpis.live_feed(kpis.flag_transactions(t)),
    "trend": lambda t, c: kpis.fraud_rate_trend(mart.transaction_summary(mart.txn_summary_mart(t))),
    "mules": lambda t, c: graph.money_mules(graph.payments(t)),
    "rings": lambda t, c: graph.fraud_rings(graph.payments(t)),
    "paths": lambda t, c: graph.top_fraud_paths(graph.payments(t)),
    "layering": lambda t, c: graph.layering_accounts(graph.payments(t)),
    "windows": lambda t, c: churn.churn_windows(t),
    "alerts": lambda t, c: churn.build_alerts(churn.churn_windows(t), scoring.customer_baseline(t)),
}

ONE_ROW = {
    "inventory": lambda t, c: mart.mart_inventory(mart.txn_summary_mart(t)),
    "portfolio": lambda t, c: kpis.portfolio_kpis(c),
    "customer 360": lambda t, c: kpis.kpi_customer_360(blend.customer_risk_blend_from(c, t)),
    "board": lambda t, c: kpis.kpi_fraud_board(kpis.flag_transactions(t), t),
    "compliance": lambda t, c: kpis.kpi_compliance(
        reports.compliance_summary(t), reports.dormancy_report(t)),
    "metric": lambda t, c: kpis.fraud_batch_metric(t, 1),
    "graph": lambda t, c: graph.graph_inventory(
        graph.account_nodes(t), graph.transaction_nodes(t), graph.sent_edges(t), graph.received_edges(t)),
}


@pytest.fixture
def nothing(spark):
    never = F.lit(1) == F.lit(0)
    return transactions(spark, SF_DIR).where(never), customers(spark, SF_DIR).where(never)


@pytest.mark.parametrize("name", PER_GROUP)
def test_no_rows(nothing, name):
    df = PER_GROUP[name](*nothing)
    assert df.columns and df.collect() == []


@pytest.mark.parametrize("name", ONE_ROW)
def test_one_row_of_zeros(nothing, name):
    rows = ONE_ROW[name](*nothing).collect()
    assert len(rows) == 1
    assert all(v in (None, 0, 1, -62.0) for v in rows[0])
