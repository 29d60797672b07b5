"""One named query per operator, on the benchmark tables of a directory.

Queries return plain columns only: decimals become doubles and arrays become joined
text, so a result can be compared with any SQL engine. Run-time clocks are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, partial, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellerlake import schemas as S
from tellerlake.functions import rules
from tellerlake.functions.exact import money_sum
from tellerlake.operators import activity as A
from tellerlake.operators import blend as B
from tellerlake.operators import graph as G
from tellerlake.operators import kpis as K
from tellerlake.operators import mart as M
from tellerlake.operators import quality as Q
from tellerlake.operators import reports as R
from tellerlake.operators import scoring as C
from tellerlake.operators.bounds import max_normalise, minmax_normalise, rolling_window
from tellerlake import jobs
from tellerlake.session import work_path
from tellerlake.sources import testtables as tables
from tellerlake.sources.feed import newest_feed
from tellerlake.sources.graph_store import GraphStore
from tellerlake.sources.readers import decode_flagged, decode_transactions
from tellerlake.sources.stored import ActivityStore, read_mart, update_mart
from tellerlake.sources.writers import overwrite_parquet, to_kv
from tellerlake.streaming import churn, compaction

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TRIGGER_MS = 5_000
MARKET_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def plain(df: DataFrame) -> DataFrame:
    columns = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, "|")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        columns.append(c.alias(f.name))
    return df.select(columns)


def query(make: Callable[[Tables], DataFrame], name: str | None = None) -> Callable:
    @wraps(make)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return plain(make(Tables(spark, sf_dir)))

    QUERIES[name or make.__name__] = run
    return make


def named(name: str) -> Callable:
    return partial(query, name=name)


class Tables:
    """The inputs and the intermediate reports the queries share."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def txns(self) -> DataFrame:
        return tables.transactions(self.spark, self.sf_dir)

    @cached_property
    def profiles(self) -> DataFrame:
        return tables.customers(self.spark, self.sf_dir)

    @cached_property
    def stream(self) -> DataFrame:
        return tables.stream_transactions(self.spark, self.sf_dir)

    @cached_property
    def messages(self) -> DataFrame:
        return tables.messages(self.spark, self.sf_dir)

    @cached_property
    def flagged(self) -> DataFrame:
        """Stream transactions the rule catches, seen at the end of their trigger interval."""
        end = (F.floor(F.col("ingestedAt") / TRIGGER_MS) + 1) * TRIGGER_MS
        return K.flag_transactions(self.stream, F.timestamp_millis(end))

    @cached_property
    def blend(self) -> DataFrame:
        return B.customer_risk_blend_from(self.profiles, self.txns, ordered=False)

    @cached_property
    def core_blend(self) -> DataFrame:
        """The blend without counterparties and mean amounts, for pages that show neither."""
        activity = B.core_activity(R.customer_activity(self.txns))
        return B.blend_of(self.profiles, activity, ordered=False)

    @cached_property
    def mart(self) -> DataFrame:
        return M.txn_summary_mart(self.txns)

    @cached_property
    def summary(self) -> DataFrame:
        return M.transaction_summary(self.mart, ordered=False)

    @cached_property
    def compliance(self) -> DataFrame:
        return R.compliance_summary(self.txns, ordered=False)

    @cached_property
    def dormancy(self) -> DataFrame:
        return R.dormancy_report(self.txns, ordered=False)

    @cached_property
    def payments(self) -> DataFrame:
        return G.payments(self.txns)

    @cached_property
    def windows(self) -> DataFrame:
        return churn.churn_windows(self.stream)

    @cached_property
    def baseline(self) -> DataFrame:
        return C.customer_baseline(self.stream)


# --- scans and messages -----------------------------------------------------------

@query
def scan_transactions(t: Tables) -> DataFrame:
    return t.txns


@query
def scan_customers(t: Tables) -> DataFrame:
    return t.profiles


@query
def json_decode(t: Tables) -> DataFrame:
    return decode_transactions(t.messages).drop("kafkaTimestamp")


@query
def kv_json(t: Tables) -> DataFrame:
    return to_kv(t.flagged, "nameOrig", "nameDest", "type", "amount", "step", "flaggedAt")


def _feed(t: Tables, status: str) -> DataFrame:
    messages = to_kv(t.flagged, *t.flagged.columns)
    return K.live_feed(decode_flagged(messages, t.flagged.schema), status=status)


@query
def live_feed(t: Tables) -> DataFrame:
    return _feed(t, "all")


@query
def live_feed_confirmed(t: Tables) -> DataFrame:
    return _feed(t, "confirmed")


@query
def live_feed_false_positive(t: Tables) -> DataFrame:
    return _feed(t, "false_positive")


# --- rules and filters ------------------------------------------------------------

@query
def fraud_flagged(t: Tables) -> DataFrame:
    return t.flagged


@query
def confirmed_fraud(t: Tables) -> DataFrame:
    return R.confirmed_fraud(t.txns)


@query
def event_time(t: Tables) -> DataFrame:
    return t.stream.select("txnId", "step", rules.event_time().alias("eventTime"))


@named("rolling_window")
def rolling_window_rows(t: Tables) -> DataFrame:
    return rolling_window(t.txns).select("txnId", "step", "amount")


@query
def latest_balance(t: Tables) -> DataFrame:
    return M.latest_balance(t.txns)


@named("minmax_normalise")
def minmax_normalise_profiles(t: Tables) -> DataFrame:
    return minmax_normalise(
        t.profiles.select("customerId", "age", "risk_score"), ["age", "risk_score"]
    )


@named("max_normalise")
def max_normalise_activity(t: Tables) -> DataFrame:
    activity = R.customer_activity(t.txns).select("customerId", "total_amount", "txn_count")
    return max_normalise(activity, {"total_amount": "volume_share", "txn_count": "count_share"})


# --- reports ----------------------------------------------------------------------

@query
def compliance_summary(t: Tables) -> DataFrame:
    return R.compliance_summary(t.txns)


@query
def customer_fraud_summary(t: Tables) -> DataFrame:
    return R.customer_fraud_summary(t.txns)


@query
def dormancy_report(t: Tables) -> DataFrame:
    return R.dormancy_report(t.txns)


@query
def daily_summary(t: Tables) -> DataFrame:
    return R.daily_summary(t.txns)


@query
def distinct_accounts(t: Tables) -> DataFrame:
    return R.distinct_accounts(t.txns)


@query
def risk_scores(t: Tables) -> DataFrame:
    return C.risk_scores(t.txns)


@query
def clv_scores(t: Tables) -> DataFrame:
    return C.clv_scores(t.txns)


@query
def customer_baseline(t: Tables) -> DataFrame:
    return t.baseline


@query
def customer_activity(t: Tables) -> DataFrame:
    return R.customer_activity(t.txns)


@query
def activity_slices(t: Tables) -> DataFrame:
    return A.activity_slices(t.txns)


@query
def activity_counterparties(t: Tables) -> DataFrame:
    return A.counterparties(t.txns)


@query
def activity_merged(t: Tables) -> DataFrame:
    return A.merged_activity(A.activity_slices(t.txns), A.counterparties(t.txns))


@query
def baseline_merged(t: Tables) -> DataFrame:
    return C.baseline_of(A.baseline_accounts(A.activity_slices(t.stream)))


@query
def txn_summary_mart(t: Tables) -> DataFrame:
    return t.mart


@query
def mart_inventory(t: Tables) -> DataFrame:
    return M.mart_inventory(t.mart)


@query
def transaction_summary(t: Tables) -> DataFrame:
    return M.transaction_summary(t.mart)


@query
def transaction_summary_daily(t: Tables) -> DataFrame:
    return M.transaction_summary_from_daily(R.daily_summary(t.txns, ordered=False))


@query
def summary_by_type(t: Tables) -> DataFrame:
    return M.summary_by_type(t.summary)


# --- customer 360 -----------------------------------------------------------------

@query
def customer_risk_blend(t: Tables) -> DataFrame:
    return B.customer_risk_blend_from(t.profiles, t.txns)


@query
def segment_rollup(t: Tables) -> DataFrame:
    return B.segment_rollup(t.core_blend)


@query
def customer_slice(t: Tables) -> DataFrame:
    sliced = B.customer_slice(t.core_blend, ["BUILDING", "MACHINERY"], ["mobile", "web"], ["verified"])
    return sliced.select("customerId", "segment", "preferred_channel", "kyc_status", "risk_band")


@query
def flagged_enriched(t: Tables) -> DataFrame:
    return B.flagged_enriched(K.flag_transactions(t.txns), t.core_blend)


@query
def segment_distribution(t: Tables) -> DataFrame:
    return K.segment_distribution(t.profiles)


@query
def portfolio_kpis(t: Tables) -> DataFrame:
    return K.portfolio_kpis(t.profiles)


@query
def kpi_customer_360(t: Tables) -> DataFrame:
    return K.kpi_customer_360(t.core_blend)


@query
def segment_bars(t: Tables) -> DataFrame:
    return K.segment_bars(t.core_blend)


@query
def churn_heatmap(t: Tables) -> DataFrame:
    return K.churn_heatmap(t.core_blend)


@query
def clv_tier_counts(t: Tables) -> DataFrame:
    return K.clv_tier_counts(t.core_blend)


@query
def risk_churn_quadrant(t: Tables) -> DataFrame:
    return K.risk_churn_quadrant(t.core_blend)


@query
def risk_band_counts(t: Tables) -> DataFrame:
    return K.risk_band_counts(t.core_blend)


@query
def top_priority_customers(t: Tables) -> DataFrame:
    return K.top_priority_customers(t.core_blend)


# --- fraud page -------------------------------------------------------------------

@query
def kpi_fraud_board(t: Tables) -> DataFrame:
    return K.kpi_fraud_board(t.flagged, t.stream)


@query
def flagged_by_day(t: Tables) -> DataFrame:
    return K.flagged_by_day(t.flagged)


@query
def flagged_by_step(t: Tables) -> DataFrame:
    return K.flagged_by_step(t.flagged)


@query
def flagged_by_type(t: Tables) -> DataFrame:
    return K.flagged_by_type(t.flagged)


@query
def latency_sla(t: Tables) -> DataFrame:
    return K.latency_sla(t.flagged)


@query
def fraud_batch_metric(t: Tables) -> DataFrame:
    return K.fraud_batch_metric(t.stream, 0)


# --- compliance page --------------------------------------------------------------

@query
def kpi_compliance(t: Tables) -> DataFrame:
    return K.kpi_compliance(t.compliance, t.dormancy, ["TRANSFER", "CASH_OUT", "PAYMENT"])


@query
def audit_table(t: Tables) -> DataFrame:
    return K.audit_table(t.compliance)


@query
def fraud_rate_trend(t: Tables) -> DataFrame:
    return K.fraud_rate_trend(t.summary)


@query
def dormancy_tier_counts(t: Tables) -> DataFrame:
    return K.dormancy_tier_counts(t.dormancy)


@query
def longest_dormant(t: Tables) -> DataFrame:
    return K.longest_dormant(t.dormancy)


@query
def risk_tier_counts(t: Tables) -> DataFrame:
    return K.risk_tier_counts(C.risk_scores(t.txns))


# --- graph ------------------------------------------------------------------------

@query
def graph_nodes(t: Tables) -> DataFrame:
    return G.graph_nodes(t.txns)


@query
def graph_edges(t: Tables) -> DataFrame:
    return G.graph_edges(t.txns)


@query
def graph_paths(t: Tables) -> DataFrame:
    return G.graph_paths(G.sent_edges(t.txns), G.received_edges(t.txns))


@query
def graph_edges_valid(t: Tables) -> DataFrame:
    known = t.profiles.select(F.col("customerId").alias("accountId"))
    return G.valid_edges(G.sent_edges(t.txns), known, G.transaction_nodes(t.txns))


@query
def received_edges_valid(t: Tables) -> DataFrame:
    known = t.profiles.select(F.col("customerId").alias("accountId"))
    return G.valid_edges(G.received_edges(t.txns), known, G.transaction_nodes(t.txns))


@query
def graph_upsert(t: Tables) -> DataFrame:
    stored = G.transaction_nodes(t.txns.where("step % 3 <> 0"))
    newer = G.transaction_nodes(t.txns.where("step % 2 = 0").withColumn("amount", F.col("amount") + 1))
    return G.upsert(stored, newer, "txnId")


@query
def account_degrees(t: Tables) -> DataFrame:
    return G.account_degrees(G.graph_edges(t.txns))


@query
def graph_inventory(t: Tables) -> DataFrame:
    return G.graph_inventory(
        G.account_nodes(t.txns), G.transaction_nodes(t.txns),
        G.sent_edges(t.txns), G.received_edges(t.txns),
    )


@query
def money_mules(t: Tables) -> DataFrame:
    return G.money_mules(t.payments)


@query
def fraud_rings(t: Tables) -> DataFrame:
    return G.fraud_rings(t.payments)


@query
def fraud_rings_all(t: Tables) -> DataFrame:
    return G.fraud_rings(t.payments, k=None)


@query
def top_fraud_paths(t: Tables) -> DataFrame:
    return G.top_fraud_paths(t.payments)


@query
def layering_accounts(t: Tables) -> DataFrame:
    return G.layering_accounts(t.payments)


@query
def layering_accounts_all(t: Tables) -> DataFrame:
    return G.layering_accounts(t.payments, k=None)


# --- churn ------------------------------------------------------------------------

@query
def churn_windows(t: Tables) -> DataFrame:
    return t.windows.drop("hasCashOut", "hasPayment", "hasDebit")


@query
def churn_alerts(t: Tables) -> DataFrame:
    return churn.build_alerts(t.windows, t.baseline)


@query
def churn_signal_counts(t: Tables) -> DataFrame:
    return churn.churn_signal_counts(t.windows, t.baseline)


# --- stored results ---------------------------------------------------------------

def _lake(t: Tables) -> str:
    """The stream's transactions as a lake by step."""
    path = work_path(t.spark, "lake")
    rows = t.stream.select(S.TRANSACTION_SCHEMA.fieldNames()).hint("rebalance", "step")
    overwrite_parquet(rows, path, ["step"])
    return path


@query
def stored_mart(t: Tables) -> DataFrame:
    """The mart as it is kept beside a lake."""
    lake, path = _lake(t), work_path(t.spark, "mart")
    update_mart(t.spark, lake, path)
    return read_mart(t.spark, path)


@query
def stored_activity(t: Tables) -> DataFrame:
    store = ActivityStore(t.spark, work_path(t.spark, "activity"))
    store.refresh(_lake(t))
    return store.activity()


@query
def stored_graph_paths(t: Tables) -> DataFrame:
    """Paths of a graph that was loaded in two overlapping parts."""
    store = GraphStore(t.spark, work_path(t.spark, "graph"), buckets=8)
    store.load(t.txns.where("amount < 250000"))
    store.load(t.txns)
    return store.paths()


@query
def graph_upsert_all(t: Tables) -> DataFrame:
    """All transactions as stored, and all frauds among them again with another amount."""
    frauds = t.txns.where("isFraud = 1").withColumn("amount", F.col("amount") + 1)
    return G.upsert(G.transaction_nodes(t.txns), G.transaction_nodes(frauds), "txnId")


def _flagged_batches(t: Tables) -> tuple[str, str]:
    """Flagged rows in eight stored batches, in the order of detection, and their schema."""
    path = work_path(t.spark, "flagged")
    batches = t.flagged.repartitionByRange(8, "flaggedAt").withColumns(
        {"run": F.lit("first"), "batch_id": F.spark_partition_id()}
    )
    batches.write.partitionBy("run", "batch_id").parquet(path)
    return path, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in t.flagged.schema)


@query
def folded_batches(t: Tables) -> DataFrame:
    """Stored batches after they were folded and the small files removed."""
    path, schema = _flagged_batches(t)
    compaction.fold(t.spark, path, schema, "first")
    compaction.remove_folded(t.spark, path, older_than_ms=0)
    return compaction.read_batches(t.spark, path, schema).drop("run", "batch_id")


@named("newest_feed")
def newest_feed_rows(t: Tables) -> DataFrame:
    path, schema = _flagged_batches(t)
    return newest_feed(t.spark, path, schema, first_files=2)


# --- data quality -----------------------------------------------------------------

@query
def dq_expectations(t: Tables) -> DataFrame:
    def value(df: DataFrame, c: Column) -> Column:
        return df.agg(c).scalar()

    def values(df: DataFrame, **named: Column) -> Column:
        return value(df, F.struct(*[c.alias(name) for name, c in named.items()]))

    rows = F.count(F.lit(1))
    volume, fraud = money_sum("amount"), F.sum("isFraud")
    severe = F.col("dormancy_severity") == "Severely Dormant"
    daily = values(
        R.daily_summary(t.txns, ordered=False),
        rows=F.sum("txn_volume"), fraud=F.sum("fraud_count"), last=F.max("step"),
        volume=money_sum("total_amount"),
        rate=100.0 * F.sum("fraud_count") / F.sum("txn_volume"),
    )
    dormant = values(t.core_blend, all=F.count_if("is_dormant"), severe=F.count_if(severe))
    recent = values(rolling_window(t.txns), volume=volume, fraud=fraud)
    early_fraud = value(t.txns.where(rules.step_between()), fraud)
    # Control totals come from the other end: nodes from the edges' own ids, transactions
    # from the daily summary, customers from distinct ids.
    customers = value(t.profiles, F.count_distinct("customerId"))
    nodes = value(G.account_nodes(t.txns), rows)
    end = F.when(F.col("edgeType") == "SENT", F.col("startId")).otherwise(F.col("endId"))
    edges = values(G.graph_edges(t.txns), rows=rows, accounts=F.count_distinct(end))
    suites = [
        ("transactions", t.txns, Q.transaction_checks(
            nodes, daily["rows"], edges["accounts"],
            daily["fraud"], daily["volume"], daily["rate"], daily["last"],
        )),
        ("graph", G.transaction_nodes(t.txns), Q.graph_checks(
            accounts=nodes,
            edges=edges["rows"],
            mules=value(G.mule_accounts(t.payments), rows),
            expected_accounts=edges["accounts"],
            expected_rows=daily["rows"],
        )),
        ("customers", t.profiles, Q.profile_checks(
            expected_rows=customers, segments=MARKET_SEGMENTS, share=0.2, verified_share=0.92,
            avg_risk=0.495, avg_churn=0.495, avg_products=2.5,
            share_tolerance=0.02, tolerance=0.005,
        )),
        ("dormancy", t.dormancy, Q.dormancy_checks(dormant["all"], dormant["severe"])),
        ("compliance", t.compliance, Q.compliance_checks(recent["volume"], recent["fraud"])),
        ("flagged", t.flagged, Q.flagged_checks()),
        ("blend", t.core_blend, Q.blend_checks(customers)),
        ("summary", t.summary, Q.summary_checks(early_fraud)),
    ]
    return Q.all_results([Q.expectations(df, name, checks) for name, df, checks in suites])


@query
def dq_segment_mix(t: Tables) -> DataFrame:
    even = F.floor(F.count(F.lit(1)) / len(MARKET_SEGMENTS)).alias("expected")
    names = F.explode(F.array(*map(F.lit, MARKET_SEGMENTS))).alias("segment")
    return Q.dq_segment_mix(t.profiles, t.profiles.agg(even).select(names, "expected"))


@query
def dq_unique_keys(t: Tables) -> DataFrame:
    edge_ends = G.graph_edges(t.txns).select(F.concat_ws("|", "edgeType", "startId", "endId").alias("edge"))
    return Q.all_results([
        Q.dq_unique(t.profiles, "customerId", "customers"),
        Q.dq_unique(edge_ends, "edge", "edges"),
        Q.dq_unique(G.transaction_nodes(t.txns), "txnId", "transactions"),
        Q.dq_unique(t.stream, "nameOrig", "stream"),
    ])


@query
def dq_orphans(t: Tables) -> DataFrame:
    return Q.dq_orphans(t.profiles.select(F.col("customerId").alias("accountId")), t.txns)


@query
def dq_mule_floor(t: Tables) -> DataFrame:
    return Q.dq_mule_floor(t.payments)


@query
def dq_gated(t: Tables) -> DataFrame:
    """The checks of a job that writes lake, graph and reports, from its own writes."""
    def profile_checks(customers: Column) -> list[Q.Check]:
        return Q.profile_checks(
            expected_rows=customers, segments=MARKET_SEGMENTS, share=0.2, verified_share=0.92,
            avg_risk=0.495, avg_churn=0.495, avg_products=2.5, share_tolerance=0.02, tolerance=0.005,
        )

    return jobs.run_gated(t.spark, t.profiles, t.txns, work_path(t.spark, "gated"), profile_checks, lake_by=())
