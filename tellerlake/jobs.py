"""Runnable jobs: lake in, reports out; messages in, flagged rows and alerts out.

Each job reads its inputs, writes its reports as Parquet, adds one CSV file of each
where the report is small by nature, and registers tables where a database is named.
``run(spark, mode, lake, out)`` starts one by name, ``all`` every report of the lake.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tellerlake import schemas as S
from tellerlake.functions import rules
from tellerlake.functions.exact import money_sum
from tellerlake.operators import blend, graph, mart, reports, scoring
from tellerlake.operators import quality as Q
from tellerlake.operators.kpis import flag_transactions
from tellerlake.sources.catalog import register_table
from tellerlake.sources.readers import decode_transactions, read_customers, read_transactions
from tellerlake.sources.stored import ActivityStore, update_mart
from tellerlake.sources.writers import overwrite_parquet, write_blend, write_csv, write_single_csv
from tellerlake.streaming.churn import Baselines, start_churn
from tellerlake.streaming.fraud import start_fraud
from tellerlake.streaming.sinks import Sinks, batch_messages, batch_parquet

Report = Callable[[DataFrame], DataFrame]

#: Reports of each mode. Customer-level ones grow with the bank, so their CSV is a directory.
MODES: dict[str, dict[str, Report]] = {
    "compliance": {"compliance_summary": reports.compliance_summary},
    "customer": {"customer_fraud_summary": reports.customer_fraud_summary},
    "dormancy": {"dormancy_report": reports.dormancy_report},
    "risk": {"risk_scores": scoring.risk_scores, "daily_summary": reports.daily_summary},
    "clv": {"clv_scores": scoring.clv_scores},
}
SMALL = {"compliance_summary", "daily_summary"}


def write_report(report: DataFrame, out: str, name: str, database: str | None = None) -> None:
    """Parquet, then CSV from the stored rows, then the table."""
    path = f"{out}/{name}"
    overwrite_parquet(report, path)
    if name in SMALL:
        write_single_csv(report, f"{path}.csv")
    else:
        write_csv(report.sparkSession.read.schema(report.schema).parquet(path), f"{path}_csv")
    if database:
        register_table(report.sparkSession, database, name, path)


def run(spark: SparkSession, mode: str, lake: str, out: str, database: str | None = None) -> list[str]:
    """Run the reports of a mode, or of all, and return their names."""
    chosen = {n: r for m in MODES for n, r in MODES[m].items()} if mode == "all" else MODES[mode]
    txns = read_transactions(spark, lake)
    for name, report in chosen.items():
        write_report(report(txns), out, name, database)
    return list(chosen)


def run_blend(spark: SparkSession, customers: str, lake: str, out: str) -> None:
    """Customer 360 and its segment rollup."""
    detail = blend.customer_risk_blend_from(read_customers(spark, customers), read_transactions(spark, lake))
    write_blend(detail, blend.segment_rollup(detail), out)


def run_mart(spark: SparkSession, lake: str, path: str, database: str) -> None:
    """Bring the mart up to date with the lake and point its table at it."""
    update_mart(spark, lake, path, database)


#: Reports that stored activity is enough for.
STORED: dict[str, Report] = {
    "customer_fraud_summary": reports.fraud_summary_of,
    "dormancy_report": reports.dormancy_of,
    "clv_scores": scoring.clv_of,
}


def run_customers(
    spark: SparkSession, customers: str, lake: str, store: str, out: str, database: str | None = None
) -> list[str]:
    """All customer reports and the blend from stored activity.

    The lake is read where it changed since the last run; the reports read the stored tables.
    """
    kept = ActivityStore(spark, store)
    kept.refresh(lake)
    for name, report in STORED.items():
        write_report(report(kept.activity()), out, name, database)
    detail = blend.blend_of(read_customers(spark, customers), kept.activity())
    write_blend(detail, blend.segment_rollup(detail), out)
    return list(STORED)


def run_summary(spark: SparkSession, out: str, mart_table: str | None = None, daily: str | None = None) -> str:
    """The transaction summary from the mart, or from the daily summary where there is no mart.

    Returns which of the two it was.
    """
    if mart_table and spark.catalog.tableExists(mart_table):
        summary, source = mart.transaction_summary(spark.table(mart_table)), "mart"
    elif daily:
        summary, source = mart.transaction_summary_from_daily(spark.read.parquet(daily)), "daily"
    else:
        raise ValueError("neither a mart table nor a daily summary was given")
    overwrite_parquet(summary, f"{out}/transaction_summary")
    write_single_csv(summary, f"{out}/transaction_summary.csv")
    return source


def run_gated(
    spark: SparkSession, profiles: DataFrame, txns: DataFrame, out: str,
    profile_checks: Callable[[Column], Sequence[Q.Check]], key: str = "txnId",
    lake_by: Sequence[str] = ("step",),
) -> DataFrame:
    """Write the lake, the graph and the reports, and judge all of them by what was written.

    Every check is measured by the write of its dataset, and what it is compared with by the
    write of another one. No dataset is read again for a check. ``profile_checks`` gets the
    number of customers that the blend has.
    """
    def store(df: DataFrame, name: str, checks: Sequence[Q.Check], partition_by: Sequence[str] = ()) -> Q.Measured:
        return Q.measured_write(df, name, checks, lambda d: overwrite_parquet(d, f"{out}/{name}", partition_by))

    def totals(**named: Column) -> list[Q.Check]:
        return [Q.equals(label, c, 0) for label, c in named.items()]

    rows = Q.row_count()
    daily = store(reports.daily_summary(txns, ordered=False), "daily_summary", totals(
        rows=F.sum("txn_volume"), fraud=F.sum("fraud_count"), last=F.max("step"), volume=money_sum("total_amount"),
        rate=F.try_divide(100.0 * F.sum("fraud_count"), F.sum("txn_volume")),
    ))
    accounts = store(graph.account_nodes(txns), "accounts", totals(rows=rows))
    edges = store(graph.graph_edges(txns, key), "edges", totals(rows=rows))
    degrees = store(graph.account_degrees(spark.read.parquet(f"{out}/edges")), "degrees", totals(rows=rows))
    mules = store(graph.mule_accounts(graph.payments(txns, key)), "mules", totals(rows=rows))
    recent = F.when(F.col("step") > daily.value("last") - S.REPORT_WINDOW_STEPS, F.col("amount"))
    control = Q.transaction_checks(
        accounts.value("rows"), daily.value("rows"), degrees.value("rows"), daily.value("fraud"),
        daily.value("volume"), daily.value("rate"), daily.value("last"),
    )
    lake = store(txns.select(S.TRANSACTION_SCHEMA.fieldNames()), "transactions", control + totals(
        recent_volume=money_sum(recent), recent_fraud=F.sum(F.when(recent.isNotNull(), F.col("isFraud"))),
        early_fraud=F.sum(F.when(rules.step_between(), F.col("isFraud"))),
    ), lake_by)
    severe = F.col("dormancy_severity") == "Severely Dormant"
    detail = blend.customer_risk_blend_from(profiles, txns, ordered=False)
    whole = store(detail, "blend", [
        *Q.blend_checks(F.lit(None)), *totals(rows=rows, dormant=F.count_if("is_dormant"), severe=F.count_if(severe)),
    ])
    people = store(profiles, "customers", profile_checks(whole.value("rows")))
    suites = [
        Q.Measured("transactions", control, lake.values),
        store(graph.transaction_nodes(txns, key), "graph", Q.graph_checks(
            accounts.value("rows"), edges.value("rows"), mules.value("rows"), degrees.value("rows"), daily.value("rows"),
        )),
        people,
        store(reports.dormancy_report(txns, ordered=False), "dormancy", Q.dormancy_checks(whole.value("dormant"), whole.value("severe"))),
        store(reports.compliance_summary(txns, ordered=False), "compliance", Q.compliance_checks(
            lake.value("recent_volume"), lake.value("recent_fraud"))),
        store(flag_transactions(txns), "flagged", Q.flagged_checks()),
        Q.Measured("blend", Q.blend_checks(people.value("customer documents")), whole.values),
        store(mart.transaction_summary(mart.txn_summary_mart(txns), ordered=False), "summary",
              Q.summary_checks(lake.value("early_fraud"))),
    ]
    return Q.verdicts(spark, suites)


def _stored(spark: SparkSession, path: str, schema) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def stream_fraud(
    spark: SparkSession, messages: DataFrame, out: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """The fraud job on decoded messages: flagged rows, alert messages and batch metrics."""
    sinks = Sinks(
        rows=batch_parquet(f"{out}/flagged"), alerts=batch_messages(f"{out}/alerts"), metrics=batch_parquet(f"{out}/metrics")
    )
    return start_fraud(decode_transactions(messages), sinks, checkpoint, once=once, name="fraud")


def stream_churn(
    spark: SparkSession, messages: DataFrame, lake: str, baselines: str, out: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """The churn job on decoded messages, against the baseline of the lake.

    A baseline is published at the start if there is none; ``refresh_baseline`` publishes
    later ones, which the running stream takes up.
    """
    versions = Baselines(spark, baselines)
    if not versions.versions():
        refresh_baseline(spark, lake, baselines)
    sinks = Sinks(rows=batch_parquet(f"{out}/churn"), alerts=batch_messages(f"{out}/churn_alerts"))
    return start_churn(decode_transactions(messages), versions, sinks, checkpoint, once=once, name="churn")


def refresh_baseline(spark: SparkSession, lake: str, baselines: str) -> int:
    return Baselines(spark, baselines).publish(history_baseline(spark, lake))


def history_baseline(spark: SparkSession, lake: str) -> DataFrame:
    """Baseline of the stored history; empty, with the same columns, before there is any."""
    txns = _stored(spark, lake, S.TRANSACTION_SCHEMA)
    if txns is None:
        txns = spark.createDataFrame([], S.TRANSACTION_SCHEMA)
    return scoring.customer_baseline(txns)


def stored_feed(spark: SparkSession, path: str, schema) -> DataFrame:
    """Flagged rows for the live feed; no rows where nothing has been written yet."""
    rows = _stored(spark, path, schema)
    return spark.createDataFrame([], schema) if rows is None else rows

