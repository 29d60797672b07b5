"""Jobs on a temporary lake, outputs read back."""

import pytest
from pyspark.sql import functions as F

from tellerlake import jobs
from tellerlake import schemas as S
from tellerlake.operators import reports
from tellerlake.operators.kpis import flag_transactions
from tellerlake.sources import testtables
from tellerlake.sources.readers import message_files, read_report, read_transactions
from tellerlake.sources.testtables import customers, transactions
from tellerlake.sources.writers import overwrite_parquet
from tellerlake.streaming.churn import build_alerts, churn_windows
from tellerlake.streaming.lake import replay_messages
from conftest import SF_DIR


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("jobs") / "lake")
    rows = transactions(spark, SF_DIR).where("step <= 40").select(S.TRANSACTION_SCHEMA.fieldNames())
    overwrite_parquet(rows, path, ["step"])
    return path


@pytest.mark.parametrize("mode", [*jobs.MODES, "all"])
def test_each_mode_writes_its_reports(spark, lake, tmp_path, mode):
    out = str(tmp_path)
    names = jobs.run(spark, mode, lake, out)
    assert names and (mode != "all" or len(names) == 6)
    for name in names:
        stored = spark.read.parquet(f"{out}/{name}")
        csv = f"{out}/{name}.csv" if name in jobs.SMALL else f"{out}/{name}_csv"
        assert stored.count() == read_report(spark, csv, stored.schema).count()
        assert name == "dormancy_report" or stored.count()


def test_a_named_database_gets_tables(spark, lake, tmp_path):
    jobs.run(spark, "compliance", lake, str(tmp_path), database="jobs_db")
    expected = reports.compliance_summary(read_transactions(spark, lake))
    assert sorted(spark.table("jobs_db.compliance_summary").collect()) == sorted(expected.collect())


def test_blend_job(spark, lake, tmp_path):
    people = str(tmp_path / "people")
    customers(spark, SF_DIR).write.json(people)
    jobs.run_blend(spark, people, lake, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "customer_risk")).count() == customers(spark, SF_DIR).count()
    assert (tmp_path / "out" / "segment_rollup.csv").is_file()


def test_summary_takes_the_mart_or_else_the_daily_summary(spark, lake, tmp_path):
    out, daily = str(tmp_path / "out"), str(tmp_path / "daily")
    overwrite_parquet(reports.daily_summary(read_transactions(spark, lake)), daily)
    assert jobs.run_summary(spark, out, "nowhere.mart", daily) == "daily"
    with pytest.raises(ValueError):
        jobs.run_summary(spark, out, "nowhere.mart")


def test_missing_history_and_feed_are_empty(spark, lake, tmp_path):
    gone = str(tmp_path / "gone")
    assert jobs.history_baseline(spark, gone).isEmpty()
    assert jobs.history_baseline(spark, gone).columns == jobs.history_baseline(spark, lake).columns
    assert jobs.stored_feed(spark, gone, "step int").isEmpty()


def test_stream_jobs_on_message_files(spark, lake, tmp_path):
    history = testtables.stream_transactions(spark, SF_DIR).select(S.TRANSACTION_SCHEMA.fieldNames())
    end = history.agg(F.max("step")).first()[0]
    last = history.limit(1).withColumn("type", F.lit("PAYMENT")).withColumn("step", F.lit(end + 500)).withColumn("nameOrig", F.lit("C_END"))
    feed, past = str(tmp_path / "messages"), str(tmp_path / "past")
    replay_messages(history.unionByName(last).orderBy("step")).coalesce(1).write.text(feed)
    overwrite_parquet(history.coalesce(1), past, ["step"])
    out, bases = str(tmp_path / "out"), str(tmp_path / "bases")

    fraud = jobs.stream_fraud(spark, message_files(spark, feed), out, str(tmp_path / "ck1"), once=True)
    fraud.awaitTermination(120)
    expected = flag_transactions(history)
    assert spark.read.parquet(f"{out}/flagged").count() == expected.count() == spark.read.json(f"{out}/alerts").count()
    assert spark.read.parquet(f"{out}/metrics").agg(F.sum("flaggedCount")).first()[0] == expected.count()

    churning = jobs.stream_churn(spark, message_files(spark, feed), past, bases, out, str(tmp_path / "ck2"), once=True)
    churning.awaitTermination(120)
    assert fraud.exception() is None and churning.exception() is None
    alerts = build_alerts(churn_windows(history), jobs.history_baseline(spark, past))
    assert spark.read.parquet(f"{out}/churn").count() == alerts.count()
    assert jobs.refresh_baseline(spark, past, bases) == 1
