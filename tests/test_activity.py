"""Shared, mergeable and stored activity; the incremental mart."""

import os
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tellerlake import jobs
from tellerlake import schemas as S
from tellerlake.operators import activity as A
from tellerlake.operators import blend, mart, reports, scoring
from tellerlake.plans.registry import QUERIES
from tellerlake.sources import testtables
from tellerlake.sources.readers import read_transactions
from tellerlake.sources.stored import ActivityStore, mart_target, read_mart, update_mart
from tellerlake.sources.writers import overwrite_parquet
from conftest import SF_DIR


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def records_read(spark, action):
    """Records that the stages of an action read from files."""
    store = spark.sparkContext._jsc.sc().statusStore()
    none = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
    statuses = spark.sparkContext._jvm.java.util.ArrayList()

    def total():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        stages = store.stageList(statuses, False, False, none, statuses)
        return {(s.stageId(), s.attemptId()): s.inputRecords() for s in map(stages.apply, range(stages.size()))}

    before = total()
    action()
    return sum(n for stage, n in total().items() if stage not in before)


@pytest.mark.parametrize("name, tables", [
    ("customer_risk_blend", ["orders", "customer"]), ("segment_rollup", ["orders", "customer"]),
    ("dormancy_report", ["orders"]), ("clv_scores", ["orders"]), ("customer_baseline", ["events"]),
    ("longest_dormant", ["orders"]),
])
def test_each_table_is_read_once(spark, name, tables):
    sizes = {t: spark.read.parquet(f"{SF_DIR}/{t}.parquet").count() for t in ("orders", "customer", "events")}
    n = records_read(spark, lambda: QUERIES[name](spark, SF_DIR).collect())
    # the test tables made of orders also count the customers, once for each use of the count
    assert n - sum(sizes[t] for t in tables) <= 2 * sizes["customer"] < sizes["orders"]


def test_types_are_bits(spark, txns):
    kinds = [*S.TXN_TYPES, "NEW", "NEW", None, *S.TXN_TYPES]
    activity = reports.customer_activity(txns(*[{"type": k} for k in kinds])).first()
    assert activity.distinct_types == len(S.TXN_TYPES) + 1 and activity.txn_count == len(kinds)


def test_rows_without_a_sender_are_no_customer(txns):
    activity = reports.customer_activity(txns({"nameOrig": None, "step": 9}, {"step": 2}))
    assert [(r.customerId, r.last_active_step) for r in activity.collect()] == [("C1", 2)]


@pytest.mark.parametrize("width", [1, 7, 168, 10_000])
def test_merged_slices_are_the_activity(spark, width):
    t = testtables.transactions(spark, SF_DIR)
    merged = A.merged_activity(A.activity_slices(t, width), A.counterparties(t, width))
    whole = reports.customer_activity(t)
    assert merged.columns == whole.columns and merged.dtypes == whole.dtypes
    assert rows(merged) == rows(whole)


def lake_of(spark, path, steps="step <= 40"):
    t = testtables.transactions(spark, SF_DIR).where(steps).select(S.TRANSACTION_SCHEMA.fieldNames())
    overwrite_parquet(t, path, ["step"])
    return t


def files(path):
    found = {}
    for folder, _, names in os.walk(path):
        found |= {os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns for n in names if n.endswith(".parquet")}
    return found


@contextmanager
def unreadable(paths):
    """Files whose content is gone while names, sizes and times stay."""
    kept = {path: (Path(path).read_bytes(), os.stat(path)) for path in paths}
    assert kept
    for path, (content, stat) in kept.items():
        Path(path).write_bytes(b"\0" * len(content))
        Path(path).with_name(f".{Path(path).name}.crc").unlink(missing_ok=True)
        os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    yield
    for path, (content, stat) in kept.items():
        Path(path).write_bytes(content)
        os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))


def test_mart_follows_the_lake_step_by_step(spark, tmp_path):
    lake, path = str(tmp_path / "lake"), str(tmp_path / "mart")
    lake_of(spark, lake)
    assert update_mart(spark, lake, path).count() > 10
    assert rows(read_mart(spark, path)) == rows(mart.txn_summary_mart(read_transactions(spark, lake)).select(read_mart(spark, path).columns))
    before = files(mart_target(path).data)

    assert update_mart(spark, lake, path).isEmpty()
    assert files(mart_target(path).data) == before

    step = read_transactions(spark, lake).agg(F.min("step")).first()[0]
    late = read_transactions(spark, lake).where(F.col("step") == step).withColumn("amount", F.col("amount") + 1)
    new = late.withColumn("step", F.lit(41))
    late.unionByName(new).coalesce(1).write.mode("append").partitionBy("step").parquet(lake)
    expected = rows(mart.txn_summary_mart(read_transactions(spark, lake)).select(read_mart(spark, path).columns))
    with unreadable(f for f in files(lake) if f"step={step}/" not in f and "step=41/" not in f):
        assert sorted(r.unit for r in update_mart(spark, lake, path).collect()) == [step, 41]
    after = files(mart_target(path).data)
    touched = {f for f in before.keys() | after.keys() if before.get(f) != after.get(f)}
    assert {f.split("step=")[1].split("/")[0] for f in touched} == {str(step), "41"}
    assert rows(read_mart(spark, path)) == expected


def test_steps_that_go_or_lose_their_rows_leave_the_mart(spark, tmp_path):
    lake, path = str(tmp_path / "lake"), str(tmp_path / "mart")
    lake_of(spark, lake, "step <= 12")
    update_mart(spark, lake, path)
    steps = {r.step for r in read_mart(spark, path).select("step").distinct().collect()}
    gone, emptied = sorted(steps)[:2]
    read_transactions(spark, lake).drop("step").limit(0).coalesce(1).write.mode("overwrite").parquet(f"{lake}/step={emptied}")
    for name in os.listdir(f"{lake}/step={gone}"):
        os.remove(f"{lake}/step={gone}/{name}")
    assert {r.unit for r in update_mart(spark, lake, path).collect()} == {gone, emptied}
    assert {r.step for r in read_mart(spark, path).select("step").distinct().collect()} == steps - {gone, emptied}


def test_a_failed_refresh_is_made_again(spark, tmp_path):
    lake, path = str(tmp_path / "lake"), str(tmp_path / "mart")
    lake_of(spark, lake, "step <= 5")
    from dataclasses import replace

    from tellerlake.sources.incremental import refresh

    def fails(txns):
        return mart.txn_summary_mart(txns).withColumn("last_balance", F.raise_error(F.lit("no")).cast("double"))

    with pytest.raises(Exception, match="no"):
        refresh(spark, lake, replace(mart_target(path), build=fails))
    assert not update_mart(spark, lake, path).isEmpty()
    assert read_mart(spark, path).count() == mart.txn_summary_mart(read_transactions(spark, lake)).count()


def test_no_lake_and_no_mart(spark, tmp_path):
    assert read_mart(spark, str(tmp_path / "m")).isEmpty()
    assert update_mart(spark, str(tmp_path / "lake"), str(tmp_path / "m")).isEmpty()
    assert read_mart(spark, str(tmp_path / "m")).columns[-1] == "step"


def test_reports_from_stored_activity(spark, tmp_path):
    lake = str(tmp_path / "lake")
    lake_of(spark, lake, "step <= 400")
    store = ActivityStore(spark, str(tmp_path / "store"), width=50)
    assert store.refresh(lake).count() == 8
    t, people = read_transactions(spark, lake), testtables.customers(spark, SF_DIR)

    def agree():
        a = store.activity()
        assert rows(a) == rows(reports.customer_activity(read_transactions(spark, lake)))
        assert rows(blend.blend_of(people, a)) == rows(blend.customer_risk_blend_from(people, t))
        assert rows(reports.dormancy_of(a)) == rows(reports.dormancy_report(t))
        assert rows(reports.fraud_summary_of(a)) == rows(reports.customer_fraud_summary(t))
        assert rows(scoring.clv_of(a)) == rows(scoring.clv_scores(t))
        assert rows(scoring.baseline_of(store.baseline_accounts())) == rows(scoring.customer_baseline(t))

    agree()
    with unreadable(files(lake)):
        read = records_read(spark, lambda: reports.dormancy_of(store.activity()).collect())
    assert read <= 3 * store.activity().count()  # once for the rows, once for each use of the last step
    t.where("step = 399").limit(1).withColumn("nameOrig", F.lit("C_new")).withColumn("step", F.lit(433)).write.mode("append").partitionBy("step").parquet(lake)
    assert [r.unit for r in store.refresh(lake).collect()] == [8]
    t = read_transactions(spark, lake)
    agree()
    last = store.merged(first=8)
    assert rows(last) == rows(reports.customer_activity(t.where("step > 400")))


def test_jobs_keep_mart_and_activity(spark, tmp_path):
    lake, out, people = str(tmp_path / "lake"), str(tmp_path / "out"), str(tmp_path / "people")
    lake_of(spark, lake)
    testtables.customers(spark, SF_DIR).write.json(people)
    jobs.run_mart(spark, lake, str(tmp_path / "mart"), "activity_db")
    assert jobs.run_summary(spark, out, "activity_db.txn_summary_mart") == "mart"
    expected = mart.transaction_summary(mart.txn_summary_mart(read_transactions(spark, lake)))
    assert rows(spark.read.parquet(f"{out}/transaction_summary")) == rows(expected)
    names = jobs.run_customers(spark, people, lake, str(tmp_path / "store"), out)
    assert names == ["customer_fraud_summary", "dormancy_report", "clv_scores"]
    assert rows(spark.read.parquet(f"{out}/clv_scores")) == rows(scoring.clv_scores(read_transactions(spark, lake)))
    assert spark.read.parquet(f"{out}/customer_risk").count() == testtables.customers(spark, SF_DIR).count()
