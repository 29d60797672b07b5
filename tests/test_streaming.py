"""Streams give what batch gives, survive restarts and retries, and drop late rows."""

import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tellerlake import schemas as S
from tellerlake.operators import kpis
from tellerlake.operators.scoring import customer_baseline
from tellerlake.sources.readers import decode_transactions, message_files, read_transactions
from tellerlake.sources.testtables import messages, stream_transactions
from tellerlake.streaming import churn, fraud, keyed
from tellerlake.streaming.lake import land_stream, replay, replay_messages
from tellerlake.streaming.sinks import Sinks, batch_messages, batch_parquet
from conftest import SF_DIR

FIELDS = S.TRANSACTION_SCHEMA.fieldNames()


@pytest.fixture
def history(spark):
    return stream_transactions(spark, SF_DIR).select(FIELDS)


@pytest.fixture
def replayed(history, tmp_path):
    path = str(tmp_path / "in")
    replay(history, path, 6)
    return path


def stream_of(spark, path, files_per_trigger=1):
    reader = spark.readStream.schema(S.TRANSACTION_SCHEMA)
    return reader.option("maxFilesPerTrigger", files_per_trigger).json(path)


def drain(query):
    query.awaitTermination(180)
    assert not query.isActive and query.exception() is None
    return query


def same(a, b, columns):
    a, b = a.select(columns), b.select(columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_fraud_stream_equals_batch_and_a_restart_adds_nothing(spark, replayed, history, tmp_path):
    rows, alerts, metrics = (str(tmp_path / n) for n in ("rows", "alerts", "metrics"))
    sinks = Sinks(batch_parquet(rows), batch_messages(alerts), batch_parquet(metrics))
    checkpoint = str(tmp_path / "ck")
    start = lambda: fraud.start_fraud(stream_of(spark, replayed), sinks, checkpoint, once=True)
    drain(start())
    flagged = spark.read.parquet(rows)
    expected = kpis.flag_transactions(history)
    stable = [c for c in expected.columns if c in FIELDS or c == "fraudReason"]
    assert flagged.count() == expected.count() > 0 and same(flagged, expected, stable)
    assert flagged.where("flaggedAt IS NULL OR detectionLatencyMs IS NULL").isEmpty()

    metric = spark.read.parquet(metrics)
    assert metric.count() == 6
    total = metric.agg(F.sum("totalCount"), F.sum("flaggedCount")).first()
    assert total[:] == (history.count(), expected.count())
    sent = spark.read.json(alerts)
    assert sent.count() == expected.count() and json.loads(sent.first().value)["fraudReason"]

    drain(start())
    assert spark.read.parquet(rows).count() == expected.count()
    assert spark.read.parquet(metrics).count() == 6


def test_a_retried_batch_replaces_itself(spark, history, tmp_path):
    rows, metrics = str(tmp_path / "rows"), str(tmp_path / "metrics")
    sinks = Sinks(rows=batch_parquet(rows), metrics=batch_parquet(metrics))
    for _ in range(2):
        fraud.process_batch(history, 3, sinks)
    assert spark.read.parquet(rows).count() == kpis.flag_transactions(history).count()
    assert [r.batchId for r in spark.read.parquet(metrics).collect()] == [3]
    fraud.process_batch(history.limit(0), 4, sinks)
    assert spark.read.parquet(metrics).count() == 1


WINDOWS = [churn.churn_windows, keyed.churn_windows_by_customer]


@pytest.mark.parametrize("windows_of", WINDOWS)
def test_churn_stream_equals_batch_over_many_batches(spark, history, tmp_path, windows_of):
    end = history.agg(F.max("step")).first()[0]
    # A sentinel far in the future moves the watermark past every real window.
    sentinel = history.limit(1).withColumn("step", F.lit(end + 500)).withColumn("nameOrig", F.lit("C_END"))
    source = str(tmp_path / "in")
    replay(history.unionByName(sentinel), source, 6)
    baseline = churn.stored_baseline(customer_baseline(history), str(tmp_path / "baseline"))
    rows, alerts, checkpoint = (str(tmp_path / n) for n in ("rows", "alerts", "ck"))
    sinks = Sinks(rows=batch_parquet(rows), alerts=batch_messages(alerts))
    start = lambda: churn.start_churn(
        stream_of(spark, source), baseline, sinks, checkpoint, once=True, windows_of=windows_of
    )
    query = drain(start())
    assert len([p for p in query.recentProgress if p["numInputRows"]]) >= 6
    customers = history.select("nameOrig").distinct().count()
    kept = max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress)
    assert kept <= customers + 1 if windows_of is WINDOWS[1] else kept > 10 * customers, kept

    expected = churn.build_alerts(churn.churn_windows(history), baseline)
    expected = expected.withColumn("signals", F.concat_ws("|", "signals"))
    got = spark.read.parquet(rows)
    assert got.count() == 325 and same(got, expected, expected.columns)
    assert "detectedAt" in got.columns and spark.read.json(alerts).count() == 325

    drain(start())
    assert spark.read.parquet(rows).count() == 325


def test_a_running_stream_takes_the_newest_baseline(spark, txns, tmp_path):
    """Two windows of one kind, finished in different batches, before and after a new version."""
    versions = churn.Baselines(spark, str(tmp_path / "baselines"), keep=2)
    assert versions.newest().isEmpty() and versions.newest().columns == ["customerId", "baselineAvgAmount", "baselineFreqPer12"]
    base = customer_baseline(txns({"nameOrig": "C1"}))
    versions.publish(base.select("customerId", F.lit(1.0).alias("baselineAvgAmount"), F.lit(0.0).alias("baselineFreqPer12")))
    source = tmp_path / "in"
    source.mkdir()

    def feed(number, *rows):
        (source / f"{number}.json").write_text("\n".join(txns(*rows).toJSON().collect()))

    rows = str(tmp_path / "rows")
    start = lambda: churn.start_churn(
        stream_of(spark, str(source)), versions, Sinks(rows=batch_parquet(rows)), str(tmp_path / "ck"), once=True)
    # draining balances and no purchases fire in every window; the mean only against a high baseline
    out = {"nameOrig": "C1", "type": "CASH_OUT", "newbalanceOrig": 1.0, "amount": 10.0}
    feed(0, *[{**out, "step": 10}] * 3, {"step": 100, "nameOrig": "C2"})
    drain(start())
    first = spark.read.parquet(rows)
    assert first.count() == 24 and first.where("signals LIKE '%SPEND%'").isEmpty()
    assert versions.publish(versions.newest().withColumn("baselineAvgAmount", F.lit(1000.0))) == 1
    feed(1, *[{**out, "step": 200}] * 3, {"step": 300, "nameOrig": "C2"})
    drain(start())
    later = spark.read.parquet(rows).where(F.col("windowStart") > first.agg(F.max("windowStart")).first()[0])
    assert later.where("signals LIKE '%SPEND%' AND baselineAvgAmount = 1000").count() == 24
    for _ in range(3):
        versions.publish(base)
    assert versions.versions() == [3, 4]


def test_a_baseline_can_change_while_the_stream_runs(spark, txns, tmp_path):
    versions = churn.Baselines(spark, str(tmp_path / "baselines"))
    used = []
    sinks = Sinks(rows=lambda df, n: used.append({r[0] for r in df.select("baselineAvgAmount").distinct().collect()}))
    source = tmp_path / "in"
    source.mkdir()

    def feed(number, step):
        out = {"nameOrig": "C1", "type": "CASH_OUT", "newbalanceOrig": 1.0, "amount": 10.0, "step": step}
        staged = tmp_path / f"{number}.json"
        staged.write_text("\n".join(txns(out, out, out, {"step": step + 90, "nameOrig": "C2"}).toJSON().collect()))
        staged.rename(source / staged.name)

    def publish(mean):
        versions.publish(spark.createDataFrame([("C1", mean, 0.0)], churn.BASELINE_SCHEMA))

    publish(1.0)
    feed(0, 10)
    query = churn.start_churn(stream_of(spark, str(source)), versions, sinks, str(tmp_path / "ck"), trigger="0 seconds")
    try:
        query.processAllAvailable()
        publish(2.0)
        feed(1, 200)
        query.processAllAvailable()
    finally:
        query.stop()
    assert used == [{1.0}, {2.0}]


def test_batch_windows_equal_plain_sliding_windows(history):
    fast = churn.churn_windows(history)
    plain = (
        churn.with_event_time(history)
        .groupBy(F.window("eventTime", "24 hours", "1 hours"), "customerId")
        .agg(F.count("*").alias("txnCount"), F.sort_array(F.collect_set("type")).alias("txnTypes"))
        .select("customerId", F.col("window.start").alias("windowStart"), "txnCount", "txnTypes")
    )
    assert same(fast, plain, plain.columns)


def run_steps(spark, txns, tmp_path, batches, windows_of=churn.churn_windows):
    """Feed one file per list of rows and return the finished windows of customer C1."""
    source = tmp_path / "in"
    source.mkdir()
    for i, rows in enumerate(batches):
        data = txns(*rows).toJSON().collect()
        (source / f"{i}.json").write_text("\n".join(data))
        os.utime(source / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    out = str(tmp_path / "out")
    query = (
        windows_of(stream_of(spark, str(source))).writeStream.format("parquet")
        .outputMode("append").option("path", out).option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True).start()
    )
    drain(query)
    windows = spark.read.parquet(out).where("customerId = 'C1'")
    return {r.e: r.txnCount for r in windows.select(
        ((F.unix_seconds("windowEnd") - S.STEP_EPOCH_SECONDS) / 3600).cast("int").alias("e"), "txnCount"
    ).collect()}


@pytest.mark.parametrize("windows_of", WINDOWS)
def test_watermark_keeps_late_rows_for_open_windows_only(spark, txns, tmp_path, windows_of):
    got = run_steps(spark, txns, tmp_path, [
        [{"step": 100}],
        [{"step": 99}],                      # one hour late: within the two hours
        [{"step": 130}],                     # moves the watermark to step 128
        [{"step": 130, "nameOrig": "C2"}],   # rows are filtered one batch after that
        [{"step": 101}, {"step": 126}],      # windows up to 128 are closed for both
        [{"step": 900, "nameOrig": "C_END"}],
    ], windows_of)
    assert got[100] == 1 and got[101] == 2 and got[123] == 2 and got[124] == 1
    assert got.get(125) is None              # only the dropped row at 101 was in it
    assert 128 not in got and got[129] == 1  # the row at 126 still counts in open windows
    assert got[131] == 2 and got[150] == 2 and got[151] == 1


def test_keyed_windows_shuffle_each_event_once(spark, txns, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "0.json").write_text("\n".join(txns({"step": 5}, {"step": 5}, {"step": 40, "nameOrig": "C2"}).toJSON().collect()))
    query = keyed.churn_windows_by_customer(stream_of(spark, str(source))).writeStream.format("noop").trigger(
        availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start()
    drain(query)
    plan = query._jsq.explainInternal(False) if hasattr(query._jsq, "explainInternal") else ""
    assert "Expand" not in plan and "Generate" not in plan
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) == 2


def test_amounts_and_types_of_panes():
    panes = {}
    events = pd.DataFrame({"hour": [3, 3, 4, 4], "cents": [100, None, 7, 8], "low": [1, 0, 0, 1], "type": ["B", None, "A", "B"]})
    keyed.add_events(panes, events)
    assert panes == {3: [2, 100, 1, 1, ["B"]], 4: [2, 15, 2, 1, ["A", "B"]]}
    ends = dict(keyed.ended_windows(panes, None, 27))
    assert ends == {4: [2, 100, 1, 1, ["B"]], **{e: [4, 115, 3, 2, ["A", "B"]] for e in range(5, 28)}}
    assert [e for e, _ in keyed.ended_windows(panes, 26, 100)] == [27, 28]
    assert keyed.next_end(panes, 0) == 4 and keyed.next_end(panes, 10) == 11


def test_signals(txns):
    one_visit = {"nameOrig": "C1", "step": 10, "newbalanceOrig": 9000.0}
    drained = [{"nameOrig": "C2", "step": 10, "type": "CASH_OUT", "newbalanceOrig": b} for b in (0.0, 499.99)]
    edge = [{"nameOrig": "C3", "step": 10, "type": "CASH_OUT", "newbalanceOrig": b} for b in (0.0, 500.0)]
    mixed = [{"nameOrig": "C4", "step": 10, "type": t} for t in ("CASH_OUT", "TRANSFER", "DEBIT")]
    events = txns(one_visit, *drained, *edge, *mixed)
    spark = events.sparkSession
    baseline = spark.createDataFrame(
        [("C1", 10_000.0, 3.1), ("C3", 100.0, 0.1), ("C4", 100.0, 9.0)],
        "customerId string, baselineAvgAmount double, baselineFreqPer12 double",
    )
    found = churn.churn_signals(churn.churn_windows(events), baseline)
    got = {r.customerId: r.signals for r in found.where(
        F.col("windowEnd") == F.timestamp_seconds(F.lit(S.STEP_EPOCH_SECONDS + 11 * 3600))).collect()}
    assert got == {
        "C1": ["FREQUENCY_COLLAPSE", "SPEND_COLLAPSE"],
        "C2": ["CASH_OUT_LIQUIDATION", "BALANCE_DRAIN"],      # no baseline: only S3 and S4
        "C3": ["CASH_OUT_LIQUIDATION"],                       # a balance of 500 is not low
        "C4": [],
    }
    alerts = churn.build_alerts(churn.churn_windows(events), baseline, as_of=F.current_timestamp())
    assert {r.customerId for r in alerts.collect()} == {"C1", "C2"}
    assert alerts.columns == S.ALERT_COLUMNS


def test_lake_landing_and_restart(spark, history, tmp_path):
    inbox, lake, checkpoint = (str(tmp_path / n) for n in ("inbox", "lake", "ck"))
    messages(spark, SF_DIR).select("value").write.text(inbox)
    start = lambda: land_stream(
        decode_transactions(message_files(spark, inbox)), lake, checkpoint, once=True
    )
    drain(start())
    landed = read_transactions(spark, lake)
    assert same(landed, history, FIELDS)
    assert sum(p.name.startswith("step=") for p in (tmp_path / "lake").iterdir()) > 100

    replay_messages(history.limit(5)).write.mode("append").text(inbox)
    drain(start())
    assert read_transactions(spark, lake).count() == history.count() + 5


def test_two_jobs_on_one_source_do_not_share_state(spark, replayed, history, tmp_path):
    rows, lake = str(tmp_path / "rows"), str(tmp_path / "lake")
    stream = stream_of(spark, replayed, 3)
    first = fraud.start_fraud(
        stream, Sinks(rows=batch_parquet(rows)), str(tmp_path / "ck1"), once=True, name="fraud"
    )
    second = land_stream(stream, lake, str(tmp_path / "ck2"), once=True, name="landing")
    drain(first), drain(second)
    assert spark.read.parquet(rows).count() == kpis.flag_transactions(history).count()
    assert read_transactions(spark, lake).count() == history.count()


def test_replay_is_read_in_step_order(spark, replayed, tmp_path):
    seen = []
    query = (
        stream_of(spark, replayed).writeStream
        .foreachBatch(lambda df, n: seen.append(df.agg(F.min("step"), F.max("step")).first()[:]))
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    )
    drain(query)
    assert len(seen) == 6 and all(a[1] < b[0] for a, b in zip(seen, seen[1:]))


def test_message_files_as_a_bounded_read(spark, tmp_path):
    replay_messages(stream_transactions(spark, SF_DIR).select(FIELDS)).write.text(str(tmp_path / "m"))
    assert decode_transactions(message_files(spark, str(tmp_path / "m"), stream=False)).count() == 1000
