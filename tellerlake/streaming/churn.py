"""Churn signals over sliding event-time windows, in batch and streaming."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tellerlake import schemas as S
from tellerlake.functions.exact import CENTS, cents, whole_sum
from tellerlake.functions.rules import event_time
from tellerlake.operators.blend import select_present
from tellerlake.streaming.sinks import Sinks, kept

WINDOW = f"{S.CHURN_WINDOW_STEPS} hours"
SLIDE = "1 hours"
BASELINE_SCHEMA = "customerId string, baselineAvgAmount double, baselineFreqPer12 double"


def with_event_time(txns: DataFrame, watermark: str = S.CHURN_WATERMARK) -> DataFrame:
    events = txns.withColumn("eventTime", event_time()).withColumnRenamed("nameOrig", "customerId")
    return events.withWatermark("eventTime", watermark) if txns.isStreaming else events


def _seen(kind: str) -> Column:
    return F.bool_or(F.col("type") == kind)


def _measures(n: Column, amount_cents: Column, low: Column) -> list[Column]:
    return [
        F.sum(n).alias("txnCount"),
        (whole_sum(amount_cents).cast("double") / CENTS).alias("amount"),
        F.sum(low).alias("lowBalanceEvents"),
        _seen("CASH_OUT").alias("hasCashOut"),
        _seen("PAYMENT").alias("hasPayment"),
        _seen("DEBIT").alias("hasDebit"),
        F.sort_array(F.collect_set("type")).alias("txnTypes"),
    ]


def _windows(measured: DataFrame, start: Column, end: Column) -> DataFrame:
    return measured.select(
        "customerId", start.alias("windowStart"), end.alias("windowEnd"), "txnCount",
        (F.col("amount") / F.col("txnCount")).alias("windowAvgAmount"),
        "txnTypes", "lowBalanceEvents", "hasCashOut", "hasPayment", "hasDebit",
    )


def churn_windows(txns: DataFrame) -> DataFrame:
    """Activity of each customer in every 24-hour window that slides by one hour.

    Each event is in 24 windows. A stream has to expand the events themselves, because
    a late event still belongs to those of its windows that are open. A bounded table
    has no late events, so there the events are first added up per customer, hour and
    type and laid out by customer; the 24-fold expansion then happens after the last
    shuffle instead of before it. (``window`` would bring the shuffle back, because it
    hides how its input is partitioned.) A customer with a large share of all events is
    reduced to at most five rows per hour before it is placed in one partition. The
    number of partitions is given, because adaptive execution would merge them by
    their size before the expansion.
    """
    partitions = int(txns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    low = F.coalesce((F.col("newbalanceOrig") < S.LOW_BALANCE).cast("bigint"), F.lit(0))
    events = with_event_time(txns)
    if txns.isStreaming:
        sliding = F.window("eventTime", WINDOW, SLIDE)
        measured = events.groupBy(sliding, "customerId").agg(
            *_measures(F.lit(1).cast("bigint"), cents("amount"), low)
        )
        return _windows(measured, F.col("window.start"), F.col("window.end"))
    hourly = (
        events.groupBy("customerId", "step", "type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            whole_sum(cents("amount")).cast("bigint").alias("cents"),
            F.sum(low).alias("low"),
        )
        .repartition(partitions, "customerId")
    )
    # A window is named by its last step: an event is in the windows ending at its own
    # step and at each of the 23 steps after it.
    later = F.explode(F.sequence(F.lit(0), F.lit(S.CHURN_WINDOW_STEPS - 1)))
    measured = (
        hourly.select("*", later.alias("later"))
        .withColumn("lastStep", F.col("step") + F.col("later"))
        .groupBy("customerId", "lastStep")
        .agg(*_measures(F.col("n"), F.col("cents"), F.col("low")))
    )
    after_last = F.col("lastStep").cast("bigint") + 1
    return _windows(
        measured,
        event_time(after_last - S.CHURN_WINDOW_STEPS),
        event_time(after_last),
    )


def churn_signals(windows: DataFrame, baseline: DataFrame) -> DataFrame:
    """Windows with the list of signals that fire; a missing baseline fires nothing.

    FREQUENCY_COLLAPSE needs a transaction in the window, so a customer who falls
    completely silent never triggers it. CASH_OUT_LIQUIDATION tolerates TRANSFER and
    CASH_IN next to the CASH_OUT; only PAYMENT and DEBIT rule it out.

    The baseline side is not forced to be broadcast: it has a row per customer, and
    whether that fits is decided from its size.
    """
    per_12 = F.col("txnCount") / (S.CHURN_WINDOW_STEPS / S.CHURN_RATE_STEPS)
    liquidating = F.col("hasCashOut") & ~F.col("hasPayment") & ~F.col("hasDebit")
    spend_floor = F.col("baselineAvgAmount") * S.SPEND_COLLAPSE_RATIO
    fired = {
        "FREQUENCY_COLLAPSE": (per_12 < S.FREQUENCY_FLOOR)
        & (F.col("baselineFreqPer12") > S.FREQUENCY_BASELINE),
        "SPEND_COLLAPSE": F.col("windowAvgAmount") < spend_floor,
        "CASH_OUT_LIQUIDATION": liquidating,
        "BALANCE_DRAIN": F.col("lowBalanceEvents") >= S.LOW_BALANCE_EVENTS,
    }
    names = F.array(*[F.when(condition, name) for name, condition in fired.items()])
    return (
        windows.join(baseline, "customerId", "left")
        .withColumn("signals", F.array_compact(names))
        .withColumn("signalCount", F.size("signals"))
        .withColumn("cashOutOnly", F.coalesce(liquidating, F.lit(False)))
    )


def build_alerts(
    windows: DataFrame,
    baseline: DataFrame,
    min_signals: int = S.MIN_SIGNALS,
    as_of: Column | None = None,
) -> DataFrame:
    """Windows where at least ``min_signals`` signals fire together."""
    alerts = churn_signals(windows, baseline).where(F.col("signalCount") >= min_signals)
    if as_of is not None:
        alerts = alerts.withColumn("detectedAt", as_of)
    return select_present(alerts, S.ALERT_COLUMNS)


def churn_signal_counts(windows: DataFrame, baseline: DataFrame) -> DataFrame:
    """How many windows fired each signal."""
    signals = churn_signals(windows, baseline).select(F.explode("signals").alias("signal"))
    return signals.groupBy("signal").agg(F.count(F.lit(1)).alias("windows"))


def process_batch(batch: DataFrame, batch_id: int, sinks: Sinks) -> None:
    """Alerts as messages, and as rows with their signals in one string."""
    with kept(batch) as alerts:
        if alerts.isEmpty():
            return
        if sinks.alerts:
            sinks.alerts(alerts, batch_id)
        if sinks.rows:
            sinks.rows(alerts.withColumn("signals", F.concat_ws("|", "signals")), batch_id)


def start_churn(
    stream: DataFrame,
    baseline: DataFrame | Baselines,
    sinks: Sinks,
    checkpoint: str,
    trigger: str = "10 seconds",
    once: bool = False,
    name: str | None = None,
    windows_of: Callable[[DataFrame], DataFrame] = churn_windows,
) -> StreamingQuery:
    """Start the job; ``windows_of`` may be ``keyed.churn_windows_by_customer``.

    A baseline given as a frame is fixed at start, so pass a stored table of it. With
    ``Baselines`` every batch takes the version that is newest when it begins: the finished
    windows are joined with it inside the batch.
    """
    windows = windows_of(stream)
    now = F.current_timestamp()
    if isinstance(baseline, Baselines):
        result = windows

        def write(df: DataFrame, n: int) -> None:
            with kept(df) as finished:
                if not finished.isEmpty():
                    process_batch(build_alerts(finished, baseline.newest(), as_of=now), n, sinks)
    else:
        result = build_alerts(windows, baseline, as_of=now)

        def write(df: DataFrame, n: int) -> None:
            process_batch(df, n, sinks)

    when = {"availableNow": True} if once else {"processingTime": trigger}
    writer = result.writeStream.outputMode("append").foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint).trigger(**when)
    return (writer.queryName(name) if name else writer).start()


@dataclass(frozen=True)
class Baselines:
    """Versions of the baseline under a path, ``version=<n>/``; the newest complete one counts.

    A version is complete when Spark has marked it, after its last file. Versions are never
    changed, so a batch that reads one is not disturbed by the next; older ones than the last
    ``keep`` go when another is published.
    """

    spark: SparkSession
    path: str
    keep: int = 3

    def _filesystem(self):
        context = self.spark.sparkContext
        hadoop_path = context._jvm.org.apache.hadoop.fs.Path
        return hadoop_path(self.path).getFileSystem(context._jsc.hadoopConfiguration()), hadoop_path

    def versions(self) -> list[int]:
        fs, hadoop_path = self._filesystem()
        folder = hadoop_path(self.path)
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        numbers = [int(n.split("=")[1]) for n in names if n.startswith("version=")]
        return sorted(n for n in numbers if fs.exists(hadoop_path(f"{self.path}/version={n}/_SUCCESS")))

    def publish(self, baseline: DataFrame) -> int:
        """Store another version; its number."""
        versions = self.versions()
        number = versions[-1] + 1 if versions else 0
        baseline.write.mode("overwrite").parquet(f"{self.path}/version={number}")
        fs, hadoop_path = self._filesystem()
        for old in versions[: max(0, len(versions) + 1 - self.keep)]:
            fs.delete(hadoop_path(f"{self.path}/version={old}"), True)
        return number

    def newest(self) -> DataFrame:
        """The newest version; without any, a baseline of no customer, which fires nothing."""
        versions = self.versions()
        if not versions:
            return self.spark.createDataFrame([], BASELINE_SCHEMA)
        return self.spark.read.schema(BASELINE_SCHEMA).parquet(f"{self.path}/version={versions[-1]}")


def stored_baseline(baseline: DataFrame, path: str) -> DataFrame:
    """Write the baseline and read it back.

    The stream then joins a plain table, whose known size lets Spark broadcast it while
    it is small, instead of re-aggregating the whole history in every micro-batch.
    """
    baseline.write.mode("overwrite").parquet(path)
    return baseline.sparkSession.read.schema(baseline.schema).parquet(path)
