"""Sliding churn windows on a stream with one state row per customer.

Spark's own sliding window copies every event into its 24 windows before the shuffle, and
keeps a state row for each customer and open window. Here the events are shuffled once, by
customer, and the state of a customer is its hourly sums of the last day; a window is the sum
of 24 of them and comes into being when the watermark passes its end. No built-in aggregation
can do that: one over hours closes an hour long before its last window, and a late event would
be lost for all of them.

The watermark is kept on the end of the last window that an event is in. It trails by the
allowed delay and a day, so it stands where a watermark on the event time would stand, while
Spark drops only events all of whose windows are over. An event counts in those of its windows
that end after the watermark with which its batch began.

The state of a customer is bounded by the hours of a day and of the delay, whatever the number
of events; the events of one customer are taken in by one task, a bounded Arrow batch at a time.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tellerlake import schemas as S
from tellerlake.functions.exact import CENTS, cents
from tellerlake.functions.rules import event_time

HOURS = S.CHURN_WINDOW_STEPS
HOUR_MS = 3_600_000
DELAY_HOURS = int(S.CHURN_WATERMARK.split()[0])

OUTPUT = (
    "customerId string, windowStart timestamp, windowEnd timestamp, txnCount long, windowAvgAmount double, "
    "txnTypes array<string>, lowBalanceEvents long, hasCashOut boolean, hasPayment boolean, hasDebit boolean"
)
_STATE = "panes string, closed long"

Pane = list  # events, cents, events with an amount, events with a low balance, types


def add_events(panes: dict[int, Pane], events: pd.DataFrame) -> None:
    """Add a batch of events to the hourly sums, grouped by hour and type first."""
    groups = events.groupby(["hour", "type"], dropna=False).agg(
        n=("low", "size"), cents=("cents", "sum"), amounts=("cents", "count"), low=("low", "sum")
    )
    for (hour, kind), row in zip(groups.index, groups.itertuples(index=False)):
        pane = panes.setdefault(int(hour), [0, 0, 0, 0, []])
        for k, value in enumerate((row.n, row.cents, row.amounts, row.low)):
            pane[k] += int(value)
        if isinstance(kind, str) and kind not in pane[4]:
            pane[4].append(kind)


def ended_windows(panes: dict[int, Pane], after: int | None, until: int) -> Iterator[tuple[int, Pane]]:
    """End and sums of the windows that end after one hour and up to another."""
    ends = {end for hour in panes for end in range(hour + 1, hour + HOURS + 1) if end <= until}
    for end in sorted(e for e in ends if after is None or e > after):
        inside = [panes[h] for h in range(end - HOURS, end) if h in panes]
        total = [sum(p[k] for p in inside) for k in range(4)]
        yield end, [*total, sorted({kind for p in inside for kind in p[4]})]


def next_end(panes: dict[int, Pane], after: int) -> int:
    """The first end of a window after an hour."""
    return min(max(hour, after) for hour in panes) + 1


def _advance(key: tuple[str], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    stored, closed = state.get if state.exists else ("{}", None)
    panes = {int(hour): pane for hour, pane in json.loads(stored).items()}
    watermark = state.getCurrentWatermarkMs()
    now = watermark // HOUR_MS
    ended = list(ended_windows(panes, closed, now))
    panes = {hour: pane for hour, pane in panes.items() if hour + HOURS > now}
    if not state.hasTimedOut:
        for events in batches:
            add_events(panes, events[events["hour"] + HOURS > now])
    if panes:
        state.update((json.dumps(panes), int(now)))
        state.setTimeoutTimestamp(max(next_end(panes, now) * HOUR_MS - 1, watermark + 1))
    else:
        state.remove()
    if ended:
        yield pd.DataFrame({
            "customerId": key[0],
            "windowStart": pd.to_datetime([(end - HOURS) * HOUR_MS for end, _ in ended], unit="ms", utc=True),
            "windowEnd": pd.to_datetime([end * HOUR_MS for end, _ in ended], unit="ms", utc=True),
            "txnCount": [p[0] for _, p in ended],
            "windowAvgAmount": [float(p[1]) / CENTS / p[0] if p[2] else None for _, p in ended],
            "txnTypes": [p[4] for _, p in ended],
            "lowBalanceEvents": [p[3] for _, p in ended],
            "hasCashOut": ["CASH_OUT" in p[4] for _, p in ended],
            "hasPayment": ["PAYMENT" in p[4] for _, p in ended],
            "hasDebit": ["DEBIT" in p[4] for _, p in ended],
        })


def churn_windows_by_customer(stream: DataFrame, delay_hours: int = DELAY_HOURS) -> DataFrame:
    """What ``churn.churn_windows`` gives for a stream, each window once, when it is over."""
    hour = F.floor(F.unix_seconds(event_time()) / 3600)
    low = F.coalesce((F.col("newbalanceOrig") < S.LOW_BALANCE).cast("long"), F.lit(0))
    events = stream.where(F.col("nameOrig").isNotNull()).select(
        F.col("nameOrig").alias("customerId"),
        F.timestamp_seconds((hour + HOURS) * 3600).alias("lastEnd"),
        hour.cast("long").alias("hour"), cents("amount").alias("cents"), low.alias("low"), "type",
    )
    timed = events.withWatermark("lastEnd", f"{delay_hours + HOURS} hours")
    return timed.groupBy("customerId").applyInPandasWithState(
        _advance, OUTPUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
