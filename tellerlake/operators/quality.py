"""Data-quality gates.

A suite of checks on one dataset is a single aggregation whose one result row is
unfolded into one row per check, so adding checks does not add passes over the data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tellerlake import schemas as S
from tellerlake.functions import rules
from tellerlake.functions.exact import money_sum, percent, score_mean
from tellerlake.operators.graph import mule_accounts
from tellerlake.operators.reports import distinct_accounts

RESULT_DDL = "dataset STRING, check STRING, actual DOUBLE, expected DOUBLE, status STRING"


def row_count() -> Column:
    return F.count(F.lit(1))


@dataclass(frozen=True)
class Check:
    """An aggregate and what it has to be.

    ``expected`` is a number or a scalar column (for reconciling two datasets).
    ``at_least`` makes it a floor; otherwise it must be met within ``tolerance``.
    """

    label: str
    actual: Column
    expected: float | Column
    tolerance: float = 0.0
    at_least: bool = False


def equals(label: str, actual: Column, expected: float | Column, tolerance: float = 0.0) -> Check:
    return Check(label, actual, expected, tolerance)


def at_least(label: str, actual: Column, floor: float) -> Check:
    return Check(label, actual, floor, at_least=True)


def every_row(label: str, condition: Column) -> Check:
    """Holds on all rows. A null condition counts as a violation."""
    return Check(label, F.bool_and(F.coalesce(condition, F.lit(False))).cast("int"), 1)


def _verdict(actual: Column, expected: Column, check: Check) -> Column:
    met = actual >= expected if check.at_least else F.abs(actual - expected) <= check.tolerance
    return F.when(actual.isNull() | expected.isNull(), "SKIP").when(met, "PASS").otherwise("FAIL")


def expectations(df: DataFrame, dataset: str, checks: Sequence[Check]) -> DataFrame:
    """One row (dataset, check, actual, expected, status) per check.

    A check whose value cannot be computed, as on an empty dataset, is SKIP.
    """
    return _unfolded(df.agg(*_measures(checks)), dataset, checks)


def _measures(checks: Sequence[Check]) -> list[Column]:
    return [c.actual.cast("double").alias(f"m{i}") for i, c in enumerate(checks)]


def _unfolded(measured: DataFrame, dataset: str, checks: Sequence[Check]) -> DataFrame:
    """The one row of measures as one row per check."""
    wanted = [c.expected if isinstance(c.expected, Column) else F.lit(c.expected) for c in checks]
    # Columns of their own, so that a scalar subquery occurs once and not per use.
    measured = measured.select("*", *[w.cast("double").alias(f"e{i}") for i, w in enumerate(wanted)])
    rows = []
    for i, c in enumerate(checks):
        actual, expected = F.col(f"m{i}"), F.col(f"e{i}")
        rows.append(
            F.struct(
                F.lit(dataset).alias("dataset"), F.lit(c.label).alias("check"),
                actual.alias("actual"), expected.alias("expected"),
                _verdict(actual, expected, c).alias("status"),
            )
        )
    return measured.select(F.inline(F.array(*rows)))


@dataclass(frozen=True)
class Measured:
    """Checks of a dataset and the values they had while it was written."""

    dataset: str
    checks: Sequence[Check]
    values: dict[str, float | None]

    def value(self, label: str) -> Column:
        """A measured value, to be what another dataset's check expects."""
        names = [c.label for c in self.checks]
        return F.lit(self.values[f"m{names.index(label)}"]).cast("double")


def measured_write(
    df: DataFrame, dataset: str, checks: Sequence[Check], write: Callable[[DataFrame], None]
) -> Measured:
    """Write ``df`` and measure its checks on the rows that pass, without another pass.

    The measures are taken in the tasks that write, each of which counts once even if it has
    to be repeated. They are aggregates without DISTINCT, as observed metrics have to be.
    """
    observation = Observation(dataset)
    write(df.observe(observation, *_measures(checks)))
    return Measured(dataset, list(checks), dict(observation.get))


def verdicts(spark: SparkSession, writes: Sequence[Measured]) -> DataFrame:
    """One row per check of all writes, as ``expectations`` gives them; reads no dataset."""
    suites = []
    for m in writes:
        schema = ", ".join(f"m{i} double" for i in range(len(m.checks)))
        row = tuple(m.values.get(f"m{i}") for i in range(len(m.checks)))
        suites.append(_unfolded(spark.createDataFrame([row], schema), m.dataset, m.checks))
    return all_results(suites)


def skipped(spark: SparkSession, dataset: str, checks: Sequence[Check]) -> DataFrame:
    """The rows of a suite whose dataset is missing."""
    rows = [(dataset, c.label, None, None, "SKIP") for c in checks]
    return spark.createDataFrame(rows, RESULT_DDL)


def all_results(suites: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, suites)


def gate(results: DataFrame) -> DataFrame:
    """Totals by status and the overall verdict, one row."""
    totals = results.agg(
        *[F.count_if(F.col("status") == s).alias(n) for s, n in
          [("PASS", "passed"), ("FAIL", "failed"), ("SKIP", "skipped")]]
    )
    return totals.withColumn("ok", F.col("failed") == 0)


# --- suites -----------------------------------------------------------------------

def transaction_checks(
    accounts: Column,
    expected_rows: float | Column,
    expected_accounts: float | Column,
    expected_fraud: float | Column,
    expected_volume: float | Column,
    expected_rate: float | Column,
    expected_step: float | Column,
    volume_tolerance: float = 0.01,
    rate_tolerance: float = 0.05,
) -> list[Check]:
    """Size, volume and fraud against control totals."""
    fraud = F.sum("isFraud")
    return [
        equals("transaction count", row_count(), expected_rows),
        equals("distinct accounts", accounts, expected_accounts),
        equals("confirmed fraud", fraud, expected_fraud),
        equals("total volume", money_sum("amount"), expected_volume, volume_tolerance),
        equals("fraud rate pct", percent(fraud, row_count()), expected_rate, rate_tolerance),
        equals("max step", F.max("step"), expected_step),
    ]


def graph_checks(
    accounts: Column, edges: Column, mules: Column,
    expected_accounts: float | Column, expected_rows: float | Column,
) -> list[Check]:
    """On transaction nodes: node and edge counts, and enough mule accounts."""
    return [
        equals("account nodes", accounts, expected_accounts),
        equals("transaction nodes", row_count(), expected_rows),
        equals("relationship edges", edges, expected_rows * 2),
        at_least("mule accounts", mules, S.MULE_FLOOR),
    ]


def flagged_checks() -> list[Check]:
    """The streaming rule, checked on its output."""
    return [
        every_row("flagged types", F.col("type").isin(S.FRAUD_TYPES)),
        every_row("flagged amounts", F.col("amount") > S.FRAUD_AMOUNT),
        every_row("flagged balances", F.col("newbalanceDest") == 0),
    ]


def profile_checks(
    expected_rows: float | Column, segments: Sequence[str], share: float, verified_share: float,
    avg_risk: float, avg_churn: float, avg_products: float,
    share_tolerance: float, tolerance: float,
) -> list[Check]:
    checks = [
        equals("customer documents", row_count(), expected_rows),
        equals("distinct segments", F.size(F.collect_set("segment")), len(segments)),
        equals(
            "verified share",
            F.try_divide(F.count_if(F.col("kyc_status") == "verified"), row_count()),
            verified_share, tolerance,
        ),
        equals("avg risk score", score_mean("risk_score"), avg_risk, tolerance),
        equals("avg churn probability", score_mean("churn_probability"), avg_churn, tolerance),
        equals("avg products held", F.try_divide(F.sum(F.size("products")), row_count()), avg_products, tolerance),
    ]
    for s in segments:
        part = F.try_divide(F.count_if(F.col("segment") == s), row_count())
        checks.append(equals(f"segment share: {s}", part, share, share_tolerance))
    return checks


def dormancy_checks(dormant: float | Column, severe: float | Column) -> list[Check]:
    return [
        equals("dormant accounts", row_count(), dormant),
        equals("severely dormant", F.count_if(F.col("steps_inactive") > S.SEVERE_AFTER_STEPS), severe),
        at_least("min transaction history", F.min("txn_count"), S.DORMANCY_MIN_TXNS),
        every_row("customer accounts only", rules.is_customer("customerId")),
    ]


def compliance_checks(volume: float | Column, fraud: float | Column, tolerance: float = 1.0) -> list[Check]:
    return [
        equals("transaction types covered", row_count(), len(S.TXN_TYPES)),
        equals("compliance volume", money_sum("total_volume"), volume, tolerance),
        equals("compliance fraud", F.sum("fraud_count"), fraud),
    ]


def composite_gap() -> Column:
    """Largest distance of the stored composite score from its formula."""
    return F.max(F.abs(F.col("composite_risk_score") - rules.composite_risk()))


def blend_checks(expected_rows: float | Column) -> list[Check]:
    return [
        equals("blend row count", row_count(), expected_rows),
        equals("composite formula", composite_gap(), 0, 1e-6),
    ]


def summary_checks(fraud: float | Column, fraud_tolerance: float = 0.0,
                   lo: int = 1, hi: int = S.REPORT_WINDOW_STEPS) -> list[Check]:
    return [
        every_row("steps in range", rules.step_between(lo, hi)),
        equals("summary fraud", F.sum("fraud_count"), fraud, fraud_tolerance),
    ]


# --- single gates -----------------------------------------------------------------

def dq_segment_mix(profiles: DataFrame, expected: DataFrame) -> DataFrame:
    """Observed against expected customers per segment (``segment, expected``).

    Unexpected segments and segments without customers are both mismatches.
    """
    observed = profiles.groupBy("segment").agg(
        row_count().alias("customers"),
        score_mean("risk_score").alias("avg_risk"),
        score_mean("churn_probability").alias("avg_churn"),
    )
    return observed.join(expected, "segment", "full").select(
        "segment",
        F.coalesce("customers", F.lit(0)).alias("customers"),
        "expected", "avg_risk", "avg_churn",
        F.col("customers").eqNullSafe(F.col("expected")).alias("matches"),
    )


def dq_unique(df: DataFrame, key: str, dataset: str) -> DataFrame:
    """Rows, distinct keys, and keys that occur more than once, one row."""
    per_key = df.groupBy(F.col(key).alias("key")).agg(row_count().alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count("key").alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicated_keys"),
        F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
    ).select(F.lit(dataset).alias("dataset"), F.lit(key).alias("key"), "*")


def dq_orphans(accounts: DataFrame, txns: DataFrame) -> DataFrame:
    """Accounts of the pool that take part in no transaction."""
    return accounts.select("accountId").join(distinct_accounts(txns), "accountId", "left_anti")


def dq_mule_floor(
    paths: DataFrame, floor: int = S.MULE_FLOOR, min_senders: int = S.MULE_MIN_SENDERS
) -> DataFrame:
    """The graph has to contain at least ``floor`` mule accounts."""
    checks = [at_least("mule accounts", row_count(), floor)]
    return expectations(mule_accounts(paths, min_senders), "graph", checks)
