import random
import statistics

import pytest
from pyspark.sql import functions as F

from tellerlake.operators import quantile
from tellerlake.operators.kpis import latency_sla
from tellerlake.operators.quantile import exact_median


def median_of(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    return spark.range(1).select(exact_median(df, "v")).first()[0]


@pytest.mark.parametrize("values", [
    [5], [5, 8], [3, 3, 3, 9], [-7, -2, 0], [0, 1 << 20, (1 << 20) + 1, 1 << 40],
    [(1 << 20) - 1, 1 << 20],
])
def test_small_medians(spark, values):
    assert median_of(spark, values) == statistics.median(values)


@pytest.mark.parametrize("n", [1001, 1000])
def test_random_median_over_many_buckets(spark, n):
    rng = random.Random(n)
    values = [rng.randint(-(10**12), 10**12) for _ in range(n - 300)] + [7] * 300
    assert median_of(spark, values) == statistics.median(values)


@pytest.mark.parametrize("n", [301, 300])
def test_values_across_all_bits(spark, n):
    rng = random.Random(n)
    values = [rng.randint(-(1 << 63), (1 << 63) - 1) >> rng.choice([0, 0, 5, 30, 62]) for _ in range(n)]
    assert median_of(spark, values) == statistics.median(values)
    assert median_of(spark, [-(1 << 63), (1 << 63) - 1]) == -0.5
    crowd = [(1 << 62) + k for k in (0, 0, 1, 5)] + [-(1 << 62)] * 2 + [1 << 61] * 2
    assert median_of(spark, crowd) == statistics.median(crowd)


def test_no_running_total_over_more_than_one_level(spark, monkeypatch):
    passes = []
    inside = quantile._inside
    monkeypatch.setattr(quantile, "_inside", lambda values, lo, hi: passes.append((lo, hi)) or inside(values, lo, hi))
    df = spark.range(0, 3_000_001).select(F.col("id").alias("v"))
    assert spark.range(1).select(exact_median(df, "v")).first()[0] == 1_500_000
    assert len(passes) == 2 and passes[1][1] - passes[1][0] == 3
    passes.clear()
    exact_median(df.where("v < 5000"), "v")
    assert passes == [(0, 4999), (0, 4999)]  # neighbours in two buckets are read off in one more pass


def test_nulls_do_not_count(spark):
    assert median_of(spark, [1, None, 3, None]) == 2.0
    assert median_of(spark, [None]) is None


def test_sla_edge(spark):
    def verdict(*ms):
        df = spark.createDataFrame([(m,) for m in ms], "detectionLatencyMs bigint")
        return latency_sla(df).first()

    assert verdict(1999, 2001).within_sla is True
    assert verdict(2000, 2001).within_sla is False
    empty = spark.createDataFrame([], "detectionLatencyMs bigint")
    assert latency_sla(empty).first()[:] == (0, None, None)
