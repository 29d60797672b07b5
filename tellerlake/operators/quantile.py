"""Exact median without gathering the values in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A level tells apart at most this many buckets and one more, in powers of two.
LEVEL_BITS = 20


def _bucket(shift: int) -> Column:
    return F.shiftright("v", shift)


def _inside(values: DataFrame, lo: int, hi: int) -> DataFrame:
    return values.where(F.col("v").between(lo, hi))


def value_of_ranks(df: DataFrame, column: str, ranks: tuple[int, int], lo: int, hi: int) -> tuple[int, int]:
    """The values of two neighbouring ranks (from 1) among whole numbers from lo to hi.

    ``percentile`` keeps every distinct value of the group in one task's memory. Here the
    range is cut into at most 2^20 + 1 buckets, whose counts are small enough for one running
    total; the bucket of the ranks is the next range, until a bucket is one value. 64 bits take
    four such passes, and a range below a million takes one. The range of a pass is a literal
    and reaches the scan. Where the two ranks are in different buckets, the lower one is the
    largest of its bucket and the upper one the smallest, which one last pass finds.
    """
    values = df.select(F.col(column).cast("bigint").alias("v"))
    low, high = ranks
    while lo < hi:
        shift = max(0, (hi - lo).bit_length() - LEVEL_BITS)
        counts = _inside(values, lo, hi).groupBy(_bucket(shift).alias("b")).agg(F.count(F.lit(1)).alias("n"))
        upto = counts.withColumn("upto", F.sum("n").over(Window.orderBy("b")))
        place = F.struct("b", (F.col("upto") - F.col("n")).alias("before"))
        first, second = upto.agg(*[F.min(F.when(F.col("upto") >= r, place)) for r in (low, high)]).head()
        if first["b"] != second["b"]:
            of_first, of_second = _bucket(shift) == first["b"], _bucket(shift) == second["b"]
            ends = F.max(F.when(of_first, F.col("v"))), F.min(F.when(of_second, F.col("v")))
            return tuple(_inside(values, lo, hi).where(of_first | of_second).agg(*ends).head())
        low, high = low - first["before"], high - first["before"]
        lo, hi = max(lo, first["b"] << shift), min(hi, ((first["b"] + 1) << shift) - 1)
    return lo, lo


def exact_median(df: DataFrame, column: str) -> Column:
    """Median of a whole-number column as a constant; the mean of the middle two if even.

    It is found when this is called; null where there is no value.
    """
    v = F.col(column).cast("bigint")
    n, lo, hi = df.agg(F.count(v), F.min(v), F.max(v)).head()
    if not n:
        return F.lit(None).cast("double")
    low, high = value_of_ranks(df, column, ((n + 1) // 2, n // 2 + 1), lo, hi)
    return F.lit((low + high) / 2)
