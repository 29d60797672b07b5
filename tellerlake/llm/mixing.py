"""Mixing sources to target weights.

Words are summed by source, every source gets a target, and its repetition rate is the
target over the words it has. A document is emitted floor(rate) times, plus once more if a
coin hashed from the seed and its id falls below the fraction.

Targets fill up like connected vessels: all sources rise together in proportion to their
weights, and one that has reached its cap stays there. The level is found from sources
sorted by cap over weight, one row for each source, with running sums; sums are whole
numbers, so the level does not depend on row order.

Defined results: a null text has size 0; a null source is a source of its own, last in
order; sources without words get target 0 and rate 0; the coin of a null id is that of the
empty text, so reruns agree; rows that repeat an id share its coin; an empty table gives an
empty mix; columns that share a name with a derived one are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellerlake.llm.shared import carried, quoted, word_count, written

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: The mix has this share of all words, and a source at most this multiple of its own.
SHARE_PERCENT, MAX_RATE = 150, 2
SEED = 20
#: The coin is the first 13 hex digits of an MD5 sum: 52 bits, exact in a double.
_DIGITS, _UNITS = 13, float(1 << 52)

DERIVED = ["size", "source_size", "target", "rate", "copies"]


def coin(doc_id: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on the seed and the id alone."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, _DIGITS), 16, 10).cast("double") / _UNITS


def targets(sizes: DataFrame, weights=WEIGHTS, share_percent=SHARE_PERCENT, max_rate=MAX_RATE) -> DataFrame:
    """One row for each source: its words, target and repetition rate.

    `sizes` has source and size. The windows run over the finished sums, a row for each
    source, never over documents.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    k = (F.row_number().over(order) - 1) % len(weights)
    weight = F.get(F.array(*[F.lit(int(w)) for w in weights]), k).cast("long")
    table = by_source.select("source", "source_size", weight.alias("weight")).withColumn(
        "cap", F.col("source_size") * (100 * max_rate)  # in hundredths of a word
    )
    rising = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = rising.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    table = table.select(
        "*",
        (F.sum("source_size").over(everything) * share_percent - F.coalesce(F.sum("cap").over(upto), F.lit(0))).alias("left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0))).alias("open"),
    )
    # the first source whose cap is above the level of what is left sets the level
    fills = F.col("cap") * F.col("open") <= F.col("weight") * F.col("left")
    level = F.first(F.when(~fills, F.struct("left", "open")), ignorenulls=True).over(
        rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    table = table.withColumns({"fills": fills, "level": level})
    target = F.when(F.col("fills"), F.col("cap") / F.lit(100.0)).otherwise(
        (F.col("weight") * F.col("level.left")).cast("double") / (F.lit(100.0) * F.col("level.open"))
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return table.withColumn("target", target).withColumn("rate", rate).select(
        "source", "source_size", "target", "rate"
    )


def planned(docs: DataFrame, seed: int = SEED, **mix) -> DataFrame:
    """Every document with its size, its source's target and how often the mix takes it.

    The table of sources is written first, so its size is known when the join is planned:
    broadcast below the session's threshold, else sorted, where adaptive execution splits
    a hot source.
    """
    keep = carried(docs, DERIVED)
    rows = docs.select(
        F.struct(*[F.col(quoted(c)) for c in keep]).alias("row"),
        F.col("source").alias("__source"), F.col("doc_id").alias("__id"),
        word_count(F.col("text")).alias("size"),
    )
    sizes = docs.select("source", word_count(F.col("text")).alias("size"))
    table = written(targets(sizes, **mix), "mix-targets")
    whole = F.floor("rate")
    copies = whole + (coin(F.col("__id"), seed) < F.col("rate") - whole).cast("long")
    return (
        rows.join(table, rows["__source"].eqNullSafe(table["source"]))
        .select(
            F.col("row"), "size", "source_size", "target", "rate", copies.alias("copies")
        )
        .select("row.*", *DERIVED)
    )


def mixed(docs: DataFrame, seed: int = SEED, **mix) -> DataFrame:
    """The mix itself: every row of `docs` as often as it is taken, columns as they came."""
    plan = planned(docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"), "source", "doc_id", "text"), seed, **mix)
    return (
        plan.where("copies > 0")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
        .select("row.*")
    )


_TARGETS_SQL = f"""
docs AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM {{docs}}),
by_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY 1),
weighed AS (
  SELECT *, source_size * {100 * MAX_RATE} AS cap,
    [{", ".join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight
  FROM by_source),
rising AS (
  SELECT *, sum(source_size) OVER () * {SHARE_PERCENT} - coalesce(sum(cap) OVER up, 0) AS rest,
    sum(weight) OVER () - coalesce(sum(weight) OVER up, 0) AS wide,
    row_number() OVER (ORDER BY cap::DOUBLE / weight, source ASC NULLS LAST) AS k
  FROM weighed
  WINDOW up AS (ORDER BY cap::DOUBLE / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT rest AS l_rest, wide AS l_wide FROM rising WHERE cap * wide > weight * rest ORDER BY k LIMIT 1),
targets AS (
  SELECT source, source_size,
    CASE WHEN cap * wide <= weight * rest THEN cap / 100.0::DOUBLE
         ELSE (weight * l_rest)::DOUBLE / (100.0::DOUBLE * l_wide) END AS target
  FROM rising LEFT JOIN level ON true),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM targets),
planned AS (
  SELECT doc_id, size, source_size, target, rate,
    (floor(rate) + (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, {_DIGITS}))::BIGINT::DOUBLE / {_UNITS}::DOUBLE
      < rate - floor(rate))::BIGINT)::BIGINT AS copies
  FROM docs JOIN rates ON docs.source IS NOT DISTINCT FROM rates.source)
"""

ORACLE = f"WITH {_TARGETS_SQL.format(docs='documents')} SELECT doc_id, size, source_size, target, size * copies AS taken FROM planned"
