"""Exact top-k search by inner product, pruned with segment means and deviations.

Components are rotated first, onto the axes along which a bounded sample of rows varies
most, largest first; a rotation changes no inner product. A rotated vector is cut into
segments. By Cauchy and Schwarz,

    q . x  <=  sum over segments of  len * mean(q) * mean(x) + len * dev(q) * dev(x),

so a few statistics bound a score from above (for vectors of known length this is the
lower bound of their distance), and the products of the means alone are its estimate.

1. Statistics of 16 segments travel, not vectors: the 8 leading components alone, then the
   rest in 8 equal parts. Every pair of a query block and a row
   block names its k likeliest rows for each query. The k likeliest of all are scored
   exactly, and the lowest of these scores is the query's floor.
2. The same statistics, from 1 segment over 4 to 16, give up every pair whose bound is below
   the floor. Only rows that are left for some query of a block are sent to it as vectors.
3. There 32 equal segments are tried, then the exact sum over the leading half of the components
   with 16 segments for the rest; the survivors get exact scores in whole numbers. Each block
   returns its own best k for each query; the best of these are the result.

Blocks are bounded in bytes, and there are at least as many as tasks can run at a time, if
rows suffice. `survivors` reports how many pairs each level leaves. Evenly spread vectors of
few components leave most pairs to step 3: no bound by statistics tells them apart.

Components are turned into floor(1024 * x), x as double. Defined results: vectors that are
null, or hold a null or non-finite component, take no part, neither do rows without id; an
empty vector scores 0; of vectors of different length the shorter counts as filled up with
zeros; ties go to the smaller id; a row is no candidate of its own id, so of rows that
repeat a query's id none is, and the largest of their vectors asks; repeated rows of another
id can each take a rank; scores beyond 64 bits stay at the limit; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tellerlake.llm.shared import written

K = 10
SCALE = 1024
#: Bytes of the vectors of a block, as doubles, and rows that make another block worth while.
#: They bound memory, not results.
ROW_BYTES, QUERY_BYTES, SMALLEST = 16 << 20, 4 << 20, 256
#: Segments of the statistics that travel, coarse to fine, and of those beside the vectors.
LEVELS, FINE = (1, 4, 16), 32
#: The rotation is fitted on this many rows, up to this width; wider vectors are only sorted.
FIT_ROWS, FIT_WIDTH = 2048, 512
#: Likely rows that are scored for a floor, in multiples of k.
LIKELY = 5
#: Queries whose bounds are held at a time.
_STRIP = 16
_LIMIT = (1 << 63) - 1


def _matrix(vectors, width: int) -> np.ndarray:
    """Vectors as rows of whole numbers in doubles, filled up with zeros."""
    out = np.zeros((len(vectors), width))
    for k, v in enumerate(vectors):
        out[k, :len(v)] = v
    return np.floor(out * SCALE)


def fitted_axes(sample: np.ndarray) -> np.ndarray:
    """Axes as columns, that of the largest mean square first."""
    scale = np.abs(sample).max(initial=0.0)
    sample = sample / scale if scale > 0 else sample
    width = sample.shape[1]
    if width <= FIT_WIDTH and len(sample):
        return np.linalg.eigh(sample.T @ sample)[1][:, ::-1]
    return np.argsort(-(sample ** 2).sum(axis=0), kind="stable")


def rotated(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """`x` along the axes, filled up to a multiple of the finest segments."""
    y = x @ axes if axes.ndim == 2 else x[:, axes]
    return np.pad(y, ((0, 0), (0, -y.shape[1] % (2 * FINE))))


def equal(width: int, segments: int) -> np.ndarray:
    return np.full(segments, width // segments)


def leading(width: int) -> np.ndarray:
    """Lengths of the segments that travel: one component each, then the rest in equal parts."""
    alone = LEVELS[-1] // 2
    return np.concatenate([np.ones(alone, dtype=int), equal(width - alone, LEVELS[-1] - alone)])


def statistics(y: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the segments, both times the root of the length."""
    starts = np.cumsum(lengths) - lengths
    means = np.add.reduceat(y, starts, axis=1) / np.sqrt(lengths)
    squares = np.add.reduceat(y * y, starts, axis=1)
    return means, np.sqrt(np.maximum(squares - means ** 2, 0.0))


def coarser(means: np.ndarray, devs: np.ndarray, lengths: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The same statistics of fewer, longer segments."""
    starts = np.arange(0, len(lengths), len(lengths) // segments)
    sums = np.add.reduceat(means * np.sqrt(lengths), starts, axis=1) / np.sqrt(np.add.reduceat(lengths, starts))
    squares = np.add.reduceat(means ** 2 + devs ** 2, starts, axis=1)
    return sums, np.sqrt(np.maximum(squares - sums ** 2, 0.0))


def _slack(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """More than a bound of each query can lose by rounding, from statistics of all pairs."""
    return 1e-7 * (1 + np.sqrt((q ** 2).sum(axis=1)) * np.sqrt((x ** 2).sum(axis=1).max(initial=0.0)))


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whole-number inner products of one query with some rows."""
    top = np.abs(q).max(initial=0.0) * np.abs(x).max(initial=0.0) * max(len(q), 1)
    if top < 2.0 ** 53:
        return (x @ q).astype(np.int64)
    whole = [[int(v) for v in row] for row in x]
    sums = [sum(a * b for a, b in zip(row, map(int, q))) for row in whole]
    return np.array([min(max(s, -_LIMIT - 1), _LIMIT) for s in sums], dtype=np.int64)


def _floor(score: float) -> float:
    """A score as a floor; at the lower limit scores are not told apart, so nothing is below."""
    return float(score) if score > -_LIMIT else -np.inf


def _halves(packed) -> tuple[np.ndarray, np.ndarray]:
    both = np.stack(list(packed))
    return both[:, :LEVELS[-1]], both[:, LEVELS[-1]:]


def likeliest(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> Iterator[tuple]:
    """(query ids, row keys, estimates) of the k rows with the largest products of means."""
    (qm, _), (xm, _) = _halves(queries["s"]), _halves(rows["s"])
    ids, keys = rows["id"].to_numpy(), rows["key"].to_numpy()
    for one, query in enumerate(queries["id"].to_numpy()):
        estimate = np.where(ids == query, -np.inf, xm @ qm[one])
        best = np.argpartition(-estimate, k - 1)[:k] if len(estimate) > k else np.arange(len(estimate))
        best = best[estimate[best] > -np.inf]
        yield np.full(len(best), query), keys[best], estimate[best]


@np.errstate(over="ignore", invalid="ignore")  # what overflows is kept
def left_by_statistics(queries: pd.DataFrame, rows: pd.DataFrame, lengths: np.ndarray, counts=None) -> np.ndarray:
    """Keys of the rows that some query's floor does not rule out; pairs by level are counted."""
    (qm, qd), (xm, xd) = _halves(queries["s"]), _halves(rows["s"])
    slack = _slack(np.hstack([qm, qd]), np.hstack([xm, xd]))
    ids, floors = rows["id"].to_numpy(), queries["floor"].to_numpy(dtype=float, na_value=-np.inf)
    levels = [(coarser(qm, qd, lengths, n), coarser(xm, xd, lengths, n)) for n in LEVELS]
    wanted = np.zeros(len(rows), dtype=bool)
    for one, query in enumerate(queries["id"].to_numpy()):
        left = np.flatnonzero(ids != query)
        for level, ((am, ad), (bm, bd)) in enumerate(levels):
            left = left[~(bm[left] @ am[one] + bd[left] @ ad[one] + slack[one] < floors[one])]
            if counts is not None:
                counts[level] += len(left)
        wanted[left] = True
    return rows["key"].to_numpy()[wanted]


@np.errstate(over="ignore", invalid="ignore")  # what overflows is kept
def best_of_block(q_ids, q, floors, x_ids, x, axes, k: int = K, counts=None):
    """(query ids, row ids, scores) of the k best rows for each query of a block."""
    order = np.argsort(x_ids, kind="stable")
    x_ids, x = x_ids[order], x[order]
    a, b = rotated(q, axes), rotated(x, axes)
    slack, half = _slack(a, b), a.shape[1] // 2
    (am, ad), (bm, bd) = (statistics(y, equal(y.shape[1], FINE)) for y in (a, b))
    (rm, rd), (sm, sd) = (statistics(y[:, half:], equal(half, FINE // 2)) for y in (a, b))
    found = []
    for start in range(0, len(q), _STRIP):
        means = am[start:start + _STRIP] @ bm.T
        coarse = means + ad[start:start + _STRIP] @ bd.T
        for one, (estimate, bound) in enumerate(zip(means, coarse), start):
            floor = floors[one]
            left = np.flatnonzero((x_ids != q_ids[one]) & ~(bound + slack[one] < floor))
            for _ in range(2):  # the block's own likeliest may raise the floor
                if len(left) <= LIKELY * k:
                    break
                likely = left[np.argpartition(-estimate[left], LIKELY * k - 1)[:LIKELY * k]]
                floor = max(floor, _floor(np.partition(_exact(q[one], x[likely]), -k)[-k]))
                left = left[~(bound[left] + slack[one] < floor)]
                estimate = bound
            fine = len(left)
            bound = b[left, :half] @ a[one, :half] + sm[left] @ rm[one] + sd[left] @ rd[one] + slack[one]
            left = left[~(bound < floor)]
            if counts is not None:
                counts += [fine, len(left)]
            scores = _exact(q[one], x[left])
            best = np.lexsort((x_ids[left], ~scores))[:k]  # -scores would overflow at the limit
            found.append((np.full(len(best), q_ids[one]), x_ids[left][best], scores[best]))
    return found


def _table(found, columns: list[str], types: list[str]) -> pd.DataFrame:
    parts = list(zip(*found)) or [[np.empty(0)]] * len(columns)
    return pd.DataFrame({c: np.concatenate(p).astype(t) for c, p, t in zip(columns, parts, types)})


def _prepared(df: DataFrame, width: int, axes: np.ndarray) -> DataFrame:
    """key, id, v and packed statistics s of each vector, written, so that keys stay as they are."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            y = rotated(_matrix(batch["v"], width), axes)
            packed = np.hstack(statistics(y, leading(y.shape[1])))
            yield pd.DataFrame({"id": batch["id"], "v": batch["v"], "s": list(packed)})

    rows = df.select("id", "v").mapInPandas(run, "id long, v array<double>, s array<double>")
    return written(rows.withColumn("key", F.monotonically_increasing_id()), "vectors")


class Search:
    """The steps of one search of `rows` for `queries`; both have id (long) and v (array of numbers)."""

    def __init__(self, queries: DataFrame, rows: DataFrame, k: int = K):
        def usable(df):
            v = F.col("v").cast("array<double>")
            finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
            return df.select("id", v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite)

        queries, rows = usable(queries).groupBy("id").agg(F.max("v").alias("v")), usable(rows)
        size = F.max(F.size("v"))
        asked, n_queries = queries.agg(size, F.count("*")).first()
        stored, n_rows = rows.agg(size, F.count("*")).first()
        self.k, self.width = k, max(asked or 0, stored or 0, 1)
        fit_rows = max(1, min(FIT_ROWS, ROW_BYTES // (8 * self.width)))
        sample = rows.orderBy(F.xxhash64("id", "v"), "id", "v").limit(fit_rows).toPandas()
        self.axes = fitted_axes(_matrix(sample["v"], self.width))
        self.lengths = leading(rotated(np.zeros((1, self.width)), self.axes).shape[1])
        self.queries = _prepared(queries, self.width, self.axes)
        self.rows = _prepared(rows, self.width, self.axes)
        tasks = rows.sparkSession.sparkContext.defaultParallelism
        self.query_blocks = max(1, -(-n_queries * 8 * self.width // QUERY_BYTES))
        self.row_blocks = max(1, -(-n_rows * 8 * self.width // ROW_BYTES), min(tasks, n_rows // SMALLEST))
        self.groups = min(self.query_blocks * self.row_blocks, 10_000)

    def _dealt(self, df: DataFrame, own: str, *columns: str):
        """Each row once for every block of the other side, keyed by the pair of blocks."""
        blocks = {"qb": self.query_blocks, "rb": self.row_blocks}
        other = "rb" if own == "qb" else "qb"
        pair = [self.block(own).alias(own)]
        if other not in df.columns:
            df = df.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(blocks[other] - 1))))
        return df.select(*columns, *pair, other).repartition(self.groups, "qb", "rb").groupBy("qb", "rb")

    def block(self, own: str):
        # repeated ids may be dealt apart: rows go by key, and every query has one row
        return F.pmod(F.xxhash64("key"), F.lit(self.query_blocks if own == "qb" else self.row_blocks)).cast("int")

    def floors(self) -> DataFrame:
        """Queries with the k-th best exact score among their likeliest rows; null if they have fewer."""
        k, width = self.k, self.width

        def pair(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            found = likeliest(queries, rows, LIKELY * k) if len(queries) and len(rows) else ()
            return _table(found, ["query_id", "key", "estimate"], ["int64", "int64", "float64"])

        likely = self._dealt(self.queries, "qb", "id", "s").cogroup(self._dealt(self.rows, "rb", "id", "key", "s")).applyInPandas(
            pair, "query_id long, key long, estimate double")
        by_query = Window.partitionBy("query_id").orderBy(F.col("estimate").desc(), "key")
        likely = likely.withColumn("n", F.row_number().over(by_query)).where(F.col("n") <= LIKELY * k)
        pairs = likely.join(self.rows.select("key", "v"), "key").join(
            self.queries.select(F.col("id").alias("query_id"), F.col("v").alias("q")), "query_id").select("query_id", "q", "v")

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                q, x = _matrix(batch["q"], width), _matrix(batch["v"], width)
                scores = [_exact(q[i], x[i:i + 1])[0] for i in range(len(q))]
                yield pd.DataFrame({"id": batch["query_id"], "score": np.array(scores, dtype="int64")})

        best = F.get(F.sort_array(F.collect_list("score"), asc=False), F.lit(k - 1))  # of LIKELY * k scores
        lowest = pairs.mapInPandas(score, "id long, score long").groupBy("id").agg(best.alias("kth")).select(
            "id", F.when(F.col("kth") > -_LIMIT, F.col("kth")).cast("double").alias("floor"))
        return written(self.queries.join(lowest, "id", "left"), "floors")

    def left(self, floors: DataFrame) -> DataFrame:
        """key and qb: which rows each query block gets as vectors."""
        lengths = self.lengths

        def pair(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            if not len(queries) or not len(rows):
                return pd.DataFrame({"key": pd.Series(dtype="int64"), "qb": pd.Series(dtype="int32")})
            keys = left_by_statistics(queries, rows, lengths)
            return pd.DataFrame({"key": keys, "qb": np.full(len(keys), queries["qb"].iloc[0], dtype="int32")})

        return self._dealt(floors, "qb", "id", "s", "floor").cogroup(self._dealt(self.rows, "rb", "id", "key", "s")).applyInPandas(
            pair, "key long, qb int")

    def result(self) -> DataFrame:
        floors = self.floors()
        vectors = self.rows.select("key", "id", "v").join(self.left(floors), "key")
        k, width, axes = self.k, self.width, self.axes

        def pair(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            found = ()
            if len(queries) and len(rows):
                lowest = queries["floor"].to_numpy(dtype=float, na_value=-np.inf)
                found = best_of_block(queries["id"].to_numpy(), _matrix(queries["v"], width), lowest,
                                      rows["id"].to_numpy(), _matrix(rows["v"], width), axes, k)
            return _table(found, ["query_id", "vec_id", "score"], ["int64"] * 3)

        found = self._dealt(floors, "qb", "id", "v", "floor").cogroup(self._dealt(vectors, "rb", "id", "v")).applyInPandas(
            pair, "query_id long, vec_id long, score long")
        by_query = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        ranked = found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
        return ranked.select("query_id", "rank", "vec_id", "score")


def survivors(queries: DataFrame, rows: DataFrame, k: int = K) -> DataFrame:
    """level and pairs: how many pairs of a query and a row are left after 1, 4, 16 and 32
    segments and after the exact leading half; level 0 has all pairs. Here every row is sent to
    every block, so the last two say what these bounds leave of all pairs."""
    search = Search(queries, rows, k)
    floors, width, axes, lengths = search.floors(), search.width, search.axes, search.lengths

    def pair(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        first, last = np.zeros(len(LEVELS), dtype=np.int64), np.zeros(2, dtype=np.int64)
        if len(queries) and len(rows):
            lowest = queries["floor"].to_numpy(dtype=float, na_value=-np.inf)
            left_by_statistics(queries, rows, lengths, first)
            best_of_block(queries["id"].to_numpy(), _matrix(queries["v"], width), lowest,
                          rows["id"].to_numpy(), _matrix(rows["v"], width), axes, k, last)
        counts = np.concatenate([[len(queries) * len(rows)], first, last])
        return pd.DataFrame({"level": np.arange(len(counts)), "pairs": counts})

    dealt = search._dealt(floors, "qb", "id", "v", "s", "floor"), search._dealt(search.rows, "rb", "id", "key", "v", "s")
    counted = dealt[0].cogroup(dealt[1]).applyInPandas(pair, "level long, pairs long")
    return counted.groupBy("level").agg(F.sum("pairs").alias("pairs"))


def top_k(queries: DataFrame, rows: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score. Both inputs have id (long) and v (array of numbers)."""
    return Search(queries, rows, k).result()


ORACLE = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, list_sum(list_transform(list_zip(q.e, x.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= {K}
"""
