"""Quality classifier from trusted positives and unlabelled text.

Documents become a few ratios of their whole text, computed by Spark. A small network is
fitted in numpy by non-negative risk: with class prior p, positives P and unlabelled U,

    risk = p * E_P[loss(+)]  +  max(0, E_U[loss(-)] - p * E_P[loss(-)]),

and where the second part falls below zero, its gradient is turned round. The prior is
estimated from P and U alone: of a first classifier's upper regions, the one that holds
least of U for what it holds of P bounds it, on rows that classifier did not see.

Labels are read from training rows only: those whose crc32(id as text) mod 3 is not 1.
Trusted positives are ids with label 1 and no other label. U is taken from all training
documents. At most `MAX_POSITIVE` and `MAX_UNLABELLED` rows go to the driver for fitting,
lowest hashes of id, text and a seeded number of the row first, so that null ids and copies
are thinned like all other rows; every document is scored.

Defined results: null and empty texts have all ratios 0 and the score that belongs to
them; without positives or training rows every score is 0.5; repeated rows give repeated
results; a null id is a training row without label; columns other than id and text play
no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerlake.llm.quality_rules import STOP_WORDS
from tellerlake.llm.shared import quoted, without_spaces, words, written

FOLDS, HELD_OUT = 3, 1
MAX_POSITIVE, MAX_UNLABELLED = 20_000, 40_000
HIDDEN, STEPS, RATE, SEED = 16, 300, 0.02, 3
#: Weight decay, and how much of the non-negative part's slack is allowed.
DECAY, SLACK = 1e-3, 0.0

#: Places in a draw are below this.
DRAWS = 1 << 53

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, the ratios of each text as an array, and the row's place in a draw.

    The draw is the same for the same partitions.
    """
    t = F.col("t")
    base = docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("t"))
    base = base.withColumns({
        "w": words(t), "lines": F.filter(F.split(t, "\n", -1), lambda x: without_spaces(x) != ""),
        "n": F.greatest(F.length(without_spaces(t)), F.lit(1)).cast("double"),
    })
    w, n, lines = F.col("w"), F.col("n"), F.col("lines")
    n_words = F.greatest(F.size(w), F.lit(1)).cast("double")
    n_lines = F.greatest(F.size(lines), F.lit(1)).cast("double")

    def share(characters: str):
        return (F.length(t) - F.length(F.translate(t, characters, ""))) / n

    in_run = F.size(F.filter(w, lambda x, i: (i > 0) & (x == F.get(w, i - 1))))
    ratios = [
        F.log1p(n), F.log1p(n_words), n / n_words, F.size(lines) / n_words * 10,
        share("#*$%&|<>"), share("!?"), share(".,;:"), share("0123456789"), share("()[]{}\"'/\\@_=+~^-"),
        share(_UPPER), 1 - F.length(F.regexp_replace(t, "[^\\x00-\\x7F]", "")) / F.greatest(F.length(t), F.lit(1)),
        F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))) / n_words,
        F.size(F.array_distinct(w)) / n_words, in_run / n_words,
        (F.size(lines) - F.size(F.array_distinct(lines))) / n_lines,
        F.size(F.filter(w, lambda x: F.length(x) <= 2)) / n_words,
    ]
    draw = F.pmod(F.xxhash64("doc_id", "t", F.rand(SEED)), F.lit(DRAWS)).alias("draw")
    return base.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.array(*[r.cast("double") for r in ratios]).alias("x"), draw)


@dataclass
class Network:
    """Two layers; `raw` is above 0 for the positive class."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def hidden(self, z: np.ndarray) -> np.ndarray:
        return np.tanh(z @ self.w1 + self.b1)

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -6, 6)

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.hidden(self.standard(x)) @ self.w2 + self.b2[0])


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(v / 2))


def risk_gradient(raw_p: np.ndarray, raw_u: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the non-negative risk by the raw scores, for the sigmoid loss."""
    sp, su = _sigmoid(raw_p), _sigmoid(raw_u)
    slope_p, slope_u = sp * (1 - sp) / len(sp), su * (1 - su) / len(su)
    negative = su.mean() - prior * sp.mean()
    if negative < -SLACK:
        return prior * slope_p, -slope_u
    return -2 * prior * slope_p, slope_u


def _fit(p: np.ndarray, u: np.ndarray, gradient) -> Network:
    rng = np.random.default_rng(SEED)
    both = np.concatenate([p, u])
    scale = both.std(axis=0)
    net = Network(
        both.mean(axis=0), np.where(scale > 1e-9, scale, 1.0), rng.normal(0, 0.5, (p.shape[1], HIDDEN)),
        np.zeros(HIDDEN), rng.normal(0, 0.5, HIDDEN), np.zeros(1),
    )
    z = net.standard(both)
    names = ["w1", "b1", "w2", "b2"]
    first, second = ({k: np.zeros_like(getattr(net, k)) for k in names} for _ in range(2))
    for step in range(1, STEPS + 1):
        h = net.hidden(z)
        raw = h @ net.w2 + net.b2[0]
        g = np.concatenate(gradient(raw[:len(p)], raw[len(p):]))
        back = np.outer(g, net.w2) * (1 - h * h)
        slopes = {
            "w1": z.T @ back + DECAY * net.w1, "b1": back.sum(axis=0),
            "w2": h.T @ g + DECAY * net.w2, "b2": np.array([g.sum()]),
        }
        for k in names:
            first[k] = 0.9 * first[k] + 0.1 * slopes[k]
            second[k] = 0.999 * second[k] + 0.001 * slopes[k] ** 2
            move = first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
            setattr(net, k, getattr(net, k) - RATE * move)
    return net


def estimated_prior(p: np.ndarray, u: np.ndarray) -> float:
    """The share of positives in `u`, bounded by regions of a classifier of P against U."""
    fit_p, fit_u, see_p, see_u = p[::2], u[::2], p[1::2], u[1::2]
    if not len(see_p) or not len(see_u):
        return 0.5
    net = _fit(fit_p, fit_u, lambda a, b: (-_sigmoid(-a) / len(a), _sigmoid(b) / len(b)))
    sp, su = net.score(see_p), net.score(see_u)
    bounds = []
    for q in np.linspace(0.005, 0.5, 100):
        edge = np.quantile(sp, q)
        in_p, in_u = (sp >= edge).mean(), (su >= edge).mean()
        error = np.sqrt(in_u * (1 - in_u) / len(su) + in_p * (1 - in_p) / len(sp))
        bounds.append((in_u + error) / in_p)
    return float(np.clip(min(bounds), 0.01, 0.99))


def fitted(p: np.ndarray, u: np.ndarray) -> Network | None:
    if not len(p) or not len(u):
        return None
    prior = estimated_prior(p, u)
    return _fit(p, u, lambda a, b: risk_gradient(a, b, prior))


def _sample(rows: DataFrame, most: int) -> np.ndarray:
    """About `most` rows, and no more: the first of the draw.

    A threshold leaves a little more than that, so what tasks send to the driver does not
    grow with their number.
    """
    share = min(1.0, 1.2 * most / max(rows.count(), 1))
    low = rows.where(F.col("draw") < F.lit(int(share * DRAWS)))
    picked = low.orderBy("draw").limit(most).select("x").toPandas()["x"]
    return np.stack([np.asarray(x) for x in picked]) if len(picked) else np.empty((0, 0))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs` (doc_id, text)."""
    table = written(features(docs), "quality-features")
    training = table.where("not held_out")
    trusted = (
        labels.where(~held_out(F.col("doc_id")) & F.col("quality").isNotNull())
        .groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")
    )
    net = fitted(_sample(training.join(trusted, "doc_id"), MAX_POSITIVE), _sample(training, MAX_UNLABELLED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.full(batch.num_rows, 0.5)
            if net is not None and batch.num_rows:
                score = net.score(batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array(score >= 0.5).cast(pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    id_type = table.schema["doc_id"].dataType.simpleString()
    return table.select("doc_id", "held_out", "x").mapInArrow(run, f"doc_id {id_type}, held_out boolean, score double, predicted int")
