"""The inputs of the quality classifier by a plain computation, its gradient by differences."""

import math
import re

import numpy as np
import pytest
from conftest import SF_DIR

from tellerlake.llm import pu_quality as Q
from tellerlake.llm.quality_rules import STOP_WORDS

SPACE = " \t\n\x0b\x0c\r"


def plain_inputs(text):
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    n, n_words, n_lines = max(sum(map(len, w)), 1), max(len(w), 1), max(len(lines), 1)

    def share(signs):
        return sum(c in signs for c in text) / n

    return [
        math.log1p(n), math.log1p(n_words), n / n_words, len(lines) / n_words * 10,
        share("#*$%&|<>"), share("!?"), share(".,;:"), share("0123456789"), share("()[]{}\"'/\\@_=+~^-"),
        sum("A" <= c <= "Z" for c in text) / n,
        sum(ord(c) > 127 for c in text) / len(text) if text else 1,  # as it stands, an empty text counts as foreign
        sum(x.lower() in STOP_WORDS for x in w) / n_words, len(set(w)) / n_words,
        sum(a == b for a, b in zip(w, w[1:])) / n_words, (len(lines) - len(set(lines))) / n_lines,
        sum(len(x) <= 2 for x in w) / n_words,
    ]


def test_inputs_agree_with_a_plain_computation(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").collect()]
    texts += [None, "", " \n\t ", "a a a\na a a\n\nB é 漢", "The the (x) #1!\r\n\r\n", "x" * 300_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in Q.features(docs).select("doc_id", "x").collect():
        assert row.x == pytest.approx(plain_inputs(texts[row.doc_id]), abs=1e-9), row.doc_id


@pytest.mark.parametrize("prior, shift", [(0.3, -1.0), (0.3, 1.0), (0.9, -2.0), (0.9, 0.5)])
def test_gradient_of_the_risk_agrees_with_differences(prior, shift):
    rng = np.random.default_rng(7)
    p, u = rng.normal(1.0, 1.0, 9), rng.normal(shift, 1.0, 14)

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    def descended(p, u):
        negative = sigmoid(u).mean() - prior * sigmoid(p).mean()
        # below zero the step goes back up the negative part alone
        return -negative if negative < 0 else prior * (1 - sigmoid(p)).mean() + negative

    by_p, by_u = Q.risk_gradient(p, u, prior)
    eps = 1e-6
    for values, got, other in ((p, by_p, lambda x: descended(x, u)), (u, by_u, lambda x: descended(p, x))):
        for k in range(len(values)):
            step = np.eye(len(values))[k] * eps
            assert got[k] == pytest.approx((other(values + step) - other(values - step)) / (2 * eps), abs=1e-7)
