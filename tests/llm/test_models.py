"""The quality classifier and the language model: held-out results and edge cases."""

import collections
import math
import pickle
import tracemalloc
import zlib

import numpy as np
import pytest
from conftest import SF_DIR

from tellerlake.llm import lm_score, pu_quality
from tellerlake.llm.queries import QUERIES

DOCS = "doc_id long, text string"


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_quality_on_held_out_labels(spark):
    rows = {r.doc_id: r for r in QUERIES["op2_quality_classifier"](spark, SF_DIR).collect()}
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (crc(i, 3) == 1) for i, r in rows.items())
    held = [x for x in labels if crc(x.doc_id, 3) == 1]
    assert np.mean([rows[x.doc_id].predicted == x.quality for x in held]) > 0.9


def test_quality_without_positives_or_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "x"), (5, "a " * 100_000)], DOCS)
    none = spark.createDataFrame([(1, 0), (2, 0), (2, 1), (None, 1), (3, None)], "doc_id long, quality int")
    assert [r.score for r in pu_quality.scored(df, none).collect()] == [0.5] * 5
    assert pu_quality.scored(df.limit(0), none).count() == 0


@pytest.mark.parametrize("same", ["NULL", "3", "7", "11"])
def test_null_and_repeated_ids_are_thinned_like_others(spark, same):
    df = spark.range(6000).selectExpr(
        f"IF(id % 3 = 0, CAST({same} AS BIGINT), id + 100) AS doc_id", "IF(id % 3 = 0, 'x', repeat('word ', 50)) AS text")
    rows = pu_quality.features(df).localCheckpoint()
    x = pu_quality._sample(rows, 900)
    assert len(x) == 900 and 0.25 < (x[:, 0] < 1).mean() < 0.42


def test_risk_turns_round_below_zero():
    p, u = np.full(10, 3.0), np.full(10, -3.0)
    gp, gu = pu_quality.risk_gradient(p, u, 0.9)  # the negative part is below zero here
    assert (gp > 0).all() and (gu < 0).all()
    gp, gu = pu_quality.risk_gradient(u, p, 0.5)
    assert (gp < 0).all() and (gu > 0).all()


@pytest.mark.parametrize("share", [0.3, 0.7])
def test_prior_is_estimated_from_positives_and_unlabelled(share):
    rng = np.random.default_rng(0)
    good, bad = rng.normal(2, 1, (8000, 3)), rng.normal(-2, 1, (8000, 3))
    k = int(4000 * share)
    assert abs(pu_quality.estimated_prior(good[:2000], np.concatenate([good[2000:2000 + k], bad[:4000 - k]])[rng.permutation(4000)]) - share) < 0.08


def tokens(text):
    return [w for w in (text or "").encode().lower().split()] + [b" end"]


def test_language_model_counts_base_and_gain(spark):
    sf_dir = SF_DIR.replace("sf0.001", "sf0.01")  # a few hundred texts are too few to learn from
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op3_lm_score"](spark, sf_dir).collect()}
    counts = collections.Counter(w for i, t in docs.items() if crc(i, 7) != 2 for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        r, words = got[i], tokens(text)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (crc(i, 7) == 2, len(words), n)
        assert r.n_known == sum(counts[w] > 0 for w in words)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))
        assert r.score < 0
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_texts_without_words_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (4, "a b a"), (4, "a b a"), (None, "c")], DOCS)
    rows = lm_score.scored(df).collect()
    assert sorted(r.n_tokens for r in rows) == [1, 1, 1, 2, 4, 4] and len({r.train_tokens for r in rows}) == 1
    assert lm_score.scored(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def small():
    subwords = lm_score.Subwords.load()
    _, end, begins = subwords.encoding()
    ids, doc = lm_score._sequence([subwords.of_words(w.split())[0] for w in (b"the heon of thonti and of", b"der und", b"")], end)
    counts = np.bincount(ids, minlength=end + 1).astype(float)
    return lm_score.Attention(counts, begins), ids, doc, begins


def test_probabilities_add_up_to_one(small):
    model, ids, doc, begins = small
    f = model.forward(*model.windows(model.inputs(ids, doc), doc))
    hidden, logits = f["h"].reshape(-1, lm_score.WIDTH)[0], f["logits"][0].astype(float)
    by_class = np.exp(logits - logits.max())
    by_class /= by_class.sum()
    total, start = 0.0, 0.0
    for c in range(model.n_classes):
        members = slice(model.slices[c], model.slices[c + 1])
        inner = np.exp(model.p["inner"][members] @ hidden + model.p["inner_bias"][members])
        of_class = np.flatnonzero(model.cls == c)
        rest = of_class[model.row[of_class] == len(model.members)]
        total += by_class[c] * ((1.0 if len(inner) else 0.0) + np.exp(model.log_share[rest]).sum())
        start += by_class[c] * (c < model.n_begin)
    empty = [c for c in range(model.n_classes) if not (model.cls == c).any()]
    assert total + sum(by_class[empty]) == pytest.approx(1, abs=1e-4)
    assert np.exp(model.score(ids, doc)[1][0]) == pytest.approx(start, abs=1e-4)
    assert (model.cls[begins] < model.n_begin).all() and (model.cls[~begins] >= model.n_begin).all()


def test_scores_see_only_what_precedes_in_the_same_text(small):
    model, ids, doc, _ = small
    whole = model.score(ids, doc)[0]
    changed = ids.copy()
    changed[-1], cut = ids[0], len(ids) - 1
    assert np.allclose(model.score(changed, doc)[0][:cut], whole[:cut])
    second = np.flatnonzero(doc == 1)
    assert np.allclose(model.score(ids[second], doc[second])[0], whole[second], atol=1e-5)


def test_gradient_agrees_with_differences(small):
    model, ids, doc, _ = small
    x, of = model.windows(model.inputs(ids, doc), doc)
    n = len(x) * lm_score.HALF
    cls, row, real = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), (of[:, lm_score.HALF:] >= 0).reshape(-1)
    cls[:len(ids)], row[:len(ids)] = model.cls[ids], model.row[ids]
    slopes = model._gradient(x, of, cls, row, real)

    def loss():
        return -(model.score(ids, doc)[0] - model.log_share[ids]).mean()

    rng = np.random.default_rng(0)
    for name, slope in slopes.items():
        flat = model.p[name].reshape(-1)
        at = int(np.abs(slope).reshape(-1).argmax()) if rng.random() < 0.9 else 0
        keep, step = flat[at], 1e-2
        flat[at] = keep + step
        up = loss()
        flat[at] = keep - step
        down = loss()
        flat[at] = keep
        assert (up - down) / (2 * step) == pytest.approx(slope.reshape(-1)[at], rel=0.05, abs=2e-4), name


def test_training_rows_hold_every_training_document_whole(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "PART_WORDS", 500)
    subwords = lm_score.Subwords.load()
    _, end, _ = subwords.encoding()
    texts = [b"a b a", None, " ".join(f"w{i}" for i in range(5000)).encode(), b"", b"held out", b"the end"]
    rows = list(lm_score._chunk_rows(list(range(6)), [i == 4 for i in range(6)], texts, subwords))
    got = [np.frombuffer(r.column("payload")[0].as_py(), dtype=lm_score._id_type(end)) for r in rows if r.column("kind")[0].as_py() == lm_score.TRAIN]
    expected, _ = lm_score._sequence([subwords.of_words((t or b"").split())[0] for i, t in enumerate(texts) if i != 4], end)
    assert len(got) > 1 and np.concatenate(got).tolist() == expected.tolist()


def test_attention_learns_from_text_outside_the_sample(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "SAMPLE_DOCS", 0)
    df = spark.range(700).selectExpr("id AS doc_id", "repeat('red green blue black ', 250) AS text")
    held = lm_score.scored(df.repartition(2)).where("held_out").selectExpr("sum(attention_score) / sum(n_tokens)").first()[0]
    assert held > math.log10(0.5)  # by counts alone a word has a quarter


def test_chunks_get_back_only_sums_that_other_chunks_add_to(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "CHUNK_BYTES", 20_000)
    df = spark.range(400).selectExpr(
        "id AS doc_id", "concat('every ', repeat('common word ', 30), 'own', id, ' a', id % 200, repeat(' x', 200)) AS text").coalesce(1)
    docs = df.selectExpr("doc_id", "text", "coalesce(crc32(cast(cast(doc_id AS STRING) AS BINARY)) % 7 = 2, false) AS held_out")
    rows = lm_score.tokenised(docs, lm_score.Subwords.load()).localCheckpoint()
    got = lm_score.summed_words(rows).collect()
    counts = collections.Counter(w for r in df.collect() if crc(r.doc_id, 7) != 2 for w in tokens(r.text))
    chunks = collections.defaultdict(lambda: collections.defaultdict(int))
    for r in rows.where(f"kind = {lm_score.WORD}").collect():
        chunks[r.word][r.chunk, r.place] += r.n
    expected = {(c, p, sum(each.values())) for each in chunks.values() for (c, p), n in each.items() if sum(each.values()) > n}
    back = [(r.chunk, r.place, r.total) for r in got if r.chunk is not None]
    assert sum(r.known for r in got) == len(counts) and len(back) == len(set(back)) and set(back) == expected
    assert 0 < len(back) < sum(map(len, chunks.values())) / 2
    scores = {r.doc_id: r for r in lm_score.scored(df).collect()}
    n, v = sum(counts.values()), len(counts)
    for r in df.collect():
        words = tokens(r.text)
        assert scores[r.doc_id].n_known == sum(counts[w] > 0 for w in words)
        assert scores[r.doc_id].base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))


def test_places_of_frequent_words_are_small():
    texts = [b"a b c d e f b z", b"z z b", b""]
    rows = list(lm_score._chunk_rows([1, 2, 3], [False] * 3, texts, lm_score.Subwords.load()))
    docs = next(r for r in rows if r.column("kind")[0].as_py() == lm_score.DOC)
    at = [lm_score._of_planes(zlib.decompress(x.as_buffer())) for x in docs.column("payload")]
    assert [len(x) for x in at] == [8, 3, 0] and sorted(at[1].tolist()) in ([0, 0, 1], [0, 1, 1])
    big = np.array([0, 255, 256, 70_000, 2**31 - 1], dtype=np.int32)
    assert lm_score._of_planes(lm_score._planes(big)).tolist() == big.tolist()


def test_large_logits_have_finite_slopes(small):
    model, ids, doc, _ = small
    x, of = model.windows(model.inputs(ids, doc), doc)
    n = len(x) * lm_score.HALF
    cls, row, real = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), (of[:, lm_score.HALF:] >= 0).reshape(-1)
    cls[:len(ids)], row[:len(ids)] = model.cls[ids], model.row[ids]
    expected = model._gradient(x, of, cls, row, real)
    for name in ("bias", "inner_bias"):
        model.p[name] += np.float32(500)
    got = model._gradient(x, of, cls, row, real)
    for name in ("bias", "inner_bias"):
        model.p[name] -= np.float32(500)
    assert all(np.allclose(got[k], expected[k], atol=1e-3) for k in expected)


def test_steps_and_strips_use_their_arrays_again(small):
    model, ids, _, _ = small
    model = pickle.loads(pickle.dumps(model))
    assert all(x.dtype is np.dtype(np.float32) for x in model.p.values())  # as np.add.at asks for its fast way
    text = np.concatenate([np.resize(ids[:-1], 100_000), ids[-1:]])
    adam, rng = lm_score.Adam(model.p), np.random.default_rng(0)

    def most(run):
        tracemalloc.start()
        run()
        took = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return took

    assert model.learn(text, adam, 0.01, rng) == len(text) // lm_score.HALF + 1
    model.score(text, np.zeros(len(text), dtype=np.int64))
    of_text = 16 * len(text)
    assert most(lambda: model.learn(text, adam, 0.01, rng)) < 2 * of_text + 1_500_000
    assert most(lambda: model.score(text, np.zeros(len(text), dtype=np.int64))) < 3 * of_text + 1_500_000


@pytest.mark.parametrize("run", [1, 3, 8])
def test_runs_of_windows_have_the_slopes_of_their_windows(small, run):
    model, ids, _, _ = small
    ids = np.resize(ids, 400)
    ends = ids == len(model.cls) - 1
    doc = np.cumsum(ends) - ends

    def slopes(run):
        x, of = model.windows(model.inputs(ids, doc), doc, run)
        cls, row = np.zeros((2, len(x) * run * lm_score.HALF), dtype=np.int32)
        cls[:len(ids)], row[:len(ids)] = model.cls[ids], model.row[ids]
        return model._gradient(x, of, cls, row, (of[:, lm_score.HALF:] >= 0).reshape(-1))

    one, got = slopes(1), slopes(run)
    assert all(np.allclose(one[k], got[k], atol=1e-6) for k in one)


def test_words_are_those_between_white_space():
    texts = [None, b"", b" ", b" a b\x0b\x0cc ", b"a", b"\ta\n\nd\r\x1cx \xc2\xa0y", b"b"]
    distinct, at, ends = lm_score._places(texts)
    words = [[distinct[k] for k in at[s:e]] for s, e in zip([0, *ends], ends)]
    assert words == [(t or b"").split() for t in texts] and len(set(distinct)) == len(distinct)
