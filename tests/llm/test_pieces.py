"""Segmentations against all segmentations, and exact round trips."""

import random

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from tellerlake.llm import pieces as P


@pytest.fixture(scope="module")
def model():
    return P.Pieces.load()


def brute(model, text, n):
    """Scores of the n best of all segmentations of a short text."""
    table = {p.replace(P.SPACE, " "): s for p, s, k in zip(model.pieces, model.scores, model.kinds) if k == "piece"}
    model.prepare()

    def scores(rest):
        if not rest:
            return [0.0]
        out = [table[rest[:k]] + s for k in range(1, len(rest) + 1) if rest[:k] in table for s in scores(rest[k:])]
        if rest[0] not in table:
            out += [model.fallback + s for s in scores(rest[1:])]
        return out

    return sorted(scores(" " + text), reverse=True)[:n]


TEXTS = ["a", "the", "thonti.", "  two  ", "x\ny", "añ▁b", "漢字 x", "😀😀", "of, the", "\t\r\n", "a b", "THE!!", "the&&& it"]


@pytest.mark.parametrize("text", TEXTS)
def test_n_best_scores_and_round_trip(model, text):
    ids, best, exact = model.encode(text)
    assert exact and best == brute(model, text, P.N_BEST)
    import numpy as np

    assert model.decode(np.frombuffer(ids, dtype=np.int32).tolist()) == text
    for score, path in model.paths(" " + text):
        assert model.decode(path) == text
    assert [s for s, _ in model.paths(" " + text)] == best


def test_best_path_is_the_first_of_the_search(model):
    import numpy as np

    model.prepare()
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("thearnoisx é.") for _ in range(rng.randrange(1, 14)))
        ids, score, behind = model.first(text)
        paths = model.paths(text)
        assert (np.frombuffer(ids, dtype=np.int32).tolist(), score) == (paths[0][1], paths[0][0])
        assert behind == (paths[0][0] - paths[1][0] if len(paths) > 1 else float("inf"))


def test_a_small_store_changes_nothing(model, monkeypatch):
    texts = [f"word{i % 17} and {i}" for i in range(200)]
    expected = [model.encode(t) for t in texts]
    monkeypatch.setattr(P, "STORE", 3)
    assert [P.Pieces.load().encode(t) for t in texts] == expected


def test_whole_table_round_trip(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    coded = P.encoded(docs.select("doc_id", "text"))
    assert coded.where("not exact").isEmpty() and coded.count() == docs.count()
    back = P.decoded(coded.select("doc_id", "ids"))
    assert back.join(docs.select("doc_id", docs.text.alias("t")), "doc_id").where("text <> t").isEmpty()
    assert coded.where("n_pieces <> size(ids) or score <> best_scores[0] or size(best_scores) > 4").isEmpty()


def test_edges_of_tables(spark):
    long = "ab " * 200_000 + "q" * 20_000
    df = spark.createDataFrame([(1, None, 7), (2, "", 7), (2, "", 7), (3, long, 7)], "doc_id long, text string, Score int").withColumn("a: b", F.lit(1))
    got = {r.doc_id: r for r in P.encoded(df).collect()}
    assert (got[1].ids, got[1].score, got[1].n_pieces, got[1].exact) == (None, None, None, True)
    assert (got[2].ids, got[2].score, got[2].best_scores) == ([], 0.0, [0.0])
    assert got[3].exact and got[3].n_pieces > 200_000
    assert P.encoded(df).columns == ["doc_id", "text", "a: b", *P.DERIVED] and P.encoded(df.limit(0)).count() == 0
    assert P.decoded(P.encoded(df)).where("doc_id = 1").first().text is None


def unpacked(paths):
    import numpy as np

    return [np.frombuffer(p, dtype=np.int32).tolist() for p in paths]


@pytest.mark.parametrize("text", [*TEXTS, "the thonti and\nthe  heon of", "reansti", ""])
def test_ids_of_the_n_best_are_those_of_the_search(model, text):
    paths, scores, exact = model.best_paths(text)
    ids = unpacked(paths)
    assert exact and len(ids) == len(scores) and len({*map(tuple, ids)}) == len(ids)
    assert [model.decode(x) for x in ids] == [text] * len(ids)
    if text:
        expected = model.paths(" " + text)
        assert scores == pytest.approx([s for s, _ in expected]) and ids[0] == expected[0][1]
        # equal scores may come in any order, and the last of them may be another one
        own = {tuple(x) for x, s in zip(ids, scores) if s > scores[-1] + 1e-6}
        assert own == {tuple(x) for s, x in expected if s > scores[-1] + 1e-6}


def test_exactness_is_tested_on_the_ids_of_each_text():
    own = P.Pieces.load()
    assert own.encode("the thonti")[2]
    last = unpacked([own.encode("the thonti")[0]])[0][-1]
    own.bytes_of[last] = b"?"
    assert not own.encode("the thonti")[2]


def test_tables_have_the_ids_of_the_n_best(spark):
    rows = P.encoded(spark.createDataFrame([(1, "the thonti"), (2, None), (3, "")], "doc_id long, text string")).collect()
    assert len(rows[0].best_ids) == len(rows[0].best_scores) == P.N_BEST and rows[0].best_ids[0] == rows[0].ids
    assert rows[1].best_ids is None and rows[2].best_ids == [[]]


def test_a_piece_across_a_space_is_found():
    model = P.Pieces(["▁", "a", "b", "a▁b", "c\n", "\n", "c"], [-2.0, -1.0, -1.0, -0.5, -0.25, -3.0, -1.5], ["piece"] * 7)
    for text in ("a b", "a ba b", "ac\nb", "c\n a b"):
        _, best, exact = model.best_paths(text)
        assert exact and best == pytest.approx(brute(model, text, P.N_BEST))
    assert not model.cut_at_spaces


def test_the_given_model_is_cut_at_spaces(model):
    model.prepare()
    assert model.cut_at_spaces


def test_parts_searched_at_once_are_as_one_by_one(model):
    model.prepare()
    rng = random.Random(4)
    texts = {"".join(rng.choice("thearnoisx é.漢😀▁&") for _ in range(rng.randrange(1, 20))) for _ in range(600)}
    texts = sorted(texts | {"a", "\x00", "the", " thonti", "q" * P.STORED_CHARS})
    assert model.firsts(texts) == [model.first(t) for t in texts] and model.firsts([]) == []


def test_new_parts_of_many_texts_are_searched_together(monkeypatch):
    texts = [f"nor{i % 50} thonti{i}, of.{i * 7}" for i in range(300)]
    expected = [P.Pieces.load().best_paths(t)[:2] for t in texts[:20]]
    own, calls = P.Pieces.load(), []
    first = own.first
    monkeypatch.setattr(own, "first", lambda text: calls.append(text) or first(text))
    got = own.n_bests_of(texts)
    assert got[:20] == expected and not calls
    assert all(own.spelled(texts, [paths for paths, _ in got]))


def test_columns_that_do_not_come_along(spark):
    df = spark.createDataFrame([(1, "the thonti", 3), (2, None, 4)], "doc_id long, text string, x int")
    rows = P.encoded(df, carry=["doc_id"])
    assert rows.columns == ["doc_id", *P.DERIVED] and [r.ids is None for r in rows.orderBy("doc_id").collect()] == [False, True]
