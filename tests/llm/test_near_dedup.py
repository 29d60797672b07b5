"""Near duplicates and components against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tellerlake.llm import components, near_dedup

SCHEMA = "doc_id long, text string"


def shingles(text):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = (text or "").translate(str.maketrans(upper, upper.lower())).encode().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """n_shingles and component of each row; rows without an id are linked with nothing."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if None not in (rows[i][0], rows[j][0]) and both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(((i, len(sets[k]), None if i is None else least[root(k)]) for k, (i, _) in enumerate(rows)), key=repr)


def found(df):
    rows = near_dedup.verdicts(df.select(F.col("doc_id").alias("id"), "text")).collect()
    assert all(r.kept == (r.id is None or r.id == r.component_id) for r in rows)
    return sorted(((r.id, r.n_shingles, r.component_id) for r in rows), key=repr)


def corpus():
    """Unrelated texts, chains, and a large group of copies at many distances of a base."""
    rng = random.Random(4)

    def text(n):
        return [f"w{rng.randrange(4000)}" for _ in range(n)]

    def edited(words, k):
        words = list(words)
        for at in rng.sample(range(len(words)), k):
            words[at] = f"e{rng.randrange(10**6)}"
        return words

    rows = [text(rng.randrange(1, 90)) for _ in range(120)]
    base = text(120)
    rows += [edited(base, rng.randrange(1, 7)) for _ in range(150)]
    chain = text(100)
    for _ in range(25):
        chain = edited(chain, 2)
        rows.append(chain)
    passage = text(40)
    rows += [text(30) + passage for _ in range(60)]
    rows += [rows[0]] * 20
    texts = [" ".join(r).upper() if i % 11 == 0 else "\n".join(r) for i, r in enumerate(rows)]
    texts += ["", " \t", None, "one two", "One  two", "one two three four", "a b c d e", "a b c d e f"]
    rng.shuffle(texts)
    return list(enumerate(texts, 1))


def test_components_agree_with_brute_force(spark):
    rows = corpus()
    expected = brute(rows)
    assert len({c for _, _, c in expected}) < len(rows) - 100
    assert found(spark.createDataFrame(rows, SCHEMA)) == expected


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "FIRST", 1)
    rows = corpus()
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other text of the same id"), (2, "A b c d e f"),
            (None, "a b c d e f"), (None, None), (3, None)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == [
        (1, 2, 1), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3), (None, 0, None), (None, 2, None)]


def test_what_stays_keeps_its_columns(spark):
    df = spark.createDataFrame([(2, "a b c d e f", 1), (1, "a b c d e f", 2), (4, None, 3)], SCHEMA + ", kept int")
    assert sorted(near_dedup.deduplicated(df).collect()) == [(1, "a b c d e f", 2), (4, None, 3)]
    assert near_dedup.deduplicated(df.limit(0)).count() == 0


def test_candidates_of_a_large_group_are_not_all_its_pairs(spark):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(300):
        words = list(base)
        for at in rng.sample(range(200), 4):
            words[at] = f"x{rng.random()}"
        rows.append((i, " ".join(words)))
    source = spark.createDataFrame(rows, "id long, text string").withColumn("text_hash", F.xxhash64("text"))
    sketched = source.mapInArrow(near_dedup._sketch, "id long, text_hash long, n long, node long, sig binary")
    members = near_dedup._members(sketched.select(F.col("node").alias("id"), "n", "sig")).withColumn("label", F.col("id"))
    cells = members.repartition(*near_dedup.CELL).sortWithinPartitions(*near_dedup.CELL)
    pairs = cells.mapInArrow(near_dedup._closest, "a long, b long").count()
    assert pairs <= 300 * near_dedup.HALVES * near_dedup.FIRST < 2 * 300 * 299


@pytest.mark.parametrize("n", [1, 2, 50])
def test_components_of_a_path_and_a_star(spark, n):
    edges = [(i, i + 1) for i in range(n)] + [(1000, 1001 + i) for i in range(n)]
    random.Random(n).shuffle(edges)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, **{1000 + i: 1000 for i in range(n + 1)}}


def test_stars_are_not_rewired_again(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(components, "written", lambda df, name: tables.append(name) or df)
    edges = spark.createDataFrame([(1, k) for k in range(2, 40)], "a long, b long")
    assert {r.component for r in components.components(edges).collect()} == {1} and len(tables) == 1


def test_components_joined_by_edges_between_them(spark):
    known = spark.createDataFrame([(1, 1), (5, 1), (2, 2), (7, 2), (3, 3), (4, 3)], "node long, component long")
    more = spark.createDataFrame([(2, 1), (9, 8), (9, 2)], "a long, b long")
    got = components.joined_components(known, more).collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 1), (3, 3), (4, 3), (5, 1), (7, 1), (8, 1), (9, 1)]


def test_a_cell_is_not_tested_pair_by_pair(monkeypatch):
    import numpy as np
    import pyarrow as pa

    rng, size, pool = np.random.default_rng(1), 100, np.arange(1, 129, dtype=np.uint64)
    sets = [np.sort(rng.choice(pool, size, replace=False)) for _ in range(150)]
    calls, similar = [], near_dedup._similar
    monkeypatch.setattr(near_dedup, "_similar", lambda a, b: calls.append(1) or similar(a, b))
    one = lambda v, kind: pa.array([v] * len(sets), kind)
    batch = pa.RecordBatch.from_pydict({
        "id": pa.array(range(150), pa.int64()), "n": one(size, pa.int64()), "sig": one(bytes(4 * near_dedup.HASHES), pa.binary()),
        "half": one(0, pa.int32()), "key": one(0, pa.int64()), "block": one(0, pa.int32()), "x": one(0, pa.int32()),
        "y": one(0, pa.int32()), "label": pa.array(range(150), pa.int64()), "shingles": pa.array([s.tobytes() for s in sets]),
    })
    links = [(a, b) for out in near_dedup._cell_links(iter([batch])) for a, b in zip(*(c.to_pylist() for c in out.columns))]
    assert len(calls) < 150

    def groups(pairs):
        label = list(range(150))
        for a, b in pairs:
            low, high = sorted((label[a], label[b]))
            label = [low if x == high else x for x in label]
        return label

    linked = [(a, b) for a in range(150) for b in range(a) if similar(sets[a], sets[b])]
    assert linked and groups(links) == groups(linked)
