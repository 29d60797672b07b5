"""The conversation trie: brute force, many ranges, hot groups, and SQL on the whole table."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from compare import connect, differences
from conftest import SF_DIR
from pyspark.sql import functions as F

from tellerlake.llm import conversation_trie as T
from tellerlake.llm.queries import ORACLE, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def test_query_matches_sql(spark):
    df = QUERIES["op11_conversation_trie"](spark, SF_DIR)
    assert df.count() > 0
    assert differences(df, connect(SF_DIR), ORACLE["op11_conversation_trie"]) == []


def brute(rows):
    """The rows of all nodes, worked out from whole sequences."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, digest, (role, text)))
    own = {conv: [t[-1] for t in sorted(turns)] for conv, turns in own.items()}
    members = defaultdict(list)
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        base = conv - (conv % 5 if conv >= 0 else -(-conv % 5))
        whole = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append((conv, len(whole)))
    saves = {p: (len(m) - 1) * len(p[-1][1].encode()) if p else 0 for p, m in members.items()}
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += saves[p]
    found = []
    for p, m in members.items():
        ends = ",".join(str(c) for c, n in sorted(m) if n == len(p))
        parent = min(members[p[:-1]])[0] if p else None
        found.append((min(m)[0], len(p), parent, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=str)


def found(spark, rows):
    df = T.trie_nodes(spark.createDataFrame(rows, SCHEMA))
    assert df.columns == T.NODE_COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


def conversations(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        kind = rng.random()
        same = rng.randrange(3)
        for turn in range(rng.randrange(1, 14)):
            text = f"{same}-{turn}" if kind < 0.6 else rng.choice(["hé", "x", "", None, "yes"])
            rows.append((conv, rng.choice([turn, turn, None, 3]), rng.choice(["user", "user", None]) if kind > 0.5 else "user", text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    rows = conversations(seed) + [(None, 1, "user", "nobody"), (-7, 0, "a", "b"), (-5, 0, "a", "c"), (2**40, 1, None, None)]
    assert found(spark, rows) == brute(rows)


def test_a_shared_conversation_over_many_ranges_and_one_long_conversation(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 300) for t in range(4)]
    rows += [(1_000, t, "user", f"turn {t % 9}") for t in range(700)] + [(7, 9, "user", "again")] * 5
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert found(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_single_conversations_and_conversations_without_turns(spark):
    alone = [(5, t, "u", f"{t}") for t in range(12)]
    assert found(spark, alone) == brute(alone)
    # an absent first conversation and at most h turns of its own leave none
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in range(1, 40) if c % 5}
    c = next(c for c, n in h.items() if n > 2)
    assert found(spark, [(c, 1, "u", "x")]) == brute([(c, 1, "u", "x")]) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    assert found(spark, [(None, 1, "u", "x")]) == [] and spark.createDataFrame([], SCHEMA).isEmpty()
    assert found(spark, []) == []


def test_tree_is_balanced_and_ordered():
    n = 1 << 12
    order = list(T.medians(n))
    assert sorted(order) == list(range(n))
    tree = T.SearchTree()
    for k in order:
        tree.insert([k, 0], [1, 1], 1, k)
    depth, level = 0, [tree.down[0]]
    while level := [x for at in level for x in (tree.less[at], tree.more[at]) if x]:
        depth += 1
    assert depth <= 12
    assert [tree.turn[node] for node, _, d in tree.preorder() if d == 1] == list(range(n))


def test_other_columns_and_long_texts(spark):
    rows = [(1, 1, "u", "x" * 3_000_000), (1, 2, "u", ""), (2, 1, "u", "x" * 3_000_000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("size", "rank", "part", "row", "key", "digest", "n_convs")})
    assert sorted(map(tuple, T.trie_nodes(df).collect()), key=str) == brute(rows)
