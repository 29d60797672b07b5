import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tellerlake.operators import graph


def paths_of(spark, edges):
    rows = [(f"T{i:04d}", s, d, i, "TRANSFER", 10.0 + i, 0.0, f) for i, (s, d, f) in enumerate(edges)]
    return spark.createDataFrame(
        rows, "txnId string, src string, dst string, step int, type string, "
        "amount double, newbalanceDest double, isFraud int",
    )


def rings_by_hand(edges, min_shared):
    receivers, fraud = {}, {}
    for s, d, f in edges:
        receivers.setdefault(d, set()).add(s)
        fraud[s, d] = max(f, fraud.get((s, d), 0))
    found = {}
    for a, b in combinations(sorted(receivers), 2):
        shared = sorted(s for s in receivers[a] & receivers[b] if fraud[s, a] or fraud[s, b])
        if len(shared) >= min_shared:
            found[a, b] = (len(shared), shared[:5])
    return found


def layering_by_hand(edges, min_in, min_out):
    found = {}
    for m in {d for _, d, _ in edges}:
        hops = [
            (edges[i][0], edges[j][1])
            for i in range(len(edges)) if edges[i][1] == m
            for j in range(len(edges)) if edges[j][0] == m and i != j
        ]
        sources = {a for a, c in hops if a != c}
        targets = {c for a, c in hops if a != c}
        if len(sources) >= min_in and len(targets) >= min_out:
            found[m] = (len(sources), len(targets))
    return found


def random_edges(seed, hub):
    """A small graph; with ``hub`` one sender makes a third of all payments."""
    rng = random.Random(seed)
    accounts = [f"A{i:02d}" for i in range(14)]
    edges = []
    for _ in range(90):
        src = "A00" if hub and rng.random() < 0.34 else rng.choice(accounts)
        edges.append((src, rng.choice(accounts), int(rng.random() < 0.25)))
    return edges


@pytest.mark.parametrize("seed, hub", [(1, False), (2, True), (3, True)])
@pytest.mark.parametrize("min_shared", [2, 3])
def test_rings_match_all_pairs(spark, seed, hub, min_shared):
    edges = random_edges(seed, hub)
    got = {
        (r.mule1, r.mule2): (r.sharedSenderCount, r.sampleSenders)
        for r in graph.fraud_rings(paths_of(spark, edges), min_shared, k=None).collect()
    }
    assert got == rings_by_hand(edges, min_shared)


def test_rings_when_two_receivers_share_their_busiest_sender(spark):
    edges = [("H", f"R{i}", 0) for i in range(6)] + [("S", "R0", 1), ("S", "R1", 0), ("H", "R0", 1)]
    got = graph.fraud_rings(paths_of(spark, edges)).collect()
    assert [(r.mule1, r.mule2, r.sharedSenderCount) for r in got] == [("R0", "R1", 2)]


def test_one_shared_sender_or_no_fraud_is_no_ring(spark):
    one_shared = [("S", "A", 1), ("S", "B", 1), ("T", "A", 1)]
    no_fraud = [(s, d, 0) for s in "ST" for d in "AB"]
    one_side = [("S", "A", 1), ("S", "B", 0), ("T", "A", 0), ("T", "B", 1)]
    assert graph.fraud_rings(paths_of(spark, one_shared)).count() == 0
    assert graph.fraud_rings(paths_of(spark, no_fraud)).count() == 0
    assert graph.fraud_rings(paths_of(spark, one_side)).count() == 1


def test_ring_sample_is_the_first_five_senders(spark):
    edges = [(f"S{i}", d, 1) for i in range(9) for d in "AB"]
    row = graph.fraud_rings(paths_of(spark, edges)).first()
    assert row.sharedSenderCount == 9 and row.sampleSenders == [f"S{i}" for i in range(5)]


def test_top_rings_are_the_largest(spark):
    edges = random_edges(5, True)
    ranked = sorted(rings_by_hand(edges, 2).items(), key=lambda kv: (-kv[1][0], kv[0]))[:4]
    got = graph.fraud_rings(paths_of(spark, edges), k=4).collect()
    assert [((r.mule1, r.mule2), r.sharedSenderCount) for r in got] == [(p, n) for p, (n, _) in ranked]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("limits", [(3, 2), (2, 2), (4, 3)])
def test_layering_matches_two_hop_paths(spark, seed, limits):
    edges = random_edges(seed, seed == 2)
    found = graph.layering_accounts(paths_of(spark, edges), *limits, k=None).collect()
    got = {r.layeringAccount: (r.inboundSources, r.onwardTargets) for r in found}
    assert got == layering_by_hand(edges, *limits)


def test_exact_shortcuts_refuse_limits_they_do_not_hold_for(spark):
    p = paths_of(spark, [("A", "B", 1)])
    with pytest.raises(ValueError):
        graph.fraud_rings(p, min_shared=1)
    with pytest.raises(ValueError):
        graph.layering_accounts(p, min_in=1)


def test_mules_need_four_senders(spark):
    edges = [(f"S{i}", "M1", int(i == 0)) for i in range(4)] + [("S0", "M1", 1)]
    edges += [(f"S{i}", "C2", 1) for i in range(3)]
    rows = graph.money_mules(paths_of(spark, edges)).collect()
    assert [(r.muleAccount, r.accountType, r.distinctSenders, r.inboundTxns, r.fraudulentInbound)
            for r in rows] == [("M1", "MERCHANT", 4, 5, 2)]
    assert rows[0].totalInboundAmount == 10.0 + 11 + 12 + 13 + 14


def test_upsert_is_idempotent_and_updates_win(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    new = spark.createDataFrame([("b", 0), ("c", 5), ("c", 4)], "id string, v int")
    once = graph.upsert(old, new, "id")
    twice = graph.upsert(once, new, "id")
    assert sorted(once.collect()) == sorted(twice.collect()) == [("a", 1), ("b", 0), ("c", 5)]


def test_edges_without_both_endpoints_are_dropped(spark):
    edges = spark.createDataFrame(
        [("a", "t1", 1.0), ("a", "t1", 1.0), ("x", "t1", 2.0), ("a", "t9", 3.0)],
        "accountId string, txnId string, amount double",
    )
    accounts = spark.createDataFrame([("a",)], "accountId string")
    txns = spark.createDataFrame([("t1",)], "txnId string")
    assert graph.valid_edges(edges, accounts, txns).collect() == [("a", "t1", 1.0)]


def test_long_keys_are_not_cut(spark):
    ids = spark.createDataFrame([(7,), (12345678,)], "txnId bigint").select(graph.txn_key())
    assert [r[0] for r in ids.collect()] == ["TXN000007", "TXN12345678"]


def test_stored_edges_join_back_to_the_same_paths(spark, txns):
    df = txns(*[{"nameOrig": f"C{i}", "nameDest": f"M{i % 3}", "step": i} for i in range(9)])
    df = df.withColumn("txnId", F.col("step").cast("bigint"))
    joined = graph.graph_paths(graph.sent_edges(df), graph.received_edges(df))
    direct = graph.payments(df)
    assert sorted(joined.select(direct.columns).collect()) == sorted(direct.collect())
