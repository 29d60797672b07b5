"""Money flow between accounts.

A transaction has one sender and one receiver, so it is stored as the path
``(account)-[SENT]->(transaction)-[RECEIVED_BY]->(account)`` and read back as one
``payments`` row (txnId, src, dst, ...). The pattern queries below work on payments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellerlake import schemas as S
from tellerlake.functions import rules
from tellerlake.functions.exact import money_sum
from tellerlake.operators.reports import distinct_accounts


# --- nodes and edges --------------------------------------------------------------

def txn_key(key: Column | str = "txnId") -> Column:
    """Transaction node id from a stable unique key of the source row.

    A running number would need a total order over the lake and would change whenever
    rows are added; a key from the data does neither.
    """
    digits = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.concat(F.lit("TXN"), F.lpad(digits, F.greatest(F.length(digits), F.lit(6)), "0"))


def account_nodes(txns: DataFrame) -> DataFrame:
    return distinct_accounts(txns).withColumn("accountType", rules.account_type("accountId"))


def transaction_nodes(txns: DataFrame, key: str = "txnId") -> DataFrame:
    return txns.select(txn_key(key).alias("txnId"), "step", "type", "amount", "isFraud")


def sent_edges(txns: DataFrame, key: str = "txnId") -> DataFrame:
    return txns.select(
        F.col("nameOrig").alias("accountId"), txn_key(key).alias("txnId"),
        "amount", F.col("step").alias("timestamp"), F.col("type").alias("transactionType"),
    )


def received_edges(txns: DataFrame, key: str = "txnId") -> DataFrame:
    return txns.select(
        txn_key(key).alias("txnId"), F.col("nameDest").alias("accountId"),
        "newbalanceDest", "isFraud",
    )


def graph_nodes(txns: DataFrame, key: str = "txnId") -> DataFrame:
    """Account and transaction nodes in one frame."""
    accounts = account_nodes(txns).select(
        F.col("accountId").alias("nodeId"), F.lit("Account").alias("label"), "accountType"
    )
    transactions = transaction_nodes(txns, key).select(
        F.col("txnId").alias("nodeId"), F.lit("Transaction").alias("label"),
        "step", "type", "amount", "isFraud",
    )
    return accounts.unionByName(transactions, allowMissingColumns=True)


def graph_edges(txns: DataFrame, key: str = "txnId") -> DataFrame:
    """SENT and RECEIVED_BY edges in one frame, both made in a single pass."""
    txn = txn_key(key)
    nothing = F.lit(None)
    sent = F.struct(
        F.col("nameOrig").alias("startId"), txn.alias("endId"), F.lit("SENT").alias("edgeType"),
        F.col("amount"), F.col("step").alias("timestamp"),
        F.col("type").alias("transactionType"),
        nothing.cast("double").alias("newbalanceDest"),
        nothing.cast("int").alias("isFraud"),
    )
    received = F.struct(
        txn.alias("startId"), F.col("nameDest").alias("endId"),
        F.lit("RECEIVED_BY").alias("edgeType"),
        nothing.cast("double").alias("amount"), nothing.cast("int").alias("timestamp"),
        nothing.cast("string").alias("transactionType"),
        F.col("newbalanceDest"), F.col("isFraud").alias("isFraud"),
    )
    return txns.select(F.inline(F.array(sent, received)))


def account_degrees(edges: DataFrame) -> DataFrame:
    """Edges that leave and reach each account, from ``graph_edges``."""
    is_sent = F.col("edgeType") == "SENT"
    account = F.when(is_sent, F.col("startId")).otherwise(F.col("endId"))
    return edges.groupBy(account.alias("accountId")).agg(
        F.count_if(is_sent).alias("sent"), F.count_if(~is_sent).alias("received")
    )


def payments(txns: DataFrame, key: str = "txnId") -> DataFrame:
    """Whole paths straight from transactions; no join is needed to walk them."""
    return txns.select(
        txn_key(key).alias("txnId"),
        F.col("nameOrig").alias("src"), F.col("nameDest").alias("dst"),
        "step", "type", "amount", "newbalanceDest", "isFraud",
    )


def graph_paths(sent: DataFrame, received: DataFrame) -> DataFrame:
    """Whole paths from stored edges: SENT joined to RECEIVED_BY on the transaction.

    The transaction key is unique on both sides, so the join cannot be skewed.
    """
    outgoing = sent.select(
        "txnId", F.col("accountId").alias("src"), "amount",
        F.col("timestamp").alias("step"), F.col("transactionType").alias("type"),
    )
    incoming = received.select("txnId", F.col("accountId").alias("dst"), "newbalanceDest", "isFraud")
    return outgoing.join(incoming, "txnId")


def upsert(existing: DataFrame | None, updates: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """Merge on a key: one row per key, an update replacing what was stored.

    Applying the same updates again changes nothing. If several updates share a key
    the greatest row wins, so the outcome does not depend on arrival order.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in updates.columns if c not in keys]

    def ranked(df: DataFrame, rank: int) -> DataFrame:
        return df.select(*keys, F.struct(F.lit(rank).alias("rank"), *rest).alias("row"))

    rows = ranked(updates, 1)
    if existing is not None:
        rows = rows.unionByName(ranked(existing, 0))
    newest = rows.groupBy(*keys).agg(F.max("row").alias("row"))
    return newest.select(*[c if c in keys else F.col(f"row.{c}").alias(c) for c in updates.columns])


def valid_edges(edges: DataFrame, accounts: DataFrame, txns: DataFrame) -> DataFrame:
    """Edges (accountId, txnId, ...) whose two endpoints both exist, one per endpoint pair."""
    known = edges.join(txns.select("txnId"), "txnId", "left_semi").join(
        accounts.select("accountId"), "accountId", "left_semi"
    )
    return upsert(None, known.select(edges.columns), ["accountId", "txnId"])


# --- patterns ---------------------------------------------------------------------

def mule_accounts(paths: DataFrame, min_senders: int = S.MULE_MIN_SENDERS) -> DataFrame:
    """Accounts paid by many different senders."""
    return (
        paths.groupBy(F.col("dst").alias("muleAccount"))
        .agg(
            F.count_distinct("src").alias("distinctSenders"),
            F.count(F.lit(1)).alias("inboundTxns"),
            money_sum("amount").alias("totalInboundAmount"),
            F.sum("isFraud").alias("fraudulentInbound"),
        )
        .where(F.col("distinctSenders") >= min_senders)
        .withColumn("accountType", rules.account_type("muleAccount"))
    )


def money_mules(
    paths: DataFrame, min_senders: int = S.MULE_MIN_SENDERS, k: int = 20
) -> DataFrame:
    """The ``k`` mule accounts with most fraud, then most senders, then lowest id."""
    return (
        mule_accounts(paths, min_senders)
        .orderBy(F.desc("fraudulentInbound"), F.desc("distinctSenders"), "muleAccount")
        .limit(k)
    )


#: Fraud edges of a sender that meet its other edges in one key.
CHUNK = 512


def _ring_candidates(links: DataFrame, min_shared: int) -> tuple[DataFrame, DataFrame]:
    """Each receiver's costliest sender, and receiver pairs with the senders they share
    beside these."""
    if min_shared < 2:
        raise ValueError("the prefix rule needs min_shared >= 2")
    fan_out = (
        links.groupBy("src")
        .agg(F.count(F.lit(1)).alias("receivers"), F.sum("fraud").alias("tainted"))
        .where((F.col("receivers") > 1) & (F.col("tainted") > 0))
        .select(
            "src", (F.col("receivers") * F.col("tainted")).alias("cost"),
            F.ceil(F.col("tainted") / CHUNK).cast("int").alias("chunks"),
        )
    )
    active = links.join(fan_out, "src")
    tops = (
        active.groupBy("dst")
        .agg(
            F.count(F.lit(1)).alias("senders"),
            F.max(F.struct("cost", "src", "fraud")).alias("top"),
        )
        .where(F.col("senders") >= min_shared)
        .select("dst", F.col("top.src").alias("topSrc"), F.col("top.fraud").alias("topFraud"))
    )
    rest = active.join(tops.select("dst", "topSrc"), "dst").where(F.col("src") != F.col("topSrc"))

    chunk = F.pmod(F.hash("dst"), F.col("chunks")).cast("int")
    tainted = rest.where(F.col("fraud") == 1).select("src", chunk.alias("chunk"), F.col("dst").alias("a"))
    every = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    other = rest.select("src", every.alias("chunk"), F.col("dst").alias("b"), "fraud")
    once = (F.col("a") != F.col("b")) & ((F.col("fraud") == 0) | (F.col("a") < F.col("b")))
    found = (
        tainted.join(other, ["src", "chunk"])
        .where(once)
        .groupBy(F.least("a", "b").alias("mule1"), F.greatest("a", "b").alias("mule2"))
        .agg(F.count(F.lit(1)).alias("found"))
    )
    return tops, found


def _ring_counts(links: DataFrame, min_shared: int) -> DataFrame:
    """(mule1, mule2, sharedSenderCount) for receiver pairs with enough shared senders.

    ``links`` has one row per (src, dst) with ``fraud`` = 1 if any payment was fraud. A
    sender counts for a pair if its payment to either side was fraud.

    Joining receivers on every common sender would pair up all customers of a large
    payer. Two exact reductions avoid that:

    * Prefix rule. Give each receiver its costliest sender (most pairs of a fraud edge
      with another edge, id as tie break) as ``top``. If two receivers share two or more
      senders, at least one of these is not the ``top`` of either: were both shared
      senders tops, each would be costlier than the other. Candidates are thus found
      without any receiver's top sender, which removes a payer that dominates the graph
      from the join, and the two tops are added afterwards by looking up the single edge
      in question.
    * A sender counts only through a fraud edge, so senders without one, or with a
      single receiver, are left out first, and the join runs fraud edges against all.

    A sender that stays costly is cut: its fraud edges are dealt to chunks of about
    ``CHUNK`` edges, and each chunk meets the sender's edges in a key of its own.
    """
    tops, found = _ring_candidates(links, min_shared)


    def side(n: int) -> DataFrame:
        return tops.select(
            F.col("dst").alias(f"mule{n}"),
            F.col("topSrc").alias(f"top{n}"), F.col("topFraud").alias(f"topFraud{n}"),
        )

    def reached(by: int, to: int) -> DataFrame:
        return links.select(
            F.col("src").alias(f"top{by}"), F.col("dst").alias(f"mule{to}"),
            F.col("fraud").alias(f"reach{by}"),
        )

    def counts(n: int) -> Column:
        """1 if the top sender of side n also pays the other side and fraud is involved."""
        qualifies = F.greatest(F.col(f"topFraud{n}"), F.col(f"reach{n}")) == 1
        return F.when(F.col(f"reach{n}").isNotNull() & qualifies, 1).otherwise(0)

    shared = (
        F.col("found") + counts(1)
        + F.when(F.col("top1") != F.col("top2"), counts(2)).otherwise(0)
    )
    return (
        found.join(side(1), "mule1")
        .join(side(2), "mule2")
        .join(reached(1, 2), ["top1", "mule2"], "left")
        .join(reached(2, 1), ["top2", "mule1"], "left")
        .select("mule1", "mule2", shared.alias("sharedSenderCount"))
        .where(F.col("sharedSenderCount") >= min_shared)
    )


def fraud_rings(
    paths: DataFrame, min_shared: int = S.RING_MIN_SHARED, k: int | None = 15, samples: int = 5
) -> DataFrame:
    """Receiver pairs fed by the same senders, with the first few of these senders.

    ``k=None`` returns every pair. Only the returned pairs look up their senders, and
    the ranking limit keeps at most ``samples`` of them per pair before the shuffle.
    """
    # Null ends are dropped here rather than by each join below, so that all uses of
    # the links have the same plan and share one shuffle.
    both_ends = F.col("src").isNotNull() & F.col("dst").isNotNull()
    links = paths.where(both_ends).groupBy("src", "dst").agg(F.max("isFraud").alias("fraud"))
    rings = _ring_counts(links, min_shared)
    if k is not None:
        rings = rings.orderBy(F.desc("sharedSenderCount"), "mule1", "mule2").limit(k)

    def feeding(n: int) -> DataFrame:
        return links.select(
            F.col("dst").alias(f"mule{n}"), "src", F.col("fraud").alias(f"fraud{n}")
        )

    by_name = Window.partitionBy("mule1", "mule2").orderBy("src")
    sample = (
        rings.join(feeding(1), "mule1")
        .join(feeding(2), ["mule2", "src"])
        .where(F.greatest("fraud1", "fraud2") == 1)
        .withColumn("nth", F.row_number().over(by_name))
        .where(F.col("nth") <= samples)
        .groupBy("mule1", "mule2", "sharedSenderCount")
        .agg(F.sort_array(F.collect_list("src")).alias("sampleSenders"))
    )
    return sample.orderBy(F.desc("sharedSenderCount"), "mule1", "mule2")


def top_fraud_paths(paths: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` largest confirmed-fraud payments, end to end."""
    return (
        paths.where(F.col("isFraud") == 1)
        .select(
            F.col("src").alias("fromAccount"),
            F.col("txnId").alias("transaction"),
            F.col("type").alias("transactionType"),
            "amount", "step",
            F.col("dst").alias("toAccount"),
            rules.account_type("dst").alias("destType"),
        )
        .orderBy(F.desc("amount"), "transaction")
        .limit(k)
    )


def layering_accounts(
    paths: DataFrame,
    min_in: int = S.LAYERING_MIN_IN,
    min_out: int = S.LAYERING_MIN_OUT,
    k: int | None = 15,
) -> DataFrame:
    """Accounts that pass money on: many sources in, several targets out.

    The pattern asks for source <> target on the two-hop path. With more than two
    sources and more than one target, every source has a different target and every
    target a different source, so counting the distinct neighbours on each side gives
    the same numbers without walking the in x out paths of a hub.
    """
    if min_in < 2 or min_out < 2:
        raise ValueError("counting neighbours needs min_in >= 2 and min_out >= 2")
    links = paths.select("src", "dst").distinct()
    ends = F.array(
        F.struct(F.col("dst").alias("account"), F.lit(1).alias("i"), F.lit(0).alias("o")),
        F.struct(F.col("src").alias("account"), F.lit(0).alias("i"), F.lit(1).alias("o")),
    )
    found = (
        links.select(F.inline(ends))
        .groupBy(F.col("account").alias("layeringAccount"))
        .agg(F.sum("i").alias("inboundSources"), F.sum("o").alias("onwardTargets"))
        .where((F.col("inboundSources") >= min_in) & (F.col("onwardTargets") >= min_out))
    )
    if k is None:
        return found
    order = [F.desc("inboundSources"), F.desc("onwardTargets"), "layeringAccount"]
    return found.orderBy(*order).limit(k)


def graph_inventory(
    accounts: DataFrame, txn_nodes: DataFrame, sent: DataFrame, received: DataFrame
) -> DataFrame:
    """Node and edge counts in one row; each count is a scalar subquery."""
    rows = F.count(F.lit(1))
    nodes = txn_nodes.agg(
        rows.alias("transactions"),
        F.coalesce(F.sum("isFraud"), F.lit(0).cast("bigint")).alias("fraudTransactions"),
    )
    counted = nodes.select(
        accounts.agg(rows).scalar().alias("accounts"),
        "transactions", "fraudTransactions",
        sent.agg(rows).scalar().alias("sentEdges"),
        received.agg(rows).scalar().alias("receivedEdges"),
    )
    return counted.withColumn("totalEdges", F.col("sentEdges") + F.col("receivedEdges"))
