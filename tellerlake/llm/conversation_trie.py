"""The prefix trie of conversations: which share their first turns, and what that saves.

Every conversation is rebuilt: it takes the first h turns of the first conversation of its
group of five, and then its own turns after its first h. Nodes of the trie are the distinct
sequences of first turns.

Turns are dictionary-encoded in two steps: as 128 bits of a SHA-256 of role and text, which
is all that is shuffled of them, and inside a task as dense numbers in the same order.
Conversations are sorted by sequence and id over all tasks, so each task has a range of the
trie. It builds a ternary search tree over the numbers, by inserting medians first, and goes
through it without recursion, adding up members, leaves and savings. Only the nodes above a
range's first and last sequence can go on in another range. They are merged by the hash of
their path; then one pass in depth-first order, which holds one path, adds up what lies below
them. That pass gets two paths for each range, whatever the number of conversations.

Scale: a conversation may hold a third of all turns. Its turns are numbered in ranges, with
the counts of earlier ranges added, and are not gathered: turns deeper than any other
conversation is long belong to it alone, and their nodes come from their rows. The sequence
of a conversation up to there is one row, 20 bytes a turn. A first turn, or a whole
conversation, that a third share is spread by the id behind the sequence. The ids that end at
such a node are hashed one after the other, as the digest asks for, from pieces that ranges
prepare; they stream through the task and are never gathered.

Defined results: a null conversation id is no conversation; null role and text are empty; a
null turn comes first; equal turns are ordered by the hash of role and text, and rows that
repeat are turns of their own; a conversation may have no turn after rebuilding and is a
member of the root then; an empty table gives no node. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellerlake.llm.shared import quoted, written

GROUP = 5
MOST_HEAD = 9  # h is below this
#: Ids in one piece of a boundary node's digest.
PIECE_IDS = 50_000

NODE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]

_PARTS = (
    "kind string, key binary, parent_key binary, shard long, place long, size long, conv_id long, depth long, "
    "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"
)
_MERGED = (
    "key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
_NOTHING = hashlib.sha256(b"").hexdigest()


# --- rebuilding conversations -----------------------------------------------------

def head_length(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % MOST_HEAD).cast("int")


def numbered_turns(rows: DataFrame) -> DataFrame:
    """conv_id, rank (from 1), digest, size of every turn.

    Rows are dealt out by range, so the turns of one conversation can be in many tasks; each
    numbers its own and adds how many the earlier ones have.
    """
    order = [F.asc_nulls_first("turn"), F.asc("digest"), F.asc("row")]
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange("conv_id", *order)
    dealt = written(dealt.withColumn("part", F.spark_partition_id()), "turns")
    own = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(*order))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("part", "conv_id").agg(F.count("*").alias("n"))
    before = counts.select("part", "conv_id", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = dealt.withColumn("own", own).join(before, ["part", "conv_id"])
    return ranked.select("conv_id", (F.col("own") + F.col("before")).alias("rank"), "digest", "size")


def _in_order(condition: Column) -> Column:
    taken = F.collect_list(F.when(condition, F.struct("rank", "digest", "size")))
    return F.transform(F.array_sort(taken), lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size")))


def rebuilt(ranked: DataFrame) -> DataFrame:
    """conv_id, heads (turns from its group's first conversation), own turns after those."""
    heads = ranked.where((F.col("conv_id") % GROUP == 0) & (F.col("rank") < MOST_HEAD)).groupBy("conv_id").agg(
        _in_order(F.lit(True)).alias("first_turns")
    )
    convs = ranked.groupBy("conv_id").agg(F.max("rank").alias("n_own")).withColumn("h", head_length(F.col("conv_id")))
    heads = heads.select(F.col("conv_id").alias("base"), "first_turns")
    met = convs.join(heads, F.col("conv_id") - F.col("conv_id") % GROUP == F.col("base"), "left")
    head = F.when(F.col("h") > 0, F.slice("first_turns", 1, F.greatest("h", F.lit(1))))
    none = F.array().cast("array<struct<digest:binary,size:int>>")
    met = met.select("conv_id", "h", "n_own", F.coalesce(head, none).alias("head"))
    return met.withColumn("total", F.size("head") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0)))


def sequences(ranked: DataFrame, convs: DataFrame, depth: int) -> DataFrame:
    """conv_id, digests, sizes, total: the first `depth` turns of every rebuilt conversation."""
    wanted = (F.col("rank") > head_length(F.col("conv_id"))) & (F.col("rank") <= depth + MOST_HEAD)
    own = ranked.where(wanted).groupBy("conv_id").agg(_in_order(F.lit(True)).alias("own"))
    turns = F.slice(F.concat("head", F.coalesce("own", F.array().cast("array<struct<digest:binary,size:int>>"))), 1, depth)
    met = convs.join(own, "conv_id", "left").select("conv_id", "total", turns.alias("turns"))
    return met.select("conv_id", "total", F.col("turns.digest").alias("digests"), F.col("turns.size").alias("sizes"))


# --- the tree of one range, inside a task -----------------------------------------

class SearchTree:
    """A ternary search tree over sequences of turn numbers; node 0 is the root of the trie."""

    def __init__(self):
        self.turn, self.less, self.down, self.more = [-1], [0], [0], [0]
        self.n, self.least, self.size = [0], [None], [0]
        self.ends: list[tuple[int, int] | None] = [None]
        self.goes_on = [0]

    def _new(self, turn: int, size: int) -> int:
        for values, value in (
            (self.turn, turn), (self.less, 0), (self.down, 0), (self.more, 0), (self.n, 0), (self.least, None),
            (self.size, size), (self.ends, None), (self.goes_on, 0),
        ):
            values.append(value)
        return len(self.turn) - 1

    def insert(self, turns, sizes, count: int, least: int) -> int:
        """Add `count` members with the least id `least`; the node where they end."""
        node = 0
        self._count(node, count, least)
        for turn, size in zip(turns, sizes):
            side, above, at = self.down, node, self.down[node]
            while at and self.turn[at] != turn:
                side, above = (self.less if turn < self.turn[at] else self.more), at
                at = side[at]
            if not at:
                at = side[above] = self._new(turn, size)
            node = at
            self._count(node, count, least)
        return node

    def _count(self, node: int, count: int, least: int) -> None:
        self.n[node] += count
        if self.least[node] is None or least < self.least[node]:
            self.least[node] = least

    def path(self, turns) -> list[int]:
        found = [0]
        for turn in turns:
            at = self.down[found[-1]]
            while self.turn[at] != turn:
                at = self.less[at] if turn < self.turn[at] else self.more[at]
            found.append(at)
        return found

    def preorder(self) -> list[tuple[int, int, int]]:
        """node, parent, depth; children in the order of their turns."""
        found, stack = [(0, -1, 0)], [(self.down[0], 0, 1, False)]
        while stack:
            node, parent, depth, passed = stack.pop()
            if not node:
                continue
            if passed:
                found.append((node, parent, depth))
                stack.append((self.down[node], node, depth + 1, False))
            else:
                stack += [(self.more[node], parent, depth, False), (node, parent, depth, True), (self.less[node], parent, depth, False)]
        return found


def medians(n: int) -> Iterator[int]:
    """0 to n - 1, the middle of every range before its halves."""
    ranges = [(0, n)]
    for lo, hi in ranges:
        if lo < hi:
            middle = (lo + hi) // 2
            yield middle
            ranges += [(lo, middle), (middle + 1, hi)]


def _child_key(key: bytes, digest: bytes) -> bytes:
    return hashlib.sha256(key + digest).digest()[:16]


def _joined(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def range_parts(table: pa.Table, shard: int) -> Iterator[dict]:
    """Finished nodes of a sorted range, its boundary nodes, and ids that end at those."""
    ids = table["conv_id"].to_numpy()
    totals = table["total"].to_numpy()
    lists = table["digests"].combine_chunks()
    sizes = table["sizes"].combine_chunks().flatten().to_numpy()
    starts = lists.offsets.to_numpy()
    coded = lists.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    in_order = sorted(range(len(names)), key=names.__getitem__)
    number = np.empty(len(names), dtype=np.int64)
    number[in_order] = np.arange(len(names))
    turns = number[coded.indices.to_numpy()] if names else np.empty(0, dtype=np.int64)
    digest_of = [names[k] for k in in_order]

    def span(row: int) -> slice:
        return slice(starts[row] - starts[0], starts[row + 1] - starts[0])

    def sequence(row: int) -> list[int]:
        return turns[span(row)].tolist()

    # groups of equal sequences; a conversation cut at the depth limit goes on below
    groups, before = [], None
    for row in range(len(ids)):
        now = sequence(row)
        if now != before or totals[row] > len(now):
            groups.append([row, row])
            before = now if totals[row] <= len(now) else None
        groups[-1][1] = row + 1
    tree = SearchTree()
    for middle in medians(len(groups)):
        row, end = groups[middle]
        now = sequence(row)
        node = tree.insert(now, sizes[span(row)].tolist(), end - row, int(ids[row]))
        if totals[row] > len(now):
            tree.goes_on[node] = 1
        else:
            tree.ends[node] = (row, end)

    order = tree.preorder()
    keys: dict[int, bytes] = {}
    for row in (0, len(ids) - 1):
        key = b""
        for node in tree.path(sequence(row)):
            key = _child_key(key, digest_of[tree.turn[node]]) if node else b""
            keys[node] = key
    children = list(tree.goes_on)
    leaves, saved = list(tree.goes_on), [0] * len(tree.turn)
    for node, parent, _ in reversed(order):
        if node in keys:
            continue
        if not children[node]:
            leaves[node] = 1
        saved[node] += (tree.n[node] - 1) * tree.size[node]
        children[parent] += 1
        leaves[parent] += leaves[node]
        saved[parent] += saved[node]
    for place, (node, parent, depth) in enumerate(order):
        ended = ids[slice(*tree.ends[node])] if tree.ends[node] else ids[:0]
        row = {
            "conv_id": tree.least[node], "depth": depth, "n_convs": tree.n[node], "n_children": children[node],
            "n_leaves": leaves[node], "saved_tokens": saved[node], "size": tree.size[node],
        }
        if node in keys:
            yield row | {"kind": "boundary", "key": keys[node], "parent_key": keys.get(parent), "shard": shard, "place": place}
            for k in range(0, len(ended), PIECE_IDS):
                yield {"kind": "ends", "key": keys[node], "shard": shard, "place": k, "ends": _joined(ended[k:k + PIECE_IDS])}
        else:
            above = {"parent_key": keys[parent]} if parent in keys else {"parent_conv_id": tree.least[parent]}
            yield row | above | {"kind": "node", "ends": hashlib.sha256(_joined(ended).encode()).hexdigest()}


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


_TYPES = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64()}


def _schema(fields: str) -> pa.Schema:
    return pa.schema([(name, _TYPES[kind]) for name, kind in (field.split() for field in fields.split(", "))])


def _range_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if b.num_rows]
    if held:
        yield from _batches(range_parts(pa.Table.from_batches(held), TaskContext.get().partitionId()), _schema(_PARTS))


# --- boundary nodes ---------------------------------------------------------------

def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each key's pieces, which come in order."""

    def digests() -> Iterator[dict]:
        key = state = None
        for batch in batches:
            for now, ends in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
                if now == key:
                    state.update(b",")
                else:
                    if state:
                        yield {"key": key, "ends_sha256": state.hexdigest()}
                    key, state = now, hashlib.sha256()
                state.update(ends.encode())
        if state:
            yield {"key": key, "ends_sha256": state.hexdigest()}

    yield from _batches(digests(), _schema("key binary, ends_sha256 string"))


def folded(rows: Iterator[dict]) -> Iterator[dict]:
    """Boundary nodes in depth-first order, with what lies below each added up."""
    path: list[dict] = []

    def close() -> dict:
        node = path.pop()
        node["n_leaves"] = node["n_leaves"] if node["n_children"] else 1
        node["saved_tokens"] += (node["n_convs"] - 1) * node.pop("size")
        if path:
            path[-1]["n_leaves"] += node["n_leaves"]
            path[-1]["saved_tokens"] += node["saved_tokens"]
        return node

    for row in rows:
        while len(path) > row["depth"]:
            yield close()
        row["parent_conv_id"] = path[-1]["conv_id"] if path else None
        if path:
            path[-1]["n_children"] += 1
        path.append(row)
    while path:
        yield close()


def _folded_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _batches(folded(row for batch in batches for row in batch.to_pylist()), _schema(_MERGED))


def merged_boundary(parts: DataFrame) -> DataFrame:
    """The boundary nodes of all ranges, each once."""
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    nodes = parts.where("kind = 'boundary'").groupBy("key").agg(
        F.min(F.struct("shard", "place")).alias("at"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"),
        F.min("size").alias("size"), *sums,
    )
    pieces = parts.where("kind = 'ends'").select("key", "shard", "place", "ends")
    digests = pieces.repartition("key").sortWithinPartitions("key", "shard", "place").select("key", "ends")
    digests = digests.mapInArrow(_digest_rows, "key binary, ends_sha256 string")
    whole = nodes.join(digests, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NOTHING)))
    return whole.repartition(1).sortWithinPartitions("at").drop("at").mapInArrow(_folded_rows, _MERGED)


# --- all nodes --------------------------------------------------------------------

def _lone_nodes(ranked: DataFrame, conv_id: int, h: int, n_head: int, total: int, depth: int) -> DataFrame:
    """Nodes below `depth` of the one conversation that goes deeper than all others."""
    at = F.col("rank") - h + n_head
    own = ranked.where((F.col("conv_id") == conv_id) & (F.col("rank") > h) & (at > depth)).select("conv_id", at.alias("depth"))
    ends = F.when(F.col("depth") == total, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(F.lit(_NOTHING))
    one = F.lit(1).cast("long")
    return own.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), F.col("conv_id").alias("parent_conv_id"), one.alias("n_convs"),
        (F.col("depth") < total).cast("long").alias("n_children"), one.alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"), ends.alias("ends_sha256"),
    )


def trie_nodes(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each node of the trie of rebuilt conversations."""
    role_text = F.coalesce(F.col(quoted(role)), F.lit("")), F.coalesce(F.col(quoted(text)), F.lit(""))
    marked = F.concat(F.octet_length(role_text[0]).cast("string"), F.lit(":"), *role_text)
    digest = F.substring(F.unhex(F.sha2(marked.cast("binary"), 256)), 1, 16)
    rows = turns.where(F.col(quoted(conv_id)).isNotNull()).select(
        F.col(quoted(conv_id)).cast("long").alias("conv_id"), F.col(quoted(turn)).alias("turn"),
        digest.alias("digest"), F.octet_length(role_text[1]).alias("size"),
    )
    ranked = written(numbered_turns(rows), "ranked-turns")
    convs = written(rebuilt(ranked), "rebuilt")
    longest = convs.orderBy(F.desc("total"), "conv_id").select("conv_id", "h", F.size("head").alias("n_head"), "total").head(2)
    # one turn more than the second longest has, where the longest is alone; heads are never deeper
    depth = max(MOST_HEAD, int(longest[1]["total"]) + 1 if len(longest) > 1 else 1)
    sorted_rows = sequences(ranked, convs, depth).repartitionByRange("digests", "conv_id").sortWithinPartitions("digests", "conv_id")
    parts = written(sorted_rows.mapInArrow(_range_rows, _PARTS), "trie-parts")
    merged = written(merged_boundary(parts), "trie-boundary")
    nodes = parts.where("kind = 'node'").withColumnRenamed("ends", "ends_sha256")
    inner = nodes.where("parent_key IS NULL").select(NODE_COLUMNS)
    above = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    outer = nodes.where("parent_key IS NOT NULL").join(above, "parent_key").withColumn("parent_conv_id", F.col("above")).select(NODE_COLUMNS)
    found = inner.unionByName(outer).unionByName(merged.select(NODE_COLUMNS))
    if longest and longest[0]["total"] > depth:
        lone = longest[0]
        found = found.unionByName(_lone_nodes(ranked, lone["conv_id"], lone["h"], lone["n_head"], int(lone["total"]), depth))
    return found


_CRC_BYTE = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
_CRC = f"xor(list_reduce([4294967295] || list_transform(range(1, len(s) + 1), lambda i: ascii(s[i])::BIGINT), lambda c, b: {_CRC_BYTE}), 4294967295)"

ORACLE = f"""
WITH raw AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
t AS (
  SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS r
  FROM raw),
named AS (SELECT DISTINCT c, c::VARCHAR AS s FROM t),
conv AS (SELECT c, {_CRC} % {MOST_HEAD} AS h FROM named),
turns AS (
  SELECT conv.c, false AS own, r, role, text FROM conv JOIN t ON t.c = conv.c - conv.c % {GROUP} AND r <= h
  UNION ALL SELECT conv.c, true, r, role, text FROM conv JOIN t ON t.c = conv.c AND r > h),
seq AS (
  SELECT conv.c, coalesce(list(struct_pack(role := role, text := text) ORDER BY own, r) FILTER (WHERE r IS NOT NULL), []) AS s
  FROM conv LEFT JOIN turns ON conv.c = turns.c GROUP BY 1),
prefix AS (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM seq),
node AS (
  SELECT s[1:d] AS p, d, min(c) AS conv_id, count(*) AS n,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(s) = d), '')) AS ends
  FROM prefix GROUP BY 1, 2),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1),
full_node AS (
  SELECT node.*, coalesce(n_children, 0) AS n_children,
    CASE WHEN d > 0 THEN (n - 1) * strlen(node.p[d].text) ELSE 0 END AS saves
  FROM node LEFT JOIN kids ON node.p = kids.p),
below AS (SELECT p, unnest(range(0, d + 1)) AS k, n_children, saves FROM full_node),
sums AS (SELECT p[1:k] AS p, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saves)::BIGINT AS saved FROM below GROUP BY 1)
SELECT a.conv_id, a.d AS depth, b.conv_id AS parent_conv_id, a.n AS n_convs, a.n_children, n_leaves, saved AS saved_tokens, a.ends AS ends_sha256
FROM full_node a JOIN sums ON a.p = sums.p LEFT JOIN node b ON a.d > 0 AND b.p = a.p[1:a.d - 1]
"""
