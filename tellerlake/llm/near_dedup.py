"""Near-duplicate documents: MinHash with tensored banding, links confirmed on full sets.

A document is the set of its five-word shingles. There are two small collections of half
keys, each of `HALVES` pairs of minhashes. A table of the index is a pair (left half, right
half), so 2 * 16 half keys, made from 64 minhashes, stand for 16 * 16 = 256 tables of four
minhashes. Two documents meet in some table if and only if they agree in a left and in a
right half; a pair with similarity 0.75 misses that with probability 4e-6.

1. Documents with the same set are one class; the set's hash stands for it.
2. Half keys that only one class has are dropped, and with them all classes that have no
   shared left or no shared right half.
3. Members of a left half meet. Those that also agree in a right half, whose sizes allow
   the similarity and whose 64 minhashes agree in 32 or more (at 0.75 missed with
   probability 1e-5) are candidates. A half with many members is cut into blocks, and the
   pairs of blocks are dealt to tasks.
4. Links are confirmed by intersecting the full sets, and classes joined to components.
   The pairs of a large group are not emitted: each class first names its closest
   candidates only. Classes that then still have a candidate in another component go to
   their cells once more, with their sets; there every such candidate is tested, and links
   that join components are all that comes out. So no link between components is lost.

Hashes have 64 bits, that of a set names its class. Defined results: a text without words, or null, has no shingles and
is linked with nothing; one with fewer than five words is one shingle; a null id takes part
in no link, its component is null and it stays; rows that repeat an id with the same text
get the same result; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerlake.llm.components import components, joined_components
from tellerlake.llm.shared import quoted, written
from tellerlake.llm.shingles import shingle_sets, slices

PERCENT = 75
CELL = ["half", "key", "x", "y"]
MEMBER = ["id", "n", "sig", *CELL[:2], "block", *CELL[2:], "label"]
HALVES, WIDTH = 16, 2
HASHES = 2 * HALVES * WIDTH
AGREE = HASHES // 2
#: Members of a block of a left half, and shingles of their sets together; pairs of blocks
#: are compared in memory.
BLOCK, BLOCK_HASHES = 2048, 4 << 20
#: Candidates that a class names in the first round; the second tests all that are left.
FIRST = 8

_RNG = np.random.default_rng(7)
_FLIP = _RNG.integers(0, 1 << 63, size=HASHES, dtype=np.uint64)
_MULTIPLY = _RNG.integers(0, 1 << 63, size=HASHES, dtype=np.uint64) | np.uint64(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The upper 32 bits of the minhashes of sets that are not empty, a row for each."""
    out = np.empty((len(sets), HASHES), dtype=np.uint32)
    if not sets:
        return out
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    scratch = np.empty_like(flat)
    with np.errstate(over="ignore"):
        for j in range(HASHES):
            np.bitwise_xor(flat, _FLIP[j], out=scratch)
            np.multiply(scratch, _MULTIPLY[j], out=scratch)
            out[:, j] = np.minimum.reduceat(scratch, starts) >> np.uint64(32)
    return out


def _node(shingles: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles, seed=len(shingles)))))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, text_hash, n, node, sig: node stands for the set, null where it is empty."""
    for batch in batches:
        for start, part in slices(batch.column("text")):
            sets = shingle_sets(part)
            sigs = iter(signatures([s for s in sets if len(s)]))
            rows = [(len(s), _node(s), next(sigs).tobytes()) if len(s) else (0, None, None) for s in sets]
            n, nodes, sig = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(start, len(part)), batch.column("text_hash").slice(start, len(part)),
                 pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sig, pa.binary())],
                names=["id", "text_hash", "n", "node", "sig"],
            )


def _half_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, n, half, key: 32 rows for each class; halves from 16 on are right ones."""
    for batch in batches:
        sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), dtype=np.uint64)  # two minhashes in one
        ids = np.repeat(batch.column("id").to_numpy(), 2 * HALVES)
        halves = np.tile(np.arange(2 * HALVES, dtype=np.int32), batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(np.repeat(batch.column("n").to_numpy(), 2 * HALVES)), pa.array(halves),
             pa.array(sig.view(np.int64))],
            names=["id", "n", "half", "key"],
        )


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Runs of rows with equal `names`, from sorted batches; a run may go over batches."""
    parts: list[dict[str, np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = {
            name: np.frombuffer(b"".join(batch.column(name).to_pylist()), dtype=np.uint32).reshape(-1, HASHES)
            if name == "sig" else batch.column(name).to_numpy(zero_copy_only=False)
            for name in batch.schema.names
        }
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for name in names:
            change |= columns[name][1:] != columns[name][:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for s, e in zip(cuts, cuts[1:]):
            run = {name: c[s:e] for name, c in columns.items()}
            if parts and any(parts[-1][name][0] != run[name][0] for name in names):
                yield _joined(parts)
                parts = []
            parts.append(run)
    if parts:
        yield _joined(parts)


def _joined(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return parts[0] if len(parts) == 1 else {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}


def _cell_pairs(cell: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidates of one cell, of a block within itself or across two: places (r, o) of both
    directions, by r and then from the closest on. A pair counts in the first left half
    where it agrees.
    """
    n, sig, label, block = (cell[c] for c in ("n", "sig", "label", "block"))
    half, across = cell["half"][0], cell["x"][0] != cell["y"][0]
    sig64 = sig.view(np.uint64)
    for s in range(0, len(n), 32):
        rows = slice(s, s + 32)
        ok = (label[rows, None] != label) & (n[rows, None] * 100 >= n * PERCENT) & (n * 100 >= n[rows, None] * PERCENT)
        if across:
            ok &= block[rows, None] != block
        r, o = np.nonzero(ok)
        if not len(r):
            continue
        r += s
        same = sig64[r] == sig64[o]
        meets = same[:, HALVES:].any(axis=1) & (same[:, :HALVES].argmax(axis=1) == half)
        r, o = r[meets], o[meets]
        agree = (sig[r] == sig[o]).sum(axis=1)
        close = agree >= AGREE
        r, o, agree = r[close], o[close], agree[close]
        if len(r):
            order = np.lexsort((o, -agree, r))
            yield r[order], o[order]


def _closest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The closest candidates of each class."""
    for cell in _groups(batches, CELL):
        for r, o in _cell_pairs(cell):
            begin = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
            take = np.arange(len(r)) - np.repeat(begin, np.diff(np.append(begin, len(r)))) < FIRST
            a, b = cell["id"][r[take]], cell["id"][o[take]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _undecided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of cells that still have a candidate in another component."""
    for cell in _groups(batches, CELL):
        if (cell["label"] == cell["label"][0]).all():
            continue
        found = [r for r, _ in _cell_pairs(cell)]
        if found:
            places = np.unique(np.concatenate(found))
            part = {c: v[places] for c, v in cell.items()}
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.tobytes() for x in part[c]], pa.binary()) if c == "sig" else pa.array(part[c]) for c in MEMBER],
                names=MEMBER,
            )


def _cell_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The components that links join, found by testing every candidate of a cell that could.

    A member's set is marked once, and its candidates' shingles are looked up together.
    """
    for cell in _groups(batches, CELL):
        label = cell["label"] = cell["label"].copy()  # grows together while the pairs are made
        sets = [np.frombuffer(x, dtype=np.uint64) for x in cell["shingles"]]
        size = np.array([len(x) for x in sets])
        start = np.cumsum(size) - size
        distinct, codes = np.unique(np.concatenate(sets), return_inverse=True)
        mark = np.zeros(len(distinct), dtype=bool)
        links = []
        for r, o in _cell_pairs(cell):
            cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
            for i, others in zip(r[np.append(0, cuts)], np.split(o, cuts)):
                # each pair comes in both directions
                others = others[(others > i) & (label[others] != label[i])]
                if not len(others):
                    continue
                own, n = codes[start[i]:start[i] + size[i]], size[others]
                from_ = np.cumsum(n) - n
                mark[own] = True
                met = mark[codes[np.repeat(start[others] - from_, n) + np.arange(n.sum())]]
                mark[own] = False
                common = np.add.reduceat(met, from_, dtype=np.int64)
                for j in others[common * 100 >= PERCENT * (size[i] + n - common)]:
                    a, b = sorted((int(label[i]), int(label[j])))
                    if a != b:
                        label[label == b] = a
                        links.append((a, b))
        if links:
            a, b = zip(*links)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common * 100 >= PERCENT * (len(a) + len(b) - common)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, part in slices(batch.column("text")):
            sets = [s for s in shingle_sets(part) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(_node, sets), pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["node", "shingles"],
            )


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("sa"), batch.column("sb"))
        linked = [_similar(*(np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in p)) for p in pairs]
        kept = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"])
        yield kept.filter(pa.array(linked, pa.bool_()))


def _members(classes: DataFrame) -> DataFrame:
    """The classes of each shared left half, dealt to cells (x, y) of its blocks."""
    keys = classes.mapInArrow(_half_keys, "id long, n long, half int, key long")
    shared = keys.groupBy("half", "key").agg(F.count("*").alias("size"), F.sum("n").alias("hashes")).where("size > 1")
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("hashes") / BLOCK_HASHES)).cast("int")
    live = keys.select("id", "half", "key").join(shared.select("half", "key", blocks.alias("blocks")), ["half", "key"])
    left = F.collect_list(F.when(F.col("half") < HALVES, F.struct("half", "key", "blocks")))
    both = live.groupBy("id").agg(left.alias("left"), F.max("half").alias("top"))
    both = both.where(f"top >= {HALVES} and size(left) > 0")
    rows = classes.join(both, "id").select("id", "n", "sig", F.inline("left"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("p", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select(
        "id", "n", "sig", "half", "key", "block",
        F.least("block", "p").alias("x"), F.greatest("block", "p").alias("y"),
    )


def _linked(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """node, component of the classes that are linked with another."""
    members = written(_members(classes.select(F.col("node").alias("id"), "n", "sig")), "near-members")

    def in_cells(rows):
        return rows.repartition(*CELL).sortWithinPartitions(*CELL)

    first = in_cells(members.withColumn("label", F.col("id")))
    pairs = written(first.mapInArrow(_closest, "a long, b long").distinct(), "near-pairs")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    ids = written(classes.join(nodes, "node", "left_semi").select("id").distinct(), "near-ids")
    chosen = docs.join(ids, "id", "left_semi").select("text").mapInArrow(_sets, "node long, shingles binary")
    sets = written(chosen.dropDuplicates(["node"]), "near-sets")
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    links = written(pairs.join(a, "a").join(b, "b").mapInArrow(_confirm, "a long, b long"), "near-links")

    labels = components(links)
    marked = members.join(labels.select(F.col("node").alias("id"), "component"), "id", "left")
    marked = marked.withColumn("label", F.coalesce("component", "id")).drop("component")
    kinds = "id long, n long, sig binary, half int, key long, block int, x int, y int, label long"
    undecided = written(in_cells(marked).mapInArrow(_undecided, kinds), "near-undecided")
    if undecided.isEmpty():
        return labels
    with_sets = undecided.join(sets.withColumnRenamed("node", "id"), "id")
    more = written(in_cells(with_sets).mapInArrow(_cell_links, "a long, b long"), "near-links")
    return labels if more.isEmpty() else joined_components(labels, more)


def verdicts(docs: DataFrame) -> DataFrame:
    """id, text_hash, n_shingles, component_id, kept for each row of `docs` (id, text)."""
    source = docs.select(F.col("id").cast("long").alias("id"), "text", F.xxhash64("text").alias("text_hash"))
    sketched = written(
        source.mapInArrow(_sketch, "id long, text_hash long, n long, node long, sig binary"), "near-sketches"
    )
    known = sketched.where("id is not null and node is not null")
    classes = written(
        known.groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sig").alias("sig")),
        "near-classes",
    )
    labels = _linked(classes, source)
    joined = classes.select("node", "id").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = joined.groupBy("component").agg(F.min("id").alias("component_id"))
    by_node = written(joined.join(least, "component").select("node", "component_id"), "near-components")
    rows = sketched.select("id", "text_hash", "n", F.when(F.col("id").isNotNull(), F.col("node")).alias("node"))
    component = F.coalesce("component_id", "id")
    return rows.join(by_node, "node", "left").select(
        "id", "text_hash", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with their columns as they came."""
    source = docs.select(F.col(quoted(doc_id)).alias("id"), F.col(quoted(text)).alias("text"))
    stay = verdicts(source).where("kept").select(F.col("id").alias("v_id"), F.col("text_hash").alias("v_hash"))
    rows = docs.select(
        F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"),
        F.col(quoted(doc_id)).cast("long").alias("id"), F.xxhash64(F.col(quoted(text))).alias("text_hash"),
    )
    met = rows.join(stay, rows["id"].eqNullSafe(stay["v_id"]) & (rows["text_hash"] == stay["v_hash"]), "left_semi")
    return met.select("row.*")
