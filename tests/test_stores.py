"""Stored batches and graphs: folding under readers, newest rows first, merges that rewrite little."""

import os
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tellerlake.operators import graph as G
from tellerlake.operators import kpis
from tellerlake.sources.feed import newest_feed
from tellerlake.sources.graph_store import BucketedTable, GraphStore
from tellerlake.sources.testtables import stream_transactions, transactions
from tellerlake.streaming import compaction as C
from conftest import SF_DIR


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


@contextmanager
def unreadable(paths):
    kept = {p: (Path(p).read_bytes(), os.stat(p)) for p in paths}
    assert kept
    for p, (content, stat) in kept.items():
        Path(p).write_bytes(b"\0" * len(content))
        Path(p).with_name(f".{Path(p).name}.crc").unlink(missing_ok=True)
        os.utime(p, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    yield
    for p, (content, stat) in kept.items():
        Path(p).write_bytes(content)
        os.utime(p, ns=(stat.st_atime_ns, stat.st_mtime_ns))


# --- folding ----------------------------------------------------------------------

SCHEMA = "k long"


def write_batch(spark, path, run, n, size=3):
    spark.range(size).select((F.col("id") + 10 * n).alias("k")).write.mode("overwrite").parquet(f"{path}/run={run}/batch_id={n}")


def test_a_reader_sees_each_batch_once_at_every_step(spark, tmp_path):
    path = str(tmp_path)
    for n in range(6):
        write_batch(spark, path, "a", n)
    write_batch(spark, path, "b", 0)
    everything = {(k, run, n) for run, batches in (("a", range(6)), ("b", [0])) for n in batches for k in range(10 * n, 10 * n + 3)}

    def seen():
        found = rows(C.read_batches(spark, path, SCHEMA))
        assert len(found) == len(set(found))
        return set(found)

    assert seen() == everything
    early = C.read_batches(spark, path, SCHEMA)
    made = C.fold(spark, path, SCHEMA, "a", files=1)
    assert made == C.Fold("a", 0, 4) and seen() == everything
    assert set(rows(early)) == everything  # a reader that began before the fold
    assert C.fold(spark, path, SCHEMA, "a") is None and C.fold(spark, path, SCHEMA, "b") is None
    assert C.fold(spark, path, SCHEMA, "nowhere") is None

    C.remove_folded(spark, path, older_than_ms=3_600_000)
    assert len(list(Path(path).glob("run=a/batch_id=*"))) == 6
    C.remove_folded(spark, path, older_than_ms=0)
    assert [p.name for p in Path(path).glob("run=a/batch_id=*")] == ["batch_id=5"] and seen() == everything
    assert len(files(f"{path}/{C.FOLDER}")) == 1

    for n in (6, 7):
        write_batch(spark, path, "a", n)
        everything |= {(k, "a", n) for k in range(10 * n, 10 * n + 3)}
    write_batch(spark, path, "a", 7)  # the last batch may be retried
    middle = C.read_batches(spark, path, SCHEMA)
    assert C.fold(spark, path, SCHEMA, "a") == C.Fold("a", 0, 6) and seen() == everything
    assert set(rows(middle)) == everything
    C.remove_folded(spark, path, older_than_ms=0)
    assert seen() == everything and [p.name for p in Path(path, C.FOLDER).iterdir()] == ["a,0-6"]


def test_an_unfinished_fold_is_not_read(spark, tmp_path):
    path = str(tmp_path)
    for n in range(3):
        write_batch(spark, path, "a", n)
    whole = rows(C.read_batches(spark, path, SCHEMA))
    spark.range(9).select(F.col("id").alias("k"), F.lit("a").alias("run"), F.lit(0).cast("long").alias("batch_id")).write.parquet(
        f"{path}/{C.FOLDER}/.left")
    assert rows(C.read_batches(spark, path, SCHEMA)) == whole
    C.fold(spark, path, SCHEMA, "a")
    assert rows(C.read_batches(spark, path, SCHEMA)) == whole


# --- newest rows ------------------------------------------------------------------

def stored_flagged(spark, path, batches=12):
    """Batches in the order of detection, each file as old as its last row."""
    stream = stream_transactions(spark, SF_DIR)
    flagged = kpis.flag_transactions(stream, F.timestamp_millis(F.col("ingestedAt") + 700))
    parts = flagged.repartitionByRange(batches, "flaggedAt").withColumn("n", F.spark_partition_id()).persist()
    for n in range(batches):
        part = parts.where(F.col("n") == n).drop("n")
        folder = Path(path, f"run=r/batch_id={n}")
        part.coalesce(1).write.parquet(str(folder))
        newest = part.agg(F.max("flaggedAt")).first()[0]
        for f in folder.glob("*.parquet"):
            os.utime(f, ns=(newest * 1_000_000, newest * 1_000_000))
    parts.unpersist()
    return flagged


SCHEMA_FEED = ("step int, type string, amount double, nameOrig string, nameDest string, newbalanceDest double, "
               "isFraud int, fraudReason string, detectionLatencyMs long, flaggedAt long")


@pytest.mark.parametrize("status", ["all", "confirmed", "false_positive"])
def test_the_newest_rows_come_from_the_newest_files(spark, tmp_path, status):
    flagged = stored_flagged(spark, tmp_path)
    expected = [tuple(r) for r in kpis.live_feed(flagged, 9, status).collect()]
    by_age = sorted(files(tmp_path), key=lambda f: os.stat(f).st_mtime_ns)
    old = by_age[:8] if status == "all" else by_age[:2]
    with unreadable(old):
        found = newest_feed(spark, str(tmp_path), SCHEMA_FEED, 9, status, first_files=1)
        assert [tuple(r) for r in found.collect()] == expected
    whole = newest_feed(spark, str(tmp_path), SCHEMA_FEED, 10_000, status, first_files=2)
    assert whole.count() == kpis.live_feed(flagged, 10_000, status).count()


def test_clocks_may_differ_and_feeds_may_be_empty_or_without_times(spark, tmp_path):
    flagged = stored_flagged(spark, tmp_path / "a", 3)
    late = sorted(files(tmp_path / "a"), key=lambda f: os.stat(f).st_mtime_ns)
    os.utime(late[-1], ns=(os.stat(late[0]).st_mtime_ns - 10**9,) * 2)  # the newest rows in the oldest file
    far = newest_feed(spark, str(tmp_path / "a"), SCHEMA_FEED, 5, first_files=1, skew_ms=10**12)
    assert [tuple(r) for r in far.collect()] == [tuple(r) for r in kpis.live_feed(flagged, 5).collect()]
    untimed = newest_feed(spark, str(tmp_path / "a"), SCHEMA_FEED.rpartition(",")[0], 5)
    assert untimed.count() == 5
    (tmp_path / "b").mkdir()
    assert newest_feed(spark, str(tmp_path / "b"), SCHEMA_FEED).isEmpty()


# --- graph ------------------------------------------------------------------------

def test_merging_again_writes_nothing(spark, tmp_path):
    txns = transactions(spark, SF_DIR)
    store = GraphStore(spark, str(tmp_path), buckets=16)
    first = store.load(txns.where("step <= 1200"))
    assert first["transactions"] == txns.where("step <= 1200").count() == first["sent"] == first["received"]
    before = files(tmp_path)
    assert store.load(txns.where("step <= 1200")) == dict.fromkeys(first, 0)
    assert files(tmp_path) == before
    assert store.load(txns)["transactions"] == txns.where("step > 1200").count()
    assert rows(store.accounts.read()) == rows(G.account_nodes(txns))
    assert rows(store.transactions.read()) == rows(G.transaction_nodes(txns))
    assert rows(store.sent.read()) == rows(G.sent_edges(txns))
    assert rows(store.received.read()) == rows(G.received_edges(txns))
    assert rows(store.paths()) == rows(G.graph_paths(G.sent_edges(txns), G.received_edges(txns)))


def test_only_touched_buckets_are_read_and_rewritten(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path), "id string, v int, w string", ("id",), buckets=8)
    assert table.read().isEmpty()
    assert table.merge(spark.range(400).select(F.concat(F.lit("k"), "id").alias("id"), F.lit(1).alias("v"), F.lit(None).cast("string").alias("w"))) == 400
    before = files(tmp_path)
    assert len({f.split("bucket=")[1].split("/")[0] for f in before}) == 8
    number = table._stored().where("id = 'k7'").first().bucket
    update = spark.createDataFrame([("k7", 2, "x"), ("k7", 1, "z"), ("k7", 2, None)], "id string, v int, w string")
    with unreadable(f for f in before if f"bucket={number}/" not in f):
        assert table.merge(update) == 1
    after = files(tmp_path)
    touched = {f for f in before.keys() | after.keys() if before.get(f) != after.get(f)}
    assert {f.split("bucket=")[1].split("/")[0] for f in touched} == {str(number)}
    assert table.read().where("id = 'k7'").collect() == [("k7", 2, "x")] and table.read().count() == 400
    assert rows(table.read()) == rows(G.upsert(table.read(), update, "id"))
    assert [p.name for p in tmp_path.iterdir()] == ["buckets-8"]


def test_first_rows_are_written_once_and_large_buckets_by_several_tasks(spark, tmp_path, monkeypatch):
    table = BucketedTable(spark, str(tmp_path), "id long, v long", ("id",), buckets=2)
    updates = spark.range(200_000).selectExpr("id", "hash(id) AS v")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "200k")
    try:
        with monkeypatch.context() as first:
            first.setattr(BucketedTable, "_kept", None)  # nothing is kept beside the buckets
            assert table.merge(updates.union(updates)) == 200_000
        assert all(len([f for f in files(tmp_path) if f"bucket={n}/" in f]) > 1 for n in range(2))
        assert table.merge(updates.where("id < 10").selectExpr("id", "v + 1 AS v")) == 10
    finally:
        spark.conf.unset(size)
    assert rows(table.read()) == rows(updates.selectExpr("id", "v + IF(id < 10, 1, 0) AS v"))
    empty = BucketedTable(spark, str(tmp_path / "e"), "id long, v long", ("id",), buckets=2)
    assert empty.merge(updates.limit(0)) == 0 and empty.read().isEmpty() and empty.merge(updates.limit(5)) == 5
