"""Exact search and WARC archives."""

import gzip

import numpy as np
import pytest
from pyspark.sql import functions as F

from tellerlake.llm import topk, warc


def brute(vectors, queries, k=10):
    width = max((len(v) for v in vectors.values()), default=0)
    whole = {i: [int(np.floor(1024 * np.float64(x))) for x in v] + [0] * (width - len(v)) for i, v in vectors.items()}
    out = []
    for q in queries:
        scores = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def search(spark, rows, k=10):
    df = spark.createDataFrame(rows, "id long, v array<double>")
    return sorted(tuple(r) for r in topk.top_k(df.where("id % 10 = 0"), df, k).collect())


@pytest.mark.parametrize("rows_of_block", [None, 40])
def test_search_agrees_with_brute_force(spark, monkeypatch, rows_of_block):
    if rows_of_block:
        monkeypatch.setattr(topk, "ROW_BYTES", rows_of_block * 64 * 8)
        monkeypatch.setattr(topk, "QUERY_BYTES", 3 * 64 * 8)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(4, 64))
    vectors = {i: (centres[i % 4] + rng.normal(scale=0.3, size=64)).tolist() for i in range(220)}
    vectors |= {i: vectors[5] for i in range(220, 260)}  # ties
    assert search(spark, list(vectors.items())) == brute(vectors, [i for i in vectors if i % 10 == 0])


def test_search_of_unusual_vectors(spark):
    vectors = {0: [1.0, 2.0], 1: [3.0], 2: [], 3: [-1e12, 1e12], 10: [0.1, -0.1]}
    bad = [(4, None), (5, [None, 1.0]), (6, [float("nan")]), (7, [float("inf")]), (20, [float("-inf")]), (None, [1.0])]
    assert search(spark, [*vectors.items(), *bad]) == brute(vectors, [0, 10])
    assert search(spark, bad) == []
    assert search(spark, [(0, [1.0]), (0, [1.0]), (1, [1.0]), (1, [1.0])]) == [(0, 1, 1, 1048576), (0, 2, 1, 1048576)]


def test_search_of_many_components(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=600 - i) * np.geomspace(1, 0.01, 600 - i)).tolist()) for i in range(60)]
    assert search(spark, rows) == brute(dict(rows), range(0, 60, 10))


def test_huge_components_and_saturated_scores(spark):
    rows = [(i, [(-1.0) ** i * 1e300, 1.0]) for i in range(25)]
    limit = (1 << 63) - 1
    want = []
    for q in (0, 10, 20):
        scores = sorted((limit if i % 2 else -limit, i) for i in range(25) if i != q)
        want += [(q, r + 1, i, limit) for r, i in enumerate(sorted(i for _, i in scores if i % 2 == 0)[:10])]
    assert search(spark, rows) == want
    lows = [(i, [-1e300 if i % 10 else 1e300 * (1 + i), 0.0]) for i in range(1, 31)]
    got = search(spark, [r for r in lows if r[0] % 10 or r[0] == 10])
    assert got == [(10, r + 1, i, -limit - 1) for r, i in enumerate(i for i in range(1, 12) if i != 10)]


def test_bounds_are_never_below_the_score():
    rng = np.random.default_rng(1)
    q, x = np.floor(rng.normal(size=(20, 50)) * 1000), np.floor(rng.normal(size=(30, 50)) * 1000)
    axes = topk.fitted_axes(x)
    a, b = topk.rotated(q, axes), topk.rotated(x, axes)
    assert a @ b.T == pytest.approx(q @ x.T, abs=1e-6)
    last, width = None, a.shape[1]
    for level in (*topk.LEVELS, topk.FINE):
        lengths = topk.equal(width, topk.FINE) if level == topk.FINE else topk.leading(width)
        (qm, qd), (xm, xd) = (topk.coarser(*topk.statistics(y, lengths), lengths, level) for y in (a, b))
        if level == 4:
            cuts = np.split(a, np.cumsum(lengths)[3:-1:4], axis=1)
            assert qm == pytest.approx(np.stack([c.mean(1) * np.sqrt(c.shape[1]) for c in cuts], 1), abs=1e-3)
            assert qd == pytest.approx(np.stack([c.std(1) * np.sqrt(c.shape[1]) for c in cuts], 1), abs=1e-3)
        bound = qm @ xm.T + qd @ xd.T
        assert (bound >= q @ x.T - 1e-3).all()
        assert last is None or level == topk.FINE or (bound <= last + 1e-3).all()
        last = bound


def test_bounds_leave_few_pairs_of_clustered_vectors(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 8)) @ rng.normal(size=(8, 64))
    rows = [(i, (centres[i % 40] + rng.normal(scale=0.05, size=64)).tolist()) for i in range(1200)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    left = dict(topk.survivors(df.where("id % 10 = 0"), df).collect())
    assert left[0] == 120 * 1200 and all(left[k + 1] <= left[k] for k in (0, 1, 2, 4))
    assert left[3] < left[0] / 2 and left[5] < left[0] / 20


PAGES = "page_id long, url string, html string"


def test_archive_of_edge_pages(spark, tmp_path):
    big = "é" * 600
    rows = [(1, "http://a/x", big), (2, None, big), (3, "http://a/ö z", big), (4, "u", "small"), (5, "u", "small"),
            (6, "u", None), (7, "u", ""), (None, "u", big), (3, "again", big)]
    got = warc.archive_round_trip(spark.createDataFrame(rows, PAGES)).collect()
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in got)
    assert kinds == sorted([
        (1, "revisit", 3, 1200), (2, "revisit", 3, 1200), (3, "response", None, 1200), (3, "response", None, 1200),
        (4, "response", None, 5), (5, "response", None, 5), (6, "response", None, 0), (7, "response", None, 0),
        (0, "response", None, 1200)], key=lambda r: (r[0], r[1]))
    assert warc.archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0


@pytest.fixture
def archive(spark, tmp_path):
    path = f"file://{tmp_path}/archive"
    rows = [(i, f"http://h{i % 3}/{i}", f"<p>page {i}\r\n\r\nWARC/1.1\r\n" + "x" * (i * 40)) for i in range(100)]
    rows += [(100 + i, "http://copy/", rows[60][2]) for i in range(3)]
    warc.archive(spark.createDataFrame(rows, PAGES), path)
    return path, {i: h for i, _, h in rows}


def test_filters_reach_the_reader_and_payloads_can_be_left_out(spark, archive):
    path, html = archive
    df = warc.read_archive(spark, path)
    assert {r.record_id: bytes(r.payload).decode() for r in df.where("record_type = 'response'").collect()} == {
        f"<urn:page:{i}>": h for i, h in html.items() if i not in (60, 100, 101)}
    some = df.where((F.col("record_type") == "revisit") & F.col("target_uri").startswith("http://copy"))
    assert sorted(r.record_id for r in some.collect()) == ["<urn:page:100>", "<urn:page:101>"]
    assert "PostScan" not in some._jdf.queryExecution().executedPlan().toString()
    bare = warc.read_archive(spark, path, payload=False)
    assert bare.count() == 103 and bare.where("payload is not null").isEmpty()


def test_foreign_archives_are_read_as_they_are(spark, archive, tmp_path):
    path, html = archive
    folder = tmp_path / "foreign"
    folder.mkdir()
    plain = b"".join(gzip.decompress(f.read_bytes()) for f in sorted((tmp_path / "archive").glob("*.warc.gz")))
    (folder / "one.warc").write_bytes(plain)
    (folder / "two.warc.gz").write_bytes(gzip.compress(plain[:len(plain)]))
    own = warc.read_archive(spark, path)
    foreign = warc.read_archive(spark, f"file://{folder}")
    assert sorted(foreign.collect(), key=str) == sorted(own.unionAll(own).collect(), key=str)


def test_files_of_failed_attempts_are_not_read(spark, archive, tmp_path):
    path, html = archive
    before = warc.read_archive(spark, path).count()
    extra = next((tmp_path / "archive").glob("*.warc.gz"))
    (tmp_path / "archive" / "part-orphan.warc.gz").write_bytes(extra.read_bytes())
    assert warc.read_archive(spark, path).count() == before


def test_the_query_pushes_the_record_type_to_both_reads(spark, archive):
    rows = warc.archived_pages(spark, archive[0])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchScan") == 2 and "Filter (" not in plan
    assert rows.count() == warc.read_archive(spark, archive[0]).count() == 103
