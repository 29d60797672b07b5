"""Collocations: brute force on small texts, the pair filter, and SQL on the whole table."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
from compare import connect, differences
from conftest import SF_DIR
from pyspark.sql import functions as F

from tellerlake.llm import collocations as C
from tellerlake.llm.queries import ORACLE, QUERIES
from tellerlake.llm.shared import written

SCHEMA = "text string, lang string"


def test_query_matches_sql(spark):
    df = QUERIES["op13_collocations"](spark, SF_DIR)
    assert differences(df, connect(SF_DIR), ORACLE["op13_collocations"]) == []


def brute(rows, min_count, top):
    upper = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(upper)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, 6):
                    if i + k <= len(words):
                        f[lang, tuple(words[i:i + k])] += 1
    rest = {p: n for p, n in f.items() if n >= min_count and len(p[1]) > 1}
    best = {}
    for (lang, words), a in rest.items():
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
        best[lang, words] = min(cuts)
    covered = set()
    for (lang, words), a in rest.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                if a >= f[lang, words[i:i + k]]:
                    covered.add((lang, words[i:i + k]))
    found = []
    for lang in total:
        kept = [(-best[p][0], -rest[p], " ".join(p[1]).encode(), p) for p in rest if p[0] == lang and p not in covered]
        for rank, (_, _, phrase, p) in enumerate(sorted(kept)[:top], 1):
            score, _, left, right = best[p]
            found.append((lang, rank, phrase.decode(), rest[p], left, right, total[lang], score))
    return sorted(found)


def texts(seed, n=150):
    rng = random.Random(seed)
    words = ["a", "B", "c", "é", "ß", "D" * 30, "𝔘", "x-y", " "]
    marks = [" ", " ", " ", " ", "\t", "  ", ". ", "\n", ";", "?!", "\r\n", ""]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randrange(0, 60)))
        rows.append((text, rng.choice(["en", "en", "de", None, "und"])))
    return rows + [(None, "en"), ("", None), (" \t ", "es"), ("one two three", "es")] + [("over and over again and again", "en")] * 9


def found(spark, rows, min_count, top, **options):
    df = C.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), min_count, top, **options)
    return sorted(map(tuple, df.collect()))


def test_brute_force_and_sql(spark):
    rows = texts(1)
    expected = brute(rows, 6, 40)
    assert len(expected) > 100
    assert found(spark, rows, 6, 40) == expected
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted(con.execute(C.sql(6, 40)).fetchall()) == expected


def test_a_full_pair_filter_only_saves_less(spark):
    rows = texts(2, 60)
    assert found(spark, rows, 4, 50, max_bits=64) == brute(rows, 4, 50)


def test_slices_and_long_texts(spark):
    rows = texts(3, 40)
    rows.append((" ".join(r[0] for r in rows if r[0]) * 20 + " end " * 500, "en"))
    parts = list(C._parts(rows[-1][0].encode(), 300))
    assert len(parts) > 20
    assert b"".join(parts) == rows[-1][0].encode().translate(C._TABLE)
    assert found(spark, rows, 5, 100) == brute(rows, 5, 100)


def test_the_filter_has_every_frequent_pair(spark):
    rng = np.random.default_rng(1)
    keys = rng.integers(-(1 << 62), 1 << 62, size=3_000)
    table = written(spark.createDataFrame([(int(k),) for k in keys], "key long"), "pairs")
    pairs = C.PairFilter(table)
    assert pairs.has(keys.view(np.uint64)).all()
    other = rng.integers(0, 1 << 63, size=20_000, dtype=np.uint64)
    assert pairs.has(other).mean() < 0.01


def test_windows_stop_at_pieces_and_rare_pairs():
    part = C.Slice([(b"a b c d e f" + C._END + b"g h", 0), (b"i", 1)])
    assert C.window_lengths(part, part.pair_keys(np.zeros(2, dtype=np.uint64))[0]).tolist() == [5, 5, 4, 3, 2, 1, 0, 2, 1, 0, 1, 0]
    assert C.window_lengths(part, np.zeros(12, dtype=bool)).tolist() == [1, 1, 1, 1, 1, 1, 0, 1, 1, 0, 1, 0]


def test_products_beyond_64_bits_are_exact(spark):
    big = 4_000_000_000_007
    rows = [("en", 0, "", 3 * big), ("en", 1, "p", big), ("en", 1, "q", big + 1), ("en", 2, "p q", big - 9)]
    table = written(spark.createDataFrame(rows, "lang string, size int, phrase string, f long"), "phrases")
    row = C.scored_phrases(table).first()
    assert row.score == 1000 * (big - 9) * 3 * big // (big * (big + 1))


def test_no_rows_and_clashing_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.collocations(empty).collect() == [] and C.collocations(empty).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert found(spark, [(None, None), ("", "en"), (".", "en")], 1, 5) == []
    df = spark.createDataFrame([("a b", "en")] * 3, SCHEMA).withColumns({c: F.lit(1) for c in ("phrase", "f", "n", "w0", "size")})
    assert [tuple(r) for r in C.collocations(df, 3).collect()] == [("en", 1, "a b", 3, 3, 3, 6, 2000)]
