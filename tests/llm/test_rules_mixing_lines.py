"""Quality rules, mixing and line dedup: small cases, and SQL on whole tables."""

import pytest
from compare import connect, differences
from conftest import SF_DIR

from tellerlake.llm import line_dedup, mixing, quality_rules
from tellerlake.llm.queries import ORACLE, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, *rows):
    return spark.createDataFrame([(i, t, "en", s, None) for i, t, s in rows], SCHEMA)


@pytest.mark.parametrize("name", ["op1_mixing", "op4_warc", "op5_quality_rules", "op6_line_dedup", "op9_topk_search"])
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert df.count() > 0
    assert differences(df, connect(SF_DIR), ORACLE[name]) == []


def one(spark, text):
    return quality_rules.judged(docs(spark, (1, text, "a"))).first()


def test_measures_of_edge_texts(spark):
    for text in (None, "", " \n\t "):
        row = one(spark, text)
        assert (row.n_words, row.word_chars, row.n_dup_lines, row.n_repeat_words) == (0, 0, 0, 0)
        assert row.base_failed and not row.kept
    row = one(spark, "a b c a b c\n\nx #\nx #\n\n")
    assert (row.n_words, row.n_symbols, row.n_dup_lines) == (10, 2, 1)
    assert row.n_repeat_words == 6
    overlapping = one(spark, "q q q q q z")
    assert overlapping.n_repeat_words == 5


def test_repeated_windows_of_a_long_text_agree_with_counting(spark):
    words = [f"w{(i * i) % 97}" for i in range(3000)] + ["once", "only", "here"]
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    assert one(spark, " ".join(words)).n_repeat_words == len(covered)


def test_clean_prose_stays_and_junk_goes(spark):
    prose = "the river of the north runs to a sea and it is cold in winter for those who live by " * 1
    clean = " ".join(f"{w}{i}" if i % 3 else w for i, w in enumerate((prose * 5).split()))
    assert one(spark, clean).kept
    assert not one(spark, " ".join(w + "###" for w in clean.split())).kept
    assert not one(spark, " | ".join(f"cell{i}" for i in range(90))).kept


def test_accepted_keeps_columns_and_clashing_names(spark):
    df = docs(spark, (1, "x", "a"), (1, "x", "a")).withColumnRenamed("n_chars", "N_Words").withColumnRenamed("lang", "row")
    assert quality_rules.accepted(df).columns == df.columns
    judged = quality_rules.judged(df)
    assert judged.count() == 2 and judged.columns.count("n_words") == 1 and "N_Words" not in judged.columns
    assert quality_rules.judged(df.limit(0)).count() == 0


def plan_of(df):
    return {r.doc_id: r for r in mixing.planned(df).collect()}


def test_targets_rise_together_to_their_caps(spark):
    # sizes 10, 100 and 1000; weights 5, 2, 1; 1665 words to share; the first two are full at 2x
    df = docs(spark, (1, "w " * 10, "a"), (2, "w " * 100, "b"), (3, "w " * 1000, None), (4, None, None))
    got = plan_of(df)
    assert [got[i].target for i in (1, 2, 3)] == [20.0, 200.0, 1445.0]
    assert got[1].copies == 2 and got[2].copies == 2 and got[3].copies in (1, 2) and got[4].size == 0


def test_taken_words_come_near_the_target_and_reruns_agree(spark):
    df = docs(spark, *[(i, "w " * (5 + i % 7), "abc"[i % 3]) for i in range(3000)])
    first, second = plan_of(df), plan_of(df.repartition(7))
    assert first == second
    for source in "abc":
        rows = [r for r in first.values() if r.source == source]
        assert abs(sum(r.size * r.copies for r in rows) / rows[0].target - 1) < 0.05
    mix = mixing.mixed(df)
    assert mix.columns == df.columns and mix.count() == sum(r.copies for r in first.values())


def test_mix_of_nothing_and_of_clashing_names(spark):
    df = docs(spark, (None, "a b", "s"), (None, "a b", "s")).withColumnRenamed("lang", "Size").withColumnRenamed("n_chars", "copy")
    assert mixing.planned(df.limit(0)).count() == 0
    assert {r.size for r in mixing.planned(df).collect()} == {2}
    assert mixing.mixed(df).columns == df.columns


def cleaned(df):
    return sorted(((r.doc_id, r.text, r.n_removed) for r in line_dedup.deduplicated(df).collect()), key=repr)


def test_later_occurrences_go_and_overlaps_merge(spark):
    df = docs(
        spark, (1, "a\nb\nc\nd\ne", "s"), (2, "x\na\nb\nc\nd\ny", "s"), (3, "a\nb", "s"), (4, None, "s"), (5, "", "s"),
        (6, "\n\n\n\n", "s"), (7, "\n\n\n\n", "s"), (8, "a\nb\nc", "s"), (9, "m\nm\nm\nm\nm\nn", "s"),
    )
    assert cleaned(df) == sorted([
        (1, "a\nb\nc\nd\ne", 0), (2, "x\ny", 4), (3, "a\nb", 0), (4, None, 0), (5, "", 0), (6, "\n\n\n\n", 0),
        (7, "\n\n\n\n", 0), (8, "", 3), (9, "m\nn", 4),
    ], key=repr)


def test_repeated_rows_are_one_occurrence(spark):
    df = docs(spark, (1, "a\nb\nc", "s"), (1, "a\nb\nc", "s"), (None, "p\nq\nr", "s"), (None, "p\nq\nr", "s"))
    assert [r[2] for r in cleaned(df)] == [0, 0, 0, 0]
    assert line_dedup.without_repeats(df.limit(0)).count() == 0
    clash = df.withColumnRenamed("lang", "N_Removed").withColumnRenamed("n_chars", "at")
    assert line_dedup.deduplicated(clash).columns == ["doc_id", "text", "source", "at", "n_lines", "n_removed"]
    assert line_dedup.without_repeats(clash).columns == clash.columns


def test_short_texts_are_compared_as_a_whole(spark):
    df = docs(spark, (1, "a b", "s"), (2, "a b", "s"), (3, "a b\nc", "s"), (4, "a b\nc", "s"), (5, "a b\nc\nd", "s"), (6, "", "s"), (7, "", "s"),
              (8, "c\na b", "s"), (9, "\n", "s"), (10, "\n", "s"), (11, None, "s"))
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.deduplicated(df, short=True).collect()}
    assert got[2] == ("", 1) and got[4] == ("", 2)
    assert all(got[r.doc_id] == (r.text, 0) for r in df.collect() if r.doc_id not in (2, 4))
    assert {r.doc_id: r.text for r in line_dedup.without_repeats(df).collect()} == {i: t for i, (t, _) in got.items()}
