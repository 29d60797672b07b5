"""Url rules and the filter cascade: small cases, exactness, and SQL on the whole table."""

from compare import connect, differences
from conftest import SF_DIR
from pyspark.sql import functions as F

from tellerlake.llm import url_filter
from tellerlake.llm.queries import ORACLE, QUERIES
from tellerlake.llm.shared import written


def pages(spark, *urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def judge(spark, *urls, **options):
    return url_filter.judged(pages(spark, *urls), **options).orderBy("page_id").collect()


def test_query_matches_sql(spark):
    df = QUERIES["op12_url_filter"](spark, SF_DIR)
    assert df.count() == spark.read.parquet(f"{SF_DIR}/pages.parquet").count()
    assert differences(df, connect(SF_DIR), ORACLE["op12_url_filter"]) == []


def test_hosts_and_paths(spark):
    rows = judge(
        spark, "HTTP://WWW.Example.ORG/En/1?q=/x", "https://a.com#/fr/", "x://h?p/q", "mailto:a@b", "", None,
        "a://b://c/d", "https://h\n/p\nq#r", "://",
    )
    assert [(r.host, r.path) for r in rows] == [
        ("www.example.org", "/En/1"), ("a.com", ""), ("h", ""), ("", ""), ("", ""), ("", ""), ("b:", "//c/d"),
        ("h\n", "/p\nq"), ("", ""),
    ]
    assert [r.verdict for r in rows] == ["allow"] * 9


def test_the_longest_fitting_rule_decides(spark):
    cases = {
        "https://example.org/es/1": ("example.org/es/", "block"), "https://m.example.org/en/12": ("example.org/en/1", "block"),
        "https://example.org/en/21": ("org/", "allow"), "https://notexample.org/es/": ("org/", "allow"),
        "https://org/x": ("org/", "allow"), "https://x.org": (None, "allow"), "https://x.com/de/1": ("com/de/", "block"),
        "https://x.com/fr/": ("com/fr/", "allow"), "https://x.com/FR/": (None, "allow"), "https://xcom/fr/": (None, "allow"),
    }
    rows = judge(spark, *cases)
    assert [(r.rule, r.verdict) for r in rows] == list(cases.values())


def test_names_are_listed_by_parts_of_labels(spark):
    cases = {
        "http://casino-win.example.com/en/1": True, "http://m.casino-win.example.net/": True, "http://casinos.example.com/": False,
        "http://spam/": False, "http://spam.net/": True, "http://free-bets-now.net/": True, "http://essex.net/": False,
        "http://good.spam": False,
    }
    rows = judge(spark, *cases, rules=[])
    assert [r.listed for r in rows] == list(cases.values())
    assert [r.verdict == "block" for r in rows] == list(cases.values())


def test_a_list_of_domains_covers_all_below_them(spark):
    blocked = spark.createDataFrame([("bad.net",), ("bad.net",), ("deep.ok.org",), (None,)], "domain string")
    urls = ["http://bad.net/", "http://x.bad.net/", "http://notbad.net/", "http://ok.org/", "http://a.deep.ok.org/"]
    rows = judge(spark, *urls, rules=[], blocked=blocked)
    assert [r.listed for r in rows] == [True, True, False, False, True]


def keys(spark, n, every):
    rows = spark.range(n).select(F.concat(F.lit("h"), "id").alias("key"), (F.col("id") % every == 0).alias("listed"))
    return written(rows, "keys")


def test_the_cascade_is_exact_for_every_key(spark):
    for n, every in ((40_000, 7), (5_000, 1), (5_000, 2), (3_000, 3_000), (100, 101)):
        universe = keys(spark, n, every)
        cascade = url_filter.build_cascade(universe)
        wrong = universe.where(cascade.has(F.col("key")) != F.col("listed"))
        assert wrong.isEmpty()
    assert len(url_filter.build_cascade(keys(spark, 40_000, 7)).levels) > 2


def test_bits_are_bounded_and_the_way_beyond_the_bound_agrees(spark):
    universe = keys(spark, 40_000, 7)
    bits = url_filter.build_cascade(universe).bits
    assert url_filter.build_cascade(universe, bits + 64) is not None
    assert url_filter.build_cascade(universe, bits // 2) is None
    urls = ["http://spam.a.net/", "http://b.net/", None, "http://spam.a.net/x"]
    assert judge(spark, *urls) == judge(spark, *urls, max_bits=0)


def test_tasks_get_bits_and_no_join_or_python(spark):
    plan = url_filter.judged(pages(spark, "http://spam.a.net/"))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Arrow" not in plan


def test_long_hosts_repeated_rows_clashing_names_and_empty_tables(spark):
    long = "http://" + "a." * 50_000 + "spam.net/x"
    rows = judge(spark, long, long, "http://" + "spam" * 100 + ".net/")
    assert [r.listed for r in rows] == [True, True, False] and rows[0].path == "/x"
    df = pages(spark, "http://spam.a.net/").select("*", F.lit(1).alias("Host"), F.lit("r").alias("row"), F.lit(2).alias("key"))
    assert url_filter.judged(df).columns == ["page_id", "url", "row", "key", *url_filter.DERIVED]
    assert url_filter.accepted(df).count() == 0 and url_filter.accepted(df).columns == df.columns
    assert judge(spark) == []
