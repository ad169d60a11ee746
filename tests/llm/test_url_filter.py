import random

import brute
import pytest
from brute import in_order, rows_of

from kandela.llm import url_filter

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
NESTED = RULES + [("example.net", "", "block"), ("a.example.net", "/en/x", "block"), ("example.net", "/en/x/y", "allow"), ("net", "/en/x/y/zzzzzzzzzz", "block")]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "clash", "clash") for i, u in urls], "page_id long, url string, html string, host string, key string").repartition(3)


def rules_frame(spark, rules):
    return spark.createDataFrame(rules, "host string, path string, verdict string")


@pytest.mark.parametrize("rules", [RULES, NESTED])
def test_against_brute_force(spark, rules):
    rng = random.Random(6)
    hosts = ["net", "example.net", "Example.NET", "a.example.net", "b.a.example.net", "badexample.net", "example.com", "x.org", "org", "",
             "example.net:80", "net.", "é.net", "example.comet", "a..net"]
    paths = ["", "/", "/en/", "/en", "/en/x", "/en/x/y", "/en/x/y/zzzzzzzzzz1", "/de/1", "/fr/é", "//", "/EN/"]
    urls = [None, "", "nothing", "://", "http:/net/", "a://b://net/", "http://net?x=/", "http://net#/", "http://example.com/de/?q#f", "http://x.org/fr/" + "p" * 50_000]
    urls += [f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?a=/en/', '#top'])}" for _ in range(400)]
    rows = list(enumerate(urls)) + [(3, urls[3]), (None, "http://net/")]
    found = url_filter.judge_urls(pages(spark, rows), rules_frame(spark, rules))
    assert rows_of(found, "page_id", "host", "path", "rule", "verdict") == in_order([(i, *brute.judge(u, rules)) for i, u in rows])


def test_odd_rules(spark):
    rules = [(None, "/", "block"), ("", "/", "block"), ("net", None, "block"), ("NET", "/x", "allow"), ("com", "/", None), ("org", "/", "allow"), ("org", "/", "block")]
    found = url_filter.judge_urls(pages(spark, [(1, "http://net/y"), (2, "http://net/x"), (3, "http://com/"), (4, "http://org/")]), rules_frame(spark, rules))
    assert rows_of(found, "page_id", "rule", "verdict") == [(1, "net", "block"), (2, "net/x", "allow"), (3, None, "allow"), (4, "org/", "block")]


def test_empty_tables(spark):
    assert url_filter.judge_urls(pages(spark, []), rules_frame(spark, RULES)).count() == 0
    found = url_filter.judge_urls(pages(spark, [(1, "http://net/")]), rules_frame(spark, []), default="block")
    assert rows_of(found, "page_id", "rule", "verdict") == [(1, None, "block")]


def test_sweep_gives_the_nested_prefixes(spark):
    keys = spark.createDataFrame([("abcd",), ("ab",), ("b",), ("abd",), ("a\U0010ffff",)], "key string")
    rules = spark.createDataFrame([("a",), ("abc",), ("ab",), ("c",)], "key string")
    got = {r["key"]: r["stack"] for r in url_filter.sweep(keys, rules).collect()}
    assert got == {"abcd": ["a", "ab", "abc"], "ab": ["a", "ab"], "b": [], "abd": ["a", "ab"], "a\U0010ffff": ["a"]}


def test_no_python_in_the_plan(spark):
    from kandela.llm.queries import QUERIES

    plan = QUERIES["op10_url_filter"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan
