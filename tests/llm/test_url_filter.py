import random
import re

import pytest
from pyspark.sql import types as T

from riskmart.llm import url_filter
from riskmart.llm.queries import URL_RULES
from riskmart.llm.url_filter import Rule

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("Host", T.IntegerType()), T.StructField("verdict", T.StringType())])


@pytest.mark.parametrize(
    ("url", "parts"),
    [
        (None, ("", "")),
        ("", ("", "")),
        ("no-scheme.com/en/", ("", "")),
        ("http://WWW.Example.COM/En/?q=/x#y", ("www.example.com", "/En/")),
        ("x://h", ("h", "")),
        ("x://h?/a", ("h", "")),
        ("x://h#a/b", ("h", "")),
        ("a://b://c/d", ("b:", "//c/d")),
        ("http://ÀB.com:80/é\n/z", ("Àb.com:80", "/é\n/z")),
        ("http:///path", ("", "/path")),
    ],
)
def test_split(url, parts):
    assert url_filter.split_url(url) == parts


def test_longest_rule_wins_on_host_and_subdomains():
    table = url_filter._by_host(URL_RULES)
    best = lambda h, p: str(url_filter.best_rule(h, p, table) or "")
    assert best("a.example.com", "/en/1") == "example.com/en/"
    assert best("www.example.com", "/en/1") == best("x.www.example.com", "/en/") == "www.example.com/en/"
    assert best("example.com", "/de/") == "com/" == best("com", "/")
    assert best("example.com", "") == "" == best("notexample.net", "/en/")
    assert best("notexample.com", "/en/") == "com/"
    assert best("a.net", "/fr/") == "net/fr/" and best("", "/fr/") == ""


def test_hits_match_a_search_of_every_place():
    rng = random.Random(2)
    vocabulary = {"ab": 2, "b": 1, "a-b": 1, "ba": 1, "é": 1}
    for _ in range(2000):
        text = "".join(rng.choices("ab-é1", k=rng.randint(0, 12)))
        want = {}
        for term in vocabulary:
            n = sum(
                text.startswith(term, i)
                and not re.match("[a-z0-9]", text[i - 1 : i] if i else "")
                and not re.match("[a-z0-9]", text[i + len(term) : i + len(term) + 1])
                for i in range(len(text))
            )
            if n:
                want[term] = n
        assert url_filter.hits(text, vocabulary) == want


def test_strict_and_soft_terms(spark):
    rows = [
        (1, "http://casino-win.net/", 1, "x"),
        (2, "http://cheap.net/cheap/cheap", 1, "x"),
        (3, "http://CHEAP-pills.net/", None, None),
        (4, "http://casinos.net/cheapest", 1, "x"),
        (5, None, 1, "x"),
        (None, "casino", 1, "x"),
        (1, "http://casino-win.net/", 1, "x"),
        (6, "http://cheap-pills.com/", 1, "x"),
        (7, "http://a.net/" + "cheap/" * 50_000 + "win", 1, "x"),
    ]
    got = url_filter.judge(spark.createDataFrame(rows, SCHEMA), rules=(Rule("com", "/", "allow"),)).collect()
    assert got[0].__fields__ == ["page_id", "url", "host", "path", "rule", "verdict", "strict_hits", "soft_terms", "score"]
    assert [r.verdict for r in got] == ["block", "allow", "block", "allow", "allow", "block", "block", "allow", "block"]
    assert [r.soft_terms for r in got][:3] == [1, 1, 2] and got[0].strict_hits == 1 and got[7].rule == "com/"
    assert url_filter.judge(spark.createDataFrame([], SCHEMA)).collect() == []
    assert url_filter.judge(spark.createDataFrame(rows, SCHEMA), vocabulary={}).filter("verdict = 'block'").count() == 0
    with pytest.raises(ValueError):
        url_filter.judge(spark.createDataFrame(rows, SCHEMA), vocabulary={"Upper": 1})
