"""URL filters: arrays sorted by digest against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskflow.llm import urls
from maskflow.llm.queries import URL_RULES

RULES = "host string, path string, verdict string"
URLS = [
    "https://example.com/en/a", "https://www.example.com/en/a?x=/fr/", "HTTP://WWW.EXAMPLE.COM/EN/", "http://com",
    "http://com/", "http://a.b.c.com/x#y", "http://notcom/x", "ftp://x.net/es/1", "http://net/fr/", "http://net/FR/",
    "//net/es/", "net/es/", "", None, "://", "://net/es/", "http://example.com:80/en/", "http://.com/", "http://a..net/es/",
    "http://xexample.com/en/", "http://example.com?/en/", "http://a.com/" + "p/" * 50_000, "http://" + "a." * 20_000 + "com/",
    "http://ÄB.NET/es/é", "http://a\n.net/es/\nb", "http://x://net/es/",
]


def parts(url):
    _, mark, rest = (url or "").partition("://")
    ends = [rest.find(c) for c in "/?#" if c in rest] if mark else []
    host, tail = (rest[: min(ends)], rest[min(ends):]) if ends else (rest if mark else "", "")
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def judge(url, rules, default="allow"):
    host, path = parts(url)
    fits = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *(max(fits)[2:] if fits else (None, default)))


def pages_of(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "page_id bigint, url string")


def found(df):
    return [tuple(r)[-4:] for r in df.orderBy("page_id").select("page_id", "host", "path", "rule", "verdict").collect()]


@pytest.mark.parametrize("bits, part_bytes", [(64, 1 << 26), (64, 40), (3, 1 << 26), (2, 40)])
def test_against_plain_python(spark, bits, part_bytes):
    """With few bits most keys collide, and small parts make many files."""
    rules = spark.createDataFrame(URL_RULES, RULES)
    url_filter = urls.UrlFilter.build(rules, bits=bits, part_bytes=part_bytes)
    got = found(urls.judged(pages_of(spark, URLS), url_filter))
    assert got == [judge(url, URL_RULES) for url in URLS]


def test_many_random_rules(spark):
    draw = random.Random(5)
    hosts = [".".join(draw.choice("ab") for _ in range(draw.randint(1, 4))) for _ in range(40)]
    rules = {(h, "/" + "/".join(draw.choices("xy", k=draw.randint(0, 3)))): draw.choice(["allow", "block"]) for h in hosts}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    values = [
        f"http://{'.'.join(draw.choices('abc', k=draw.randint(1, 6)))}/{'/'.join(draw.choices('xyz', k=draw.randint(0, 5)))}"
        for _ in range(300)
    ]
    for bits in (64, 5):
        url_filter = urls.UrlFilter.build(spark.createDataFrame(rules, RULES), default="block", bits=bits, part_bytes=256)
        assert len(url_filter.rules.files) > 1
        got = found(urls.judged(pages_of(spark, values), url_filter))
        for url, row in zip(values, got):
            want = judge(url, rules, "block")
            # Two rules may be equally long; the longer host goes first.
            assert row == want


def test_rules_of_any_kind(spark):
    rules = [("A.Com", "/", "allow"), ("a.com", "/", "block"), (None, None, "block"), ("b", None, "block"), ("b", "é", "allow")]
    url_filter = urls.UrlFilter.build(spark.createDataFrame(rules, RULES))
    got = found(urls.judged(pages_of(spark, ["x://a.com/", "x://a.com", None, "x://c.b/é", "x://c/", "x://c./"]), url_filter))
    assert [row[2:] for row in got] == [("a.com/", "block"), (None, "allow"), ("", "block"), ("b", "block"), (None, "allow"), ("", "block")]
    with pytest.raises(Exception, match="verdicts are allow and block"):
        urls.UrlFilter.build(spark.createDataFrame([("a", "/", "deny")], RULES))


def test_no_rules_empty_tables_and_clashing_names(spark):
    empty = urls.UrlFilter.build(spark.createDataFrame([], RULES))
    assert found(urls.judged(pages_of(spark, ["http://a/b", None]), empty)) == [("a", "/b", None, "allow"), ("", "", None, "allow")]
    url_filter = urls.UrlFilter.build(spark.createDataFrame(URL_RULES, RULES))
    assert urls.judged(pages_of(spark, []), url_filter).count() == 0
    odd = pages_of(spark, ["http://net/es/", "http://net/"]).select(
        "*", F.lit(1).alias("host"), F.lit(2).alias("rule"), F.lit(3).alias("_judged"), F.create_map(F.lit(1), F.lit(2)).alias("page")
    )
    rows = urls.judged(odd.unionByName(odd), url_filter).collect()
    assert sorted((r["page_id"], r["rule"], r["_judged"]) for r in rows) == [(0, "net/es/", 3)] * 2 + [(1, None, 3)] * 2
    kept = urls.allowed(odd, url_filter)
    assert kept.columns == odd.columns and [r["page_id"] for r in kept.collect()] == [1]


def test_array_confirms_strings():
    strings = [b"one", b"two", b"", b"four"]
    keys = np.array([7, 7, 7, 1], dtype=np.uint64)
    array = urls.DigestArray(urls.encode_array(keys, strings, [[1], [2, 3], [], [4]]))
    entries = array.find(np.array([7, 7, 7, 7, 1, 2], dtype=np.uint64), [b"two", b"", b"one", b"four", b"four", b"one"])
    assert [e >= 0 for e in entries] == [True, True, True, False, True, False]
    assert [array.values_of(e).tolist() for e in entries if e >= 0] == [[2, 3], [], [1], [4]]


def test_driver_holds_names_alone(spark):
    """Rules are in files, none in the function that is sent to tasks."""
    rules = spark.range(2000).selectExpr("concat('host', id, '.example') AS host", "'/' AS path", "'block' AS verdict")
    url_filter = urls.UrlFilter.build(rules, part_bytes=16 << 10)
    assert 4 <= len(url_filter.hosts.files) <= 16 and set(vars(url_filter)) == {"hosts", "rules", "labels", "default"}
    pages = spark.range(3000).selectExpr("id AS page_id", "concat('http://www.host', id, '.example/x') AS url")
    counts = dict(map(tuple, urls.judged(pages, url_filter).groupBy("verdict").count().collect()))
    assert counts == {"block": 2000, "allow": 1000}
