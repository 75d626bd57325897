"""Rules against plain string work, and trees on URLs that no rule has seen."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ripplelog.llm.queries import OP13_RULES, QUERIES
from ripplelog.llm.url_filter import ALLOW, BLOCK, Rule, features, filter_urls

TYPE = "page_id long, url string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    tail = rest[end:]
    stop = min((i for i in (tail.find(c) for c in "?#") if i >= 0), default=len(tail))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    return host, tail[:stop]


def ruled(url, rules):
    host, path = parts(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return min(fits, key=lambda r: (-len(r.text), r.text), default=None)


ODD = [
    None, "", "no scheme/en/", "http://", "http://NET", "http://NET/", "http://a.b.net?x=/en/", "http://example.net/en", "https://Example.NET/en/1", "https://myexample.net/en/1", "http://x.example.com/de/?a=1&b=2",
    "http://x.example.com/DE/", "http://org/fr/", "ftp://a://b.net/c", "http://ü.Österreich.org/fr/x#y", "http://net./", "http://a.net/\nx", "http://example.com#/de/", "x" * 300_000 + "://q.net/" + "1" * 300_000,
]


@pytest.fixture(scope="module")
def pages():
    """Shops with many parameters and digits on ever new hosts, and plain articles; the end of the name doesn't tell them apart."""
    rng, rows = random.Random(8), []
    for i in range(2400):
        end = rng.choice(["com", "org"])
        if i % 2:
            url = f"http://{'-'.join(rng.choice(['win', 'best', 'free', 'bet']) for _ in range(3))}{rng.randrange(10**6)}.{end}/p/q/{rng.randrange(10**9)}?id={rng.randrange(10**8)}&ref={rng.randrange(10**6)}&s=1"
        else:
            url = f"https://{''.join(rng.choice('aeioulmnrst') for _ in range(7))}.{end}/{''.join(rng.choice('aeioulmnrst') for _ in range(12))}"
        rows.append((i, url))
    return rows


def test_rules(spark):
    rules = [*OP13_RULES, Rule(ALLOW, "net/e"), Rule(BLOCK, "osterreich.org/"), Rule(BLOCK, "Österreich.org/fr/x"), Rule(ALLOW, "b.net")]
    rows = [(i, u) for i, u in enumerate(ODD * 2)]
    found = {r.page_id: r for r in filter_urls(spark.createDataFrame(rows, TYPE).repartition(3), rules).collect()}
    assert len(found) == len(rows)
    for i, url in rows:
        r, rule = found[i], ruled(url, rules)
        assert (r.host, r.path) == parts(url) and r.url == url
        assert (r.rule, r.verdict) == (rule.text, rule.verdict) if rule else (r.rule is None and r.verdict == ALLOW)  # too few to learn from


def test_trees_judge_hosts_that_no_rule_knows(spark, pages):
    hosts = [(i, parts(u)[0]) for i, u in pages]
    rules = [Rule(BLOCK if i % 2 else ALLOW, f"{h}/") for i, h in hosts[:300]]
    found = filter_urls(spark.createDataFrame(pages, TYPE).repartition(2), rules).collect()
    right = Counter((r.rule is None, r.verdict == (BLOCK if r.page_id % 2 else ALLOW)) for r in found)
    assert right[False, False] == 0 and right[False, True] >= 300
    assert right[True, True] / (right[True, True] + right[True, False]) > 0.97


def test_query(spark, pages, tmp_path):
    rng = random.Random(1)
    ends = ["example.net/en/", "example.net/de/", "example.com/de/", "example.com/en/", "example.org/fr/", "example.org/en/"]
    rows = [*[(i, u) for i, u in enumerate(ODD, 10_000)], *[(20_000 + i, f"https://www.h{i % 40}.{rng.choice(ends)}{i}") for i in range(400)], *pages]
    spark.createDataFrame(rows, TYPE).withColumn("html", F.lit("x")).repartition(2).write.parquet(f"{tmp_path}/pages.parquet")
    found = {r.page_id: r for r in QUERIES["op13_url_filter"](spark, str(tmp_path)).collect()}
    assert len(found) == len(rows) and {r.verdict for r in found.values()} <= {ALLOW, BLOCK}
    for i, url in rows:
        rule, r = ruled(url, OP13_RULES), found[i]
        assert (r.host, r.path, r.rule) == (*parts(url), rule.text if rule else None) and (rule is None or r.verdict == rule.verdict)
    # by their look, English pages are like those that the rules allow
    assert {r.verdict for r in found.values() if r.rule is None and r.path.startswith("/en/")} == {ALLOW}


def test_features(spark):
    urls = ["http://a-b.c.example.org/x/y1?q=1&r=2#top", "", None, "日本://é.x/12"]
    rows = spark.createDataFrame([(i, u, *parts(u)) for i, u in enumerate(urls)], "id int, url string, host string, path string")
    found = {r.id: r for r in features(rows).collect()}
    u, r = urls[0], found[0]
    entropy = -sum(n / len(u) * math.log2(n / len(u)) for n in Counter(u).values())
    assert (r.length, r.host_length, r.names, r.hyphens, r.depth, r.parameters) == (len(u), 17, 4, 1, 2, 2)
    assert abs(r.entropy - entropy) < 1e-9 and abs(r.digit_ratio - 3 / len(u)) < 1e-9
    assert (r.suffix1, r.suffix2, r.suffix3, r.segment) == ("org", "example.org", "c.example.org", "x")
    assert found[1].entropy == found[2].entropy == 0 and found[2].length == 0
    assert abs(found[3].entropy + sum(n / len(urls[3]) * math.log2(n / len(urls[3])) for n in Counter(urls[3]).values())) < 1e-9


def test_columns_of_clashing_names_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, "http://a.net/x"), (1, "http://a.net/x"), (2, None)], TYPE)
    odd = rows.withColumns({c: F.lit("odd") for c in ("host", "rule", "verdict", "length", "features", "prediction", "_row", "_found", "a.b", "blocked", "suffix1")})
    found = filter_urls(odd, OP13_RULES)
    assert sorted((r.page_id, r.host, r.rule, r.verdict, r["length"], r["a.b"]) for r in found.collect()) == [(1, "a.net", "net/", BLOCK, "odd", "odd")] * 2 + [(2, "", None, ALLOW, "odd", "odd")]
    assert filter_urls(rows.limit(0), OP13_RULES).collect() == []
