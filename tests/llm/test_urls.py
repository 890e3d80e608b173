"""URL rules against a brute force over all rules."""
import random

import pytest

from clientlens.llm import urls

SCHEMA = "page_id long, url string, host string, rule int, key string"


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.host) + len(r.path), len(r.host)), default=None)
    return host, path, best and best.host + best.path, best.verdict if best else default


def sample():
    r = random.Random(8)
    hosts = ["org", "example.org", "www.example.org", "WWW.Example.ORG", "badexample.org", "a.com", "b.a.com", "com", "org.com", "x.de", "", "a..com", "é.org", "org."]
    paths = ["", "/", "/fr/", "/fr", "/fr/1?x=/de/", "/en/1", "/en/12#/es/", "/en/2", "/es/x", "/de/é", "?a://b", "#t"]
    out = [(i, r.choice(["http://", "https://", "x://"]) + r.choice(hosts) + r.choice(paths)) for i in range(400)]
    return out + [(1000, None), (1001, ""), (1002, "no scheme/fr/"), (1003, "://"), (1004, "a://b://c/fr/"), (None, "http://a.com/fr/"), (1, out[1][1]), (1005, "http://a.com/" + "y" * 100000)]


RULES = urls.RULES + (urls.Rule("block", "a.com", "/"), urls.Rule("allow", "b.a.com", "/fr/"), urls.Rule("block", "com", ""), urls.Rule("allow", "é.org", "/"))


@pytest.mark.parametrize("rules,most", [(urls.RULES, 50_000), (RULES, 50_000), (RULES, 2), ((), 1)])
def test_rules_match_brute_force(spark, monkeypatch, rules, most):
    monkeypatch.setattr(urls, "PASS", most)
    rows = sample()
    got = urls.judge_urls(spark.createDataFrame([(i, u, "h", 1, "k") for i, u in rows], SCHEMA), rules).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, *brute(u, rules)) for i, u in rows), key=str)


def test_empty_table(spark):
    assert urls.judge_urls(spark.createDataFrame([], SCHEMA)).collect() == []
