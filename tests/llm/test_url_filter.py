from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from docgraph.llm import url_filter
from docgraph.llm.queries import URL_RULES
from docgraph.llm.url_filter import MAX_LISTED, build_cascade, judge_urls

LISTED = ["spam.example.org", "bad.test"]


def judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = lambda h: host == h or host.endswith("." + h)
    best = max((r for r in URL_RULES if host and fits(r[0]) and path.startswith(r[1])), key=lambda r: len(r[0] + r[1]), default=None)
    if best:
        return host, path, best[0] + best[1], best[2]
    return host, path, None, "block" if host and any(map(fits, LISTED)) else "allow"


URLS = [
    None,
    "",
    "no scheme",
    "://",
    "http://",
    "http://com/",
    "http://com",
    "http://com?x",
    "http://WWW.Example.COM/en/a?b#c",
    "https://example.com/en/",
    "https://example.com/EN/",
    "https://m.example.com/en/x",
    "https://a.www.example.com/en/x",
    "https://notexample.com/en/x",
    "https://x.net/es/1",
    "https://x.net/fr/1#top",
    "https://x.net/de/1",
    "https://net/es/",
    "https://spam.example.org/",
    "https://www.spam.example.org",
    "https://nospam.example.org/a",
    "https://bad.test?x=://y",
    "a://b://c/en/",
    "http://ÄÖ.com/é?ü",
    "http://x.com:80/",
    "http://.com/",
    "http://" + "a." * 5000 + "example.com/en/" + "p" * 50_000,
    "http://line\nbreak.com/en/\nx",
]


def frames(spark, urls):
    rows = [(k if k % 9 else None, u, "h", "r") for k, u in enumerate(urls)] + [(5, "https://example.com/en/", "h", "r")] * 2
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, rule string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return rows, pages, rules, spark.createDataFrame([(h,) for h in LISTED], "host string")


@pytest.mark.parametrize("bound", [MAX_LISTED, 1])
def test_against_the_rules_in_python(spark, bound):
    """With cascades and, beyond their bound, by joins."""
    rows, pages, rules, listed = frames(spark, URLS)
    found = judge_urls(pages, rules, listed, bound)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    want = sorted(((r[0], *judged(r[1])) for r in rows), key=str)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want


def test_empty_tables(spark):
    _, pages, rules, listed = frames(spark, ["http://com/"])
    assert judge_urls(pages.limit(0), rules, listed).collect() == []
    alone = judge_urls(pages, rules.limit(0), listed.limit(0)).collect()
    assert {(r.rule, r.verdict) for r in alone} == {(None, "allow")}


def test_cascade_is_exact(spark):
    rng = random.Random(3)
    keys = [f"k{n}" for n in range(20_000)]
    listed = set(rng.sample(keys, 700))
    universe = spark.createDataFrame([(k,) for k in keys], "key string")
    frame = spark.createDataFrame([(k,) for k in [*listed, "elsewhere"]], "key string")
    cascade = build_cascade(universe, frame)
    assert len(cascade.levels) > 1
    found = {r.key for r in universe.filter(cascade.holds(F.col("key"))).collect()}
    assert found == listed
    bits = sum(level.bits for level in cascade.levels)
    assert bits < 16 * len(listed)


def test_a_cascade_that_does_not_end_fails(spark, monkeypatch):
    """Keys that no hash tells apart are an error, not an endless loop."""
    monkeypatch.setattr(url_filter, "_position", lambda key, seed, j, bits: F.pmod(F.length(key).cast("long"), F.lit(bits).cast("long")))
    monkeypatch.setattr(url_filter, "MOST_LEVELS", 3)
    universe = spark.createDataFrame([("ab",), ("cd",)], "key string")
    with pytest.raises(RuntimeError, match="told apart"):
        url_filter.build_cascade(universe, universe.filter("key = 'ab'"))


def test_judging_neither_joins_nor_moves_the_pages(spark):
    _, pages, rules, listed = frames(spark, URLS)
    plan = judge_urls(pages, rules, listed)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "Python" not in plan
