from collections import Counter

import numpy as np

from faresight.llm import url_filter as U
from faresight.llm.text import random_words
from tests.conftest import SF_SMALL


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if c.isascii() else c for c in host), rest[:end]


def judged(urls, rules=U.RULES, least=2):
    split = [parts(u) for u in urls]
    pages = Counter(p for p in split if p[0])
    out = []
    for host, path in split:
        fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fit, key=lambda r: len(r.host + r.path), default=None)
        listed = pages[host, path] >= least
        out.append((host, path, best and best.host + best.path, listed,
                    best.verdict if best else "block" if listed else "allow"))
    return out


URLS = [None, "", "no scheme", "http://COM/", "https://www.Example.com/en/x?y#z", "http://example.com/en/", "http://example.com/en",
        "http://a.example.com/en/q", "http://x.net/es/1", "http://net/fr/", "http://x.net/fr", "http://notexample.com/en/",
        "http://a.org/p?s=1", "https://a.org/p?s=2", "http://a.org/q#", "a://b://c.com/", "http://x.com?a/b", "http://", "://com/",
        "http://ÄB.org/Ä", "http://x.www.example.com/en/", "http://a..com/", "http://a.org/p#f"]


def run(spark, urls, **more):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rows = {r["page_id"]: r for r in U.judge_urls(spark, pages, **more).collect()}
    return [tuple(rows[i][c] for c in ("host", "path", "rule", "listed_address", "verdict")) for i in range(len(urls))]


def test_cases(spark):
    assert run(spark, URLS) == judged(URLS)


def test_keys_and_cascades_by_shard_give_the_same(spark):
    assert run(spark, URLS, broadcast_bytes=0) == judged(URLS)


def test_query_equals_plain_rules(spark):
    from faresight.llm.registry import op7_url_filters
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    want = dict(zip((p["page_id"] for p in pages), judged([p["url"] for p in pages])))
    got = op7_url_filters(spark, SF_SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["listed_address"], r["verdict"]) == want[r["page_id"]]


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert U.judge_urls(spark, pages).collect() == []


def test_cascade_is_exact_over_its_universe():
    for n, share in ((0, 0), (1, 1.0), (5000, 0.01), (5000, 0.5), (5000, 0.99), (300, 0.0), (300, 1.0)):
        h1, h2 = random_words(n, 1), random_words(n, 2)
        listed = np.arange(n) < share * n
        levels = U._unpacked(U._packed(U.build_cascade(h1, h2, listed)))
        assert (U.cascade_contains(levels, h1, h2) == listed).all()
        if share == 0.01:  # a few bits for each listed key, not for each key
            assert 2 <= len(levels) and sum(len(w) for *_, w in levels) < 50 * 6
