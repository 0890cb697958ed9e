import random

import pytest

from marginalia.llm import urls
from marginalia.llm.queries import QUERIES


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [i for i, c in enumerate(rest) if c in "/?#"] + [len(rest)]
    host, tail = rest[: ends[0]], rest[ends[0] :]
    ends = [i for i, c in enumerate(tail) if c in "?#"] + [len(tail)]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[: ends[0]]


def rule_for(url):
    host, path = parts(url)
    fits = [(h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda f: len(f[0]), default=(None, None))


ODD = [
    None, "", "no scheme", "http://", "https://Example.COM/de/x", "http://example.com/de", "http://example.com/de/", "http://notexample.com/de/",
    "http://a.net", "http://a.net/", "http://a.net?x=/", "http://example.net/en/1", "http://x.example.net/en/1", "http://example.net/EN/1",
    "http://ÉXAMPLE.org/fr/", "http://a.org/fr/#f", "//a.net/", "x://y://z.net/q", "http://u@a.net:80/", "http://a.net:80/", "http://a\n.net/\nb?c",
    "http://" + "a" * 50_000 + ".net/" + "b" * 50_000,
]


def test_hosts_paths_and_rules(frame):
    df = frame([(i, u, "x", "y") for i, u in enumerate(ODD)] + [(4, ODD[4], "x", "y")], "page_id long, url string, host string, score string")
    got = urls.filter_urls(df).collect()
    assert len(got) == len(ODD) + 1
    for r in got:
        rule, verdict = rule_for(ODD[r.page_id])
        assert (r.host, r.path, r.rule) == (*parts(ODD[r.page_id]), rule), ODD[r.page_id]
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")


def test_learns_lexical_features(frame):
    random.seed(4)

    def bad():
        return f"http://{random.randint(10**7, 10**9)}.win{random.randint(0, 99)}.tk/{random.randint(1, 10**6)}?a={random.random()}&b=1&c=2"

    def good():
        return f"https://www.{random.choice(['news', 'wiki', 'lab'])}.example.edu/articles/{random.choice(['cats', 'trees', 'rivers'])}"

    rows = [(bad(), 1.0) if i % 2 else (good(), 0.0) for i in range(400)]
    df = frame(rows, "_url string, label double")
    host, path = urls.split_url(df._url)
    model = urls.fit(df.withColumns({"host": host, "path": path}))
    fresh = frame([(i, bad() if i % 2 else good()) for i in range(200)], "page_id long, url string")
    got = urls.filter_urls(fresh, rules=(), model=model).collect()
    assert sum((r.verdict == "block") == bool(r.page_id % 2) for r in got) >= 195


@pytest.mark.parametrize("url,verdict", [("http://a.net/", "block"), ("http://a.org/fr/", "allow"), ("http://a.de/", "allow")])
def test_one_class_or_none(frame, url, verdict):
    got = urls.filter_urls(frame([(1, url), (2, "http://other.info/")], "page_id long, url string")).collect()
    assert {r.page_id: r.verdict for r in got} == {1: verdict, 2: verdict if url != "http://a.de/" else "allow"}


def test_empty(spark):
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_entropy(frame):
    df = frame([("aabb",), ("",), ("aaaa",), ("abcd",)], "u string")
    assert dict(df.select("u", urls.entropy(df.u)).collect()) == {"aabb": 1.0, "": 0.0, "aaaa": 0.0, "abcd": 2.0}


def test_given_pages(spark, small):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    got = QUERIES["op1_url_filter"](spark, small).collect()
    assert len(got) == len(pages)
    for r in got:
        rule, verdict = rule_for(pages[r.page_id])
        assert (r.host, r.path, r.rule) == (*parts(pages[r.page_id]), rule)
        assert r.verdict == (verdict or r.verdict)


def test_no_python_on_executors(spark, small):
    plan = QUERIES["op1_url_filter"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
