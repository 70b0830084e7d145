import re

from cellweave.llm import queries, url_filter

RULES = queries.URL_RULES


def plain(url):
    """Host, path, rule and its verdict by the wording of the contract."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in RULES:
        name, _, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
            if best is None or len(rule) > len(best[1]):
                best = (verdict, rule)
    return host, path, best


def check(rows):
    for r in rows:
        host, path, best = plain(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best[1])
        assert r["verdict"] == best[0] if best else r["verdict"] in ("allow", "block")


def test_rules_on_odd_urls(spark):
    urls = [None, "", "no scheme/x.net/", "http://A.NET/De", "http://net", "http://net?x=/", "x://example.net/en/a://b",
            "http://example.com/de", "http://example.com/de/1#t?x", "http://notexample.com/de/1", "http://É.org/fr/", "http://a.org/fr/1", "://", "http:///x"]
    df = spark.createDataFrame([(u, "kept", i) for i, u in enumerate(urls * 2)], "url string, host string, page_id long")
    rows = url_filter.judge(df, RULES).collect()
    assert len(rows) == 2 * len(urls)
    check(rows)


def test_whole_table(spark, given):
    rows = url_filter.judge(given("pages").select("page_id", "url"), RULES).collect()
    assert len(rows) == given("pages").count()
    check(rows)


def test_templates_learn_and_generalise(spark):
    block = [(f"http://bad{i}.net/ads/{w}",) for i in range(30) for w in ("a1234", "b5678")]
    allow = [(f"http://good{i}.org/fr/{w}",) for i in range(30) for w in ("a1234", "b5678")]
    free = [("http://x.com/ads/c9999",), ("http://x.com/fr/c9999",)]
    slugs = [(f"http://s.com/post/{chr(97 + i % 26)}{'xyz'[i // 26 % 3]}word",) for i in range(60)]
    rows = url_filter.judge(spark.createDataFrame(block + allow + free + slugs, "url string"), RULES).collect()
    found = {r["url"]: r for r in rows}
    assert found["http://x.com/ads/c9999"]["verdict"] == "block"
    assert found["http://x.com/fr/c9999"]["verdict"] == "allow"
    assert {found[u]["template"] for (u,) in slugs} == {"/post/*"}


def test_empty(spark):
    assert url_filter.judge(spark.createDataFrame([], "url string"), RULES).count() == 0
