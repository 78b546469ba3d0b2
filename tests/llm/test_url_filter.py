import pytest

from wayfarer.llm import url_filter as U

URLS = [None, "", "no scheme.net/", "http://a.net", "http://a.net/", "HTTP://A.NET/x?y#z", "https://example.net/en/1",
        "https://sub.Example.NET/en", "https://badexample.net/en/", "http://example.com/de/", "http://example.com/den/",
        "http://x.org/fr/?q", "http://org/fr/", "http://x.org/en/", "ftp://u@h.net:80/", "http://net./", "http://a.net?x/",
        "http://a.net#/", "x://y://z.net/", "http://a..net/", "http://\n.net/a\nb"]


def slow(url):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = tail[:min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(h + p, v) for h, p, v in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, "allow"))
    return host, path, rule, verdict


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame([(i, u, "h", "p", "x") for i, u in enumerate(URLS)] * 2,
                                 "page_id long, url string, h string, host string, verdict string")


@pytest.mark.parametrize("limit", [U.MAX_BROADCAST_BYTES, 0])
def test_trie_and_join_match_definition(spark, pages, limit):
    got = [(r.page["page_id"], *r.url_rule) for r in U.judge(pages, U.RULES, max_broadcast_bytes=limit).collect()]
    assert sorted(got, key=repr) == sorted([(i, *slow(u)) for i, u in enumerate(URLS)] * 2, key=repr)


@pytest.mark.parametrize("limit", [U.MAX_BROADCAST_BYTES, 0])
def test_longest_match_between_allow_and_block(spark, limit):
    rules = spark.createDataFrame([("b.com", "", "block"), ("a.b.com", "", "allow"), ("a.b.com", "/x/y", "block"),
                                   ("a.b.com", "/x/yes/", "allow"), ("c.com", "/", "allow"), ("c.com", "/", "block"),
                                   (None, "/", "block")], "host string, path string, verdict string")
    urls = ["u://q.b.com/", "u://a.b.com/x", "u://z.a.b.com/x/yell", "u://a.b.com/x/yes/1", "u://c.com/", "u://d.com/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page["page_id"]: r.url_rule["verdict"] for r in U.judge(pages, rules, max_broadcast_bytes=limit).collect()}
    assert got == {0: "block", 1: "allow", 2: "block", 3: "allow", 4: "block", 5: "allow"}


def test_no_rules_and_no_rows(spark, pages):
    assert {r.verdict for r in U.judge(pages, []).select("url_rule.verdict").collect()} == {"allow"}
    assert U.judge(pages.limit(0), U.RULES).count() == 0
    assert U.allowed(pages, U.RULES).columns == pages.columns
