"""URL filters against the rules applied one by one, and the host and path grammar on odd URLs."""
import random

import pytest
from panelscore.llm import url_filter

ODD = [None, "", "no scheme/at all", "http://", "://a.net", "http://A.B.EXAMPLE.NET/en/x?y#z", "https://example.net/en/", "https://example.net/en",
       "http://net/", "http://net", "http://x.internet/", "http://example.com/de/..", "http://a.example.com/fr/", "ftp://a.org/fr/?q", "http://a.org?x/fr/",
       "http://a.org#/fr/", "http://u@example.net:80/en/", "http://.net/", "x://y://net/", "http://a.org//fr/", "http://Ä.NET/", "http://" + "a." * 3000 + "net/" + "x/" * 3000]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:n], rest[n:]
    m = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:m]


def judge(url, rules):
    host, path = parts(url)
    fit = [(len(h + p), a == "block", h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


@pytest.mark.parametrize("rules", [url_filter.RULES, (("example.net", "/e", "block"), ("net", "/en/x", "allow"), ("b.example.net", "/en/", "block"), ("a.org", "/", "block"), ("a.org", "/", "allow"))])
def test_verdicts_are_those_of_the_rules_one_by_one(spark, rules):
    rnd = random.Random(1)
    urls = ODD + ["http://" + ".".join(rnd.choice(["a", "b", "example", "net", "com", "org", "WWW"]) for _ in range(rnd.randint(1, 4))) + rnd.choice(["", "/", "/en/", "/en/x", "/de/", "/fr/1", "?a", "#b", "/e"])
                  for _ in range(400)]
    pages = spark.createDataFrame([(i, u, "host", "rule") for i, u in enumerate(urls)], "page_id long, url string, host string, key string")
    table = spark.createDataFrame(list(rules), "host string, path string, action string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, table).collect()}
    assert got == {i: judge(u, rules) for i, u in enumerate(urls)}


def test_repeated_and_null_rows_empty_tables_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, None)], "page_id long, url string")
    rules = spark.createDataFrame(list(url_filter.RULES) + [(None, "/", "block"), ("com", None, "block")], "host string, path string, action string")
    rows = sorted(map(str, (tuple(r) for r in url_filter.judge_urls(pages, rules).collect())))
    assert rows == sorted(map(str, [(1, "a.net", "/", "net/", "block")] * 2 + [(None, "", "", None, "allow")]))
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_filter.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_main_path_is_native(spark, sf_dir):
    from test_fingerprints import python_free
    assert python_free(url_filter.query(spark, sf_dir))
