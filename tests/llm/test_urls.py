import re

import numpy as np

from tablewright.llm.url_rules import DEFAULT_RULES, judge, rule_table

PAGES = "page_id long, url string, html string, key string, stack string, part int"


def brute(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), h.count("."), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def check(spark, urls, rules, parts=None):
    pages = spark.createDataFrame([(i, u, "<p>", "k", "s", 1) for i, u in urls], PAGES)
    got = [tuple(r) for r in judge(pages, rule_table(spark, rules), parts=parts).collect()]
    order = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)
    assert sorted(got, key=order) == sorted(((i, *brute(u, rules)) for i, u in urls), key=order)


def test_nested_rules_by_brute_force(spark):
    rng = np.random.default_rng(3)
    hosts = ["net", "a.net", "b.a.net", "c.b.a.net", "xa.net", "a-b.net", "org", "a.org", "net.org", "com", ""]
    paths = ["", "/", "/a", "/a/", "/a/b", "/ab", "/A", "/ü/x", "/" + "z" * 300]
    rules = {(h, p): "allow" if rng.random() < 0.5 else "block" for h in hosts[:-1] for p in paths if rng.random() < 0.4}
    urls = [(int(i), f"{s}://{hosts[rng.integers(len(hosts))].upper()}{paths[rng.integers(len(paths))]}{t}") for i, s, t in
            zip(rng.integers(0, 90, 400), rng.choice(["http", "HTTPS", ""], 400), rng.choice(["", "?q=/x", "#/a", "/more"], 400))]
    check(spark, urls, [(v, h, p) for (h, p), v in rules.items()], parts=7)


def test_odd_urls(spark):
    urls = [(1, None), (1, None), (None, "http://x.net/"), (2, ""), (3, "x.net/de/"), (4, "http://example.net"), (5, "http://example.net/en/a://b/"), (6, "a\n://X.ORG/fr/\n?"),
            (7, "http://example.com./de/"), (8, "http://.net/"), (9, "http://example.com:80/de/"), (10, "://")] + [(11, "https://www.example.net/en/same")] * 30
    check(spark, urls, DEFAULT_RULES, parts=5)
    check(spark, urls, [], parts=2)
    check(spark, [], DEFAULT_RULES)
    # a common host, one common url and deep nesting over many ranges
    check(spark, [(i % 500, f"http://hot.net/{'a' * (i % 40)}") for i in range(3000)], [("block" if n % 2 else "allow", "net", "/" + "a" * n) for n in range(30)], parts=16)


def test_repeated_rules_and_copies(spark):
    pages = spark.createDataFrame([(1, "http://a.b/x", "", "", "", 1)] * 10_000, PAGES)
    rules = rule_table(spark, [("allow", "A.b", "/"), ("block", "a.b", "/"), ("allow", None, "/")])
    got = judge(pages, rules).groupBy("page_id", "rule", "verdict").count().collect()
    assert [tuple(r) for r in got] == [(1, "a.b/", "block", 10_000)]
