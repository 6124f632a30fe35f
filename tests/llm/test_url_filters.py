from __future__ import annotations

import random

from assaycast.llm import url_filters as uf


def brute(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url[url.index("://") + 3 :]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


RULES = [
    ("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
    ("block", "org", "/fr/a"), ("allow", "org", "/fr/a/b"), ("block", "a.org", "/fr"), ("block", "b.a.org", "/"), ("allow", "xn", ""),
]
URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://EXAMPLE.NET/en/x?q=/de/", "http://example.net", "http://example.net/en",
    "http://www.example.net/en/", "http://badexample.net/en/", "http://net./", "http://.net/", "http://a..net/", "http://xn", "http://a.xn?/x",
    "http://x.com://y.net/", "http://ÀB.net/É", "http://h.org/fr/a/b/c", "http://h.org/fr/a/c", "http://b.a.org/fr/a/b", "http://a.org\n/fr/",
    "http://example.com/de/" + "x" * 50_000, "http://" + "s." * 60 + "example.com/de/#f", "http://example.com/DE/",
]


def test_against_brute_force(shipped, clash):
    rng = random.Random(4)
    more = [
        f"http://{'.'.join(rng.choice(['a', 'b', 'www', 'example']) for _ in range(rng.randrange(4)))}.{rng.choice(['net', 'org', 'com', 'xn'])}"
        f"{rng.choice(['', '/'])}{rng.choice(['fr/', 'en/', 'de/', ''])}{rng.choice(['a', 'a/b', '', '?x'])}"
        for _ in range(500)
    ]
    urls = URLS + more + more[:20]
    pages = shipped.createDataFrame([(None if k % 50 == 7 else k % 400, u) for k, u in enumerate(urls)], "page_id long, url string")
    want = sorted([(-1 if r[0] is None else r[0], *[str(x) for x in brute(r[1], RULES)]) for r in pages.collect()])
    for per_task in (1_000_000, 3):
        got = uf.filter_urls(clash(pages), uf.rule_rows(shipped, RULES), points_per_task=per_task).collect()
        assert sorted([(-1 if r[0] is None else r[0], *[str(x) for x in r[1:]]) for r in got]) == want


def test_no_rules_and_no_pages(shipped):
    pages = shipped.createDataFrame([(1, "http://a.net/x"), (1, "http://a.net/x")], "page_id long, url string")
    got = uf.filter_urls(pages, uf.rule_rows(shipped, RULES).limit(0), default="block").collect()
    assert [tuple(r) for r in got] == [(1, "a.net", "/x", None, "block")] * 2
    assert uf.filter_urls(pages.limit(0), uf.rule_rows(shipped, RULES)).count() == 0


def test_no_python_in_the_plan(shipped):
    pages = shipped.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    plan = uf.filter_urls(pages, uf.rule_rows(shipped, RULES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
