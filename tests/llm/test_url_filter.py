from __future__ import annotations

import random

from claimlake.llm import url_filter
from claimlake.llm.url_filter import Rule, UrlTrie, judge_urls


def brute(rules, host, path):
    """The longest rule by trying all."""
    fits = [
        (len(r.host) + len(r.path), len(r.host), r.action == "block", r.host + r.path, r.action) for r in rules
        if host and (not r.host or host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits)[3:] if fits else (None, None)


def test_trie_equals_trying_all_rules():
    pick = random.Random(4)
    hosts = [".".join(pick.choices("abc", k=pick.randint(1, 3))) for _ in range(12)] + [""]
    paths = ["".join(pick.choices(["/", "x", "y", "xy"], k=pick.randint(0, 5))) for _ in range(25)]
    rules = [Rule(pick.choice(["allow", "block"]), pick.choice(hosts), pick.choice(paths)) for _ in range(60)]
    trie = UrlTrie(rules)
    for host in [*hosts, "a.b.c.a", "d"]:
        for path in [*paths, "", "/", "/x/y/x"]:
            found = trie.longest(host, path)
            assert (found[3] if found else None, ("allow", "block")[found[2]] if found else None) == brute(rules, host, path)


def test_urls(spark, monkeypatch):
    rules = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "Example.com", "/de/"), Rule("allow", "org", "/fr/")]
    urls = {
        "http://a.Example.NET/en/1?q#f": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "http://example.net/enx": ("example.net", "/enx", "net/", "block"),
        "http://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
        "http://www.example.com/de/x": ("www.example.com", "/de/x", "example.com/de/", "block"),
        "http://x.org": ("x.org", "", None, "allow"),
        "http://x.net?a=http://y.org/fr/": ("x.net", "", None, "allow"),
        "http://x.net:80/": ("x.net:80", "/", None, "allow"),
        "a://b.net/://c.org/fr/": ("b.net", "/://c.org/fr/", "net/", "block"),
        "mailto:x": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "http://É.NET/" + "x" * 100_000: ("É.net", "/" + "x" * 100_000, "net/", "block"),
    }
    pages = spark.createDataFrame([(k, u, 1, "z") for k, u in enumerate([*urls, *urls])] + [(None, None, 1, "z")], "page_id long, url string, host int, rule string")
    want = [(k, *urls[u]) for k, u in enumerate([*urls, *urls])] + [(None, "", "", None, "allow")]
    assert sorted(map(tuple, judge_urls(pages, rules).collect()), key=repr) == sorted(want, key=repr)
    monkeypatch.setattr(url_filter, "MAX_TRIE_RULES", 1)  # a trie per rule gives the same
    assert sorted(map(tuple, judge_urls(pages, rules).collect()), key=repr) == sorted(want, key=repr)
    assert judge_urls(pages.limit(0), rules).collect() == []
    assert {r.verdict for r in judge_urls(pages, [], "block").collect()} == {"block"}
