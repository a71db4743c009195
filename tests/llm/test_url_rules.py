from collections import Counter
from itertools import combinations

import pytest

from quarryline.llm import url_rules
from quarryline.llm.queries import LISTED

CASES = [
    ("https://A.Example.NET/en/5?x=1", "a.example.net", "/en/5", "example.net/en/"),
    ("http://example.net/de/", "example.net", "/de/", "net/"),
    ("http://notexample.com/de/x", "notexample.com", "/de/x", None),
    ("http://x.example.com/de/x#y", "x.example.com", "/de/x", "example.com/de/"),
    ("http://a.org/fr/", "a.org", "/fr/", "org/fr/"),
    ("http://a.org/fr", "a.org", "/fr", None),
    ("http://a.net", "a.net", "", None),
    ("http://a.net?x=/", "a.net", "", None),
    ("ftp://a.net#x/y", "a.net", "", None),
    ("a.net/x", "", "", None),
    ("", "", "", None),
    (None, "", "", None),
    ("http://a.net/x://b.org/fr/", "a.net", "/x://b.org/fr/", "net/"),
    ("http://ÄB.net:80/\nx", "Äb.net:80", "/\nx", None),
]


def judged(spark, urls):
    rows = [(i, u, "kept", "p") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string, path string")
    got = url_rules.judge(pages, LISTED).collect()
    assert len(got) == len(urls)
    return {r["page_id"]: r for r in got}


def test_hosts_paths_and_listed_rules(spark):
    got = judged(spark, [c[0] for c in CASES])
    for i, (_, host, path, rule) in enumerate(CASES):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        if rule:
            assert got[i]["verdict"] == next(r.verdict for r in LISTED if r.text == rule)


def brute_force(baskets, min_support, min_confidence):
    """All token combinations with a verdict, less those a part covers as confidently."""
    seen, with_verdict = Counter(), Counter()
    for items, verdict in baskets:
        for n in range(1, len(items) + 1):
            for part in combinations(sorted(items), n):
                seen[part] += 1
                with_verdict[part, verdict] += 1
    least = min_support * len(baskets)
    rules = {
        (part, v): n / seen[part]
        for (part, v), n in with_verdict.items()
        if n >= least and n / seen[part] >= min_confidence
    }
    return {
        (part, v): c
        for (part, v), c in rules.items()
        if not any(
            rules.get((tuple(x for x in part if x != left), v), -1) >= c for left in part
        )
    }


def test_mined_rules_equal_brute_force(spark):
    baskets = []
    for i in range(200):
        items = [f"h0:{'net' if i % 3 else 'com'}", f"p:{i % 5}", f"q:{i % 7}"]
        baskets.append((items, "block" if i % 5 in (1, 2) or (i % 3 and i % 7 == 0) else "allow"))
    df = spark.createDataFrame(baskets, "items array<string>, verdict string")
    got = url_rules.mined_rules(df, 0.02, 0.8).collect()
    want = brute_force(baskets, 0.02, 0.8)
    assert {(tuple(r["items"]), r["verdict"]) for r in got} == set(want)
    for r in got:
        assert r["confidence"] == pytest.approx(want[tuple(r["items"]), r["verdict"]])


def test_the_best_rule_decides(spark):
    urls = [f"http://h{i}.example.net/en/{i}" for i in range(50)] + [f"http://h{i}.net/xx/{i}" for i in range(50)]
    got = judged(spark, [*urls, "http://new.org/en/1", "http://new.org/xx/2", "http://new.org/yy/3"])
    assert [got[i]["verdict"] for i in (100, 101, 102)] == ["allow", "block", "allow"]
    assert got[102]["mined_rule"] is None and got[101]["mined_rule"].endswith("-> block")


def test_repeated_and_no_rows(spark):
    rows = [(1, "http://a.net/x")] * 3 + [(None, None)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string")
    assert url_rules.judge(pages, LISTED).count() == 5
    assert url_rules.judge(pages.limit(0), LISTED).count() == 0
