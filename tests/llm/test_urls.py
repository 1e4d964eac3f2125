from __future__ import annotations

from mergelens.llm.queries import URL_RULES
from mergelens.llm.urls import UrlRule, judge

CASES = [
    ("http://example.net/en/1", "example.net", "/en/1", "example.net/en/", "allow"),
    ("http://a.example.net/de/", "a.example.net", "/de/", "net/", "block"),
    ("http://A.Example.NET/EN/1", "a.example.net", "/EN/1", "net/", "block"),
    ("http://badexample.net", "badexample.net", "", None, "allow"),
    ("x://www.example.com/de/x?u=://b.net/", "www.example.com", "/de/x", "example.com/de/", "block"),
    ("https://notexample.com/de/1", "notexample.com", "/de/1", None, "allow"),
    ("http://www.org/fr/#top", "www.org", "/fr/", "org/fr/", "allow"),
    ("http://blog.casino-win.example.org/en/", "blog.casino-win.example.org", "/en/", None, "block"),
    ("http://casino.example.org/win", "casino.example.org", "/win", None, "allow"),
    ("example.net/en/1", "", "", None, "allow"),
    ("http://?q", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def pages(spark, urls):
    rows = [(i, u, "x", "y", "z") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, rule string, token string")


def test_cases_and_repeated_rows(spark):
    got = judge(pages(spark, [c[0] for c in CASES] * 2), "page_id", "url", URL_RULES).collect()
    assert len(got) == 2 * len(CASES)
    for row in got:
        assert tuple(row)[1:] == CASES[row.page_id % len(CASES)][1:], row


def test_rules_without_tokens_and_strength(spark):
    rules = [
        UrlRule("any", "block", "x", (), 1),
        UrlRule("digits", "allow", r"/\d+$", (), 5),
        UrlRule("word", "block", "^shop", ("shop",), 3),
    ]
    urls = ["h://shop.a/12", "h://shop.a/b", "h://xx/", "h://b/"]
    got = {r.page_id: (r.rule, r.verdict) for r in judge(pages(spark, urls), "page_id", "url", rules).collect()}
    assert got == {0: ("digits", "allow"), 1: ("word", "block"), 2: ("any", "block"), 3: (None, "allow")}


def test_empty_table(spark):
    assert judge(pages(spark, []), "page_id", "url", URL_RULES).count() == 0
