"""URL rules against regular expressions."""

import random
import re

from barorail.llm.urls import RULES, HostRule, ShiftAnd, judge_urls


def as_regex(glob):
    parts = re.split(r"(\*\*|\*|\?)", glob)
    kinds = {"**": "(?s:.*)", "*": "[^/]*", "?": "(?s:.)"}
    return re.compile("".join(kinds.get(p, re.escape(p)) for p in parts))


def test_automaton_against_regular_expressions():
    rng = random.Random(3)
    letters = "ab/.é\U0001f600"
    globs = ["".join(rng.choice(letters[:4] + "**?") for _ in range(rng.randint(1, 30))) for _ in range(40)]
    globs = [re.sub(r"\*{3,}", "**", g) for g in globs] + ["**", "*", "?", "a"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(400)] + ["", "a" * 5000]
    found = ShiftAnd(globs).fits(texts)
    for i, t in enumerate(texts):
        assert [bool(as_regex(g).fullmatch(t)) for g in globs] == found[i].tolist(), t


def test_rules(spark):
    urls = {
        "http://net/x": ("net", "/x", "net/", "block"),
        "http://a.Example.NET/en/?q": ("a.example.net", "/en/", "example.net/en/", "allow"),
        "http://example.net/de": ("example.net", "/de", "net/", "block"),
        "http://example.net": ("example.net", "", None, "allow"),
        "http://notnet/": ("notnet", "/", None, "allow"),
        "http://a.com/x.net/": ("a.com", "/x.net/", None, "allow"),
        "x://org/fr/#a": ("org", "/fr/", "org/fr/", "allow"),
        "http:///net/": ("", "/net/", None, "allow"),
        "no scheme.net/": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "http://best-casino.com/x": ("best-casino.com", "/x", None, "block"),
        "http://É.com://net/\n": ("É.com:", "//net/\n", None, "allow"),
        "http://a.net/" + "x" * 20000: ("a.net", "/" + "x" * 20000, "net/", "block"),
    }
    rows = [(i, u, "h") for i, u in enumerate(urls)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = sorted((r["page_id"], tuple(r)[1:5]) for r in judge_urls(df).collect())
    assert got == sorted((i, w) for i, w in enumerate(urls.values()) for _ in range(2))
    assert judge_urls(df.limit(0)).collect() == []


def test_many_rules_take_many_words():
    rules = [HostRule(f"site{i}.com/{'p' * (i % 7)}", "block") for i in range(300)]
    automaton = ShiftAnd([g for r in (*rules, *RULES) for g in r.globs()])
    assert automaton.move.shape[1] > 50
    found = automaton.fits(["site299.com/" + "p" * 6, "x.site299.com/", "site299.com"])
    assert found.sum(axis=1).tolist() == [1, 0, 0]
