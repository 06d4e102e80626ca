import random
import re

from lacuna.llm import urlfilter as U
from lacuna.llm.oracle import ORACLE
from tests.llm.conftest import duck, same

URLS = ["http://www.Example.com/en/1", "https://example.com/en/x?y#z", "https://blog.example.com/en/2", "https://example.com/de/2", "ftp://x.net/es/1",
        "https://x.net/ES/1", "https://notexample.com/en/", "https://example.com", "https://example.com/en", "https://EXAMPLE.COM/EN/", "no scheme",
        "https://a.com.net/fr/q", None, "", "://", "https:///en/", "http://x.org/login", "http://x.org/login?next=1", "http://x.org/loginpage", "http://blog.x.org/en/login",
        "http://x.org/a?page=1&utm_source=feed", "http://x.org/a?utm_source=feeds", "http://ads.doubleclick.net/x", "http://doubleclick.net.evil.org/", "http://x.org/archive/a/b.html",
        "http://x.org/archive/login/b.html?q", "http://x.org/é/ads/1", "http://x.org/\nlogin", "a" * 5000 + "://h/ads/" + "x" * 5000, "http://x.org/banner/1/click", "http://x.org/?Sort=a&ORDER=b"]


def pages(spark):
    return spark.createDataFrame([(i, u, "<html>", 1, 2, 3) for i, u in enumerate(URLS)] + [(3, URLS[3], "x", 1, 2, 3)], "page_id long, url string, html string, host int, verdict int, tokens int")


def test_equal_to_sql_over_all_rules(spark):
    rows = pages(spark)
    same(U.judge(rows).distinct(), duck({"pages": rows.select("page_id", "url")}, ORACLE["op4_url_filter"]).drop_duplicates())
    assert U.judge(rows).count() == len(URLS) + 1


def test_site_rules_by_hand(spark):
    got = {r.page_id: r for r in U.judge(pages(spark)).collect()}
    want = {0: ("www.example.com/en/", "allow"), 1: ("example.com/en/", "block"), 2: ("example.com/en/", "block"), 3: ("com/", "allow"), 4: ("net/es/", "block"),
            5: (None, "allow"), 6: ("com/", "allow"), 7: (None, "allow"), 8: ("com/", "allow"), 9: ("com/", "allow"), 10: (None, "allow"), 11: ("net/fr/", "block"), 12: (None, "allow")}
    assert {i: (got[i].rule, got[i].verdict) for i in want} == want
    assert (got[0].host, got[0].path) == ("www.example.com", "/en/1") and (got[10].host, got[10].path, got[12].host) == ("", "", "")


def test_every_fitting_url_holds_the_rules_tokens():
    for r in U.default_rules():
        for u in filter(None, URLS):
            m = re.match(U.URL, u)
            place = (m[1].translate(str.maketrans(U.UPPER, U.LOWER)) + m[2]) if m else ""
            if re.search(r.regex, place if r.site else u):
                held = set(re.split("[^a-z0-9]+", u.translate(str.maketrans(U.UPPER, U.LOWER))))
                assert set(r.tokens) <= held, (r, u)


def test_tokens_of_patterns():
    assert U.pattern_rule("block", "||ads.*/click^").tokens == ("ads", "click")
    assert U.pattern_rule("block", "foo*bar").tokens == ()
    assert U.pattern_rule("block", "|http://a.b/c").tokens == ("http", "a", "b")
    assert U.site_rule("block", "x.org", "/en").tokens == ("x", "org")


def test_rules_without_tokens_and_own_rules(spark):
    rules = [U.pattern_rule("block", "*ogi*"), U.site_rule("allow", "x.org", "/log")]
    got = {r.page_id: (r.rule, r.pattern, r.verdict) for r in U.judge(pages(spark), rules, "block").collect()}
    assert got[16] == ("x.org/log", None, "allow") and got[0] == (None, None, "block") and got[19] == ("x.org/log", None, "allow") or got[19][2] == "block"


def fits(pattern: str, url: str) -> bool:
    """The pattern language by itself, place by place, without regular expressions."""
    url, anchored, at_end = url.lower(), False, False
    p = pattern.lower()
    starts = range(len(url) + 1)
    if p.startswith("||"):
        p, anchored = p[2:], True
        scheme, sep, rest = url.partition("://")
        if not sep or not scheme or not scheme[0].isascii() or not scheme[0].isalpha() or any(not (c.isascii() and (c.isalnum() or c in "+.-")) for c in scheme):
            return False
        at = len(scheme) + 3
        host = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        starts = [at] + [at + i + 1 for i, c in enumerate(rest[:host]) if c == "."]
    elif p.startswith("|"):
        p, starts = p[1:], [0]
    if p.endswith("|"):
        p, at_end = p[:-1], True

    def match(i: int, j: int) -> bool:
        if i == len(p):
            return not at_end or j == len(url)
        if p[i] == "*":
            return any(match(i + 1, k) for k in range(j, len(url) + 1))
        if p[i] == "^":
            separator = j < len(url) and not (url[j].isascii() and (url[j].isalnum() or url[j] in "_.%-"))
            return separator and match(i + 1, j + 1) or j == len(url) and match(i + 1, j)
        return j < len(url) and url[j] == p[i] and match(i + 1, j + 1)

    return any(match(0, j) for j in starts)


def test_patterns_equal_an_independent_matcher():
    r = random.Random(4)
    urls = [u for u in URLS if u and len(u) < 300] + ["".join(r.choice(["a", "ads", ".", "/", "?", "=", "-", "_", "%", "é", "x.org", "click", "://"]) for _ in range(12)) for _ in range(200)]
    urls += [r.choice(["http", "ftp", "1x", ""]) + "://" + u for u in urls[-150:]]
    patterns = [p for _, p in U.PATTERN_RULES] + ["".join(r.choice(["a", "ads", ".", "/", "^", "*", "=", "x.org", "click", "?"]) for _ in range(4)) for _ in range(120)]
    patterns += [r.choice(["|", "||"]) + p for p in patterns[-60:]] + [p + "|" for p in patterns[-60:]]
    hits = 0
    for p in patterns:
        rule = U.pattern_rule("block", p)
        for u in urls:
            assert bool(re.search(rule.regex, u)) == fits(p, u), (p, u)
            hits += fits(p, u)
    assert hits > 500


def test_rules_in_groups(spark, monkeypatch):
    want = sorted(map(tuple, U.judge(pages(spark)).collect()), key=str)
    monkeypatch.setattr(U, "GROUP", 7)
    assert sorted(map(tuple, U.judge(pages(spark)).collect()), key=str) == want


def test_many_rules(spark):
    rules = [U.pattern_rule("block", f"/p{i}/*") for i in range(30_000)] + [U.site_rule("allow", "x.org", "/p7/")]
    rows = spark.createDataFrame([(i, f"http://h.org/a/p{i * 6000}/b") for i in range(6)] + [(9, "http://x.org/p7/p29999/")], "page_id long, url string")
    got = {r.page_id: (r.rule, r.pattern, r.verdict) for r in U.judge(rows, rules).collect()}
    assert got == {**{i: (None, f"/p{i * 6000}/*", "block") for i in range(5)}, 5: (None, None, "allow"), 9: ("x.org/p7/", None, "allow")}


def test_no_rules(spark):
    assert {r.verdict for r in U.judge(pages(spark), [], "block").collect()} == {"block"}


def test_empty_table(spark):
    assert U.judge(pages(spark).limit(0)).count() == 0
