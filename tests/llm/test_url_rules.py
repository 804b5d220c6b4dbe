"""URL rules: the index against trying every rule, defined cases."""

import random

from kiln.llm import queries, url_rules
from kiln.llm.url_rules import HostRule, PatternRule, RuleIndex, split_url


def brute(url, rules):
    host, path = split_url(url)
    fits = [r for r in rules if isinstance(r, HostRule) and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path) and (host or path)]
    if fits:
        best = max(fits, key=lambda r: len(r.name))
        return host, path, best.name, best.action
    hit = {r.action for r in rules if isinstance(r, PatternRule) and (host or path) and r.regex().match(url.translate(url_rules.LOWER))}
    return host, path, None, "block" if hit == {"block"} else "allow"


RULES = [*queries.HOST_RULES, HostRule("block", "bad.example.net", "/"), HostRule("allow", "bad.example.net", "/ok/x"),
         PatternRule("block", "*?*utm_source=*"), PatternRule("allow", "*/safe/*"), PatternRule("block", "*ads*")]


def test_index_equals_all_rules():
    rng = random.Random(3)
    hosts = ["example.org", "a.example.org", "xexample.org", "EXAMPLE.ORG", "org", "www.bad.example.net", "a.com", "com", "", "x.y.fr"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12/", "/en/2", "/fr/9", "/de/1", "/ok/x1", "/safe/1", "/DE/"]
    tails = ["", "?utm_source=a", "#top", "?a=1&utm_source=", "/ads", "?q=/safe/"]
    index = RuleIndex(RULES, {"org": 900, "com": 900, "example": 500, "fr": 3})
    regexes = [r.regex() for r in RULES]
    for _ in range(3000):
        url = rng.choice(["https://", "http://", "", "://"]) + rng.choice(hosts) + rng.choice(paths) + rng.choice(tails)
        assert index.judge(url, regexes) == brute(url, RULES), url


def test_rules_are_filed_under_their_rarest_token():
    index = RuleIndex(RULES, {"org": 900, "com": 900, "example": 500, "es": 4, "en": 5, "fr": 3, "de": 1000, "net": 7, "bad": 2})
    assert index.by_token["es"] == [1] and index.by_token["en"] == [2] and index.by_token["com"] == [4] and 5 in index.by_token["bad"]
    assert [RULES[k].name for k in index.always] == ["*ads*"]


def test_contract_cases():
    rules = queries.HOST_RULES
    index, regexes = RuleIndex(rules, {}), [r.regex() for r in rules]
    judge = lambda url: index.judge(url, regexes)
    assert judge("https://M.Example.org/es/1?x#y") == ("m.example.org", "/es/1", "example.org/es/", "block")
    assert judge("https://a.example.org/en/1695/")[2:] == ("example.org/en/1", "block")
    assert judge("https://a.example.org/en/2")[2:] == ("org/", "allow")
    assert judge("http://a.org")[2:] == (None, "allow") and judge("http://a.org?x=/es/") == ("a.org", "", None, "allow")
    assert judge("http://a.net/x") == ("a.net", "/x", None, "allow")
    assert judge(None) == judge("") == judge("a.org/es/") == ("", "", None, "allow")


def test_messy_rows(spark, result, fixture_table):
    assert len(result("op6_url_rules")) == fixture_table("pages").count()
    rows = [(1, None, "x"), (None, "http://b.com/de/1", None), (2, "http://b.com/de/1", "x"), (2, "http://b.com/de/1", "x"), (3, "x" * 100_000 + "://o.org/", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, rule string")
    got = sorted((r.page_id or 0, r.host, r.rule, r.verdict) for r in url_rules.judge_urls(pages, RULES).collect() if r.rule)
    assert got == [(0, "b.com", "com/de/", "block"), (2, "b.com", "com/de/", "block"), (2, "b.com", "com/de/", "block"), (3, "o.org", "org/", "allow")]
    assert url_rules.judge_urls(pages.limit(0), RULES).count() == 0
