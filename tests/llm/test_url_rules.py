import random
import re

import pytest

from feira.llm.url_rules import Rule, RuleIndex, judge

RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def split(url):
    found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    if not found:
        return "", ""
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in found[1])
    return host, found[2]


def brute(url, rules, default):
    host, path = split(url)
    fits = []
    for rule in rules:
        known = host == rule.host or host.endswith("." + rule.host)
        pattern = ".*".join(map(re.escape, rule.path.split("*")))
        if known and re.match(pattern, path, re.DOTALL):
            fits.append((-len(rule.name), rule.name, rule.verdict))
    best = min(fits, default=None)
    return (host, path, best and best[1], best[2] if best else default)


def urls(seed=1):
    rng = random.Random(seed)
    out = [None, "", "no scheme", "://", "http://", "http://net", "http://NET/", "HTTP://a.É.Net/x?y#z"]
    out += ["http://x.org/fr", "http://x.org/fr/", "http://notnet/", "a://b://c.net/", "http://e.net/\nen/"]
    for _ in range(300):
        host = ".".join(rng.choice(["www", "example", "ex", "m"]) for _ in range(rng.randrange(1, 3)))
        top = rng.choice(["net", "com", "org", "Org"])
        path = "".join("/" + rng.choice(["en", "de", "fr", "english", "x.net"]) for _ in range(rng.randrange(3)))
        out.append(f"http://{host}.{top}{path}{rng.choice(['', '/', '?a=/en/', '#en'])}")
    return out


MORE = (
    Rule("block", "com", "/en"), Rule("allow", "com", "/*/x."), Rule("block", "example.org", "/d"),
    Rule("allow", "www.example.com", "/en/de/"), Rule("block", "www.ex.net", "/*"), Rule("block", "m.net", ""),
)


@pytest.mark.parametrize("rules", [RULES, RULES + MORE, ()])
@pytest.mark.parametrize("default", ["allow", "block"])
def test_equals_trying_every_rule(spark, rules, default):
    rows = [(k, u, f"own {k}", "v") for k, u in enumerate(urls())]
    rows += [rows[20], (None, rows[20][1], None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    found = judge(pages, rules, default).collect()
    wanted = [(r[0], *brute(r[1], rules, default)) for r in rows]
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)


def test_rules_are_filed_under_their_rarest_token():
    index = RuleIndex(RULES, {"net": 90, "example": 80, "en": 70, "com": 60, "de": 5, "org": 30, "fr": 30})
    filed = {t: [r.name for r, _ in entries] for t, entries in index.by_token.items()}
    assert filed == {"net": ["net/"], "en": ["example.net/en/"], "de": ["example.com/de/"], "fr": ["org/fr/"]}


def test_only_candidates_run_their_expression():
    index = RuleIndex(RULES, {})

    class Never:
        def match(self, place):
            raise AssertionError(place)

    index.by_token = {t: [(r, Never()) for r, _ in e] for t, e in index.by_token.items()}
    assert index.winner("shop.info", "/it/") is None


def test_empty_table_and_too_many_rules(spark, monkeypatch):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert judge(pages, RULES).collect() == []
    monkeypatch.setattr("feira.llm.url_rules.MAX_RULES", 3)
    with pytest.raises(ValueError, match="more than 3"):
        judge(pages, RULES)
