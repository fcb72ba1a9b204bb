import random

from pyspark.sql import functions as F

from pulsemart.llm import url_rules
from pulsemart.llm.queries import DOMAIN_RULES

SCHEMA = "page_id long, url string, host string, verdict string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min([path.find(c) for c in "?#" if c in path] + [len(path)])]


def by_rules(host, path):
    fits = [r for r in DOMAIN_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name)) if fits else None


URLS = [
    None, "", "x", "://", "http://", "HTTP://WWW.Example.COM/en/1?x#y", "http://example.com", "http://example.com/",
    "http://a.example.com/en/", "http://www.example.com/en/a", "http://b.www.example.com/en/a", "http://notexample.com/en/",
    "http://a.net/es/1", "http://net/fr/", "http://a.net/es", "http://a.org/es/?q", "http://É.com/é#://b", "a://b://c/d",
    "http://x.com?u=/en/", "http://x.com#/en/", "http://a.net/es/\nx", "http://com/",
]


def test_listed_rules(spark):
    rows = spark.createDataFrame([(i, u, "x", None) for i, u in enumerate(URLS + URLS[:3])], SCHEMA)
    none = url_rules.mine_rules(spark.createDataFrame([], "url string, bad boolean"))
    got = {}
    for r in url_rules.judge(rows, none, DOMAIN_RULES, ["page_id"]).collect():
        got[r["page_id"]] = tuple(r)[1:5]
    assert len(got) == len(URLS) + 3
    for i, url in enumerate(URLS):
        host, path = split(url)
        rule = by_rules(host, path)
        assert got[i] == (host, path, rule and rule.name, rule.action if rule else "allow"), url


def labelled(n=1500, seed=3):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a, b = r.choice(["win", "news", "shop"]), r.choice(["bets", "blog", "wiki"])
        bad = (a == "win" and b == "bets") or (r.random() < 0.02)
        out.append((f"https://{a}.site{r.randrange(40)}.org/{b}/{i}.html?id={i}", bad))
    return out


def test_mined_combination(spark):
    rows = spark.createDataFrame(labelled() + [(None, True), ("http://x.org", None)], "url string, bad boolean")
    rules = url_rules.mine_rules(rows)
    got = {tuple(r["items"]): (r["confidence"], r["support"]) for r in rules.collect()}
    assert ("h:win", "p:bets") in got
    # Nothing that a part of it says already.
    assert not any({"h:win", "p:bets"} < set(k) for k in got)
    tokens = [(set(r[0]), r[1]) for r in rows.where("url is not null").select(url_rules.tokens_of(F.col("url")), "bad").collect()]
    for items, (confidence, support) in got.items():
        fits = [bool(bad) for t, bad in tokens if set(items) <= t]
        assert abs(confidence - sum(fits) / len(fits)) < 1e-9 and confidence >= 0.8 and len(fits) >= 20
    pages = spark.createDataFrame([(0, "http://win.new.org/bets/7", "x", None), (1, "http://win.new.org/wiki/7", "x", None), (1, None, None, None)], SCHEMA)
    verdicts = [(r["page_id"], r["verdict"]) for r in url_rules.judge(pages, rules, keep=["page_id"]).collect()]
    assert sorted(verdicts) == [(0, "block"), (1, "allow"), (1, "allow")]


def test_no_bad_labels_no_rules(spark):
    rows = spark.createDataFrame([(u, False) for u, _ in labelled(50)], "url string, bad boolean")
    assert url_rules.mine_rules(rows).count() == 0
