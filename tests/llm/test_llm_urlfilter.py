"""URL filters: parsing, rules, shrinkage and edges."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lanekit.llm import urlfilter

SCHEMA = "page_id long, url string"


def rows_of(df):
    return {r.page_id: r for r in df.collect()}


@pytest.mark.parametrize("url, host, path", [
    ("https://A.Example.ORG/Es/1?x=1#y", "a.example.org", "/Es/1"), ("http://x.com", "x.com", ""), ("http://x.com?q=/a", "x.com", ""),
    ("x.com/a", "", ""), (None, "", ""), ("", "", ""), ("a://b://c/d", "b:", "//c/d"), ("http://É.org/é#z", "É.org", "/é"),
    ("http:///only", "", "/only"), ("mailto:x", "", ""), ("http://x.com/a\nb?c", "x.com", "/a\nb"), ("://h/p", "h", "/p")])
def test_host_and_path(spark, url, host, path):
    row = spark.createDataFrame([(url,)], "url string").select(urlfilter.url_host(F.col("url")).alias("h"),
                                                                urlfilter.url_path(F.col("url")).alias("p")).first()
    assert (row.h, row.p) == (host, path)


@pytest.mark.parametrize("host, suffix, domain", [
    ("a.b.example.com", "com", "example.com"), ("example.com", "com", "example.com"), ("com", "com", "com"), ("", "", ""),
    ("www.site.co.uk", "co.uk", "site.co.uk"), ("co.uk", "co.uk", "co.uk"), ("10.0.0.1:80", "10.0.0.1", "10.0.0.1"),
    ("user@a.example.net:8080", "net", "example.net"), ("a.example.net.", "net", "example.net"), ("localhost", "localhost", "localhost")])
def test_suffix_and_domain(spark, host, suffix, domain):
    name = urlfilter.host_name(F.col("host"))
    end = urlfilter.public_suffix(name)
    row = spark.createDataFrame([(host,)], "host string").select(end.alias("s"), urlfilter.registered_domain(name, end).alias("d")).first()
    assert (row.s, row.d) == (suffix, domain)


def test_the_longest_rule_wins(spark):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("a.example.org", "/es/ok/", "allow"),
             ("example.org", "/en/1", "block"), ("com", "/x", "block"), ("b.com", "/", "allow")]
    pages = [(1, "http://example.org/es/1"), (2, "http://z.example.org/es/ok/1"), (3, "http://a.example.org/es/ok/1"),
             (4, "http://notexample.org/es/1"), (5, "http://example.org/en/12"), (6, "http://example.org"),
             (7, "http://b.com/x"), (8, "http://org/a"), (9, "http://xorg/a"), (10, "http://example.org/ES/1")]
    got = rows_of(urlfilter.judged(spark.createDataFrame(pages, SCHEMA), rules))
    want = {1: "example.org/es/", 2: "example.org/es/", 3: "a.example.org/es/ok/", 4: "org/", 5: "example.org/en/1", 6: None,
            7: "b.com/", 8: "org/", 9: None, 10: "org/"}
    assert {k: r.rule for k, r in got.items()} == want
    assert [got[i].verdict for i in (1, 2, 3, 4, 5, 7, 8)] == ["block", "block", "allow", "allow", "block", "allow", "allow"]


def brute_reputation(outcomes):
    """outcomes: {host: (suffix, domain, n, blocked)} -> {host: (rate, weight, n)}."""
    def weight(units):
        seen = sum((b - n * m) ** 2 for n, b, m in units if n)
        plain = sum(n * m * (1 - m) for n, b, m in units if n)
        extra = sum(n * (n - 1) * m * (1 - m) for n, b, m in units if n)
        if not extra:
            return 0.5
        rho = (seen - plain) / extra
        return 1000.0 if rho <= 1 / 1001 else max(0.5, 1 / rho - 1)

    n, blocked = (sum(o[i] for o in outcomes.values()) for i in (2, 3))
    means = {(): (blocked + 0.5) / (n + 1)}
    for depth in (1, 2, 3):
        sums = {}
        for host, (suffix, domain, n, b) in outcomes.items():
            key = (suffix, domain, host)[:depth]
            s = sums.setdefault(key, [0, 0])
            s[0] += n
            s[1] += b
        w = weight([(n, b, means[k[:-1]]) for k, (n, b) in sums.items()])
        means |= {k: (w * means[k[:-1]] + b) / (w + n) for k, (n, b) in sums.items()}
    return {h: (means[s, d, h], w, n) for h, (s, d, n, _) in outcomes.items()}


def test_rates_are_shrunk_level_by_level(spark):
    rng = random.Random(4)
    outcomes = {}
    for i in range(60):
        suffix, domain = rng.choice(["com", "org"]), f"d{rng.randrange(8)}"
        n = rng.choice([0, 1, 3, 20, 200])
        outcomes[f"h{i}.{domain}.{suffix}"] = (suffix, f"{domain}.{suffix}", n, sum(rng.random() < 0.1 + 0.1 * int(domain[1]) for _ in range(n)))
    df = spark.createDataFrame([(h, o[2], o[3]) for h, o in outcomes.items()], "host string, n long, blocked long")
    got = {r.host: r for r in urlfilter.reputation(df).collect()}
    for host, (rate, w, n) in brute_reputation(outcomes).items():
        bound = rate - 2 * math.sqrt(rate * (1 - rate) / (w + n + 1))
        assert got[host].rate == pytest.approx(rate) and got[host].bound == pytest.approx(bound)
        assert got[host].surely_bad == (bound > 0.5)


def test_reputation_decides_pages_without_a_rule(spark):
    rules = [("com", "/spam/", "block"), ("com", "/news/", "allow")]
    pages, n = [], 0
    for host in range(12):
        for i in range(30):
            n += 1
            pages.append((n, f"http://h{host}.d{host}.com/{'spam' if host < 3 else 'news'}/{i}"))
    pages += [(1000 + host, f"http://h{host}.d{host}.com/other") for host in range(12)]
    pages += [(2000, "http://new.d0.com/x"), (2001, "http://unseen.net/x"), (2002, "http://sole.com/x")]
    got = rows_of(urlfilter.judged(spark.createDataFrame(pages, SCHEMA), rules))
    assert [got[1000 + host].verdict for host in range(12)] == ["block"] * 3 + ["allow"] * 9
    assert got[2001].verdict == got[2002].verdict == "allow"     # no evidence: not surely bad
    assert got[2000].rate > got[2002].rate                       # a new host inherits its domain's rate


def test_a_single_bad_page_is_not_enough(spark):
    rules = [("com", "/bad/", "block"), ("com", "/ok/", "allow")]
    pages = [(i, f"http://a{i}.x{i}.com/ok/") for i in range(50)] + [(100, "http://once.y.com/bad/"), (101, "http://once.y.com/q")]
    assert rows_of(urlfilter.judged(spark.createDataFrame(pages, SCHEMA), rules))[101].verdict == "allow"


def test_awkward_rows(spark):
    clash = "host string, path string, rule string, verdict string, n long, blocked long, rate double, page_id_ long"
    rows = [(1, None), (None, "http://a.org/x"), (2, ""), (2, ""), (3, "http://a.com/de/" + "x" * 100_000), (None, None), (4, "no scheme")]
    df = spark.createDataFrame([r + ("h", "p", "r", "v", 1, 1, 0.5, 1) for r in rows], f"{SCHEMA}, {clash}")
    got = urlfilter.judged(df).collect()
    assert len(got) == len(rows)
    assert sorted((r.page_id or 0, r.host, r.verdict) for r in got if r.host == "") == [
        (0, "", "allow"), (1, "", "allow"), (2, "", "allow"), (2, "", "allow"), (4, "", "allow")]
    assert [r.verdict for r in got if r.page_id == 3] == ["block"]
    assert [r.rule for r in got if r.host == "a.org"] == ["org/"]
    assert urlfilter.judged(df.limit(0)).collect() == []


def test_too_many_rules_are_refused(spark):
    df = spark.createDataFrame([(1, "http://a.org/")], SCHEMA)
    with pytest.raises(ValueError):
        urlfilter.judged(df, [("org", f"/{i}", "allow") for i in range(urlfilter.MAX_RULES + 1)])
