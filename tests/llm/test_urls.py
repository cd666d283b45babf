"""URL rules and host reputation."""

import math
from collections import defaultdict

import pytest
from almanack.llm import url_reputation
from almanack.llm.oracles import ORACLES
from almanack.llm.queries import QUERIES, URL_RULES
from almanack.llm.url_reputation import Rule, fitting_rule, host_reputation, judge_urls, site_levels, url_parts
from compare import difference, oracle
from conftest import DATA
from plans_text import plan
from pyspark.sql import functions as F

PAGES, LABELS = "page_id long, url string, html string", "doc_id long, quality int, toxic int"


def parted(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for c in "/?#" if (i := rest.find(c)) >= 0], default=len(rest))
    host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
    return host, rest[: min([i for c in "?#" if (i := rest.find(c)) >= 0], default=len(rest))]


ODD = [
    "http://Example.ORG/en/1x?y#z", "https://a.b.com", "https://a.b.com?x/y", "https://a.b.com#f/de/", "nothing", "", None,
    "http://", "x://://y/z", "http://ÀÉ.com/de/é", "http://com/fr/", "http://notcom/de/", "HTTP://U:P@h.co.uk:80/a\nb?c",
    "http://1.2.3.4/de/", "http://[::1]/x", "http://org", "http://org/", "http://a.example.org/es/", "http://h.org./q",
]


def test_query_agrees_with_sql(spark):
    for sf in ("sf0.001", "sf0.01"):
        found = QUERIES["op11_url_reputation"](spark, f"{DATA}/{sf}")
        assert difference(found, oracle(f"{DATA}/{sf}"), ORACLES["op11_url_reputation"]) is None


def test_plan_has_no_python(spark):
    text = plan(QUERIES["op11_url_reputation"](spark, f"{DATA}/sf0.001"))
    for word in ("Python", "InArrow", "InPandas", "Cartesian", "NestedLoop", "html"):
        assert word not in text, text


def test_hosts_and_paths(spark):
    urls = spark.createDataFrame([(u,) for u in ODD], "url string")
    host, path = url_parts(F.col("url"))
    assert [(r.h, r.p) for r in urls.select(host.alias("h"), path.alias("p")).collect()] == [parted(u) for u in ODD]


def test_rules(spark):
    rules = [*URL_RULES, Rule("block", "b.com", "/fr/"), Rule("allow", "b.com", "/fr/"), Rule("block", "com", "/fr/b.com")]

    def longest(host, path):
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(((len(r.name), len(r.host), -rules.index(r)) for r in fits), default=None)

    urls = [parted(u) for u in [*ODD, "http://b.com/fr/x", "http://x.b.com/fr/b.com", "http://c.com/fr/b.com"]]
    found = spark.createDataFrame(urls, "host string, path string")
    name, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    for row in found.select("host", "path", name.alias("rule"), verdict.alias("verdict")).collect():
        best = longest(row.host, row.path)
        want = rules[-best[2]] if best else Rule(None, "", "")
        assert (row.rule, row.verdict) == ((want.name, want.verdict) if best else (None, None))


def test_levels(spark):
    hosts = ["u@a.b.co.uk:8", "a.b.uk", "co.uk", "x", "", "1.2.3.4:80", "a.example.com.", "[::1]"]
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    rows = df.select(*(c.alias(k) for k, c in site_levels(F.col("h")).items())).collect()
    assert [tuple(r) for r in rows] == [
        ("a.b.co.uk", "b.co.uk", "co.uk"), ("a.b.uk", "b.uk", "uk"), ("co.uk", "co.uk", "uk"), ("x", "x", "x"),
        ("", "", ""), ("1.2.3.4", "1.2.3.4", ""), ("a.example.com", "example.com", "com"), ("[::1]", "[::1]", ""),
    ]


def plain_posterior(counts):
    """Posterior by site from {(suffix, domain, site): (n, bad)}, written level by level."""
    total, bad = (sum(c[i] for c in counts.values()) for i in (0, 1))
    above = {(): (1 + bad, 9 + total - bad)}
    for depth in (1, 2, 3):
        groups = defaultdict(lambda: [0, 0])
        for key, (n, b) in counts.items():
            groups[key[:depth]][0] += n
            groups[key[:depth]][1] += b
        excess = room = 0.0
        for key, (n, b) in groups.items():
            a0, b0 = above[key[:-1]]
            m = a0 / (a0 + b0)
            excess += (b - n * m) ** 2 - n * m * (1 - m)
            room += n * (n - 1) * m * (1 - m)
        r = excess / room if room else 0.0
        strength = 1 / min(max(r, 1 / 1001), 1 / 2) - 1
        below = {}
        for key, (n, b) in groups.items():
            a0, b0 = above[key[:-1]]
            worth = min(strength, a0 + b0)
            below[key] = (a0 / (a0 + b0) * worth + b, b0 / (a0 + b0) * worth + n - b)
        above = below
    return {key[2]: v for key, v in above.items()}


def test_posteriors_are_those_of_a_plain_form(spark):
    counts = {}
    for i in range(40):
        suffix = ("com", "org", "net")[i % 3]
        domain = f"d{i % 7}.{suffix}"
        n = (0, 1, 3, 200)[i % 4]
        counts[suffix, domain, f"h{i}.{domain}"] = (n, n * (i % 5) // 4)
    sites = spark.createDataFrame([k for k in counts], "suffix string, domain string, site string")
    outcomes = [(k[2], *v) for k, v in counts.items() if v[0]]
    rows = host_reputation(sites, spark.createDataFrame(outcomes, "site string, n long, bad long")).collect()
    want = plain_posterior(counts)
    assert len(rows) == len(want)
    for r in rows:
        assert math.isclose(r.alpha, want[r.site][0]) and math.isclose(r.beta, want[r.site][1])


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_bad_hosts_are_blocked(spark, limit):
    """A host with a third of all pages is bad; a sister of bad hosts without labels is blocked too."""
    urls, labels = [], []
    for i in range(3000):
        host = "big.bad.com" if i % 3 == 0 else f"h{i % 8}.spam.net" if i % 30 == 1 else f"h{i % 40}.good{i % 5}.org"
        urls.append((i, f"http://{host}/{i}", None))
        if i % 2 == 0 or "spam" in host:
            labels.append((i, 0 if "good" not in host else int(i % 50 > 0), 0))
    urls += [(9001, "http://new.spam.net/x", None), (9002, "http://new.good1.org/x", None), (None, None, "x"), (9002, "http://new.good1.org/x", None)]
    labels += [(None, 0, 1), (5, None, None), (0, 0, 1)]
    found = judge_urls(
        spark.createDataFrame(urls, PAGES), spark.createDataFrame(labels, LABELS), [Rule("allow", "bad.com", "/3")],
        max_broadcast_bytes=limit,
    )
    rows = found.collect()
    assert len(rows) == len(urls)
    for r in rows:
        bad = "bad.com" in r.host or "spam" in r.host
        allowed = "bad.com" in r.host and r.path.startswith("/3")
        assert r.verdict == ("block" if bad and not allowed else "allow"), r
    if not limit:
        assert "part" in plan(found)


def test_odd_tables(spark):
    pages, labels = spark.createDataFrame([], PAGES), spark.createDataFrame([], LABELS)
    assert judge_urls(pages, labels, URL_RULES).collect() == []
    some = spark.createDataFrame([(1, "http://a.org/es/", "x", "y", 1)], PAGES + ", host string, n long")
    assert judge_urls(some, labels, URL_RULES).collect() == [(1, "a.org", "/es/", "org/", "allow")]
    # One bad page alone blocks nobody.
    one = spark.createDataFrame([(1, 0, 1, "z")], LABELS + ", verdict string")
    more = spark.createDataFrame([(1, "http://a.xx/", None), (2, "http://b.xx/", None), (3, "http://c.yy", None)], PAGES)
    assert {r.verdict for r in judge_urls(more, one, []).collect()} == {"allow"}
    assert url_reputation.LEVELS == ("suffix", "domain", "site")
