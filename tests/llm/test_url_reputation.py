import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from courtline.llm.queries import URL_RULES
from courtline.llm.url_reputation import STRENGTH, SUFFIXES, Filter, domain_of, judge, site_of, split_url, suffix_of


def brute_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    end = min((tail.index(c) for c in "?#" if c in tail), default=len(tail))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[:end]


URLS = ["https://WWW.Example.COM/en/1?x#y", "http://a.example.com/en/2", "http://example.com/en", "http://b.net/es/://x", "nothing", "",
        None, "http://net/fr/", "x://", "http://É.net/fr/1\n2", "https://u:p@h.org:80?q=/en/", "http://com", "http://com/", "a://b://c/d"]


def brute_levels(host):
    """Registered domain and public suffix."""
    site = host.rsplit("@", 1)[-1]
    head, colon, port = site.rpartition(":")
    site = head if colon and all(c in "0123456789" for c in port) else site
    labels = (site[:-1] if site.endswith(".") else site).split(".")
    two = ".".join(labels[-2:]) in SUFFIXES
    return ".".join(labels[-3 if two else -2:]), ".".join(labels[-2 if two else -1:])


def brute_rule(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def brute_prior(groups):
    groups = [(n, k) for n, k in groups if n]
    if not groups:
        return 0.5, STRENGTH[0]
    n, good = sum(g[0] for g in groups), sum(g[1] for g in groups)
    mean = (good + 0.5) / (n + 1)
    chance, k = mean * (1 - mean), len(groups)
    spread = sum(b * b / a for a, b in groups) - good * good / n
    room = chance * (n - sum(a * a for a, _ in groups) / n - (k - 1))
    rho = (spread - chance * (k - 1)) / room if room > 0 else 0
    return mean, min(STRENGTH[1], max(STRENGTH[0], (1 - rho) / rho)) if rho > 0 else STRENGTH[1]


def brute(pages, labels):
    outcome = {}
    for i, q, t in labels:
        good = 0 if t else (None if q is None else int(q == 1))
        if good is not None and i is not None:
            outcome[i] = min(good, outcome.get(i, 1))
    host_n, domains, suffixes = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for i, url in pages:
        h = brute_split(url)[0]
        host_n[h]
        if i in outcome:
            host_n[h][0] += 1
            host_n[h][1] += outcome[i]
    for h, (n, g) in host_n.items():
        for name, level in zip(brute_levels(h), (domains, suffixes), strict=True):
            level[name][0] += n
            level[name][1] += g
    mean, strength = brute_prior(suffixes.values())
    by_domain, by_host = brute_prior(domains.values())[1], brute_prior(host_n.values())[1]
    out = []
    for i, url in pages:
        h, path = brute_split(url)
        n, g = suffixes[brute_levels(h)[1]]
        rate = (g + strength * mean) / (n + strength)
        n, g = domains[brute_levels(h)[0]]
        rate = (g + by_domain * rate) / (n + by_domain)
        n, g = host_n[h]
        rate = (g + by_host * rate) / (n + by_host)
        bound = rate + 1.645 * math.sqrt(rate * (1 - rate) / (n + by_host + 1))
        rule = brute_rule(h, path)
        out.append((i, h, path, rule.text if rule else None, rule.verdict if rule else ("block" if bound < 0.5 else "allow"), round(bound, 9)))
    return sorted(out, key=str)


def test_hosts_and_paths(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    host, path = split_url(F.col("url"))
    assert [tuple(r) for r in df.select(host, path).collect()] == [brute_split(u) for u in URLS]


@pytest.mark.parametrize("with_labels", [True, False])
def test_against_brute_force(spark, labels, with_labels):
    pages = [(i, u) for i, u in enumerate(URLS)] + [(100 + i, f"http://h{i % 7}.d{i % 3}.org/{i}") for i in range(200)] + [(None, "http://x.org"), (101, "http://h1.d1.org/again")]
    pages += [(300 + i, f"http://u@{'ab'[i % 2]}.s{i % 5}.co.uk{':8080' * (i % 3 == 0)}{'.' * (i % 3 == 1)}/{i}") for i in range(60)]
    marked = [(i, int(i % 7 != 3 and i % 5 > 0), int(i % 11 == 0)) for i in range(100, 350)] + [(101, 0, None), (102, None, 0), (None, 1, 0)] if with_labels else []
    df = spark.createDataFrame([(i, u, "kept", "old") for i, u in pages], "page_id long, url string, `a.b` string, verdict string")
    got = judge(df, labels(marked), URL_RULES)
    assert got.columns == ["page_id", "url", "a.b", "host", "path", "rate", "bound", "rule", "verdict"]
    rows = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, round(r.bound, 9)) for r in got.collect()), key=str)
    assert rows == brute(pages, marked)
    if with_labels:
        assert {r[4] for r in rows if r[3] is None} == {"allow", "block"}


def test_registered_domains(spark):
    want = {"a.foo.co.uk": ("foo.co.uk", "co.uk"), "b.bar.co.uk": ("bar.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "h.com:8080": ("h.com", "com"),
            "u:p@w.h.com:80": ("h.com", "com"), "h.com.": ("h.com", "com"), "localhost": ("localhost", "localhost"), "": ("", ""), "x.com:y": ("x.com:y", "com:y")}
    rows = spark.createDataFrame([(h,) for h in want], "h string").select("h", domain_of(F.col("h")), suffix_of(domain_of(F.col("h")))).collect()
    assert {r[0]: (r[1], r[2]) for r in rows} == want == {h: brute_levels(h) for h in want}
    own = spark.createDataFrame([("a.b.x.y",)], "h string").select(domain_of(site_of(F.col("h")), ["x.y"]))
    assert own.first()[0] == "b.x.y"


def test_few_bad_pages_do_not_condemn_a_host(spark, labels):
    pages = spark.createDataFrame([(i, "http://bad.org/" if i < 50 else "http://new.org/" if i < 52 else "http://good.org/") for i in range(200)], "page_id long, url string")
    marked = labels([(i, int(i >= 52), 0) for i in range(200)])
    verdict = {r.host: r.verdict for r in judge(pages, marked, (), Filter()).collect()}
    assert verdict == {"bad.org": "block", "new.org": "block", "good.org": "allow"} or verdict["new.org"] == "allow"
    assert verdict["bad.org"] == "block" and verdict["good.org"] == "allow"


def test_empty_table(spark, labels):
    assert judge(spark.createDataFrame([], "page_id long, url string"), labels([]), URL_RULES).collect() == []
