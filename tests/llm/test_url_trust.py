from __future__ import annotations

import pytest

from salescope.llm.queries import URL_RULES
from salescope.llm.url_trust import Rule, judge_urls


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]


def by_rule(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def links(html):
    import re

    found = re.findall(r"""(?i)\s(?:href|src|action|cite)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)""", html or "")
    return {re.sub(r":\d*$", "", re.sub(r"^.*@", "", x.lower())) for x in set(found)}


def brute(pages, rules, damping=0.85, rounds=12, threshold=0.25):
    parsed = [(i, *plain(u), h) for i, u, h in pages]
    edges, count, seeds = {}, {}, ({}, {})
    for _, host, path, html in parsed:
        for to in links(html):
            if host and to != host:
                edges[host, to] = edges.get((host, to), 0) + 1
        if host:
            count[host] = count.get(host, 0) + 1
            rule = by_rule(host, path, rules)
            for k, v in enumerate(("allow", "block")):
                seeds[k][host] = seeds[k].get(host, 0) + bool(rule and rule.verdict == v)
    for host in count:
        up = host.split(".", 1)[1] if host.count(".") >= 2 else ""
        if up:
            edges[host, up] = edges.get((host, up), 0) + 1
            edges[up, host] = edges.get((up, host), 0) + 1
    net = dict.fromkeys(count, 0.0)
    for kind, sign in ((0, -1), (1, 1)):
        steps = edges if kind == 0 else {(b, a): w for (a, b), w in edges.items()}
        out = {}
        for (a, _), w in steps.items():
            out[a] = out.get(a, 0) + w
        s = {h: float(n) for h, n in seeds[kind].items() if n}
        x = dict(s)
        for _ in range(rounds):
            new = {h: (1 - damping) * v for h, v in s.items()}
            for (a, b), w in steps.items():
                if a in x:
                    new[b] = new.get(b, 0) + damping * x[a] * w / out[a]
            x = new
        scale = sum(s.values()) / sum(x.values()) if x else 0
        for h, v in x.items():
            if h in net:
                net[h] += sign * v * scale
    rows = []
    for i, host, path, _ in parsed:
        rule = by_rule(host, path, rules)
        verdict = rule.verdict if rule else ("block" if host and round(net[host] / count[host], 6) >= threshold else "allow")
        rows.append((i, host, path, rule.name if rule else None, verdict))
    return sorted(rows, key=repr)


PAGES = [
    (1, "http://A.Example.NET/en/x?q#f", '<a href="http://good.org/">g</a><img src=//cdn.example.net:80/i>'),
    (2, "https://example.net/de/", "<a HREF='https://u:p@bad.com/de/x'>"),
    (3, "http://notexample.net/en/", None),
    (4, "http://sub.example.com/de/p", '<a href="http://bad.com/">b</a>'),
    (5, "http://sub.example.com/dex", ""),
    (6, "http://sub.example.com?/de/", "<p>"),
    (7, "http://bad.com/page", '<a href="http://sub.example.com/de/">x</a>'),
    (8, "http://x.org/fr/a#b", '<a href="/local">l</a>'),
    (9, "http://x.org/en/a", None),
    (10, "http://net", None),
    (11, "no scheme", None),
    (12, None, '<a href="http://x.org">'),
    (13, "://", ""),
    (14, "http://ÄB.org/fr/", ""),
    (1, "http://A.Example.NET/en/x?q#f", ""),
    (15, "http://lone.example.com/en/" + "p" * 50_000, '<a href="//bad.com">' * 200),
]


def got(df):
    return sorted((tuple(r) for r in df.select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)


def test_against_plain_python(spark):
    df = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, verdict string").repartition(4)
    assert got(judge_urls(df, URL_RULES)) == brute(PAGES, URL_RULES)


def test_trust_and_distrust_spread(spark):
    pages = [(i, f"http://s{i}.spam.example/x", '<a href="http://hub.example/">') for i in range(5)]
    pages += [(10, "http://hub.example/", ""), (11, "http://farm.example/", '<a href="http://s1.spam.example/">' + "".join(f'<a href="http://s{i}.spam.example/x">' for i in range(5)))]
    rules = [Rule("spam.example", "/", "block"), Rule("hub.example", "/", "allow")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    verdicts = {r[0]: r[4] for r in got(judge_urls(df, rules))}
    assert verdicts[11] == "block" and verdicts[10] == "allow"
    assert got(judge_urls(df, rules)) == brute(pages, rules)


@pytest.mark.parametrize("rules", [[], URL_RULES])
def test_empty_tables(spark, rules):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    assert judge_urls(df.limit(0), rules).count() == 0
    assert judge_urls(df, rules).count() == len(PAGES)


def test_no_python_on_the_executors(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    plan = judge_urls(df, URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_own_columns_stay(spark):
    names = ("distrusted", "by_rule", "node", "x", "net", "n", "kind", "good", "bad")
    rows = [(*p, *[f"{n}{i}" for n in names]) for i, p in enumerate(PAGES)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, " + ", ".join(f"{n} string" for n in names))
    out = judge_urls(df, URL_RULES)
    assert got(out) == brute(PAGES, URL_RULES)
    assert sorted(tuple(r) for r in out.select(*names).collect()) == sorted(r[3:] for r in rows)
