from __future__ import annotations

import random

import numpy as np
import pytest

from touchline.llm import urls
from touchline.llm.urls import Rule, blocked_hosts, build_cascade, judge_urls, listed

RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def plain(url, rules=RULES, blocked=()):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:cut], rest[cut:]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [r for r in rules
            if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.host + r.path), len(r.host)), default=None)
    parts = host.split(".")
    bad = any(".".join(parts[i:]) in blocked for i in range(len(parts)))
    verdict = best.action if best else "block" if bad else "allow"
    return host, path, best.host + best.path if best else None, verdict


def test_rules_against_plain_python(spark, scratch):
    rng = random.Random(3)
    hosts = ["net", "a.net", "example.net", "X.Example.NET", "example.com", "w.example.com",
             "org", "a.org", "notnet", "anexample.com", "", "..net", "ex.net.org", "İ.net"]
    paths = ["", "/", "/en/", "/en", "/de/x", "/fr/y/", "/EN/", "//", "/en/?q=/de/", "?a/", "#/fr/"]
    found = [f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(400)]
    found += [None, "", "no scheme", "://", "a://b://net/", "http://net", "http://net/" + "x" * 9000]
    rows = [(i, x, "clash") for i, x in enumerate(found)] + [(None, "http://net/", "clash"), (5, found[5], "clash")]
    frame = spark.createDataFrame(rows, "page_id long, url string, rule string").repartition(4)
    out = judge_urls(frame, RULES, scratch)
    assert out.columns == ["page_id", "host", "path", "rule", "verdict"]
    expected = sorted(((i, *plain(x)) for i, x, _ in rows), key=str)
    assert sorted(map(tuple, out.collect()), key=str) == expected


def test_a_list_of_hosts_decides_without_a_rule(spark, scratch):
    rows = [(1, "http://bad.example/x"), (2, "http://w.bad.example/"), (3, "http://good.example/"),
            (4, "http://bad.net/"), (5, "http://notbad.example")]
    frame = spark.createDataFrame(rows, "page_id long, url string")
    names = blocked_hosts(spark, ["bad.example", "bad.net", None, "unseen"])
    out = judge_urls(frame, RULES, scratch, names)
    assert {r.page_id: r.verdict for r in out.collect()} == {
        1: "block", 2: "block", 3: "allow", 4: "block", 5: "allow",
    }
    nothing = judge_urls(frame.limit(0), (), scratch, names)
    assert nothing.count() == 0
    assert {r.verdict for r in judge_urls(frame, (), scratch).collect()} == {"allow"}


@pytest.mark.parametrize("bits", [1, 2, 12])
def test_the_cascade_is_exact_over_its_universe(spark, scratch, monkeypatch, bits):
    """Small filters let many keys through, so that many levels are needed."""
    monkeypatch.setattr(urls, "BITS_FIRST", bits)
    universe = spark.range(4000).selectExpr("IF(id = 7, NULL, concat('k', id % 3500)) AS key")
    keys = spark.range(0, 6000, 3).selectExpr("concat('k', id) AS key")
    cascade = build_cascade(keys, universe, scratch)
    hashed = universe.select("key", *urls._hashes(universe["key"])).filter("key IS NOT NULL").collect()
    a, b = (np.array([r[x] for r in hashed], np.int64).view(np.uint64) for x in "ab")
    wanted = np.array([int(r.key[1:]) % 3 == 0 for r in hashed])
    assert (listed(cascade, a, b) == wanted).all()
    assert len(cascade.levels) > (1 if bits < 12 else 0)


def test_too_long_a_list_raises(spark, scratch, monkeypatch):
    monkeypatch.setattr(urls, "MOST_BYTES", 8)
    keys = spark.range(100).selectExpr("concat('k', id) AS key")
    with pytest.raises(ValueError, match="bytes of filters"):
        build_cascade(keys, keys, scratch)
