"""URL rules against brute force, the trees on names they have not seen."""

from __future__ import annotations

import re

import pytest

from hourlake.llm import url_filter as U
from tests.llm.texts import SF

URLS = [
    None, "", "no scheme", "http://", "https://NET/x", "http://a.net/", "http://a.net", "http://anet/en/",
    "HTTP://WWW.Example.NET/en/1?q=/de/#f", "http://example.net/EN/1", "http://x.example.com/de/", "http://example.com/de",
    "ftp://a.org/fr/b", "http://org/fr/", "http://a.example.org?x=1/fr/", "http://u@h.net:80/p", "x://a.net/y://b.org/fr/",
    "http://É.net/é\n/z", "http://example.net/en/" + "a" * 50_000,
]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in U.RULES:
        rule_host, rule_path = rule.split("/", 1)
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + rule_path):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return host, path, best and best[0], best and best[1]


def frame(spark, urls):
    rows = [(i, u, "h", 1.0) for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, name string, score double")


def test_rules_equal_brute_force(spark):
    got = U.filter_urls(frame(spark, [*URLS, URLS[4], URLS[4]])).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        host, path, rule, verdict = brute(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.name == "h"
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in U.filter_urls(pages).collect():
        host, path, rule, verdict = brute(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule) and (verdict is None or r.verdict == verdict)


def test_trees_block_names_they_have_not_seen(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    named = U.decide_by_rule(U.parsed(pages, "url"), U.RULES).where("rule is null")
    # two of the listed words are held out, with all their hosts
    late = named.where("host rlike 'casino|pills'")
    early = named.where("not host rlike 'casino|pills'").select(
        "url", U.listed(named["host"], ["adult", "ads", "bets", "spam"]).alias("label")
    )
    model = U.fit(early, "url", "label")
    judged = U.judge(late.select("page_id", "url"), model, rules=[]).collect()
    assert judged and sum(r.verdict == "block" for r in judged) >= 0.9 * len(judged)
    clean = U.judge(early.where("label = 0").select("url"), model, rules=[]).collect()
    assert sum(r.verdict == "allow" for r in clean) >= 0.98 * len(clean)


@pytest.mark.parametrize("urls", [[], ["http://a.com/x"], [None]])
def test_without_labels_of_both_kinds(spark, urls):
    got = U.filter_urls(frame(spark, urls)).collect()
    assert [r.verdict for r in got] == ["allow"] * len(urls)


def test_entropy(spark):
    got = spark.createDataFrame([("aabb",), ("",), ("a",), ("abcd",)], "t string").select(U.entropy(U.F.col("t")))
    assert [round(r[0], 6) for r in got.collect()] == [1.0, 0.0, 0.0, 2.0]


def test_repeated_urls_do_not_fill_the_sample(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("url")
    named = U.decide_by_rule(U.parsed(pages, "url"), U.RULES).where("rule is null")
    labelled = named.select("url", U.listed(named["host"], U.LISTED_TERMS).alias("label"))
    hot = labelled.orderBy(U.F.xxhash64("url")).limit(1).crossJoin(spark.range(500)).drop("id")
    model = U.fit(labelled.unionByName(hot), "url", "label", rows=400)
    assert model.trees is not None
    alone = U.fit(labelled, "url", "label", rows=400)
    assert model.prior == alone.prior
