"""URL filter against a plain search of the list, with a large list, and odd URLs."""

import random

from pyspark.sql import functions as F

from touchline.llm.url_filter import RULES, bloom_blocks, filter_urls, possible_hits, rule_table


def plain(url, rules, default="allow"):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    rest = rest[end:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fitting = []
    for rule, verdict in rules:
        rule_host, slash, rule_path = rule.partition("/")
        if host and (host == rule_host or host.endswith("." + rule_host)) and path.startswith(slash + rule_path):
            fitting.append((len(rule), rule, verdict))
    best = max(fitting, default=(0, None, default))
    return host, path, best[1], best[2]


URLS = [
    "https://www.EXAMPLE.com/en/1?x=/en/#top", "http://example.com/en", "http://example.com/en/", "http://m.www.example.com/en/x",
    "http://notexample.com/en/1", "ftp://a.net/es/?q", "a.net/es/", "http://net/fr/", "http://com", "http://com/", "http://x.com?a/",
    "http://x.com#/en/", "", None, "://", "http://É.com/en/", "http://.com/", "http://a..net/fr/x", "x://y://z.net/es/", "http://u:p@h.net:80/es/",
    "http://example.com/EN/1", "http://a.com/\nb?c",
]


def check(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "<p>", "x") for i, u in enumerate(urls)], "page_id long, url string, html string, host string")
    found = {r.page_id: tuple(r)[1:] for r in filter_urls(pages, rule_table(spark, rules)).collect()}
    assert len(found) == len(urls)
    for i, url in enumerate(urls):
        assert found[i] == plain(url, rules), url


def test_odd_urls(spark):
    check(spark, URLS, RULES)


def test_a_large_list(spark):
    rng = random.Random(1)
    label = lambda: rng.choice(["a", "b", "news", "shop", "x1"])
    make = lambda: ".".join(label() for _ in range(rng.randint(1, 3)))
    rules = {f"{make()}.org{rng.choice(['/', '/en/', '/en/shop', '/q'])}": rng.choice(["allow", "block"]) for _ in range(300)}
    urls = [f"http://{make()}.{rng.choice(['org', 'net'])}{rng.choice(['', '/', '/en/', '/en/shopping', '/quiz'])}" for _ in range(400)]
    check(spark, urls, list(rules.items()))


def test_the_bloom_filter_loses_nothing_and_drops_most(spark):
    keys = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"))
    blocks = 125
    bloom = bloom_blocks(keys, "key", blocks)
    assert bloom.count() <= blocks
    assert possible_hits(keys, "key", bloom, blocks).count() == 2000
    others = spark.range(20_000).select(F.concat(F.lit("other"), "id").alias("key"))
    assert possible_hits(others, "key", bloom, blocks).count() < 200


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [tuple(r) for r in filter_urls(pages, rule_table(spark).limit(0)).collect()] == [(1, "a.com", "/", None, "allow")]
    assert filter_urls(pages.limit(0), rule_table(spark)).collect() == []


def test_repeated_pages_each_get_a_row(spark):
    pages = spark.createDataFrame([(1, "http://b.net/es/")] * 3 + [(None, "http://b.net/es/")], "page_id long, url string")
    assert [r.verdict for r in filter_urls(pages, rule_table(spark)).collect()] == ["block"] * 4
