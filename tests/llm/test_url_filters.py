import random
import re

import pytest

from corpusmill.llm import url_filters as U

RULES = [U.Rule("net/", "block"), U.Rule("example.net/en/", "allow"), U.Rule("example.com/de/", "block"), U.Rule("org/fr/", "allow")]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


def urls():
    rng = random.Random(2)
    out = [None, "", "no scheme.net/", "http://", "https://NET/", "http://x.net", "x://a.Example.NET/en/1?q=//#f", "http://é.org/fr/\n", "a://b://c.net/", "http://notexample.com/de/", "http://example.com/de/" + "9" * 5000]
    for _ in range(300):
        host = ".".join(rng.choice(["www", "a-b", "example", "x", "Net"]) for _ in range(rng.randint(0, 3))) + rng.choice([".net", ".example.net", ".com", ".example.com", ".org", "org", "example.com"])
        out.append(rng.choice(["http://", "https://"]) + host + rng.choice(["", "/", "/en/", "/de/", "/fr/"]) + rng.choice(["", "12.html", "?a=1&b=2", "#/fr/"]))
    return out


@pytest.mark.parametrize("inline", [256, 0])
def test_hosts_paths_and_rules_against_brute_force(spark, inline):
    host, path = U.host_and_path(U.F.col("url"))
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls())], "id long, url string").withColumns({"host": host, "path": path})
    out = U.matched(df, RULES, inline).collect()
    assert len(out) == len(urls())
    for r in out:
        assert (r.host, r.path, r.rule, r.rule_verdict) == brute(r.url)


def test_judged_pages(spark):
    rows = [(i, u, "h", "clash") for i, u in enumerate(urls())] + [(None, "http://a.net/", None, None), (0, None, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, score string")
    out = U.judged(pages, RULES, n_trees=2).collect()
    assert len(out) == len(rows)
    for r, (i, u, *_) in zip(sorted(out, key=lambda r: (r.page_id is None, r.page_id or 0, r.host)), sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)), strict=True):
        host, path, rule, verdict = brute(u)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert U.judged(pages.limit(0), RULES).collect() == []


def test_trees_on_held_out_urls(spark):
    rng = random.Random(9)

    def row(i):
        bad = rng.random() < 0.4
        host = f"{'cheap-pills-' if bad else ''}{''.join(rng.choice('abcdefgh') for _ in range(6))}.com"
        return i, f"http://{host}/{rng.randint(1, 10 ** (8 if bad else 3))}", int(bad)

    known = [row(i) for i in range(1500)]
    test = [row(i) for i in range(500)]
    labelled = spark.createDataFrame([(u, y) for _, u, y in known], "url string, y int")
    pages = spark.createDataFrame([(i, u) for i, u, _ in test], "page_id long, url string")
    got = {r.page_id: r.verdict for r in U.judged(pages, [], labelled, n_trees=3).collect()}
    assert sum((got[i] == "block") == bool(y) for i, _, y in test) > 475


def test_sample_is_not_crowded_by_one_url(spark):
    import hashlib

    digest = lambda u: hashlib.md5(u.encode()).hexdigest()
    urls = sorted((f"http://h{i}.net/p{i}" for i in range(300)), key=digest)
    rows = [(urls[0], 0.0)] * 1500 + [(u, 1.0) for u in urls[1:]] + [(u, 1.0) for u in urls[1:]]
    labelled = spark.createDataFrame(rows, "url string, y double")
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls[:3])], "page_id long, url string")
    out = U.judged(pages, [], labelled, sample_rows=500).collect()
    assert all(1e-6 < r.score < 1 - 1e-6 for r in out)
    known = labelled.selectExpr("url", "'' as host", "'' as path", "y")
    some = U.sampled(known, 500, len(rows)).collect()
    assert len(some) == 500 and 250 < sum(r.url == urls[0] for r in some) < 440
    assert U.sampled(known, 9999, len(rows)).count() == len(rows)


def test_undecided_urls_get_both_verdicts_and_unseen_suffixes_the_mean(spark):
    """Rules block long numeric paths of one kind of host; undecided URLs look like either kind. They aren't training rows."""
    rng = random.Random(4)
    page = lambda host, bad: f"http://{host}/{'x' if not bad else rng.randint(10**9, 10**10)}"
    rows = [page(f"a{i}.blocked.net", True) for i in range(300)] + [page(f"b{i}.good.org", False) for i in range(300)]
    rows += [page(f"c{i}.else.com", i % 2) for i in range(100)] + [page(f"d{i}.else.info", i % 2) for i in range(100)]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    rules = [U.Rule("blocked.net/", "block"), U.Rule("good.org/", "allow")]
    out = {r.page_id: r for r in U.judged(pages, rules).collect()}
    left = [r for r in out.values() if r.rule is None]
    assert len(left) == 200 and {r.verdict for r in left} == {"block", "allow"}
    assert sum((r.verdict == "block") == bool(r.page_id % 2) for r in left) >= 180
    stats = U.suffix_statistics(spark.createDataFrame([("net", 1.0), ("net", 1.0), ("org", 0.0), ("org", 1.0)], "suffix string, y double"))
    got = {r.suffix: r.suffix_rate for r in stats.joined(spark.createDataFrame([("net",), ("new",)], "suffix string")).collect()}
    assert stats.mean == 0.75 and got["new"] == 0.75 and got["net"] > 0.75
    fig = U.held_out(pages, rules).first()
    assert fig.rows > 60 and fig.accuracy > 0.95


def test_nothing_to_learn_from(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c"), (2, None), (None, "http://x.net/" + "a?" * 20_000)], "page_id long, url string")
    out = {r.page_id: (r.rule, r.verdict) for r in U.judged(pages, [U.Rule("q.q/", "block")]).collect()}
    assert out == {1: (None, "allow"), 2: (None, "allow"), None: (None, "allow")}
