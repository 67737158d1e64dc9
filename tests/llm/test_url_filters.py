import random

from pyspark.sql import functions as F

from tokenmill.llm import url_filters as U

RULES = "host string, path string, verdict string"


def judge(url, rules, default="allow"):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        for end in "#?":
            rest = rest.split(end, 1)[0]
        host = rest.split("/", 1)[0]
        path = rest[len(host):]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0]), len(r[1])), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else default


def test_matches_a_plain_scan_of_nested_rules(spark, monkeypatch):
    monkeypatch.setattr(U, "ROWS_PER_RANGE", 40)  # many ranges
    rng = random.Random(4)
    hosts = ["net", "example.net", "a.example.net", "b.a.example.net", "org", "x.org", "notexample.net", "example.netx", "com"]
    rules = [(h, p, rng.choice(["allow", "block"])) for h in hosts[:7] for p in ("/", "/en/", "/en/x") if rng.random() < 0.7]
    urls = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.Net/EN/", "http://example.net", "http://net?x=/en/", "a://b://net/", "http://.net/en/", "http://net./en/"]
    urls += [f"http://{rng.choice(['', 'www.', 'm.'])}{rng.choice(hosts)}{rng.choice(['', '/', '/en/', '/en/x/1', '/e', '/en?q=/', '/en/#f'])}" for _ in range(400)]
    urls += ["http://hot.example.net/en/1"] * 200
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge_urls(pages, spark.createDataFrame(rules, RULES)).collect()}
    assert got == {i: judge(u, rules) for i, u in enumerate(urls)}


def test_edges(spark):
    rules = spark.createDataFrame([("NET", "/", "block")], RULES)
    pages = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, "http://b.org/"), (2, None)], "page_id long, url string")
    pages = pages.withColumns({c: F.lit(9) for c in ("host", "rule", "range", "id", "kind")})
    rows = U.judge_urls(pages, rules).collect()
    assert sorted((r.page_id or 0, r.verdict) for r in rows) == [(0, "allow"), (1, "block"), (1, "block"), (2, "allow")]
    assert U.judge_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in U.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}
