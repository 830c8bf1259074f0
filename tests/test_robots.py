from pyspark.sql import functions as F

from webloom.operators.robots import crawl_delays, parse_robots, robots_check

BODY = "\n".join([
    "User-agent: *", "Disallow: /private", "Allow: /private/open", "",
    "User-agent: webloom", "User-agent: other", "Disallow: /x", "Allow: /x/y$",
    "Crawl-delay: 3", "Disallow:",
])


def _rules(spark, body, status=200):
    df = spark.createDataFrame([("ex.com", body, status)], "host string, body string, status_code int")
    return parse_robots(df.withColumn("fetched_at", F.current_timestamp()))


def check(spark, rules, urls, agent):
    u = spark.createDataFrame([(x,) for x in urls], "url string")
    return {r.url: r.allowed for r in robots_check(u, rules, agent).collect()}


def test_star_group(spark):
    r = _rules(spark, BODY)
    got = check(spark, r, ["http://ex.com/private/secret", "http://ex.com/private/open/1", "http://ex.com/"], "bot")
    assert got == {"http://ex.com/private/secret": False, "http://ex.com/private/open/1": True,
                   "http://ex.com/": True}


def test_agent_group_and_anchor(spark):
    r = _rules(spark, BODY)
    got = check(spark, r, ["http://ex.com/x/z", "http://ex.com/x/y", "http://ex.com/x/yz",
                           "http://ex.com/private"], "webloom/1.0")
    assert got == {"http://ex.com/x/z": False, "http://ex.com/x/y": True,
                   "http://ex.com/x/yz": False, "http://ex.com/private": True}
    d = {x.host: x.delay_sec for x in crawl_delays(r, "webloom").collect()}
    assert d == {"ex.com": 3.0}


def test_missing_robots_allows(spark):
    r = _rules(spark, "User-agent: *\nDisallow: /", status=404)
    assert check(spark, r, ["http://ex.com/a"], "bot") == {"http://ex.com/a": True}


def test_reason_text(spark):
    r = _rules(spark, BODY)
    u = spark.createDataFrame([("http://ex.com/private/a",)], "url string")
    row = robots_check(u, r, "bot").first()
    assert row.robots_reason == 'Blocked by robots.txt rule for user-agent "bot"'


def test_verdict_independent_of_rule_order(spark):
    import random
    rules = ["Disallow: /a", "Allow: /a/b", "Disallow: /a/b/c$", "Allow: /*.html", "Disallow: /x*y",
             "Allow: /a/b/c"]
    urls = ["http://ex.com/a/b/c", "http://ex.com/a/b/c/d", "http://ex.com/a/q.html", "http://ex.com/x1y",
            "http://ex.com/a/b", "http://ex.com/z"]
    base = None
    rng = random.Random(3)
    for _ in range(4):
        rng.shuffle(rules)
        got = check(spark, _rules(spark, "User-agent: *\n" + "\n".join(rules)), urls, "bot")
        base = base or got
        assert got == base
    # "/a/b/c$" (7 characters) outranks "Allow: /a/b/c" (6).
    assert base["http://ex.com/a/b/c"] is False and base["http://ex.com/a/b/c/d"] is True
    assert base["http://ex.com/x1y"] is False
