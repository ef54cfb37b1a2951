from pyspark.sql import functions as F

from municare.llm import hosts

PAGES = "page_id long, url string, html string, host int, n int, bad int"


def judged(spark, urls, outcomes=()):
    pages = spark.createDataFrame([(i, u, "", 0, 0, 0) for i, u in urls], PAGES)
    known = spark.createDataFrame(list(outcomes), "page_id long, bad int")
    return {r["page_id"]: r for r in hosts.judge_urls(pages, known).collect()}


def test_hosts_paths_and_rules(spark):
    urls = [
        (1, "http://Example.ORG/es/x?q#f"), (2, "https://a.example.org/en/12"), (3, "http://x.org"), (4, "http://x.org/"),
        (5, "http://myexample.org/es/"), (6, "http://a.com/fr/1"), (7, "http://b.a.com/de/1"), (8, "http://com/de/"),
        (9, "no scheme/a"), (10, None), (11, "a://b://c/d"), (12, "http://É.net#x"), (13, "http://h.net?x=/y"),
        (14, "http://example.org/en/2"), (15, "http://example.org/ES/"),
    ]
    got = judged(spark, urls)
    cut = {i: (r["host"], r["path"], r["rule"], r["verdict"]) for i, r in got.items()}
    assert cut == {
        1: ("example.org", "/es/x", "example.org/es/", "block"),
        2: ("a.example.org", "/en/12", "example.org/en/1", "block"),
        3: ("x.org", "", None, "allow"),
        4: ("x.org", "/", "org/", "allow"),
        5: ("myexample.org", "/es/", "org/", "allow"),
        6: ("a.com", "/fr/1", "com/fr/", "allow"),
        7: ("b.a.com", "/de/1", "com/de/", "block"),
        8: ("com", "/de/", "com/de/", "block"),
        9: ("", "", None, "allow"),
        10: ("", "", None, "allow"),
        11: ("b:", "//c/d", None, "allow"),
        12: ("É.net", "", None, "allow"),
        13: ("h.net", "", None, "allow"),
        14: ("example.org", "/en/2", "org/", "allow"),
        15: ("example.org", "/ES/", "org/", "allow"),
    }


def test_reputation_shrinks_towards_the_levels_above(spark):
    urls, outcomes = [], []

    def add(host, count, bad):
        for k in range(count):
            i = len(urls)
            urls.append((i, f"http://{host}/p{k}"))
            outcomes.append((i, int(k < bad)))

    add("bad.one.net", 60, 55)
    add("good.one.net", 60, 3)
    add("www.two.net", 80, 4)
    add("a.three.edu", 50, 2)
    urls += [(1000, "http://new.one.net/"), (1001, "http://new.two.net/"), (1001, "http://new.two.net/"), (None, "http://new.two.net/")]
    got = judged(spark, urls, [*outcomes, (None, 1), (5, None)])
    by_host = {r["host"]: r for r in got.values()}
    assert by_host["bad.one.net"]["verdict"] == "block"
    assert by_host["good.one.net"]["verdict"] == by_host["www.two.net"]["verdict"] == "allow"
    rate = {h: r["bad_rate"] for h, r in by_host.items()}
    assert rate["good.one.net"] < rate["new.one.net"] < rate["bad.one.net"]
    assert rate["new.two.net"] < rate["new.one.net"]
    assert all(r["bad_low"] <= r["bad_rate"] for r in by_host.values())


def test_registered_domains(spark):
    want = {
        "www.bbc.co.uk": ("bbc.co.uk", "co.uk"), "news.bbc.co.uk:80": ("bbc.co.uk", "co.uk"), "bbc.co.uk.": ("bbc.co.uk", "co.uk"),
        "co.uk": ("co.uk", "co.uk"), "saude.gov.br": ("saude.gov.br", "gov.br"), "u:p@a.b.abc.net.au": ("abc.net.au", "net.au"),
        "a.b.example.com": ("example.com", "com"), "x.uk": ("x.uk", "uk"), "localhost": ("localhost", "localhost"), "": ("", ""),
        "10.0.1.2": ("10.0.1.2", "10.0.1.2"), "192.168.1.2:8080": ("192.168.1.2", "192.168.1.2"),
        "[2001:db8::1]:80": ("[2001:db8::1]", "[2001:db8::1]"), "1.2.3.4.com": ("4.com", "com"),
    }
    rows = spark.createDataFrame([(h,) for h in want], "host string").withColumn("domain", hosts.domain_of(F.col("host")))
    got = {r["host"]: (r["domain"], r["suffix"]) for r in rows.withColumn("suffix", hosts.suffix_of(F.col("domain"))).collect()}
    assert got == want


def test_sites_under_one_public_suffix_inform_only_their_own_hosts(spark):
    urls, outcomes = [], []
    for host, bad in (("www.spam.co.uk", 58), ("www.bbc.co.uk", 2), ("1.1.7.7", 58), ("2.2.7.7", 2), ("a.fine.net", 2), ("b.good.net", 1)):
        for k in range(60):
            outcomes.append((len(urls), int(k < bad)))
            urls.append((len(urls), f"http://{host}/{k}"))
    urls += [(1000, "http://news.bbc.co.uk/"), (1001, "http://m.spam.co.uk/"), (1002, "http://3.3.7.7/")]
    rate = {r["host"]: r["bad_rate"] for r in judged(spark, urls, outcomes).values()}
    overall = sum(b for _, b in outcomes) / len(outcomes)
    assert rate["news.bbc.co.uk"] < overall < rate["m.spam.co.uk"]
    assert rate["news.bbc.co.uk"] < rate["m.spam.co.uk"] - 0.1
    assert abs(rate["3.3.7.7"] - overall) < 1e-9


def test_no_rows(spark):
    assert judged(spark, []) == {}


def test_plan_is_native(spark):
    pages = spark.createDataFrame([(1, "http://a.net/", "", 0, 0, 0)], PAGES)
    known = spark.createDataFrame([(1, 1)], "page_id long, bad int")
    plan = hosts.judge_urls(pages, known)._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in ("Python", "Arrow", "Pandas", "NestedLoop", "Cartesian") if word in plan]
