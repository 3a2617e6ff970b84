import pytest
from pyspark.sql import functions as F

from skytally.llm import url_reputation
from skytally.llm.queries import URL_RULES, op1_url_filters
from skytally.llm.url_reputation import Rule, host_and_path, judge, registered_domain, reputations
from tests.conftest import SF_DIR


def test_host_and_path(spark):
    cases = {
        "http://A.Example.com/En/x?y=/z#t": ("a.example.com", "/En/x"),
        "https://host": ("host", ""), "https://host?x": ("host", ""), "ftp://ÄB.net#/es/": ("Äb.net", ""),
        "no scheme": ("", ""), "": ("", ""), None: ("", ""), "x://": ("", ""), "a://b://c/d": ("b:", "//c/d"),
        "http://h/a\nb?c": ("h", "/a\nb"), "http://h:80/": ("h:80", "/"),
    }
    rows = spark.createDataFrame([(u,) for u in cases], "url string")
    host, path = host_and_path(F.coalesce("url", F.lit("")))
    found = {r.url: (r.host, r.path) for r in rows.select("url", host.alias("host"), path.alias("path")).collect()}
    assert found == cases


def test_registered_domain(spark):
    cases = {
        "a.b.example.com": ("example.com", "com"), "example.com": ("example.com", "com"), "com": ("com", "com"),
        "x.shop.co.uk": ("shop.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "localhost": ("localhost",) * 2,
    }
    rows = spark.createDataFrame([(h,) for h in cases], "host string")
    domain, suffix = registered_domain(F.col("host"))
    found = rows.select("host", domain.alias("d"), suffix.alias("s")).collect()
    assert {r.host: (r.d, r.s) for r in found} == cases


@pytest.fixture
def outcomes(spark):
    rows = [("good.a.com", 0)] * 60 + [("bad.a.com", 1)] * 60 + [("few.a.com", 1)] * 2
    rows += [(f"h{i}.b.net", 1) for i in range(40)] + [("c.org", 0)] * 40 + [(None, 1), ("c.org", None), ("", 1)]
    return spark.createDataFrame(rows, "host string, bad int")


def test_reputations_shrink_towards_parents(outcomes):
    found = {(r.level, r.name): r for r in reputations(outcomes).collect()}
    assert found["all", ""].n == 202
    domain = found["domain", "a.com"].mean
    assert found["host", "good.a.com"].mean < 0.1 and found["host", "bad.a.com"].mean > 0.9
    assert domain < found["host", "few.a.com"].mean < found["host", "bad.a.com"].mean
    assert found["domain", "b.net"].mean > 0.8 and found["host", "h1.b.net"].mean > 0.8
    assert found["host", "few.a.com"].sd > found["host", "bad.a.com"].sd


@pytest.mark.parametrize("bound", [0, 1000])
def test_judge(spark, outcomes, monkeypatch, bound):
    monkeypatch.setattr(url_reputation, "_BROADCAST_HOSTS", bound)
    cases = {
        "http://bad.a.com/": (None, "block", "host"), "http://good.a.com/": (None, "allow", "host"),
        "http://new.a.com/": (None, "allow", "domain"), "http://new.b.net/": (None, "block", "domain"),
        "http://new.net": (None, "block", "suffix"), "http://new.xyz": (None, "allow", "all"),
        None: (None, "allow", None), "nothing": (None, "allow", None),
        "http://x.bad.a.com/ok/1": ("bad.a.com/ok/", "allow", "domain"),
        "http://bad.a.com/ok/no/1": ("bad.a.com/ok/no/", "block", "host"),
        "http://notbad.a.com/ok/": (None, "allow", "domain"),
    }
    rules = [Rule(True, "bad.a.com/ok/"), Rule(False, "bad.a.com/ok/no/"), Rule(True, "com/nowhere/")]
    pages = spark.createDataFrame(
        [(u, "x", 1) for u in cases] * 2, "url string, host string, verdict int"
    )
    found = judge(pages, rules, outcomes, block_above=0.5).collect()
    assert len(found) == 2 * len(cases)
    assert {r.page.url: (r.rule, r.verdict, r.level) for r in found} == cases
    assert judge(pages.limit(0), rules, outcomes).count() == 0
    unknown = judge(pages, rules, outcomes.limit(0)).where("rule IS NULL").collect()
    assert {(r.verdict, r.level) for r in unknown} == {("allow", None)}


def test_rules_on_the_whole_table(spark):
    def expected(host, path):
        fits = [
            r for r in URL_RULES
            if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
        ]
        return max(fits, key=lambda r: len(r.text), default=None)

    rows = op1_url_filters(spark, SF_DIR).collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/pages.parquet").count()
    for r in rows:
        rule = expected(r.host, r.path)
        assert r.rule == (rule and rule.text)
        assert rule is None or r.verdict == ("allow" if rule.allow else "block")
    assert len({r.rule for r in rows}) > 3


def test_a_planted_bad_host_is_blocked(spark):
    hosts = [(f"h{i}.site{i}.org", 0) for i in range(60) for _ in range(30)] + [("bad.evil.org", 1)] * 30
    outcomes = spark.createDataFrame(hosts, "host string, bad int")
    pages = spark.createDataFrame([(i, f"https://{h}/x") for i, h in enumerate(sorted({h for h, _ in hosts}))], "page_id long, url string")
    assert {r.host for r in judge(pages, (), outcomes).where("verdict = 'block'").collect()} == {"bad.evil.org"}
