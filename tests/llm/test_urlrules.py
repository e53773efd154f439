import re

import duckdb
import pytest
from frames import SMALL

from ledgerkit.llm import oracles, queries, urlrules

RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
    ("com", "/de/", "block"), ("a.b.com", "/fr/x", "block"), ("b.com", "/fr/xy", "allow"), ("b.com", "/", "block"),
]
URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.ORG/es/1?x#y", "http://example.org", "http://example.org/",
    "http://example.org/es", "http://example.org/es/", "http://x.example.org/en/12", "http://example.orgs/es/1",
    "http://myexample.org/es/1", "https://b.com/fr/xyz", "https://a.b.com/fr/xyz", "https://c.a.b.com/fr/x",
    "https://b.com?/fr/", "https://b.com#/fr/", "https://com/fr/", "https://a.com/fr/?u=http://b.org/", "x://.com/de/",
    "x://com./de/", "x://../de/", "x://org/\U0010ffff", "x://org/|", "x://É.Com/de/É", "http://a.b.com/" + "p/" * 3000,
    "http://" + "s." * 100 + "org/x", "x://com|/fr/", "x://org:80/", "x://com/fr/a#b?c",
]


def brute(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [
        (len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, None, default))
    return host, path, best[1], best[2]


def test_op6_against_brute_force_and_sql(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url").collect()
    found = queries.op6_url_rules(spark, SMALL)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    rows = sorted(map(tuple, found.collect()), key=str)
    assert rows == sorted(((r.page_id, *brute(r.url, queries.URL_RULES)) for r in pages), key=str)
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SMALL}/pages.parquet'")
    assert sorted(con.execute(oracles.ORACLES["op6_url_rules"]).fetchall(), key=str) == rows


@pytest.mark.parametrize("salts", [1, 3])
def test_odd_urls(spark, salts):
    urls = URLS * 2
    frame = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, salt int")
    out = urlrules.judge_urls(frame, urlrules.rules_frame(spark, [*RULES, RULES[0]]), salts=salts)
    assert out.columns == ["page_id", "url", "salt", "host", "path", "rule", "verdict"]
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    assert found == {i: brute(u, RULES) for i, u in enumerate(urls)}


def test_no_rules_no_rows_and_contradictions(spark):
    frame = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    none = urlrules.rules_frame(spark, [])
    assert urlrules.judge_urls(frame, none, default="block").first().verdict == "block"
    assert urlrules.judge_urls(frame.limit(0), urlrules.rules_frame(spark, RULES)).count() == 0
    with pytest.raises(Exception, match="two verdicts"):
        urlrules.judge_urls(frame, urlrules.rules_frame(spark, [("org", "/", "allow"), ("org", "/", "block")])).collect()


def test_no_python_in_the_plan(spark):
    plan = queries.op6_url_rules(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "html" not in plan
