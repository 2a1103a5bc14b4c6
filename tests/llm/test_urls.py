"""URL filters against SQL and against trying every rule on every url."""

from deedmill.llm import urls
from deedmill.llm.oracle import ORACLE
from deedmill.llm.queries import QUERIES, URL_RULES
from tests.compare import difference, tables
from tests.llm.data import SF, rows_of, with_clashes

ODD = [
    None, "", "no scheme", "://", "http://", "http://com", "http://com/", "http://COM/x", "http://a.com?x=/y", "x://a.com#/en/",
    "http://example.com/en/", "http://example.com/en", "http://www.example.com/en/a/b", "http://aexample.com/en/", "http://x.net/es/?q",
    "http://x.net/esp/", "http://net/fr/", "a://b://net/fr/", "http://.com/", "http://ÄÖ.COM/", "http://a..net//es/",
    "http://" + "a." * 3000 + "com/" + "b/" * 3000, "http://host/en\n/x", "first\nline http://x.com/",
]
COLUMNS = ("page_id", "host", "path", "rule", "verdict")


def plain(url, rules):
    url, host, path = url or "", "", ""
    if "://" in url:
        rest = url[url.index("://") + 3 :]
        end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        path = rest[: min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    best = None
    for rule, verdict in rules:
        at = rule.index("/")
        fits = (host == rule[:at] or host.endswith("." + rule[:at])) and path.startswith(rule[at:])
        if fits and (best is None or (len(rule), verdict == "block", rule) > best[0]):
            best = (len(rule), verdict == "block", rule), rule, verdict
    return (host, path, best[1], best[2]) if best else (host, path, None, "allow")


def pages(spark, values):
    return spark.createDataFrame(values, "page_id long, url string")


def test_query_equals_sql(spark):
    assert difference(QUERIES["op2_url_filters"](spark, SF), tables(SF), ORACLE["op2_url_filters"]) is None


def test_odd_urls_by_both_joins(spark):
    values = [(k, u) for k, u in enumerate(ODD)] + [(1, ODD[10])] * 3 + [(None, ODD[10]), (None, None)]
    rules = [*URL_RULES, ("com/x", "block"), ("a.com/y", "block"), ("net//", "allow"), ("x.net/es/?", "allow")]
    want = {}
    for k, u in values:
        row = (k, *plain(u, rules))
        want[row] = want.get(row, 0) + 1
    for limit in (urls.BROADCAST_RULES, 0):
        found = urls.judge_urls(with_clashes(pages(spark, values)), urls.make_rules(spark, rules), broadcast_rules=limit)
        assert rows_of(found, *COLUMNS) == want


def test_empty_tables(spark):
    assert urls.judge_urls(pages(spark, []), urls.make_rules(spark, URL_RULES)).collect() == []
    none = urls.make_rules(spark, URL_RULES).where("false")
    assert rows_of(urls.judge_urls(pages(spark, [(1, "http://a.com/")]), none), *COLUMNS) == {(1, "a.com", "/", None, "allow"): 1}


def test_one_shuffle(spark):
    plan = QUERIES["op2_url_filters"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
