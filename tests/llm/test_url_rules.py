import pytest

from changeflow.llm.url_rules import RULES, Rule, judge

URLS = [
    (1, "https://WWW.Example.com/en/x?q=1"), (2, "http://a.example.com/en/#t"),
    (3, "http://a.example.com/fr/"), (4, "ftp://net/es/"), (5, "http://sub.x.net/es/1"),
    (6, "http://net/es"), (7, "http://com"), (8, "http://notcom/"), (9, None), (10, ""),
    (11, "no scheme/com/"), (12, "http://example.org/"), (13, "a://b://com/"),
    (14, "http://example.com/en/"), (15, "http://xexample.com/en/"), (16, "http://com:80/"),
    (17, "http://example.com?/en/"), (18, "x://line\nbreak.net/fr/é"), (None, "http://a.net/es/"),
    (20, "http://a.com" + "/y" * 50_000), (1, "https://WWW.Example.com/en/x?q=1"),
    (21, "http://.com/"), (22, "http://example.com-x.net/fr/"), (23, "http://com!/"),
]


def brute(url, rules, default="allow"):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host))
           and path.startswith(r.path)]
    best = max(fit, key=lambda r: (len(r.name), len(r.host)), default=None)
    return host, path, best and best.name, best.verdict if best else default


MORE = (*RULES, Rule("a.com", "/", "block"), Rule("com", "/y/", "allow"), Rule("net", "", "block"),
        Rule("break.net", "/fr", "allow"))


@pytest.mark.parametrize("rules", [RULES, (), MORE])
def test_judge(spark, rules):
    table = spark.createDataFrame(URLS, "page_id bigint, url string")
    got = judge(spark, table, rules)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(
        str((i, url, *brute(url, rules))) for i, url in URLS)


def test_rule_table_with_nulls_and_repeats(spark):
    rules = spark.createDataFrame(
        [("com", "/", "block"), ("com", "/", "allow"), (None, "/", "block"), ("net", None, "block")],
        "host string, path string, verdict string")
    table = spark.createDataFrame([("http://a.com/",), ("http://a.net/",)], "url string")
    assert {tuple(r) for r in judge(spark, table, rules).collect()} == {
        ("http://a.com/", "a.com", "/", "com/", "allow"),
        ("http://a.net/", "a.net", "/", None, "allow")}


def test_clashing_columns_and_empty_table(spark):
    table = spark.createDataFrame([(1, "http://a.com/", "h", "k", 7)],
                                  "page_id int, url string, Host string, key string, part int")
    got = judge(spark, table)
    assert got.columns == ["page_id", "url", "key", "part", "host", "path", "rule", "verdict"]
    assert [tuple(r) for r in got.collect()] == [
        (1, "http://a.com/", "k", 7, "a.com", "/", "com/", "allow")]
    assert judge(spark, table.limit(0)).collect() == []


def test_one_host_and_one_url_fill_many_ranges(spark):
    table = spark.range(4000).selectExpr(
        "id AS page_id", "if(id % 3 = 0, 'http://www.example.com/en/', "
        "concat('http://h', id % 7, '.net/', if(id % 2 = 0, 'es/', 'de/'), id)) AS url")
    found = judge(spark, table).groupBy("rule", "verdict").count().collect()
    assert {(r["rule"], r["verdict"]): r["count"] for r in found} == {
        ("www.example.com/en/", "allow"): 1334, ("net/es/", "block"): 1333, (None, "allow"): 1333}


def test_columns_named_like_inner_ones_stay(spark):
    urls = spark.createDataFrame([("http://a.com/x", 1, 2, 3, 4, 5)],
                                 "url string, _rule int, rule_row int, key int, part int, other int")
    row = judge(spark, urls).first()
    assert (row["_rule"], row["rule_row"], row["key"], row["part"], row["verdict"]) == (
        1, 2, 3, 4, "allow")
