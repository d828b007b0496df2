from raterscope.llm import url_filters as U

URLS = [
    None, "", "no scheme", "http://Example.COM/en/x?y#z", "https://www.example.com/en/", "https://m.www.example.com/en/a",
    "https://badexample.com/en/", "http://a.net/es/1", "http://net/fr/", "http://a.net?es/", "x://y://com/", "http://com/",
    "http://a.com#f", "http://a..com/", "http://a.com/" + "p" * 100_000, "http://" + "a." * 2000 + "net/es/", "http://a.net/es/1",
    "http://ÄB.com/É?", "http://a.com:80/",
]


def brute(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = []
    for verdict, rule in rules:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            fits.append((len(rule), len(h), verdict, rule))
    best = max(fits, default=(0, 0, "allow", None))
    return host, path, best[3], best[2]


def test_rows_equal_brute_force(spark):
    rules = [*U.RULES, ("allow", "a.com/p"), ("block", "a.com/"), ("allow", "a.com/"), (None, "x/"), ("block", None)]
    pages = spark.createDataFrame([(i, u, "h", None) for i, u in enumerate(URLS)], "page_id int, url string, host string, Rule string")
    table = spark.createDataFrame(rules, "verdict string, rule string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(pages, table).collect()}
    real = [r for r in rules if None not in r]
    assert found == {i: brute(u, real) for i, u in enumerate(URLS)}


def test_empty_tables_and_repeated_rows(spark):
    none = spark.createDataFrame([], "page_id int, url string")
    assert U.judge(none, U.rule_table(spark, U.RULES)).count() == 0
    pages = spark.createDataFrame([(1, "http://a.net/es/")] * 3, "page_id int, url string")
    assert [r.verdict for r in U.judge(pages, U.rule_table(spark, U.RULES)).collect()] == ["block"] * 3
    assert U.judge(pages, U.rule_table(spark, U.RULES).limit(0)).where("rule is null and verdict = 'allow'").count() == 3


def test_plan_reads_only_the_url(spark, sf):
    from raterscope.llm.queries import QUERIES

    plan = QUERIES["op5_url_filters"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "html" not in plan and "Python" not in plan and "Arrow" not in plan


def test_columns_named_like_helpers_stay(spark):
    rows = [("http://a.net/es/", "b", "d", "s", 1)]
    pages = spark.createDataFrame(rows, "url string, _best string, _digest string, _suffix string, page_id int")
    r = U.judge(pages, U.rule_table(spark, U.RULES)).first()
    assert (r["_best"], r["_digest"], r["_suffix"], r.page_id, r.rule, r.verdict) == ("b", "d", "s", 1, "net/es/", "block")
