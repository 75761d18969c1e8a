import random
import re

import duckdb

from creditmart.llm import queries, url_rules

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host):])[0]


def expected(url, rules):
    host, path = split(url)
    fits = [(len(h + p), len(h), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, "allow"
    best = max(fits, key=lambda x: x[:2])
    return host, path, best[3], best[2]


def test_query_equals_sql_and_brute_force(spark, tables):
    rows = queries.LLM_QUERIES["op4_url_filter"](spark, "/root/testdata/sf0.1").collect()
    urls = {r.page_id: r.url for r in tables("pages", "sf0.1").collect()}
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert len(rows) == len(urls) and got == {i: expected(u, RULES) for i, u in urls.items()}
    assert len({r.rule for r in rows}) >= 5
    duck = duckdb.connect()
    duck.execute("create view pages as select * from '/root/testdata/sf0.1/pages.parquet'")
    assert {r[0]: r[1:] for r in duck.execute(queries.LLM_ORACLES["op4_url_filter"]).fetchall()} == got


def test_random_nested_rules(spark):
    random.seed(11)
    names, parts = ["a", "b", "c", "ab", "B"], ["/", "/x", "/x/", "/x/y", "/é", "", "//", "/x/y/z", "/\U0010ffff"]
    host = lambda: ".".join(random.choices(names, k=random.randint(1, 4)))
    rules = {(host().lower(), random.choice(parts)): random.choice(["allow", "block"]) for _ in range(60)}
    rules = [(v, h, p) for (h, p), v in rules.items()]
    urls = [None, "", "no scheme", "x://", "x:///p", "a://B.c?x://y", "://a#b", "://.a./x", "http://u@a:80/x"] + [
        f"s://{host()}{random.choice(parts)}{random.choice(['', '/more', 'q', '?z=1', '#f'])}" for _ in range(900)
    ]
    urls += [urls[-1]] * 500
    pages = spark.createDataFrame([(i, u, "top", 1) for i, u in enumerate(urls)], "page_id int, url string, host string, key int")
    frame = url_rules.rules_frame(spark, rules + [("allow", *rules[0][1:]), ("no", "a", "/"), (rules[1])])
    rules[0] = ("block" if "block" in (rules[0][0], "allow") else "allow", *rules[0][1:])
    found = url_rules.filter_urls(pages, frame).select("row.page_id", "host", "path", "rule", "verdict").collect()
    assert {r[0]: tuple(r[1:]) for r in found} == {i: expected(u, rules) for i, u in enumerate(urls)}
    assert url_rules.filter_urls(pages.limit(0), frame).count() == 0
    assert {r.verdict for r in url_rules.filter_urls(pages, frame.limit(0), default="block").collect()} == {"block"}


def test_very_long_urls(spark):
    """Hosts of very many labels cost no more keys than a rule has labels."""
    urls = [f"s://{'a.' * 20_000}example.com/en/{'x/' * 5000}", f"s://{'.' * 20_000}net/es/x", f"s://{'b' * 100_000}", "s://" + "a." * 20_000]
    urls += [f"s://h{i}.www.example.com/en/{i}" for i in range(2000)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    found = url_rules.filter_urls(pages, url_rules.rules_frame(spark, RULES)).select("row.page_id", "host", "path", "rule", "verdict").collect()
    assert {r[0]: tuple(r[1:]) for r in found} == {i: expected(u, RULES) for i, u in enumerate(urls)}
