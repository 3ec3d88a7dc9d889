import re

import duckdb

from panelfactors.llm.url_rules import RULES, SQL, judge, op10_url_filters
from tests.conftest import SF_SMALL


def brute(url, rules=RULES, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest).group()
        path = re.match("[^?#]*", rest[len(host):]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h.count("."), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p) and host]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


URLS = [None, "", "nothing", "://", "http://", "http://org", "http://org/", "http://Example.ORG/es/1?x=1", "x://a.example.org/es/",
        "http://a.b.c.example.org/en/1", "http://example.org/en/2#f", "http://badexample.org/es/", "https://x.com/fr/1",
        "https://x.com/fr", "https://com/de/", "http://x.net/de/", "a://b://c.org/x", "http://x.org?q=/es/", "http://é.com/fr/",
        "http://x.com/fr/" + "y" * 50_000, "http://" + "a." * 3000 + "com/de/z", "http://.org/", "http://org./", "HTTP://ÀB.COM/DE/"]


def rows_of(df):
    return sorted(((r.page_id is None, r.page_id or 0, r.host, r.path, r.rule, r.verdict) for r in df.collect()), key=repr)


def test_against_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    assert rows_of(judge(pages)) == sorted(((False, i, *brute(u)) for i, u in enumerate(URLS)), key=repr)


def test_nested_rules_hot_keys_and_many_partitions(spark):
    rules = [("org", "/", "allow"), ("b.org", "/", "block"), ("b.org", "/x/", "allow"), ("b.org", "/x/y", "block"),
             ("a.b.org", "/x/", "block"), ("c.org", "/", "block"), ("net", "/q", "block"), ("a.net", "/", "allow")]
    urls = [f"http://{h}/{p}" for h in ("org", "b.org", "a.b.org", "z.a.b.org", "c.org", "net", "a.net", "com")
            for p in ("", "x/", "x/y", "x/yy/1", "q", "z")] + ["http://b.org/x/y"] * 300
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "31")
        got = rows_of(judge(pages, rules, "none"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == sorted(((False, i, *brute(u, rules, "none")) for i, u in enumerate(urls)), key=repr)


def test_repeated_rows_null_ids_and_empty(spark):
    pages = spark.createDataFrame([(1, "http://x.com/de/1"), (1, "http://x.com/de/1"), (None, "http://x.com/de/1"), (None, None)],
                                  "page_id long, url string")
    out = judge(pages).collect()
    assert len(out) == 4 and [r.verdict for r in out].count("block") == 3
    assert judge(pages.limit(0)).count() == 0
    assert {r.verdict for r in judge(pages, []).collect()} == {"allow"}


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF_SMALL}/pages.parquet')")
    cur = con.execute(SQL)
    names = [c[0] for c in cur.description]
    want = sorted((tuple(r) for r in cur.fetchall()), key=repr)
    got = sorted((tuple(r) for r in op10_url_filters(spark, SF_SMALL).select(*names).collect()), key=repr)
    assert got == want and any(r[names.index("verdict")] == "block" for r in got)
