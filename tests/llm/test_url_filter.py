import duckdb

import __spark_entry__ as registry
from galepost.llm import queries, url_filter

URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/1", "https://example.org/en/12?x#y",
    "https://a.example.org/en/2", "http://com/fr/", "http://x.com/fr", "http://x.com/de/?a",
    "http://xcom/de/", "ftp://a.net/casino-win", "http://a.net/casinos", "http://a.net/free?bets=1",
    "http://a.net/free/free", "http://éSPAM.net/x", "http://a.net/ads_track", "http://İ.net://b",
    "x://y?://z/ü", "http://a.net/free\nbets", "http://org", "http://org/",
]


def test_cases(spark):
    pages = spark.createDataFrame(
        [(i, u, "h", "p") for i, u in enumerate(URLS)] + [(None, URLS[-1], "h", "p")],
        "page_id long, url string, host string, rule string",
    )
    rows = {r.page_id: r for r in url_filter.filter_urls(pages).collect()}
    assert len(rows) == len(URLS) + 1
    assert (rows[0].host, rows[0].path, rows[0].rule, rows[0].verdict) == ("", "", None, "allow")
    assert (rows[4].host, rows[4].rule) == ("www.example.org", "example.org/es/")
    assert [rows[i].verdict for i in (4, 5, 6, 7, 9)] == [
        "block", "block", "allow", "allow", "block",
    ]
    assert rows[8].rule is None and rows[10].rule is None and rows[20].rule is None
    assert rows[21].rule == "org/" and rows[None].rule == "org/"
    assert [rows[i].verdict for i in (11, 12, 13, 14, 16, 19)] == [
        "block", "allow", "block", "allow", "block", "block",
    ]
    assert url_filter.filter_urls(pages.limit(0)).count() == 0
    connection = duckdb.connect()
    connection.execute("create table pages (page_id bigint, url varchar)")
    connection.executemany(
        "insert into pages values (?, ?)", [*enumerate(URLS), (None, URLS[-1])]
    )
    cursor = connection.execute(queries.ORACLE_SQL["op6_url_filter"])
    names = [c[0] for c in cursor.description]
    want = {r[0]: dict(zip(names, r, strict=True)) for r in cursor.fetchall()}
    assert {k: r.asDict() for k, r in rows.items()} == want


def test_empty_vocabulary(spark):
    pages = spark.createDataFrame([(1, "http://a.net/casino")], "page_id long, url string")
    rows = url_filter.filter_urls(pages, (), url_filter.Vocabulary((), ())).collect()
    assert rows[0].verdict == "allow"


def test_query(spark):
    rows = registry.queries()["op6_url_filter"](spark, registry.SMOKE_DIR)
    assert rows.count() == spark.read.parquet(f"{registry.SMOKE_DIR}/pages.parquet").count()
