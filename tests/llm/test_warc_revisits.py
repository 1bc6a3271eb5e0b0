import random

import duckdb
from pyspark.sql import functions as F

from tradewell.llm.queries import ORACLE, QUERIES
from tradewell.llm.warc_revisits import FIXED_HEADERS, canonical_url, resolve_revisits

SF = "/root/testdata/sf0.01"


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    res = con.sql(ORACLE["op9_warc_revisits"])
    cols = sorted(res.columns)
    df = QUERIES["op9_warc_revisits"](spark, SF)
    assert sorted(df.columns) == cols
    key = lambda t: t[cols.index("record_id")]
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key)
    want = sorted((tuple(r[res.columns.index(c)] for c in cols) for r in res.fetchall()), key=key)
    assert got == want
    assert {"full", "resolved", "changed", "missing"} == {r[cols.index("outcome")] for r in got}


def brute(rows):
    out = {}
    for rid, url, date, status, headers, body in rows:
        mine = {k.lower(): v for k, v in (headers or {}).items()}
        if status != 304:
            out[rid] = ("full", rid, mine)
            continue
        full = [r for r in rows if r[3] != 304 and url is not None and r[1] == url and None not in (date, r[2]) and r[2] < date]
        if not full:
            out[rid] = ("missing", None, mine)
            continue
        f = max(full, key=lambda r: (r[2], r[0]))
        theirs = {k.lower(): v for k, v in (f[4] or {}).items()}
        strip = lambda t: t[2:] if t and t.startswith("W/") else t
        if "etag" in mine:
            ok = strip(mine["etag"]) == strip(theirs.get("etag"))
        else:
            ok = "last-modified" not in mine or mine["last-modified"] == theirs.get("last-modified")
        merged = theirs | {k: v for k, v in mine.items() if k not in FIXED_HEADERS}
        out[rid] = ("resolved", f[0], merged) if ok else ("changed", None, mine)
    return out


def test_hot_url_equals_brute_force(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(1500):
        url = "http://hot.example/" if rnd.random() < 0.5 else f"http://x.example/{rnd.randrange(40)}"
        url = None if rnd.random() < 0.02 else url
        date = None if rnd.random() < 0.02 else rnd.randrange(300)
        status = rnd.choice([304, 304, 304, 304, 200, None])
        h = {"ETag": rnd.choice(['"a"', 'W/"a"', '"b"'])} if rnd.random() < 0.5 else {"Last-Modified": rnd.choice("xy")}
        h |= {"Content-Length": str(i), "X-N": str(i)}
        rows.append((i, url, date, status, None if rnd.random() < 0.05 else h, None if status == 304 else f"b{i}"))
    df = spark.createDataFrame(rows, "record_id long, url string, date long, status int, headers map<string,string>, body string")
    df = df.withColumn("part", F.lit(1)).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = {r.record_id: (r.outcome, r.resolved_id, r.headers) for r in resolve_revisits(df).collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute(rows)
    assert resolve_revisits(df.limit(0)).count() == 0


def test_canonical_url(spark):
    urls = {"HTTP://WWW.Ex.com:80/a/?utm_source=x&b=2&a=1#t": "ex.com/a?a=1&b=2", "https://ex.com": "ex.com", "": "",
            "ex.com/#a": "ex.com/#a", "https://ex.com/Q?": "ex.com/Q"}
    df = spark.createDataFrame([(u,) for u in urls], "url string").select("url", canonical_url(F.col("url")).alias("c"))
    assert {r.url: r.c for r in df.collect()} == urls


def test_header_names_fold(spark):
    df = spark.createDataFrame([(1, "http://a/", 5, 200, {"ETag": "1", "etag": "2"}, None), (1, "http://a/", 5, 200, {}, "x" * 10**6)],
                               "record_id long, url string, date long, status int, headers map<string,string>, body string")
    assert sorted((r.headers.get("etag"), r.body_bytes) for r in resolve_revisits(df.where("body is null")).collect()) == [("2", 0)]
    assert resolve_revisits(df).count() == 2
