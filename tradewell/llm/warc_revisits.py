"""WARC: resolution of not-modified revisits.

A revisit record (status 304) has no body. It is resolved by an as-of join: the
latest full response of the same canonical URL with an earlier date. If the
revisit names a validator (ETag, or else Last-Modified) that the response does
not have, it stays unresolved. The resolved record has the response's status,
body and headers, updated by those of the revisit that a 304 may update.

Records are put in one global order by (canonical URL, date) and the last
response is carried forward, also over the borders of partitions: a URL with a
third of all captures spans several tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tradewell.llm.common import register, stored, table
from tradewell.llm.ordered import as_batch

# Headers that a 304 response must not change in a stored one.
FIXED_HEADERS = ["connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
                 "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te",
                 "trailer", "transfer-encoding", "upgrade"]


def canonical_url(url) -> F.Column:
    """Host (lower case, without www., default port, scheme) + path (without a
    trailing slash) + query (sorted, without utm_ parameters); no fragment. A
    text that is no absolute URL is kept."""
    bare = F.regexp_replace(url, "#[^\n]*$", "")
    host = F.lower(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^www[0-9]*\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, r"^[^?]*\?(.*)$", 1)
    kept = F.sort_array(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.startswith(F.lower(p), F.lit("utm_"))))
    return F.when(bare.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"),
                  F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
                  ).otherwise(url)


def lower_names(headers) -> F.Column:
    """Header map with lower-case names; of names that differ in case only, the last stays."""
    e = F.coalesce(F.map_entries(headers), F.array().cast("array<struct<key:string,value:string>>"))
    low = F.transform(e, lambda x: F.struct(F.lower(x["key"]).alias("key"), x["value"].alias("value")))
    return F.map_from_entries(F.filter(low, lambda x, i: ~F.exists(
        F.slice(low, i + 2, F.greatest(F.size(low) - i - 1, F.lit(0))), lambda y: y["key"] == x["key"])))


def merged_headers(full, update) -> F.Column:
    """The headers of the full response, updated by the permitted ones."""
    allowed = F.map_filter(update, lambda k, v: ~k.isin(FIXED_HEADERS))
    return F.map_concat(F.map_filter(full, lambda k, v: ~F.map_contains_key(allowed, k)), allowed)


def same_etag(a, b) -> F.Column:
    return F.regexp_replace(a, "^W/", "") == F.regexp_replace(b, "^W/", "")


CARRIED = ["id", "status", "digest", "n_bytes", "headers"]


def carry_responses(lean: DataFrame) -> DataFrame:
    """Add to every row the last earlier answer of its key (f_ columns).

    Rows are range-partitioned by (key, date, full, id) and filled within their
    partition; the first key of a partition may go on from the partition before,
    so a summary with one row per partition hands the last answer over."""
    src = (lean.repartitionByRange("key", "date", "full", "id").sortWithinPartitions("key", "date", "full", "id")
           .withColumn("part", F.spark_partition_id()))
    kinds = {"id": pa.int64(), "status": pa.int64(), "digest": pa.string(), "n_bytes": pa.int64(), "headers": pa.string()}
    names = src.columns

    def fill(batches):
        pos, key, held, head = 0, None, None, True  # head: still in the partition's first key
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            col = lambda c: b.column(names.index(c))  # noqa: E731,B023
            keys, answers = col("key"), col("answers").to_numpy(zero_copy_only=False)
            opens = np.zeros(n, bool)
            opens[0] = pos > 0 and keys[0].as_py() != key
            if n > 1:
                opens[1:] = pa.compute.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
            i = np.arange(n)
            start = np.maximum.accumulate(np.where(opens, i, -1))
            last = np.maximum.accumulate(np.where(answers, i, -1))
            before = np.r_[-1, last[:-1]]
            near = np.where(before >= np.maximum(start, 0), before, -1)
            from_held = (near < 0) & (start < 0) & (held is not None)
            out = []
            for c in CARRIED:
                pool = pa.concat_arrays([col(c).cast(kinds[c]), pa.array([held[c] if held else None], kinds[c])])
                out.append(pool.take(pa.array(np.where(near >= 0, near, n), pa.int64(), mask=(near < 0) & ~from_held)))
            wants = (near < 0) & ~from_held & (start < 0) & head
            yield as_batch([*b.columns, *out, pos + i, wants], [*names, *[f"f_{c}" for c in CARRIED], "pos", "wants"])
            if last[-1] >= max(int(start[-1]), 0):
                held = {c: col(c)[int(last[-1])].as_py() for c in CARRIED}
            elif start[-1] >= 0:
                held = None
            pos, key, head = pos + n, keys[n - 1].as_py(), head and start[-1] < 0

    flag = src.schema["full"].dataType
    rows = stored(src.mapInArrow(fill, StructType(
        [*src.schema.fields, *[StructField(f"f_{c}", src.schema[c].dataType) for c in CARRIED],
         StructField("pos", LongType()), StructField("wants", flag)])), "warc-ordered")
    answer = F.when(F.col("answers"), F.struct("pos", "key", *CARRIED))
    parts = (rows.groupBy("part").agg(F.min("key").alias("a"), F.max("key").alias("z"), F.max(answer).alias("last"))
             .orderBy("part").collect())
    carry, now = [], None
    for p in parts:  # a few values per partition
        if now is not None and now.key == p.a:
            carry.append((p.part, *[now[c] for c in CARRIED]))
        if p.last is not None and p.last.key == p.z:
            now = p.last
        elif not (p.a == p.z and now is not None and now.key == p.a):
            now = None
    handed = rows.sparkSession.createDataFrame(carry, StructType(
        [StructField("hpart", rows.schema["part"].dataType), *[StructField(f"h_{c}", src.schema[c].dataType) for c in CARRIED]]))
    rows = rows.join(F.broadcast(handed), F.col("wants") & (F.col("part") == F.col("hpart")), "left")
    return rows.withColumns({f"f_{c}": F.coalesce(f"f_{c}", f"h_{c}") for c in CARRIED})


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Records have record_id (long), url, date (long or timestamp), status
    (304 marks a revisit), headers (map) and body. One row per record:
    record_id, canonical_url, outcome ('full', 'resolved', 'changed': the
    validators differ, 'missing': no earlier response), resolved_id, status,
    body_md5, body_bytes (long), headers (map, lower-case names).

    An unresolved revisit keeps its own status and headers and has no body.
    Records of one URL and date: revisits come first, so a response is never
    earlier than a revisit of the same date; of several responses of one date
    the largest record_id is the latest. A null URL or date never resolves; a
    null status is a full response, a null body has no MD5 and 0 bytes. Repeated
    rows stay; an empty table gives an empty result; other columns are not read."""
    revisit = F.coalesce(F.col("status") == 304, F.lit(False))
    raw = F.col("body").cast("binary")
    h = lower_names(F.col("headers"))
    lean = records.select(
        F.col("record_id").cast("long").alias("id"), canonical_url(F.col("url")).alias("curl"),
        F.col("date").alias("date"),
        (~revisit).alias("full"), F.col("status").cast("long").alias("status"), F.md5(raw).alias("digest"),
        F.coalesce(F.octet_length(raw), F.lit(0)).cast("long").alias("n_bytes"), F.to_json(h).alias("headers"))
    lean = lean.withColumn("key", F.coalesce("curl", F.lit("")))
    # records without URL or date take part in the order, but never as a response
    lean = lean.withColumn("answers", F.col("full") & F.col("curl").isNotNull() & F.col("date").isNotNull())
    lean = stored(lean, "warc-records")
    rows = carry_responses(lean).withColumnRenamed("full", "own")
    text = "map<string,string>"
    mine, theirs = F.from_json("headers", text), F.from_json("f_headers", text)
    known = F.col("curl").isNotNull() & F.col("date").isNotNull() & F.col("f_headers").isNotNull()
    etag = mine["etag"]
    fits = F.when(etag.isNotNull(), F.coalesce(same_etag(etag, theirs["etag"]), F.lit(False))).when(
        mine["last-modified"].isNotNull(), F.coalesce(mine["last-modified"] == theirs["last-modified"], F.lit(False))).otherwise(True)
    rows = rows.withColumn("outcome", F.when(F.col("own"), "full").when(~known, "missing").when(fits, "resolved").otherwise("changed"))
    got, own = F.col("outcome") == "resolved", F.col("outcome") == "full"
    pick = lambda a, b: F.when(got, a).otherwise(b)
    return rows.select(
        F.col("id").alias("record_id"), F.col("curl").alias("canonical_url"), "outcome",
        F.when(got, F.col("f_id")).when(own, F.col("id")).alias("resolved_id"),
        pick(F.col("f_status"), F.col("status")).alias("status"),
        F.when(got, F.col("f_digest")).when(own, F.col("digest")).alias("body_md5"),
        F.when(got, F.col("f_n_bytes")).when(own, F.col("n_bytes")).otherwise(0).cast("long").alias("body_bytes"),
        pick(merged_headers(theirs, mine), mine).alias("headers"))


def page_records(pages: DataFrame) -> DataFrame:
    """Captures derived from the pages: every page is a full response at date
    100 * page_id, and is asked for again later, or (each 11th) at a
    date before it; each 7th of these revisits names another ETag, each 5th none."""
    x = F.octet_length("url").cast("long")
    n = F.col("page_id") + x
    tag = F.concat(F.lit('"'), F.md5(F.col("html").cast("binary")), F.lit('"'))
    full = pages.select(
        (2 * F.col("page_id")).alias("record_id"), "url", (100 * F.col("page_id")).alias("date"), F.lit(200).alias("status"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("ETag"), tag, F.lit("Cache-Control"), F.lit("max-age=60"),
                     F.lit("Content-Length"), F.octet_length("html").cast("string")).alias("headers"), F.col("html").alias("body"))
    wrong = F.when(n % 7 == 0, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), tag))
    late = F.when(n % 11 == 0, -50).otherwise(50 + (F.col("page_id") * 7919 + x) % 100_000)
    short = F.create_map(F.lit("cache-control"), F.concat(F.lit("max-age="), (n % 1000).cast("string")),
                         F.lit("Content-Length"), F.lit("0"), F.lit("X-Seen"), F.col("page_id").cast("string"))
    again = pages.select((2 * F.col("page_id") + 1).alias("record_id"), "url", (100 * F.col("page_id") + late).alias("date"),
                         F.lit(304).alias("status"),
                         F.when(n % 5 == 0, short).otherwise(F.map_concat(short, F.create_map(F.lit("ETag"), wrong))).alias("headers"),
                         F.lit(None).cast("string").alias("body"))
    return full.union(again)


_SQL = r"""
WITH p AS (SELECT *, CAST(page_id AS BIGINT) AS pid, '"' || md5(html) || '"' AS tag, CAST(octet_length(encode(url)) AS BIGINT) AS x,
      regexp_replace(url, '#.*$', '') AS bare FROM pages),
u AS (SELECT *, list_sort(list_filter(string_split(regexp_extract(bare, '^[^?]*\?(.*)$', 1), '&'),
      lambda q: q <> '' AND NOT starts_with(lower(q), 'utm_'))) AS kept FROM p),
c AS (SELECT *, CASE WHEN regexp_matches(bare, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN
      regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), '^www[0-9]*\.', ''), ':(80|443)$', '')
      || regexp_replace(regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1), '/+$', '')
      || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END ELSE url END AS curl FROM u),
r AS (SELECT 2 * pid AS rid, curl, 100 * pid AS d, 1 AS isfull, tag, html, pid, x FROM c
      UNION ALL SELECT 2 * pid + 1, curl, 100 * pid + CASE WHEN (pid + x) % 11 = 0 THEN -50 ELSE 50 + (pid * 7919 + x) % 100000 END, 0,
      CASE WHEN (pid + x) % 5 = 0 THEN NULL WHEN (pid + x) % 7 = 0 THEN '"other"' ELSE tag END, NULL, pid, x FROM c),
w AS (SELECT *, last_value(CASE WHEN isfull = 1 THEN rid END IGNORE NULLS) OVER win AS fid,
      last_value(CASE WHEN isfull = 1 THEN tag END IGNORE NULLS) OVER win AS ftag,
      last_value(CASE WHEN isfull = 1 THEN html END IGNORE NULLS) OVER win AS fhtml FROM r
      WINDOW win AS (PARTITION BY curl ORDER BY d, isfull, rid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
o AS (SELECT *, CASE WHEN isfull = 1 THEN 'full' WHEN fid IS NULL THEN 'missing' WHEN tag IS NULL OR tag = ftag THEN 'resolved'
      ELSE 'changed' END AS outcome, CASE WHEN isfull = 1 THEN html ELSE fhtml END AS h,
      'cache-control: max-age=' || CAST((pid + x) % 1000 AS VARCHAR) AS cc FROM w)
SELECT rid AS record_id, curl AS canonical_url, outcome,
  CASE outcome WHEN 'resolved' THEN fid WHEN 'full' THEN rid END AS resolved_id,
  CAST(CASE WHEN outcome IN ('resolved', 'full') THEN 200 ELSE 304 END AS BIGINT) AS status,
  CASE WHEN outcome IN ('resolved', 'full') THEN md5(h) END AS body_md5,
  CAST(CASE WHEN outcome IN ('resolved', 'full') THEN octet_length(encode(h)) ELSE 0 END AS BIGINT) AS body_bytes,
  CASE outcome WHEN 'full' THEN 'cache-control: max-age=60' || chr(10) || 'content-length: ' || CAST(octet_length(encode(h)) AS VARCHAR)
      || chr(10) || 'content-type: text/html' || chr(10) || 'etag: ' || tag
    WHEN 'resolved' THEN cc || chr(10) || 'content-length: ' || CAST(octet_length(encode(h)) AS VARCHAR) || chr(10)
      || 'content-type: text/html' || chr(10) || 'etag: ' || CASE WHEN tag IS NULL THEN ftag ELSE 'W/' || tag END
      || chr(10) || 'x-seen: ' || CAST(pid AS VARCHAR)
    ELSE cc || chr(10) || 'content-length: 0' || CASE WHEN tag IS NULL THEN '' WHEN tag = '"other"' THEN chr(10) || 'etag: "other"'
      ELSE chr(10) || 'etag: W/' || tag END || chr(10) || 'x-seen: ' || CAST(pid AS VARCHAR) END AS headers
FROM o"""


@register("op9_warc_revisits", _SQL)
def op9_warc_revisits(spark, sf_dir):
    out = resolve_revisits(page_records(table(spark, sf_dir, "pages")))
    names = F.array_join(F.transform(F.array_sort(F.map_entries("headers")),
                                     lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
    return out.withColumn("headers", names)
