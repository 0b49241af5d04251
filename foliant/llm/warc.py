"""WARC: not-modified revisit records resolved against the latest earlier full response of the same canonical URL.

The as-of join has no group that grows without bound.  Full responses and questions are first reduced to one row for
each URL and second (map-side combine).  Within a URL and day, at most 86,400 instants, a window finds the latest
earlier response; what earlier days carry in is a window over one row for each URL and day.  Record rows meet
their answers in equi-joins, which adaptive execution splits where a URL is hot.  Payloads are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliant.llm.common import written

DAY = 86_400
# Header fields that a 304 response may update, and query parameters that only track.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = r"^(utm_[a-z]+|fbclid|gclid|msclkid|ref)(=|$)"
RECORD = "record_id string, kind string, url string, t long, etag string, last_modified string, headers map<string,string>, digest string"


def canonical_url(url: Column) -> Column:
    """Host in lower case without www. and default port, path without a last slash, sorted query without tracking.

    The scheme and the fragment are dropped.  Null stays null.
    """
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, "^[^/?]*", 0)), ":(80|443)$", ""),
        r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(TRACKING)))
    return F.concat(host, F.when(path == "", "/").otherwise(path),
        F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def lower_names(headers: Column) -> Column:
    """Headers under lower-case names; of names that differ in case only, the value of the last one by name counts."""
    entries = F.transform(F.map_entries(headers),
        lambda e: F.struct(F.lower(e.key).alias("key"), e.value.alias("value")))
    ordered = F.array_sort(entries)
    last = F.filter(ordered, lambda e, i: F.get(ordered, i + 1).isNull() | (F.get(ordered, i + 1).key != e.key))
    return F.map_from_entries(last)


def resolve(records: DataFrame) -> DataFrame:
    """An answer for each record of kind revisit.

    records: record_id, kind (response or revisit), url, t (seconds), etag, last_modified, headers (names in any
    case), digest.  status is
      no_earlier          no full response of the canonical URL is strictly earlier (also for a null URL or time),
      no_validator        the revisit has neither validator,
      validator_mismatch  its entity tag (weak comparison), or without one its last-modified, differs,
      resolved            it matches: headers are the response's, with the permitted ones of the revisit put over them.
    Of responses in the same second the greatest record_id counts; repeated revisits are each answered.
    """
    fields = ("record_id", "kind", "url", "t", "etag", "last_modified", "digest")
    r = records.select(*fields, lower_names(F.col("headers")).alias("headers"),
        canonical_url(F.col("url")).alias("canonical_url"))
    full = (r.where("kind = 'response' and t is not null and canonical_url is not null").groupBy("canonical_url", "t")
            .agg(F.max_by(F.struct("record_id", "etag", "last_modified", "headers", "digest"),
            "record_id").alias("full")))
    placed = "t is not null and canonical_url is not null"
    asked = r.where(f"kind = 'revisit' and {placed}")
    lost = r.where(f"kind = 'revisit' and not ({placed})")  # no join: they would all share one key
    day = F.floor(F.col("t") / DAY).cast("long").alias("day")
    instants = full.select("canonical_url", "t", F.col("t").alias("ref")).union(
        asked.select("canonical_url", "t").distinct().withColumn("ref", F.lit(None).cast("long"))).withColumn("day", day)
    before = W.partitionBy("canonical_url", "day").orderBy("t").rangeBetween(W.unboundedPreceding, -1)
    within = instants.withColumn("own", F.max("ref").over(before)).where("ref is null").select("canonical_url", "t",
        "day", "own")
    days = instants.groupBy("canonical_url", "day").agg(F.max("ref").alias("last"))
    carried = days.withColumn("carry",
        F.max("last").over(W.partitionBy("canonical_url").orderBy("day").rowsBetween(W.unboundedPreceding, -1)))
    answers = within.join(carried, ["canonical_url", "day"]).select("canonical_url", "t",
        F.coalesce("own", "carry").alias("ref"))
    found = asked.join(answers, ["canonical_url", "t"], "left")
    own = full.withColumnRenamed("t", "ref")
    both = found.join(own, ["canonical_url", "ref"], "left")
    weak = lambda c: F.regexp_replace(c, "^W/", "")
    f = F.col("full")
    status = (F.when(f.isNull(), "no_earlier")
              .when(F.col("etag").isNotNull(), F.when(weak(F.col("etag")) == weak(f.etag),
              "resolved").otherwise("validator_mismatch"))
              .when(F.col("last_modified").isNotNull(), F.when(F.col("last_modified") == f.last_modified,
              "resolved").otherwise("validator_mismatch"))
              .otherwise("no_validator"))
    none = F.create_map().cast("map<string,string>")
    update = F.map_filter(F.coalesce("headers", none), lambda k, v: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter(F.coalesce(f.headers, none), lambda k, v: ~F.map_contains_key(update, k)), update)
    found = both.withColumn("status", status).select(
        "record_id", "canonical_url", "status", f.record_id.alias("response_id"),
        F.when(F.col("status") == "resolved", f.digest).alias("digest"),
        F.when(F.col("status") == "resolved", merged).alias("headers"))
    text = F.lit(None).cast("string")
    return found.union(lost.select("record_id", "canonical_url", F.lit("no_earlier"), text, text,
        F.lit(None).cast("map<string,string>")))


def captures(pages: DataFrame) -> DataFrame:
    """Capture records of a crawl of pages, by rule from page_id.

    Each page has a full response; every third a later one with another body; each a revisit ten days on, under
    another spelling of its URL (entity tag of the latest body, or a stale one, or only a date, or nothing), and
    every thirteenth a revisit before its first response.
    """
    p = F.coalesce(F.col("page_id"), F.lit(0))
    html = F.coalesce("html", F.lit(""))
    t = F.lit(1_700_000_000) + F.pmod(p * 7919, F.lit(2_592_000))
    # explode makes the kinds from small values: the page itself is read into two digests first
    base = pages.select(p.alias("p"), F.col("url").alias("u"), t.cast("long").alias("t0"), F.md5(html).alias("a"),
        F.md5(F.concat(html, F.lit("v2"))).alias("b"))
    last = F.when(F.pmod("p", F.lit(3)) == 0, F.col("b")).otherwise(F.col("a"))
    tag = lambda d: F.concat(F.lit('"'), F.substring(d, 1, 16), F.lit('"'))
    modified = lambda d: F.concat(F.lit("m"), F.substring(d, 17, 8))
    text = lambda x: F.lit(x).cast("string")
    none = text(None)
    ask = F.when(F.pmod("p", F.lit(11)) == 2, none).when(F.pmod("p", F.lit(7)) == 1,
        none).when(F.pmod("p", F.lit(5)) == 0, F.concat(F.lit('"old'), F.col("p").cast("string"),
        F.lit('"'))).otherwise(F.concat(F.lit("W/"), tag(last)))
    ask_modified = F.when(F.pmod("p", F.lit(11)) == 2, none).when(F.pmod("p", F.lit(7)) == 1,
        modified(last)).otherwise(none)
    variant = F.concat(F.regexp_replace("u", "#.*$", ""),
        F.when(F.contains("u", F.lit("?")), F.lit("&utm_medium=mail#x")).otherwise(F.lit("?utm_medium=mail#x")))

    def record(name: str, kind: str, url: Column, at: Column, etag: Column, mod: Column, digest: Column) -> Column:
        head = F.map_filter(F.create_map(
            F.lit("date"), at.cast("string"), F.lit("etag"), etag, F.lit("last-modified"), mod, F.lit("content-type"),
            text("text/html"),
            F.lit("cache-control"), F.concat(F.lit("max-age="), F.pmod(at, F.lit(600)).cast("string")), F.lit("server"),
            text(kind)), lambda k, v: v.isNotNull())
        return F.struct(F.concat(F.lit(f"{name}-"), F.col("p").cast("string")).alias("record_id"),
            F.lit(kind).alias("kind"), url.alias("url"), at.cast("long").alias("t"), etag.alias("etag"),
            mod.alias("last_modified"), head.alias("headers"), digest.alias("digest"))

    u, t0 = F.col("u"), F.col("t0")
    each = F.filter(F.array(
        record("first", "response", u, t0, tag(F.col("a")), modified(F.col("a")), F.col("a")),
        F.when(F.pmod("p", F.lit(3)) == 0, record("second", "response", u, t0 + 5 * DAY, tag(F.col("b")),
        modified(F.col("b")), F.col("b"))),
        record("again", "revisit", variant, t0 + 10 * DAY, ask, ask_modified, none),
        F.when(F.pmod("p", F.lit(13)) == 3, record("early", "revisit", u, t0 - DAY, tag(F.col("a")), none, none))),
        lambda x: x.isNotNull())
    return base.select(F.explode(each).alias("r")).select("r.*")


def revisits(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The answers for the captures of pages, headers as name: value lines in order of name.

    The captures are written once, since the join reads them four times; pages and their digests are read once.
    """
    found = resolve(written(captures(pages), "captures"))
    lines = F.array_join(F.transform(F.array_sort(F.map_entries("headers")),
        lambda x: F.concat_ws(": ", x.key, x.value)), "\n")
    return found.select("record_id", "canonical_url", "status", "response_id", "digest", lines.alias("headers"))


REVISIT_SQL = r"""
WITH b AS (SELECT coalesce(page_id, 0) AS p, url AS u, 1700000000 + (coalesce(page_id, 0) * 7919) % 2592000 AS t0,
                  md5(coalesce(html, '')) AS a, md5(coalesce(html, '') || 'v2') AS b FROM pages),
v AS (SELECT *, CASE WHEN p % 3 = 0 THEN b ELSE a END AS l FROM b),
x AS (
  SELECT 'first-' || p AS id, 'response' AS kind, u, t0 AS t, '"' || substr(a, 1, 16) || '"' AS etag, 'm' || substr(a, 17, 8) AS lm, a AS digest FROM v
  UNION ALL SELECT 'second-' || p, 'response', u, t0 + 432000, '"' || substr(b, 1, 16) || '"', 'm' || substr(b, 17, 8), b FROM v WHERE p % 3 = 0
  UNION ALL SELECT 'again-' || p, 'revisit', regexp_replace(u, '#.*$', '') || CASE WHEN contains(u, '?') THEN '&' ELSE '?' END || 'utm_medium=mail#x', t0 + 864000,
    CASE WHEN p % 11 = 2 OR p % 7 = 1 THEN NULL WHEN p % 5 = 0 THEN '"old' || p || '"' ELSE 'W/"' || substr(l, 1, 16) || '"' END,
    CASE WHEN p % 11 = 2 THEN NULL WHEN p % 7 = 1 THEN 'm' || substr(l, 17, 8) END, NULL FROM v
  UNION ALL SELECT 'early-' || p, 'revisit', u, t0 - 86400, '"' || substr(a, 1, 16) || '"', NULL, NULL FROM v WHERE p % 13 = 3),
y AS (SELECT *, regexp_replace(regexp_replace(trim(u), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM x),
z AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), ':(80|443)$', ''), '^www\.', '') AS host,
             regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
             list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
               lambda q: q <> '' AND NOT regexp_matches(q, '^(utm_[a-z]+|fbclid|gclid|msclkid|ref)(=|$)'))) AS q FROM y),
c AS (SELECT *, host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS canonical_url FROM z),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY canonical_url, t ORDER BY id DESC) AS k FROM c WHERE kind = 'response') WHERE k = 1),
j AS (SELECT r.id AS record_id, r.canonical_url, r.t, r.etag, r.lm, f.id AS response_id, f.t AS ft, f.etag AS fe, f.lm AS fl, f.digest AS fd
      FROM c r LEFT JOIN f ON f.canonical_url = r.canonical_url AND f.t < r.t WHERE r.kind = 'revisit'
      QUALIFY row_number() OVER (PARTITION BY r.id ORDER BY f.t DESC NULLS LAST) = 1),
s AS (SELECT *, CASE WHEN response_id IS NULL THEN 'no_earlier'
        WHEN etag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') = fe THEN 'resolved' ELSE 'validator_mismatch' END
        WHEN lm IS NOT NULL THEN CASE WHEN lm = fl THEN 'resolved' ELSE 'validator_mismatch' END ELSE 'no_validator' END AS status FROM j)
SELECT record_id, canonical_url, status, response_id, CASE WHEN status = 'resolved' THEN fd END AS digest,
  CASE WHEN status = 'resolved' THEN 'cache-control: max-age=' || (t % 600) || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || t || chr(10)
    || 'etag: ' || coalesce(etag, fe) || chr(10) || 'last-modified: ' || coalesce(lm, fl) || chr(10) || 'server: response' END AS headers FROM s
"""
