"""Semi-structured sources, reshaping and files."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F, types as T

from lakesteps.operators import (
    explode_json_records, explode_lateral, extract_pattern_records, extract_records, json_field,
    outer_join_all, pivot_last, union_all, unpivot_long, zip_arrays_to_rows,
)
from lakesteps.operators.records import Element, FieldRule, ListingRule
from lakesteps.plans.articles import epoch_listing, iso_listing, json_listing
from lakesteps.session import run_dir
from lakesteps.sources import (
    append, export_csv, load_mark, read_csv_blocks, read_delimited, read_inferred_csv, read_partition,
    read_typed_csv, replace, save_mark, union_feeds,
)
from workload.registry import query

TYPES = ("click", "error", "purchase", "signup", "view")


@query("json_records", """
SELECT event_id, k, name FROM (
  SELECT event_id, regexp_extract(props, '[0-9]+', 0) AS k, '' AS name FROM events
  WHERE event_type <> 'error'
  UNION ALL SELECT event_id, CAST(event_id AS VARCHAR), event_type FROM events
  WHERE event_type <> 'error')""")
def json_records(t):
    # a list of two objects; error events hold a bare object, which is no list
    listed = F.format_string('[%s, {"k": %d, "name": "%s"}]', "props", "event_id", "event_type")
    body = F.when(F.col("event_type") == "error", F.col("props")).otherwise(listed)
    rows = t("events").select("event_id", body.alias("body"))
    schema = T.StructType.fromDDL("k string, name string")
    return explode_json_records(rows, "body", schema, keep=["event_id"])


@query("json_field", """
SELECT event_id, CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS k, 'none' AS missing
FROM events""")
def json_fields(t):
    return t("events").select(
        "event_id", json_field(F.col("props"), "k").cast("bigint").alias("k"),
        json_field(F.col("props"), "absent", "none").alias("missing"))


@query("zip_arrays", """
SELECT vec_id, CAST(idx AS BIGINT) AS idx, CAST(value AS DOUBLE) AS value, 'archive' AS source
FROM (SELECT vec_id, unnest(range(len(embedding))) AS idx, unnest(embedding) AS value FROM embeddings)""")
def zip_arrays(t):
    size = F.size("embedding").cast("bigint")
    rows = zip_arrays_to_rows(
        t("embeddings"),
        {"idx": F.sequence(F.lit(0).cast("bigint"), size - 1),
         "value": F.col("embedding").cast("array<double>")},
        {"source": "archive"}, keep=["vec_id"],
    )
    return rows


@query("explode_lateral", """
SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents""")
def explode_lines(t):
    return explode_lateral(t("documents").select("doc_id", "text"),
                           F.split("text", "\n"), "line").drop("text")


# ---- markup

LINK = r"""<a href="[^"]*">[^<]*</a>"""
LINK_FIELDS = {"link": r"""href="([^"]*)\"""", "title": r""">([^<]*)<"""}


@query("html_records", f"""
SELECT page_id, CAST(pos AS BIGINT) AS pos, page_title,
  regexp_extract(block, '{LINK_FIELDS["link"]}', 1) AS link,
  regexp_extract(block, '{LINK_FIELDS["title"]}', 1) AS title
FROM (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS page_title,
        unnest(blocks) AS block, unnest(range(len(blocks))) AS pos
      FROM (SELECT *, regexp_extract_all(html, '{LINK}') AS blocks FROM pages))""")
def html_records(t):
    titled = t("pages").withColumn(
        "page_title", F.regexp_extract("html", "<title>([^<]*)</title>", 1))
    rows = extract_pattern_records(titled, "html", LINK, LINK_FIELDS, keep=["page_id", "page_title"])
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


NAV_ITEM = ListingRule(Element("li"), {
    "title": FieldRule((Element("a"),), text=True),
    "link": FieldRule((Element("a"),), attr="href"),
})


@query("html_records_parser", r"""
SELECT page_id, CAST(pos AS BIGINT) AS pos, regexp_extract(block, 'href="([^"]*)"', 1) AS link,
  replace(regexp_extract(block, '>([^<]*)</a>', 1), '&amp;', '&') AS title
FROM (SELECT page_id, unnest(blocks) AS block, unnest(range(len(blocks))) AS pos
      FROM (SELECT *, regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>') AS blocks FROM pages))""")
def html_records_parser(t):
    rows = extract_records(t("pages"), NAV_ITEM, keep=["page_id"])
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


@query("html_listing_epoch", """
SELECT page_id, md5(url) AS article_id, 'Page ' || page_id AS title, url,
  'About ' || page_id || ' & more' AS summary,
  CAST(DATE '2024-01-01' + CAST(page_id % 300 AS INTEGER) AS DATE) AS publish_date
FROM pages WHERE url <> ''""")
def html_listing_epoch(t):
    seconds = F.lit(1704067200).cast("bigint") + (F.col("page_id") % 300) * 86400
    item = F.format_string(
        '<div><article class="item-news thumb item-news-common" data-publishtime="%d"><img src="x">'
        '<h3 class="title-news"><a href="%s">Page <b>%d</b></a></h3><p class="description">'
        '<a>About %d &amp; more</a></p></article><article class="item-news item-news-common">'
        '<h3 class="title-news"><a href="">No link</a></h3></article></div>',
        seconds, F.replace("url", F.lit("&"), F.lit("&amp;")), "page_id", "page_id")
    pages = t("pages").select("page_id", item.alias("html"))
    # the title pieces of nested tags are joined without a blank
    title = F.replace("title", F.lit("Page"), F.lit("Page "))
    return epoch_listing(pages, keep=["page_id"]).withColumn("title", title).drop("pos")


@query("html_listing_iso", """
SELECT page_id, md5('https://site.example/p/' || page_id) AS article_id, url AS title,
  'https://site.example/p/' || page_id AS url, 'Sapo ' || page_id AS summary,
  CASE WHEN starts_with(url, 'https') THEN DATE '2024-03-05' END AS publish_date
FROM pages""")
def html_listing_iso(t):
    stamp = F.when(F.col("url").startswith("https"), "2024-03-05T06:07:08").otherwise("5 March")
    item = F.format_string(
        '<div class="box-category-item"><a class="box-category-link-title" title="%s" href="/p/%d">t'
        '</a><a class="box-category-sapo">Sapo <i>%d</i></a><div class="box-time" title="%s"></div></div>',
        F.replace("url", F.lit("&"), F.lit("&amp;")), "page_id", "page_id", stamp)
    pages = t("pages").select("page_id", item.alias("html"))
    return iso_listing(pages, ["page_id"], "https://site.example").drop("pos")


@query("json_listing", """
SELECT page_id, CAST(page_id AS VARCHAR) AS article_id, DATE '2024-03-05' AS publish_date,
  'Sự kiện ' || page_id AS title, 'ở ĐÀ NẴNG' AS summary, url
FROM pages WHERE starts_with(url, 'https')""")
def json_articles(t):
    place = F.when(F.col("url").startswith("https"), "ở ĐÀ NẴNG").otherwise("ở nơi khác")
    body = F.format_string(
        '[{"Title": " Sự kiện %d ", "Headlines": "%s", "LinktoMe2": "%s", '
        '"Time_yyyyMMddHHmmss": "2024-03-05 06:07", "PublisherId": %d}]',
        "page_id", place, "url", "page_id")
    return json_listing(t("pages").select("page_id", body.alias("body")), "body", ["page_id"])


# ---- long and wide

def _daily(t):
    return t("events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n"))


WIDE_SQL = "SELECT CAST(ts AS DATE) AS day, " + ", ".join(
    f"nullif(count(*) FILTER (event_type = '{x}'), 0) AS \"{x}\"" for x in TYPES
) + " FROM events GROUP BY 1"


@query("pivot_wide", WIDE_SQL)
def pivot_wide(t):
    return pivot_last(_daily(t), "day", "event_type", "n", TYPES, ["day"])


@query("melt_long", f"""
SELECT day, keyword, search_interest FROM ({WIDE_SQL})
UNPIVOT (search_interest FOR keyword IN ({", ".join(TYPES)}))""")
def melt_long(t):
    wide = pivot_last(_daily(t), "day", "event_type", "n", TYPES, ["day"])
    return unpivot_long(wide, ["day"], TYPES, "keyword", "search_interest")


@query("outer_join_all", """
SELECT coalesce(a.day, b.day, c.day) AS day, a.anchor, a.clicks, b.errors, c.big FROM
  (SELECT CAST(ts AS DATE) AS day, count(*) AS anchor, count(*) FILTER (event_type = 'click') AS clicks
   FROM events GROUP BY 1) a
FULL JOIN (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS errors FROM orders GROUP BY 1) b
  ON a.day = b.day
FULL JOIN (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS big FROM lineitem
  GROUP BY 1) c ON c.day = coalesce(a.day, b.day)""")
def outer_join_days(t):
    def daily(df, ts, **counts):
        return df.groupBy(F.to_date(ts).alias("day")).agg(
            *[e.alias(n) for n, e in counts.items()])

    everything = F.count(F.lit(1))
    a = daily(t("events"), "ts", anchor=everything, clicks=F.count_if(F.col("event_type") == "click"))
    b = daily(t("orders"), "o_orderdate", anchor=everything, errors=everything)
    c = daily(t("lineitem"), "l_shipdate", anchor=everything, big=everything)
    return outer_join_all([a, b, c], "day", anchor="anchor")


# ---- files

# Texts with line breaks and quotes, through files that are cut into blocks wherever their size says.
@query("csv_blocks", "SELECT doc_id, lang, source, n_chars, text FROM documents")
def csv_blocks(t):
    root = f"{run_dir(t.spark)}/blocks-{uuid.uuid4().hex}"
    docs = t("documents").select("doc_id", "lang", "source", "n_chars", "text")
    export_csv(docs, root)
    return read_csv_blocks(t.spark, root, docs.schema)


@query("csv_roundtrip", """
SELECT 'delimited' AS step, CAST(c_custkey AS VARCHAR) AS key, c_name || ', "x"' AS value FROM customer
UNION ALL SELECT 'typed', CAST(c_custkey AS VARCHAR), c_mktsegment FROM customer
UNION ALL SELECT 'inferred', CAST(c_custkey AS VARCHAR), CAST(c_nationkey AS VARCHAR) FROM customer
UNION ALL SELECT 'feeds', CAST(c_custkey AS VARCHAR), c_name FROM customer
UNION ALL SELECT 'feeds', CAST(s_suppkey AS VARCHAR), s_name FROM supplier
UNION ALL SELECT 'rejected', 'n', 'c_custkey,c_name'
UNION ALL SELECT 'appended', CAST(c_custkey AS VARCHAR), c_name FROM customer
UNION ALL SELECT 'appended', CAST(c_custkey AS VARCHAR), c_name FROM customer
UNION ALL SELECT 'replaced', CAST(c_custkey AS VARCHAR), upper(c_name) FROM customer
UNION ALL SELECT 'partition', CAST(event_id AS VARCHAR), event_type FROM events
  WHERE CAST(ts AS DATE) = DATE '2024-01-05'
UNION ALL SELECT 'mark', 'last_date', CAST(CAST(max(ts) AS DATE) AS VARCHAR) FROM events""")
def csv_roundtrip(t):
    spark = t.spark
    root = f"{run_dir(spark)}/files-{uuid.uuid4().hex}"
    customer, supplier = t("customer"), t("supplier")

    def step(name, df, key, value):
        return df.select(F.lit(name).alias("step"), F.col(key).cast("string").alias("key"),
                         F.col(value).cast("string").alias("value"))

    quoted = customer.select("c_custkey", F.concat("c_name", F.lit(', "x"')).alias("c_name"))
    export_csv(quoted, f"{root}/semi", sep=";")
    delimited = read_delimited(
        spark, f"{root}/semi", T.StructType.fromDDL("c_custkey bigint, c_name string"), sep=";")
    export_csv(customer, f"{root}/c")
    typed = read_typed_csv(
        spark, f"{root}/c", T.StructType.fromDDL("c_mktsegment string, c_custkey bigint, extra date"))
    inferred = read_inferred_csv(spark, f"{root}/c")
    export_csv(supplier.select(F.col("s_name").alias("c_name"), F.col("s_suppkey").alias("c_custkey")),
               f"{root}/s")
    export_csv(t("nation"), f"{root}/n")
    feeds, rejected = union_feeds(
        spark, [f"{root}/c", f"{root}/absent", f"{root}/n", f"{root}/s"], ["c_custkey", "c_name"])
    rejects = spark.range(1).select(
        F.lit(rejected[0][0].rsplit("/", 1)[1]).alias("path"), F.lit(",".join(rejected[0][1])).alias("m"))

    names = customer.select("c_custkey", "c_name")
    append(names, f"{root}/appended")
    append(names, f"{root}/appended")
    append(names, f"{root}/replaced")
    stored = spark.read.parquet(f"{root}/replaced")
    replace(stored.withColumn("c_name", F.upper("c_name")), f"{root}/replaced")

    days = t("events").select("event_id", "event_type", F.to_date("ts").alias("ds"))
    append(days.hint("rebalance", "ds"), f"{root}/days", partition_by=["ds"])
    mark_path = f"{root}/mark"
    save_mark(days.agg(F.max("ds").cast("string").alias("last_date")), mark_path)
    save_mark(days.limit(0).select(F.col("ds").cast("string").alias("last_date")), mark_path)
    mark = load_mark(spark, mark_path, "last_date string")
    marks = spark.range(1).select(F.lit("last_date").alias("k"), F.lit(mark.last_date).alias("v"))
    return union_all([
        step("delimited", delimited, "c_custkey", "c_name"),
        step("typed", typed, "c_custkey", "c_mktsegment"),
        step("inferred", inferred, "c_custkey", "c_nationkey"),
        step("feeds", feeds, "c_custkey", "c_name"),
        step("rejected", rejects, "path", "m"),
        step("appended", spark.read.parquet(f"{root}/appended"), "c_custkey", "c_name"),
        step("replaced", spark.read.parquet(f"{root}/replaced"), "c_custkey", "c_name"),
        step("partition", read_partition(spark, f"{root}/days", date(2024, 1, 5)), "event_id", "event_type"),
        step("mark", marks, "k", "v"),
    ])
