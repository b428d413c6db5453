"""Cleansing: dates, defaults, keys, strings, column tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakesteps import functions as L
from lakesteps.operators import (
    check, keep_containing, not_null, require, require_text, score_text, term_matches, union_all, unique,
    word_list_label, word_list_scorer, class_counts,
)
from workload.registry import initcap, partial_date, query, rnd, strict_date, trim


# ---- dates

# One date in five notations, by priority: day, month, quarter, year, and one that is no date.
ORDER_DATE_TEXT = """CASE o_orderpriority
    WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN '2-HIGH' THEN strftime(o_orderdate, ' %Y-%m')
    WHEN '3-MEDIUM' THEN year(o_orderdate) || '-Q' || quarter(o_orderdate)
    WHEN '4-NOT SPECIFIED' THEN CAST(year(o_orderdate) AS VARCHAR)
    ELSE strftime(o_orderdate, '%d.%m.%Y') END"""


def order_date_text(d, priority):
    return (
        F.when(priority == "1-URGENT", F.date_format(d, "yyyy-MM-dd"))
        .when(priority == "2-HIGH", F.date_format(d, " yyyy-MM"))
        .when(priority == "3-MEDIUM", F.concat(F.year(d).cast("string"), F.lit("-Q"),
                                               F.quarter(d).cast("string")))
        .when(priority == "4-NOT SPECIFIED", F.year(d).cast("string"))
        .otherwise(F.date_format(d, "dd.MM.yyyy"))
    )


@query("partial_date_parse", f"""
SELECT o_orderkey, raw, {partial_date('raw')} AS repaired, {strict_date('raw')} AS strict
FROM (SELECT o_orderkey, {ORDER_DATE_TEXT} AS raw FROM orders)""")
def partial_date_parse(t):
    raw = order_date_text(F.col("o_orderdate"), F.col("o_orderpriority"))
    return t("orders").select("o_orderkey", raw.alias("raw")).select(
        "o_orderkey", "raw",
        L.parse_partial_date(F.col("raw")).alias("repaired"),
        L.parse_date_strict(F.col("raw")).alias("strict"),
    )


@query("date_repair_duration", """
SELECT l_orderkey, l_linenumber, CAST(o_orderdate AS DATE) AS start_date,
  CAST(l_shipdate AS DATE) AS end_date,
  CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) + 1 AS BIGINT) AS duration_days,
  CAST(year(o_orderdate) AS BIGINT) AS event_year
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_shipdate IS NOT NULL AND o_orderdate IS NOT NULL""")
def date_repair_duration(t):
    orders = require(t("orders"), ["o_orderdate"]).select(
        F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("start_date"))
    lines = require(t("lineitem"), ["l_shipdate"]).select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("end_date"))
    start, end = F.col("start_date"), F.col("end_date")
    return lines.join(orders, "l_orderkey").select(
        "l_orderkey", "l_linenumber", "start_date", "end_date",
        L.duration_days(start, end).cast("bigint").alias("duration_days"),
        F.year(start).cast("bigint").alias("event_year"),
    )


@query("parse_times", """
SELECT event_id, CAST(ts AS DATE) AS from_epoch,
  CAST(ts + INTERVAL 7 HOUR AS DATE) AS from_epoch_local,
  CAST(ts AS DATE) AS from_iso, CAST(ts AS DATE) AS from_heading,
  CASE WHEN event_type = 'click' THEN NULL ELSE CAST(ts AS DATE) END AS from_mixed,
  CAST(CAST(ts AS DATE) - INTERVAL 3 DAY AS DATE) AS days_before,
  CAST(NULL AS DATE) AS from_junk
FROM events""")
def parse_times(t):
    ts = F.col("ts")
    day_seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts))
    epoch = F.unix_date(F.to_date(ts)).cast("bigint") * 86400 + day_seconds
    text = t("events").select(
        "event_id",
        epoch.cast("string").alias("epoch"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("iso"),
        F.date_format(ts, "EEEE, MMM d").alias("heading"),
        F.year(ts).alias("y"),
        F.when(F.col("event_type") == "view", F.date_format(ts, "dd/MM/yyyy"))
        .when(F.col("event_type") == "click", F.lit("yesterday"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd")).alias("mixed"),
        F.to_date(ts).alias("d"), "event_type",
    )
    return text.select(
        "event_id",
        L.epoch_to_date(F.col("epoch")).alias("from_epoch"),
        L.epoch_to_date(F.col("epoch"), "Asia/Bangkok").alias("from_epoch_local"),
        L.iso_to_date(F.col("iso")).alias("from_iso"),
        L.heading_to_date(F.col("heading"), F.col("y")).alias("from_heading"),
        L.parse_or_null(F.col("mixed"), ["yyyy-MM-dd", "dd/MM/yyyy"]).alias("from_mixed"),
        F.date_sub("d", 3).alias("days_before"),
        L.epoch_to_date(F.col("event_type")).alias("from_junk"),
    )


# ---- defaults and keys

@query("safe_defaults", f"""
SELECT l_orderkey, l_linenumber,
  coalesce(nullif(l_discount, 0), 0.01) AS discount,
  CAST(coalesce(CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END, 0) AS BIGINT) AS quantity,
  CAST(coalesce(CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END, 0) + l_linenumber AS BIGINT) AS total,
  {rnd("coalesce(nullif(l_tax, 0), (l_discount + l_tax) / 2)", 1)} AS rate
FROM lineitem""")
def safe_defaults(t):
    quantity = L.to_long(F.when(F.col("l_returnflag") != "R", F.col("l_quantity")))
    return t("lineitem").select(
        "l_orderkey", "l_linenumber",
        L.default(F.nullif(F.col("l_discount"), F.lit(0.0)), 0.01).alias("discount"),
        L.default(quantity, 0).alias("quantity"),
        L.total(quantity, F.col("l_linenumber")).cast("bigint").alias("total"),
        L.fallback_mean(F.nullif(F.col("l_tax"), F.lit(0.0)), F.col("l_discount"), F.col("l_tax"))
        .alias("rate"),
    )


@query("surrogate_keys", """
SELECT c_custkey, md5(c_custkey || '_' || c_mktsegment) AS customer_id, md5(c_name) AS name_id,
  c_nationkey || '-' || c_mktsegment || '-' || nullif(c_name, 'Customer#000000001') AS readable_id
FROM customer""")
def surrogate_keys(t):
    name = F.nullif(F.col("c_name"), F.lit("Customer#000000001"))
    return t("customer").select(
        "c_custkey",
        L.surrogate_key([F.col("c_custkey"), F.col("c_mktsegment")]).alias("customer_id"),
        L.surrogate_key([F.col("c_name")]).alias("name_id"),
        L.joined_key([F.col("c_nationkey"), F.col("c_mktsegment"), name]).alias("readable_id"),
    )


# ---- strings

@query("string_normalise", f"""
SELECT page_id, lower({trim("padded")}) AS link, CAST(length({trim("padded")}) AS BIGINT) AS link_length,
  substr(url, 1, 10) AS head,
  CASE WHEN starts_with(path, '/') THEN 'https://site.example' || path ELSE path END AS absolute,
  CASE WHEN fragment <> '' THEN fragment WHEN path <> '' THEN path ELSE '' END AS anchor
FROM (SELECT page_id, url, chr(160) || chr(9) || url || ' ' AS padded,
        regexp_extract(url, '^https?://[^/]+(/[^#]*)', 1) AS path,
        regexp_extract(url, '#(.*)$', 1) AS fragment FROM pages)
WHERE url <> ''""")
def string_normalise(t):
    pages = require_text(t("pages"), "url").select(
        "page_id", "url", F.concat(F.lit("\xa0\t"), "url", F.lit(" ")).alias("padded"),
        F.regexp_extract("url", "^https?://[^/]+(/[^#]*)", 1).alias("path"),
        F.regexp_extract("url", "#(.*)$", 1).alias("fragment"),
    )
    return pages.select(
        "page_id", L.normal(F.col("padded")).alias("link"),
        F.length(L.trim_ws(F.col("padded"))).cast("bigint").alias("link_length"),
        L.prefix(F.col("url"), 10).alias("head"),
        L.absolute_url(F.col("path"), "https://site.example").alias("absolute"),
        L.first_non_empty(F.col("fragment"), F.col("path")).alias("anchor"),
    )


@query("initcap_category", f"SELECT p_partkey, {initcap('upper(p_name)')} AS category FROM part")
def initcap_category(t):
    return t("part").select("p_partkey", F.initcap(F.upper("p_name")).alias("category"))


CLEANED = r"""trim(regexp_replace(regexp_replace(text, '<.*?>', ' ', 'g'), '[^\p{L}\p{N}_]+', ' ', 'g'))"""


@query("text_clean", f"""
SELECT doc_id, md5({CLEANED}) AS text_md5, CAST(length({CLEANED}) AS BIGINT) AS text_length
FROM documents""")
def text_clean(t):
    cleaned = t("documents").select("doc_id", "text").select("doc_id", L.clean_text(F.col("text")).alias("cleaned"))
    return cleaned.select(
        "doc_id", F.md5("cleaned").alias("text_md5"),
        F.length("cleaned").cast("bigint").alias("text_length"))


TERMS = ("license", "copyright", "password", "avec", "über", "para", "whthe", "ndtion", "@", "http")


# Terms from a table: whole passages, their first eight signs, and their first three, which most texts hold.
@query("terms_from_table", """
WITH t AS (SELECT item_id, k, substr(text, 1, k) AS term FROM benchmark, unnest([3, 8, 100000]) AS u(k))
SELECT doc_id, item_id * 10 + CASE k WHEN 3 THEN 0 WHEN 8 THEN 1 ELSE 2 END AS term_no
FROM documents JOIN t ON contains(lower(text), lower(term)) WHERE term <> ''""")
def terms_from_table(t):
    cut = lambda n, k: F.struct((F.col("item_id") * 10 + n).alias("term_no"), F.substring("text", 1, k).alias("term"))
    terms = t("benchmark").select(F.inline(F.array(cut(0, 3), cut(1, 8), cut(2, 100000))))
    return term_matches(t("documents"), terms, "doc_id", "text", "term_no", "term")


@query("contains_any", f"""
SELECT doc_id, lang FROM documents
WHERE {" OR ".join(f"contains(lower(source || ' ' || text), '{w}')" for w in TERMS)}""")
def contains_any(t):
    rows = t("documents").select("doc_id", "lang", "source", "text")
    return keep_containing(rows, ["source", "text"], TERMS).select("doc_id", "lang")


POSITIVE_WORDS = ("the", "with", "le", "und", "para", "avec", "für", "from")
NEGATIVE_WORDS = ("not", "of", "de", "nicht", "est", "der", "con", "at")


def _count(words: tuple[str, ...]) -> str:
    inside = ", ".join(f"'{w}'" for w in words)
    return f"len(list_filter(words, lambda w: w IN ({inside})))"


SCORED_SQL = f"""
SELECT doc_id, CAST(score AS BIGINT) AS score,
  CASE score WHEN 1 THEN 'Tích cực' WHEN -1 THEN 'Tiêu cực' ELSE 'Trung lập' END AS label
FROM (SELECT doc_id, sign({_count(POSITIVE_WORDS)} - {_count(NEGATIVE_WORDS)}) AS score
      FROM (SELECT doc_id, string_split(lower({CLEANED}), ' ') AS words FROM documents))"""


@query("score_text", SCORED_SQL)
def score_documents(t):
    factory = word_list_scorer(POSITIVE_WORDS, NEGATIVE_WORDS)
    scored = score_text(t("documents").select("doc_id", "text"), "text", factory)
    return scored.select("doc_id", F.col("score").cast("bigint").alias("score"), "label")


@query("score_text_native", SCORED_SQL)
def score_documents_native(t):
    pair = word_list_label(F.col("text"), POSITIVE_WORDS, NEGATIVE_WORDS)
    rows = t("documents").select("doc_id", "text")
    return rows.select("doc_id", pair.alias("p")).select(
        "doc_id", F.col("p.score").cast("bigint").alias("score"), F.col("p.label").alias("label"))


# ---- classes and column tests

@query("class_counts_daily", """
SELECT CAST(ts AS DATE) AS day,
  count(*) FILTER (event_type IN ('click', 'purchase')) AS domestic,
  count(*) FILTER (event_type NOT IN ('click', 'purchase')) AS international,
  count(*) AS total
FROM events GROUP BY 1""")
def class_counts_daily(t):
    kind = L.class_by_membership(
        F.col("event_type"), ["click", "purchase"], "domestic", "international")
    rows = t("events").select(F.to_date("ts").alias("day"), kind.alias("kind"))
    return class_counts(rows, "day", "kind", ["domestic", "international"])


DQ_RULES = {
    "orders": [unique("o_orderkey"), not_null("o_orderkey"), unique("o_custkey"), not_null("o_orderdate")],
    "lineitem": [unique("l_orderkey"), not_null("l_shipdate")],
    "customer": [unique("c_custkey"), not_null("c_name"), unique("c_mktsegment")],
    "part": [unique("p_name"), not_null("p_type")],
    "supplier": [unique("s_suppkey"), not_null("s_acctbal")],
    "nation": [unique("n_nationkey"), unique("n_regionkey")],
    "region": [unique("r_regionkey"), not_null("r_name")],
    "events": [unique("event_id"), not_null("props"), unique("user_id"), not_null("value")],
    "documents": [unique("doc_id"), unique("text"), not_null("lang")],
    "labels": [unique("doc_id"), not_null("quality")],
    "pages": [unique("url"), not_null("html")],
    "embeddings": [unique("vec_id"), not_null("label")],
    "benchmark": [unique("item_id"), not_null("text")],
    "conversations": [unique("conv_id"), not_null("role")],
}


def _rule_sql(table: str, rule) -> str:
    head = f"SELECT '{table}' AS relation, '{rule.name}' AS rule, '{rule.column}' AS \"column\", "
    if rule.name == "not_null":
        return f"{head}count(*) FILTER ({rule.column} IS NULL) AS failures FROM {table}"
    return (f"{head}count(*) AS failures FROM (SELECT {rule.column} FROM {table} "
            f"WHERE {rule.column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")


@query("dq_report", "\nUNION ALL\n".join(
    _rule_sql(table, rule) for table, rules in DQ_RULES.items() for rule in rules))
def dq_report(t):
    return union_all([
        check(t(table), rules).select(F.lit(table).alias("relation"), "*")
        for table, rules in DQ_RULES.items()
    ])
