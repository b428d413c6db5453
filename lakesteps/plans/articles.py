"""Article listings to records, and the refresh of an article table from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakesteps import functions as L
from lakesteps import schemas
from lakesteps.functions.text import LOCAL_TERMS
from lakesteps.operators.dedup import keep_first
from lakesteps.operators.merge import merge_new_first
from lakesteps.operators.records import (
    LISTING_EPOCH, LISTING_ISO, explode_json_records, extract_records,
)
from lakesteps.operators.select import keep_containing, require_text, take_until_marker
from lakesteps.session import materialize

RECORD = ("article_id", "publish_date", "title", "summary", "url")


def epoch_listing(pages: DataFrame, keep: Sequence[str], tz: str = "UTC") -> DataFrame:
    """Listing pages that state epoch seconds. The key of an article is the MD5 of its link."""
    found = require_text(extract_records(pages, LISTING_EPOCH, keep=keep), "url")
    return _records(found, keep, F.md5("url"), L.epoch_to_date(F.col("published"), tz))


def iso_listing(pages: DataFrame, keep: Sequence[str], host: str) -> DataFrame:
    """Listing pages that state ISO times, with links relative to ``host``."""
    found = extract_records(pages, LISTING_ISO, keep=keep)
    found = found.withColumn("url", L.absolute_url(F.col("url"), host))
    return _records(require_text(found, "url"), keep, F.md5("url"), L.iso_to_date(F.col("published")))


def _records(found: DataFrame, keep: Sequence[str], key: Column, day: Column) -> DataFrame:
    return found.select(
        *keep, "pos", key.alias("article_id"), day.alias("publish_date"), "title", "summary", "url")


def json_listing(
    responses: DataFrame, col: str, keep: Sequence[str], terms: Sequence[str] = LOCAL_TERMS
) -> DataFrame:
    """JSON article lists, kept where title or summary names one of the terms."""
    rows = explode_json_records(responses, col, schemas.ARTICLE_OBJECT, keep=keep)
    named = rows.select(
        *keep,
        F.col("PublisherId").alias("article_id"),
        L.parse_date_strict(L.prefix(F.col("Time_yyyyMMddHHmmss"), 10)).alias("publish_date"),
        L.trim_ws(F.col("Title")).alias("title"),
        L.trim_ws(F.col("Headlines")).alias("summary"),
        L.trim_ws(F.col("LinktoMe2")).alias("url"),
    )
    return keep_containing(named, ["title", "summary"], terms)


def fresh_articles(found: DataFrame, order: Sequence[str], last_url: str | None) -> DataFrame:
    """Records listed before the last known link, each link and each article once.

    ``order`` is the place in the listing, newest first.
    """
    if last_url is not None:
        found = take_until_marker(found, order, "url", last_url, descending=False)
    return keep_first(keep_first(found, ["url"], order), ["article_id"], order)


def refresh_articles(
    old: DataFrame,
    found: DataFrame,
    order: Sequence[str],
    last_url: str | None = None,
    drop_blank_title: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(articles, mark)``: new records win over stored ones.

    The mark is the first listed new record with the size of the table; it has no row when there
    is nothing new, so saving it then changes nothing.
    """
    # written once: the merge, the mark and the test for new records all read it
    fresh = materialize(fresh_articles(found, order, last_url), "fresh-articles")
    articles = merge_new_first(
        old.select(*RECORD), fresh.select(*RECORD), "article_id", "publish_date", drop_blank_title)
    first = F.min_by(F.struct("article_id", "url", "publish_date"), F.struct(*order)).alias("first")
    size = articles.agg(F.count(F.lit(1))).scalar()
    mark = fresh.agg(first).where("first is not null").select(
        F.col("first.article_id").alias("last_article_id"),
        F.col("first.url").alias("last_article_url"),
        F.col("first.publish_date").cast("string").alias("last_publish_date"),
        size.alias("total_articles"),
        F.current_timestamp().alias("last_update"),
    )
    return articles, mark
