"""Column tests."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    column: str


def unique(column: str) -> Rule:
    """No value occurs twice; NULLs do not count."""
    return Rule("unique", column)


def not_null(column: str) -> Rule:
    return Rule("not_null", column)


def check(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """``(rule, column, failures)``; a rule passes with 0. One pass and one shuffle for all rules.

    A row gives a 128-bit digest for each ``unique`` rule and a mark for each failed ``not_null``
    rule; these are counted per value, on the map side first. Failures of ``unique`` are the
    repeated values. Texts of any length travel as digests.
    """
    rules = list(rules)
    marks = []
    for i, rule in enumerate(rules):
        value = F.col(rule.column)
        digest = F.when(value.isNull(), F.lit("") if rule.name == "not_null" else None)
        if rule.name == "unique":
            digest = F.md5(value.cast("binary") if dict(df.dtypes)[rule.column] == "string"
                           else value.cast("string").cast("binary"))
        marks.append(F.struct(F.lit(i).alias("_rule"), digest.alias("_value")))
    found = df.select(F.inline(F.array(*marks))).where(F.col("_value").isNotNull())
    counts = found.groupBy("_rule", "_value").agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.agg(*[
        (F.count_if((F.col("_rule") == i) & (F.col("_n") > 1)) if rule.name == "unique"
         else F.coalesce(F.sum(F.when(F.col("_rule") == i, F.col("_n"))), F.lit(0))
         ).cast("bigint").alias(f"_{i}") for i, rule in enumerate(rules)])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column"),
                 F.col(f"_{i}").alias("failures")) for i, r in enumerate(rules)])))


def require_checks(report: DataFrame) -> None:
    """Raise with the failed tests of a report; returns where there is none."""
    failed = report.where("failures > 0").collect()  # at most a row per rule
    if failed:
        raise ValueError("column tests failed: " + "; ".join(
            ", ".join(f"{k}={v}" for k, v in row.asDict().items()) for row in failed))


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


# The column tests of the silver layer. The article date is tested under the name it has there.
SILVER_RULES: dict[str, list[Rule]] = {
    "stg_flight_cleansed": [unique("flight_date"), not_null("flight_date"),
                            not_null("total_flights")],
    "stg_weather_cleansed": [unique("weather_date"), not_null("weather_date"),
                             not_null("temp_mean_celsius")],
    "stg_tourism_stats_cleansed": [unique("stat_id"), not_null("stat_id"),
                                   not_null("accommodation_guests")],
    "stg_news_cleansed": [unique("url"), not_null("url"), not_null("report_date"),
                          not_null("title")],
    "stg_trend_cleansed": [unique("trend_id"), not_null("trend_id"),
                           not_null("search_interest")],
    "stg_events_cleansed": [unique("event_id"), not_null("event_id"), not_null("event_name"),
                            not_null("start_date")],
}
