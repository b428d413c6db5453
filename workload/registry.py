"""Where queries are registered, and the SQL building blocks they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakesteps.functions.text import UNICODE_SPACES


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}
_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(t)``, where ``t("orders")`` reads a table and ``t.spark`` is the session."""

    def add(fn):
        QUERIES[name] = Query(lambda spark, sf_dir: fn(Tables(spark, sf_dir)), sql)
        return fn

    return add


class Tables:
    """The tables of one folder; each is opened once, as opening one reads its schema."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._opened: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._opened[name]


def cte(name: str, sql: str, *needs: str) -> None:
    """A named SQL block for use in several check queries."""
    _CTES[name] = (needs, sql)


def with_ctes(select: str, *names: str) -> str:
    """``select`` with the named blocks, and those they need, in front."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for need in _CTES[name][0]:
                visit(need)
            ordered.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n][1]})" for n in ordered) + "\n" + select


_SPACES = " || ".join(f"chr({ord(c)})" for c in UNICODE_SPACES)


def trim(x: str) -> str:
    return f"trim({x}, {_SPACES})"


def rnd(x: str, digits: int) -> str:
    """Round the printed value, halves away from zero, as Spark rounds doubles."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"(({a}) / nullif(CAST({b} AS DOUBLE), 0))"


def initcap(x: str) -> str:
    """Words split at blanks, first letter up, the rest down."""
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            "lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ')")


def partial_date(x: str) -> str:
    """Day, month, quarter or year text to its first day; NULL for anything else."""
    t = trim(x)
    return (
        f"CASE WHEN regexp_full_match({t}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
        f"THEN try_cast({t} AS DATE) "
        f"WHEN regexp_full_match({t}, '[0-9]{{4}}-[0-9]{{2}}') THEN try_cast({t} || '-01' AS DATE) "
        f"WHEN regexp_full_match({t}, '[0-9]{{4}}-Q[1-4]') "
        f"THEN make_date(CAST(substr({t}, 1, 4) AS INTEGER), "
        f"CAST(substr({t}, 7, 1) AS INTEGER) * 3 - 2, 1) "
        f"WHEN regexp_full_match({t}, '[0-9]{{4}}') THEN try_cast({t} || '-01-01' AS DATE) END"
    )


def strict_date(x: str) -> str:
    return (f"CASE WHEN regexp_full_match({x}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
            f"THEN try_cast({x} AS DATE) END")
