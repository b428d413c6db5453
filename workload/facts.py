"""Dimensions, facts, roll-ups, indexes and scenarios over the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakesteps import functions as L
from lakesteps.operators import (
    count_by, dense_key, distinct_values, explode_days, explode_months, left_join_all, lookup_dim,
    minmax_scale, rollup_spec, scenarios, with_global_stats,
)
from lakesteps.plans.gold import calendar_dim
from lakesteps.session import materialize
from workload.registry import cte, div, query, rnd, with_ctes

# ---- dimensions

CALENDAR_COLS = """date_key, CAST(year(date_key) AS BIGINT) AS year,
  CAST(quarter(date_key) AS BIGINT) AS quarter, CAST(month(date_key) AS BIGINT) AS month,
  CAST(day(date_key) AS BIGINT) AS day, CAST(strftime(date_key, '%U') AS BIGINT) AS week_of_year,
  dayname(date_key) AS day_of_week, dayofweek(date_key) IN (0, 6) AS is_weekend"""


@query("dim_calendar", f"""
SELECT {CALENDAR_COLS} FROM (SELECT CAST(o_orderdate AS DATE) AS date_key FROM orders
  UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem UNION SELECT CAST(ts AS DATE) FROM events)""")
def dim_calendar(t):
    return calendar_dim([
        t("orders").select(F.to_date("o_orderdate")), t("lineitem").select(F.to_date("l_shipdate")),
        t("events").select(F.to_date("ts")),
    ])


@query("dim_dense_key", """
SELECT row_number() OVER (ORDER BY p_type) AS type_key, p_type
FROM (SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL)""")
def dim_dense_key(t):
    return dense_key(distinct_values(t("part"), "p_type"), ["p_type"], "type_key")


@query("dense_key_orders", """
SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_no, o_orderkey FROM orders""")
def dense_key_orders(t):
    rows = t("orders").select("o_orderdate", "o_orderkey")
    return dense_key(rows, ["o_orderdate", "o_orderkey"], "order_no").drop("o_orderdate")


@query("dim_lookup_left", """
SELECT n_nationkey, n_name, r_name FROM nation
LEFT JOIN (SELECT * FROM region WHERE r_name <> 'ASIA') ON n_regionkey = r_regionkey""")
def dim_lookup_left(t):
    regions = t("region").where("r_name <> 'ASIA'").withColumnRenamed("r_regionkey", "n_regionkey")
    return lookup_dim(t("nation"), regions, ["n_regionkey"], "r_name").drop("n_regionkey")


@query("fact_star", """
SELECT o_orderkey, c_custkey AS customer_key, n_nationkey AS nation_key, d.date_key, o_totalprice
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date_key FROM lineitem) d
  ON d.date_key = CAST(o_orderdate AS DATE)""")
def fact_star(t):
    customers = t("customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_custkey").alias("customer_key"), "c_nationkey")
    nations = t("nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_nationkey").alias("nation_key"))
    days = calendar_dim([t("lineitem").select(F.to_date("l_shipdate"))]).select(
        F.col("date_key").alias("day"), "date_key")
    rows = t("orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"),
                              "o_totalprice")
    rows = lookup_dim(rows, customers, ["o_custkey"], "customer_key", "c_nationkey")
    rows = lookup_dim(rows, nations, ["c_nationkey"], "nation_key")
    rows = lookup_dim(rows, days, ["day"], "date_key")
    return rows.select("o_orderkey", "customer_key", "nation_key", "date_key", "o_totalprice")


# ---- monthly counts

def month_keys(d):
    return {"year": F.year(d).cast("bigint"), "month": F.month(d).cast("bigint")}


def month_cols(d):
    return [e.alias(k) for k, e in month_keys(d).items()]


def month_sql(d: str) -> str:
    return f"CAST(year({d}) AS BIGINT) AS year, CAST(month({d}) AS BIGINT) AS month"


@query("count_by_month", f"SELECT {month_sql('l_shipdate')}, count(*) AS n FROM lineitem GROUP BY 1, 2")
def count_by_month(t):
    return count_by(t("lineitem"), month_keys("l_shipdate"))


@query("fact_conditional", f"""
SELECT {month_sql("o_orderdate")}, count(*) AS order_count,
  CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS finished,
  CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS open,
  CAST(sum(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END) AS BIGINT) AS building,
  count(nullif(o_orderpriority, '5-LOW')) AS with_priority
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
def fact_conditional(t):
    segments = t("customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    rows = t("orders").join(segments, "o_custkey", "inner")
    return rows.groupBy(*month_cols("o_orderdate")).agg(
        F.count(F.lit(1)).alias("order_count"),
        L.count_where(F.col("o_orderstatus") == "F").alias("finished"),
        L.count_where(F.col("o_orderstatus") == "O").alias("open"),
        L.count_where(F.col("c_mktsegment") == "BUILDING").alias("building"),
        F.count(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))).alias("with_priority"),
    )


# Orders as intervals: some without an end, some reversed.
cte("intervals", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS start_date, CASE
  WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
  WHEN o_orderstatus = 'P' THEN CAST(o_orderdate AS DATE) - 2
  ELSE CAST(o_orderdate AS DATE) + CAST(o_custkey % 40 AS INTEGER) END AS end_date FROM orders""")
cte("interval_days", """
SELECT o_orderkey, CAST(unnest(generate_series(start_date, coalesce(end_date, start_date),
  INTERVAL 1 DAY)) AS DATE) AS d FROM intervals WHERE start_date <= coalesce(end_date, start_date)""",
    "intervals")
cte("interval_months", f"SELECT {month_sql('d')}, count(o_orderkey) AS event_days FROM interval_days GROUP BY 1, 2",
    "interval_days")


def intervals(t):
    start = F.to_date("o_orderdate")
    end = (
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None).cast("date"))
        .when(F.col("o_orderstatus") == "P", F.date_sub(start, 2))
        .otherwise(F.date_add(start, (F.col("o_custkey") % 40).cast("int")))
    )
    return t("orders").select("o_orderkey", start.alias("start_date"), end.alias("end_date"))


def interval_month_counts(t):
    rows = explode_months(intervals(t), "start_date", "end_date")
    return rows.groupBy(*month_cols("month_start")).agg(F.sum("days").alias("event_days"))


@query("interval_days", with_ctes("SELECT * FROM interval_months", "interval_months"))
def interval_days(t):
    rows = explode_days(intervals(t), "start_date", "end_date", "d")
    return rows.groupBy(*month_cols("d")).agg(F.count("o_orderkey").alias("event_days"))


@query("interval_months", with_ctes("SELECT * FROM interval_months", "interval_months"))
def interval_months(t):
    return interval_month_counts(t)


# ---- the monthly fact: every feed summed up to its month, then joined

EVENT_MONTH = "CAST(CAST(ts AS DATE) - to_months(CAST(user_id % 60 + 276 AS INTEGER)) AS DATE)"
cte("fact_monthly", f"""
SELECT make_date(CAST(o.year AS INTEGER), CAST(o.month AS INTEGER), 1) AS report_date, o.year, o.month,
  o.order_count, o.revenue, coalesce(s.building_count, 0) AS building_count,
  l.quantity, l.avg_discount, e.avg_value, coalesce(i.event_days, 0) AS event_days
FROM (SELECT {month_sql("o_orderdate")}, count(*) AS order_count,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS revenue FROM orders GROUP BY 1, 2) o
LEFT JOIN (SELECT {month_sql("o_orderdate")}, count(*) FILTER (c_mktsegment = 'BUILDING') AS building_count
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) s USING (year, month)
LEFT JOIN (SELECT {month_sql("l_shipdate")}, CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS BIGINT) AS quantity,
        {rnd("avg(l_discount)", 6)} AS avg_discount FROM lineitem GROUP BY 1, 2) l USING (year, month)
LEFT JOIN (SELECT {month_sql(EVENT_MONTH)}, {rnd("avg(value)", 6)} AS avg_value FROM events GROUP BY 1, 2) e
  USING (year, month)
LEFT JOIN interval_months i USING (year, month)
WHERE o.year >= 1995 AND o.month BETWEEN 1 AND 12""", "interval_months")


def monthly(t):
    orders = t("orders")
    spine = orders.groupBy(*month_cols("o_orderdate")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("revenue"),
    ).where((F.col("year") >= 1995) & F.col("month").between(1, 12))
    segments = t("customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    buyers = orders.join(segments, "o_custkey").groupBy(*month_cols("o_orderdate")).agg(
        F.count_if(F.col("c_mktsegment") == "BUILDING").alias("building_count"))
    lines = t("lineitem").groupBy(*month_cols("l_shipdate")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("bigint").alias("quantity"),
        F.round(F.avg("l_discount"), 6).alias("avg_discount"))
    moved = F.add_months(F.to_date("ts"), -(F.col("user_id") % 60 + 276).cast("int"))
    values = t("events").select(moved.alias("d"), "value").groupBy(*month_cols("d")).agg(
        F.round(F.avg("value"), 6).alias("avg_value"))
    joined = left_join_all(spine, [buyers, lines, values, interval_month_counts(t)], ["year", "month"])
    return joined.select(
        L.month_start(F.col("year"), F.col("month")).alias("report_date"), "year", "month",
        "order_count", "revenue", L.default(F.col("building_count"), 0).alias("building_count"),
        "quantity", "avg_discount", "avg_value",
        L.default(F.col("event_days"), 0).alias("event_days"))


def written_month(t):
    """The monthly fact as a table: scaling reads it twice, once for the extremes."""
    return materialize(monthly(t), "fact-monthly")


@query("fact_monthly", with_ctes("SELECT * FROM fact_monthly", "fact_monthly"))
def fact_monthly(t):
    return monthly(t)


@query("mart_rollup", with_ctes(f"""
SELECT year, CAST(sum(order_count) AS BIGINT) AS total_orders, max(revenue) AS top_revenue,
  {rnd("avg(avg_value)", 6)} AS avg_value, min(avg_discount) AS low_discount,
  count(avg_value) AS months_with_events, CAST(sum(event_days) AS BIGINT) AS total_days
FROM fact_monthly GROUP BY year""", "fact_monthly"))
def mart_rollup(t):
    rows = rollup_spec(monthly(t), ["year"], {
        "total_orders": ("sum", "order_count"), "top_revenue": ("max", "revenue"),
        "avg_value": ("avg", "avg_value"), "low_discount": ("min", "avg_discount"),
        "months_with_events": ("count", "avg_value"), "total_days": ("sum", "event_days")})
    return rows.withColumn("avg_value", F.round("avg_value", 6))


MEASURES = {
    "visitor_score": "order_count", "revenue_score": "revenue", "flight_score": "quantity",
    "search_score": "avg_value", "event_score": "event_days",
}


def scaled_sql(col: str) -> str:
    """0..1 over the whole table; NULL stays NULL."""
    return div(f"{col} - min({col}) OVER ()", f"(max({col}) OVER () - min({col}) OVER ())")


cte("index_a_scores", "SELECT report_date, " + ", ".join(
    f"{scaled_sql(c)} * 100 AS {out}" for out, c in MEASURES.items()) + " FROM fact_monthly",
    "fact_monthly")
cte("index_a", f"""SELECT *, {rnd("visitor_score * 0.30 + revenue_score * 0.25 + flight_score * 0.20 + search_score * 0.15 + event_score * 0.10", 2)}
  AS health_index FROM index_a_scores""", "index_a_scores")
WEIGHTS_A = {"visitor_score": 0.30, "revenue_score": 0.25, "flight_score": 0.20,
             "search_score": 0.15, "event_score": 0.10}


def band_sql(col: str, labels: tuple[str, ...]) -> str:
    return (f"CASE WHEN {col} >= 80 THEN '{labels[0]}' WHEN {col} >= 60 THEN '{labels[1]}' "
            f"WHEN {col} >= 40 THEN '{labels[2]}' ELSE '{labels[3]}' END")


LABELS_A = ("Excellent", "Good", "Moderate", "Poor")
LABELS_B = ("Healthy", "Watch", "Warning", "Critical")


def bands(labels):
    return list(zip((80, 60, 40), labels))


@query("minmax_null_kept", with_ctes(
    "SELECT report_date, " + ", ".join(f"{rnd(c, 6)} AS {c}" for c in MEASURES)
    + " FROM index_a_scores", "index_a_scores"))
def minmax_null_kept(t):
    rows = minmax_scale(written_month(t), MEASURES)
    return rows.select("report_date", *[F.round(c, 6).alias(c) for c in MEASURES])


# Scaled over all order rows, where a window over the whole table would need one task.
@query("minmax_orders", f"""
SELECT o_orderkey, {scaled_sql("o_totalprice")} * 100 AS price_score,
  min(o_totalprice) OVER () AS lowest, max(o_totalprice) OVER () AS highest FROM orders""")
def minmax_orders(t):
    rows = minmax_scale(t("orders").select("o_orderkey", "o_totalprice"), {"price_score": "o_totalprice"})
    return with_global_stats(rows, ["o_totalprice"]).select(
        "o_orderkey", "price_score", F.col("min_o_totalprice").alias("lowest"),
        F.col("max_o_totalprice").alias("highest"))


cte("fractions", "SELECT *, " + ", ".join(
    f"coalesce({scaled_sql(c)}, 0) AS f_{c}"
    for c in ("avg_value", "quantity", "revenue", "avg_discount", "order_count", "event_days")
) + " FROM fact_monthly", "fact_monthly")
SHARE = f"{rnd('coalesce(' + div('building_count', 'order_count') + ', 0) * 100', 2)}"
cte("scores_b", f"""SELECT report_date, f_avg_value * 100 AS demand_score, f_quantity * 100 AS mobility_score,
  (f_revenue + (1 - f_avg_discount) + (1 - f_order_count)) / 3 * 100 AS environment_score,
  f_event_days * 100 AS event_score, {SHARE} AS sentiment_score FROM fractions""", "fractions")
SCORES_B = ("demand_score", "mobility_score", "environment_score", "event_score", "sentiment_score")
WEIGHTS_B = dict(zip(SCORES_B, (0.30, 0.25, 0.15, 0.15, 0.15)))
SUM_B = " + ".join(f"{c} * {w:.2f}" for c, w in WEIGHTS_B.items())
cte("index_b", "SELECT report_date, " + ", ".join(f"{rnd(c, 2)} AS {c}" for c in SCORES_B)
    + f", {rnd(SUM_B, 2)} AS health_index FROM scores_b", "scores_b")


FRACTIONS_B = {"f_demand": "avg_value", "f_mobility": "quantity", "f_warm": "revenue",
               "f_dry": "avg_discount", "f_calm": "order_count", "f_event": "event_days"}


def index_b(fact, *keep):
    rows = minmax_scale(fact, FRACTIONS_B, scale=1.0, null_to=0.0, invert=["f_dry", "f_calm"])
    scores = rows.select(
        "report_date", *keep, (F.col("f_demand") * 100).alias("demand_score"),
        (F.col("f_mobility") * 100).alias("mobility_score"),
        L.mean_of(F.col("f_warm"), F.col("f_dry"), F.col("f_calm"), scale=100).alias("environment_score"),
        (F.col("f_event") * 100).alias("event_score"),
        L.share(F.col("building_count"), F.col("order_count")).alias("sentiment_score"),
    ).withColumn("health_index", L.weighted_index(WEIGHTS_B))
    return scores.select("report_date", *keep, *[F.round(c, 2).alias(c) for c in SCORES_B], "health_index")


@query("minmax_null_zero", with_ctes("SELECT * FROM index_b", "index_b"))
def minmax_null_zero(t):
    return index_b(written_month(t))


@query("weighted_index_band", with_ctes(f"""
SELECT a.report_date, a.health_index AS index_a, {band_sql("a.health_index", LABELS_A)} AS status_a,
  b.health_index AS index_b, {band_sql("b.health_index", LABELS_B)} AS status_b
FROM index_a a JOIN index_b b USING (report_date)""", "index_a", "index_b"))
def weighted_index_band(t):
    fact = written_month(t)
    a = minmax_scale(fact, {f"a_{k}": v for k, v in MEASURES.items()})
    a = a.withColumn("index_a", L.weighted_index({f"a_{k}": w for k, w in WEIGHTS_A.items()}))
    return index_b(a, "index_a").withColumnRenamed("health_index", "index_b").select(
        "report_date", "index_a", L.band(F.col("index_a"), bands(LABELS_A), LABELS_A[3]).alias("status_a"),
        "index_b", L.band(F.col("index_b"), bands(LABELS_B), LABELS_B[3]).alias("status_b"))


def scenario_sql(index: str, source: str) -> str:
    """Three readings of one index table; factors work on the rounded scores."""
    def variant(name, factors):
        cols = {c: f"{c} * {factors[c]}" if c in factors else c for c in SCORES_B}
        total = " + ".join(f"({e}) * {WEIGHTS_B[c]:.2f}" for c, e in cols.items())
        value = rnd(total, 2) if factors else index
        scores = ", ".join(f"{e} AS {c}" for c, e in cols.items())
        return f"SELECT report_date, '{name}' AS scenario, {value} AS {index}, {scores} FROM {source}"

    return "\nUNION ALL\n".join([
        variant("Baseline", {}), variant("High Demand", {"demand_score": "1.20"}),
        variant("Festival Season", {"event_score": "1.5"})])


@query("scenario_union", with_ctes(scenario_sql("health_index", "index_b"), "index_b"))
def scenario_union(t):
    variants = {"Baseline": {}, "High Demand": {"demand_score": 1.20}, "Festival Season": {"event_score": 1.5}}
    return scenarios(index_b(written_month(t)), variants, WEIGHTS_B, "health_index", ids=["report_date"])


def flagship(t):
    """Monthly revenue index: roll-up, scaling, weighting, banding."""
    fact = written_month(t)
    rows = minmax_scale(fact, MEASURES).withColumn("health_index", L.weighted_index(WEIGHTS_A))
    return rows.withColumn("health_status", L.band(F.col("health_index"), bands(LABELS_A), LABELS_A[3]))
