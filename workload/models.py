"""The layered models on their own schemas, with the feeds cut from the supplied tables.

Order, line, event and document rows stand in for the feeds; their dates are moved by 25 years so
that all feeds share the months from 2020 on.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lakesteps.operators import keep_first, word_list_scorer
from lakesteps.operators.rollup import high_water, high_water_value
from lakesteps.operators.merge import reprocess_window
from lakesteps.operators.quality import SILVER_RULES
from lakesteps.plans import bronze, gold, silver
from lakesteps.plans.articles import refresh_articles
from lakesteps.plans.build import check_silver
from lakesteps.session import materialize, run_dir
from lakesteps.sources import load_mark, read_days
from workload.cleaning import (
    NEGATIVE_WORDS, ORDER_DATE_TEXT, POSITIVE_WORDS, SCORED_SQL, order_date_text,
)
from workload.facts import (
    CALENDAR_COLS, LABELS_A, LABELS_B, band_sql, month_sql, scaled_sql, scenario_sql,
)
from workload.registry import (
    cte, div, initcap, partial_date, query, rnd, strict_date, trim, with_ctes,
)

MOVED = 25 * 12


def moved(c):
    return F.add_months(F.to_date(c), MOVED)


def moved_sql(c: str) -> str:
    return f"CAST(CAST({c} AS DATE) + INTERVAL {MOVED} MONTH AS DATE)"


# ---- feeds

def flight_feed(t):
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    undated = (status == "P") & (priority == "4-NOT SPECIFIED")
    return t("orders").select(
        F.when(~undated, moved("o_orderdate")).alias("flight_date"),
        F.when(priority != "5-LOW", F.col("o_custkey")).alias("domestic_flights"),
        F.when(status != "P", F.floor(F.col("o_totalprice") / 1000)).alias("international_flights"),
        F.floor(F.col("o_totalprice") / 100).alias("total_flights"),
        priority.alias("data_source"),
    )


cte("flight", f"""SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN NULL
    ELSE {moved_sql("o_orderdate")} END AS flight_date,
  CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS domestic_flights,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice / 1000) AS BIGINT) END AS international_flights,
  CAST(floor(o_totalprice / 100) AS BIGINT) AS total_flights, o_orderpriority AS data_source FROM orders""")


def weather_feed(t):
    quantity = F.col("l_quantity")
    return t("lineitem").select(
        moved("l_shipdate").alias("date"),
        F.when(F.col("l_returnflag") != "R", quantity + F.col("l_tax")).alias("temp_mean"),
        (quantity + F.col("l_tax") * 10).alias("temp_max"),
        (quantity - F.col("l_discount") * 10).alias("temp_min"),
        F.when(F.col("l_linestatus") != "O", F.col("l_discount") * 100).alias("rainfall_mm"),
        (F.col("l_tax") * 100).alias("wind_speed_max"),
        F.col("l_returnflag").alias("source"),
    )


cte("weather", f"""SELECT {moved_sql("l_shipdate")} AS date,
  CASE WHEN l_returnflag <> 'R' THEN l_quantity + l_tax END AS temp_mean,
  l_quantity + l_tax * 10 AS temp_max, l_quantity - l_discount * 10 AS temp_min,
  CASE WHEN l_linestatus <> 'O' THEN l_discount * 100 END AS rainfall_mm,
  l_tax * 100 AS wind_speed_max, l_returnflag AS source FROM lineitem""")


def statistics_feed(t):
    day, price = moved("o_orderdate"), F.floor("o_totalprice")
    annual = F.col("o_orderpriority") == "5-LOW"
    return t("orders").select(
        F.year(day).cast("bigint").alias("year"),
        F.when(~annual, F.month(day)).cast("bigint").alias("month"),
        F.when(annual, "annual").otherwise("monthly").alias("period_type"),
        price.alias("accommodation_guests"),
        F.col("o_custkey").alias("accommodation_intl_guests"),
        F.when(F.col("o_orderstatus") != "P", price - F.col("o_custkey"))
        .alias("accommodation_domestic_guests"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("tourism_revenue_billion_vnd"),
    )


cte("tourism_stats", f"""SELECT CAST(year(day) AS BIGINT) AS year,
  CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(month(day) AS BIGINT) END AS month,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'annual' ELSE 'monthly' END AS period_type,
  CAST(floor(o_totalprice) AS BIGINT) AS accommodation_guests, o_custkey AS accommodation_intl_guests,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice) AS BIGINT) - o_custkey END AS accommodation_domestic_guests,
  CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS tourism_revenue_billion_vnd
FROM (SELECT *, {moved_sql("o_orderdate")} AS day FROM orders)""")


def news_feed(t):
    """Documents as articles: several share a link, some have no title, most are unscored."""
    zero = F.lit(0)
    crawled = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        zero, zero, zero, (F.col("doc_id") * 60).cast("decimal(18,6)"))
    score = (F.col("quality") - F.col("toxic")).cast("bigint")
    label = (F.when(score > 0, "Tích cực ").when(score < 0, "Tiêu cực").when(score == 0, "Trung lập"))
    return t("documents").join(t("labels"), "doc_id", "left").select(
        F.format_string(" a%d", "doc_id").alias("article_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("n_chars") % 2400).cast("int")).alias("publish_date"),
        F.nullif(F.substring_index("text", "\n", 1), F.lit("")).alias("title"),
        F.col("text").alias("summary"),
        F.concat(F.lit("\xa0https://"), "source", F.lit("/"), "lang", F.lit("/"),
                 F.col("n_chars").cast("string"), F.lit(" ")).alias("url"),
        F.concat(F.lit(" "), F.upper("source")).alias("source"),
        F.concat(F.lit("API "), "lang").alias("source_system"),
        crawled.alias("crawl_time"), score.alias("sentiment_score"), label.alias("sentiment_label"),
    )


cte("news", """SELECT ' a' || doc_id AS article_id,
  CAST(DATE '2020-01-01' + CAST(n_chars % 2400 AS INTEGER) AS DATE) AS publish_date,
  nullif(split_part(text, chr(10), 1), '') AS title, text AS summary,
  chr(160) || 'https://' || source || '/' || lang || '/' || n_chars || ' ' AS url,
  ' ' || upper(source) AS source, 'API ' || lang AS source_system,
  TIMESTAMP '2024-01-01' + to_seconds(doc_id * 60) AS crawl_time,
  CAST(quality - toxic AS BIGINT) AS sentiment_score,
  CASE WHEN quality > toxic THEN 'Tích cực ' WHEN quality < toxic THEN 'Tiêu cực'
    WHEN quality = toxic THEN 'Trung lập' END AS sentiment_label
FROM documents LEFT JOIN labels USING (doc_id)""")


def trend_feed(t):
    back = -(F.col("user_id") % 40).cast("int")
    return t("events").select(
        F.add_months(F.to_date("ts"), back).alias("search_date"),
        F.when(F.col("event_type") != "error",
               F.concat(F.lit(" "), F.upper("event_type"), F.lit("\xa0"))).alias("keyword"),
        F.floor("value").alias("search_interest"),
        F.lit(" Google_Trends").alias("source"), F.lit("PyTrends").alias("source_system"),
        F.col("ts").alias("crawl_time"),
    )


cte("google_trends", """SELECT CAST(CAST(ts AS DATE) - to_months(CAST(user_id % 40 AS INTEGER)) AS DATE) AS search_date,
  CASE WHEN event_type <> 'error' THEN ' ' || upper(event_type) || chr(160) END AS keyword,
  CAST(floor(value) AS BIGINT) AS search_interest, ' Google_Trends' AS source, 'PyTrends' AS source_system,
  ts AS crawl_time FROM events""")


def event_feed(t):
    """Orders as events: dates in five notations, some without end, some reversed, some unplaced."""
    day, priority, status = moved("o_orderdate"), F.col("o_orderpriority"), F.col("o_orderstatus")
    rows = t("orders").withColumns({"day": day})
    end = (
        F.when(status == "P", F.lit(None).cast("string"))
        .when(status == "F", order_date_text(F.date_add("day", 9), priority))
        .when(priority == "2-HIGH", F.date_format(F.date_sub("day", 5), "yyyy-MM-dd"))
        .otherwise(F.date_format(F.date_add("day", 3), "yyyy-MM-dd"))
    )
    return rows.select(
        F.concat(F.lit("\xa0Event "), F.col("o_custkey").cast("string"), F.lit(" ")).alias("event_name"),
        order_date_text(F.col("day"), priority).alias("start_date"), end.alias("end_date"),
        F.when(priority != "4-NOT SPECIFIED", F.concat(priority, F.lit("/"), status)).alias("location"),
        F.concat(F.lit(" "), F.lower(F.replace(priority, F.lit("-"), F.lit(" "))), F.lit(" mUSIC ")).alias("category"),
    )


def _text_of(day: str) -> str:
    return ORDER_DATE_TEXT.replace("o_orderdate", day)


cte("event", f"""SELECT chr(160) || 'Event ' || o_custkey || ' ' AS event_name, {_text_of("day")} AS start_date,
  CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F' THEN {_text_of("(day + 9)")}
    WHEN o_orderpriority = '2-HIGH' THEN strftime(day - 5, '%Y-%m-%d')
    ELSE strftime(day + 3, '%Y-%m-%d') END AS end_date,
  CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority || '/' || o_orderstatus END AS location,
  ' ' || lower(replace(o_orderpriority, '-', ' ')) || ' mUSIC ' AS category
FROM (SELECT *, {moved_sql("o_orderdate")} AS day FROM orders)""")


# ---- silver

cte("stg_flight", """SELECT md5(CAST(flight_date AS VARCHAR)) AS flight_id, flight_date,
  coalesce(domestic_flights, 0) AS domestic_flights, coalesce(international_flights, 0) AS international_flights,
  coalesce(domestic_flights, 0) + coalesce(international_flights, 0) AS total_flights, data_source
FROM flight WHERE flight_date IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY flight_date ORDER BY flight.total_flights DESC NULLS LAST,
  flight.domestic_flights DESC NULLS LAST, flight.international_flights DESC NULLS LAST,
  flight.data_source DESC NULLS LAST) = 1""", "flight")
cte("stg_weather", f"""SELECT md5(CAST(date AS VARCHAR)) AS weather_id, date AS weather_date,
  {rnd("coalesce(temp_mean, (temp_max + temp_min) / 2)", 1)} AS temp_mean_celsius,
  coalesce(rainfall_mm, 0) AS rainfall_mm, coalesce(wind_speed_max, 0) AS wind_speed_max
FROM (SELECT * FROM weather QUALIFY row_number() OVER (PARTITION BY date ORDER BY temp_mean DESC NULLS LAST,
  temp_max DESC NULLS LAST, temp_min DESC NULLS LAST, rainfall_mm DESC NULLS LAST,
  wind_speed_max DESC NULLS LAST, source DESC NULLS LAST) = 1)""", "weather")
cte("stg_statistics", """SELECT year || '-' || month || '-' || period_type AS stat_id, year AS stat_year,
  month AS stat_month, period_type, coalesce(accommodation_guests, 0) AS accommodation_guests,
  coalesce(accommodation_intl_guests, 0) AS accommodation_intl_guests,
  coalesce(accommodation_domestic_guests, 0) AS accommodation_domestic_guests,
  coalesce(tourism_revenue_billion_vnd, 0) AS tourism_revenue_billion_vnd
FROM (SELECT * FROM tourism_stats QUALIFY row_number() OVER (PARTITION BY year, month, period_type
  ORDER BY accommodation_guests DESC NULLS LAST, accommodation_intl_guests DESC NULLS LAST,
  accommodation_domestic_guests DESC NULLS LAST, tourism_revenue_billion_vnd DESC NULLS LAST) = 1)""",
    "tourism_stats")
cte("stg_news", f"""SELECT {trim("article_id")} AS article_id, publish_date AS report_date, {trim("title")} AS title,
  {trim("summary")} AS summary, {trim("url")} AS url, lower({trim("source")}) AS source,
  lower({trim("source_system")}) AS source_system, CAST(crawl_time AS VARCHAR) AS crawl_time,
  CAST(length({trim("title")}) AS BIGINT) AS title_length, CAST(length({trim("summary")}) AS BIGINT) AS summary_length,
  coalesce(sentiment_score, 0) AS sentiment_score, coalesce({trim("sentiment_label")}, 'Uncategorized') AS sentiment_label
FROM (SELECT * FROM news WHERE article_id IS NOT NULL AND title IS NOT NULL AND publish_date IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {trim("url")} ORDER BY crawl_time DESC) = 1)""", "news")
cte("stg_trend", f"""SELECT md5(search_date || '_' || keyword) AS trend_id, search_date AS report_date,
  lower({trim("keyword")}) AS keyword, search_interest, lower({trim("source")}) AS source,
  lower(source_system) AS source_system, {month_sql("search_date")}, strftime(search_date, '%Y-%m') AS year_month
FROM google_trends WHERE keyword IS NOT NULL AND search_interest IS NOT NULL""", "google_trends")
cte("stg_events", f"""SELECT md5(start_date || '_' || event_name) AS event_id, *,
  CAST(date_diff('day', start_date, end_date) + 1 AS BIGINT) AS duration_days, CAST(year(start_date) AS BIGINT) AS event_year
FROM (SELECT {trim("event_name")} AS event_name, {partial_date("start_date")} AS start_date,
  {partial_date("end_date")} AS end_date, {trim("location")} AS location, {initcap(trim("category"))} AS category
  FROM event WHERE event_name IS NOT NULL AND start_date IS NOT NULL AND end_date IS NOT NULL)""", "event")


def unstamped(df):
    return df.drop("dbt_processed_at")


def stated_time(df):
    return df.withColumn("crawl_time", F.col("crawl_time").cast("string"))


@query("model_silver_flight", with_ctes("SELECT * FROM stg_flight", "stg_flight"))
def model_silver_flight(t):
    return unstamped(silver.silver_flight(flight_feed(t)))


@query("model_silver_weather", with_ctes("SELECT * FROM stg_weather", "stg_weather"))
def model_silver_weather(t):
    return unstamped(silver.silver_weather(weather_feed(t)))


@query("model_silver_statistics", with_ctes("SELECT * FROM stg_statistics", "stg_statistics"))
def model_silver_statistics(t):
    return unstamped(silver.silver_statistics(statistics_feed(t)))


@query("model_silver_news", with_ctes("SELECT * FROM stg_news", "stg_news"))
def model_silver_news(t):
    return stated_time(silver.silver_news(news_feed(t)))


@query("model_silver_trend", with_ctes("SELECT * FROM stg_trend", "stg_trend"))
def model_silver_trend(t):
    return silver.silver_trend(trend_feed(t)).drop("crawl_time")


@query("model_silver_events", with_ctes("SELECT * FROM stg_events", "stg_events"))
def model_silver_events(t):
    return silver.silver_events(event_feed(t))



def _test_sql(view: str, relation: str, rule: str, col: str) -> str:
    head = f"SELECT '{relation}' AS relation, '{rule}' AS rule, '{col}' AS \"column\", count(*) AS failures FROM "
    if rule == "not_null":
        return f"{head}{view} WHERE {col} IS NULL"
    return f"{head}(SELECT 1 FROM {view} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)"


SILVER_FEEDS = {
    "stg_flight_cleansed": (silver.silver_flight, flight_feed, "stg_flight"),
    "stg_weather_cleansed": (silver.silver_weather, weather_feed, "stg_weather"),
    "stg_tourism_stats_cleansed": (silver.silver_statistics, statistics_feed, "stg_statistics"),
    "stg_news_cleansed": (silver.silver_news, news_feed, "stg_news"),
    "stg_trend_cleansed": (silver.silver_trend, trend_feed, "stg_trend"),
    "stg_events_cleansed": (silver.silver_events, event_feed, "stg_events"),
}


@query("model_silver_checks", with_ctes("\nUNION ALL\n".join(
    _test_sql(SILVER_FEEDS[relation][2], relation, rule.name, rule.column)
    for relation, rules in SILVER_RULES.items() for rule in rules),
    *[view for _, _, view in SILVER_FEEDS.values()]))
def model_silver_checks(t):
    return check_silver({name: make(feed(t)) for name, (make, feed, _) in SILVER_FEEDS.items()})


# ---- gold

cte("dim_time", f"""SELECT {CALENDAR_COLS} FROM (SELECT report_date AS date_key FROM stg_news
  UNION SELECT report_date FROM stg_trend UNION SELECT weather_date FROM stg_weather
  UNION SELECT flight_date FROM stg_flight)""", "stg_news", "stg_trend", "stg_weather", "stg_flight")
cte("dim_location", """SELECT row_number() OVER (ORDER BY location) AS location_key, location
FROM (SELECT DISTINCT location FROM event WHERE location IS NOT NULL)""", "event")


def _dim_event_sql(parse) -> str:
    return f"""SELECT row_number() OVER (ORDER BY start_date NULLS FIRST, event_name NULLS FIRST,
  end_date NULLS FIRST, location_key NULLS FIRST, category NULLS FIRST) AS event_key, *
FROM (SELECT event_name, {parse("start_date")} AS start_date, {parse("end_date")} AS end_date, location_key, category
  FROM event LEFT JOIN dim_location USING (location))"""


cte("dim_event", _dim_event_sql(strict_date), "event", "dim_location")
cte("dim_event_repaired", _dim_event_sql(partial_date), "event", "dim_location")
cte("dim_news", """SELECT row_number() OVER (ORDER BY report_date, article_id, url) AS article_key, article_id,
  report_date, title, summary, url, source, source_system, crawl_time FROM stg_news""", "stg_news")
cte("dim_sentiment", """SELECT row_number() OVER (ORDER BY sentiment_label) AS sentiment_key, sentiment_label
FROM (SELECT DISTINCT sentiment_label FROM stg_news)""", "stg_news")
cte("fact_news", """SELECT article_key, date_key, sentiment_key, sentiment_score FROM stg_news s
LEFT JOIN (SELECT article_key, article_id, url FROM dim_news) USING (article_id, url)
LEFT JOIN (SELECT date_key FROM dim_time) ON report_date = date_key LEFT JOIN dim_sentiment USING (sentiment_label)""",
    "stg_news", "dim_news", "dim_time", "dim_sentiment")


def silver_views(t):
    """The silver relations the gold models read, each written because several read it."""
    return {
        "news": materialize(silver.silver_news(news_feed(t)), "silver-news"),
        "trend": materialize(silver.silver_trend(trend_feed(t)), "silver-trend"),
        "weather": materialize(silver.silver_weather(weather_feed(t)), "silver-weather"),
        "flight": materialize(silver.silver_flight(flight_feed(t)), "silver-flight"),
    }


def calendar(views):
    return gold.calendar_dim([
        views["news"].select("report_date"), views["trend"].select("report_date"),
        views["weather"].select("weather_date"), views["flight"].select("flight_date")])


@query("model_calendar", with_ctes("SELECT * FROM dim_time", "dim_time"))
def model_calendar(t):
    return calendar(silver_views(t))


@query("model_dim_location", with_ctes("SELECT * FROM dim_location", "dim_location"))
def model_dim_location(t):
    return gold.dim_location(event_feed(t))


@query("model_dim_event", with_ctes("SELECT * FROM dim_event", "dim_event"))
def model_dim_event(t):
    events = event_feed(t)
    return gold.dim_event(events, gold.dim_location(events))


@query("model_dim_event_repaired", with_ctes("SELECT * FROM dim_event_repaired", "dim_event_repaired"))
def model_dim_event_repaired(t):
    events = event_feed(t)
    return gold.dim_event(events, gold.dim_location(events), repair_dates=True)


@query("model_dim_news", with_ctes("SELECT * FROM dim_news", "dim_news"))
def model_dim_news(t):
    return stated_time(gold.dim_news(silver.silver_news(news_feed(t))))


@query("model_dim_sentiment", with_ctes("SELECT * FROM dim_sentiment", "dim_sentiment"))
def model_dim_sentiment(t):
    return gold.dim_sentiment(silver.silver_news(news_feed(t)))


@query("model_fact_news", with_ctes("SELECT * FROM fact_news", "fact_news"))
def model_fact_news(t):
    views = silver_views(t)
    news = views["news"]
    return gold.fact_news(news, gold.dim_news(news), calendar(views), gold.dim_sentiment(news))


def _monthly_sql(view: str, day: str, cols: str) -> str:
    return f"(SELECT {month_sql(day)}, {cols} FROM {view} GROUP BY 1, 2)"


cte("event_days", """SELECT event_key, CAST(unnest(generate_series(start_date, coalesce(end_date, start_date),
  INTERVAL 1 DAY)) AS DATE) AS d FROM dim_event WHERE start_date <= coalesce(end_date, start_date)""", "dim_event")
cte("fact_tourism", f"""SELECT make_date(CAST(stat_year AS INTEGER), CAST(stat_month AS INTEGER), 1) AS report_date,
  stat_year AS year, stat_month AS month, CAST(1 AS BIGINT) AS day,
  coalesce(news_count, 0) AS news_count, coalesce(positive_news, 0) AS positive_news,
  coalesce(neutral_news, 0) AS neutral_news, coalesce(negative_news, 0) AS negative_news,
  {rnd("avg_search_interest", 6)} AS avg_search_interest, {rnd("temp_mean_celsius", 6)} AS temp_mean_celsius,
  {rnd("rainfall_mm", 6)} AS rainfall_mm, {rnd("wind_speed_max", 6)} AS wind_speed_max,
  domestic_flights, international_flights, total_flights, coalesce(event_count, 0) AS event_count,
  accommodation_guests, accommodation_intl_guests, accommodation_domestic_guests, tourism_revenue_billion_vnd
FROM stg_statistics s
LEFT JOIN (SELECT {month_sql("report_date")}, count(*) AS news_count,
    count(*) FILTER (sentiment_label = 'Tích cực') AS positive_news,
    count(*) FILTER (sentiment_label = 'Trung lập') AS neutral_news,
    count(*) FILTER (sentiment_label = 'Tiêu cực') AS negative_news
  FROM fact_news JOIN dim_news USING (article_key) LEFT JOIN dim_sentiment USING (sentiment_key) GROUP BY 1, 2) n
  ON n.year = stat_year AND n.month = stat_month
LEFT JOIN {_monthly_sql("stg_trend", "report_date", "avg(search_interest) AS avg_search_interest")} tr
  ON tr.year = stat_year AND tr.month = stat_month
LEFT JOIN {_monthly_sql("stg_weather", "weather_date", "avg(temp_mean_celsius) AS temp_mean_celsius, "
    "avg(rainfall_mm) AS rainfall_mm, avg(wind_speed_max) AS wind_speed_max")} w
  ON w.year = stat_year AND w.month = stat_month
LEFT JOIN {_monthly_sql("stg_flight", "flight_date", "CAST(sum(domestic_flights) AS BIGINT) AS domestic_flights, "
    "CAST(sum(international_flights) AS BIGINT) AS international_flights, CAST(sum(total_flights) AS BIGINT) AS total_flights")} f
  ON f.year = stat_year AND f.month = stat_month
LEFT JOIN {_monthly_sql("event_days", "d", "count(event_key) AS event_count")} e
  ON e.year = stat_year AND e.month = stat_month
WHERE stat_year >= 2020 AND stat_month BETWEEN 1 AND 12""",
    "stg_statistics", "fact_news", "dim_news", "dim_sentiment", "stg_trend", "stg_weather", "stg_flight", "event_days")


def tourism_fact(t):
    views, events = silver_views(t), event_feed(t)
    news = views["news"]
    articles = gold.dim_news(news)
    sentiments = gold.dim_sentiment(news)
    fact = gold.fact_monthly(
        silver.silver_statistics(statistics_feed(t)),
        gold.fact_news(news, articles, calendar(views), sentiments), sentiments,
        views["trend"], views["weather"], views["flight"],
        gold.dim_event(events, gold.dim_location(events)),
    )
    # averages of doubles depend on the order of addition in their last digits
    averages = ["avg_search_interest", "temp_mean_celsius", "rainfall_mm", "wind_speed_max"]
    return fact.withColumns({c: F.round(c, 6) for c in averages})


def written_fact(t):
    return materialize(tourism_fact(t), "fact-tourism")


@query("model_fact_monthly", with_ctes("SELECT * FROM fact_tourism", "fact_tourism"))
def model_fact_monthly(t):
    return tourism_fact(t)


GUEST_COLS = ("accommodation_guests", "accommodation_intl_guests", "accommodation_domestic_guests",
              "tourism_revenue_billion_vnd")


@query("model_monthly_mart", with_ctes(f"""
SELECT year, month, CAST(sum(news_count) AS BIGINT) AS total_news, avg(avg_search_interest) AS avg_search_interest,
  avg(temp_mean_celsius) AS avg_temperature, sum(rainfall_mm) AS total_rainfall, max(wind_speed_max) AS max_wind_speed,
  CAST(sum(domestic_flights) AS BIGINT) AS total_domestic_flights,
  CAST(sum(international_flights) AS BIGINT) AS total_international_flights,
  CAST(sum(total_flights) AS BIGINT) AS total_flights, CAST(sum(event_count) AS BIGINT) AS total_events,
  {", ".join(f"max({c}) AS {c}" for c in GUEST_COLS)}
FROM fact_tourism GROUP BY year, month""", "fact_tourism"))
def model_monthly_mart(t):
    return gold.monthly_mart(tourism_fact(t))


MEASURES_A = {"visitor_score": "accommodation_guests", "revenue_score": "tourism_revenue_billion_vnd",
              "flight_score": "total_flights", "search_score": "avg_search_interest", "event_score": "event_count"}
cte("normalized_a", f"""SELECT report_date, year, month, day, {", ".join(MEASURES_A.values())},
  {", ".join(f"{scaled_sql(c)} * 100 AS {out}" for out, c in MEASURES_A.items())} FROM fact_tourism""", "fact_tourism")
cte("health_a", "SELECT *, " + rnd(
    "visitor_score * 0.30 + revenue_score * 0.25 + flight_score * 0.20 + search_score * 0.15 + event_score * 0.10", 2)
    + " AS tourism_health_index FROM normalized_a", "normalized_a")


@query("model_health_index_a", with_ctes(
    f"SELECT *, {band_sql('tourism_health_index', LABELS_A)} AS health_status FROM health_a", "health_a"))
def model_health_index_a(t):
    return gold.health_index_a(written_fact(t))


cte("fractions_t", "SELECT *, " + ", ".join(
    f"coalesce({scaled_sql(c)}, 0) AS f_{c}" for c in (
        "avg_search_interest", "total_flights", "temp_mean_celsius", "rainfall_mm", "wind_speed_max", "event_count"))
    + " FROM fact_tourism", "fact_tourism")
cte("normalized_b", f"""SELECT report_date, year, month, f_avg_search_interest * 100 AS demand_score,
  f_total_flights * 100 AS mobility_score,
  (f_temp_mean_celsius + (1 - f_rainfall_mm) + (1 - f_wind_speed_max)) / 3 * 100 AS environment_score,
  f_event_count * 100 AS event_score,
  {rnd("coalesce(" + div("positive_news", "news_count") + ", 0) * 100", 2)} AS sentiment_score FROM fractions_t""",
    "fractions_t")
SCORES = ("demand_score", "mobility_score", "environment_score", "event_score", "sentiment_score")
cte("health_b", f"""SELECT report_date, year, month, {", ".join(f"{rnd(c, 2)} AS {c}" for c in SCORES)},
  {rnd("demand_score * 0.30 + mobility_score * 0.25 + environment_score * 0.15 + event_score * 0.15 + sentiment_score * 0.15", 2)}
  AS tourism_health_index FROM normalized_b""", "normalized_b")


@query("model_health_index_b", with_ctes(
    f"SELECT *, {band_sql('tourism_health_index', LABELS_B)} AS health_status FROM health_b", "health_b"))
def model_health_index_b(t):
    return gold.health_index_b(written_fact(t))


@query("model_scenario_table", with_ctes(scenario_sql("tourism_health_index", "health_b"), "health_b"))
def model_scenario_table(t):
    return gold.scenario_table(gold.health_index_b(written_fact(t)))


# ---- bronze loads

ANCHOR = "click"
GROUPS = (("click", "view"), ("click", "purchase", "signup"), ("click", "error"))
KEYWORDS = ("click", "view", "purchase", "signup", "error")


def _group(events, keywords, lowest):
    rows = events.where(F.col("value") >= lowest)
    return rows.groupBy(F.to_date("ts").alias("date")).agg(*[
        F.nullif(F.count_if(F.col("event_type") == k), F.lit(0)).alias(k) for k in keywords])


def refreshed(t):
    """The stored table holds all days; the newest ten are loaded again from three groups."""
    events = t("events").select("ts", "event_type", "value")
    stamp = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    old = bronze.trend_long([_group(events, k, 0) for k in GROUPS], ANCHOR, crawl_time=stamp)
    last = high_water_value(events.select(F.to_date("ts").alias("d")), "d")
    window = reprocess_window(last, last, days=9)
    recent = events.where(F.to_date("ts") >= F.lit(window[0]))
    groups = [_group(recent, k, 20) for k in GROUPS]
    return bronze.trend_refresh(old, groups, window, ANCHOR, KEYWORDS, crawl_time=stamp)


cte("trend_counts", """SELECT CAST(ts AS DATE) AS search_date, event_type AS keyword, count(*) AS n_all,
  count(*) FILTER (value >= 20) AS n_new FROM events GROUP BY 1, 2""")
cte("trend_table", """SELECT search_date, keyword, n_all AS search_interest FROM trend_counts
WHERE search_date < (SELECT max(search_date) - 9 FROM trend_counts)
UNION ALL SELECT search_date, keyword, n_new FROM trend_counts
WHERE search_date >= (SELECT max(search_date) - 9 FROM trend_counts) AND n_new > 0""", "trend_counts")


@query("model_trend_refresh_long", with_ctes(
    "SELECT *, 'google_trends' AS source, 'pytrends' AS source_system FROM trend_table", "trend_table"))
def model_trend_refresh_long(t):
    return refreshed(t)[0].drop("crawl_time")


@query("model_trend_refresh_wide", with_ctes("SELECT search_date, " + ", ".join(
    f"max(search_interest) FILTER (keyword = '{k}') AS \"{k}\"" for k in KEYWORDS)
    + ", (SELECT CAST(max(search_date) AS VARCHAR) FROM trend_table) AS last_date FROM trend_table GROUP BY 1",
    "trend_table"))
def model_trend_refresh_wide(t):
    _, wide, mark = refreshed(t)
    return wide.withColumn("last_date", mark.scalar())


def refreshed_by_day(t):
    """The same refresh on tables stored by day: where they lie, their schemas, and the long table's
    files before and after."""
    events = t("events").select("ts", "event_type", "value")
    stamp = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    root = f"{run_dir(t.spark)}/trend-{uuid.uuid4().hex}"
    last = high_water_value(events.select(F.to_date("ts").alias("d")), "d")
    bronze.trend_refresh_days(t.spark, root, [_group(events, k, 0) for k in GROUPS],
                              reprocess_window(None, last), ANCHOR, KEYWORDS, stamp)
    before = materialize(day_files(t.spark, f"{root}/long"), "trend-files")
    window = reprocess_window(last, last, days=9)
    groups = [_group(events.where(F.to_date("ts") >= F.lit(window[0])), k, 20) for k in GROUPS]
    long, wide = bronze.trend_refresh_days(t.spark, root, groups, window, ANCHOR, KEYWORDS, stamp)
    return root, long, wide, before, day_files(t.spark, f"{root}/long")


def day_files(spark, path):
    """Days and the names of their files."""
    return spark.read.schema("keyword string, search_date date").parquet(path).select(
        "search_date", F.col("_metadata.file_name").alias("file")).distinct()


@query("model_trend_days_long", with_ctes(
    "SELECT *, 'google_trends' AS source, 'pytrends' AS source_system FROM trend_table", "trend_table"))
def model_trend_days_long(t):
    root, long, *_ = refreshed_by_day(t)
    return read_days(t.spark, f"{root}/long", long).drop("crawl_time")


@query("model_trend_days_wide", with_ctes("SELECT search_date, " + ", ".join(
    f"max(search_interest) FILTER (keyword = '{k}') AS \"{k}\"" for k in KEYWORDS)
    + ", (SELECT CAST(max(search_date) AS VARCHAR) FROM trend_table) AS last_date FROM trend_table GROUP BY 1",
    "trend_table"))
def model_trend_days_wide(t):
    root, _, wide, *_ = refreshed_by_day(t)
    mark = load_mark(t.spark, f"{root}/mark", "last_date string")
    return read_days(t.spark, f"{root}/wide", wide).withColumn("last_date", F.lit(mark["last_date"]))


# Which days have other files after the refresh than before it: those of the window.
@query("model_trend_days_untouched", with_ctes("""
SELECT search_date, search_date >= (SELECT max(search_date) - 9 FROM trend_counts) AS written
FROM trend_counts GROUP BY 1""", "trend_counts"))
def model_trend_days_untouched(t):
    *_, before, after = refreshed_by_day(t)
    both = before.withColumn("old", F.lit(1)).unionByName(after.withColumn("old", F.lit(0)))
    return both.groupBy("search_date", "file").agg(F.count(F.lit(1)).alias("n")).groupBy("search_date").agg(
        (F.min("n") < 2).alias("written"))


NEWS_SQL = f"""
SELECT doc_id AS article_id, CAST(DATE '2020-01-01' + CAST(n_chars % 2400 AS INTEGER) AS DATE) AS publish_date,
  md5(text) AS summary_md5, source, url, s.score AS sentiment_score, s.label AS sentiment_label
FROM (SELECT *, 'https://' || lang || '/' || n_chars AS url FROM documents) d
JOIN ({SCORED_SQL}) s USING (doc_id)
QUALIFY row_number() OVER (PARTITION BY source, url ORDER BY doc_id) = 1"""


@query("model_news_bronze", NEWS_SQL)
def model_news_bronze(t):
    rows = t("documents").select(
        F.col("doc_id").cast("string").alias("article_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("n_chars") % 2400).cast("int"))
        .cast("string").alias("publish_date"),
        F.lit("t").alias("title"), F.col("text").alias("summary"),
        F.concat(F.lit("https://"), "lang", F.lit("/"), F.col("n_chars").cast("string")).alias("url"),
        "source", F.lit("api").alias("source_system"), F.lit("2024-01-01 10:00:00").alias("crawl_time"),
        F.col("doc_id").alias("_line"),
    )
    updates = bronze.news_updates(rows, ["_line"], None)
    scored = bronze.score_news(updates, word_list_scorer(POSITIVE_WORDS, NEGATIVE_WORDS))
    return scored.select(
        F.col("article_id").cast("bigint").alias("article_id"), "publish_date",
        F.md5("summary").alias("summary_md5"), "source", "url", "sentiment_score", "sentiment_label")


# Documents as listed articles, newest first by number. The stored table holds them all in an older
# state; the last known link is that of the longest document.
LINK = "'https://' || lang || '/' || n_chars"
cte("listed", f"""SELECT md5(u) AS article_id, DATE '2024-01-01' + CAST(n_chars % 300 AS INTEGER) AS publish_date,
  'new ' || source AS title, md5(text) AS summary, u AS url, doc_id
FROM (SELECT *, {LINK} AS u FROM documents)""")
cte("fresh", f"""SELECT * FROM listed WHERE doc_id < (SELECT min(doc_id) FROM listed
  WHERE url = (SELECT max_by(u, (n_chars, doc_id)) FROM (SELECT *, {LINK} AS u FROM documents)))
QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc_id) = 1""", "listed")
cte("refreshed", """SELECT article_id, publish_date, title, summary, url FROM (
  SELECT *, 0 AS age FROM fresh UNION ALL SELECT * REPLACE ('old' AS title), 1 FROM (
    SELECT * FROM listed QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc_id) = 1))
QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY age) = 1""", "listed", "fresh")


def article_refresh(t):
    url = F.concat(F.lit("https://"), "lang", F.lit("/"), F.col("n_chars").cast("string"))
    documents = t("documents").withColumn("url", url)
    listed = documents.select(
        F.md5("url").alias("article_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("n_chars") % 300).cast("int")).alias("publish_date"),
        F.concat(F.lit("new "), "source").alias("title"), F.md5("text").alias("summary"), "url", "doc_id")
    last_url = documents.agg(F.max_by("url", F.struct("n_chars", "doc_id"))).first()[0]
    old = keep_first(listed, ["url"], ["doc_id"]).withColumn("title", F.lit("old"))
    return refresh_articles(old, listed, ["doc_id"], last_url)


@query("model_article_refresh", with_ctes("SELECT * FROM refreshed", "refreshed"))
def model_article_refresh(t):
    return article_refresh(t)[0]


@query("model_article_mark", with_ctes("""
SELECT article_id AS last_article_id, url AS last_article_url, CAST(publish_date AS VARCHAR) AS last_publish_date,
  (SELECT count(*) FROM refreshed) AS total_articles FROM fresh ORDER BY doc_id LIMIT 1""", "fresh", "refreshed"))
def model_article_mark(t):
    return article_refresh(t)[1].drop("last_update")


@query("model_flight_bronze", """
SELECT CAST(ts AS DATE) AS flight_date, count(*) FILTER (event_type IN ('click', 'view')) AS domestic_flights,
  count(*) FILTER (event_type NOT IN ('click', 'view')) AS international_flights, count(*) AS total_flights,
  'Flightradar24' AS data_source FROM events WHERE event_type <> 'error' GROUP BY 1""")
def model_flight_bronze(t):
    kind = F.col("event_type")
    origin = F.when(kind == "click", "HAN").when(kind == "view", "SGN").otherwise("SIN")
    heading = F.when(kind == "error", "no heading").otherwise(F.date_format("ts", "EEEE, MMM d"))
    arrivals = t("events").select(heading.alias("heading"), origin.alias("origin"), F.year("ts").alias("y"))
    return bronze.flight_bronze(arrivals, "heading", "origin", F.col("y"))


# The stored table ends ten days before the run; its odd days have another reading.
@query("model_weather_bronze", """
WITH d AS (SELECT CAST(ts AS DATE) AS date, CAST(count(*) AS DOUBLE) AS temp_mean, max(value) AS temp_max,
    min(value) AS temp_min, CAST(count(*) FILTER (event_type = 'error') AS DOUBLE) AS rainfall_mm,
    CAST(max(user_id) AS DOUBLE) AS wind_speed_max FROM events GROUP BY 1),
run AS (SELECT max(date) AS today FROM d)
SELECT d.*, 'archive_api' AS source FROM d, run
WHERE date <= today - 3 AND (date > today - 10 OR day(date) % 2 = 1)
UNION ALL
SELECT date, temp_mean + 1, temp_max, temp_min, rainfall_mm, wind_speed_max, 'live_forecast_api' FROM d, run
WHERE date > today - 3""")
def model_weather_bronze(t):
    def responses(shift):
        """One response per week of readings, its arrays as long as the week has days."""
        days = t("events").groupBy(F.to_date("ts").alias("d")).agg(
            (F.count(F.lit(1)) + shift).cast("double").alias("n"), F.max("value").alias("hi"),
            F.min("value").alias("lo"), F.count_if(F.col("event_type") == "error").cast("double").alias("e"),
            F.max("user_id").cast("double").alias("u"))
        names = {"d": "time", "n": "temperature_2m_mean", "hi": "temperature_2m_max",
                 "lo": "temperature_2m_min", "e": "precipitation_sum", "u": "wind_speed_10m_max"}
        weeks = days.groupBy(F.date_trunc("week", "d")).agg(
            F.sort_array(F.collect_list(F.struct(*names))).alias("days"))
        daily = F.struct(*[
            F.col(f"days.{c}").cast("array<string>" if c == "d" else "array<double>").alias(n)
            for c, n in names.items()])
        return weeks.select(F.to_json(F.struct(daily.alias("daily"))).alias("body"))

    today = high_water(t("events").select(F.to_date("ts").alias("d")), "d")
    archive = responses(0)
    odd = (F.dayofmonth("date") % 2).cast("double")
    stored = bronze.weather_days(archive, "body", "archive_api").where(
        F.col("date") <= F.date_sub(today, 10)).withColumn("temp_mean", F.col("temp_mean") + odd)
    return bronze.weather_bronze(archive, responses(1), today, loaded=stored)
