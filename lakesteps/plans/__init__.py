"""Composite models built from the operators."""

from lakesteps.plans.articles import (  # noqa: F401
    epoch_listing, fresh_articles, iso_listing, json_listing, refresh_articles,
)
from lakesteps.plans.bronze import (  # noqa: F401
    flight_bronze, news_bronze, trend_refresh, weather_bronze,
)
from lakesteps.plans.build import build_gold, build_silver, check_silver  # noqa: F401
from lakesteps.plans.gold import (  # noqa: F401
    calendar_dim, dim_event, dim_location, dim_news, dim_sentiment, fact_monthly, fact_news,
    health_index_a, health_index_b, monthly_mart, scenario_table,
)
from lakesteps.plans.silver import (  # noqa: F401
    silver_events, silver_flight, silver_news, silver_statistics, silver_trend, silver_weather,
)
