"""Column expressions."""

from lakesteps.functions.dates import (  # noqa: F401
    day_name, duration_days, epoch_to_date, heading_to_date, is_weekend, iso_to_date, month_start,
    parse_date_strict, parse_or_null, parse_partial_date, week_sunday, year_month,
)
from lakesteps.functions.numbers import (  # noqa: F401
    band, count_where, default, fallback_mean, first_match, mean_of, share, to_long, total,
    weighted_index,
)
from lakesteps.functions.text import (  # noqa: F401
    absolute_url, class_by_membership, clean_text, contains_any, first_non_empty, joined_key,
    normal, prefix, surrogate_key, trim_ws,
)
