"""Structured Streaming jobs."""

from lakesteps.streaming.ledgers import (  # noqa: F401
    count_days, first_seen, read_corrected_days, read_first_seen, read_late, stream_corrected_days,
    stream_first_seen,
)
from lakesteps.streaming.jobs import (  # noqa: F401
    latest_per_batch, merge_batch, read_stream, stream_append, stream_daily_counts, stream_dedup, stream_merge,
    with_event_time, write_stream,
)
