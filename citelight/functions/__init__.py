"""Scalar and aggregate column functions."""

from .arithmetic import mean, rescale_percent, rescale_sentiment, round_to, safe_divide, total
from .calendar import (
    firestore_timestamp,
    iso_week,
    parse_timestamp,
    snapshot_day,
    sunday_week,
    text_day,
    week_monday,
)
from .text import (
    ascii_key,
    business_key,
    engine_provider,
    first_or_blank,
    json_text_array,
    parse_tags,
    row_uuid,
    run_id,
    url_domain,
)

__all__ = [
    "ascii_key", "business_key", "engine_provider", "firestore_timestamp", "first_or_blank",
    "iso_week", "json_text_array", "mean", "parse_tags", "parse_timestamp", "rescale_percent",
    "rescale_sentiment", "round_to", "row_uuid", "run_id", "safe_divide", "snapshot_day",
    "sunday_week", "text_day", "total", "url_domain", "week_monday",
]
