"""End-to-end results: the daily price gap in its two plans, left-join counts, leg summaries."""

from .price_gap import left_join_counts, leg_summary, price_gap_daily  # noqa: F401
