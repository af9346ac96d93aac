"""Relational operators of the price-gap and summary results."""

from .joins import anti_join_ids, checked_broadcast, trade_price_left_join, within_bound  # noqa: F401
from .legs import (keyed_prices, leg_price_pairs, legs_union_all, legs_with_price_sums, mapped_prices,  # noqa: F401
                   price_sums, side_legs, trade_legs, weighted_pairs, weighted_prices)
from .aggregates import (daily_trade_summary, headline_totals, headline_totals_of_trades, series_for_token,  # noqa: F401
                         token_list, token_series)
