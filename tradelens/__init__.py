"""tradelens: token-swap trade analytics on Spark DataFrames.

Staging loads with content-hash row ids (idempotent), an hourly join of trades to
market prices, the daily price-gap and trade-summary results, and the dashboard
aggregates, all expressed with Spark DataFrame / SQL primitives.
"""

__all__ = ["session", "schemas"]
