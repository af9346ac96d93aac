"""Joins: trades to prices by hour key, and the id anti-join of the idempotent load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A broadcast side is at most this many rows.  Every side passed here is narrow (an
# int slot, a token symbol, a double and a count: about 48 bytes as an UnsafeRow,
# about 100 bytes with its key in the executor's hash relation), so the bound keeps
# a broadcast near 100 MB per executor at worst; real price sides are far smaller.
BROADCAST_MAX_ROWS = 1_000_000


def within_bound(side: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, bound_by: DataFrame | None = None) -> bool:
    """Whether ``side`` is proven to hold ``<= max_rows`` rows.

    The bound is measured (an exact, distributed row count: partial counts per task and a
    one-row merge; a ``limit`` would funnel rows through one task), not estimated.
    ``bound_by`` may name a frame with at least as many rows as ``side`` (the input of its
    pre-aggregation): counting it needs no shuffle, and only when it exceeds the bound is
    ``side`` itself counted.
    """
    return max_rows > 0 and any(p.count() <= max_rows for p in ([bound_by] if bound_by is not None else []) + [side])


def checked_broadcast(side: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                      bound_by: DataFrame | None = None) -> DataFrame:
    """Mark ``side`` for broadcast only if it is ``within_bound``.

    Beyond the bound the side carries a sort-merge hint, so neither the planner's size estimate
    nor a run-time re-plan can broadcast it; both sides are shuffled on the join keys and AQE
    splits skewed key partitions.  The count runs when the plan is built, so build the plan
    right before running it.
    """
    return F.broadcast(side) if within_bound(side, max_rows, bound_by) else side.hint("merge")


def trade_price_left_join(keyed: DataFrame, price_counts: DataFrame,
                          broadcast_max_rows: int = BROADCAST_MAX_ROWS,
                          bound_by: DataFrame | None = None) -> DataFrame:
    """Trades left-joined to the price rows of their hour key.

    ``price_counts`` holds one row per (slot, token) with the number ``n`` of price
    rows, so the join emits one row per trade and matched token instead of one per
    price row; counts over the joined rows are sums of ``n``.
    """
    side = checked_broadcast(price_counts, broadcast_max_rows, bound_by)
    return keyed.join(side, ["slot"], "left")


def anti_join_ids(batch: DataFrame, existing_ids: DataFrame) -> DataFrame:
    """Rows of ``batch`` whose ``id`` is not among ``existing_ids``.

    No side is hinted: the stored ids are measured when they are read, and AQE broadcasts them
    only if they turn out small; the MD5 ids spread evenly over the shuffle partitions.
    """
    return batch.join(existing_ids.select("id"), "id", "left_anti")
