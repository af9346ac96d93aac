"""Rows of a (slot, token) in blocks, so that a joined row stands for many pairs.

Joining a leg to a price costs far more than their gap: the row is looked up, copied and grouped.
``in_blocks`` puts up to ``BLOCK`` rows of either side beside each other as columns, and
``gap_sum`` forms every pair of two blocks in one expression.  No pair is left out or
estimated; only the number of joined rows falls, by ``BLOCK * BLOCK``.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import gap_of_ratio, price_ratio

# Rows of a block.  All pairs of two blocks are one generated method; beyond about 8,000 bytes the
# JVM no longer compiles it (a trial of 8,686 bytes took 113 s for 1.7 s).
BLOCK = 4

# Pieces a (slot, token) is cut into by value: its blocks are built, and joined beyond the
# broadcast bound, by as many tasks.
SALTS = 32


def in_blocks(rows: DataFrame, value: str, count: str, **sums: Column) -> DataFrame:
    """``(slot, token, value, count)`` -> ``(slot, token, salt, count, value_0.., count_0.., *sums)``.

    ``count`` is the rows behind the block's values, missing values left out; an idle place holds
    the block's smallest value and the count 0, in a block without values NaN.  ``sums`` are
    aggregates over all rows of the block.
    """
    keys = ["slot", "token", "salt"]
    rows = rows.withColumn("salt", F.pmod(F.xxhash64(value), F.lit(SALTS)))
    rows = rows.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy(value)) - 1)
    known = F.when(F.col(value).isNotNull(), F.col(count))
    here = [F.col("_at") % BLOCK == i for i in range(BLOCK)]
    blocks = rows.groupBy(*keys, F.floor(F.col("_at") / BLOCK).alias("_block")).agg(
        F.min(value).alias("_least"), F.sum(known).alias(count), *[s.alias(name) for name, s in sums.items()],
        *[F.max(F.when(h, F.col(value))).alias(f"{value}_{i}") for i, h in enumerate(here)],
        *[F.max(F.when(h, known)).alias(f"{count}_{i}") for i, h in enumerate(here)])
    return blocks.select(
        *keys, F.coalesce(count, F.lit(0).cast("long")).alias(count), *sums,
        *[F.coalesce(f"{value}_{i}", "_least", F.lit(float("nan"))).alias(f"{value}_{i}") for i in range(BLOCK)],
        *[F.coalesce(F.col(f"{count}_{i}").cast("double"), F.lit(0.0)).alias(f"{count}_{i}") for i in range(BLOCK)])


def gap_sum(gap: str = "quarter", on_zero: str = "raise") -> Column:
    """The sum of the gaps of all pairs of joined blocks of legs (``trade_price``, ``m``) and prices
    (``external_price``, ``n``); NULL where no pair has one.

    Meant for an aggregate: there it is a method of its own, in a projection it would be part of
    the join's loop, which the JVM may take long to compile."""
    def ratio(k: int, i: int) -> Column:
        real = F.col(f"m_{k}") * F.col(f"n_{i}") > 0
        return price_ratio(f"trade_price_{k}", f"external_price_{i}", on_zero, real) * F.col(f"n_{i}")

    ratios = _total([_total([ratio(k, i) for i in range(BLOCK)]) * F.col(f"m_{k}") for k in range(BLOCK)])
    return F.when(_some(), gap_of_ratio(ratios, gap))


def pair_count(on_zero: str = "raise") -> Column:
    """The number of pairs that ``gap_sum`` adds up; NULL where no pair has a gap."""
    pairs = F.col("m") * F.col("n")
    if on_zero == "null":
        zero = [F.when(F.col(f"trade_price_{k}") + F.col(f"external_price_{i}") == 0, F.col(f"m_{k}") * F.col(f"n_{i}")).otherwise(
            F.lit(0.0)) for k in range(BLOCK) for i in range(BLOCK)]
        pairs = F.nullif(pairs - _total(zero).cast("long"), F.lit(0).cast("long"))
    return F.when(_some(), pairs)


def _some() -> Column:
    return (F.col("m") > 0) & (F.col("n") > 0)


def _total(terms: list[Column]) -> Column:
    return functools.reduce(operator.add, terms)
