"""Scalar Column helpers.  All are built-in Spark expressions (codegen, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "COIN_TOKENS", "HOUR_KEY_FORMATS", "as_col", "to_ts", "hour_key", "hour_slot",
    "slot_day", "hour_text_from_slot", "day_key", "coin_to_token",
    "price_gap", "price_ratio", "gap_of_ratio", "market_value", "month_start", "days_before", "month_start_text",
    "to_unix_seconds", "unix_ms_to_text", "round_half_even", "row_json", "element",
    "text_to_date", "wall_clock_seconds", "wall_clock_millis", "text_from_epoch_seconds",
]

# Coin id of the price source -> token symbol of the trades.
# Any other coin maps to NULL and so never matches a trade leg.
COIN_TOKENS = {
    "ethereum": "WETH",
    "usd-coin": "USDC",
}

# Hour-key text formats.  '12h' reproduces the source view, whose
# hour field is 01-12, so 03:xx and 15:xx share one key; '24h' is the corrected key.
HOUR_KEY_FORMATS = {
    "12h": "yyyy-MM-dd hh:00",
    "24h": "yyyy-MM-dd HH:00",
}


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ts(c) -> Column:
    """Text or timestamp -> TIMESTAMP_NTZ.  A zone suffix in the text is dropped."""
    return as_col(c).cast("timestamp_ntz")


def hour_key(ts, mode: str = "12h") -> Column:
    """Hour-key text of a timestamp: ``HOUR_KEY_FORMATS[mode]`` applied to its local time.

    Built from the wall-clock fields (``hour_slot``), not with ``date_format``, which
    would pass the value through the session time zone and shift local times that a
    daylight-saving change skips.
    """
    return hour_text_from_slot(hour_slot(ts, mode), mode)


def _slots_per_day(mode: str) -> int:
    if mode not in HOUR_KEY_FORMATS:
        raise ValueError(f"hour key mode must be one of {sorted(HOUR_KEY_FORMATS)}")
    return 12 if mode == "12h" else 24


def hour_slot(ts, mode: str = "12h") -> Column:
    """Integer form of ``hour_key``: equal slots <=> equal key texts.

    ``day * 12 + hour % 12`` for '12h', ``day * 24 + hour`` for '24h', where day is
    days since 1970-01-01.  Joining on an int is cheaper than on formatted text.
    """
    n = _slots_per_day(mode)
    t = to_ts(ts)
    return F.unix_date(F.to_date(t)) * n + F.hour(t) % n


def slot_day(slot, mode: str = "12h") -> Column:
    """Days since epoch of an hour slot."""
    return F.floor(as_col(slot) / _slots_per_day(mode)).cast("int")


def hour_text_from_slot(slot, mode: str = "12h") -> Column:
    """Hour-key text of a slot, identical to ``hour_key`` of any timestamp in it."""
    n = _slots_per_day(mode)
    s = as_col(slot)
    day = F.date_from_unix_date(slot_day(s, mode)).cast("string")
    h = s - slot_day(s, mode) * n
    hh = F.when(h == 0, F.lit(12)).otherwise(h) if n == 12 else h
    return F.concat(day, F.lit(" "), F.lpad(hh.cast("string"), 2, "0"), F.lit(":00"))


def day_key(ts) -> Column:
    """Day-key text ``yyyy-MM-dd`` of a text or timestamp value (its wall-clock date)."""
    return F.to_date(to_ts(ts)).cast("string")


def coin_to_token(coin, mapping: dict | None = None) -> Column:
    """Coin id -> token symbol; unknown coins give NULL."""
    mapping = COIN_TOKENS if mapping is None else mapping
    c = as_col(coin)
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out if out is not None else F.lit(None).cast("string")


def price_gap(trade_price, external_price, mode: str = "quarter", on_zero: str = "raise") -> Column:
    """Gap between a trade price and the market price, in percent.

    'quarter' is the source formula ``((p - e) / (p + e) / 2) * 100``;
    'symmetric_pct' is ``(p - e) / ((p + e) / 2) * 100``.  A zero ``p + e`` raises,
    whatever the session's ANSI mode; ``on_zero='null'`` gives NULL instead, and
    AVG then skips the pair; ``on_zero='ieee'`` divides as floats do (0 / 0 is NaN,
    anything else over 0 an infinity), and the pair's average is no number.
    """
    p, e = as_col(trade_price), as_col(external_price)
    if on_zero not in ("raise", "null", "ieee"):
        raise ValueError("on_zero must be 'raise', 'null' or 'ieee'")
    if mode not in ("quarter", "symmetric_pct"):
        raise ValueError("gap mode must be 'quarter' or 'symmetric_pct'")
    total = p + e
    zero = total == 0
    if on_zero != "raise":
        total = F.nullif(total, F.lit(0.0))
    else:
        total = F.when(total == 0, F.raise_error(F.lit("trade price and market price sum to zero")).cast("double")).otherwise(total)
    gap = ((p - e) / total / 2) * 100 if mode == "quarter" else (p - e) / (total / 2) * 100
    return F.when(zero, (p - e) * F.lit(float("inf"))).otherwise(gap) if on_zero == "ieee" else gap


def price_ratio(p, e, on_zero: str, real: Column) -> Column:
    """``(p - e) / (p + e)`` of two numbers that are not missing; ``gap_of_ratio`` makes it the gap.

    Where ``p + e`` is zero it is as ``on_zero`` says of ``price_gap``, but 0 for 'null' and for a
    pair that is not ``real``.  Kept short: many of them share one generated method."""
    p, e = as_col(p), as_col(e)
    at_zero = {"raise": F.raise_error(F.lit("trade price and market price sum to zero")).cast("double"),
               "null": F.lit(0.0), "ieee": (p - e) * F.lit(float("inf"))}
    if on_zero not in at_zero:
        raise ValueError("on_zero must be 'raise', 'null' or 'ieee'")
    return F.coalesce(F.try_divide(p - e, p + e), F.when(real, at_zero[on_zero]).otherwise(F.lit(0.0)))


def gap_of_ratio(ratio, mode: str = "quarter") -> Column:
    """The gap of a ``price_ratio`` (or the sum of the gaps of a sum of them)."""
    if mode not in ("quarter", "symmetric_pct"):
        raise ValueError("gap mode must be 'quarter' or 'symmetric_pct'")
    return as_col(ratio) / 2 * 100 if mode == "quarter" else as_col(ratio) * 2 * 100


def market_value(units, external_price) -> Column:
    return as_col(units) * as_col(external_price)


def month_start(d) -> Column:
    return F.trunc(as_col(d).cast("date"), "month")


def days_before(d, n: int = 1) -> Column:
    return F.date_sub(as_col(d).cast("date"), n)


def month_start_text(d) -> Column:
    return month_start(d).cast("string")


def wall_clock_seconds(ts) -> Column:
    """Whole seconds since 1970-01-01 00:00:00 of a TIMESTAMP_NTZ, read as UTC.

    Built from the wall-clock fields: ``timestamp_diff`` on NTZ values would pass
    through the session time zone.
    """
    t = to_ts(ts)
    return ((F.unix_date(F.to_date(t)).cast("long") * 24 + F.hour(t)) * 60 + F.minute(t)) * 60 + F.second(t)


def wall_clock_millis(ts) -> Column:
    """Milliseconds since the epoch of a TIMESTAMP_NTZ read as UTC (sub-milliseconds dropped)."""
    t = to_ts(ts)
    whole_minutes = (F.unix_date(F.to_date(t)).cast("long") * 24 + F.hour(t)) * 60 + F.minute(t)
    return whole_minutes * 60000 + F.floor(F.extract(F.lit("SECOND"), t) * 1000).cast("long")


def text_from_epoch_seconds(secs) -> Column:
    """UTC text ``'yyyy-MM-dd HH:mm:ss'`` of whole epoch seconds, zone-free."""
    s = as_col(secs).cast("long")
    day = F.floor(s / 86400)
    sod = s - day * 86400

    def two(c):
        return F.lpad(c.cast("string"), 2, "0")
    return F.concat(F.date_from_unix_date(day.cast("int")).cast("string"), F.lit(" "),
                    two(F.floor(sod / 3600)), F.lit(":"), two(F.floor((sod % 3600) / 60)), F.lit(":"),
                    two(sod % 60))


def to_unix_seconds(text) -> Column:
    """``'yyyy-MM-dd HH:mm:ss'`` read as UTC -> unix seconds (independent of session zone)."""
    return wall_clock_seconds(F.to_timestamp_ntz(as_col(text), F.lit("yyyy-MM-dd HH:mm:ss")))


def unix_ms_to_text(ms) -> Column:
    """Unix milliseconds -> UTC text ``'yyyy-MM-dd HH:mm:ss'``, sub-seconds dropped."""
    return text_from_epoch_seconds(F.floor(as_col(ms) / 1000))


def round_half_even(x) -> Column:
    """Round to an integer, ties to even (2.5 -> 2, 3.5 -> 4)."""
    return F.bround(as_col(x), 0).cast("long")


def row_json(*cols) -> Column:
    return F.to_json(F.struct(*[as_col(c) for c in cols]))


def element(arr, i: int) -> Column:
    return as_col(arr)[i]


def text_to_date(text) -> Column:
    return F.to_date(as_col(text))
