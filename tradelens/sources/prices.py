"""Market prices: load windows over the staging table and price-history documents.

A price-history document holds three parallel arrays ``prices``, ``market_caps``
and ``total_volumes`` of ``[unix_ms, value]`` pairs.  Landed documents live under
``<root>/coin=<coin id>/`` so the coin comes from the path (partition discovery).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import element, unix_ms_to_text
from ..schemas import PRICE_DOC, PRICE_DOC_DDL

PRICE_ROW_COLUMNS = ["date_time", "prices", "market_cap", "total_volume"]


def _day(d) -> dt.date:
    return dt.date.fromisoformat(d) if isinstance(d, str) else d


def price_window(prices: DataFrame, coin, lo: str, hi: str) -> DataFrame:
    """Prices of a coin, or of a list of coins (one scan), with ``lo <= date_time <= hi``
    (UTC text, so text order = time order)."""
    coins = [coin] if isinstance(coin, str) else list(coin)
    return prices.where(F.col("coin").isin(coins) & F.col("date_time").between(lo, hi))


def init_price_window(prices: DataFrame, coin: str, as_of, start=None) -> DataFrame:
    """Initial load: ``[start 00:00:00, as_of - 1 day 23:59:59]``; start defaults to the 1st of the month."""
    d = _day(as_of)
    s = _day(start) if start is not None else d.replace(day=1)
    y = d - dt.timedelta(days=1)
    return price_window(prices, coin, f"{s.isoformat()} 00:00:00", f"{y.isoformat()} 23:59:59")


def update_price_window(prices: DataFrame, coin: str, target_date) -> DataFrame:
    """Daily load: one day ``[d 00:00:00, d 23:59:59]``."""
    d = _day(target_date).isoformat()
    return price_window(prices, coin, f"{d} 00:00:00", f"{d} 23:59:59")


def price_windows(prices: DataFrame, coins, as_of, target_date, start=None) -> DataFrame:
    """The rows of ``init_price_window`` and ``update_price_window`` of several coins from one scan,
    with ``load`` (``init`` or ``update``); a row of both windows comes twice."""
    d, day = _day(as_of), _day(target_date).isoformat()
    first = (_day(start) if start is not None else d.replace(day=1)).isoformat()
    spans = {"init": (f"{first} 00:00:00", f"{(d - dt.timedelta(days=1)).isoformat()} 23:59:59"),
             "update": (f"{day} 00:00:00", f"{day} 23:59:59")}
    rows = price_window(prices, coins, min(lo for lo, _ in spans.values()), max(hi for _, hi in spans.values()))
    inside = F.array(*[F.when(F.col("date_time").between(lo, hi), F.lit(load)) for load, (lo, hi) in spans.items()])
    return rows.select(*prices.columns, F.explode(F.filter(inside, lambda x: x.isNotNull())).alias("load"))


# A built document holds at most this many points (an API page).
MAX_DOC_POINTS = 512


def price_docs_from_prices(points: DataFrame, ms_col: str = "ms",
                           max_points: int = MAX_DOC_POINTS) -> DataFrame:
    """Build price-history documents as JSON text: (coin, doc_hour, chunk, doc).

    ``points`` has ``coin``, ``ms_col``, ``prices``, ``market_cap``, ``total_volume``.  The
    points that an input partition holds of a (coin, UTC hour) are numbered and cut into
    documents of at most ``max_points``, equal points included; so neither a document nor a
    task grows with a hot coin-hour.  ``chunk`` tells a coin-hour's documents apart.
    """
    pts = points.select(
        "coin", F.col(ms_col).cast("double").alias("ms"), "prices", "market_cap", "total_volume",
        F.floor(F.col(ms_col) / 3_600_000).cast("long").alias("doc_hour"),
        F.spark_partition_id().cast("long").alias("part"), F.monotonically_increasing_id().alias("n"))
    group = ["part", "coin", "doc_hour"]
    place = F.row_number().over(Window.partitionBy(*group).orderBy("n")) - 1
    grouped = (pts.withColumn("cut", F.floor(place / max_points).cast("long")).groupBy(*group, "cut")
               .agg(F.sort_array(F.collect_list(F.struct("ms", "prices", "market_cap", "total_volume")))
                    .alias("pts"))
               .withColumn("chunk", F.col("part") * (1 << 32) + F.col("cut")))

    def series(field):
        return F.transform("pts", lambda p: F.array(p["ms"], p[field]))

    doc = F.struct(series("prices").alias("prices"), series("market_cap").alias("market_caps"),
                   series("total_volume").alias("total_volumes"))
    return grouped.select("coin", "doc_hour", "chunk", F.to_json(doc).alias("doc"))


def explode_price_docs(parsed: DataFrame, keep: tuple[str, ...] = ("coin",)) -> DataFrame:
    """Parsed documents -> one row per point, by position.

    Documents without ``prices`` give no rows.  The timestamp comes from ``prices``
    only; arrays of unequal length raise an error (``arrays_zip`` would pad with NULL).
    """
    keep = [c for c in keep if c in parsed.columns]
    p, m, v = F.col("prices"), F.col("market_caps"), F.col("total_volumes")
    same_len = (F.size(p) == F.size(m)) & (F.size(p) == F.size(v))
    zipped = F.when(same_len, F.arrays_zip(p.alias("p"), m.alias("m"), v.alias("v"))).otherwise(
        F.raise_error(F.lit("price document arrays differ in length")))
    rows = parsed.where(p.isNotNull()).select(*keep, F.inline(zipped))
    return rows.select(
        *keep,
        unix_ms_to_text(element("p", 0).cast("long")).alias("date_time"),
        element("p", 1).alias("prices"),
        element("m", 1).alias("market_cap"),
        element("v", 1).alias("total_volume"),
    )


def parse_price_docs(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """JSON text column -> the three arrays (other columns kept)."""
    others = [c for c in docs.columns if c != doc_col]
    return docs.select(*others, F.from_json(F.col(doc_col), PRICE_DOC).alias("_d")).select(*others, "_d.*")


# Fixed value: the coin id at the start of a landed file name, before '_' or '.'.
COIN_FILE_PATTERN = r"^([^_.]+)"


def read_price_docs(spark: SparkSession, path: str, multi_line: bool = False,
                    coin_from: str = "folder", file_pattern: str = COIN_FILE_PATTERN) -> DataFrame:
    """Landed documents -> one row per point with ``coin``.

    ``coin_from='folder'``: files under ``path/coin=<id>/`` (partition discovery).
    ``coin_from='file_name'``: files named ``<id>_<anything>.json`` directly under
    ``path``; the coin is read from the file's metadata with ``file_pattern``.
    ``multi_line=True`` reads one (pretty-printed) document per file, as returned by
    the price API; otherwise one document per line.
    """
    if coin_from not in ("folder", "file_name"):
        raise ValueError("coin_from must be 'folder' or 'file_name'")
    ddl = PRICE_DOC_DDL + (", coin string" if coin_from == "folder" else "")
    raw = spark.read.schema(ddl).option("multiLine", str(multi_line).lower()).json(path)
    if coin_from == "file_name":
        raw = raw.withColumn("coin", F.regexp_extract(F.col("_metadata.file_name"), file_pattern, 1))
    return explode_price_docs(raw).select("coin", *PRICE_ROW_COLUMNS)


# --------------------------------------------------------------------------- documents that do not load

NOT_JSON, NO_PRICES, UNEQUAL, NO_TIME = "not a JSON document", "no prices", "arrays differ in length", "a point without time"
_ARRAYS = ["prices", "market_caps", "total_volumes"]


def landed_docs(spark: SparkSession, path: str, multi_line: bool = False, coin_from: str = "folder",
                file_pattern: str = COIN_FILE_PATTERN, stream_options: dict | None = None) -> DataFrame:
    """Landed documents as text: ``(coin, file, doc)``, without blank ones.

    The options are those of ``read_price_docs``; with ``stream_options`` (may be empty) it is a
    streaming read."""
    if coin_from not in ("folder", "file_name"):
        raise ValueError("coin_from must be 'folder' or 'file_name'")
    reader = spark.read if stream_options is None else spark.readStream.options(**stream_options)
    ddl = "value string" + (", coin string" if coin_from == "folder" else "")
    raw = reader.schema(ddl).option("wholetext", str(multi_line).lower()).format("text").load(path)
    coin = F.col("coin") if coin_from == "folder" else F.regexp_extract(F.col("_metadata.file_name"), file_pattern, 1)
    return raw.where(F.trim(F.regexp_replace("value", r"[\r\n\t]", " ")) != "").select(
        coin.alias("coin"), F.col("_metadata.file_path").alias("file"), F.col("value").alias("doc"))


def checked_price_docs(docs: DataFrame) -> DataFrame:
    """``docs`` (``coin, file, doc``) with the three arrays and ``reason``: why the document does
    not load, null if it does.

    A document loads whole or not at all: it must be a JSON object whose ``prices`` is an array
    of points with times and whose other two arrays are as long."""
    schema = T.StructType([*PRICE_DOC.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json("doc", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = docs.select("coin", "file", "doc", parsed.alias("d")).select("coin", "file", "doc", "d.*")
    size = [F.coalesce(F.size(c), F.lit(-1)) for c in _ARRAYS]
    timed = F.forall("prices", lambda p: p.isNotNull() & F.get(p, F.lit(0)).isNotNull())
    reason = (F.when(F.col("_corrupt").isNotNull(), NOT_JSON)
              .when(F.col("prices").isNull(), NO_PRICES)
              .when((size[0] != size[1]) | (size[0] != size[2]), UNEQUAL)
              .when(~timed, NO_TIME))
    return rows.select("coin", "file", "doc", *_ARRAYS, reason.alias("reason"))


def loadable_prices(checked: DataFrame) -> DataFrame:
    """The points of the documents that load: ``coin`` and the price columns."""
    return explode_price_docs(checked.where("reason is null").select("coin", *_ARRAYS)).select("coin", *PRICE_ROW_COLUMNS)


def rejected_docs(checked: DataFrame) -> DataFrame:
    """``(coin, file, reason, doc)`` of the others."""
    return checked.where("reason is not null").select("coin", "file", "reason", "doc")
