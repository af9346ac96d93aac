"""

Every query reads the driver's tables through the fixture mapping of FIXTURES.md
(``events`` -> trades and coin prices) and runs over the whole tables.  Floating
results are rounded to 6 decimals in both engines, because sums in a different
order differ in the last bits; the inputs have at most 4 decimals, so sums sit on
a 4-decimal grid and 6-decimal rounding never meets a tie.  Sums too large for
that (``legs_union_all``) are exact decimal sums, rounded once at the end.

Every query sets the recommended session time zone (UTC).  The library's keys and
unix conversions read wall-clock fields and do not depend on it (tested under a
daylight-saving zone).
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import importlib.util
import json
import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelens import session as _session
from tradelens.functions import scalars as S
from tradelens.functions.identity import with_row_id
from tradelens.operators import aggregates as AG
from tradelens.operators import legs as LG
from tradelens.plans import incremental as IN
from tradelens.plans import price_gap as PG
from tradelens.sources import day_documents as DD
from tradelens.sources import fixtures as FX
from tradelens.sources import prices as PR
from tradelens.sources import trades as TR
from tradelens import jobs as JB
from tradelens.sinks import drift as DR
from tradelens.sinks import ledger as LDG
from tradelens.sinks import load as LD
from tradelens.sinks import tables as TB
from tradelens.sinks import views as VW
from tradelens.streaming import price_stream as ST

SMOKE_DIR = "/root/testdata/sf0.001"
AS_OF = "2024-01-15"  # fixed `as_of` of the load windows (FIXTURES.md §3)
# Prices of zero occur: the gaps of such a pair divide as floats do, in both engines.
ON_ZERO = "ieee"


# --------------------------------------------------------------------------- helpers

def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    _session.apply_recommended(spark)
    return FX.load_events(spark, sf_dir)


def _tables(spark: SparkSession, sf_dir: str):
    events = _events(spark, sf_dir)
    return FX.trades_from_events(events), FX.coin_prices_from_events(events)


def _r(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


def _gap(mode="12h", gap="quarter", plan="single_join"):
    def run(spark, sf_dir):
        trades, prices = _tables(spark, sf_dir)
        out = PG.price_gap_daily(trades, prices, mode=mode, gap=gap, plan=plan, on_zero=ON_ZERO)
        return _r(out, {"avg_price_difference": 6})
    return run


# --------------------------------------------------------------------------- queries

def q_trade_price_left_join(spark, sf_dir):
    trades, prices = _tables(spark, sf_dir)
    return PG.left_join_counts(trades, prices)


def _legs_query(side):
    """One side's legs with their prices, per (hour key, token), from weighted pairs of counted legs."""
    def run(spark, sf_dir):
        trades, prices = _tables(spark, sf_dir)
        pairs = LG.weighted_pairs(LG.counted_legs(LG.side_legs(trades, side)), prices, on_zero=ON_ZERO)
        out = PG.leg_summary(pairs, weight="n", legs="m")
        return _r(out, {"sum_amount": 6, "avg_trade_price": 6, "avg_price_difference": 6,
                        "sum_external_value_usd": 6, "sum_usd_trade_value": 6})
    return run


def q_legs_union_all(spark, sf_dir):
    """Counts and value sums per token of ``sell legs UNION ALL buy legs`` with their prices.

    All four are linear in the market price, so each leg meets the count and sum of
    its hour's prices (one row per leg, no pairs).
    """
    trades, prices = _tables(spark, sf_dir)
    legs = LG.legs_with_price_sums(LG.legs_union_all(trades), prices)
    n = F.col("n")
    return legs.groupBy("token").agg(
        F.sum(n).alias("n_rows"),
        _decimal_sum(F.col("amount") * n).alias("sum_amount"),
        _decimal_sum(F.col("amount") * F.col("sum_price")).alias("sum_external_value_usd"),
        _decimal_sum(F.col("usd_trade_value") * n).alias("sum_usd_trade_value"))


def _decimal_sum(c):
    return F.round(F.sum(c.cast("decimal(28,10)")), 4).cast("double")


def q_trade_summary_daily(spark, sf_dir):
    trades, _ = _tables(spark, sf_dir)
    out = AG.daily_trade_summary(trades)
    return _r(out, {"total_usd_value_bought": 6, "total_usd_value_sold": 6, "total_units_sold": 6,
                    "total_units_bought": 6, "avg_buy_price": 6, "avg_sell_price": 6})


def q_headline_totals(spark, sf_dir):
    trades, _ = _tables(spark, sf_dir)
    return AG.headline_totals_of_trades(trades)


def _gap_table(spark, sf_dir):
    trades, prices = _tables(spark, sf_dir)
    return PG.price_gap_daily(trades, prices, on_zero=ON_ZERO)


def q_token_list(spark, sf_dir):
    return AG.tokens_with_prices(*_tables(spark, sf_dir))


def q_token_series(spark, sf_dir):
    return _r(AG.token_series(_gap_table(spark, sf_dir)), {"avg_price_difference": 6})


def q_price_gap_one_token(spark, sf_dir):
    gap = PG.price_gap_of_token(*_tables(spark, sf_dir), "WETH", on_zero=ON_ZERO)
    return _r(AG.series_for_token(gap, "WETH"), {"avg_price_difference": 6})


def q_trades_month_to_date(spark, sf_dir):
    trades, _ = _tables(spark, sf_dir)
    return TR.trades_month_to_date(trades, AS_OF)


def q_trades_prev_day(spark, sf_dir):
    trades, _ = _tables(spark, sf_dir)
    return TR.trades_prev_day(trades, AS_OF)


def q_price_window(spark, sf_dir):
    _, prices = _tables(spark, sf_dir)
    d = _dt.date.fromisoformat(AS_OF) - _dt.timedelta(days=1)
    return PR.price_windows(prices, JB.DEFAULT_COINS, AS_OF, d)


def q_hour_keys(spark, sf_dir):
    events = _events(spark, sf_dir)
    return events.groupBy(S.hour_key("ts", "12h").alias("hour_key_12h"),
                          S.hour_key("ts", "24h").alias("hour_key_24h")).agg(F.count(F.lit(1)).alias("n"))


def q_day_keys(spark, sf_dir):
    _, prices = _tables(spark, sf_dir)
    return prices.groupBy(S.day_key("date_time").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.min(S.to_ts("date_time")).alias("first_ts"))


def q_coin_tokens_mapped(spark, sf_dir):
    _, prices = _tables(spark, sf_dir)
    return prices.groupBy("coin", S.coin_to_token("coin").alias("token")).agg(F.count(F.lit(1)).alias("n"))


def q_unix_roundtrip(spark, sf_dir):
    _, prices = _tables(spark, sf_dir)
    secs = S.to_unix_seconds("date_time")
    return prices.select("date_time", secs.alias("unix_s"),
                         S.unix_ms_to_text(secs * 1000 + 999).alias("back_text"))


def q_price_docs_exploded(spark, sf_dir):
    events = _events(spark, sf_dir)
    docs = PR.price_docs_from_prices(FX.price_points_from_events(events))
    return PR.explode_price_docs(PR.parse_price_docs(docs)).select("coin", *PR.PRICE_ROW_COLUMNS)


def q_rows_as_json(spark, sf_dir):
    events = _events(spark, sf_dir)
    return events.select("event_id", S.row_json("event_id", "user_id", "event_type", "props").alias("json"))


def q_row_ids(spark, sf_dir):
    trades, _ = _tables(spark, sf_dir)
    cols = ["block_date", "tx_hash", "token_pair", "order_type", "partial_fill", "sell_token", "buy_token"]
    return with_row_id(trades.select(*cols))


def q_float_row_ids(spark, sf_dir):
    """Ids over floats of every layout: short and long fractions, large and small exponents."""
    v = F.col("value")
    return with_row_id(_events(spark, sf_dir).select(
        "event_id", v.alias("plain"), (v / 3).alias("third"), (v * 1e-9).alias("small"), (v / 7 * 1e15).alias("large"),
        (-v * 1e18).alias("huge"), F.floor(v).cast("double").alias("whole"),
        F.when(F.col("event_id") % 3 != 0, v / 1e5).alias("missing")))


# --- staging loads (pure DataFrame form of insert-if-absent and its report)

FIRST_HALF_END = "2024-01-16"      # existing rows: block_date before this day
BATCH_START = "2024-01-10"         # batch: overlaps the existing rows from this day
BATCH_DUP_START = "2024-01-25"     # ... and repeats its rows from this day
EMPTY_BEFORE = "2024-01-01"        # no trade is older: an empty batch


def _trade_rows(spark, sf_dir):
    trades, _ = _tables(spark, sf_dir)
    return with_row_id(trades.select(*JB.TRADE_COLUMNS))


def _overlapping_batch(rows):
    d = F.col("block_date")
    return rows.where(d >= F.lit(BATCH_START).cast("date")).unionByName(
        rows.where(d >= F.lit(BATCH_DUP_START).cast("date")))


def q_insert_if_absent(spark, sf_dir):
    rows = _trade_rows(spark, sf_dir)
    stored = LD.insert_new_rows(rows.where(F.col("block_date") < F.lit(FIRST_HALF_END).cast("date")), None)
    new = LD.insert_new_rows(_overlapping_batch(rows), stored)
    return stored.unionByName(new).drop("id")


def q_seed_if_empty(spark, sf_dir):
    rows = _trade_rows(spark, sf_dir).drop("id")
    d = F.col("block_date")
    seed = rows.where(d >= F.lit(AS_OF).cast("date"))
    empty_target = rows.where(d < F.lit(EMPTY_BEFORE).cast("date"))
    full_target = rows.where(d < F.lit(AS_OF).cast("date"))
    return (LD.seed_if_empty(empty_target, seed).withColumn("target", F.lit("empty"))
            .unionByName(LD.seed_if_empty(full_target, seed).withColumn("target", F.lit("non_empty"))))


def q_load_report(spark, sf_dir):
    """The reports of two loads into a catalog table: an overlapping batch, an empty one."""
    rows = _trade_rows(spark, sf_dir)
    with _databases(spark, "staging") as (staging,):
        table = JB.trades_table(spark, name=f"{staging}.trades")
        LD.insert_if_absent(spark, rows.where(F.col("block_date") < F.lit(FIRST_HALF_END).cast("date")), table)
        reports = [("daily", LD.insert_if_absent(spark, _overlapping_batch(rows), table, source_id="q-1")),
                   ("empty", LD.insert_if_absent(
                       spark, rows.where(F.col("block_date") < F.lit(EMPTY_BEFORE).cast("date")), table, source_id="q-2"))]
    out = [(r.schema.rpartition("_")[0], r.table_name.rpartition(".")[2], load, r.total_rows, r.inserted_rows,
            ",".join(r.columns), r.source_id) for load, r in reports]
    return spark.createDataFrame(out, "schema_name string, table_name string, load string, total_rows long, "
                                      "inserted_rows long, columns string, query_id string")


@contextlib.contextmanager
def _databases(spark, *names):
    """Fresh databases, dropped with their tables and views at the end."""
    tag = uuid.uuid4().hex[:10]
    made = [TB.create_namespace(spark, f" {n.title()} {tag} ") for n in names]
    try:
        yield made
    finally:
        for db in made:
            spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def _kept(spark, df):
    """The rows of ``df``, read from a copy in the shared scratch folder."""
    path = _session.scratch_path(spark, "kept")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def q_published_views_read(spark, sf_dir):
    """Namespaces, tables, loads and persistent views in fresh databases; the view read back."""
    trades, prices = _tables(spark, sf_dir)
    with _databases(spark, "staging", "data warehouse") as (staging, warehouse):
        t = JB.trades_table(spark, name=f"{staging}.trades")
        p = JB.prices_table(spark, name=f"{staging}.coin_prices")
        for _ in range(2):
            LD.insert_if_absent(spark, with_row_id(trades.select(*JB.TRADE_COLUMNS)), t)
            LD.insert_if_absent(spark, with_row_id(prices.select(*JB.PRICE_COLUMNS)), p, range_columns=("date_time",))
        VW.publish_views(spark, t.name, p.name, target=warehouse, on_zero=ON_ZERO)
        return _kept(spark, _r(spark.table(f"{warehouse}.price_gap_daily"), {"avg_price_difference": 6}))


def _published(spark, sf_dir, view):
    """The views over session views of the inputs; every name is gone once the result is kept."""
    trades, prices = _tables(spark, sf_dir)
    tag = f"tl_{uuid.uuid4().hex[:8]}_"
    trades.createOrReplaceTempView(f"{tag}trades")
    prices.createOrReplaceTempView(f"{tag}coin_prices")
    out = VW.publish_views(spark, f"{tag}trades", f"{tag}coin_prices", temporary=True, prefix=tag, on_zero=ON_ZERO)
    try:
        return _kept(spark, out[view])
    finally:
        for name in ("price_gap_daily", "trade_summary_daily", "trades", "coin_prices"):
            spark.catalog.dropTempView(f"{tag}{name}")


def q_published_price_gap_view(spark, sf_dir):
    return _r(_published(spark, sf_dir, "price_gap_daily"), {"avg_price_difference": 6})


def q_published_summary_view(spark, sf_dir):
    return _r(_published(spark, sf_dir, "trade_summary_daily"),
              {"total_usd_value_bought": 6, "total_usd_value_sold": 6, "total_units_sold": 6,
               "total_units_bought": 6, "avg_buy_price": 6, "avg_sell_price": 6})


def _odd_prices(events):
    """Price rows with missing and empty coins and missing times."""
    n = F.col("event_id")
    coin = F.when(n % 5 == 0, F.lit(None)).when(n % 5 == 1, F.lit("")).otherwise(F.lit("ethereum"))
    rows = FX.coin_prices_from_events(events.withColumn("event_type", F.lit("view")))
    return events.select(
        F.when(n % 7 != 0, F.substring(F.col("ts").cast("timestamp_ntz").cast("string"), 1, 19)).alias("date_time"),
        F.col("value").alias("prices"), n.cast("double").alias("market_cap"),
        F.lit(None).cast("double").alias("total_volume"), coin.cast("string").alias("coin")).select(*rows.columns)


def q_replay_odd_partitions(spark, sf_dir):
    """Three loads of rows with null and empty partition values and null times store each once."""
    rows = with_row_id(_odd_prices(_events(spark, sf_dir)).select(*JB.PRICE_COLUMNS))
    table = JB.prices_table(spark, path=_session.scratch_path(spark, "odd"))
    for _ in range(3):
        LD.insert_if_absent(spark, rows, table, range_columns=("date_time",))
    return table.read().drop("id")


def q_seeded_table(spark, sf_dir):
    """A seed is written to an empty table; a second seed finds rows and changes nothing."""
    rows = _trade_rows(spark, sf_dir)
    d = F.col("block_date")
    table = JB.trades_table(spark, path=_session.scratch_path(spark, "seeded"))
    LD.seed_table(spark, table, rows.where(d < F.lit(AS_OF).cast("date")))
    LD.seed_table(spark, table, rows)
    return table.read().drop("id")


def q_landed_price_docs(spark, sf_dir):
    """Landed JSON documents read in one batch; documents without prices give no rows."""
    docs = PR.price_docs_from_prices(FX.price_points_from_events(_events(spark, sf_dir))).select("coin", "doc")
    broken = docs.select("coin", F.lit('{"error": "rate limited"}').alias("doc"))
    path = _session.scratch_path(spark, "landed")
    ST.land_price_docs(docs.unionByName(broken), path)
    return PR.read_price_docs(spark, path)


def _bad_docs(points):
    """Three documents per coin and hour that do not load: cut off, without prices, unequal arrays."""
    hours = points.select("coin", F.floor(F.col("ms") / 3_600_000).cast("string").alias("h")).distinct()
    texts = [F.concat(F.lit('{"prices": [['), "h"), F.concat(F.lit('{"error": "rate limited", "hour": '), "h", F.lit("}")),
             F.concat(F.lit('{"prices": [[1, 2]], "market_caps": [], "total_volumes": [], "hour": '), "h", F.lit("}"))]
    return hours.select("coin", F.explode(F.array(*texts)).alias("doc"))


def _quarantined(prices, rejected):
    loaded = prices.groupBy("coin").agg(F.count(F.lit(1)).alias("n")).select("coin", F.lit("loaded").alias("outcome"), "n")
    return loaded.unionByName(rejected.groupBy("coin", F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n")))


def _land_with_bad_docs(spark, sf_dir, path):
    points = FX.price_points_from_events(_events(spark, sf_dir))
    good = PR.price_docs_from_prices(points).select("coin", "doc")
    ST.land_price_docs(good.unionByName(_bad_docs(points)), path)


def q_quarantined_price_docs(spark, sf_dir):
    """Good and bad documents loaded twice in batch: points per coin, rejected documents by reason."""
    base = _session.scratch_path(spark, "quarantine")
    _land_with_bad_docs(spark, sf_dir, f"{base}/landing")
    p, bad = JB.prices_table(spark, path=f"{base}/prices"), JB.rejected_table(spark, path=f"{base}/rejected")
    for _ in range(2):
        JB.load_price_docs(spark, PR.landed_docs(spark, f"{base}/landing"), p, bad)
    return _quarantined(p.read(), bad.read())


def q_stream_quarantine(spark, sf_dir):
    """The same documents as a stream, replayed under a new checkpoint."""
    base = _session.scratch_path(spark, "quarantine-stream")
    _land_with_bad_docs(spark, sf_dir, f"{base}/landing")
    p, bad = JB.prices_table(spark, path=f"{base}/prices"), JB.rejected_table(spark, path=f"{base}/rejected")
    for run in range(2):
        ST.stream_price_docs(spark, f"{base}/landing", p, f"{base}/checkpoint-{run}", rejected=bad).awaitTermination()
    return _quarantined(p.read(), bad.read())


def _price_days(spark, sf_dir, name):
    """The price points landed as documents by coin and day; the format that reads them, its options."""
    points = FX.price_points_from_events(_events(spark, sf_dir))
    root = _session.scratch_path(spark, name)
    day = F.date_from_unix_date(F.floor(F.col("doc_hour") / 24).cast("int")).alias("day")
    DD.land_by_day(PR.price_docs_from_prices(points).select(F.col("coin").alias("key"), day, "doc"), root)
    lo, hi = points.agg(F.min("ms"), F.max("ms")).first()
    first, last = [(_dt.date(1970, 1, 1) + _dt.timedelta(days=(ms or 0) // 86_400_000)) for ms in (lo, hi)]
    source = DD.register(spark, DD.FolderTransport(root), f"days_{uuid.uuid4().hex[:12]}")
    return source, {"keys": json.dumps(sorted(FX.PRICE_EVENT_COINS.values())), "first": first.isoformat()}, last


def q_sourced_price_docs(spark, sf_dir):
    """All price documents through the data source, a partition per coin and week."""
    source, options, last = _price_days(spark, sf_dir, "price-days")
    docs = spark.read.format(source).options(**options, end=(last + _dt.timedelta(days=1)).isoformat(), days="7").load()
    return PR.loadable_prices(PR.checked_price_docs(docs.withColumnRenamed("key", "coin")))


def q_sourced_price_stream(spark, sf_dir):
    """The same as a stream in two runs of one checkpoint: the complete days up to the middle, then the others."""
    source, options, last = _price_days(spark, sf_dir, "price-day-stream")
    base = _session.scratch_path(spark, "price-day-tables")
    p, bad = JB.prices_table(spark, path=f"{base}/prices"), JB.rejected_table(spark, path=f"{base}/rejected")
    first = _dt.date.fromisoformat(options["first"])
    for more in ({"end": (first + (last - first) / 2).isoformat()}, {}):
        ST.stream_day_documents(spark, source, options | {"days": "7"} | more, p, bad, f"{base}/checkpoint").awaitTermination()
    return p.read().drop("id")


def q_sourced_trades(spark, sf_dir):
    """All trades as documents by direction and day, read back through the data source."""
    trades, _ = _tables(spark, sf_dir)
    root = _session.scratch_path(spark, "trade-days")
    DD.land_by_day(TR.trade_docs(trades), root, "direction")
    lo, hi = trades.agg(F.min("block_date"), F.max("block_date")).first()
    keys = json.dumps(["USDC-WETH", "WETH-USDC"])
    source = DD.register(spark, DD.FolderTransport(root, "direction"), f"days_{uuid.uuid4().hex[:12]}")
    first, last = lo or _dt.date(1970, 1, 1), hi or _dt.date(1970, 1, 1)
    docs = spark.read.format(source).options(keys=keys, first=first.isoformat(), end=(last + _dt.timedelta(days=1)).isoformat(), days="7")
    return TR.parse_trade_docs(docs.load())


def q_staged_trades(spark, sf_dir):
    """A source frame with raw column names -> cleaned names, staging types, id."""
    events = _events(spark, sf_dir)
    k = FX.k_of("props")
    raw = events.where(F.col("event_type").isin(*FX.TRADE_EVENT_TYPES)).select(
        F.col("event_id").alias("Unnamed: 0"),
        F.to_date("ts").alias("Block Date"),
        F.col("user_id").cast("string").alias(" TX Hash "),
        F.col("user_id").cast("int").alias("User Id"),
        F.col("value").alias("Units Bought"),
        (k >= 50).alias("Partial Fill"))
    return LD.stage_rows(raw, ["column_0", "block_date", "tx_hash", "user_id", "partial_fill"])


def q_staged_types(spark, sf_dir):
    """Arrays become arrays of texts, decimals keep their digits; the month's first day as text."""
    events = _events(spark, sf_dir)
    raw = events.select(F.col("event_id").alias("Event Id"), F.array("event_id", "user_id").alias("Id List"),
                        F.col("value").cast("decimal(38,9)").alias("Amount"),
                        S.month_start_text("ts").alias(" Month Start "))
    return LD.stage_rows(raw).drop("id").withColumn("id_list", F.array_join("id_list", "|"))


def q_coin_tagged_prices(spark, sf_dir):
    """Each coin's documents parsed on their own columns; the coin is the request's constant.

    One scan: the constant is set per coin by a CASE over the coins requested."""
    docs = PR.price_docs_from_prices(FX.price_points_from_events(_events(spark, sf_dir)))
    request = F.lit(None).cast("string")
    for coin in FX.PRICE_EVENT_COINS.values():
        request = F.when(F.col("coin") == coin, F.lit(coin)).otherwise(request)
    return PR.explode_price_docs(PR.parse_price_docs(docs.withColumn("coin", request))).select(*PR.PRICE_ROW_COLUMNS, "coin")


def q_daily_load_replayed(spark, sf_dir):
    trades, prices = _tables(spark, sf_dir)
    base = _session.scratch_path(spark, "daily-trades")
    t = JB.trades_table(spark, path=f"{base}/trades")
    for _ in range(2):
        JB.load_trades(spark, trades, t, AS_OF)
    return t.read().drop("id")


def q_daily_price_load_replayed(spark, sf_dir):
    _, prices = _tables(spark, sf_dir)
    base = _session.scratch_path(spark, "daily-prices")
    p = JB.prices_table(spark, path=f"{base}/prices")
    for _ in range(2):
        JB.load_prices(spark, prices, p, list(JB.DEFAULT_COINS), AS_OF)
    return p.read().drop("id")


def q_backfill_price_gap(spark, sf_dir):
    """Initial load into staging tables, then the daily price gap read from them."""
    trades, prices = _tables(spark, sf_dir)
    base = _session.scratch_path(spark, "backfill")
    t = JB.trades_table(spark, path=f"{base}/trades")
    p = JB.prices_table(spark, path=f"{base}/prices")
    JB.backfill(spark, trades, prices, t, p, AS_OF)
    return _r(PG.price_gap_daily(t.read(), p.read(), on_zero=ON_ZERO), {"avg_price_difference": 6})


#: Days of a window of the resumed backfill, and the day on which its first run dies.
WINDOW_DAYS, DEAD_DAY = 5, "2024-01-08"


@contextlib.contextmanager
def _resumed(spark, sf_dir):
    """A backfill into fresh databases that dies in its second window, once the prices before it
    and that window's own are asked for, and is run again: ``(staging, warehouse, trades table,
    prices table, ledger)``."""
    trades, prices = _tables(spark, sf_dir)
    dead = F.when(F.substring("date_time", 1, 10) == DEAD_DAY, F.raise_error(F.lit("the price source is gone")).cast("double"))
    dying = prices.withColumn("market_cap", dead.otherwise(F.col("market_cap")))
    with _databases(spark, "staging", "data warehouse") as (staging, warehouse):
        t = JB.trades_table(spark, name=f"{staging}.trades")
        p = JB.prices_table(spark, name=f"{staging}.coin_prices")
        ledger = LDG.ledger_table(spark, name=f"{staging}.loads")
        for source in (dying, prices):
            with contextlib.suppress(PySparkException) if source is dying else contextlib.nullcontext():
                JB.resumable_backfill(spark, trades, source, t, p, ledger, AS_OF, window_days=WINDOW_DAYS,
                                      views_db=warehouse, on_zero=ON_ZERO)
        yield staging, warehouse, t, p, ledger


def q_resumed_backfill_gap(spark, sf_dir):
    """The published price-gap view after a backfill that died and went on."""
    with _resumed(spark, sf_dir) as (_, warehouse, *_rest):
        return _kept(spark, _r(spark.table(f"{warehouse}.price_gap_daily"), {"avg_price_difference": 6}))


def q_backfill_ledger(spark, sf_dir):
    """The ledger of the same backfill, a row per window."""
    with _resumed(spark, sf_dir) as (*_, ledger):
        return _kept(spark, LDG.progress(ledger, JB.job_name()))


def q_published_headline_totals(spark, sf_dir):
    """The totals over the published summary view, then a reset of the staging tables: the totals
    and the number of tables that the reset left."""
    with _resumed(spark, sf_dir) as (staging, warehouse, *tables):
        totals = _kept(spark, AG.headline_totals(spark.table(f"{warehouse}.trade_summary_daily")))
        TB.drop_tables(spark, [t.name for t in tables])
        left = len([t for t in spark.catalog.listTables(staging) if not t.isTemporary])
        return totals.withColumn("tables_left", F.lit(left).cast("long"))


def q_drifted_loads(spark, sf_dir):
    """Three loads whose columns change: whole amounts, then real ones with a further column, then
    all whole amounts again as reals (a replay).  Rows and ids under the newest columns."""
    events = _events(spark, sf_dir)
    base = events.select(F.col("event_id").alias("Event Id"), F.col("user_id").alias("User Id"),
                         F.col("value").alias(" Amount "), F.col("event_type").alias("Kind"))
    half = F.col("`Event Id`") % 2 == 0
    whole = base.where(half).withColumn(" Amount ", F.floor(" Amount ")).drop("Kind")
    table = DR.DriftingTable(spark, _session.scratch_path(spark, "drift"))
    for frame in (whole, base.where(~half), whole.withColumn(" Amount ", F.col(" Amount ").cast("double"))):
        DR.load_drifting(spark, frame, table)
    return table.read()


def q_bucketed_id_load(spark, sf_dir):
    """A source frame loaded twice into a catalog table bucketed by id: half of it, then all."""
    events = _events(spark, sf_dir)
    raw = events.select(F.col("event_id").alias("Event Id"), F.col("user_id").alias("User Id"), F.col("event_type").alias("Kind"))
    with _databases(spark, "staging") as (staging,):
        table = TB.StagingTable(spark, name=f"{staging}.events", bucket_by=("id", 16))
        for frame in (raw.where(F.col("`Event Id`") % 2 == 0), raw):
            LD.load_frame(spark, frame, table)
        return _kept(spark, table.read().drop("id"))


def _drifted(trades):
    """Trades some of which lie two days off their ``block_date``."""
    off = F.when(F.dayofmonth("block_time") % 3 == 0, 2).otherwise(0)
    return trades.withColumn("block_date", F.date_add(F.to_date("block_time"), off))


def _materialized(spark, sf_dir):
    """Results refreshed by two loads: all but the late prices, then the late prices with the
    same trades again."""
    trades, prices = _tables(spark, sf_dir)
    base = _session.scratch_path(spark, "results")
    t, p = JB.trades_table(spark, path=f"{base}/trades"), JB.prices_table(spark, path=f"{base}/prices")
    late = F.hour(F.col("date_time").cast("timestamp_ntz")) >= 18
    trades = with_row_id(_drifted(trades).select(*JB.TRADE_COLUMNS))
    parts = [prices.where(~late), prices.where(late)]
    for part in parts:
        def load(part=part):
            days = (F.to_date("block_time"), F.col("block_date"))
            time = F.to_date(F.col("date_time").cast("timestamp_ntz"))
            return [LD.insert_if_absent(spark, trades, t, day_columns=days),
                    LD.insert_if_absent(spark, with_row_id(part.select(*JB.PRICE_COLUMNS)), p,
                                        range_columns=("date_time",), day_columns=(time,))]
        JB.load_and_refresh(spark, t, p, (f"{base}/summary", f"{base}/gap"), load, ON_ZERO)
    return JB.read_daily_results(spark, f"{base}/summary", f"{base}/gap")


def q_materialized_null_days(spark, sf_dir):
    """The summary refreshed by three loads, with trades that have no ``block_date``: the first
    half, the second half, and the second half again."""
    trades, prices = _tables(spark, sf_dir)
    no_day = F.when(F.dayofmonth("block_time") % 5 != 0, F.col("block_date"))
    rows = with_row_id(trades.withColumn("block_date", no_day).select(*JB.TRADE_COLUMNS))
    base = _session.scratch_path(spark, "null-days")
    t, p = JB.trades_table(spark, path=f"{base}/trades"), JB.prices_table(spark, path=f"{base}/prices")
    p.ensure()
    late = F.dayofmonth("block_time") >= 15
    for part in (rows.where(~late), rows.where(late), rows.where(late)):
        JB.load_and_refresh(spark, t, p, (f"{base}/summary", f"{base}/gap"), lambda part=part: [
            LD.insert_if_absent(spark, part, t, day_columns=(F.to_date("block_time"), F.col("block_date")))])
    return _r(JB.read_daily_results(spark, f"{base}/summary", f"{base}/gap")[0], _SUMMARY_DIGITS)


_SUMMARY_DIGITS = {"total_usd_value_bought": 6, "total_usd_value_sold": 6, "total_units_sold": 6,
                   "total_units_bought": 6, "avg_buy_price": 6, "avg_sell_price": 6}


def q_materialized_price_gap(spark, sf_dir):
    return _r(_materialized(spark, sf_dir)[1], {"avg_price_difference": 6})


def q_materialized_summary(spark, sf_dir):
    return _r(_materialized(spark, sf_dir)[0],
              {"total_usd_value_bought": 6, "total_usd_value_sold": 6, "total_units_sold": 6,
               "total_units_bought": 6, "avg_buy_price": 6, "avg_sell_price": 6})


def _incremental(spark, sf_dir):
    """States after four loads: the early prices and trades, the late prices, the late trades with
    all trades again, and everything again."""
    trades, prices = _tables(spark, sf_dir)
    base = _session.scratch_path(spark, "incremental")
    t, p = JB.trades_table(spark, path=f"{base}/trades"), JB.prices_table(spark, path=f"{base}/prices")
    trades = with_row_id(_drifted(trades).select(*JB.TRADE_COLUMNS))
    prices = with_row_id(prices.select(*JB.PRICE_COLUMNS))
    late_price = F.hour(F.col("date_time").cast("timestamp_ntz")) >= 18
    results = IN.IncrementalResults(spark, f"{base}/states", t, p, on_zero=ON_ZERO)
    results.load(trades.where(F.minute("block_time") < 40), prices.where(~late_price))
    results.load(None, prices.where(late_price))
    results.load(trades)
    results.load(trades, prices)
    return results


def q_incremental_price_gap(spark, sf_dir):
    return _r(_incremental(spark, sf_dir).price_gap(), {"avg_price_difference": 6})


def q_incremental_summary(spark, sf_dir):
    return _r(_incremental(spark, sf_dir).summary(), _SUMMARY_DIGITS)


def q_stream_load_replayed(spark, sf_dir):
    events = _events(spark, sf_dir)
    base = _session.scratch_path(spark, "price-stream")
    ST.land_price_docs(PR.price_docs_from_prices(FX.price_points_from_events(events)), f"{base}/landing")
    table = JB.prices_table(spark, path=f"{base}/table")
    for run in range(2):  # the second run replays everything under a new checkpoint
        ST.stream_price_docs(spark, f"{base}/landing", table, f"{base}/checkpoint-{run}").awaitTermination()
    return table.read().drop("id")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "price_gap_daily": _gap(),
    "price_gap_daily_union": _gap(plan="union"),
    "price_gap_daily_24h": _gap(mode="24h"),
    "price_gap_daily_symmetric": _gap(gap="symmetric_pct"),
    "trade_price_left_join": q_trade_price_left_join,
    "sell_legs": _legs_query("sell"),
    "buy_legs": _legs_query("buy"),
    "legs_union_all": q_legs_union_all,
    "trade_summary_daily": q_trade_summary_daily,
    "headline_totals": q_headline_totals,
    "token_list": q_token_list,
    "token_series": q_token_series,
    "price_gap_one_token": q_price_gap_one_token,
    "trades_month_to_date": q_trades_month_to_date,
    "trades_prev_day": q_trades_prev_day,
    "price_window": q_price_window,
    "hour_keys": q_hour_keys,
    "day_keys": q_day_keys,
    "coin_tokens_mapped": q_coin_tokens_mapped,
    "unix_roundtrip": q_unix_roundtrip,
    "price_docs_exploded": q_price_docs_exploded,
    "rows_as_json": q_rows_as_json,
    "row_ids": q_row_ids,
    "float_row_ids": q_float_row_ids,
    "insert_if_absent": q_insert_if_absent,
    "seed_if_empty": q_seed_if_empty,
    "load_report": q_load_report,
    "published_price_gap_view": q_published_price_gap_view,
    "published_summary_view": q_published_summary_view,
    "staged_trades": q_staged_trades,
    "coin_tagged_prices": q_coin_tagged_prices,
    "daily_load_replayed": q_daily_load_replayed,
    "daily_price_load_replayed": q_daily_price_load_replayed,
    "stream_load_replayed": q_stream_load_replayed,
    "backfill_price_gap": q_backfill_price_gap,
    "resumed_backfill_gap": q_resumed_backfill_gap,
    "backfill_ledger": q_backfill_ledger,
    "published_headline_totals": q_published_headline_totals,
    "drifted_loads": q_drifted_loads,
    "bucketed_id_load": q_bucketed_id_load,
    "materialized_price_gap": q_materialized_price_gap,
    "materialized_summary": q_materialized_summary,
    "materialized_null_days": q_materialized_null_days,
    "incremental_price_gap": q_incremental_price_gap,
    "incremental_summary": q_incremental_summary,
    "published_views_read": q_published_views_read,
    "replay_odd_partitions": q_replay_odd_partitions,
    "seeded_table": q_seeded_table,
    "landed_price_docs": q_landed_price_docs,
    "quarantined_price_docs": q_quarantined_price_docs,
    "stream_quarantine": q_stream_quarantine,
    "sourced_price_docs": q_sourced_price_docs,
    "sourced_price_stream": q_sourced_price_stream,
    "sourced_trades": q_sourced_trades,
    "staged_types": q_staged_types,
}


# --------------------------------------------------------------------------- oracle SQL

_FIXTURE_CTES = """
ev AS (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
trades AS (
  SELECT CAST(ts AS DATE) AS block_date, ts AS block_time, CAST(user_id AS VARCHAR) AS tx_hash,
         'USDC-WETH' AS token_pair, event_type AS order_type, (k >= 50) AS partial_fill,
         CASE WHEN event_type = 'purchase' THEN 'USDC' ELSE 'WETH' END AS sell_token,
         CASE WHEN event_type = 'purchase' THEN 'WETH' ELSE 'USDC' END AS buy_token,
         k + 2 AS units_sold, value AS units_bought, value AS sell_value_usd,
         value * (k + 1) AS usd_value, value / (k + 2) AS sell_price, k + 1 AS buy_price
  FROM ev WHERE event_type IN ('purchase', 'signup')),
coin_prices AS (
  SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS date_time, value AS prices,
         value * 1000 AS market_cap, value * 10 AS total_volume,
         CASE event_type WHEN 'view' THEN 'ethereum' WHEN 'click' THEN 'usd-coin' ELSE 'other' END AS coin
  FROM ev WHERE event_type IN ('view', 'click', 'error'))"""


def _price_ctes(hours=12, gap="quarter", trades_src="trades", prices_src="coin_prices", base=None):
    """Legs (a trade's two sides), quotes (mapped prices) and their pairs by day and hour key."""
    mean = "(trade_price + price)" if gap == "quarter" else "((trade_price + price) / 2)"
    half = " / 2" if gap == "quarter" else ""
    return f"""{base or _FIXTURE_CTES},
legs AS (
  SELECT CAST(block_time AS DATE) AS day, hour(block_time) % {hours} AS h, side.*
  FROM (SELECT block_time, unnest([
          {{'side': 'sell', 'token': sell_token, 'amount': units_sold, 'trade_price': sell_price, 'usd': sell_value_usd}},
          {{'side': 'buy', 'token': buy_token, 'amount': units_bought, 'trade_price': buy_price, 'usd': usd_value}}]) AS side
        FROM {trades_src})),
quotes AS (
  SELECT CAST(tick AS DATE) AS day, hour(tick) % {hours} AS h, price,
         map_extract_value(MAP {{'ethereum': 'WETH', 'usd-coin': 'USDC'}}, coin) AS token
  FROM (SELECT CAST(date_time AS TIMESTAMP) AS tick, prices AS price, coin FROM {prices_src})),
pairs AS (
  SELECT legs.*, price, ((trade_price - price) / {mean}{half}) * 100 AS gap
  FROM legs JOIN quotes USING (day, h, token)),
gap AS (
  SELECT strftime(day, '%Y-%m-%d') AS date, token, avg(gap) AS avg_price_difference
  FROM pairs GROUP BY day, token)"""


def _gap_sql(hours=12, gap="quarter", **sources):
    return f"""WITH {_price_ctes(hours, gap, **sources)}
SELECT date, token, round(avg_price_difference, 6) AS avg_price_difference FROM gap"""


_SUMMARY_CTE = """summary AS (
  SELECT block_date, token_pair, count(DISTINCT tx_hash) AS no_txn,
         sum(usd_value) AS total_usd_value_bought, sum(sell_value_usd) AS total_usd_value_sold,
         sum(units_sold) AS total_units_sold, sum(units_bought) AS total_units_bought,
         avg(buy_price) AS avg_buy_price, avg(sell_price) AS avg_sell_price
  FROM trades GROUP BY block_date, token_pair)"""

_LEG_SUMMARY = """SELECT strftime(day, '%Y-%m-%d ') || lpad(CAST(if(h = 0, 12, h) AS VARCHAR), 2, '0') || ':00' AS datetime,
       token, count(*) AS n_rows, round(sum(amount), 6) AS sum_amount,
       round(avg(trade_price), 6) AS avg_trade_price, round(avg(gap), 6) AS avg_price_difference,
       round(sum(amount * price), 6) AS sum_external_value_usd, round(sum(usd), 6) AS sum_usd_trade_value
FROM pairs WHERE side = '{side}' GROUP BY day, h, token"""

_TRADE_COLS = ("block_date, block_time, tx_hash, token_pair, order_type, partial_fill, sell_token, "
               "buy_token, units_sold, units_bought, sell_value_usd, usd_value, sell_price, buy_price")

_ORACLE: dict[str, str] = {
    "price_gap_daily": _gap_sql(),
    "price_gap_daily_union": _gap_sql(),
    "price_gap_daily_24h": _gap_sql(hours=24),
    "price_gap_daily_symmetric": _gap_sql(gap="symmetric_pct"),
    "trade_price_left_join": f"""WITH {_price_ctes()},
keys AS (SELECT day, h, count(*) AS n, count(token) AS mapped FROM quotes GROUP BY day, h),
met AS (SELECT day, count(*) AS n FROM pairs GROUP BY day),
per AS (
  SELECT l.day, sum(greatest(coalesce(k.n, 0), 1)) AS joined_rows, count(*) FILTER (WHERE k.n IS NULL) AS unmatched_trades,
         sum(coalesce(k.mapped, 0)) AS mapped_rows
  FROM legs l LEFT JOIN keys k USING (day, h) WHERE l.side = 'buy' GROUP BY l.day)
SELECT strftime(day, '%Y-%m-%d') AS date, CAST(joined_rows AS BIGINT) AS joined_rows, unmatched_trades,
       CAST(mapped_rows AS BIGINT) AS mapped_rows, coalesce(met.n, 0) AS leg_rows
FROM per LEFT JOIN met USING (day)""",
    "sell_legs": f"WITH {_price_ctes()}\n" + _LEG_SUMMARY.format(side="sell"),
    "buy_legs": f"WITH {_price_ctes()}\n" + _LEG_SUMMARY.format(side="buy"),
    "legs_union_all": f"""WITH {_price_ctes()}
SELECT token, count(*) AS n_rows,
       CAST(round(sum(CAST(amount AS DECIMAL(28,10))), 4) AS DOUBLE) AS sum_amount,
       CAST(round(sum(CAST(amount * price AS DECIMAL(28,10))), 4) AS DOUBLE) AS sum_external_value_usd,
       CAST(round(sum(CAST(usd AS DECIMAL(28,10))), 4) AS DOUBLE) AS sum_usd_trade_value
FROM pairs GROUP BY token""",
    "trade_summary_daily": f"""WITH {_FIXTURE_CTES}, {_SUMMARY_CTE}
SELECT block_date, token_pair, no_txn,
       round(total_usd_value_bought, 6) AS total_usd_value_bought,
       round(total_usd_value_sold, 6) AS total_usd_value_sold,
       round(total_units_sold, 6) AS total_units_sold, round(total_units_bought, 6) AS total_units_bought,
       round(avg_buy_price, 6) AS avg_buy_price, round(avg_sell_price, 6) AS avg_sell_price
FROM summary""",
    "headline_totals": f"""WITH {_FIXTURE_CTES}, {_SUMMARY_CTE}
SELECT CAST(sum(no_txn) AS BIGINT) AS no_trades,
       CAST(round_even(sum(total_units_bought), 0) AS BIGINT) AS units_bought,
       CAST(round_even(sum(total_units_sold), 0) AS BIGINT) AS units_sold,
       CAST(round_even(sum(total_usd_value_sold), 0) AS BIGINT) AS value_sold,
       CAST(round_even(sum(total_usd_value_bought), 0) AS BIGINT) AS value_bought,
       (SELECT count(DISTINCT tx_hash) FROM trades) AS no_trades_distinct
FROM summary""",
    "token_list": f"WITH {_price_ctes()}\nSELECT DISTINCT token FROM gap",
    "token_series": f"""WITH {_price_ctes()}
SELECT token, row_number() OVER (PARTITION BY token ORDER BY CAST(date AS DATE)) AS seq,
       CAST(date AS DATE) AS date, round(avg_price_difference, 6) AS avg_price_difference
FROM gap""",
    "price_gap_one_token": f"""WITH {_price_ctes()}
SELECT CAST(date AS DATE) AS date, round(avg_price_difference, 6) AS avg_price_difference
FROM gap WHERE token = 'WETH' ORDER BY date""",
    "trades_month_to_date": f"""WITH {_FIXTURE_CTES}
SELECT {_TRADE_COLS} FROM trades
WHERE buy_token = 'WETH' AND sell_token = 'USDC'
  AND block_date >= date_trunc('month', DATE '{AS_OF}') AND block_date < DATE '{AS_OF}'""",
    "trades_prev_day": f"""WITH {_FIXTURE_CTES}
SELECT {_TRADE_COLS} FROM trades
WHERE buy_token = 'WETH' AND sell_token = 'USDC' AND block_date = DATE '{AS_OF}' - INTERVAL '1' DAY""",
    "price_window": f"""WITH {_FIXTURE_CTES}
SELECT date_time, prices, market_cap, total_volume, coin, 'init' AS load FROM coin_prices
WHERE coin IN ('ethereum', 'usd-coin') AND date_time BETWEEN '2024-01-01 00:00:00' AND '2024-01-14 23:59:59'
UNION ALL
SELECT date_time, prices, market_cap, total_volume, coin, 'update' AS load FROM coin_prices
WHERE coin IN ('ethereum', 'usd-coin') AND date_time BETWEEN '2024-01-14 00:00:00' AND '2024-01-14 23:59:59'""",
    "hour_keys": """SELECT strftime(ts, '%Y-%m-%d %I:00') AS hour_key_12h, strftime(ts, '%Y-%m-%d %H:00') AS hour_key_24h,
       count(*) AS n
FROM events GROUP BY 1, 2""",
    "day_keys": f"""WITH {_FIXTURE_CTES}
SELECT strftime(CAST(date_time AS TIMESTAMP), '%Y-%m-%d') AS day, count(*) AS n,
       min(CAST(date_time AS TIMESTAMP)) AS first_ts
FROM coin_prices GROUP BY 1""",
    "coin_tokens_mapped": f"""WITH {_FIXTURE_CTES}
SELECT coin, CASE WHEN coin = 'ethereum' THEN 'WETH' WHEN coin = 'usd-coin' THEN 'USDC' END AS token,
       count(*) AS n
FROM coin_prices GROUP BY 1, 2""",
    "unix_roundtrip": f"""WITH {_FIXTURE_CTES}
SELECT date_time, CAST(epoch(CAST(date_time AS TIMESTAMP)) AS BIGINT) AS unix_s,
       strftime(make_timestamp((CAST(epoch(CAST(date_time AS TIMESTAMP)) AS BIGINT) * 1000 + 999) * 1000),
                '%Y-%m-%d %H:%M:%S') AS back_text
FROM coin_prices""",
    "price_docs_exploded": f"""WITH {_FIXTURE_CTES}
SELECT coin, date_time, prices, market_cap, total_volume FROM coin_prices""",
    "rows_as_json": """SELECT event_id,
       CAST(to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type, 'props': props}) AS VARCHAR) AS json
FROM events""",
    "row_ids": f"""WITH {_FIXTURE_CTES},
r AS (SELECT block_date, tx_hash, token_pair, order_type, partial_fill, sell_token, buy_token,
             md5(concat_ws(',', CAST(block_date AS VARCHAR), tx_hash, token_pair, order_type,
                           CASE WHEN partial_fill THEN 'True' ELSE 'False' END, sell_token, buy_token)) AS h
      FROM trades)
SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4)
       || '-' || substr(h, 21, 12) AS id,
       block_date, tx_hash, token_pair, order_type, partial_fill, sell_token, buy_token
FROM r""",
}

_TRADE_ROWS = f"SELECT {_TRADE_COLS} FROM trades"
_BATCH = f"""{_TRADE_ROWS} WHERE block_date >= DATE '{BATCH_START}'
UNION ALL {_TRADE_ROWS} WHERE block_date >= DATE '{BATCH_DUP_START}'"""
_PRICE_ROW_COLS = "date_time, prices, market_cap, total_volume, coin"
_TRADE_COL_LIST = ",".join(["id"] + _TRADE_COLS.replace(" ", "").split(","))

_DISTINCT_CTES = f"""{_FIXTURE_CTES},
distinct_trades AS (SELECT DISTINCT {_TRADE_COLS} FROM trades),
distinct_prices AS (SELECT DISTINCT {_PRICE_ROW_COLS} FROM coin_prices)"""

_ORACLE.update({
    "insert_if_absent": f"""WITH {_FIXTURE_CTES},
b AS ({_TRADE_ROWS} WHERE block_date < DATE '{FIRST_HALF_END}' UNION ALL {_BATCH})
SELECT DISTINCT * FROM b""",
    "seed_if_empty": f"""WITH {_FIXTURE_CTES}
SELECT {_TRADE_COLS}, 'empty' AS target FROM trades WHERE block_date >= DATE '{AS_OF}'
UNION ALL
SELECT {_TRADE_COLS}, 'non_empty' AS target FROM trades WHERE block_date < DATE '{AS_OF}'""",
    "load_report": f"""WITH {_FIXTURE_CTES},
s AS (SELECT DISTINCT {_TRADE_COLS} FROM trades WHERE block_date < DATE '{FIRST_HALF_END}'),
b AS ({_BATCH}),
e AS ({_TRADE_ROWS} WHERE block_date < DATE '{EMPTY_BEFORE}')
SELECT 'staging' AS schema_name, 'trades' AS table_name, 'daily' AS load,
       (SELECT count(*) FROM b) AS total_rows,
       (SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM s)) AS inserted_rows,
       '{_TRADE_COL_LIST}' AS columns, 'q-1' AS query_id
UNION ALL
SELECT 'staging', 'trades', 'empty', (SELECT count(*) FROM e),
       (SELECT count(*) FROM (SELECT * FROM e EXCEPT SELECT * FROM s)), '{_TRADE_COL_LIST}', 'q-2'""",
    "published_price_gap_view": _gap_sql(),
    "published_summary_view": _ORACLE["trade_summary_daily"],
    "staged_trades": f"""WITH {_FIXTURE_CTES},
r AS (SELECT event_id AS column_0, CAST(CAST(ts AS DATE) AS VARCHAR) AS block_date,
             CAST(user_id AS VARCHAR) AS tx_hash, CAST(user_id AS BIGINT) AS user_id,
             value AS units_bought, (k >= 50) AS partial_fill
      FROM ev WHERE event_type IN ('purchase', 'signup')),
h AS (SELECT *, md5(concat_ws(',', CAST(column_0 AS VARCHAR), block_date, tx_hash, CAST(user_id AS VARCHAR),
                               CASE WHEN partial_fill THEN 'True' ELSE 'False' END)) AS hx FROM r)
SELECT substr(hx, 1, 8) || '-' || substr(hx, 9, 4) || '-' || substr(hx, 13, 4) || '-' || substr(hx, 17, 4)
       || '-' || substr(hx, 21, 12) AS id, column_0, block_date, tx_hash, user_id, units_bought, partial_fill
FROM h""",
    "coin_tagged_prices": f"WITH {_FIXTURE_CTES}\nSELECT {_PRICE_ROW_COLS} FROM coin_prices",
    "daily_load_replayed": f"""WITH {_FIXTURE_CTES}
SELECT DISTINCT {_TRADE_COLS} FROM trades
WHERE buy_token = 'WETH' AND sell_token = 'USDC' AND block_date = DATE '{AS_OF}' - INTERVAL '1' DAY""",
    "daily_price_load_replayed": f"""WITH {_FIXTURE_CTES}
SELECT DISTINCT {_PRICE_ROW_COLS} FROM coin_prices
WHERE coin IN ('ethereum', 'usd-coin') AND date_time BETWEEN '2024-01-14 00:00:00' AND '2024-01-14 23:59:59'""",
    "stream_load_replayed": f"WITH {_FIXTURE_CTES}\nSELECT DISTINCT {_PRICE_ROW_COLS} FROM coin_prices",
    "materialized_price_gap": _gap_sql(trades_src="distinct_trades", prices_src="distinct_prices", base=_DISTINCT_CTES),
    "materialized_summary": _ORACLE["trade_summary_daily"].replace(
        f"WITH {_FIXTURE_CTES}, {_SUMMARY_CTE}", f"WITH {_DISTINCT_CTES}, drifted AS (SELECT * REPLACE (CAST(CAST(block_time AS DATE)"
        " + CASE WHEN day(block_time) % 3 = 0 THEN 2 ELSE 0 END AS DATE) AS block_date) FROM distinct_trades), "
        + _SUMMARY_CTE.replace("FROM trades", "FROM drifted")),
    "materialized_null_days": _ORACLE["trade_summary_daily"].replace(
        f"WITH {_FIXTURE_CTES}, {_SUMMARY_CTE}", f"WITH {_DISTINCT_CTES}, undated AS (SELECT * REPLACE ("
        "CASE WHEN day(block_time) % 5 <> 0 THEN block_date END AS block_date) FROM distinct_trades), "
        + _SUMMARY_CTE.replace("FROM trades", "FROM undated")),
    "published_views_read": _gap_sql(trades_src="distinct_trades", prices_src="distinct_prices", base=_DISTINCT_CTES),
    "backfill_price_gap": _gap_sql(trades_src="staged_trades", prices_src="staged_prices", base=f"""{_FIXTURE_CTES},
staged_trades AS (
  SELECT DISTINCT {_TRADE_COLS} FROM trades
  WHERE buy_token = 'WETH' AND sell_token = 'USDC'
    AND block_date >= DATE '2024-01-01' AND block_date < DATE '{AS_OF}'),
staged_prices AS (
  SELECT DISTINCT {_PRICE_ROW_COLS} FROM coin_prices
  WHERE coin IN ('ethereum', 'usd-coin') AND date_time BETWEEN '2024-01-01 00:00:00' AND '2024-01-14 23:59:59')"""),
    "replay_odd_partitions": """SELECT DISTINCT CASE WHEN event_id % 7 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS date_time,
       value AS prices, CAST(event_id AS DOUBLE) AS market_cap, CAST(NULL AS DOUBLE) AS total_volume,
       CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'ethereum' END AS coin
FROM events""",
    "seeded_table": f"""WITH {_FIXTURE_CTES}
SELECT DISTINCT {_TRADE_COLS} FROM trades WHERE block_date < DATE '{AS_OF}'""",
    "landed_price_docs": f"""WITH {_FIXTURE_CTES}
SELECT coin, date_time, prices, market_cap, total_volume FROM coin_prices""",
    "staged_types": """SELECT event_id, CAST(event_id AS VARCHAR) || '|' || CAST(user_id AS VARCHAR) AS id_list,
       CAST(CAST(value AS DECIMAL(38,9)) AS VARCHAR) AS amount, strftime(date_trunc('month', ts), '%Y-%m-%d') AS month_start
FROM events""",
})

_ORACLE["float_row_ids"] = """WITH r AS (
  SELECT event_id, value AS plain, value / 3 AS third, value * CAST('1e-9' AS DOUBLE) AS small,
         value / 7 * CAST('1e15' AS DOUBLE) AS large, -value * CAST('1e18' AS DOUBLE) AS huge, CAST(floor(value) AS DOUBLE) AS whole,
         CASE WHEN event_id % 3 <> 0 THEN value / CAST('1e5' AS DOUBLE) END AS missing FROM events),
h AS (SELECT *, md5(concat_ws(',', CAST(event_id AS VARCHAR), CAST(plain AS VARCHAR), CAST(third AS VARCHAR), CAST(small AS VARCHAR),
                               CAST(large AS VARCHAR), CAST(huge AS VARCHAR), CAST(whole AS VARCHAR),
                               coalesce(CAST(missing AS VARCHAR), 'None'))) AS hx FROM r)
SELECT substr(hx, 1, 8) || '-' || substr(hx, 9, 4) || '-' || substr(hx, 13, 4) || '-' || substr(hx, 17, 4)
       || '-' || substr(hx, 21, 12) AS id, * EXCLUDE (hx) FROM h"""
_ORACLE["quarantined_price_docs"] = _ORACLE["stream_quarantine"] = f"""WITH {_FIXTURE_CTES},
hours AS (SELECT coin, count(DISTINCT floor(epoch(CAST(date_time AS TIMESTAMP)) / 3600)) AS n FROM coin_prices GROUP BY coin)
SELECT coin, 'loaded' AS outcome, count(*) AS n
FROM (SELECT DISTINCT {_PRICE_ROW_COLS} FROM coin_prices) GROUP BY coin
UNION ALL
SELECT coin, unnest(['{PR.NOT_JSON}', '{PR.NO_PRICES}', '{PR.UNEQUAL}']), n FROM hours"""
_ORACLE["sourced_price_docs"] = _ORACLE["price_docs_exploded"]
_ORACLE["sourced_price_stream"] = f"""WITH {_FIXTURE_CTES}
SELECT DISTINCT {_PRICE_ROW_COLS} FROM coin_prices
WHERE substr(date_time, 1, 10) < (SELECT max(substr(date_time, 1, 10)) FROM coin_prices)"""
_ORACLE["sourced_trades"] = f"WITH {_FIXTURE_CTES}\nSELECT {_TRADE_COLS} FROM trades"
_BACKFILLED = f"""WITH {_FIXTURE_CTES},
staged_trades AS (
  SELECT DISTINCT {_TRADE_COLS} FROM trades
  WHERE buy_token = 'WETH' AND sell_token = 'USDC' AND block_date >= DATE '2024-01-01' AND block_date < DATE '{AS_OF}'),
staged_prices AS (
  SELECT DISTINCT {_PRICE_ROW_COLS} FROM coin_prices
  WHERE coin IN ('ethereum', 'usd-coin') AND date_time BETWEEN '2024-01-01 00:00:00' AND '2024-01-14 23:59:59')"""
_ORACLE["resumed_backfill_gap"] = _ORACLE["backfill_price_gap"]
_ORACLE["backfill_ledger"] = _BACKFILLED + f""",
days AS (SELECT unnest(generate_series(0, 13)) AS i),
windows AS (SELECT DATE '2024-01-01' + CAST(min(i) AS INTEGER) AS first_day, DATE '2024-01-01' + CAST(max(i) AS INTEGER) AS last_day
            FROM days GROUP BY i // {WINDOW_DAYS}),
w AS (
  SELECT first_day, last_day,
         (SELECT count(*) FROM trades t WHERE buy_token = 'WETH' AND sell_token = 'USDC' AND block_date BETWEEN first_day AND last_day) AS trade_rows,
         (SELECT count(*) FROM staged_trades t WHERE block_date BETWEEN first_day AND last_day) AS new_trades,
         (SELECT count(*) FROM coin_prices p WHERE coin IN ('ethereum', 'usd-coin')
            AND CAST(substr(date_time, 1, 10) AS DATE) BETWEEN first_day AND last_day) AS price_rows,
         (SELECT count(*) FROM staged_prices p WHERE CAST(substr(date_time, 1, 10) AS DATE) BETWEEN first_day AND last_day) AS new_prices
  FROM windows)
SELECT first_day, last_day, CAST(CASE WHEN DATE '{DEAD_DAY}' BETWEEN first_day AND last_day THEN 2 ELSE 1 END AS BIGINT) AS attempts,
       'done' AS state, trade_rows, new_trades, price_rows, new_prices FROM w"""
_ORACLE["published_headline_totals"] = _BACKFILLED + ", " + _SUMMARY_CTE.replace("FROM trades", "FROM staged_trades") + """
SELECT CAST(sum(no_txn) AS BIGINT) AS no_trades,
       CAST(round_even(sum(total_units_bought), 0) AS BIGINT) AS units_bought,
       CAST(round_even(sum(total_units_sold), 0) AS BIGINT) AS units_sold,
       CAST(round_even(sum(total_usd_value_sold), 0) AS BIGINT) AS value_sold,
       CAST(round_even(sum(total_usd_value_bought), 0) AS BIGINT) AS value_bought,
       CAST(0 AS BIGINT) AS tables_left
FROM summary"""
_ORACLE["drifted_loads"] = """WITH r AS (
  SELECT event_id, CAST(user_id AS BIGINT) AS user_id, CASE WHEN event_id % 2 = 0 THEN floor(value) ELSE value END AS amount,
         CASE WHEN event_id % 2 <> 0 THEN event_type END AS kind FROM events),
h AS (SELECT *, md5(concat_ws(',', coalesce(CAST(event_id AS VARCHAR), 'None'), coalesce(CAST(user_id AS VARCHAR), 'None'),
             coalesce(CASE WHEN amount = floor(amount) THEN CAST(CAST(amount AS BIGINT) AS VARCHAR) ELSE CAST(amount AS VARCHAR) END, 'None'),
             'kind=' || kind)) AS hx FROM r)
SELECT DISTINCT substr(hx, 1, 8) || '-' || substr(hx, 9, 4) || '-' || substr(hx, 13, 4) || '-' || substr(hx, 17, 4)
       || '-' || substr(hx, 21, 12) AS id, * EXCLUDE (hx) FROM h"""
_ORACLE["bucketed_id_load"] = "SELECT DISTINCT event_id, CAST(user_id AS BIGINT) AS user_id, event_type AS kind FROM events"
_ORACLE["incremental_price_gap"] = _ORACLE["materialized_price_gap"]
_ORACLE["incremental_summary"] = _ORACLE["materialized_summary"]


# --------------------------------------------------------------------------- optional parts

# The training-data operators may be absent, and with them or alone their pipeline, which needs
# them; the rest works without them.  Only their absence is handled: an import error inside them
# is raised.
_llm = importlib.util.find_spec("tradelens.llm")
# A folder left behind without its modules has no file of its own.
if _llm is not None and _llm.origin is not None:
    from tradelens.llm import queries as _LLM
    _QUERIES.update(_LLM.QUERIES)
    _ORACLE.update(_LLM.ORACLE_SQL)
    if importlib.util.find_spec("corpus_pipeline") is not None:
        import corpus_pipeline as _CP
        _QUERIES["pipeline"] = _CP.run
        if _CP.ORACLE_SQL is not None:
            _ORACLE["pipeline"] = _CP.ORACLE_SQL


# --------------------------------------------------------------------------- contract

def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the daily price gap per token on sf0.001."""
    return _QUERIES["price_gap_daily"](spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in _ORACLE.items() if k in _QUERIES}


if __name__ == "__main__":  # pragma: no cover
    entry(_session.build_session()).show()
