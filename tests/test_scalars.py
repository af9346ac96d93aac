"""Hand-made edge rows (FIXTURES.md §4) for the scalar helpers and identity."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tradelens.functions import identity as I
from tradelens.functions import naming as N
from tradelens.functions import scalars as S


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_hour_key_12h_folds_am_pm(spark):
    df = spark.createDataFrame([("2024-01-05 03:10:00",), ("2024-01-05 15:20:00",), ("2024-01-05 00:31:00",),
                                ("2024-01-05 12:31:00",)], "t string")
    rows = df.select(S.hour_key("t", "12h").alias("k12"), S.hour_key("t", "24h").alias("k24")).collect()
    assert [r.k12 for r in rows] == ["2024-01-05 03:00", "2024-01-05 03:00", "2024-01-05 12:00", "2024-01-05 12:00"]
    assert [r.k24 for r in rows] == ["2024-01-05 03:00", "2024-01-05 15:00", "2024-01-05 00:00", "2024-01-05 12:00"]


@pytest.mark.parametrize("mode", ["12h", "24h"])
def test_hour_key_and_slot_match_the_text_format(spark, mode):
    """The key equals strftime's %I (12h) / %H (24h) text, and slots are a bijection with it."""
    start = dt.datetime(1969, 12, 30, 0, 0)
    df = spark.range(0, 26 * 24 * 60, 37).select(
        F.timestamp_add("MINUTE", F.col("id"), F.lit(start).cast("timestamp_ntz")).alias("t"))
    got = df.select("t", S.hour_key("t", mode).alias("k"), S.hour_slot("t", mode).alias("s")).collect()
    fmt = "%Y-%m-%d %I:00" if mode == "12h" else "%Y-%m-%d %H:00"
    assert all(r.k == r.t.strftime(fmt) for r in got)
    pairs = {(r.k, r.s) for r in got}
    assert len({k for k, _ in pairs}) == len({s for _, s in pairs}) == len(pairs)


def test_keys_do_not_depend_on_the_session_zone(spark):
    """A wall-clock time that a DST change skips keeps its hour in any session zone."""
    df = spark.createDataFrame([("2024-03-10 02:30:00",)], "t string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        r = df.select(S.hour_key("t", "24h").alias("k"), S.day_key("t").alias("d"),
                      S.unix_ms_to_text(S.to_unix_seconds("t") * 1000).alias("u")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (r.k, r.d, r.u) == ("2024-03-10 02:00", "2024-03-10", "2024-03-10 02:30:00")


def test_zone_suffix_is_dropped(spark):
    assert one(spark, S.to_ts(F.lit("2024-10-12 00:03:11.000 UTC"))) == dt.datetime(2024, 10, 12, 0, 3, 11)


def test_unknown_coin_maps_to_null(spark):
    df = spark.createDataFrame([("ethereum",), ("usd-coin",), ("other",)], "coin string")
    assert [r.t for r in df.select(S.coin_to_token("coin").alias("t")).collect()] == ["WETH", "USDC", None]


def test_gap_formulas(spark):
    assert one(spark, S.price_gap(F.lit(3.0), F.lit(1.0))) == 25.0
    assert one(spark, S.price_gap(F.lit(3.0), F.lit(1.0), "symmetric_pct")) == 100.0


def test_zero_sum_raises_in_default_mode(spark):
    with pytest.raises(PySparkException):
        spark.range(1).select(S.price_gap(F.lit(0.0), F.lit(0.0))).collect()


def test_half_even(spark):
    assert one(spark, S.round_half_even(F.lit(2.5))) == 2
    assert one(spark, S.round_half_even(F.lit(3.5))) == 4


def test_ms_to_text_and_back(spark):
    assert one(spark, S.unix_ms_to_text(F.lit(1728691391999))) == "2024-10-12 00:03:11"
    assert one(spark, S.to_unix_seconds(F.lit("2024-10-12 00:03:11"))) == 1728691391


def test_month_start_and_previous_day(spark):
    assert one(spark, S.month_start_text(F.lit(dt.date(2024, 1, 15)))) == "2024-01-01"
    assert one(spark, S.days_before(F.lit(dt.date(2024, 3, 1)), 1)) == dt.date(2024, 2, 29)


def test_uuid_text_matches_python(spark):
    import hashlib
    import uuid
    expect = str(uuid.UUID(hex=hashlib.md5("a,b".encode()).hexdigest()))
    assert one(spark, I.uuid_text(F.md5(F.lit("a,b")))) == expect


def test_row_id_null_text_and_comma_collision(spark):
    df = spark.createDataFrame([("a,b", "c"), ("a", "b,c"), ("x", None), ("x", "None")], "p string, q string")
    ids = [r.id for r in I.with_row_id(df).collect()]
    assert ids[0] == ids[1]            # documented collision
    assert ids[2] == ids[3]            # NULL is hashed as the text 'None'
    import hashlib
    import uuid
    assert ids[2] == str(uuid.UUID(hex=hashlib.md5(b"x,None").hexdigest()))


def test_row_id_boolean_text(spark):
    df = spark.createDataFrame([(True, 1), (False, 2)], "b boolean, n long")
    import hashlib
    import uuid
    got = [r.id for r in I.with_row_id(df).collect()]
    assert got == [str(uuid.UUID(hex=hashlib.md5(t.encode()).hexdigest())) for t in ("True,1", "False,2")]


def test_clean_column_names():
    assert [N.clean_column_name(i, c) for i, c in enumerate(["Unnamed: 0", " Block Date ", "TX Hash"])] == \
        ["column_0", "block_date", "tx_hash"]
    assert N.clean_schema_name(" Data Warehouse ") == "data_warehouse"


def test_staging_types(spark):
    df = spark.createDataFrame([(1, 2.5, True, ["a"], "x", dt.date(2024, 1, 1))],
                               "i int, f float, b boolean, a array<string>, s string, d date")
    assert [t for _, _, t in N.staging_type_report(df)] == \
        ["UUID PRIMARY KEY", "BIGINT", "FLOAT", "BOOLEAN", "TEXT[]", "TEXT", "TEXT"]
    typed = N.staging_types(df)
    assert [f.dataType.simpleString() for f in typed.schema.fields] == \
        ["bigint", "double", "boolean", "array<string>", "string", "string"]
    assert typed.first()["d"] == "2024-01-01"
