"""Floats in hashed rows are printed as Python prints them."""

import hashlib
import math
import random
import struct
import uuid

import pytest
from pyspark.sql import functions as F

from tradelens.functions.identity import float_texts, with_row_id

EDGES = [0.1, 1e-05, 1e7, 12345678.9, 1e16, 1e15, 9999999999999998.0, 123456789012345680.0, 0.0001, 0.00012345, 9.5e-05, 0.0, -0.0,
         1e22, 1e23, 2e23, 8.41e21, 9.3e-5, 5e-324, 4.9e-323, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308,
         1 / 3, 2 / 3, 100.0, 1e100, -1.5e-7, 2.0e-3, 1.1, 0.30000000000000004, 4.35, 1e-4, 999999.9999999999, 9007199254740993.0,
         float("nan"), float("inf"), float("-inf")]


def _texts(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double").repartition(4)
    return [r[1] for r in sorted(df.select("i", float_texts([F.col("x")])[0]).collect())]


def test_edges(spark):
    assert _texts(spark, EDGES + [None]) == [str(x) for x in EDGES] + [None]


@pytest.mark.parametrize("kind", ["bits", "whole", "decimal", "quotient", "power"])
def test_many(spark, kind):
    rng = random.Random(kind)
    make = {"bits": lambda: struct.unpack("<d", rng.randbytes(8))[0], "whole": lambda: float(rng.randint(2**52, 2**64)),
            "decimal": lambda: round(rng.uniform(-1e4, 1e4), rng.randint(0, 12)),
            "quotient": lambda: rng.randint(1, 10**6) / rng.randint(1, 10**6) * 10.0 ** rng.randint(-12, 22),
            "power": lambda: float(f"{rng.randint(1, 10**rng.randint(1, 17))}e{rng.randint(-320, 290)}")}[kind]
    values = [v for v in (make() for _ in range(20_000)) if not math.isnan(v)]
    got = _texts(spark, values)
    assert [(g, v) for g, v in zip(got, values) if g != str(v)] == []


def test_ids_equal_those_of_rows_hashed_in_python(spark):
    rows = [("a", 1e-05, True, 3), ("b", 1e7, None, None), ("c", 0.1, False, 5), ("d", None, True, 0), ("e", 1 / 3, None, 7)]
    df = spark.createDataFrame(rows, "s string, x double, b boolean, n bigint")
    want = {r[0]: str(uuid.UUID(hex=hashlib.md5(",".join(map(str, r)).encode()).hexdigest())) for r in rows}
    assert {r.s: r.id for r in with_row_id(df).collect()} == want


def test_single_precision_by_its_own_shortest_text(spark):
    df = spark.createDataFrame([(0.1,), (16777216.0,), (1e-7,)], "x double").select(F.col("x").cast("float").alias("x"))
    want = [str(uuid.UUID(hex=hashlib.md5(t.encode()).hexdigest())) for t in ("0.1", "16777216.0", "1e-07")]
    assert sorted(r.id for r in with_row_id(df).collect()) == sorted(want)
