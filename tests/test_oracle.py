"""Every registered query against its DuckDB oracle on sf0.001 (the driver uses sf0.01)."""

import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ["events"]
# The queries of the optional training-data package have their own tests.
NAMES = sorted(n for n in E.queries() if not re.match(r"op\d+_|pipeline$", n))


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    yield c
    c.close()


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql())


# Spark simple type names -> DuckDB type names of the same values.
_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
          "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    """Rows, column names and types equal the oracle's, and no Python runs in the plan."""
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    want = [tuple(_norm(r[ocols.index(c)]) for c in cols) for r in cur.fetchall()]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)

    spark_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    rel = con.sql(E.oracle_sql()[name])
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}

    plan = df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    for marker in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow"):
        assert marker not in plan


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "token", "avg_price_difference"]
    assert df.count() > 0
