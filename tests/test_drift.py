"""Loads whose columns change from one to the next."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelens.functions.identity import with_row_id
from tradelens.session import scratch_path
from tradelens.sinks import drift as DR


@pytest.fixture
def table(spark):
    return DR.DriftingTable(spark, scratch_path(spark, "drift-test"))


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_columns_widen_and_join_and_rows_keep_their_ids(spark, table):
    first = spark.createDataFrame([(1, "x"), (2, None), (None, "z")], "`Amount ` int, Kind string")
    assert DR.load_drifting(spark, first, table).inserted_rows == 3
    ids = {r.id for r in table.read().select("id").collect()}
    plain = first.select(F.col("`Amount `").cast("long").alias("amount"), F.col("Kind").alias("kind"))
    assert ids == {r.id for r in with_row_id(plain).collect()}

    second = spark.createDataFrame([(2.5, "x", True), (1.0, "x", None), (1.0, "x", False)], "amount double, kind string, flag boolean")
    report = DR.load_drifting(spark, second, table)
    assert (report.total_rows, report.inserted_rows) == (3, 2)          # 1.0, x, null is the row of before
    assert rows(table.read(), "amount", "kind", "flag") == sorted(
        [(1.0, "x", None), (2.0, None, None), (None, "z", None), (2.5, "x", True), (1.0, "x", False)], key=str)
    assert ids < {r.id for r in table.read().select("id").collect()}

    # The frame of before, in the layout of before: nothing is new, and no version is opened.
    assert DR.load_drifting(spark, first, table).inserted_rows == 0
    assert len(table.versions()) == 2
    # A column is gone, and the new one alone comes with another order of the columns.
    third = spark.createDataFrame([(True, 9)], "flag boolean, amount int")
    assert DR.load_drifting(spark, third, table).inserted_rows == 1
    assert (9.0, None, True) in rows(table.read(), "amount", "kind", "flag") and len(table.versions()) == 2


def test_added_column_widens_in_its_turn(spark, table):
    DR.load_drifting(spark, spark.createDataFrame([(1,)], "a int"), table)
    DR.load_drifting(spark, spark.createDataFrame([(1, 7)], "a int, b int"), table)
    DR.load_drifting(spark, spark.createDataFrame([(1, 7.0), (1, 7.5)], "a int, b double"), table)
    assert rows(table.read(), "a", "b") == [(1, 7.0), (1, 7.5), (1, None)]
    assert [s.simpleString() for s in table.versions()] == [
        "struct<id:string,a:bigint>", "struct<id:string,a:bigint,b:bigint>", "struct<id:string,a:bigint,b:double>"]


def test_a_text_that_spells_an_added_column_is_no_repeat(spark, table):
    DR.load_drifting(spark, spark.createDataFrame([("x",)], "a string"), table)
    more = spark.createDataFrame([("x", "1", None), ("x", None, "1"), ("x", "", None)], "a string, b string, c string")
    assert DR.load_drifting(spark, more, table).inserted_rows == 3


@pytest.mark.parametrize("ddl, row, reason", [
    ("a string", ("x",), "a: bigint cannot become string"),
    ("a boolean", (True,), "a: bigint cannot become boolean"),
    ("`b` int, ` B ` int", (1, 2), "b: 2 columns of this name"),
    ("a array<int>", ([1],), "a: bigint cannot become array<string>")])
def test_other_changes_are_refused_and_write_nothing(spark, table, ddl, row, reason):
    DR.load_drifting(spark, spark.createDataFrame([(1,)], "a int"), table)
    with pytest.raises(DR.SchemaDrift) as e:
        DR.load_drifting(spark, spark.createDataFrame([row], ddl), table)
    assert e.value.reasons == [reason]
    assert len(table.versions()) == 1 and table.read().count() == 1


def test_integers_that_a_double_would_merge_are_refused(spark, table):
    big = 2**53 + 1
    DR.load_drifting(spark, spark.createDataFrame([(1, big)], "a long, b long"), table)
    with pytest.raises(DR.SchemaDrift, match="b: integers beyond 2\\^53 in the table"):
        DR.load_drifting(spark, spark.createDataFrame([(1.5, 2.5)], "a double, b double"), table)
    DR.load_drifting(spark, spark.createDataFrame([(1.5, 3)], "a double, b long"), table)
    with pytest.raises(DR.SchemaDrift, match="a: integers beyond 2\\^53 in the frame"):
        DR.load_drifting(spark, spark.createDataFrame([(-big, 3)], "a long, b long"), table)
    assert rows(table.read(), "a", "b") == [(1.0, big), (1.5, 3)]


def test_merged_schema_names_every_reason():
    old = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    new = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType()), T.StructField("c", T.LongType())])
    with pytest.raises(DR.SchemaDrift) as e:
        DR.merged_schema(old, new)
    assert e.value.reasons == ["a: bigint cannot become string", "b: string cannot become bigint"]


def test_empty_frames_and_filters_that_reach_every_version(spark, table):
    empty = spark.createDataFrame([], "a int, b string")
    assert DR.load_drifting(spark, empty, table).inserted_rows == 0 and not table.exists()
    DR.load_drifting(spark, spark.createDataFrame([(1, "p"), (2, "q")], "a int, b string"), table)
    DR.load_drifting(spark, spark.createDataFrame([(0.5, "q", 1)], "a double, b string, c int"), table)
    DR.load_drifting(spark, spark.createDataFrame([], "a double, d int"), table)
    assert len(table.versions()) == 2
    found = table.read().where("b = 'q'").select("a")
    plan = found._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert plan.count("PushedFilters: [IsNotNull(b), EqualTo(b,q)]") == 2 and "c:" not in plan
    assert rows(found, "a") == [(0.5,), (2.0,)]
