"""Append, update, delete and merge over DataFrames and Parquet directories."""

import pytest
from pyspark.sql import functions as F

from kiln.operators import tables

SCHEMA = "k long, v int, s string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def table(spark):
    return spark.createDataFrame([(1, 10, "a"), (2, None, "b"), (None, 30, "c"), (4, 40, None)], SCHEMA)


def test_append_checks_types_without_nullability(spark, scratch):
    arrays = spark.range(3).select("id", F.array(F.lit("x"), F.lit("y")).alias("a"), F.struct(F.lit(1).alias("p")).alias("st"))
    arrays.write.parquet(scratch)
    back = spark.read.parquet(scratch)  # everything may be NULL in what is read back
    assert tables.append(arrays, back).count() == 6
    tables.append_files(spark, scratch, arrays.schema, back)
    assert spark.read.schema(arrays.schema).parquet(scratch).count() == 6


def test_append_rejects_and_evolves(spark, table, scratch):
    wider = spark.createDataFrame([(9, 1, "z", True)], SCHEMA + ", closed boolean")
    with pytest.raises(tables.SchemaMismatchError):
        tables.append(table, wider)
    with pytest.raises(tables.SchemaMismatchError):
        tables.append(table, spark.createDataFrame([("9",)], "k string"), evolve=True)
    out = tables.append(table, wider, evolve=True)
    assert out.columns == ["k", "v", "s", "closed"] and out.where("closed").count() == 1 and out.count() == 5
    table.write.parquet(scratch)
    schema = tables.append_files(spark, scratch, table.schema, wider, evolve=True)
    assert rows(spark.read.schema(schema).parquet(scratch)) == rows(out)


def test_append_evolves_a_struct(spark):
    have = spark.createDataFrame([(1, (2,))], "k int, st struct<p:int>")
    more = spark.createDataFrame([(1, (2, "x"))], "k int, st struct<p:int,q:string>")
    with pytest.raises(tables.SchemaMismatchError):
        tables.append(have, more)
    assert [r["st"]["q"] for r in tables.append(have, more, evolve=True).collect()] == [None, "x"]


def test_update_and_delete_are_three_valued(table):
    got = tables.update(table, F.col("v") >= 30, {"s": F.lit("new"), "v": F.col("v") + 1})
    assert rows(got) == rows_of((1, 10, "a"), (2, None, "b"), (None, 31, "new"), (4, 41, "new"))
    assert rows(tables.delete(table, "v >= 30")) == rows_of((1, 10, "a"), (2, None, "b"))


def rows_of(*r):
    return sorted(r, key=repr)


def test_merge_null_and_duplicate_keys(spark, table):
    source = spark.createDataFrame([(1, 11, "A"), (None, 0, "N"), (7, 70, "x"), (7, 71, "y")], SCHEMA)
    got = tables.merge(table, source, "k")  # doubled key 7 matches no row: both are inserted
    assert rows(got) == rows_of((2, None, "b"), (None, 30, "c"), (4, 40, None), (1, 11, "A"), (None, 0, "N"), (7, 70, "x"), (7, 71, "y"))
    clash = spark.createDataFrame([(1, 11, "A"), (1, 12, "B")], SCHEMA)
    with pytest.raises(Exception, match="several source rows"):
        tables.merge(table, clash, "k").collect()
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(tables.merge(table, empty, "k")) == rows(table)
    assert rows(tables.merge(empty, source, "k")) == rows(source)


def test_merge_against_a_dictionary(spark):
    have = spark.range(0, 2000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("int").alias("v"), F.lit("t").alias("s"))
    source = spark.range(1500, 2500, 3).select(F.col("id").alias("k"), F.lit(1).alias("v"), F.lit("u").alias("s"))
    expect = {i: "t" for i in range(2000)} | {i: "u" for i in range(1500, 2500, 3)}
    assert {r["k"]: r["s"] for r in tables.merge(have, source, "k").collect()} == expect


# ------------------------------------------------------- what the files say


def test_append_is_held_against_the_files(spark, scratch):
    spark.createDataFrame([("1", 1.0)], "loan_id string, Paid double").write.parquet(scratch)
    before = spark.read.parquet(scratch).collect()
    for ddl, row in (("loan_id long", (2,)), ("Loan_ID string", ("2",)), ("loan_id string, paid double", ("2", 2.0))):
        rows_ = spark.createDataFrame([row], ddl)
        with pytest.raises(tables.SchemaMismatchError):
            tables.append_files(spark, scratch, rows_.schema, rows_, evolve=True)
    assert spark.read.parquet(scratch).collect() == before  # nothing was written
    stale = spark.createDataFrame([], "loan_id string").schema
    got = tables.append_files(spark, scratch, stale, spark.createDataFrame([("3",)], "loan_id string"))
    assert got.names == ["loan_id", "Paid"]  # the files know a column that the caller did not


def test_stored_schema(spark, scratch):
    assert tables.stored_schema(spark, f"{scratch}/none") is None
    spark.createDataFrame([(1, (2,))], "a int, st struct<p:int>").write.parquet(scratch)
    spark.createDataFrame([(1, (2, "x"), True)], "a int, st struct<p:int,q:string>, b boolean").write.mode("append").parquet(scratch)
    assert tables.stored_schema(spark, scratch).simpleString() == "struct<a:int,st:struct<p:int,q:string>,b:boolean>"
    spark.createDataFrame([("x",)], "a string").write.mode("append").parquet(scratch)
    with pytest.raises(tables.SchemaMismatchError):
        tables.stored_schema(spark, scratch)


def test_merge_keeps_what_the_source_does_not_say(spark, table):
    source = spark.createDataFrame([(1, "z"), (9, "new")], "k long, s string")
    got = tables.merge(table, source, "k")
    assert rows(got) == rows_of((1, 10, "z"), (2, None, "b"), (None, 30, "c"), (4, 40, None), (9, None, "new"))
    overwritten = tables.merge(table, spark.createDataFrame([(1, None, None)], SCHEMA), "k")
    assert (1, None, None) in rows(overwritten)  # a NULL that the source does say
    wider = spark.createDataFrame([(1, "z", True)], "k long, s string, extra boolean")
    with pytest.raises(tables.SchemaMismatchError):
        tables.merge(table, wider, "k")
    assert rows(tables.merge(table, wider, "k", evolve=True).where("extra").drop("extra")) == [(1, 10, "z")]
    for ddl, row in (("k long, v string", (1, "1")), ("k string", ("1",)), ("k long, V int", (1, 1))):
        with pytest.raises(tables.SchemaMismatchError):
            tables.merge(table, spark.createDataFrame([row], ddl), "k", evolve=True)


def test_merge_changes_each_matched_row_in_place(spark):
    have = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 3, "c")], SCHEMA)
    got = tables.merge(have, spark.createDataFrame([(1, "new")], "k long, s string"), "k")
    assert rows(got) == rows_of((1, 1, "new"), (1, 2, "new"), (2, 3, "c"))
