"""Update, delete and merge in place: equal to the whole-table forms, and files of other partitions stay."""

import glob
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kiln.operators import partitioned, tables
from kiln.session import scratch_path

DDL = "k long, v int, p string"


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def folders(path):
    return {f.rsplit("/", 1)[0].rsplit("p=", 1)[1] for f in files(path)}


def unchanged(before, after):
    return {f.rsplit("/", 1)[0].rsplit("p=", 1)[1] for f, t in before.items() if after.get(f) == t}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def table(spark, scratch):
    df = spark.range(200).select(
        F.col("id").alias("k"), (F.col("id") % 50).cast("int").alias("v"), F.expr("CASE WHEN id % 5 < 4 THEN concat('p /=', id % 5) END AS p")
    )
    path = partitioned.write_partitioned(df, f"{scratch}/t", ["p"])
    schema = spark.createDataFrame([], DDL).schema
    return path, schema, spark.createDataFrame(df.collect(), schema)


def now(spark, table):
    return rows(partitioned.read_partitioned(spark, table[0], table[1]))


def test_delete_touches_one_partition(spark, table):
    path, schema, df = table
    before = files(path)
    cond = "p = 'p /=1' AND v < 20"
    assert partitioned.delete_files(spark, path, schema, cond, ["p"]) == 1
    assert now(spark, table) == rows(tables.delete(df, cond))
    assert unchanged(before, files(path)) == {"p %2F%3D0", "p %2F%3D2", "p %2F%3D3", "__HIVE_DEFAULT_PARTITION__"}
    assert partitioned.delete_files(spark, path, schema, cond, ["p"]) == 0  # again: nothing to do


def test_delete_of_whole_partitions_and_of_all(spark, table):
    path, schema, df = table
    before = files(path)
    assert partitioned.delete_files(spark, path, schema, "p = 'p /=1' OR p IS NULL", ["p"]) == 2
    assert folders(path) == {"p %2F%3D0", "p %2F%3D2", "p %2F%3D3"} == unchanged(before, files(path))
    partitioned.delete_files(spark, path, schema, F.lit(True), ["p"])
    assert files(path) == {} and now(spark, table) == []


def test_null_condition_changes_nothing(spark, table):
    path, schema, df = table
    before = files(path)
    assert partitioned.delete_files(spark, path, schema, "p > NULL", ["p"]) == 0
    assert partitioned.update_files(spark, path, schema, "v > NULL", {"v": F.lit(0)}, ["p"]) == 0
    assert files(path) == before


def test_update_moves_rows_and_keeps_those_that_are_there(spark, table):
    path, schema, df = table
    before = files(path)
    cond, values = "p = 'p /=2' OR (p IS NULL AND v = 4)", {"p": F.lit("p /=3"), "v": F.col("v") + 1}
    assert partitioned.update_files(spark, path, schema, cond, values, ["p"]) == 3
    assert now(spark, table) == rows(tables.update(df, cond, values))
    assert unchanged(before, files(path)) == {"p %2F%3D0", "p %2F%3D1"} and "p %2F%3D2" not in folders(path)


def test_merge_moves_changes_and_inserts(spark, table):
    path, schema, df = table
    before = files(path)
    source = spark.createDataFrame([(0, "new"), (5, "p /=0"), (6, "p /=0"), (900, "p /=0"), (None, None)], "k long, p string")
    want = rows(tables.merge(df, source, "k"))
    got = partitioned.merge_files(spark, path, schema, source, "k", ["p"])
    assert got == schema and now(spark, table) == want
    assert unchanged(before, files(path)) == {"p %2F%3D2", "p %2F%3D3"}
    partitioned.merge_files(spark, path, schema, source.where("k IS NOT NULL"), "k", ["p"])
    assert now(spark, table) == want  # again: the same


def test_merge_refuses_and_leaves_all_as_it_was(spark, table):
    path, schema, df = table
    before = files(path)
    twice = spark.createDataFrame([(1, 1, "a"), (1, 2, "a")], DDL)
    with pytest.raises(Exception, match="several source rows"):
        partitioned.merge_files(spark, path, schema, twice, "k", ["p"])
    for ddl, row in (("k long, v int", (1, 1)), ("k long, p string, x int", (1, "a", 1)), ("k string, p string", ("1", "a"))):
        with pytest.raises(tables.SchemaMismatchError):
            partitioned.merge_files(spark, path, schema, spark.createDataFrame([row], ddl), "k", ["p"])
    assert files(path) == before
    wide = partitioned.merge_files(spark, path, schema, spark.createDataFrame([(1, "p /=1", 7)], "k long, p string, x int"), "k", ["p"], evolve=True)
    assert wide.names == ["k", "v", "p", "x"]
    assert rows(partitioned.read_partitioned(spark, path, wide).where("x IS NOT NULL")) == [(1, 1, "p /=1", 7)]


def test_merge_by_partition_key_reads_its_partitions_only(spark, scratch):
    df = spark.range(100).select((F.col("id") % 10).alias("day"), F.col("id").alias("n"))
    path = partitioned.write_partitioned(df.dropDuplicates(["day"]), f"{scratch}/t", ["day"])
    schema = spark.createDataFrame([], "day long, n long").schema
    for other in glob.glob(f"{path}/day=7/*.parquet"):
        with open(other, "wb") as f:
            f.write(b"not a file that can be read")
    partitioned.merge_files(spark, path, schema, spark.createDataFrame([(3, 333), (11, 11)], schema), "day", ["day"])
    got = partitioned.read_partitioned(spark, path, schema).where("day <> 7")
    assert sorted(r["n"] for r in got.where("day IN (3, 11)").collect()) == [11, 333]


def test_two_partition_columns(spark, scratch):
    ddl = "k long, a string, b int"
    df = spark.createDataFrame([(i, "xy"[i % 2], i % 3) for i in range(30)], ddl)
    path = partitioned.write_partitioned(df, f"{scratch}/t", ["a", "b"])
    before = files(path)
    assert partitioned.update_files(spark, path, df.schema, "a = 'x' AND b = 1", {"b": F.lit(2)}, ["a", "b"]) == 2
    assert rows(partitioned.read_partitioned(spark, path, df.schema)) == rows(tables.update(df, "a = 'x' AND b = 1", {"b": F.lit(2)}))
    after = files(path)
    assert sum(after.get(f) == t for f, t in before.items()) == 4


def test_hot_partition_is_written_by_many_tasks(spark, scratch):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        df = spark.range(60_000).select(F.col("id").alias("k"), F.xxhash64("id").alias("v"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("p"))
        path = partitioned.write_partitioned(df.repartition(16), f"{scratch}/t", ["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{path}/p=hot/*.parquet")) > 4


changes = st.lists(st.tuples(st.integers(0, 12), st.sampled_from(["a", "b", "c", None])), max_size=6, unique_by=lambda x: x[0])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.sampled_from(["a", "b", None])), min_size=1, max_size=8), changes)
def test_merge_equals_whole_table_form(spark, have, source):
    ddl = "k long, p string"
    df, src = spark.createDataFrame(have, ddl), spark.createDataFrame(source, ddl)
    path = partitioned.write_partitioned(df, scratch_path(spark, "prop"), ["p"])
    partitioned.merge_files(spark, path, df.schema, src, "k", ["p"])
    assert rows(partitioned.read_partitioned(spark, path, df.schema)) == rows(tables.merge(df, src, "k"))
