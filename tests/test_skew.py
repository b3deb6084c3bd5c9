"""Joins and ranks in which one key holds a third of the rows, and malformed text."""

import glob
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kiln.operators import bucketed, relational as rel
from kiln.plans.inspect import plan_text
from kiln.sources import files


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def pair(spark):
    left = spark.range(0, 30_000, numPartitions=8).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 1000 == 1, None).otherwise(F.col("id")).alias("k"), F.col("id").alias("a"))
    right = spark.range(0, 20_000, numPartitions=4).select(F.col("id").alias("j"), F.col("id").alias("b"))
    return left, right


def test_bucket_count_follows_the_rows():
    assert [bucketed.bucket_count(n, 100) for n in (0, 1, 100, 101, 200, 201, 1000)] == [1, 1, 1, 2, 2, 4, 16]


def test_hot_keys_are_few(spark, pair):
    hot, total = bucketed.hot_keys(pair[0], "k")
    assert hot == {7: 10_001} and total == 30_000 - pair[0].where("k is null").count()
    assert bucketed.hot_keys(pair[1], "j") == ({}, 20_000)


@pytest.mark.parametrize("swap", [False, True])
def test_bucketed_join_with_a_hot_key(spark, scratch, pair, swap):
    left, right = pair
    args = (right, left, "j", "k") if swap else (left, right, "k", "j")
    want = rows(left.join(right, F.col("k") == F.col("j")).select("k", "a", "j", "b"))
    before = {t.name for t in spark.catalog.listTables()}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with bucketed.bucketed_join(*args, f"{scratch}/b", rows_per_bucket=4000) as joined:
            assert rows(joined.select("k", "a", "j", "b")) == want
            # the bucketed part has no exchange: both are in the part of the hot key
            assert plan_text(joined, "simple").count("Exchange hashpartitioning") == 2
            spread = joined.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
            assert len(spread) >= 6 and max(r["count"] for r in spread) < 0.5 * 10_001
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {t.name for t in spark.catalog.listTables()} == before  # dropped
    assert len(glob.glob(f"{scratch}/b/left/*.parquet")) <= 8  # one file per bucket


def test_bucketed_join_without_hot_keys_and_of_nothing(spark, scratch, pair):
    left, right = pair
    cold = left.where("k <> 7")
    with bucketed.bucketed_join(cold, right, "k", "j", f"{scratch}/cold") as joined:
        assert "Exchange hashpartitioning" not in plan_text(joined, "simple")
        assert rows(joined) == rows(cold.join(right, F.col("k") == F.col("j")))
    with bucketed.bucketed_join(left.limit(0), right, "k", "j", f"{scratch}/none") as joined:
        assert joined.count() == 0
    with pytest.raises(RuntimeError):
        with bucketed.bucketed_join(cold, right, "k", "j", f"{scratch}/fails"):
            raise RuntimeError
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


@pytest.mark.parametrize("descending", [True, False])
def test_top_values_with_ties_nulls_and_a_hot_group(spark, descending):
    g = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 == 1, None).otherwise((F.col("id") % 5).cast("string"))
    v = F.when(F.col("id") % 101 == 0, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(7000)) / 2)
    df = spark.range(30_000).select(g.alias("g"), v.alias("v"), "id")
    order = F.col("v").desc() if descending else F.col("v").asc()
    for k in (3, 2500):
        want = df.withColumn("rank", F.dense_rank().over(Window.partitionBy("g").orderBy(order))).where(F.col("rank") <= k)
        got = rel.top_values_per_group(df, ["g"], "v", k, descending=descending, parts=8)
        assert rows(got) == rows(want)
    assert rel.top_values_per_group(df.limit(0), ["g"], "v", 5).count() == 0


def test_no_rank_window_holds_a_hot_group(spark):
    """k = 5,000 and a group with two thirds of 200,000 rows: windows see distinct values, dealt over the parts first."""
    g = F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string"))
    df = spark.range(200_000).select(g.alias("g"), F.pmod(F.xxhash64("id"), F.lit(150_000)).alias("v"))
    got = rel.top_values_per_group(df, ["g"], "v", 5000)
    upper, lower = re.findall(r"Window \[row_number\(\) windowspecdefinition\((__key0#\d+L?, (?:__part#\d+L?, )?)__value", plan_text(got, "simple"))
    assert "__part" not in upper and "__part" in lower
    assert plan_text(got, "simple").count("HashAggregate(keys=[__key0") == 2  # distinct values, partly so before their shuffle
    assert got.where("g = 'hot'").select("v").distinct().count() == 5000


def test_malformed_lines_are_kept_as_text(spark, scratch):
    lines = ["id,x,name", "1,1.5,a", "2,zz,b", "3,2.5", "4,1,c,more", "99999999999,1,d", '5,,"q,r"', "6,7,", "7,NaN,é"]
    spark.createDataFrame([("\n".join(lines),)], "v string").coalesce(1).write.text(f"{scratch}/in")
    schema = spark.createDataFrame([], "id int, x double, name string").schema
    good, bad = files.split_csv(spark, f"{scratch}/in", schema, f"{scratch}/out")
    assert sorted(r["line"] for r in bad.collect()) == sorted(["2,zz,b", "3,2.5", "4,1,c,more", "99999999999,1,d"])
    assert rows(good.select("id", "name")) == [(1, "a"), (5, "q,r"), (6, None), (7, "é")]
    assert good.schema == schema and all(r["file"] for r in bad.collect())
    assert good.count() + bad.count() == len(lines) - 1
    for part in (good, bad):  # one part's files each
        assert re.search(r"PartitionFilters: \[isnotnull\(_rejected", plan_text(part, "formatted"))


def test_malformed_split_odd_inputs(spark, scratch):
    schema = spark.createDataFrame([], "line int, _line string").schema  # clashing names
    spark.createDataFrame([("1\tx\n\n2y\tz\n",)], "v string").coalesce(1).write.text(f"{scratch}/in")
    good, bad = files.split_csv(spark, f"{scratch}/in", schema, f"{scratch}/out", sep="\t", header=False)
    assert rows(good) == [(1, "x")] and [r["line"] for r in bad.collect()] == ["2y\tz"]
    spark.createDataFrame([], "v string").write.text(f"{scratch}/none")
    good, bad = files.split_csv(spark, f"{scratch}/none", schema, f"{scratch}/out2", header=False)
    assert good.count() == bad.count() == 0
