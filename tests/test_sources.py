"""Readers and writers: inference, declared schemas, malformed cells, formats."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, IntegerType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from conftest import SF_SMALL
from kiln.plans.inspect import plan_text, schema_text
from kiln.sources import files, literal


def test_csv_inference_narrows_and_shape_restores(spark, scratch):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    files.write_csv(ev, scratch)
    inferred = files.read_csv_inferred(spark, scratch)
    assert dict(inferred.dtypes)["event_id"] == "int"
    back = files.shape_like(inferred, ev.schema)
    assert back.schema == ev.schema
    assert back.exceptAll(ev).count() == 0 and ev.exceptAll(back).count() == 0


def test_declared_csv_malformed_cell_is_null(spark, scratch):
    with open_text(spark, scratch, "a,b\n1,x\nnot-a-number,y\n3,\n") as path:
        schema = StructType([StructField("a", IntegerType()), StructField("b", StringType())])
        got = [tuple(r) for r in files.read_csv_declared(spark, path, schema).collect()]
    assert got == [(1, "x"), (None, "y"), (3, None)]


def test_all_string_read_then_cast(spark, scratch):
    with open_text(spark, scratch, "delay,distance\n12,x\n,7\n") as path:
        raw = files.read_csv_text(spark, path)
        assert [t for _, t in raw.dtypes] == ["string", "string"]
        got = [tuple(r) for r in files.cast_columns(raw, {"delay": "int", "distance": "int"}).collect()]
    assert got == [(12, None), (None, 7)]


def test_tsv_inferred(spark, scratch):
    with open_text(spark, scratch, "City\tState\tIATA\nSeattle\tWA\tSEA\n") as path:
        df = files.read_tsv_inferred(spark, path)
    assert df.columns == ["City", "State", "IATA"] and df.first()["IATA"] == "SEA"


def test_json_inferred_columns_in_name_order(spark, scratch):
    with open_text(spark, scratch, '{"z": 1, "a": "x"}\n{"z": 2, "a": "y"}\n', name="j.json") as path:
        df = files.read_json(spark, path)
    assert df.columns == ["a", "z"] and dict(df.dtypes)["z"] == "bigint"


def test_json_declared_array(spark, scratch):
    with open_text(spark, scratch, '{"Id": 1, "Campaigns": ["twitter", "LinkedIn"]}\n{"Id": 2}\n', name="b.json") as path:
        schema = StructType([StructField("Id", IntegerType(), False), StructField("Campaigns", ArrayType(StringType()), False)])
        df = files.read_json(spark, path, schema)
        got = [(r["Id"], r["Campaigns"]) for r in df.orderBy("Id").collect()]
    assert got == [(1, ["twitter", "LinkedIn"]), (2, None)]
    # file sources read declared non-null fields as nullable
    assert all(f.nullable for f in df.schema.fields)
    assert "Campaigns: array" in schema_text(df)


def test_timestamp_text_round_trip_keeps_micros(spark, scratch):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),)], "ts timestamp_ntz")
    files.write_json(df, scratch)
    back = files.shape_like(files.read_json(spark, scratch), df.schema)
    assert back.first()["ts"] == dt.datetime(2024, 1, 1, 0, 0, 7, 179575)


def test_sorted_write_is_ordered(spark, scratch):
    df = spark.range(0, 5000, numPartitions=4).select((F.col("id") * 7919 % 5000).alias("k"))
    files.write_sorted_parquet(df, scratch, "k")
    parts = spark.read.parquet(scratch).withColumn("f", F.input_file_name())
    ranges = sorted((r["lo"], r["hi"]) for r in parts.groupBy("f").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).collect())
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))  # files hold disjoint key ranges


def test_literal_rows_are_plan_local(spark):
    schema = StructType([StructField("uid", IntegerType()), StructField("name", StringType())])
    df = literal.literal_rows(spark, [(1, "Alice"), (22, "Eve")], schema)
    assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in schema.fields]
    assert sorted(tuple(r) for r in df.collect()) == [(1, "Alice"), (22, "Eve")]
    assert "PythonRDD" not in plan_text(df, "extended") and "ExistingRDD" not in plan_text(df)
    assert literal.literal_rows(spark, [], schema).count() == 0


def test_synthetic_usage_is_deterministic_and_in_range(spark):
    a = literal.synthetic_usage(spark.range(2000))
    b = literal.synthetic_usage(spark.range(2000).repartition(7))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    stats = a.agg(F.min("usage"), F.max("usage"), F.min(F.length("uname")), F.max(F.length("uname"))).first()
    assert 0 <= stats[0] and stats[1] < 1000 and stats[2] == stats[3] == 10


class open_text:
    """Write a small text file under the scratch folder via Spark (no local temp dirs)."""

    def __init__(self, spark, scratch, text, name="in.csv"):
        self.path = f"{scratch}/{name.split('.')[0]}"
        lines = text.rstrip("\n").split("\n")
        spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.mode("overwrite").text(self.path)

    def __enter__(self):
        return self.path

    def __exit__(self, *exc):
        return False


def test_shared_dir_comes_from_session(spark):
    from kiln.session import scratch_path, shared_dir

    root = shared_dir(spark)
    assert root and not root.endswith("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root + "/kiln/x-")


def test_literal_rows_keep_wall_clock_and_instants(spark):
    rows = [(dt.datetime(2024, 1, 1, 2, 30), dt.datetime(2024, 1, 1, 2, 30), dt.date(2024, 1, 1))]
    schema = StructType(
        [
            StructField("ntz", TimestampNTZType()),
            StructField("ltz", TimestampType()),
            StructField("d", DateType()),
        ]
    )
    assert literal.literal_rows(spark, rows, schema).collect() == spark.createDataFrame(rows, schema).collect()
