"""File stream into Parquet files: run, rerun, new file, restart, new checkpoint."""

import glob
import os
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from kiln.operators import append_files
from kiln.streaming import drifting_files, file_stream, run_for, start_append, stream_files, stream_into_table, table_append

SCHEMA = "loan_id long, funded_amnt int, paid_amnt double, addr_state string"


def drop(spark, inbox, ids, schema=SCHEMA, extra=()):
    rows = [(i, i, float(i), "A", *extra) for i in ids]
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)


def ids(spark, path):
    return sorted(r["loan_id"] for r in spark.read.schema(SCHEMA).parquet(path).collect())


def test_run_rerun_and_new_file(spark, scratch):
    inbox, out, ckpt = f"{scratch}/inbox", f"{scratch}/out", f"{scratch}/ckpt"
    drop(spark, inbox, range(3))
    stream_files(spark, inbox, SCHEMA, out, ckpt)
    assert ids(spark, out) == [0, 1, 2]
    stream_files(spark, inbox, SCHEMA, out, ckpt)  # nothing new: no duplicates
    assert ids(spark, out) == [0, 1, 2]
    drop(spark, inbox, range(3, 7))
    stream_files(spark, inbox, SCHEMA, out, ckpt)
    assert ids(spark, out) == list(range(7))


def test_new_checkpoint_reads_the_whole_source(spark, scratch):
    inbox = f"{scratch}/inbox"
    drop(spark, inbox, range(5))
    stream_files(spark, inbox, SCHEMA, f"{scratch}/out", f"{scratch}/ckpt")
    drop(spark, inbox, range(5, 8))
    with pytest.raises(ValueError, match="another checkpoint"):  # the sink would skip its batches
        stream_files(spark, inbox, SCHEMA, f"{scratch}/out", f"{scratch}/ckpt2")
    assert ids(spark, f"{scratch}/out") == list(range(5))
    stream_files(spark, inbox, SCHEMA, f"{scratch}/out2", f"{scratch}/ckpt2")
    assert ids(spark, f"{scratch}/out2") == list(range(8))


def test_extra_column_is_left_out(spark, scratch):
    inbox, out = f"{scratch}/inbox", f"{scratch}/out"
    drop(spark, inbox, [1], SCHEMA + ", closed boolean", (True,))
    stream_files(spark, inbox, SCHEMA, out, f"{scratch}/ckpt")
    assert spark.read.parquet(out).columns == ["loan_id", "funded_amnt", "paid_amnt", "addr_state"]
    assert ids(spark, out) == [1]


def test_restart_between_bounded_batches(spark, scratch):
    """A run that is stopped after some batches goes on where it was; no row is lost or repeated."""
    inbox, out, ckpt = f"{scratch}/inbox", f"{scratch}/out", f"{scratch}/ckpt"
    for part in range(4):
        drop(spark, inbox, range(part * 10, part * 10 + 5))
    q = start_append(file_stream(spark, inbox, SCHEMA, max_files_per_trigger=1), out, ckpt, trigger="0 seconds")
    while not q.recentProgress and q.isActive:
        q.awaitTermination(0.1)
    q.stop()
    stream_files(spark, inbox, SCHEMA, out, ckpt, max_files_per_trigger=1)
    assert ids(spark, out) == sorted(i for part in range(4) for i in range(part * 10, part * 10 + 5))


def test_processing_time_trigger_bounded_run(spark, scratch):
    inbox, out = f"{scratch}/inbox", f"{scratch}/out"
    drop(spark, inbox, [1])
    q = start_append(file_stream(spark, inbox, SCHEMA), out, f"{scratch}/ckpt", trigger="1 second")
    q.processAllAvailable()
    run_for(q, 0.5)
    assert not q.isActive and ids(spark, out) == [1]


# ---------------------------------------------------- streams into a shared table


def plain(spark, path):
    return sorted(r["loan_id"] for r in spark.read.parquet(path).collect())


def forget_commit(ckpt):
    """The state after a crash between a batch's work and Spark's note of it: the last batch runs again."""
    last = max((f for f in os.listdir(f"{ckpt}/commits") if f.isdigit()), key=int)
    os.rename(f"{ckpt}/commits/{last}", f"{ckpt}/forgotten-{last}")
    if os.path.exists(f"{ckpt}/commits/.{last}.crc"):
        os.rename(f"{ckpt}/commits/.{last}.crc", f"{ckpt}/forgotten-{last}.crc")


def test_stream_and_batch_share_a_table(spark, scratch):
    inbox, table, ckpt = f"{scratch}/inbox", f"{scratch}/table", f"{scratch}/ckpt"
    schema = spark.createDataFrame([], SCHEMA).schema
    drop(spark, table, range(3))
    drop(spark, inbox, range(3, 5))
    stream_into_table(spark, inbox, SCHEMA, table, ckpt)
    assert plain(spark, table) == list(range(5))
    append_files(spark, table, schema, spark.createDataFrame([(i, i, 1.0, "B") for i in range(5, 9)], SCHEMA))
    assert plain(spark, table) == list(range(9))
    stream_into_table(spark, inbox, SCHEMA, table, ckpt)  # nothing new
    drop(spark, inbox, range(9, 12))
    stream_into_table(spark, inbox, SCHEMA, table, ckpt)
    assert plain(spark, table) == list(range(12))
    assert len(duckdb.sql(f"SELECT * FROM '{table}/*.parquet'").fetchall()) == 12


@pytest.mark.parametrize("published", [True, False])
def test_a_batch_that_runs_again_adds_nothing(spark, scratch, published):
    inbox, table, ckpt = f"{scratch}/inbox", f"{scratch}/table", f"{scratch}/ckpt"
    drop(spark, table, [100])
    for part in range(3):
        drop(spark, inbox, range(part * 10, part * 10 + 4))
    stream_into_table(spark, inbox, SCHEMA, table, ckpt, max_files_per_trigger=1)
    want = plain(spark, table)
    assert len(want) == 13
    forget_commit(ckpt)
    if not published:  # the crash came while files were moving: some are there, the mark is not
        (mark,) = glob.glob(f"{table}/_stream/*/*/_PUBLISHED")
        os.rename(mark, mark + "-not")
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{table}/*.parquet")}
    stream_into_table(spark, inbox, SCHEMA, table, ckpt, max_files_per_trigger=1)
    assert plain(spark, table) == want
    same = sum(os.stat(f).st_mtime_ns == t for f, t in before.items())
    assert same == len(before) - (not published)


def test_retry_after_a_batch_failed_halfway(spark, scratch, monkeypatch):
    """The table is partitioned; moving a batch's files fails after the first one, and the next run completes it."""
    inbox, table, ckpt = f"{scratch}/inbox", f"{scratch}/table", f"{scratch}/ckpt"
    rows = [(i, i, 1.0, "AB C/"[i % 5]) for i in range(20)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(inbox)
    move, moved = table_append.paths.move, []

    def fails(spark, f, to):
        if moved:
            raise OSError("no space")
        moved.append(to)
        move(spark, f, to)

    monkeypatch.setattr(table_append.paths, "move", fails)
    with pytest.raises(Exception, match="no space"):
        stream_into_table(spark, inbox, SCHEMA, table, ckpt, partition_by=["addr_state"])
    monkeypatch.undo()
    stream_into_table(spark, inbox, SCHEMA, table, ckpt, partition_by=["addr_state"])
    got = spark.read.schema(SCHEMA).parquet(table).select("loan_id", "funded_amnt", "paid_amnt", "addr_state")
    assert sorted(map(tuple, got.collect())) == rows


def test_sink_and_shared_directories_are_kept_apart(spark, scratch):
    inbox, out = f"{scratch}/inbox", f"{scratch}/out"
    drop(spark, inbox, range(3))
    drop(spark, f"{scratch}/table", [9])
    with pytest.raises(ValueError, match="no stream wrote"):
        stream_files(spark, inbox, SCHEMA, f"{scratch}/table", f"{scratch}/ckpt")
    stream_files(spark, inbox, SCHEMA, out, f"{scratch}/ckpt")
    schema = spark.createDataFrame([], SCHEMA).schema
    with pytest.raises(ValueError, match="file sink"):
        append_files(spark, out, schema, spark.createDataFrame([], schema))
    with pytest.raises(ValueError, match="file sink"):
        stream_into_table(spark, inbox, SCHEMA, out, f"{scratch}/ckpt2")
    stream_into_table(spark, inbox, SCHEMA, f"{scratch}/table", f"{scratch}/ckpt3")
    with pytest.raises(ValueError, match="another checkpoint"):
        stream_into_table(spark, inbox, SCHEMA, f"{scratch}/table", f"{scratch}/ckpt4")
    drop(spark, f"{scratch}/inbox2", [50])
    stream_into_table(spark, f"{scratch}/inbox2", SCHEMA, f"{scratch}/table", f"{scratch}/ckpt5")  # another source is fine
    assert plain(spark, f"{scratch}/table") == [0, 1, 2, 9, 50]


def test_a_name_in_another_case_is_found_in_any_order(spark, scratch):
    """Merged without case, the name of the file that came first would hide the other's."""
    files = []
    for folder, name in (("a", "loan_id"), ("b", "Loan_ID"), ("c", "loan_id")):
        spark.createDataFrame([(1,)], f"{name} long").coalesce(1).write.parquet(f"{scratch}/{folder}")
        files += glob.glob(f"{scratch}/{folder}/*.parquet")
    schema = spark.createDataFrame([], "loan_id long").schema
    assert [drifting_files(spark, f, schema) for f in (files[:2], files[1:], files)] == [[files[1]]] * 3


def test_files_of_another_schema_are_quarantined(spark, scratch):
    inbox, table, ckpt = f"{scratch}/in box", f"{scratch}/table", f"{scratch}/ckpt"
    drop(spark, inbox, range(4))
    drop(spark, inbox, [10, 11], SCHEMA + ", closed boolean", (True,))
    spark.createDataFrame([("x20", 1)], "loan_id string, funded_amnt int").coalesce(1).write.mode("append").parquet(inbox)
    spark.createDataFrame([(30,)], "loan_id long").coalesce(1).write.mode("append").parquet(inbox)  # lacks columns only
    spark.createDataFrame([(40, 1)], "Loan_ID long, funded_amnt int").coalesce(1).write.mode("append").parquet(inbox)
    stream_into_table(spark, inbox, SCHEMA, table, ckpt)
    assert ids(spark, table) == [0, 1, 2, 3, 30]
    kept = [spark.read.parquet(f) for f in sorted(glob.glob(f"{table}/_quarantine/*/0/*"))]
    assert sorted(tuple(sorted(c for c in k.columns)) for k in kept) == sorted(
        tuple(sorted(c)) for c in (["addr_state", "arrived_as", "closed", "funded_amnt", "loan_id", "paid_amnt"], ["arrived_as", "funded_amnt", "loan_id"], ["Loan_ID", "arrived_as", "funded_amnt"])
    )
    assert sorted(str(r[0]) for k in kept for r in k.collect()) == ["10", "11", "40", "x20"]
    drop(spark, inbox, [50], SCHEMA + ", closed boolean", (False,))
    stream_into_table(spark, inbox, SCHEMA, table, ckpt, quarantine_dir=f"{scratch}/aside")
    assert ids(spark, table) == [0, 1, 2, 3, 30] and len(glob.glob(f"{scratch}/aside/*/1/0/*.parquet")) == 1


def test_drifting_files_are_found_among_many(spark, scratch):
    for i in range(24):
        drop(spark, f"{scratch}/{i}", [i], SCHEMA + (", more int" if i in (5, 17) else ""), (1,) if i in (5, 17) else ())
    files = sorted(glob.glob(f"{scratch}/*/*.parquet"))
    schema = spark.createDataFrame([], SCHEMA).schema
    assert sorted(f.split("/")[-2] for f in drifting_files(spark, files, schema)) == ["17", "5"]
    assert drifting_files(spark, [], schema) == []


def test_bounded_run_ends_between_batches(spark, scratch, monkeypatch):
    """Batches take longer than the run: what is there afterwards is whole batches, the rest comes with the next run."""
    inbox, table, ckpt = f"{scratch}/inbox", f"{scratch}/table", f"{scratch}/ckpt"
    for part in range(5):
        drop(spark, inbox, range(part * 10, part * 10 + 3))
    check = table_append.drifting_files
    monkeypatch.setattr(table_append, "drifting_files", lambda *a: time.sleep(2) or check(*a))
    stream_into_table(spark, inbox, SCHEMA, table, ckpt, available_now=False, trigger="0 seconds", run_seconds=1, max_files_per_trigger=1)
    some = plain(spark, table) if glob.glob(f"{table}/*.parquet") else []
    assert 0 < len(some) < 15 and len(some) % 3 == 0
    assert not glob.glob(f"{table}/_stream/*/*/part-*")  # nothing begun and not published
    monkeypatch.undo()
    stream_into_table(spark, inbox, SCHEMA, table, ckpt)
    assert plain(spark, table) == sorted(i for part in range(5) for i in range(part * 10, part * 10 + 3))


def test_bounded_run_of_the_file_sink_waits_for_its_batch(spark, scratch):
    """A run of a moment over a batch of seconds ends with that batch committed."""
    inbox, out, ckpt = f"{scratch}/inbox", f"{scratch}/out", f"{scratch}/ckpt"
    drop(spark, inbox, range(5))
    stream = file_stream(spark, inbox, SCHEMA)
    slow = stream.where(F.expr("length(sha2(aggregate(sequence(1, 300000), 'x', (a, i) -> md5(a)), 256)) = 64"))
    q = start_append(slow, out, ckpt, trigger="1 hour")
    while not q.status["isTriggerActive"]:
        time.sleep(0.05)
    run_for(q, 0.2)
    assert not q.isActive and ids(spark, out) == list(range(5))
    assert os.path.exists(f"{ckpt}/commits/0")
