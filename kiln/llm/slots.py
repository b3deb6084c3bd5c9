"""Sharding by fixed virtual slots, with DataFrame and SQL functions only.

Every record is hashed into one of a few thousand slots; the number of slots
never changes.  Bytes are summed per slot, and a map from slots to shards is
made from the sums: slots go, largest first, to the shard that holds least so
far.  The map is a small table of (version, slot, part, shard), stored under a
versioned folder.  Rebalancing edits it: slots keep their shard as long as the
shard is within its share, and only the others move.

A slot that alone holds more than a small share of a shard (copies of one
record hash alike) is split into parts by a hash of the record and of its
number among equal records, and its parts are mapped each on their own.  So a
record's shard depends on the table alone, not on how its rows are stored.  The aggregates that the map is made from have
at most slots x parts rows, whatever the size of the data.

Defined results: a null text has size 1 and the CRC of no bytes; null ids hash
like any value; repeated rows are placed each on their own; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kiln import paths

from .common import cut

SLOTS = 4096
PARTS = 64
SHARDS = 16
CHUNK = 128
#: A slot above this share of the mean shard is split into parts.
LARGE = 1 / 64


def slot_of(*cols: Column, slots: int = SLOTS) -> Column:
    """The slot of a record, by hash of its columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(slots)).cast("int")


def slot_bytes(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(slot, part, bytes): sums per slot; large slots by part, others as part 0.

    ``rows`` has slot, part and size.  Sums are partial per task first, and at
    most slots x parts rows are left.
    """
    parts = cut(rows.groupBy("slot", "part").agg(F.sum("size").alias("bytes")))
    whole = parts.groupBy("slot").agg(F.sum("bytes").alias("slot_bytes"))
    total = parts.agg(F.sum("bytes").alias("total"))
    large = F.col("slot_bytes") > F.col("total") * (LARGE / shards)
    # total has one row
    marked = parts.join(whole, "slot").join(F.broadcast(total), F.lit(True), "left")
    part = F.when(large, F.col("part")).otherwise(F.lit(0)).alias("part")
    return marked.groupBy("slot", large.alias("split"), part).agg(F.sum("bytes").alias("bytes"))


def _fold(items: Column, loads: Column, choose) -> Column:
    """Go through an array of (bytes, slot, part, old) and give each a shard; the state is loads and the list of choices.

    Choices are gathered by chunks of ``CHUNK`` items, so a step copies at most a
    chunk, and the work is linear in the number of items.
    """
    item_type = "array<struct<slot:int,part:int,shard:int>>"
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int")), lambda i: F.slice(items, i * CHUNK + 1, CHUNK))

    def step(state: Column, x: Column) -> Column:
        shard = choose(state["loads"], x)
        new = F.transform(state["loads"], lambda load, i: F.when(i == shard, load + x["bytes"]).otherwise(load))
        item = F.struct(x["slot"].alias("slot"), x["part"].alias("part"), shard.cast("int").alias("shard"))
        return F.struct(new.alias("loads"), F.concat(state["out"], F.array(item)).alias("out"))

    def through(state: Column, chunk: Column) -> Column:
        done = F.aggregate(chunk, F.struct(state["loads"].alias("loads"), F.array().cast(item_type).alias("out")), step)
        return F.struct(done["loads"].alias("loads"), F.concat(state["out"], F.array(done["out"])).alias("out"))

    zero = F.struct(loads.alias("loads"), F.array().cast(f"array<{item_type}>").alias("out"))
    return F.flatten(F.aggregate(chunks, zero, through, lambda state: state["out"]))


def _least(loads: Column) -> Column:
    return F.array_position(loads, F.array_min(loads)).cast("int") - 1


def slot_map(sums: DataFrame, shards: int = SHARDS, version: int = 1) -> DataFrame:
    """(version, slot, part, split, shard): largest sums first, each to the shard with least bytes.

    ``sums`` has at most slots x parts rows; they are folded in one row.
    """
    item = F.struct((-F.col("bytes")).alias("order"), "slot", "part", "bytes")
    one = sums.agg(F.sort_array(F.collect_list(item)).alias("items"))
    choices = _fold(F.col("items"), F.array_repeat(F.lit(0).cast("long"), shards), lambda loads, x: _least(loads))
    placed = one.select(F.explode(choices).alias("m")).select("m.*")
    return placed.join(sums.select("slot", "part", "split"), ["slot", "part"]).select(F.lit(version).alias("version"), "slot", "part", "split", "shard")


def rebalance(old: DataFrame, sums: DataFrame, shards: int, slack: float = 0.001) -> DataFrame:
    """The next version of a map: each shard keeps slots, in hash order, then the smallest, as far as its share (plus ``slack``) goes.

    All others move, largest first, to the shard that holds least.  A part whose
    slot was not split before keeps the shard of its slot, where it can.
    """
    was = old.select("slot", "part", F.col("shard").alias("old_shard"), "version")
    whole = was.groupBy("slot").agg(F.min("old_shard").alias("slot_shard"))
    both = sums.join(was.drop("version"), ["slot", "part"], "left").join(whole, "slot", "left")
    known = F.coalesce("old_shard", "slot_shard", F.lit(-1))
    both = both.withColumn("old", F.when(known < shards, known).otherwise(-1))
    share = sums.agg((F.sum("bytes") * ((1 + slack) / shards)).alias("share"))  # one row
    before = F.sum("bytes").over(Window.partitionBy("old").orderBy(F.xxhash64("slot", "part"), "slot", "part").rowsBetween(Window.unboundedPreceding, 0))
    both = both.withColumn("held", before).join(F.broadcast(share), F.lit(True), "left")
    both = both.withColumn("early", F.col("held") <= F.col("share"))
    # the room that the first slot beyond the share leaves is filled with the smallest of those after it
    room = F.col("share") - F.coalesce(F.max(F.when(F.col("early"), F.col("held"))).over(Window.partitionBy("old")), F.lit(0))
    small = Window.partitionBy("old", "early").orderBy("bytes", F.xxhash64("slot", "part"), "slot", "part").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("room", room).withColumn("late", F.sum("bytes").over(small) <= F.col("room"))
    stays = (F.col("old") >= 0) & (F.col("early") | F.col("late"))
    both = both.select("slot", "part", "split", "bytes", F.when(stays, F.col("old")).otherwise(-1).alias("old"))
    item = F.struct((F.col("old") < 0).alias("moves"), (-F.col("bytes")).alias("order"), "slot", "part", "bytes", "old")
    one = both.agg(F.sort_array(F.collect_list(item)).alias("items"))
    choices = _fold(F.col("items"), F.array_repeat(F.lit(0).cast("long"), shards), lambda loads, x: F.when(x["old"] >= 0, x["old"]).otherwise(_least(loads)))
    placed = one.select(F.explode(choices).alias("m")).select("m.*")
    number = old.agg((F.max("version") + 1).alias("version"))
    # number has one row
    out = placed.join(sums.select("slot", "part", "split"), ["slot", "part"]).join(F.broadcast(number), F.lit(True), "left")
    return out.select("version", "slot", "part", "split", "shard")


def store_map(mapping: DataFrame, path: str) -> None:
    """Add a map to the versioned table at ``path``; a version that is there already is an error."""
    version = mapping.agg(F.max("version")).first()[0]
    mapping.drop("version").coalesce(1).write.parquet(f"{path.rstrip('/')}/version={version}")


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A stored version of a map, or its last."""
    every = spark.read.parquet(path)
    if version is None:
        version = every.agg(F.max("version")).first()[0]
    return every.where(F.col("version") == version).select("version", "slot", "part", "split", "shard")


def prepare(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, virtual slot and part of every row; part is a hash of the record and its number among equal ones."""
    data = F.col(f"`{text_col}`").cast("string").cast("binary")
    rows = df.select(
        F.col(f"`{id_col}`").alias("id"),
        (F.coalesce(F.octet_length(data), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(data, F.lit(b""))).alias("text_crc32"),
    )
    same = ["id", "text_crc32", "size"]
    rows = cut(rows.withColumn("slot", slot_of(F.col("id"), F.col("text_crc32"))).withColumn("stored", F.spark_partition_id()))
    # number equal records: within each stored part of the rows, after those of the parts before it, so that a
    # record with a third of the rows is numbered by many tasks
    counts = rows.groupBy(*same, "stored").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy(*same).orderBy("stored").rowsBetween(Window.unboundedPreceding, -1))
    several = counts.withColumn("before", F.coalesce(before, F.lit(0))).withColumn("all", F.sum("n").over(Window.partitionBy(*same)))
    several = several.where(F.col("all") > 1).select(*[F.col(c).alias(f"{c}_") for c in [*same, "stored"]], "before")
    on = F.lit(True)
    for c in [*same, "stored"]:
        on = on & F.col(c).eqNullSafe(F.col(f"{c}_"))
    twins = rows.join(several, on).drop(*[f"{c}_" for c in [*same, "stored"]])
    twins = twins.withColumn("number", F.col("before") + F.row_number().over(Window.partitionBy(*same, "stored").orderBy("slot")) - 1)
    single = rows.join(several, on, "left_anti").withColumn("number", F.lit(0).cast("long"))
    every = single.drop("stored").unionByName(twins.drop("stored", "before"))
    return cut(every.withColumn("part", F.pmod(F.xxhash64("id", "text_crc32", "number"), F.lit(PARTS)).cast("int")).drop("number"))


def placed(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """``rows`` with their shard and their gapless place in it.

    A place is the number of rows in the shard's earlier (slot, part) cells, a
    running sum over at most slots x parts counts, plus the row's number in its
    own cell; so no window holds more than a cell.
    """
    cells = rows.groupBy("slot", "part").agg(F.count(F.lit(1)).alias("cell_rows"))
    # a slot that is not split has one line, for all its parts
    m = mapping.select("slot", "split", "shard", F.explode(F.when(F.col("split"), F.array("part")).otherwise(F.sequence(F.lit(0), F.lit(PARTS - 1)))).alias("part"))
    cells = cells.join(m.select("slot", "part", "shard"), ["slot", "part"])
    before = F.sum("cell_rows").over(Window.partitionBy("shard").orderBy("slot", "part").rowsBetween(Window.unboundedPreceding, -1))
    cells = cells.select("slot", "part", "shard", F.coalesce(before, F.lit(0)).alias("before"))
    in_cell = F.row_number().over(Window.partitionBy("slot", "part").orderBy("id", "text_crc32", "size")) - 1
    return rows.withColumn("in_cell", in_cell).join(cells, ["slot", "part"]).withColumn("place", F.col("before") + F.col("in_cell"))


def shard(df: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", store: str | None = None, rows: DataFrame | None = None) -> DataFrame:
    """id, size, text_crc32, shard, place, virtual_slot of every row, under a map that is new or, with ``store``, the edit of the stored one.

    ``rows`` are the prepared rows, where the caller has them already.
    """
    rows = prepare(df, id_col, text_col) if rows is None else rows
    sums = cut(slot_bytes(rows, shards))
    if store is None:
        mapping = slot_map(sums, shards)
    else:
        spark = df.sparkSession
        mapping = cut(rebalance(load_map(spark, store), sums, shards) if paths.exists(spark, store) else slot_map(sums, shards))
        store_map(mapping, store)
    out = placed(rows, cut(mapping))
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", "place", F.col("slot").alias("virtual_slot"), "part")


def op10_virtual_slots(spark, sf_dir: str) -> DataFrame:
    """The table grows out of one shard less: a map is stored, then loaded and edited for one more shard, and places the rows."""
    from kiln.session import scratch_path

    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows, folder = prepare(docs), scratch_path(spark, "slot-map")
    store_map(slot_map(cut(slot_bytes(rows, SHARDS)), SHARDS - 1), folder)
    out = shard(docs, store=folder, rows=rows)
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("place").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )
