"""Near copies by MinHash: one permutation, optimal densification, star edges.

A text's set holds the 64-bit hashes of its distinct word shingles.  One hash
function serves all bins: the top bits of a shingle's hash name its bin, and
the smallest hash of each bin is the bin's value.  Empty bins borrow from
pseudo-random other bins until one that holds a value is found (optimal
densification), so short texts have full signatures.  ``ROWS`` bins make a
band and equal bands share a bucket.

Texts with equal sets are one class, and only one representative of a class
goes on.  Within a bucket only star-shaped pairs are made: every member against
the bucket's hub.  Each pair is confirmed on the full sets.  Then the hub
leaves its bucket, and a bucket that still holds members of different
components gets another hub, once.  Buckets that are mixed even then (texts around one
common passage share bands without being copies) are resolved exactly: with
shingles in order of rarity among those texts, two similar sets share a shingle
of the larger one's first n - ceil(0.8 n) + 1 and of the smaller one's first
n - ceil(0.8 / 0.9 n) + 1.  These rare shingles are new, tight buckets: a hub
each first, then what still differs in component within a bucket.  So pairs
grow with members times hubs, and no pair that shares a band and could still
join two components goes untested.  The chance that a link of
similarity exactly 0.8 shares no bucket is (1 - 0.8**6)**45, about 1e-6.

Defined results: null texts and texts without words have an empty set and link
with nothing; a text with fewer words than a shingle has one shingle, all its
words; repeated rows share a class, and texts that come under one id, where it is the
smallest of their classes, are one node; a null id joins a class but never
names a component; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textscan as ts
from .common import by_value, cut, fresh, text_or_empty

ROWS, BANDS = 6, 45
BINS = ROWS * BANDS
ATTEMPTS = 64


def shingle_sets(data: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each text, sorted by row, then hash."""
    low = ts.LOWER[data]
    starts, ends, row = ts.words(low, off)
    wh = ts.hash_spans(low, starts, ends)
    h, at = ts.windows(wh, row, width)
    h, r = h.copy(), row[at]
    n = len(off) - 1
    count = np.bincount(row, minlength=n)
    few = np.flatnonzero((count > 0) & (count < width))
    if len(few):
        first = np.searchsorted(row, few)
        mult = ts.multipliers(width, seed=8)
        whole = np.zeros(len(few), np.uint64)
        for k in range(width - 1):
            has = count[few] > k
            whole[has] += wh[first[has] + k] * mult[k]
        h = np.concatenate([h, ts.mix(whole + count[few].astype(np.uint64))])
        r = np.concatenate([r, few])
        order = np.argsort(r, kind="stable")
        h, r = h[order], r[order]
    bounds = np.searchsorted(r, np.arange(n + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a > 1:
            h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return r[new], h[new]


def bin_values(row: np.ndarray, h: np.ndarray, bins: int = BINS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows that have shingles, their bins' values, which bins are their own) from sorted distinct shingle hashes, empty bins filled."""
    bin_of = ((h >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    key = row * bins + bin_of
    first = np.ones(len(h), bool)
    first[1:] = key[1:] != key[:-1]  # hashes ascend within a bin, so its first is its least
    live = np.unique(row)
    at = np.searchsorted(live, row[first])
    value = np.zeros((len(live), bins), np.uint64)
    full = np.zeros((len(live), bins), bool)
    value[at, bin_of[first]] = h[first]
    full[at, bin_of[first]] = True
    own, done = value.copy(), full.copy()
    everywhere = np.arange(1, bins + 1, dtype=np.uint64)
    for t in range(ATTEMPTS):
        open_rows = np.flatnonzero(~done.all(axis=1))
        if not len(open_rows):
            break
        pick = ((ts.mix(everywhere * np.uint64(0x9E3779B97F4A7C15) + np.uint64(t)) >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
        take = ~done[open_rows] & full[open_rows][:, pick]
        i, j = np.nonzero(take)
        value[open_rows[i], j] = own[open_rows[i], pick[j]]
        done[open_rows[i], j] = True
    for i in np.flatnonzero(~done.all(axis=1)):  # few shingles: the nearest filled bin after a pseudo-random place
        filled = np.flatnonzero(full[i])
        left = np.flatnonzero(~done[i])
        place = (ts.mix(left.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)) % np.uint64(bins)).astype(np.int64)
        value[i, left] = own[i, filled[np.searchsorted(filled, place) % len(filled)]]
    return live, value, full


def signatures(row: np.ndarray, h: np.ndarray, n: int, rows: int = ROWS, bands: int = BANDS) -> np.ndarray:
    """n x bands band hashes from sorted distinct shingle hashes; rows without shingles hold zeros."""
    out = np.zeros((n, bands), np.uint64)
    if not len(h):
        return out
    live, value, _ = bin_values(row, h, rows * bands)
    mult = ts.multipliers(rows, seed=21)
    salt = ts.multipliers(bands, seed=22)
    value = value.reshape(len(live), bands, rows)
    total = np.zeros((len(live), bands), np.uint64)
    for k in range(rows):
        total += ts.mix(value[:, :, k]) * mult[k]
    out[live] = ts.mix(total + salt)
    return out


_SIGN_TYPE = "struct<n:bigint,fp1:bigint,fp2:bigint,bands:array<bigint>>"


def _sign_udf(width: int):
    def sign(col: pa.Array) -> pa.Array:
        size = len(col)
        n, fp1, fp2 = np.zeros(size, np.int64), np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        bands = np.zeros((size, BANDS), np.int64)
        for lo, hi, data, off in ts.slices(col):
            row, h = shingle_sets(data, off, width)
            n[lo:hi] = np.bincount(row, minlength=hi - lo)
            if len(h):
                first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
                live = lo + row[first]
                fp1[live] = np.add.reduceat(ts.mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first)
                fp2[live] = np.add.reduceat(ts.mix(h + np.uint64(0x1234567)), first)
            bands[lo:hi] = signatures(row, h, hi - lo).view(np.int64)
        offsets = pa.array(np.arange(size + 1, dtype=np.int32) * BANDS)
        return pa.StructArray.from_arrays(
            [pa.array(n), pa.array(fp1.view(np.int64)), pa.array(fp2.view(np.int64)), pa.ListArray.from_arrays(offsets, pa.array(bands.reshape(-1)))],
            names=["n", "fp1", "fp2", "bands"],
        )

    return F.arrow_udf(sign, returnType=_SIGN_TYPE)


def _set_udf(width: int):
    def sets(col: pa.Array) -> pa.Array:
        parts, counts, sketches = [], [np.zeros(1, np.int64)], []
        for lo, hi, data, off in ts.slices(col):
            row, h = shingle_sets(data, off, width)
            parts.append(h.view(np.int64))
            counts.append(np.bincount(row, minlength=hi - lo))
            sketch = np.zeros((hi - lo, BINS), np.uint8)
            if len(h):
                live, value, full = bin_values(row, h)
                sketch[live] = np.where(full, ts.mix(value) % np.uint64(255) + np.uint64(1), np.uint64(0)).astype(np.uint8)
            sketches += [x.tobytes() for x in sketch]
        offsets = np.cumsum(np.concatenate(counts)).astype(np.int32)
        shingles = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64)))
        return pa.StructArray.from_arrays([shingles, pa.array(sketches, pa.binary())], names=["shingles", "sketch"])

    return F.arrow_udf(sets, returnType="struct<shingles:array<bigint>,sketch:binary>")


def _may_link(percent: int) -> Column:
    """Arrow function: whether two sketches leave room for the similarity.

    A bin that at least one of two sets fills agrees with the chance of their
    similarity; borrowed values take no part.  Pairs six standard deviations
    below the similarity sought are ruled out, so one that has it is lost with a
    chance of about 1e-9.
    """
    p = percent / 100

    def may(a: pa.Array, b: pa.Array) -> pa.Array:
        x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(len(c), -1) for c in (a, b))
        either = np.maximum(((x > 0) | (y > 0)).sum(axis=1), 1)
        agree = ((x == y) & (x > 0)).sum(axis=1) / either
        return pa.array(agree >= p - 6 * np.sqrt(p * (1 - p) / either))

    return F.arrow_udf(may, returnType="boolean")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) with the smallest node of each component of the edges (u, v).

    Each round every node takes its smallest neighbour, chains are followed to
    their end by doubling, and edges are contracted; the number of components
    in play at least halves each round.  Stars take one round.
    """
    live = cut(edges.union(edges.select("v", "u")).where("u != v").distinct())
    label = None
    while True:
        up = cut(live.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low")).select("node", F.least("node", "low").alias("comp")))
        while True:
            hop = up.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
            new = cut(up.join(hop, "comp").select("node", "comp", "next"))
            moved = not new.where("comp != next").isEmpty()
            up = new.select("node", F.col("next").alias("comp"))
            if not moved:
                break
        if label is None:
            label = up
        else:
            step = up.select(F.col("node").alias("comp"), F.col("comp").alias("to"))
            label = cut(label.join(step, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")))
        a = up.select(F.col("node").alias("u"), F.col("comp").alias("cu"))
        b = up.select(F.col("node").alias("v"), F.col("comp").alias("cv"))
        live = cut(live.join(a, "u").join(b, "v").where("cu != cv").select(F.col("cu").alias("u"), F.col("cv").alias("v")).distinct())
        if live.isEmpty():
            return label


def join_components(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` (node, comp) with the components that ``links`` (u, v) connect made one.

    Links are first put between components, so each round of new links costs
    work in proportion to them, not to all links so far.
    """
    of_u = label.select(F.col("node").alias("u"), F.col("comp").alias("cu"))
    of_v = label.select(F.col("node").alias("v"), F.col("comp").alias("cv"))
    between = links.join(of_u, "u").join(of_v, "v").where("cu != cv").select(F.col("cu").alias("u"), F.col("cv").alias("v"))
    step = components(between).select(F.col("node").alias("comp"), F.col("comp").alias("to"))
    return cut(label.join(step, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")))


def _similar(part: Column, whole: Column, percent: int) -> Column:
    return 100 * part >= percent * whole


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    Sizes that differ too much and sketches that agree too little
    (:func:`_may_link`) save the comparison.  The member's set is
    joined first: members are in few pairs.  The join on the hub, who may be in
    very many, then has rows as large as their sets, and Spark splits its large
    partitions (adaptive skew join).
    """
    hub = sets.select(F.col("node").alias("b"), F.size("shingles").alias("nb"), F.col("sketch").alias("kb"))
    sa = sets.select(F.col("node").alias("a"), F.size("shingles").alias("na"), F.col("sketch").alias("ka"), F.col("shingles").alias("sa"))
    sb = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    near = pairs.join(hub, "b").join(sa, "a").where(_similar(F.least("na", "nb"), F.greatest("na", "nb"), percent))
    near = near.where(_may_link(percent)("ka", "kb"))
    full = near.select("a", "b", "na", "sa").join(sb, "b")
    both = full.select("a", "b", "na", F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("common"))
    linked = both.where(_similar(F.col("common"), F.col("na") + F.col("nb") - F.col("common"), percent))
    return linked.select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()


def rare_members(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(key, node, n, first, place): each node under the shingles of its prefix, rarest first, that another node has too.

    Of two similar sets the larger meets the smaller one's first
    n - ceil(2p / (1 + p) n) + 1 shingles (``first``) in its own first
    n - ceil(p n) + 1.  Shingles that no other node has come before all others
    and need no bucket.
    """
    each = sets.join(nodes, "node").select("node", F.size("shingles").alias("n"), F.explode("shingles").alias("key"))
    often = each.groupBy("key").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    mine = Window.partitionBy("node")
    known = each.join(often, "key").withColumn("r", F.row_number().over(mine.orderBy("df", "key"))).withColumn("c", F.count(F.lit(1)).over(mine))
    place = F.col("r") + F.col("n") - F.col("c")
    known = known.where(place <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)
    first = place <= F.col("n") - F.ceil(F.col("n") * (2 * percent) / (100 + percent) - F.lit(1e-9)) + 1
    return known.select("key", "node", "n", first.alias("first"), place.alias("place"))


@by_value
def near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id) per row of ``df``: components of texts linked at ``percent`` similarity of ``width``-word shingles."""
    spark = df.sparkSession
    text = df.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))
    sign = _sign_udf(width)
    rows = cut(text.select("id", sign("text").alias("s")).select("id", "s.*"))
    same = ["n", "fp1", "fp2"]
    # one representative per class of equal sets: its smallest id
    classes = rows.where("n > 0").groupBy(*same).agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"))
    classes = cut(classes.where(F.col("node").isNotNull()))
    entries = classes.select(F.explode("bands").alias("key"), "node")
    shared = entries.groupBy("key").agg(F.min("node").alias("h"), F.max("node").alias("last")).where("h != last").select("key")
    members = cut(entries.join(shared, "key"))
    wanted = members.select(F.col("node").alias("id")).distinct()
    sets = text.join(wanted, "id").select(F.col("id").alias("node"), _set_udf(width)("text").alias("s")).select("node", "s.*")
    # stored once, and kept dealt by node, on local disks, for the joins of all rounds: a round
    # moves its pairs, not the sets; lost parts are dealt again from what is stored
    sets = cut(sets.distinct())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sets = sets.repartition(parts, "node").sortWithinPartitions("node").persist(StorageLevel.DISK_ONLY)
    label = cut(wanted.select(F.col("id").alias("node"), F.col("id").alias("comp")))
    for on_bands, one_hub in ((True, True), (True, True), (False, True), (False, False)):
        if not on_bands and one_hub:
            members = cut(rare_members(members.select("node").distinct(), sets, percent))
        now = members.join(label, "node")
        hub = now if on_bands else now.where("first")
        if one_hub:
            hub = hub.groupBy("key").agg(F.min(F.struct(*[c for c in now.columns if c != "key"])).alias("h")).select("key", "h.*")
        ends = now.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 != c1").select("key")
        hubs = hub.join(ends, "key").select("key", *[F.col(c).alias(f"hub_{c}") for c in hub.columns if c != "key"])
        hubs = cut(hubs)
        if hubs.isEmpty():
            break
        # the hub is the pair's second node, whichever is smaller; pairs inside a component need no test
        pairs = now.join(hubs, "key").where("comp != hub_comp")
        if not on_bands:
            pairs = pairs.where((F.col("n") >= F.col("hub_n")) & _similar(F.col("hub_n"), F.col("n"), percent))
            # at the first shingle they share, what may still be common must suffice
            most = 1 + F.least(F.col("n") - F.col("place"), F.col("hub_n") - F.col("hub_place"))
            pairs = pairs.where((100 + percent) * most >= percent * (F.col("n") + F.col("hub_n")))
        found = cut(_confirm(pairs.select(F.col("node").alias("a"), F.col("hub_node").alias("b")).distinct(), sets, percent))
        if not found.isEmpty():
            label = join_components(label, found)
        if on_bands:
            rest = members.join(hubs.select("key").distinct(), "key", "left_semi")
            members = cut(rest.join(hubs.select("key", F.col("hub_node").alias("node")), ["key", "node"], "left_anti"))
    sets.unpersist()
    moved = label.where("comp != node")
    home = classes.select(*same, "node", "copies").join(moved, "node", "left").where((F.col("copies") > 1) | F.col("comp").isNotNull())
    home = home.select(*same, F.coalesce("comp", "node").alias("name"))
    out = rows.select("id", *same).join(home, same, "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("name", "id").alias("component_id"))


def op7_minhash(spark, sf_dir: str) -> DataFrame:
    from .common import table

    out = near_copies(table(spark, sf_dir, "documents"), width=4)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one_copy(df: DataFrame) -> DataFrame:
    """Pipeline stage: one row of each group of near copies, with the columns of ``df``.

    The row whose id names the component stays; rows that share that id are
    told apart by nothing else, so one of them stays.  Rows without an id stay.
    Only the narrow result is joined back; texts are shuffled for repeated ids alone.
    """
    got = cut(near_copies(df))
    gone = got.where((F.col("doc_id") != F.col("component_id"))).select(F.col("doc_id").alias("gone_id")).distinct()
    left = df.join(gone, df["doc_id"] == F.col("gone_id"), "left_anti")
    many = cut(got.where("doc_id = component_id").groupBy(F.col("doc_id").alias("many_id")).count().where("count > 1").select("many_id"))
    if many.isEmpty():
        return left.select(*df.columns)
    single = left.join(many, left["doc_id"] == F.col("many_id"), "left_anti").select(*df.columns)
    several = left.join(many, left["doc_id"] == F.col("many_id"), "left_semi").select(*df.columns)
    return single.unionByName(several.dropDuplicates(["doc_id"]))
