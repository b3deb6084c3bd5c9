"""Prefix trie of rebuilt conversations by composable fingerprints.

A conversation is rebuilt from the head of its base conversation and its own
later turns.  No rebuilt text is made: with a turn's hash e and its place i, the
fingerprint of a sequence is the sum of e * B^i modulo a prime.  Fingerprints
form a monoid (length, sum): a head of length h followed by a suffix has the sum
of the head plus B^h times that of the suffix.  A suffix is the difference of
two running sums of the stored conversation, moved by a power of B, so every
rebuilt prefix is a few products of stored sums.  Three primes make 93 bits.

Rows name the stored turn that they end with (conversation and place), never
its text.  Members of a prefix group must agree on the parent's fingerprint and
on the turn that they end with, and turns are told apart by their full role and
text, which Spark groups once; by induction over depth the group's sequences are
then equal.  If any group disagrees, all is done again under another base.

Scale.  Places come from a range partition by (conversation, turn), so a
conversation with a third of all turns is numbered by many tasks; running sums
go in blocks of ``BLOCK`` turns plus sums per block.  Joins in which a key may
be hot take the at most ``HEAVY`` keys above a share of 1 / HEAVY of the rows
out and broadcast their partner rows.  Sums over a subtree need no walk by
depth: each node is counted at the path of its smallest member, so a subtree's
sum is one of its members' totals less what lies above.  The ids that end at a
node are joined into pieces by range, and one hash runs over the pieces in order.

Defined results: rows without a conversation id are left out; null roles and
texts are empty; equal turn numbers are ordered by role, then by hash of the
turn, equal rows count each; conversation ids are integers.  An empty table has
no nodes.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by_value, cut, table

GROUP = 20
MOST_HEAD = 3
BLOCK = 4096
HEAVY = 256
PIECE_IDS = 4096
PRIMES = (2147483647, 2147483629, 2147483587)
_N = range(len(PRIMES))
KEY = ["depth", *[f"f{k}" for k in _N]]


# ------------------------------------------------------------- fingerprints


def bases(seed: int) -> list[int]:
    """One multiplier per prime, from a seed."""
    return [int.from_bytes(hashlib.sha256(f"{seed}/{p}".encode()).digest()[:8], "big") % (p - 1000) + 500 for p in PRIMES]


def _powers(base: int, p: int, n: np.ndarray) -> np.ndarray:
    out, square, left = np.ones(len(n), np.uint64), np.uint64(base), n.astype(np.uint64)
    p64 = np.uint64(p)
    while left.any():
        odd = (left & np.uint64(1)).astype(bool)
        out[odd] = out[odd] * square % p64
        square = square * square % p64
        left >>= np.uint64(1)
    return out


def _terms(seed: int):
    """Arrow function: e * B^place modulo each prime, from a turn's two hashes and its place."""
    b = bases(seed)

    def run(one: pa.Array, two: pa.Array, place: pa.Array) -> pa.Array:
        h = [np.asarray(x).astype(np.int64).view(np.uint64) for x in (one, two)]
        at = np.asarray(place)
        cols = []
        for k, p in enumerate(PRIMES):
            e = (h[k % 2] if k < 2 else h[0] ^ (h[1] << np.uint64(1))) % np.uint64(p - 1) + np.uint64(1)
            cols.append(pa.array((e * _powers(b[k], p, at) % np.uint64(p)).astype(np.int64)))
        return pa.StructArray.from_arrays(cols, names=[f"t{k}" for k in _N])

    return F.arrow_udf(run, returnType="struct<" + ",".join(f"t{k}:bigint" for k in _N) + ">")


# -------------------------------------------------------------------- turns


def stored_turns(conversations: DataFrame) -> DataFrame:
    """(conv, place, one, two, words): every turn with its place from 0 in its conversation and two hashes of role and text."""
    empty = F.lit("")
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    )
    rows = rows.select(
        "conv",
        "turn",
        "role",
        F.xxhash64("role", "text").alias("one"),
        F.xxhash64(F.lit(1), "text", "role").alias("two"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("tie"),  # deals out equal rows, which may be many
    )
    order = ["turn", "role", "one", "two", "tie"]
    dealt = cut(rows.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()))
    sizes = dealt.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("size"))
    before = F.coalesce(F.sum("size").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("conv", "part", before.alias("before"))
    here = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order)) - 1
    return dealt.withColumn("here", here).join(sizes, ["conv", "part"]).select("conv", (F.col("here") + F.col("before")).alias("place"), "one", "two", "words")


def one_content_per_hash(conversations: DataFrame) -> bool:
    """Whether no two different (role, text) share both hashes: each distinct content is grouped by its full text."""
    empty = F.lit("")
    rows = conversations.select(F.coalesce(F.col("role").cast("string"), empty).alias("role"), F.coalesce(F.col("text").cast("string"), empty).alias("text"))
    rows = rows.withColumns({"one": F.xxhash64("role", "text"), "two": F.xxhash64(F.lit(1), "text", "role")})
    return rows.distinct().groupBy("one", "two").count().where("count > 1").isEmpty()


def head_length(conv: Column) -> Column:
    """How many turns a conversation takes from its base."""
    return (F.crc32(conv.cast("string").cast("binary")) % (MOST_HEAD + 1)).cast("int")


# ------------------------------------------------------------ hot-key joins


def join_hot(rows: DataFrame, unique: DataFrame, keys: list[str]) -> DataFrame:
    """Left join to rows unique by ``keys``, for any skew of ``rows``.

    At most ``HEAVY`` keys can each have more than 1 / HEAVY of the rows; their
    partners are broadcast, all others are joined by key.
    """
    counts = cut(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")))
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    hot = cut(counts.where(F.col("_rows") > max(1000, total / HEAVY)).select(*keys))  # at most HEAVY rows
    if hot.isEmpty():
        return rows.join(unique, keys, "left")
    partners = unique.join(F.broadcast(hot), keys, "left_semi")
    apart = rows.join(F.broadcast(hot), keys, "left_semi").join(F.broadcast(cut(partners)), keys, "left")
    return rows.join(F.broadcast(hot), keys, "left_anti").join(unique, keys, "left").unionByName(apart)


# ------------------------------------------------------------------ members


def _mod(c: Column, k: int) -> Column:
    return F.pmod(c, F.lit(PRIMES[k]))


def members(turns: DataFrame, seed: int = 0) -> DataFrame:
    """(conv, depth, f*, q*, one, two, words, src_conv, src_place, ends): a row per rebuilt conversation and depth, root included.

    f* is the fingerprint of the prefix, q* that of its parent; src_* names the
    stored turn that the prefix ends with; ends marks the whole conversation.
    """
    b = bases(seed)
    terms = _terms(seed)
    t = turns.withColumn("t", terms("one", "two", "place")).select("conv", "place", "one", "two", "words", "t.*")
    t = cut(t.withColumn("block", F.floor(F.col("place") / BLOCK)))
    h = head_length(F.col("conv"))
    early = F.col("place") < h
    first = F.col("place") < MOST_HEAD
    turn = F.struct("place", "one", "two", "words", *[f"t{k}" for k in _N])
    per = t.groupBy("conv").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.coalesce(F.sum(F.when(early, F.col(f"t{k}"))), F.lit(0)).alias(f"s{k}") for k in _N],
        F.sort_array(F.collect_list(F.when(first & (F.col("conv") % GROUP == 0), turn))).alias("head"),  # at most MOST_HEAD
    )
    per = cut(per.withColumn("h", head_length(F.col("conv"))))
    heads = per.where(F.size("head") > 0).select(F.col("conv").alias("base"), F.col("head").alias("base_head"))
    own = per.drop("head").withColumn("base", F.col("conv") - F.col("conv") % GROUP).join(heads, "base", "left")
    taken = F.least("h", F.greatest(F.size("base_head"), F.lit(0)))  # the size of null is -1 or null
    own = own.withColumn("taken", F.coalesce(taken, F.lit(0)))
    own = own.withColumn("used", F.when(F.col("taken") > 0, F.slice("base_head", 1, F.col("taken"))))
    length = F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    # sums of the head's first d turns
    sum_to = lambda k, d: F.aggregate(F.slice("used", 1, d), F.lit(0).cast("long"), lambda acc, x: acc + x[f"t{k}"])
    own = own.withColumn("length", length).withColumns({f"g{k}": F.when(F.col("taken") > 0, _mod(sum_to(k, F.col("taken")), k)).otherwise(F.lit(0)) for k in _N})
    own = cut(own)
    none = F.lit(None).cast("long")
    zero = [F.lit(0).cast("long").alias(f"{c}{k}") for c in "fq" for k in _N]
    root = own.select("conv", F.lit(0).cast("long").alias("depth"), *zero, none.alias("one"), none.alias("two"), F.lit(0).cast("long").alias("words"), none.alias("src_conv"), none.alias("src_place"), (F.col("length") == 0).alias("ends"))
    x = F.col("x")
    depth = x["place"] + 1
    head = own.where("taken > 0").select("conv", "base", "length", "used", F.explode("used").alias("x"))
    head = head.select(
        "conv",
        depth.cast("long").alias("depth"),
        *[_mod(sum_to(k, depth), k).alias(f"f{k}") for k in _N],
        *[_mod(sum_to(k, depth) - x[f"t{k}"], k).alias(f"q{k}") for k in _N],
        x["one"].alias("one"),
        x["two"].alias("two"),
        x["words"].alias("words"),
        F.col("base").alias("src_conv"),
        x["place"].cast("long").alias("src_place"),
        (F.col("length") == depth).alias("ends"),
    )
    # own suffixes: running sums in blocks, carried over blocks, less what the head replaces, moved to their new place
    sums = t.groupBy("conv", "block").agg(*[F.sum(f"t{k}").alias(f"o{k}") for k in _N])
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv", "block", *[F.coalesce(F.sum(f"o{k}").over(before), F.lit(0)).alias(f"o{k}") for k in _N])
    sums = sums.join(own.select("conv", "h", "taken", "length", *[f"{c}{k}" for c in "sg" for k in _N]), "conv")
    within = Window.partitionBy("conv", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = t.join(sums, ["conv", "block"]).withColumns({f"c{k}": F.sum(f"t{k}").over(within) + F.col(f"o{k}") for k in _N})
    rows = rows.where(F.col("place") >= F.col("h")).withColumn("gap", F.col("h") - F.col("taken"))

    def moved(k: int, c: Column) -> Column:
        back = pow(b[k], -1, PRIMES[k])
        shift = F.lit(1).cast("long")
        for g in range(1, MOST_HEAD + 1):
            shift = F.when(F.col("gap") == g, F.lit(pow(back, g, PRIMES[k])).cast("long")).otherwise(shift)
        return _mod(_mod(c, k) * shift, k)

    to = (F.col("place") - F.col("gap") + 1).cast("long")
    suffix = rows.select(
        "conv",
        to.alias("depth"),
        *[_mod(F.col(f"g{k}") + moved(k, F.col(f"c{k}") - F.col(f"s{k}")), k).alias(f"f{k}") for k in _N],
        *[_mod(F.col(f"g{k}") + moved(k, F.col(f"c{k}") - F.col(f"s{k}") - F.col(f"t{k}")), k).alias(f"q{k}") for k in _N],
        "one",
        "two",
        "words",
        F.col("conv").alias("src_conv"),
        F.col("place").cast("long").alias("src_place"),
        (to == F.col("length")).alias("ends"),
    )
    return root.unionByName(head).unionByName(suffix)


# -------------------------------------------------------------------- nodes


def group_prefixes(rows: DataFrame) -> DataFrame:
    """A node per depth and fingerprint, with whether its members agree on their last turn and their parent."""
    turn, up = F.struct("one", "two"), F.struct(*[f"q{k}" for k in _N])
    nodes = rows.groupBy(*KEY).agg(
        F.min("conv").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("words").alias("words"),
        F.min(up).alias("up"),
        F.min(F.struct("src_conv", "src_place")).alias("src"),
        ((F.min(turn) == F.max(turn)) & (F.min(up) == F.max(up))).alias("agree"),
    )
    return nodes.select(*KEY, "conv_id", "n_convs", "words", *[F.col(f"up.q{k}").alias(f"q{k}") for k in _N], "src", F.coalesce("agree", F.lit(True)).alias("agree"))


def _join_ids(batches):
    """Sorted (key.., conv) rows to (key.., first, ids): runs of a key joined by commas, in pieces."""
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(i).to_numpy() for i in range(len(KEY))])
        conv = batch.column(len(KEY)).to_numpy()
        new = np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(0)])
        start = np.flatnonzero(new)
        long = np.diff(np.append(start, len(conv)))
        cuts = np.concatenate([np.arange(s, s + n, PIECE_IDS) for s, n in zip(start, long)])
        ends = np.append(cuts[1:], len(conv))
        text = conv.astype(str)
        ids = [",".join(text[a:z]) for a, z in zip(cuts, ends)]
        cols = [*[pa.array(k[cuts]) for k in key], pa.array(conv[cuts]), pa.array(ids)]
        yield pa.RecordBatch.from_arrays(cols, names=[*KEY, "first", "ids"])


def _hash_pieces(batches):
    """Sorted (key.., first, ids) rows to (key.., ends_sha256): one running hash per key."""
    now, running = None, None

    def out(done):
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in zip(*[k for k, _ in done])], pa.array([h for _, h in done])], names=[*KEY, "ends_sha256"])

    for batch in batches:
        done = []
        keys = zip(*[batch.column(i).to_pylist() for i in range(len(KEY))])
        for key, ids in zip(keys, batch.column(len(KEY) + 1).to_pylist()):
            if key != now:
                if now is not None:
                    done.append((now, running.hexdigest()))
                now, running = key, hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
        if done:
            yield out(done)
    if now is not None:
        yield out([(now, running.hexdigest())])


def end_hashes(rows: DataFrame) -> DataFrame:
    """(key.., ends_sha256) of the conversations that end at each node, ids ascending."""
    keys = ", ".join(f"{c} long" for c in KEY)
    ends = rows.where("ends").select(*KEY, "conv")
    pieces = ends.repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv").mapInArrow(_join_ids, f"{keys}, first long, ids string")
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_hash_pieces, f"{keys}, ends_sha256 string")


@by_value
def prefix_trie(conversations: DataFrame, seed: int = 0) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and the stored turn (src_conv_id, src_place) that it ends with."""
    turns = cut(stored_turns(conversations))
    if not one_content_per_hash(conversations):
        raise ValueError("two different turns share both 64-bit hashes")
    for again in range(8):
        rows = cut(members(turns, seed + again))
        nodes = cut(group_prefixes(rows))
        if nodes.where("not agree").isEmpty():
            break
    else:
        raise ValueError("fingerprints of different prefixes met under every base")
    nodes = nodes.drop("agree")
    parent = [(F.col("depth") - 1).alias("depth"), *[F.col(f"q{k}").alias(f"f{k}") for k in _N]]
    kids = nodes.where("depth > 0").select(*parent).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(kids, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = cut(nodes.withColumn("value", (F.col("n_convs") - 1) * F.col("words")).withColumn("block", F.floor(F.col("depth") / BLOCK)))
    # what each conversation counts: the values and the leaf of the nodes whose smallest member it is
    owned = cut(nodes.groupBy(F.col("conv_id").alias("conv"), "block").agg(F.sum("value").alias("value"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf")))
    totals = owned.groupBy("conv").agg(F.sum("value").alias("total"), F.max("leaf").alias("leaf"))
    below = join_hot(rows.select("conv", *KEY), cut(totals), ["conv"])
    below = below.groupBy(*KEY).agg(F.sum("total").alias("all_totals"), F.sum("leaf").alias("n_leaves"))
    later = Window.partitionBy("conv").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    owned = owned.select(F.col("conv").alias("conv_id"), "block", F.coalesce(F.sum("value").over(later), F.lit(0)).alias("later"))
    owned = owned.join(totals.select(F.col("conv").alias("conv_id"), "total"), "conv_id")
    down = Window.partitionBy("conv_id", "block").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    out = nodes.join(owned, ["conv_id", "block"]).withColumn("from_here", F.sum("value").over(down) + F.col("later"))
    out = out.join(below, KEY).withColumn("saved_tokens", F.col("all_totals") - F.col("total") + F.col("from_here"))
    out = out.join(end_hashes(rows), KEY, "left")
    out = cut(out.select(*parent, F.col("depth").alias("d"), "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "src"))
    ups = nodes.where("n_children > 0").select(*KEY, F.col("conv_id").alias("parent_conv_id"))
    out = join_hot(out, ups, KEY)
    return out.select(
        "conv_id",
        F.col("d").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        F.col("src.src_conv").alias("src_conv_id"),
        F.col("src.src_place").alias("src_place"),
    )


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")).drop("src_conv_id", "src_place")
