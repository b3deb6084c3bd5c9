"""Ranked lexical search of many queries at once, by shared partial accumulators.

A term adds the same amount to a document's score whichever item asks for it,
so items that share terms share work.  Terms that occur in exactly the same
items form one shared set; the sets of an item, in order of how many items hold
them, form a sequence, and two sets that are neighbours in several sequences
are merged into a new one, again and again, until no pair of neighbours is
shared.  The result is a graph: its leaves are sets of terms, an inner node is
the sum of two others, and an item is the sum of a few nodes.  For a batch of
documents each leaf's accumulator is filled once, each inner node is one
addition, and each item adds up what is left of its sequence.

Two passes: the first counts, per document, its terms and those of the queries
(numpy over Arrow buffers; the full bytes of a term are compared, not only its
hash) and stores these short rows; document frequencies come from them by a
Spark aggregate.  The second scores the stored rows; a task keeps the best
``top`` per item, and a window picks the best of all tasks.

Queries go in blocks of at most ``BLOCK_PAIRS`` (item, term) pairs, which bounds
what is broadcast.  An item with more terms than half a block is dealt over
several blocks by term; its partial scores, unlimited, are then added per
document before it is ranked.

Defined results: null, empty and termless texts have no terms: such an item has
no rows, such a document counts nowhere.  Repeated item ids form one item with
the terms of all their texts; rows without an item id are left out.  Repeated
document rows are documents of their own; rows without a document id count in
the statistics and are not ranked.  Equal scores go by ascending document id,
which must be an integer.  Extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textscan as ts
from .common import by_value, cut, table

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 50
BLOCK_PAIRS = 1 << 18
CELLS = 1 << 21
#: Fixed values of the score: length share in hundredths, saturation in thousandths, and the scale of a term's part.
LENGTH_SHARE, SATURATION, SCALE = 50, 20, 1_000_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# ------------------------------------------------------------------ queries


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (item, term)."""
    text = F.translate(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), _UPPER, _LOWER)
    rows = items.where(F.col(f"`{id_col}`").isNotNull())
    return rows.select(F.col(f"`{id_col}`").alias("item"), F.explode(F.regexp_extract_all(text, F.lit(TERM), 0)).alias("term")).distinct()


def blocks_of(pairs: DataFrame, most: int = BLOCK_PAIRS) -> tuple[DataFrame, int]:
    """(item, term, wide, block) and the number of blocks; no block has more than ``most`` rows."""
    sizes = pairs.groupBy("item").agg((F.count(F.lit(1)) > most // 2).alias("wide"))
    pairs = cut(pairs.join(sizes, "item"))
    n = max(1, math.ceil(2 * pairs.count() / most))
    while True:
        place = F.when(F.col("wide"), F.xxhash64("item", "term")).otherwise(F.xxhash64("item"))
        dealt = pairs.withColumn("block", F.pmod(place, F.lit(n)).cast("int"))
        largest = dealt.groupBy("block").count().agg(F.max("count")).first()[0]
        if (largest or 0) <= most:
            return dealt, n
        n *= 2


@dataclass
class Plan:
    """The query graph of a block: leaves come first, then each inner node after the two that it adds."""

    items: list  # item ids
    wide: np.ndarray  # per item: more terms elsewhere
    seed: int  # of the terms' hashes
    hashes: np.ndarray  # sorted
    text: np.ndarray  # bytes of all terms, by hash
    at: np.ndarray  # offsets into them
    leaf: np.ndarray  # leaf of each term
    n_leaves: int
    sums: list  # (left, right) of each inner node
    tops: list  # nodes that each item adds


def merge_neighbours(rows: list[list[int]], n: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Replace neighbours that several rows share by new nodes, numbered from ``n``, until none is shared.

    Nodes are distinct within a row.  Of two overlapping pairs the one that more
    rows share is taken; each round shortens the rows, so it ends.
    """
    sums: list[tuple[int, int]] = []
    while True:
        count = Counter(p for r in rows for p in zip(r, r[1:]))
        made: dict[tuple[int, int], int] = {}
        out = []
        for r in rows:
            new, i = [], 0
            while i < len(r):
                here = count[r[i], r[i + 1]] if i + 1 < len(r) else 0
                after = count[r[i + 1], r[i + 2]] if i + 2 < len(r) else 0
                if here >= 2 and here >= after:
                    pair = (r[i], r[i + 1])
                    if pair not in made:
                        made[pair] = n + len(sums)
                        sums.append(pair)
                    new.append(made[pair])
                    i += 2
                else:
                    new.append(r[i])
                    i += 1
            out.append(new)
        if not made:
            return sums, rows
        rows = out


def _hashed(terms: list[bytes], seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lens = np.array([len(t) for t in terms], np.int64)
    at = np.concatenate([[0], np.cumsum(lens)])
    data = np.frombuffer(b"".join(terms), np.uint8)
    return ts.hash_spans(data, at[:-1], at[1:], seed), data, at


def plan_block(pairs: list[tuple]) -> Plan:
    """The query graph of (item, term, wide) rows, at most a block of them."""
    holders: dict[str, list] = {}
    wide: dict = {}
    for item, term, is_wide in sorted(pairs, key=lambda p: (p[0], p[1])):
        holders.setdefault(term, []).append(item)
        wide[item] = is_wide
    by_holders: dict[tuple, list[str]] = {}
    for term, who in holders.items():
        by_holders.setdefault(tuple(who), []).append(term)
    order = sorted(by_holders, key=lambda who: (-len(who), who))  # most shared first
    leaf_of = {t: i for i, who in enumerate(order) for t in by_holders[who]}
    items = sorted(wide)
    rows: dict = {i: [] for i in items}
    for i, who in enumerate(order):
        for item in who:
            rows[item].append(i)
    sums, tops = merge_neighbours([rows[i] for i in items], len(order))
    seed = 11
    terms = sorted((t.encode("utf-8"), t) for t in leaf_of)
    while True:  # a seed under which no two terms of the block share their hash
        h, _, _ = _hashed([b for b, _ in terms], seed)
        if len(np.unique(h)) == len(terms):
            break
        seed += 1
    by_hash = np.argsort(h)
    terms = [terms[i] for i in by_hash]
    h, data, at = _hashed([b for b, _ in terms], seed)
    leaf = np.array([leaf_of[t] for _, t in terms], np.int64)
    return Plan(items, np.array([wide[i] for i in items], bool), seed, h, data, at, leaf, len(order), sums, tops)


# ---------------------------------------------------------------- documents

COUNTS = "struct<n:bigint,term:array<int>,tf:array<int>>"


def _same_bytes(data, starts, lens, text, at) -> np.ndarray:
    """Whether data[start : start + len] equals the term text[at : at + len], per pair."""
    if not len(starts):
        return np.zeros(0, bool)
    first = np.cumsum(lens) - lens
    pos = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(first, lens)
    same = data[pos + np.repeat(starts, lens)] == text[pos + np.repeat(at, lens)]
    return np.logical_and.reduceat(same, first)


def count_terms(col: pa.Array, plan: Plan) -> pa.Array:
    """Per text: its number of terms, and number and count of each term that the plan knows."""
    n_all, sizes, ids, tfs = np.zeros(len(col), np.int64), np.zeros(len(col), np.int64), [], []
    known = len(plan.hashes)
    for lo, hi, raw, off in ts.slices(col):
        data = ts.LOWER[raw]
        starts, ends, row = ts.words(data, off, ts.NOT_ALNUM)
        n_all[lo:hi] = np.bincount(row, minlength=hi - lo)
        if not known or not len(starts):
            continue
        h = ts.hash_spans(data, starts, ends, plan.seed)
        at = np.minimum(np.searchsorted(plan.hashes, h), known - 1)
        hit = np.flatnonzero((plan.hashes[at] == h) & (ends - starts == plan.at[at + 1] - plan.at[at]))
        hit = hit[_same_bytes(data, starts[hit], (ends - starts)[hit], plan.text, plan.at[at[hit]])]
        key, tf = np.unique(row[hit] * known + at[hit], return_counts=True)
        sizes[lo:hi] = np.bincount(key // known, minlength=hi - lo)
        ids.append((key % known).astype(np.int32))
        tfs.append(tf.astype(np.int32))
    off = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    lists = [pa.ListArray.from_arrays(off, pa.array(np.concatenate([np.zeros(0, np.int32), *x]))) for x in (ids, tfs)]
    return pa.StructArray.from_arrays([pa.array(n_all), *lists], names=["n", "term", "tf"])


class Best:
    """The ``top`` best (score, doc) of each item among what was added; an item with ``all_of`` keeps everything."""

    def __init__(self, n_items: int, top: int, all_of: np.ndarray):
        self.top, self.all_of = top, all_of
        self.least = np.ones(n_items, np.int64)
        self.kept = [np.zeros((4, 0), np.int64)]
        self.held = 0

    def add(self, scores: np.ndarray, docs: np.ndarray, rows: np.ndarray) -> None:
        """scores is items x documents."""
        item, d = np.nonzero(scores >= self.least[:, None])
        self.kept.append(np.stack([item, scores[item, d], docs[d], rows[d]]))
        self.held += len(item)
        if self.held > 1 << 20:
            self.prune()

    def prune(self) -> np.ndarray:
        item, score, doc, row = x = np.concatenate(self.kept, axis=1)
        order = np.lexsort((row, doc, -score, item))
        x = x[:, order]
        item = x[0]
        first = np.searchsorted(item, np.arange(len(self.least)))
        rank = np.arange(len(item)) - first[item]
        last = (rank == self.top - 1) & ~self.all_of[item]
        self.least[item[last]] = x[1][last]
        x = x[:, (rank < self.top) | self.all_of[item]]
        self.kept, self.held = [x], 0  # what is left is bounded but for items that keep all
        return x


def score_rows(n, off, term, tf, plan: Plan, weight: np.ndarray, docs_n: int, terms_n: int) -> np.ndarray:
    """Items x documents: exact 64-bit scores of a batch, by one accumulator per node of the graph."""
    row = np.repeat(np.arange(len(n)), np.diff(off))
    m = (100 - LENGTH_SHARE) + (LENGTH_SHARE * n * docs_n) // max(terms_n, 1)
    part = weight[term] * ((SCALE * tf) // (1000 * tf + SATURATION * m[row]))
    acc = np.zeros((plan.n_leaves + len(plan.sums), len(n)), np.int64)
    np.add.at(acc, (plan.leaf[term], row), part)
    for k, (a, b) in enumerate(plan.sums, plan.n_leaves):
        np.add(acc[a], acc[b], out=acc[k])
    return np.stack([acc[nodes].sum(0) for nodes in plan.tops])


def _scorer(shared, top: int, id_type: pa.DataType):
    def run(batches):
        plan, weight, docs_n, terms_n = shared.value
        best = Best(len(plan.items), top, plan.wide)
        most = max(1, CELLS // (plan.n_leaves + len(plan.sums) + len(plan.items)))

        def rows(x):
            ids = pa.array(plan.items, id_type).take(pa.array(x[0]))
            cols = [ids, pa.array(x[2]), pa.array(x[3]), pa.array(x[1])]
            return pa.RecordBatch.from_arrays(cols, names=["item", "doc", "uid", "score"])

        for batch in batches:
            doc, uid, n = (batch.column(i).to_numpy() for i in range(3))
            lists = [batch.column(i) for i in (3, 4)]
            off = np.asarray(lists[0].offsets)
            term, tf = (x.values.to_numpy().astype(np.int64) for x in lists)
            for a in range(0, len(n), most):
                z = min(a + most, len(n))
                s, e = off[a], off[z]
                best.add(score_rows(n[a:z], off[a : z + 1] - s, term[s:e], tf[s:e], plan, weight, docs_n, terms_n), doc[a:z], uid[a:z])
            if plan.wide.any():  # those may be as many as the documents: they leave with each batch
                x = best.prune()
                out = plan.wide[x[0]]
                yield rows(x[:, out])
                best.kept = [x[:, ~out]]
        yield rows(best.prune())

    return run


@by_value
def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """(item_col, rank, id_col, score): each item's ``top`` best documents with a score above 0."""
    spark = docs.sparkSession
    item_type = items.schema[item_col].dataType
    pairs, n_blocks = blocks_of(item_terms(items, item_col, item_text), block_pairs)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.monotonically_increasing_id().alias("uid"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = spark.createDataFrame([], f"item {item_type.simpleString()}, doc long, uid long, score long")
    out_schema = found.schema
    for b in range(n_blocks):
        asked = [(r["item"], r["term"], r["wide"]) for r in pairs.where(F.col("block") == b).collect()]  # at most block_pairs
        if not asked:
            continue
        plan = plan_block(asked)
        shared = spark.sparkContext.broadcast(plan)
        count = F.arrow_udf(lambda col, shared=shared: count_terms(col, shared.value), returnType=COUNTS)
        counted = cut(rows.select("doc", "uid", count("text").alias("c")).where("c.n > 0").select("doc", "uid", "c.*"))
        total = counted.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        df = np.zeros(len(plan.hashes), np.int64)
        for r in counted.select(F.explode("term").alias("t")).groupBy("t").count().collect():  # at most block_pairs
            df[r["t"]] = r["count"]
        weight = np.array([math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        known = spark.sparkContext.broadcast((plan, weight, total["docs"], total["terms"]))
        hits = counted.where("doc is not null and size(term) > 0").select("doc", "uid", "n", "term", "tf")
        some = hits.mapInArrow(_scorer(known, top, _arrow(item_type)), out_schema)
        if n_blocks > 1:
            some = cut(some)
        found = found.union(some)
    if n_blocks > 1:  # a wide item has parts of a score in several blocks
        found = found.groupBy("item", "doc", "uid").agg(F.sum("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), "doc", "uid"))
    ranked = found.withColumn("rank", place).where(F.col("rank") <= top)
    return ranked.select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score")


def _arrow(data_type) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(data_type)


def op11_shared_search(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
