"""Approximate nearest neighbours by inner product: NN-descent and greedy graph search.

Vectors of equal content are one class, and classes are the nodes of a graph.
Nodes are linked by direction: on vectors of one length that is the order of
inner products, and on others it keeps the long ones from becoming everyone's
neighbours.  A code holds a vector in bytes on a scale of its own.

Building.  Random hyperplanes deal the nodes by their direction over small
blocks, a few times over, for first neighbours.  Then NN-descent: each round joins every node with
its neighbours and a sample of those it is a neighbour of, compares all pairs
that meet at a node, and keeps for each node the best; a round offers a pair
only if one of its edges is new and it beats the worst neighbour kept.  What
meets at a node is at most K + REVERSE vectors, so a hub costs no more than any
other node.

Searching.  A query starts at the nearest of a bounded sample of landmarks and
of the longest vectors, and at its own node if it has one; each round joins the
best nodes it has not expanded with their neighbours, scores those by inner
product, and keeps the best of a beam, until every node kept is expanded:
however large the table, no open node beats them.  The beam grows with the
table: CHECKED queries are compared with all vectors in one scan and searched
first, and while that finds less than GOAL of their nearest, they are searched
anew with a beam of twice the width.  The others are searched once, with the
width found; no query's search looks at another's.  That scan measures only; it
adds nothing to a result.  The scores that are returned are inner products of
the original vectors in double precision.

How it runs.  A node lives in a part, given by its id; parts grow in number with
the table and hold a bounded number of bytes.  What one part tells another in a
step is one row of packed arrays (``_ROW``), with each code in it once, so that
Spark moves a few rows per pair of parts where it would sort and group a row
per edge.  A round of NN-descent is one job of four such steps, a round of the
search one of two: queries send the nodes they expand to the parts these live
in, where the codes of the neighbours lie beside them, and get back those that
beat the worst of their beam.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do those of another length than most; equal rows
count once; a row is never its own neighbour; ties go to the smaller id; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_value, cut

K = 32  # neighbours kept per node
REVERSE = 32  # of those a node is a neighbour of, how many are sampled
OFFERS = 4  # best new partners that a meeting place offers a node
TABLES = 6  # times that hyperplanes deal the nodes
BLOCK = 1600  # nodes of a block
ROUNDS = 7  # at most; fewer where a round finds next to nothing new
LANDMARKS = 512  # bounded sample, and as many of the longest; a byte a component each is broadcast
BEAM = 128  # nodes kept per query, to begin with
EXPAND = 48  # nodes of a query that one round of the search expands, for a beam of BEAM
FIRST = 4  # nodes that the first round expands, when the best are still far; doubled each round up to EXPAND
GOAL = 0.95  # share of the nearest of the checked queries that the search must find
CHECKED = 128  # queries, by smallest hash, that are compared with all vectors; their vectors are broadcast
PLACES = 128  # meeting places that are compared at once
PART_BYTES = 300_000  # of codes of the nodes that live in a part; K + REVERSE times as many meet there
BEAM_ROWS = 1 << 18  # nodes in the beams of the queries of a slot
HEAD = 8  # bytes of a code before its components


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the distinct rows whose vector can take part."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null")
    rows = rows.where((F.size("v") > 0) & ~F.exists("v", bad)).where(F.exists("v", lambda x: x != 0))
    # -0.0 and 0.0 are one value
    rows = cut(rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))).distinct())
    usual = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.col("count").desc(), "dim").limit(1)
    dim = usual.first()
    return rows.where(F.size("v") == (dim["dim"] if dim else 0))


def _coder(longest: float):
    """Array of doubles to its code: scale and rounding error (4 bytes each), then one byte per component.

    ``longest`` keeps scales in range; codes stand for the vectors divided by it.
    """

    def code(col: pa.Array) -> pa.Array:
        n = len(col)
        flat = col.flatten().to_numpy(zero_copy_only=False)
        x = flat.reshape(n, -1) / longest if n else np.zeros((0, 1))
        scale = np.maximum(np.abs(x).max(axis=1, initial=0, keepdims=True) / 127, 1e-30).astype(np.float32)
        small = np.clip(np.rint(x / scale), -127, 127).astype(np.int8)
        off = np.sqrt(((x - small * scale.astype(np.float64)) ** 2).sum(axis=1, keepdims=True))
        off = (off * (1 + 1e-6) + 1e-37).astype(np.float32)
        both = np.concatenate([scale.view(np.uint8), off.view(np.uint8), small.view(np.uint8)], axis=1)
        return pa.array([r.tobytes() for r in both], pa.binary())

    return F.arrow_udf(code, returnType="binary")


def _bytes(col: pa.Array) -> np.ndarray:
    """Codes of a column, a row each."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not len(col):
        return np.zeros((0, HEAD + 1), np.uint8)
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2], np.uint8)[off[0] : off[-1]].reshape(len(col), -1)


def _parts_of(codes: np.ndarray):
    """Scales, rounding errors and components of codes."""
    head = np.ascontiguousarray(codes[:, :HEAD]).view(np.float32)
    return head[:, 0], head[:, 1], codes[:, HEAD:].view(np.int8)


def _vectors(codes: np.ndarray) -> np.ndarray:
    """The vectors of codes."""
    scale, _, small = _parts_of(codes)
    return small.astype(np.float32) * scale[:, None]


def _directions(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one."""
    x = x / np.maximum(np.abs(x).max(axis=1, initial=0, keepdims=True), 1e-37)
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-37)


def _norms(small: np.ndarray) -> np.ndarray:
    out = np.zeros(len(small), np.float32)
    for at in range(0, len(small), 16384):
        x = small[at : at + 16384].astype(np.float32)
        out[at : at + 16384] = np.sqrt(np.einsum("ij,ij->i", x, x))
    return out


def _dealer(bits: int, tables: int):
    """Code to one block key per table: the signs of random projections of the original part."""

    def deal(col: pa.Array) -> pa.Array:
        x = _vectors(_bytes(col))
        out = np.zeros((len(x), tables), np.int64)
        for t in range(tables):
            planes = np.random.default_rng([77, t]).standard_normal((x.shape[1], max(bits, 1))).astype(np.float32)
            out[:, t] = ((x @ planes > 0) * (1 << np.arange(max(bits, 1)))).sum(axis=1) if bits else 0
        offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * tables)
        return pa.ListArray.from_arrays(offsets, pa.array(out.reshape(-1)))

    return F.arrow_udf(deal, returnType="array<bigint>")


#: What parts hold and send: the part it is for, what it is, a count, and up to five packed arrays.
_ROW = "part long, kind int, n long, a binary, b binary, c binary, d binary, e binary"
NODE, STATE, OFFER, FORWARD, BACK, NOTE, MEET = range(7)


def _table(rows: list) -> pa.Table:
    """Rows (part, kind, n, array, ...) as a table of _ROW."""
    cols = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64())]
    for i in range(3, 8):
        cols.append(pa.array([np.ascontiguousarray(r[i]).tobytes() if i < len(r) else None for r in rows], pa.binary()))
    return pa.table(cols, names=["part", "kind", "n", "a", "b", "c", "d", "e"])


def _cells(t, i: int, *types) -> list[np.ndarray]:
    """The arrays of row i."""
    return [np.frombuffer(t.column(x)[i].as_buffer(), kind) for x, kind in zip("abcde", types)]


def _rows_of(t, kind: int) -> np.ndarray:
    return np.flatnonzero(t.column("kind").to_numpy() == kind)


def _got(t, kind: int, *types) -> list[np.ndarray]:
    """The arrays of all rows of a kind, one after the other."""
    each = [_cells(t, int(i), *types) for i in _rows_of(t, kind)]
    return [np.concatenate([x[j] for x in each]) if each else np.zeros(0, k) for j, k in enumerate(types)]


def _with(t, kind: int, rows: list) -> pa.Table:
    """The table's rows of a kind, followed by new rows."""
    if isinstance(t, pa.RecordBatch):
        t = pa.Table.from_batches([t])
    new = _table(rows)
    return pa.concat_tables([t.filter(pa.array(t.column("kind").to_numpy() == kind)).cast(new.schema), new])


def _hash(ids: np.ndarray, salt: int = 0) -> np.ndarray:
    h = (np.ascontiguousarray(ids, np.int64).view(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _home(ids: np.ndarray, parts: int) -> np.ndarray:
    """The part in which a node lives."""
    return (_hash(ids) >> np.uint64(8)) % np.uint64(parts)


def _runs(x: np.ndarray):
    """Bounds of the runs of equal values."""
    at = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)
    return at, np.append(at[1:], len(x))


def _ranks(x: np.ndarray) -> np.ndarray:
    """The place of each value in its run of equal values."""
    a, b = _runs(x)
    return np.arange(len(x)) - np.repeat(a, b - a)


def _sent(kind: int, to: np.ndarray, *arrays) -> list:
    """Rows with what goes to each part."""
    order = np.argsort(to, kind="stable")
    to, arrays = to[order], [x[order] for x in arrays]
    return [(int(to[a]), kind, b - a, *(x[a:b] for x in arrays)) for a, b in zip(*_runs(to))]


def _sent_codes(kind: int, to: np.ndarray, what: np.ndarray, v: np.ndarray, flag: np.ndarray, ids, codes, worst) -> list:
    """Rows with (ids, codes, worst) of what each part needs, once each, and for which v: 2 * place in ids + flag."""
    order = np.lexsort((what, to))
    to, what, v, flag = to[order], what[order], v[order], flag[order]
    out = []
    for a, b in zip(*_runs(to)):
        need, at = np.unique(what[a:b], return_inverse=True)
        out.append((int(to[a]), kind, b - a, ids[need], codes[need], worst[need], v[a:b], (2 * at + flag[a:b]).astype(np.int32)))
    return out


def _met(t, kind: int):
    """ids, codes, worst of the nodes, and (v, place in ids, flag), as sent by _sent_codes."""
    each = [_cells(t, int(i), np.int64, np.uint8, np.float32, np.int64, np.int32) for i in _rows_of(t, kind)]
    if not each:
        return np.zeros(0, np.int64), np.zeros((0, HEAD + 1), np.uint8), np.zeros(0, np.float32), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    base = np.cumsum([0] + [len(x[0]) for x in each])
    ids, codes, worst, v = (np.concatenate([x[j] for x in each]) for j in range(4))
    flag = np.concatenate([x[4] & 1 for x in each]).astype(bool)
    at = np.concatenate([(x[4] >> 1) + base[i] for i, x in enumerate(each)])
    return ids, codes.reshape(len(ids), -1), worst, v, at, flag


def _by_part(df: DataFrame, parts: int, step) -> DataFrame:
    """One step: ``step`` (a function of a part's rows) on every part."""
    return df.repartition(parts, "part").groupBy("part").applyInArrow(step, _ROW)


def _tidy(spark) -> None:
    """Let Spark's cleaner drop the shuffles and checkpoints of frames that are no longer used."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _block_neighbours(parts: int):
    """The K nearest of each node inside a block, block by block of rows, as offers."""

    def near(t):
        ids, (_, _, small) = t.column("node").to_numpy(), _parts_of(_bytes(t.column("code")))
        x, r = small.astype(np.float32), 1 / np.maximum(_norms(small), 1e-37)
        out = []
        k = min(K, len(ids) - 1)
        for at in range(0, len(ids) if k > 0 else 0, 512):
            s = (x[at : at + 512] @ x.T) * r[at : at + 512, None] * r[None, :]
            rows = np.arange(len(s))
            s[rows, at + rows] = -np.inf
            top = np.argpartition(-s, k - 1, axis=1)[:, :k]
            out.append((np.repeat(ids[at : at + 512], k), ids[top].reshape(-1), np.take_along_axis(s, top, axis=1).reshape(-1)))
        if not out:
            return _table([])
        node, nbr, sim = (np.concatenate(x) for x in zip(*out))
        return _table(_sent(OFFER, _home(node, parts), node, nbr, sim.astype(np.float32)))

    return near


def _state(t):
    """Ids in order, codes, neighbours, their similarities (-inf: none) and which of them are new, of a part's nodes."""
    ids, codes, nbr, sim, fresh = _got(t, STATE, np.int64, np.uint8, np.int64, np.float32, np.uint8)
    new, more = _got(t, NODE, np.int64, np.uint8)
    n = len(new) * K
    ids, codes = np.concatenate([ids, new]), np.concatenate([codes, more])
    nbr, sim, fresh = np.append(nbr, np.zeros(n, np.int64)), np.append(sim, np.full(n, -np.inf, np.float32)), np.append(fresh, np.zeros(n, np.uint8))
    order = np.argsort(ids)
    return ids[order], codes.reshape(len(ids), -1)[order], *(x.reshape(-1, K)[order] for x in (nbr, sim, fresh))


def _merge(t):
    """The K best of a node's neighbours and offers; a pair that was known before stays not fresh."""
    part = t.column("part")[0].as_py()
    ids, codes, nbr, sim, _ = _state(t)
    to, new, s = _got(t, OFFER, np.int64, np.int64, np.float32)
    has = sim > -np.inf
    node = np.append(np.nonzero(has)[0], np.searchsorted(ids, to))
    new, s, flag = np.append(nbr[has], new), np.append(sim[has], s), np.append(np.zeros(has.sum(), np.uint8), np.ones(len(to), np.uint8))
    order = np.lexsort((flag, new, node))
    node, new, s, flag = node[order], new[order], s[order], flag[order]
    first = np.append(True, (node[1:] != node[:-1]) | (new[1:] != new[:-1])) if len(node) else np.zeros(0, bool)
    node, new, s, flag = node[first], new[first], s[first], flag[first]
    order = np.lexsort((new, -s, node))
    node, new, s, flag = node[order], new[order], s[order], flag[order]
    rank = _ranks(node)
    keep = rank < K
    at = (node[keep], rank[keep])
    nbr, sim, fresh = np.zeros((len(ids), K), np.int64), np.full((len(ids), K), -np.inf, np.float32), np.zeros((len(ids), K), np.uint8)
    nbr[at], sim[at], fresh[at] = new[keep], s[keep], flag[keep]
    return _table([(part, STATE, int(fresh.sum()), ids, codes, nbr, sim, fresh)])


def _tell_back(parts: int):
    """Every node tells its neighbours that they are."""

    def tell(batches):
        for t in batches:
            yield t
            ids, _, nbr, sim, fresh = _state(t)
            has = sim > -np.inf
            node, nbr = np.repeat(ids, has.sum(axis=1)), nbr[has]
            yield from _table(_sent(BACK, _home(nbr, parts), nbr, node, fresh[has])).to_batches()

    return tell


def _sample_back(v, p, fresh, salt: int):
    """Up to REVERSE of the nodes p whose neighbour v is."""
    order = np.lexsort((p, _hash(p, salt), v))
    order = order[_ranks(v[order]) < REVERSE]
    return v[order], p[order], fresh[order]


def _distinct_pairs(v, p, fresh):
    """Distinct (v, p), fresh if one of them is."""
    order = np.lexsort((1 - fresh, p, v))
    v, p, fresh = v[order], p[order], fresh[order]
    first = np.append(True, (v[1:] != v[:-1]) | (p[1:] != p[:-1])) if len(v) else np.zeros(0, bool)
    return v[first], p[first], fresh[first]


def _invite(parts: int, salt: int):
    """Tell the neighbours of a node, and a sample of those it is a neighbour of, that they meet there."""

    def invite(t):
        ids, _, nbr, sim, fresh = _state(t)
        has = sim > -np.inf
        back = _sample_back(*_got(t, BACK, np.int64, np.int64, np.uint8), salt)
        v, p, new = _distinct_pairs(*(np.append(x, y) for x, y in zip((np.repeat(ids, has.sum(axis=1)), nbr[has], fresh[has]), back)))
        # where no edge is new, nothing new can meet
        a, b = _runs(v)
        some = np.repeat(np.logical_or.reduceat(new > 0, a) if len(a) else np.zeros(0, bool), b - a)
        return _with(t, STATE, _sent(NOTE, _home(p[some], parts), p[some], v[some], new[some]))

    return invite


def _come(parts: int):
    """Send codes to where they meet, and the similarity that an offer has to beat."""

    def come(t):
        ids, codes, _, sim, _ = _state(t)
        p, v, new = _got(t, NOTE, np.int64, np.int64, np.uint8)
        return _with(t, STATE, _sent_codes(MEET, _home(v, parts), np.searchsorted(ids, p), v, new, ids, codes, sim.min(axis=1)))

    return come


def _meet(parts: int):
    """All pairs that meet at each place v: the offers that beat a node's worst neighbour."""

    def meet(t):
        ids, codes, worst, v, at, fresh = _met(t, MEET)
        small = _parts_of(codes)[2]
        r = 1 / np.maximum(_norms(small), 1e-37)
        order = np.argsort(v, kind="stable")
        at, fresh = at[order], fresh[order]
        starts, ends = _runs(v[order])
        by_size = np.argsort(ends - starts, kind="stable")
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))]
        for c in range(0, len(by_size), PLACES):
            a, b = starts[by_size[c : c + PLACES]], ends[by_size[c : c + PLACES]]
            slot = a[:, None] + np.arange((b - a).max())
            there = slot < b[:, None]
            slot = np.where(there, slot, a[:, None])
            p, new = at[slot], fresh[slot]
            x, scale = small[p].astype(np.float32), r[p]
            s = np.matmul(x, x.transpose(0, 2, 1)) * scale[:, :, None] * scale[:, None, :]
            s[~(new[:, :, None] | new[:, None, :]) | ~there[:, None, :] | (p[:, :, None] == p[:, None, :])] = -np.inf
            i, j = np.nonzero((s.max(axis=2) > worst[p]) & there)
            s, me = s[i, j], p[i, j]
            k = min(OFFERS, s.shape[1])
            top = np.argpartition(-s, k - 1, axis=1)[:, :k]
            best = np.take_along_axis(s, top, axis=1)
            y, z = np.nonzero(best > worst[me][:, None])
            out.append((me[y], p[i[y], top[y, z]], best[y, z]))
        node, nbr, sim = (np.concatenate(x) for x in zip(*out))
        _, one = np.unique(node * len(ids) + nbr, return_index=True)
        node, nbr, sim = node[one], nbr[one], sim[one]
        order = np.lexsort((-sim, node))
        order = order[_ranks(node[order]) < K]
        node, nbr, sim = ids[node[order]], ids[nbr[order]], sim[order]
        return _with(t, STATE, _sent(OFFER, _home(node, parts), node, nbr, sim))

    return meet


def _homes(parts: int):
    """Nodes (node, code) to the parts in which they live."""

    def homes(batches):
        for t in batches:
            ids, codes = t.column("node").to_numpy(zero_copy_only=False), _bytes(t.column("code"))
            yield from _table(_sent(NODE, _home(ids, parts), ids, codes)).to_batches()

    return homes


def _parts(nodes: DataFrame, n: int) -> int:
    """How many parts hold n nodes, so that what meets in a part is bounded in bytes."""
    one = nodes.select(F.length("code").alias("n")).first()
    return max(-(-n * (one["n"] if one else 1) // PART_BYTES), min(24, -(-n // 256)), 1)


def build_graph(nodes: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(node, nbr, sim) neighbour graph of ``nodes`` (node, code)."""
    spark = nodes.sparkSession
    n = nodes.count()
    parts = _parts(nodes, n)
    bits = max(0, int(np.ceil(np.log2(max(n, 1) / (BLOCK / 2)))))
    dealt = nodes.select("node", "code", F.posexplode(_dealer(bits, TABLES)("code")).alias("t", "block"))
    dealt = cut(dealt)
    sizes = dealt.groupBy("t", "block").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    # blocks above their size are dealt at random over parts; one key per part,
    # so that all parts of a block need not meet in one task
    part = F.pmod(F.xxhash64("node", "t"), F.col("parts"))
    blocks = dealt.join(sizes, ["t", "block"]).select("node", "code", F.xxhash64("t", "block", part).alias("key"))
    first = blocks.groupBy("key").applyInArrow(_block_neighbours(parts), _ROW)
    homes = nodes.select("node", "code").mapInArrow(_homes(parts), _ROW)
    state = cut(_by_part(homes.union(first), parts, _merge))
    del dealt, sizes, blocks, first, homes
    _tidy(spark)
    for i in range(rounds):
        told = state.mapInArrow(_tell_back(parts), _ROW)
        met = _by_part(_by_part(_by_part(told, parts, _invite(parts, i)), parts, _come(parts)), parts, _meet(parts))
        state = cut(_by_part(met, parts, _merge))
        del told, met
        _tidy(spark)
        if (state.agg(F.sum("n")).first()[0] or 0) < 0.02 * n * K:
            break

    def edges(batches):
        for t in batches:
            ids, _, nbr, sim, _ = _state(t)
            has = sim > -np.inf
            edge = pa.table({"node": np.repeat(ids, has.sum(axis=1)), "nbr": nbr[has], "sim": sim[has]})
            yield from edge.to_batches(max_chunksize=65536)

    return state.mapInArrow(edges, "node long, nbr long, sim float")


def _both_ways(parts: int):
    """Edges (node, nbr) to the parts of both ends."""

    def send(batches):
        got, size = [], 0
        for t in batches:
            got.append((t.column("node").to_numpy(zero_copy_only=False), t.column("nbr").to_numpy(zero_copy_only=False)))
            size += len(got[-1][0])
            if size >= 1 << 20:
                yield from pack(got)
                got, size = [], 0
        yield from pack(got)

    def pack(got):
        node, nbr = (np.concatenate(x) for x in zip(*got)) if got else (np.zeros(0, np.int64),) * 2
        yield from _table(_sent(FORWARD, _home(node, parts), node, nbr) + _sent(BACK, _home(nbr, parts), nbr, node)).to_batches()

    return send


def _ways(nodes: DataFrame, graph: DataFrame, parts: int) -> DataFrame:
    """By part: its nodes, where the neighbours of each begin, which they are, and ids and codes of these.

    A node's neighbours are those of the graph, and up to REVERSE of those it is a neighbour of.
    """

    def ask(t):
        v, p = _got(t, FORWARD, np.int64, np.int64)
        back = _sample_back(*_got(t, BACK, np.int64, np.int64), np.zeros(sum(t.column("n")[int(i)].as_py() for i in _rows_of(t, BACK)), np.uint8), 99)
        v, p, _ = _distinct_pairs(np.append(v, back[0]), np.append(p, back[1]), np.zeros(len(v) + len(back[0]), np.uint8))
        return _with(t, NODE, _sent(NOTE, _home(p, parts), p, v))

    def answer(t):
        ids, codes = _got(t, NODE, np.int64, np.uint8)
        codes, order = codes.reshape(len(ids), -1), np.argsort(ids)
        ids, codes = ids[order], codes[order]
        p, v = _got(t, NOTE, np.int64, np.int64)
        at = np.searchsorted(ids, p)
        known = ids[np.minimum(at, len(ids) - 1)] == p if len(ids) else np.zeros(len(p), bool)
        at, v = at[known], v[known]
        return _table(_sent_codes(MEET, _home(v, parts), at, v, np.zeros(len(v), np.int32), ids, codes, np.zeros(len(ids), np.float32)))

    def lay(t):
        ids, codes, _, v, at, _ = _met(t, MEET)
        order = np.argsort(v, kind="stable")
        starts, _ = _runs(v[order])
        offsets = np.append(starts, len(v)).astype(np.int64)
        return _table([(t.column("part")[0].as_py(), MEET, len(starts), v[order][starts], offsets, at[order].astype(np.int32), ids, codes)])

    sent = nodes.select("node", "code").mapInArrow(_homes(parts), _ROW).union(graph.select("node", "nbr").mapInArrow(_both_ways(parts), _ROW))
    return _by_part(_by_part(_by_part(sent, parts, ask), parts, answer), parts, lay)


def _beam(query, node, sim, rad, done, n: int, width: int):
    """The ``width`` best distinct nodes of each of n queries, best first: nodes, sims (-inf: none), radii, expanded."""
    order = np.lexsort((-done.astype(np.int8), -sim, node, query))
    query, node, sim, rad, done = (x[order] for x in (query, node, sim, rad, done))
    first = np.append(True, (query[1:] != query[:-1]) | (node[1:] != node[:-1])) if len(query) else np.zeros(0, bool)
    query, node, sim, rad, done = (x[first] for x in (query, node, sim, rad, done))
    order = np.lexsort((node, -sim, query))
    query, node, sim, rad, done = (x[order] for x in (query, node, sim, rad, done))
    rank = _ranks(query)
    keep = rank < width
    at = (query[keep], rank[keep])
    out = [np.full((n, width), x, k) for x, k in ((0, np.int64), (-np.inf, np.float32), (0, np.float32), (0, np.uint8))]
    for x, y in zip(out, (node, sim, rad, done)):
        x[at] = y[keep]
    return out


def _radii(codes: np.ndarray, norms: np.ndarray):
    """By how much the inner product of a code with a direction may be off, but for the direction's error, and with it per unit."""
    scale, off, _ = _parts_of(codes)
    length = norms * scale
    return off + 1e-5 * length, length


def _turned(codes: np.ndarray) -> np.ndarray:
    """By how much the directions of codes may be off: |a/|a| - b/|b|| <= 2 |a - b| / (|a| + |b|)."""
    scale, off, small = _parts_of(codes)
    both = 2 * _norms(small) * scale - off
    return np.minimum(2 * off / np.maximum(both, 1e-37), 2).astype(np.float32)


def _starter(marks, widths: list[int]):
    """Queries (slot, query, code, own) to their first beams: the nearest landmarks, and the own node before all."""

    def start(t):
        ids, codes = marks.value
        slot = t.column("slot")[0].as_py()
        query, code = t.column("query").to_numpy(), _bytes(t.column("code"))
        own = t.column("own").combine_chunks() if isinstance(t.column("own"), pa.ChunkedArray) else t.column("own")
        has, own = np.asarray(own.is_valid()), np.asarray(own.fill_null(0))
        q, n = _directions(_vectors(code)), len(query)
        k = min(BEAM, len(ids))
        s = q @ _vectors(codes).T
        top = np.argsort(-s, axis=1, kind="stable")[:, :k]
        error, length = _radii(codes, _norms(_parts_of(codes)[2]))
        rad = error[top] + length[top] * _turned(code)[:, None]
        who = np.append(np.repeat(np.arange(n), k), np.flatnonzero(has))
        node = np.append(ids[top].reshape(-1), own[has])
        sim = np.append(np.take_along_axis(s, top, axis=1).reshape(-1), np.full(has.sum(), np.inf)).astype(np.float32)
        rad = np.append(rad.reshape(-1), np.zeros(has.sum())).astype(np.float32)
        rows = []
        for i, width in enumerate(widths):
            nodes, sims, radii, done = _beam(who, node, sim, rad, np.zeros(len(who), np.uint8), n, width)
            rows.append((slot * len(widths) + i, width, int((sims > -np.inf).sum()), query, code, nodes, np.stack([sims, radii]), done))
        return _table(rows)

    return start


def _search_state(t, i: int):
    width = t.column("kind")[i].as_py()
    query, codes, nodes, both, done = _cells(t, i, np.int64, np.uint8, np.int64, np.float32, np.uint8)
    sims, radii = both.reshape(2, -1, width)
    return width, query, codes.reshape(len(query), -1), nodes.reshape(-1, width), sims, radii, done.reshape(-1, width)


def _chosen(sims, done, width: int, step: int) -> np.ndarray:
    """The nodes that this round expands: the best open ones."""
    open_ = (done == 0) & (sims > -np.inf)
    return open_ & (np.cumsum(open_, axis=1) <= min(FIRST << step, max(EXPAND * width // BEAM, FIRST)))


def _expand(parts: int, step: int):
    """The nodes that queries expand, to the parts in which they live: with the queries' codes and worst of their beams."""

    def expand(batches):
        for t in batches:
            for i in range(t.num_rows):
                if not t.column("n")[i].as_py():
                    continue
                width, _, codes, nodes, sims, _, done = _search_state(t, i)
                who, at = np.nonzero(_chosen(sims, done, width, step))
                node = nodes[who, at]
                rows = []
                for to, _, _, x, w in _sent(0, _home(node, parts), node, who):
                    need, place = np.unique(w, return_inverse=True)
                    head = np.concatenate([need.astype(np.int32), sims[need, -1].view(np.int32)])
                    rows.append((to, width, t.column("part")[i].as_py(), x, place.astype(np.int32), head, codes[need]))
                yield from _table(rows).to_batches()

    return expand


def _score(ways, asked):
    """What queries get back from a part: the neighbours of the nodes they expand that may enter their beams."""
    if not ways.num_rows or not asked.num_rows:
        return _table([])
    v, offsets, at, ids, codes = _cells(ways, 0, np.int64, np.int64, np.int32, np.int64, np.uint8)
    codes = codes.reshape(len(ids), -1)
    scale, _, small = _parts_of(codes)
    rows = []
    error, length = _radii(codes, _norms(small))
    for i in range(asked.num_rows):
        node, who, head, qcodes = _cells(asked, i, np.int64, np.int32, np.int32, np.uint8)
        width, (need, bound) = asked.column("kind")[i].as_py(), head.reshape(2, -1)
        qcodes, bound = qcodes.reshape(len(need), -1), bound.view(np.float32)
        q = _directions(_vectors(qcodes))
        place = np.minimum(np.searchsorted(v, node), len(v) - 1)
        here = v[place] == node
        place, who = place[here], who[here]
        got = [(np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.float32))]
        for c in range(0, len(place), 256):
            a, b = offsets[place[c : c + 256]], offsets[place[c : c + 256] + 1]
            count = b - a
            p = at[np.repeat(a - np.cumsum(count) + count, count) + np.arange(count.sum())]
            w = np.repeat(who[c : c + 256], count)
            s = np.einsum("ij,ij->i", small[p].astype(np.float32), q[w]) * scale[p]
            in_ = s >= bound[w]
            got.append((w[in_], p[in_], s[in_]))
        w, p, s = (np.concatenate(x) for x in zip(*got))
        _, one = np.unique(w.astype(np.int64) * len(ids) + p, return_index=True)
        w, p, s = w[one], p[one], s[one]
        order = np.lexsort((ids[p], -s, w))
        order = order[_ranks(w[order]) < width]
        w, p, s = w[order], p[order], s[order]
        rad = error[p] + length[p] * _turned(qcodes)[w]
        rows.append((asked.column("n")[i].as_py(), width, len(w), need[w], ids[p], s.astype(np.float32), rad.astype(np.float32)))
    return _table(rows)


def _widen(step: int):
    """Beams, and what came back to them (rows without ``e``), to new beams."""

    def widen(t):
        held = np.asarray(t.column("e").is_valid())
        back, rows = t.filter(pa.array(~held)), []
        cells = [_cells(back, j, np.int32, np.int64, np.float32, np.float32) for j in range(back.num_rows)]
        new = [np.concatenate(x) for x in zip(*cells)] if cells else [np.zeros(0, k) for k in (np.int32, np.int64, np.float32, np.float32)]
        for i in np.flatnonzero(held):
            width, query, codes, nodes, sims, radii, done = _search_state(t, int(i))
            done = done | _chosen(sims, done, width, step)
            # only beams that get something change
            some, who = np.unique(new[0], return_inverse=True)
            has = sims[some] > -np.inf
            old = (np.nonzero(has)[0], nodes[some][has], sims[some][has], radii[some][has], done[some][has])
            merged = [np.append(x, y) for x, y in zip(old, (who, *new[1:], np.zeros(len(who), np.uint8)))]
            nodes, both, done = nodes.copy(), np.stack([sims, radii]), done.astype(np.uint8)
            nodes[some], both[0, some], both[1, some], done[some] = _beam(*merged, len(some), width)
            still = int(((done == 0) & (both[0] > -np.inf)).sum())
            rows.append((t.column("part")[int(i)].as_py(), width, still, query, codes, nodes, both, done))
        return _table(rows)

    return widen


def _result(best: int | None):
    """(query, node) of the beams; with ``best``, only those whose inner product may be among the best of the query, besides its own node."""

    def rows(batches):
        for t in batches:
            for i in range(t.num_rows):
                width, query, _, nodes, sims, radii, _ = _search_state(t, i)
                keep = sims > -np.inf
                if best is not None and best < width:
                    least = np.where(keep & (sims < np.inf), sims - radii, -np.inf)
                    least = -np.partition(-least, best - 1, axis=1)[:, best - 1]
                    keep &= sims + radii >= least[:, None]
                out = pa.table({"query": np.repeat(query, keep.sum(axis=1)), "node": nodes[keep]})
                yield from out.to_batches(max_chunksize=65536)

    return rows


def greedy_search(queries: DataFrame, nodes: DataFrame, graph: DataFrame, enough=None, best: int | None = None) -> DataFrame:
    """(query, node): the best nodes (node, code, length) found for each query (query, code, own: its node or null).

    While ``enough``, a function of that result for the checked queries, is false, these are searched with a wider
    beam, as long as one of them has more nodes than its beam holds; the others are searched with the last width only.
    With ``best``, nodes that cannot be among the ``best`` of a query by the vectors themselves are left out: the codes
    bound what these give.
    """
    spark = nodes.sparkSession
    # bounded samples: LANDMARKS rows each; few neighbours lead to the longest vectors, which many queries want
    marks = nodes.orderBy(F.xxhash64("node"), "node").limit(LANDMARKS).collect()
    far = nodes.orderBy(F.col("length").desc(), "node").limit(LANDMARKS).collect()
    marks = list({r["node"]: r for r in marks + far}.values())
    if not marks:
        return queries.select("query", F.col("own").alias("node")).limit(0)
    seed = np.array([r["node"] for r in marks], np.int64), np.array([np.frombuffer(bytes(r["code"]), np.uint8) for r in marks])
    seed = spark.sparkContext.broadcast(seed)
    parts = _parts(nodes, nodes.count())
    # stays dealt by part over the rounds
    ways = _ways(nodes, graph, parts).repartition(parts, "part").persist(StorageLevel.DISK_ONLY)

    def search(asked: DataFrame, n: int, widths: list[int]) -> DataFrame:
        slots = max(-(-n * max(widths) // BEAM_ROWS), min(24, -(-n // 64)), 1)
        dealt = asked.select(F.pmod(F.xxhash64("query"), F.lit(slots)).alias("slot"), "query", "code", "own")
        state = cut(dealt.groupBy("slot").applyInArrow(_starter(seed, widths), _ROW))
        step, slots = 0, slots * len(widths)
        # ends: each round expands a node of every open query, and one that leaves the beam never comes back
        while state.agg(F.sum("n")).first()[0]:
            sent = state.where("n > 0").mapInArrow(_expand(parts, step), _ROW).repartition(parts, "part")
            back = ways.groupBy("part").cogroup(sent.groupBy("part")).applyInArrow(_score, _ROW)
            # a union, as the planner takes the product of the sizes of two sides: a frame that meets itself round by
            # round would double the digits of that number, which checkpoints keep, and end in the driver's memory
            state = cut(_by_part(state.union(back), slots, _widen(step)))
            step = min(step + 1, 30)
            del sent, back
            _tidy(spark)
        return state

    def found(state: DataFrame, width: int, best: int | None = None) -> DataFrame:
        return state.where(F.col("kind") == width).mapInArrow(_result(best), "query long, node long")

    width = BEAM
    if enough is None:
        result = found(search(queries, queries.count(), [width]), width, best)
    else:
        checked = cut(_checked(queries))
        n = checked.count()
        # several widths at once: few queries
        widths = [width, 2 * width, 4 * width]
        state = search(checked, n, widths)
        while not enough(found(state, width)) and not found(state, width).groupBy("query").count().where(F.col("count") >= width).isEmpty():
            width *= 2
            if width > widths[-1]:
                widths = [width, 2 * width, 4 * width]
                state = search(checked, n, widths)
        others = cut(queries.join(checked.select("query"), "query", "left_anti"))
        result = found(state, width, best).union(found(search(others, others.count(), [width]), width, best))
    ways.unpersist()
    return result


def _checked(queries: DataFrame) -> DataFrame:
    return queries.orderBy(F.xxhash64("query"), "query").limit(CHECKED)


def _dot(a: str, b: str):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _checker(queries: DataFrame, classes: DataFrame, k: int):
    """Does a search result (query, node) hold GOAL of the k nearest classes (node, v) of CHECKED of the queries (query)?

    Counted by score, so that ties do not matter: how many of the nodes found are as near as the k-th nearest.
    """
    some = _checked(queries.select("query"))
    some = cut(some.join(classes.select(F.col("node").alias("query"), F.col("v").alias("qv")), "query"))
    rows = some.collect()
    if not rows:
        return None
    asked = classes.sparkSession.sparkContext.broadcast((np.array([r["query"] for r in rows], np.int64), np.array([r["qv"] for r in rows])))

    def scan(batches):
        ids, q = asked.value
        for t in batches:
            node = t.column("node").to_numpy(zero_copy_only=False)
            if not len(node):
                continue
            s = q @ t.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(node), -1).T
            s[ids[:, None] == node] = -np.inf
            top = np.argpartition(-s, min(k, len(node)) - 1, axis=1)[:, :k]
            best = np.take_along_axis(s, top, axis=1)
            yield pa.record_batch({"query": np.repeat(ids, best.shape[1]), "score": best.reshape(-1)})

    near = classes.select("node", "v").mapInArrow(scan, "query long, score double").where("score > double('-inf')")
    w = Window.partitionBy("query").orderBy(F.col("score").desc())
    near = near.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k)
    bounds = cut(near.groupBy("query").agg(F.min("score").alias("bound"), F.count(F.lit(1)).alias("n")))
    wanted = bounds.agg(F.sum("n")).first()[0] or 0

    def enough(found: DataFrame) -> bool:
        got = found.where("node != query").join(some, "query").join(classes, "node").join(bounds, "query")
        got = got.where(_dot("v", "qv") >= F.col("bound") - 1e-9 * F.abs("bound"))
        got = got.groupBy("query", "n").count().agg(F.sum(F.least("count", "n"))).first()[0] or 0
        return got >= GOAL * wanted

    return enough


@by_value
def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, id, score: the k nearest found for each row where ``is_query`` (a function of the id column) holds."""
    rows = usable(vectors, id_col, vec_col)
    # nodes are classes of equal vectors, named by a hash of their content
    classes = cut(rows.select("v").distinct().select(F.xxhash64("v").alias("node"), "v"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    code = _coder(classes.agg(F.max(length)).first()[0] or 1.0)
    nodes = cut(classes.select("node", code("v").alias("code"), length.alias("length")))
    graph = build_graph(nodes)
    # members of a class, as far as they can be among the k nearest of a query
    members = rows.select("id", F.xxhash64("v").alias("node"))
    w = Window.partitionBy("node").orderBy("id")
    members = cut(members.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1).drop("r"))
    asked = rows.where(is_query(F.col("id")))
    # equal vectors ask alike: one search per class
    asked_classes = asked.select(F.xxhash64("v").alias("query")).distinct()
    q = cut(asked_classes.join(nodes, asked_classes["query"] == nodes["node"]).select("query", "code", F.col("node").alias("own")))
    found = greedy_search(q, nodes, graph, _checker(q, classes, k), k + 1)
    exact = found.join(classes.select("node", "v"), "node").join(classes.select(F.col("node").alias("query"), F.col("v").alias("qv")), "query")
    exact = exact.select("query", "node", _dot("v", "qv").alias("score"))
    hits = exact.join(members, "node").select("query", "id", "score")
    # the k + 1 best ids of a class of queries serve each of its rows, less the row itself
    w_ids = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    hits = cut(hits.withColumn("r", F.row_number().over(w_ids)).where(F.col("r") <= k + 1).drop("r"))
    pairs = asked.select(F.col("id").alias("query_id"), F.xxhash64("v").alias("query")).join(hits, "query").where("query_id != id")
    last = Window.partitionBy("query_id", "query").orderBy(F.col("score").desc(), "id")
    out = pairs.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", F.col("id").alias(id_col), "score")


def op1_nn_descent(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), lambda i: i % 20 == 0)
