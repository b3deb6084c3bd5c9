"""Best-fit packing by a grouping genetic algorithm on islands.

Every text is tokenised and closed with an end token; longer ones are cut into
pieces of the sequence length, the first piece being the shorter one.  Pieces
shorter than a sequence are packed.

Items are dealt over blocks of bounded size.  Several islands evolve each block
from different seeds: individuals are groupings of the block's items into bins,
crossover injects whole well-filled bins of one parent into another, drops the
bins that held the injected items, and best-fits what those bins still held;
mutation empties the worst bins.  After an epoch the elite of an island
migrates to the next island of its ring, and the islands evolve on; the best
island gives the block's bins.  Bins that stay well below full are opened again
and their items dealt over fewer blocks, so that leftovers of all blocks meet,
until one block is left or opening no longer helps.  Work is linear in the
number of items, and no group is larger than a block.

Defined results: a null or empty text is its end token alone; repeated rows are
packed each on its own; ties are broken by the rows' order; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import _iterating, encoder
from .common import by_value, cut, text_or_empty

BLOCK = 4096  # items a block holds on average
ISLANDS = 2
POPULATION = 3
GENERATIONS = 3  # per epoch
EPOCHS = 2
CLOSED = 0.97  # bins filled this far stay; the others are opened in the next round
MAX_ROUNDS = 8


def best_fit(lens: list[int], items: list[int], room: list[int], bin_of: list[int], size: int) -> None:
    """Put each item, longest first, into the open bin it fills best, or a new one.  ``room`` is extended, ``bin_of`` set."""
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    mask = 0
    for b, r in enumerate(room):
        if r:
            by_room[r].append(b)
            mask |= 1 << r
    for i in sorted(items, key=lens.__getitem__, reverse=True):
        need = lens[i]
        fits = mask >> need
        if fits:
            r = need + (fits & -fits).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                mask &= ~(1 << r)
        else:
            r, b = size, len(room)
            room.append(size)
        r -= need
        room[b] = r
        if r:
            by_room[r].append(b)
            mask |= 1 << r
        bin_of[i] = b


def _compact(bin_of: np.ndarray) -> np.ndarray:
    return np.unique(bin_of, return_inverse=True)[1].reshape(-1)


def _refit(lens: np.ndarray, bin_of: np.ndarray, loose: np.ndarray, size: int) -> np.ndarray:
    """Best-fit the loose items among the bins of the others."""
    fixed = np.flatnonzero(~loose)
    out = np.full(len(lens), -1)
    out[fixed] = _compact(bin_of[fixed]) if len(fixed) else []
    room = (size - np.bincount(out[fixed], weights=lens[fixed], minlength=0)).astype(int).tolist() if len(fixed) else []
    placed = out.tolist()
    best_fit(lens.tolist(), np.flatnonzero(loose).tolist(), room, placed, size)
    return np.array(placed)


def quality(lens: np.ndarray, bin_of: np.ndarray, size: int) -> tuple[int, float]:
    """(number of bins, mean of squared fill); fewer bins first, then fuller ones."""
    fill = np.bincount(bin_of, weights=lens) / size
    return int(len(fill)), float((fill**2).mean())


def crossover(lens: np.ndarray, host: np.ndarray, giver: np.ndarray, size: int, rng) -> np.ndarray:
    """Inject half of the giver's well-filled bins into the host; what they push out is best-fitted."""
    fill = np.bincount(giver, weights=lens)
    good = np.flatnonzero(fill >= CLOSED * size)
    if not len(good):
        good = np.argsort(-fill, kind="stable")[: max(1, len(fill) // 4)]
    chosen = good[rng.random(len(good)) < 0.5]
    injected = np.isin(giver, chosen)
    hit = np.zeros(int(host.max()) + 1, bool)
    hit[host[injected]] = True
    loose = hit[host] & ~injected
    merged = np.where(injected, giver + len(hit), host)
    return _refit(lens, merged, loose, size)


def mutate(lens: np.ndarray, bin_of: np.ndarray, size: int, rng) -> np.ndarray:
    """Empty the worst-filled bins and a few others, and best-fit their items."""
    fill = np.bincount(bin_of, weights=lens)
    n = len(fill)
    drop = np.zeros(n, bool)
    drop[np.argsort(fill, kind="stable")[: max(1, n // 20)]] = True
    drop |= rng.random(n) < 0.03
    return _refit(lens, bin_of, drop[bin_of], size)


def evolve(lens: np.ndarray, seeds: list[np.ndarray], size: int, rng) -> np.ndarray:
    """The best grouping after GENERATIONS, from given individuals and new ones."""
    everyone = np.ones(len(lens), bool)
    pop = [s for s in seeds if len(s)]
    if not pop:
        pop.append(_refit(lens, np.zeros(len(lens), int), everyone, size))
    while len(pop) < POPULATION:  # best fit of a random part, the rest after it
        first = rng.random(len(lens)) < 0.5
        start = np.zeros(len(lens), np.int64)
        if first.any():
            start[first] = _refit(lens[first], start[first], np.ones(int(first.sum()), bool), size)
        pop.append(_refit(lens, start, ~first, size))

    def key(x: np.ndarray) -> tuple[float, float]:
        n, q = quality(lens, x, size)
        return n, -q

    least = -(-int(lens.sum()) // size)
    pop.sort(key=key)
    for _ in range(GENERATIONS):
        if key(pop[0])[0] <= least:
            break  # no grouping has fewer bins
        child = crossover(lens, pop[0], pop[int(rng.integers(1, len(pop)))], size, rng)
        other = mutate(lens, pop[int(rng.integers(0, len(pop)))], size, rng)
        pop = sorted([*pop, child, other], key=key)[:POPULATION]
    return pop[0]


def _epoch(size: int):
    """Evolve one island of one block; rows: row_id, len, kind (0 item, 1 own elite, 2 migrant), bin."""

    def run(key, t):
        block, island = key[0].as_py(), key[1].as_py()
        row, ln, kind, bins = (t.column(c).to_numpy() for c in ("row_id", "len", "kind", "bin"))
        order = np.lexsort((row, kind))
        row, ln, kind, bins = row[order], ln[order], kind[order], bins[order]
        kinds = np.unique(kind)
        ids, lens = row[kind == kinds[0]], ln[kind == kinds[0]].astype(np.int64)
        seeds = [_compact(bins[kind == k]) for k in kinds if k > 0]
        rng = np.random.default_rng([abs(int(block)), int(island), len(seeds)])
        best = _compact(evolve(lens, seeds, size, rng))
        n, q = quality(lens, best, size)
        # offsets: within its bin, in row order
        by_bin = np.argsort(best, kind="stable")
        before = np.cumsum(lens[by_bin]) - lens[by_bin]
        first = np.searchsorted(best[by_bin], np.arange(n))
        offset = np.empty(len(lens), np.int64)
        offset[by_bin] = before - before[first][best[by_bin]]
        fill = np.bincount(best, weights=lens)[best].astype(np.int64)
        same = len(ids)
        return pa.table(
            {
                "block": pa.array(np.full(same, block), pa.int64()),
                "island": pa.array(np.full(same, island), pa.int32()),
                "row_id": pa.array(ids, pa.int64()),
                "len": pa.array(lens, pa.int64()),
                "bin": pa.array(best, pa.int64()),
                "offset": pa.array(offset, pa.int64()),
                "fill": pa.array(fill, pa.int64()),
                "bins": pa.array(np.full(same, n), pa.int64()),
                "quality": pa.array(np.full(same, q), pa.float64()),
            }
        )

    return run


_EPOCH_TYPE = "block long, island int, row_id long, len long, bin long, offset long, fill long, bins long, quality double"


@by_value
def group_items(items: DataFrame, size: int) -> DataFrame:
    """(row_id, sequence_id, offset) for items (row_id, len) with len below ``size``."""
    out, left, number = None, items, items.count()
    for round_no in range(MAX_ROUNDS):
        blocks = max(1, -(-number // BLOCK))
        dealt = left.select((F.pmod(F.xxhash64("row_id", F.lit(round_no)), F.lit(blocks))).alias("block"), "row_id", F.col("len").cast("long").alias("len"))
        state = dealt.select("block", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island"), "row_id", "len", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("bin"))
        for _ in range(EPOCHS):
            best = cut(state.groupBy("block", "island").applyInArrow(_epoch(size), _EPOCH_TYPE))
            own = best.select("block", "island", "row_id", "len", F.lit(1).alias("kind"), "bin")
            elite = best.select("block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int").alias("island"), "row_id", "len", F.lit(2).alias("kind"), "bin")
            state = own.union(elite)
        rank = F.struct("bins", (-F.col("quality")).alias("q"), "island")
        winner = best.groupBy("block").agg(F.min(rank).alias("w")).select("block", F.col("w.island").alias("island"))
        won = best.join(winner, ["block", "island"])
        # sequence ids: round, block and bin side by side (blocks hold fewer than 2**20 bins)
        named = won.select("row_id", "len", "fill", "offset", (F.lit(round_no << 58) + F.col("block") * (1 << 20) + F.col("bin")).alias("sequence_id"))
        full = F.col("fill") >= F.lit(int(CLOSED * size))
        if blocks == 1 or round_no == MAX_ROUNDS - 1:
            part, number = named, 0
        else:
            named = cut(named)
            again = named.where(~full).count()
            if again > 0.5 * number:  # most bins stay open: opening them again would not help
                part, number = named, 0
            else:
                part, left, number = named.where(full), named.where(~full).select("row_id", "len"), again
        part = part.select("row_id", "sequence_id", "offset")
        out = part if out is None else out.union(part)
        if not number:
            return out
    return out


PIECES_TYPE = "array<struct<piece:int,start:bigint,length:bigint,crc:bigint>>"


@by_value
def with_pieces(df: DataFrame, path: str, size: int, end_id: int, text_col: str = "text", out: str = "pieces") -> DataFrame:
    """``df`` with the pieces of each whole text: number, first id, number of ids, CRC-32 of the ids as 32-bit little-endian words."""

    def cut_up(batches):
        enc = encoder(path)
        for col in batches:
            offsets, piece, start, length, crc = [0], [], [], [], []
            for lo, hi, flat, id_off, _, _ in enc.slices(col):
                # the end id after each text's ids
                closed = np.insert(flat, id_off[1:], end_id).astype("<u4", copy=False)
                ends = (id_off + np.arange(len(id_off))).tolist()
                words = memoryview(closed)
                for a, z in zip(ends, ends[1:]):
                    n = z - a
                    at, k = 0, 0
                    while at < n:
                        stop = at + ((n - at) % size or size) if k == 0 else at + size
                        piece.append(k)
                        start.append(at)
                        length.append(stop - at)
                        crc.append(zlib.crc32(words[a + at : a + stop]))
                        at, k = stop, k + 1
                    offsets.append(len(piece))
            items = pa.StructArray.from_arrays(
                [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["piece", "start", "length", "crc"],
            )
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)

    return df.withColumn(out, _iterating(cut_up, PIECES_TYPE)(text_or_empty(text_col)))


def pack(df: DataFrame, path: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    rows = with_pieces(df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), path, size, end_id)
    rows = rows.select("id", F.explode("pieces").alias("p")).select("id", "p.*")
    rows = cut(rows.withColumn("row_id", F.monotonically_increasing_id()))  # stored, so the ids stay
    whole = rows.where(F.col("length") == size).withColumn("sequence_id", -1 - F.col("row_id")).withColumn("offset", F.lit(0).cast("long"))
    items = rows.where(F.col("length") < size)
    placed = group_items(items.select("row_id", F.col("length").alias("len")), size)
    packed = items.join(placed, "row_id")
    cols = [F.col("id").alias(id_col), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id", "offset"]
    return whole.select(*cols).unionByName(packed.select(*cols))


def op2_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as vocabularies

    from .common import table

    return pack(table(spark, sf_dir, "documents"), vocabularies.path("byte_bpe_50k.json"))


def pack_documents(df: DataFrame) -> DataFrame:
    """Pipeline stage: the packed pieces of the documents."""
    import public_tokenizers as vocabularies

    return pack(df, vocabularies.path("byte_bpe_50k.json"))
