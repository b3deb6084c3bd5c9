"""Language identification by a string kernel, Nystroem landmarks and kernel ridge regression.

Two texts are compared by the blended spectrum of presence: the number of
distinct byte n-grams (n = 1 to 4, lower case, ASCII signs other than letters
read as a space) that both hold, over the root of the product of their own
numbers.  ``LANDMARKS`` training pieces span the Nystroem approximation of that
kernel, and one ridge regression per language (targets +1 and -1) is solved in
their span.  N-grams that no landmark holds meet nothing, so they count in no
product and no norm.

Texts are scored in batches: the presence matrix of a batch (texts x n-grams)
times the n-grams' weights, which are the landmarks' presence times the solved
coefficients.  That is the sum over landmarks of coefficient times kernel, with
its factors taken in the other order, and needs no kernel matrix of the corpus.

What is fitted comes from a bounded sample: distinct pieces of at most ``PIECE``
characters of the labelled texts (a long text gives several), by smallest hash
of the piece, at most ``MAX_TRAIN`` over all languages, evenly shared.  Scores
are of whole texts.  Work per batch is bounded by ``CELLS``, a single text by
its own length.

Defined results: null texts and texts without a letter are ``und`` with score
0; so is every text when nothing was learned.  A text that holds no known
n-gram gets the first language by name, with score 0.  Ties go to the first
language by name.  Null languages teach nothing; repeated rows are scored alike
and teach once; extra columns stay, and the new ones must not clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textscan as ts
from .common import by_value, cut, fresh, table

WIDTH = 4
LANDMARKS = 256
MAX_TRAIN = 4096
PIECE = 8192
RIDGE = 1e-3
CELLS = 1 << 23
UNKNOWN = "und"
RESULT = "struct<lang:string,score:double>"

_FOLD = np.array([ts.LOWER[b] if b > 127 or chr(b).isalpha() else 0x20 for b in range(256)], np.uint8)


def gram_codes(data: np.ndarray, off: np.ndarray):
    """Per length n: (code of every n-gram, its row).  Codes hold the bytes, so they tell lengths apart."""
    b = _FOLD[data].astype(np.uint32)
    row = np.repeat(np.arange(len(off) - 1, dtype=np.int64), np.diff(off))
    code = np.zeros(len(b), np.uint32)
    for n in range(WIDTH):
        m = len(b) - n
        if m <= 0:
            return
        code = (code[:m] << np.uint32(8)) | b[n:]
        inside = row[:m] == row[n:]
        yield (code[inside], row[:m][inside]) if n else (code, row)


class Index:
    """Ids of known codes by a hash table; codes that share a slot with another are looked up in a sorted rest."""

    def __init__(self, codes: np.ndarray):
        self.size = len(codes)
        self.shift = np.uint32(32 - max(12, int(np.ceil(np.log2(8 * max(1, self.size))))))
        slot = self._slot(codes)
        used, first = np.unique(slot, return_index=True)
        n = 1 << (32 - int(self.shift))
        self.keys, self.ids, self.crowded = np.zeros(n, np.uint32), np.full(n, -1, np.int32), np.zeros(n, bool)
        self.keys[used], self.ids[used] = codes[first], first
        others = np.ones(self.size, bool)
        others[first] = False
        self.rest_ids = np.flatnonzero(others)
        self.rest = codes[self.rest_ids]  # codes are sorted
        self.crowded[slot[self.rest_ids]] = True

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint32(0x9E3779B1)) >> self.shift

    def find(self, codes: np.ndarray) -> np.ndarray:
        slot = self._slot(codes)
        hit = (self.keys[slot] == codes) & (self.ids[slot] >= 0)
        out = np.where(hit, self.ids[slot], -1)
        again = np.flatnonzero(~hit & self.crowded[slot])
        if len(again):
            at = np.minimum(np.searchsorted(self.rest, codes[again]), len(self.rest) - 1)
            out[again] = np.where(self.rest[at] == codes[again], self.rest_ids[at], -1)
        return out


def presence(col: pa.Array, index: Index):
    """(first row, end row, presence matrix) of batches of at most ``CELLS`` cells, one row at least."""
    most = max(1, CELLS // max(1, index.size))
    for lo, hi, data, off in ts.slices(col):
        for a in range(0, hi - lo, most):
            z = min(a + most, hi - lo)
            x = np.zeros((z - a, index.size + 1), np.float32)  # unknown codes, -1, go to the last column
            part, base = data[off[a] : off[z]], off[a : z + 1] - off[a]
            for code, row in gram_codes(part, base):
                x[row, index.find(code)] = 1
            yield lo + a, lo + z, x[:, :-1]


def known_codes(col: pa.Array) -> np.ndarray:
    """Sorted distinct codes of a bounded set of texts."""
    found = [np.zeros(0, np.uint32)]
    for _, _, data, off in ts.slices(col):
        found += [np.unique(code) for code, _ in gram_codes(data, off)]
    return np.unique(np.concatenate(found))


def kernel(texts: pa.Array, landmarks: pa.Array, index: Index) -> np.ndarray:
    """Normalised kernel of each text with each landmark, by products of presence blocks."""
    out = np.zeros((len(texts), len(landmarks)))
    root = lambda x: np.sqrt(np.maximum(x.sum(1), 1))
    for a, z, x in presence(texts, index):
        for b, y, m in presence(landmarks, index):
            out[a:z, b:y] = (x @ m.T) / np.outer(root(x), root(m))
    return out


@dataclass
class Model:
    langs: list
    codes: np.ndarray
    weights: np.ndarray  # n-grams x languages


def _pieces(docs: DataFrame, text: str, lang: str, train: Column) -> DataFrame:
    """Distinct (lang, piece) with their hash; pieces cover every labelled text."""
    t = F.col(f"`{text}`").cast("string")
    rows = docs.where(train & F.col(f"`{lang}`").isNotNull() & t.rlike(r"\p{L}"))
    starts = F.sequence(F.lit(0), F.floor((F.length(t) - 1) / PIECE).cast("int"))
    rows = rows.select(F.col(f"`{lang}`").cast("string").alias("lang"), t.alias("t"), F.explode(starts).alias("i"))
    rows = rows.select("lang", F.lower(F.substring("t", F.col("i") * PIECE + 1, F.lit(PIECE))).alias("piece"))
    return rows.withColumn("h", F.xxhash64("piece"))


def training_pieces(docs: DataFrame, text: str, lang: str, train: Column, most: int) -> DataFrame:
    """(lang, piece, n): at most ``most`` distinct pieces over all languages, evenly shared, by smallest hash; n counts from 1 per language.

    Two passes: the number of distinct pieces per language sets a bound on the
    hash that twice the share passes, so only that much is deduplicated and
    ranked.  Copies share their hash and are in or out together.
    """
    pieces = _pieces(docs, text, lang, train)
    counts = {r["lang"]: r["n"] for r in pieces.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    share = max(1, most // max(1, len(counts)))
    top = (1 << 63) - 1
    bound = {k: min(top, int((2 * share + 64) / max(n, 1) * 2.0**64) - top - 1) for k, n in counts.items()}
    spark = docs.sparkSession
    limits = spark.createDataFrame([(k, v) for k, v in bound.items()], "lang string, bound long")
    near = pieces.join(F.broadcast(limits), "lang").where("h <= bound").select("lang", "piece", "h").distinct()
    n = F.row_number().over(Window.partitionBy("lang").orderBy("h", "piece"))
    return cut(near.withColumn("n", n).where(F.col("n") <= share).select("lang", "piece", "n"))


@by_value
def fit(docs: DataFrame, train: Column = None, text_col: str = "text", lang_col: str = "lang", most: int = MAX_TRAIN, landmarks: int = LANDMARKS) -> Model:
    """The model of the documents for which ``train`` holds and whose language is not null."""
    train = F.lit(True) if train is None else F.coalesce(train, F.lit(False))
    sample = training_pieces(docs, text_col, lang_col, train, most)
    langs = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    if not langs:
        return Model([], np.zeros(0, np.uint32), np.zeros((0, 0), np.float32))
    each = max(1, landmarks // len(langs))
    marks = [r["piece"] for r in sample.where(F.col("n") <= each).orderBy("lang", "n").select("piece").collect()]
    codes = known_codes(pa.array(marks))
    shared = docs.sparkSession.sparkContext.broadcast((marks, codes))

    def rows(batches):
        marks_, codes_ = shared.value
        index, m = Index(codes_), pa.array(marks_)
        for batch in batches:
            k = kernel(batch.column(1), m, index)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(k), pa.list_(pa.float64()))], names=["lang", "k"])

    sized = sample.select("lang", "piece").repartition(max(1, min(16, most // 256)))
    got = sized.mapInArrow(rows, "lang string, k array<double>").collect()  # at most `most` rows
    got.sort(key=lambda r: (r["lang"], r["k"]))
    k_nm = np.array([r["k"] for r in got])
    who = np.array([langs.index(r["lang"]) for r in got])
    y = np.where(who[:, None] == np.arange(len(langs)), 1.0, -1.0)
    even = 1.0 / np.bincount(who)[who]  # each language weighs alike
    even /= even.sum()
    k_mm = kernel(pa.array(marks), pa.array(marks), Index(codes))
    left = k_nm.T @ (k_nm * even[:, None]) + RIDGE * k_mm
    alpha = np.linalg.lstsq(left + 1e-9 * np.eye(len(marks)), k_nm.T @ (y * even[:, None]), rcond=None)[0]
    weights = np.zeros((len(codes), len(langs)))
    for a, z, x in presence(pa.array(marks), Index(codes)):
        weights += x.T @ (alpha[a:z] / np.sqrt(np.maximum(x.sum(1), 1))[:, None])
    return Model(langs, codes, weights.astype(np.float32))


def _scorer(shared):
    def score(col: pa.Array) -> pa.Array:
        model = shared.value
        index = Index(model.codes)
        best, sure = np.zeros(len(col), np.int64), np.zeros(len(col))
        for a, z, x in presence(col, index):
            size = x.sum(1)
            f = (x @ model.weights) / np.sqrt(np.maximum(size, 1))[:, None]
            best[a:z] = f.argmax(1)
            sure[a:z] = np.where(size > 0, np.clip((f.max(1) + 1) / 2, 0, 1), 0)
        return pa.StructArray.from_arrays([pa.array(model.langs).take(pa.array(best)), pa.array(sure)], names=["lang", "score"])

    return F.arrow_udf(score, returnType=RESULT)


@by_value
def with_language(df: DataFrame, model: Model, text_col: str = "text", out: str = "language") -> DataFrame:
    """``df`` with a struct (lang, score); see the module for what nulls and odd texts get."""
    if out in df.columns:
        raise ValueError(f"column {out} is there already")
    text = F.col(f"`{text_col}`").cast("string")
    none = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
    if not model.langs:
        return df.withColumn(out, none)
    tmp = fresh("judged", df)
    got = df.withColumn(tmp, _scorer(df.sparkSession.sparkContext.broadcast(model))(F.coalesce(F.lower(text), F.lit(""))))
    return got.withColumn(out, F.when(text.rlike(r"\p{L}"), F.col(tmp)).otherwise(none)).drop(tmp)


def op12_string_kernel(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
    model = fit(docs, ~held_out)
    out = with_language(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out.alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))
