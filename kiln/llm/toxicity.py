"""Toxicity: maximum-scoring segments over token log-odds.

Training.  The numbers of toxic and clean labelled texts with a token give a log-odds
weight per token with a Dirichlet prior (the prior mean is the token's share over
the whole corpus); weights of tokens with little evidence (likelihood ratio) are set to zero.
Copies of one text count once.  Tokens are
hashed into a fixed number of buckets, so the model is an array of fixed size
however large the vocabulary grows, and that array is what is broadcast.

Scoring.  Each token scores its weight less a small cost, so clean text drifts
down and toxic passages rise.  A linear-time scan finds every maximal scoring
segment of a text (Ruzzo and Tompa).  The best segment of a clean text of n
tokens follows an extreme-value law, P(S < s) = exp(-K n exp(-lambda s));
lambda and K come from the clean labelled texts.  A segment is significant
where its expected number K n exp(-lambda s) is small, and the evidence of a
text, the log of that number for its best segment and the number of its
significant segments, becomes a probability by logistic regression on the
labelled texts.

The fit reads at most ``max_train`` labelled documents (those with the smallest
hash of their id); prior counts cover the whole corpus, and every whole text is
scored.  Defined results: null and empty texts have no segment and get the
calibrated score of no evidence; repeated rows are scored alike; without any
labels the score is 0; an empty table gives an empty result; extra columns pass
through.  Rows with a null id are scored but never train.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textscan as ts
from .common import by_value, cut, fresh, text_or_empty

BUCKETS = 1 << 18
MAX_TRAIN = 40_000  # labelled documents that the fit reads at most (16 bytes each are broadcast)
PRIOR_TOKENS = 5_000.0  # weight of the Dirichlet prior
PRIOR_LEAST = 0.5  # least prior count of a bucket
MIN_Z = 4.0
TOKEN_COST = 0.15
SIGNIFICANT = 0.01  # expected number of such segments in a clean text


def token_buckets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, row, start, end) of every token: runs of ASCII letters and digits and of non-ASCII bytes, ASCII lower-cased."""
    low = ts.LOWER[data]
    starts, ends, row = ts.words(low, off, ts.NOT_ALNUM)
    h = ts.hash_spans(low, starts, ends, seed=11)
    return (h >> np.uint64(64 - 18)).astype(np.int64), row, starts, ends


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns text, label (1, 0 or null) to numbers of texts with each bucket: all, toxic, clean.  One array per task.

    A text counts a token once, so one text that repeats a word a thousand
    times says no more about it than any other.
    """
    total = np.zeros((3, BUCKETS), np.int64)
    for b in batches:
        text, label = b.column(0), b.column(1).fill_null(-1).to_numpy(zero_copy_only=False)
        for lo, hi, data, off in ts.slices(text):
            bucket, row, _, _ = token_buckets(data, off)
            once = np.unique(row * BUCKETS + bucket)
            bucket, y = once % BUCKETS, label[lo:hi][once // BUCKETS]
            total[0] += np.bincount(bucket, minlength=BUCKETS)
            for k, v in ((1, 1), (2, 0)):
                if (mine := bucket[y == v]).size:
                    total[k] += np.bincount(mine, minlength=BUCKETS)
    used = np.flatnonzero(total[0])
    if len(used):
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(total[k][used]) for k in range(3)]], names=["bucket", "n", "toxic", "clean"])


@dataclass
class Model:
    """weights: BUCKETS floats; lam, k: extreme-value law; beta: logistic coefficients."""

    weights: np.ndarray
    lam: float = 1.0
    k: float = 1.0
    beta: tuple[float, ...] = (-50.0, 0.0, 0.0)


def maximal_segments(left: np.ndarray, right: np.ndarray, pos: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments, from the positive tokens of one text.

    left, right: sum of all scores before and through each positive token;
    pos: its place.  Returns (score, first place, last place).
    """
    stack: list[list] = []  # [sum before, sum through, first, last, index of nearest lower left sum]
    for lft, rgt, at in zip(left.tolist(), right.tolist(), pos.tolist()):
        seg = [lft, rgt, at, at, -1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= seg[0]:
                j = stack[j][4]
            seg[4] = j
            if j < 0 or stack[j][1] >= seg[1]:
                stack.append(seg)
                break
            seg = [stack[j][0], seg[1], stack[j][2], seg[3], -1]
            del stack[j:]
    return [(s[1] - s[0], s[2], s[3]) for s in stack]


SPANS_TYPE = "struct<n_tokens:bigint,best:double,scores:array<double>,starts:array<bigint>,ends:array<bigint>>"


def _segment_udf(weights):
    """Arrow function: every maximal segment of each text, with code point spans."""

    def scan(col: pa.Array) -> pa.Array:
        w = weights.value
        n_rows = len(col)
        n_tokens, best = np.zeros(n_rows, np.int64), np.zeros(n_rows)
        scores, starts, ends = ([[] for _ in range(n_rows)] for _ in range(3))
        for lo, hi, data, off in ts.slices(col):
            bucket, row, b_start, b_end = token_buckets(data, off)
            n_tokens[lo:hi] = np.bincount(row, minlength=hi - lo)
            s = w[bucket].astype(np.float64) - TOKEN_COST
            through = np.cumsum(s)  # in double: a single sum over millions of tokens loses the cost of one
            up = np.flatnonzero(s > 0)
            if not len(up):
                continue
            lead = np.cumsum((data & 0xC0) != 0x80)  # code points through each byte
            r = row[up]
            cuts = np.flatnonzero(np.diff(r)) + 1
            for idx in np.split(up, cuts):
                i = int(row[idx[0]])
                base = lead[off[i]] - 1
                segs = maximal_segments(through[idx] - s[idx], through[idx], idx)
                scores[lo + i] = [x for x, _, _ in segs]
                starts[lo + i] = [int(lead[b_start[a]] - 1 - base) for _, a, _ in segs]
                ends[lo + i] = [int(lead[b_end[z] - 1] - base) for _, _, z in segs]
                best[lo + i] = max(scores[lo + i])
        return pa.StructArray.from_arrays(
            [pa.array(n_tokens), pa.array(best), pa.array(scores, pa.list_(pa.float64())), pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64()))],
            names=["n_tokens", "best", "scores", "starts", "ends"],
        )

    return F.arrow_udf(scan, returnType=SPANS_TYPE)


def training_rows(labels: DataFrame, id_col: str, label_col: str, train: Column, max_train: int) -> DataFrame:
    """At most max_train rows (train_id, train_label), one per id (the larger label), by the smallest hash of the id."""
    one = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & train)
    one = one.groupBy(F.col(id_col).alias("train_id")).agg(F.max(F.col(label_col).cast("int")).alias("train_label"))
    return one.orderBy(F.xxhash64("train_id"), "train_id").limit(max_train)


def one_of_each_copy(text: DataFrame, rows: DataFrame) -> DataFrame:
    """Of training rows with equal texts, one: copies are not independent evidence.

    Texts are compared by two 64-bit hashes and length, of at most as many rows as ``rows`` has.
    """
    copy = F.struct(F.xxhash64("text"), F.xxhash64(F.lit(1), "text"), F.length("text")).alias("copy")
    signed = text.join(F.broadcast(rows), "train_id").select("train_id", "train_label", copy)
    one = signed.groupBy("copy").agg(F.min_by(F.struct("train_id", "train_label"), F.struct("train_id", "train_label")).alias("r"))
    return cut(one.select("r.*").groupBy("train_id").agg(F.max("train_label").alias("train_label")))


def _evidence(seg: Column, lam: float, k: float) -> tuple[Column, Column]:
    """(-log of the expected number of clean segments as good as the best, number of significant segments)."""
    log_kn = F.log(F.greatest(seg["n_tokens"], F.lit(1)) * F.lit(k))
    worth = F.when(seg["best"] > 0, F.lit(lam) * seg["best"] - log_kn)
    need = (log_kn - math.log(SIGNIFICANT)) / F.lit(lam)
    many = F.size(F.filter(seg["scores"], lambda s: s >= need))
    return worth, many


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps with halving for logistic regression with a small ridge."""

    def loss(beta: np.ndarray) -> float:
        z = x @ beta
        return float(np.logaddexp(0, z).sum() - y @ z + 0.5 * (beta @ beta))

    beta = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.eye(x.shape[1])
        step, now = np.linalg.solve(h, x.T @ (y - p) - beta), loss(beta)
        while loss(beta + step) > now and np.abs(step).max() > 1e-10:
            step = step / 2
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def _squash(worth: Column, many: Column) -> list[Column]:
    return [F.lit(1.0), F.when(worth > 0, F.log1p(worth)).otherwise(F.lit(0.0)), F.least(many, F.lit(5)).cast("double")]


@by_value
def fit(
    docs: DataFrame,
    labels: DataFrame,
    train: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_train: int = MAX_TRAIN,
) -> Model:
    """Fit on the labelled rows where ``train`` (a condition on columns of ``labels``) holds."""
    spark = docs.sparkSession
    rows = training_rows(labels, id_col, label_col, F.lit(True) if train is None else train, max_train)
    text = docs.select(F.col(f"`{id_col}`").alias("train_id"), text_or_empty(text_col).alias("text"))
    # at most max_train rows of 16 bytes: a proven bound, so they may be broadcast
    rows = one_of_each_copy(text, rows)
    joined = text.join(F.broadcast(rows), "train_id", "left")
    counts = (
        joined.select("text", "train_label")
        .mapInArrow(_count_batches, "bucket long, n long, toxic long, clean long")
        .groupBy("bucket")
        .agg(*[F.sum(c).cast("double").alias(c) for c in ("n", "toxic", "clean")])
    )
    all_n, all_t, all_c = counts.agg(F.sum("n"), F.sum("toxic"), F.sum("clean")).first()
    weights = np.zeros(BUCKETS, np.float32)
    if not all_t or not all_c:
        return Model(weights)
    a = F.greatest(F.col("n") * F.lit(PRIOR_TOKENS / all_n), F.lit(PRIOR_LEAST))
    t, c = F.col("toxic") + a, F.col("clean") + a
    delta = F.log(t / (F.lit(all_t + PRIOR_TOKENS) - t)) - F.log(c / (F.lit(all_c + PRIOR_TOKENS) - c))
    # root of the likelihood ratio against equal shares
    both, share = F.col("toxic") + F.col("clean"), all_t / (all_t + all_c)

    def part(seen: Column, share: float) -> Column:
        return F.when(seen > 0, seen * F.log(seen / (both * F.lit(share)))).otherwise(F.lit(0.0))

    z = F.sqrt(F.greatest(2 * (part(F.col("toxic"), share) + part(F.col("clean"), 1 - share)), F.lit(0.0)))
    strong = counts.select("bucket", "clean", delta.alias("w"), z.alias("z")).where(F.col("z") >= MIN_Z)
    # at most BUCKETS rows
    strong = strong.select("bucket", "clean", "w").toPandas()
    weights[strong["bucket"].to_numpy(np.int64)] = strong["w"].to_numpy()
    # lambda: the positive root of E[exp(lambda score)] = 1 over clean tokens
    score = np.append(strong["w"].to_numpy(float) - TOKEN_COST, -TOKEN_COST)
    mass = np.append(strong["clean"].to_numpy(float), all_c - strong["clean"].sum()) / all_c
    lo, hi = 1e-3, 20.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (mass * np.exp(np.minimum(mid * score, 500))).sum() < 1 else (lo, mid)
    lam = max(lo, 0.05)
    seg = _segment_udf(spark.sparkContext.broadcast(weights))
    held = text.join(F.broadcast(rows), "train_id").select("train_label", seg("text").alias("seg")).select("train_label", "seg.n_tokens", "seg.best", "seg.scores")
    held = held.select("train_label", "n_tokens", "best", F.struct("n_tokens", "best", "scores").alias("seg"))
    # one line per labelled row is kept: bounded by max_train (and copies of their ids)
    rows_n, decay = (
        held.where("train_label = 0")
        .agg(F.count(F.lit(1)), F.sum(F.greatest("n_tokens", F.lit(1)) * F.exp(-F.lit(lam) * F.col("best"))))
        .first()
    )
    k = rows_n / decay if decay else 1.0
    worth, many = _evidence(F.col("seg"), lam, k)
    feats = [c.alias(f"f{i}") for i, c in enumerate(_squash(worth, many))]
    # equal evidence is pooled, so the driver gets at most a few thousand rows
    pool = (
        held.select("train_label", *[F.round(c, 2).alias(f"f{i}") for i, c in enumerate(feats)])
        .groupBy("f0", "f1", "f2", "train_label")
        .agg(F.count(F.lit(1)).alias("times"))
        .toPandas()
    )
    times = pool["times"].to_numpy()
    x = np.repeat(pool[["f0", "f1", "f2"]].to_numpy(float), times, axis=0)
    y = np.repeat(pool["train_label"].to_numpy(float), times)
    return Model(weights, lam, float(k), tuple(_logistic(x, y)))


@by_value
def with_scores(df: DataFrame, model: Model, text_col: str = "text", score: str = "score", segments: str | None = None) -> DataFrame:
    """``df`` with the score of each whole text and, if named, its significant segments (score, start, end; code points)."""
    seg = fresh("seg", df)
    scan = _segment_udf(df.sparkSession.sparkContext.broadcast(model.weights))
    out = df.withColumn(seg, scan(text_or_empty(text_col)))
    worth, many = _evidence(F.col(seg), model.lam, model.k)
    logit = sum((F.lit(float(b)) * f for b, f in zip(model.beta, _squash(worth, many))), F.lit(0.0))
    out = out.withColumn(score, 1 / (1 + F.exp(-logit)))
    if segments:
        need = (F.log(F.greatest(F.col(seg)["n_tokens"], F.lit(1)) * F.lit(model.k)) - math.log(SIGNIFICANT)) / F.lit(model.lam)
        each = F.arrays_zip(F.col(seg)["scores"].alias("score"), F.col(seg)["starts"].alias("start"), F.col(seg)["ends"].alias("end"))
        out = out.withColumn(segments, F.filter(each, lambda s: s["score"] >= need))
    return out.drop(seg)


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"), train=~held_out())
    out = with_scores(docs, model, segments="segments")
    spans = F.array_join(F.transform("segments", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return out.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        spans.alias("segments"),
    )


def drop_toxic(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Pipeline stage: the rows of ``df`` scored below 0.5, with the columns of ``df``.

    Null and empty texts score alike, by the model's base; equal rows stay or go
    together; without labels all rows stay, and an empty table stays empty.
    """
    s = fresh("score", df)
    model = fit(df, labels, train=~held_out())
    return with_scores(df, model, score=s).where(F.col(s) < 0.5).select(*df.columns)
