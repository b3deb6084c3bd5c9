"""Quality rules: fixed base rules and robust multivariate outliers.

Each text gets counts (words, symbols, repeated lines, repeated 3-word
windows, ...).  Texts that pass the base rules are also compared with texts of
the same language and source: their transformed statistics form a vector, a
minimum-covariance-determinant (MCD) estimate of centre and scatter is fitted
per group over all its vectors, and a vector whose robust squared Mahalanobis
distance lies far beyond the chi-square range is rejected.

The MCD fit is the usual concentration algorithm, as Spark aggregates: a start
(two deterministic ones: medians with MADs, and spatial signs), then C-steps
that keep the nearest share of each group and re-estimate its mean and
covariance from plain sums.  Rows of a hot group are pre-aggregated in every
task; a group is never gathered.  What crosses the network is one row of sums
per group and task.  Groups smaller than ``min_group`` are pooled by language,
and languages smaller than that into one group.

Defined results: null or empty texts have no words and fail the base rules;
null language or source is a group value of its own; repeated rows are judged
each on its own; an empty table gives an empty result; extra columns pass
through.  A table where nothing passes the base rules has no groups to fit and
nothing is kept.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textscan as ts
from .common import by_value, cut, fresh, text_or_empty

STATS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_punct",
    "n_distinct",
)
STATS_TYPE = "struct<" + ",".join(f"{s}:bigint" for s in STATS) + ">"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[ord(c) for c in "!\"'(),-./:;?@[]_`{}~"]] = True


def count_texts(col: pa.Array) -> pa.Array:
    """The counts of STATS for every text of an Arrow array."""
    out = {s: np.zeros(len(col), np.int64) for s in STATS}
    for lo, hi, data, off in ts.slices(col):
        n = hi - lo
        lead = (data & 0xC0) != 0x80
        starts, ends, row = ts.words(data, off)
        out["n_words"][lo:hi] = np.bincount(row, minlength=n)
        out["word_chars"][lo:hi] = ts.per_row(lead & ~ts._WS[data], off)
        out["n_symbols"][lo:hi] = ts.per_row(_SYMBOL[data], off)
        out["n_upper"][lo:hi] = ts.per_row(_UPPER[data], off)
        out["n_punct"][lo:hi] = ts.per_row(_PUNCT[data], off)
        wh = ts.hash_spans(data, starts, ends)
        _, later = ts.repeated(row, wh)
        out["n_distinct"][lo:hi] = np.bincount(row[~later], minlength=n)
        # lines: spans between \n and text ends; only those with a word count
        if len(starts):
            cuts = np.union1d(np.flatnonzero(data == 0x0A) + 1, off[:-1])
            line = np.unique(np.searchsorted(cuts, starts, side="right") - 1)  # lines with a word
            l_end = np.append(cuts[1:], len(data))[line]
            l_start = cuts[line]
            l_end = np.where(data[l_end - 1] == 0x0A, l_end - 1, l_end)
            l_row = np.searchsorted(off, l_start, side="right") - 1
            out["n_lines"][lo:hi] = np.bincount(l_row, minlength=n)
            _, l_later = ts.repeated(l_row, ts.hash_spans(data, l_start, l_end, seed=3))
            out["n_dup_lines"][lo:hi] = np.bincount(l_row[l_later], minlength=n)
        w3, at = ts.windows(wh, row, 3)
        twice, _ = ts.repeated(row[at], w3)
        hit = np.zeros(len(row), bool)
        for k in range(3):
            hit[at[twice] + k] = True
        out["n_repeat_words"][lo:hi] = np.bincount(row[hit], minlength=n)
    return pa.StructArray.from_arrays([pa.array(out[s]) for s in STATS], names=list(STATS))


@by_value
def with_text_stats(df: DataFrame, text_col: str = "text", out: str = "stats") -> DataFrame:
    """``df`` with a struct column of the counts of STATS for each whole text."""
    count = F.arrow_udf(count_texts, returnType=STATS_TYPE)
    return df.withColumn(out, count(text_or_empty(text_col)))


def base_failed(stats: Column) -> Column:
    n = stats["n_words"]
    return (n < 50) | (100 * stats["n_repeat_words"] > 50 * n)


def feature_columns(stats: Column) -> list[Column]:
    """Transformed statistics, each close to bell-shaped over plain texts.

    Shares go through log(share + a): one stray symbol or a header line that
    comes again as a footer hardly moves them, a text made of symbols lies far out.
    """
    n = F.greatest(stats["n_words"], F.lit(1)).cast("double")
    chars = F.greatest(stats["word_chars"], F.lit(1)).cast("double")

    def share(part: Column, whole: Column, a: float = 0.02) -> Column:
        return F.log(part / whole + F.lit(a))

    return [
        F.log(chars / n),
        share(stats["n_symbols"], chars),
        share(stats["n_upper"], chars),
        share(stats["n_punct"], chars),
        share(stats["n_repeat_words"], n, 0.1),
        share(stats["n_dup_lines"], F.greatest(stats["n_lines"], F.lit(1)).cast("double"), 0.1),
    ]


P = 6
#: Least standard deviation per feature.  Keeps a group in which a statistic is
#: (nearly) constant from rejecting texts for a tiny difference in it, and low
#: enough that each statistic alone can pass CUTOFF: in a group without any,
#: beyond 30 % of repeated words or 61 % of repeated lines (two equal lines stay).
SCALE_FLOOR = (0.08, 0.25, 0.25, 0.25, 0.25, 0.35)


def chi2_quantile(q_normal: float, p: int) -> float:
    """Chi-square quantile at the normal deviate ``q_normal`` (Wilson-Hilferty)."""
    return p * (1 - 2 / (9 * p) + q_normal * math.sqrt(2 / (9 * p))) ** 3


#: Distances beyond this are outliers: chi-square with P degrees at 4 deviates.
CUTOFF = chi2_quantile(4.0, P)
SHARE = 0.65  # share of a group that the C-steps keep
SALTS = 32  # parts of a group in joins of rows with group estimates
#: Up to so many groups (about 400 bytes each) their estimates are broadcast.
BROADCAST_GROUPS = 10_000
MEDIAN_CHI2 = chi2_quantile(0.0, P)

_FIT_TYPE = "struct<centre:array<double>,inverse:array<double>,logdet:double>"


def _solve(kind: str):
    """Arrow function from moments (or medians and MADs) to centre, inverse scatter, log determinant."""
    floor = np.array(SCALE_FLOOR)
    p = P

    def fit(n: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
        k = len(n)
        n = np.asarray(n.to_numpy(zero_copy_only=False), float).reshape(k, 1)
        a = np.array(first.to_pylist(), float).reshape(k, p)
        b = np.array(second.to_pylist(), float).reshape(k, -1)
        cov = np.zeros((k, p, p))
        if kind == "mad":
            centre = a
            cov[:, range(p), range(p)] = np.maximum(1.4826 * b, floor) ** 2
        else:
            centre = a / n
            i, j = np.triu_indices(p)
            cov[:, i, j] = cov[:, j, i] = b / n - centre[:, i] * centre[:, j]
            # eigenvalues below the floors (in units of the floors) are raised to them
            scaled = cov / floor[:, None] / floor
            w, v = np.linalg.eigh(scaled)
            scaled = np.einsum("kij,kj,klj->kil", v, np.maximum(w, 1.0), v)
            cov = scaled * floor[:, None] * floor
        inverse = np.linalg.inv(cov).reshape(k, p * p)
        logdet = np.linalg.slogdet(cov)[1]
        return pa.StructArray.from_arrays(
            [
                pa.array(centre.tolist(), pa.list_(pa.float64())),
                pa.array(inverse.tolist(), pa.list_(pa.float64())),
                pa.array(logdet, pa.float64()),
            ],
            names=["centre", "inverse", "logdet"],
        )

    return F.arrow_udf(fit, returnType=_FIT_TYPE)


def squared_distance(x: list[Column], centre: Column, inverse: Column) -> Column:
    d = [x[i] - centre[i] for i in range(P)]
    total = F.lit(0.0)
    for i in range(P):
        for j in range(i, P):
            term = d[i] * d[j] * inverse[i * P + j]
            total = total + (term if i == j else 2 * term)
    return total


def _moments(x: list[Column]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(c) for c in x]).alias("first"),
        F.array(*[F.sum(x[i] * x[j]) for i in range(P) for j in range(i, P)]).alias("second"),
    ]


def _group_key(df: DataFrame, by: tuple[str, str]) -> list[Column]:
    lang, source = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in by)
    return [lang.alias("lang_key"), source.alias("source_key")]


@by_value
def fit_groups(
    df: DataFrame,
    stats: str = "stats",
    by: tuple[str, str] = ("lang", "source"),
    steps: int = 4,
    min_group: int = 200,
) -> DataFrame:
    """MCD fit per group: lang_key, source_key, centre, inverse, scale.

    One row for every (language, source) of the table; small groups share the
    row contents of their pool.  ``scale`` makes the median distance of the
    group that of a chi-square.
    """
    s = F.col(stats)
    rows = df.where(~base_failed(s)).select(*_group_key(df, by), *[c.alias(f"x{i}") for i, c in enumerate(feature_columns(s))])
    x = [F.col(f"x{i}") for i in range(P)]
    sizes = rows.groupBy("lang_key", "source_key").agg(F.count(F.lit(1)).alias("size"))
    langs = sizes.groupBy("lang_key").agg(F.sum("size").alias("lang_size"))
    small, few = F.col("size") < min_group, F.col("lang_size") < min_group
    pools = cut(
        sizes.join(langs, "lang_key").select(
            "lang_key",
            "source_key",
            F.when(small & few, F.lit("\u0001")).otherwise(F.col("lang_key")).alias("g_lang"),
            F.when(small, F.lit("\u0001")).otherwise(F.col("source_key")).alias("g_source"),
        )
    )
    g = ["g_lang", "g_source"]
    # up to a number of groups the estimates are broadcast, and rows never move; beyond it rows carry a salt
    # and estimates hold a line per salt, so a join never meets a whole group in one task
    few = pools.count() <= BROADCAST_GROUPS
    salt = (F.monotonically_increasing_id() % SALTS).cast("int").alias("salt")

    def meet(rows: DataFrame, estimates: DataFrame, keys: list[str]) -> DataFrame:
        if few:
            return rows.join(F.broadcast(estimates), keys)
        return rows.join(estimates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [*keys, "salt"])

    rows = meet(rows.select("*", salt), pools, ["lang_key", "source_key"])
    rows = cut(rows.select(*g, "salt", *x))

    def quantile(c: Column, share: float) -> Column:
        return F.percentile_approx(c, F.lit(share), F.lit(2000))

    med = cut(rows.groupBy(*g).agg(*[quantile(c, 0.5).alias(f"m{i}") for i, c in enumerate(x)]))
    centred = meet(rows, med, g)
    mads = centred.groupBy(*g).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.first(f"m{i}") for i in range(P)]).alias("first"),
        F.array(*[quantile(F.abs(x[i] - F.col(f"m{i}")), 0.5) for i in range(P)]).alias("second"),
    )
    by_mad = cut(mads.select(*g, F.lit(0).alias("start"), _solve("mad")("n", "first", "second").alias("fit")))
    # spatial signs: each centred row, in units of the MADs, scaled to length one
    z = [(x[i] - F.col("fit.centre")[i]) * F.sqrt(F.col("fit.inverse")[i * P + i]) for i in range(P)]
    length = F.greatest(F.sqrt(sum((c * c for c in z), F.lit(0.0))), F.lit(1e-9))
    sign = [c / length / F.sqrt(F.col("fit.inverse")[i * P + i]) * math.sqrt(P) for i, c in enumerate(z)]
    signs = meet(rows, by_mad, g).select(*g, F.col("fit.centre").alias("mid"), *[c.alias(f"x{i}") for i, c in enumerate(sign)])
    by_sign = (
        signs.groupBy(*g)
        .agg(*_moments(x), F.first("mid").alias("mid"))
        .select(*g, F.lit(1).alias("start"), _solve("moments")("n", "first", "second").alias("fit"), "mid")
        .select(*g, "start", F.struct(F.col("mid").alias("centre"), "fit.inverse", "fit.logdet").alias("fit"))
    )
    fits = cut(by_mad.unionByName(by_sign))
    key = [*g, "start"]
    for _ in range(steps):
        near = meet(rows, fits, g).withColumn("d2", squared_distance(x, F.col("fit.centre"), F.col("fit.inverse")))
        limit = cut(near.groupBy(*key).agg(quantile(F.col("d2"), SHARE).alias("most")))
        kept = meet(near, limit, key).where(F.col("d2") <= F.col("most"))
        sums = kept.groupBy(*key).agg(*_moments(x))
        fits = cut(sums.select(*key, _solve("moments")("n", "first", "second").alias("fit")))
    # of the two starts, the one with the smaller determinant
    best = fits.groupBy(*g).agg(F.min_by("fit", F.struct("fit.logdet", "start")).alias("fit"))
    best = cut(best)
    spread = meet(rows, best, g).groupBy(*g).agg(
        quantile(squared_distance(x, F.col("fit.centre"), F.col("fit.inverse")), 0.5).alias("mid_d2")
    )
    out = pools.join(best, g).join(spread, g)
    # floors make distances of quiet groups small; only wide ones are rescaled
    scale = F.greatest(F.col("mid_d2") / F.lit(MEDIAN_CHI2), F.lit(1.0))
    return cut(out.select("lang_key", "source_key", "fit.centre", "fit.inverse", scale.alias("scale")))


def judge(df: DataFrame, fits: DataFrame, stats: str = "stats", by: tuple[str, str] = ("lang", "source"), distance: str = "distance", kept: str = "kept") -> DataFrame:
    """``df`` with its robust squared distance (null where the base rules fail or no group fits) and verdict."""
    s = F.col(stats)
    names = {c: fresh(f"fit_{c}", df) for c in ("lang_key", "source_key", "centre", "inverse", "scale")}
    f = fits.select(*[F.col(c).alias(n) for c, n in names.items()])
    lang, source = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in by)
    same = (lang == F.col(names["lang_key"])) & (source == F.col(names["source_key"]))
    if fits.count() <= BROADCAST_GROUPS:
        f = F.broadcast(f)  # below 4 MB; the rows, with their texts, stay where they are
    else:
        names["salt"] = fresh("fit_salt", df)
        f = f.withColumn(names["salt"], F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        same = same & (F.pmod(F.hash(s), F.lit(SALTS)) == F.col(names["salt"]))
    out = df.join(f, same, "left")
    d2 = squared_distance(feature_columns(s), F.col(names["centre"]), F.col(names["inverse"])) / F.col(names["scale"])
    d2 = F.when(~base_failed(s), d2)
    return out.withColumn(distance, d2).withColumn(kept, F.coalesce(F.col(distance) <= CUTOFF, F.lit(False))).drop(*names.values())


def quality_rules(df: DataFrame, text_col: str = "text", by: tuple[str, str] = ("lang", "source"), min_group: int = 200) -> DataFrame:
    """``df`` without its text, with ``stats``, ``distance``, ``base_failed`` and ``kept`` (stored once, read twice).

    Columns of ``df`` with these names stay; the new one is then called
    ``stats_1`` and so on, with the first number that is free.
    """
    s, d, k, failed = (fresh(c, df) for c in ("stats", "distance", "kept", "base_failed"))
    rows = with_text_stats(df, text_col, s).drop(text_col)
    rows = cut(rows)
    return judge(rows, fit_groups(rows, s, by, min_group=min_group), s, by, d, k).withColumn(failed, base_failed(F.col(s)))


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    out = quality_rules(docs)
    return out.select(
        "doc_id",
        *[f"stats.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "base_failed",
        "kept",
        "distance",
    )


def keep_quality(df: DataFrame) -> DataFrame:
    """Pipeline stage: the rows of ``df`` that the rules keep, with the columns of ``df``.

    Null and empty texts go; equal rows are judged alike; of an empty table
    nothing stays.
    Statistics are computed twice (once to fit, once to filter) so that texts
    need not be stored, and no join by document id is needed.
    """
    s, d, k = fresh("stats", df), fresh("distance", df), fresh("kept", df)
    fit_rows = with_text_stats(df, "text", s).select("lang", "source", s)
    fits = fit_groups(cut(fit_rows), s)
    return judge(with_text_stats(df, "text", s), fits, s, distance=d, kept=k).where(F.col(k)).select(*df.columns)
