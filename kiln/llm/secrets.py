"""Secret scans with corpus-wide ownership frequency.

Base rules find assignments, access keys and long hexadecimal runs.  Further
patterns find more candidates (private key blocks, bearer and JWT tokens,
vendor prefixes, passwords in URLs).  Every candidate value is hashed; the
corpus tells for each hash in how many distinct repositories and owners it
occurs.  A value that many owners hold is a widely copied example; a value
with few owners that also looks random is a live credential.  Live values are
then marked wherever they occur as a whole candidate, and the added spans of
the further patterns are kept where they are live.

Here a row's ``source`` is its repository and (``source``, ``lang``) its owner,
unless other columns are named.  Distinct owners are counted per hash with
partial aggregation, so a value that stands in a third of all rows costs one
line per task and owner; hashes, never values, cross the network.

Defined results: null and empty texts have no spans; null repository or owner
is a value of its own; repeated rows count as one owner; an empty table gives
an empty result; extra columns pass through.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, cut, fresh, text_or_empty

BASE = ("assign", "access", "hex")
ADDED = ("pem", "bearer", "jwt", "vendor", "urlpass")
KINDS = BASE + ADDED
EXAMPLE_OWNERS = 5  # values with this many distinct owners or more are copied examples
EXAMPLE_REPOS = 4
LIVE_BITS = 2.5  # least entropy per character of a live-looking value

#: Patterns per kind: (pattern, group that holds the value, least length of it).
_ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_PATTERNS = {
    "assign": (re.compile(_ASSIGN, re.IGNORECASE | re.ASCII), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]{14,}"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]{16,}"), 0, 16),
    "pem": (re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----"), 0, 60),
    "bearer": (re.compile(r"\b[Bb]earer ([A-Za-z0-9._~+/-]{20,}=*)"), 1, 20),
    "jwt": (re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), 0, 29),
    "vendor": (re.compile(r"\b(?:gh[pousr]_[A-Za-z0-9]{30,}|glpat-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})"), 0, 15),
    "urlpass": (re.compile(r"://[^\s:/@]+:([^\s:/@]{6,})@"), 1, 6),
}
#: A literal that every match holds, to skip texts without it.
_NEEDS = {"access": ("AKIA",), "pem": ("PRIVATE KEY",), "bearer": ("earer ",), "jwt": ("eyJ",), "vendor": ("gh", "glpat-", "xox", "sk_live_", "AIza"), "urlpass": ("://",)}

SPAN_TYPE = "array<struct<kind:int,start:bigint,end:bigint,hash:bigint,random:boolean>>"


def looks_random(value: str) -> bool:
    """Letters and digits, entropy per character of at least LIVE_BITS, and not one alphabet run (abcdef, 123456)."""
    n = len(value)
    if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
        return False
    counts: dict[str, int] = {}
    for c in value:
        counts[c] = counts.get(c, 0) + 1
    bits = -sum(k / n * math.log2(k / n) for k in counts.values())
    steps = sum(ord(b) - ord(a) in (0, 1) for a, b in zip(value, value[1:]))
    return bits >= LIVE_BITS and steps < 0.6 * n


def value_hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def find_candidates(text: str) -> list[tuple[int, int, int, int, bool]]:
    """(kind, start, end, value hash, looks random) of every candidate, base kinds exactly by their rules."""
    out = []
    for k, kind in enumerate(KINDS):
        if kind in _NEEDS and not any(x in text for x in _NEEDS[kind]):
            continue
        pattern, group, least = _PATTERNS[kind]
        for m in pattern.finditer(text):
            value = m.group(group)
            if len(value) >= least:
                out.append((k, m.start(), m.end(), value_hash(value), looks_random(value)))
    out.sort(key=lambda x: (x[1], x[0]))
    return out


def _scan(col: pa.Array) -> pa.Array:
    offsets, flat = [0], []
    for text in col:
        flat.extend(find_candidates(text.as_py() or ""))
        offsets.append(len(flat))
    cols = list(zip(*flat)) if flat else [[], [], [], [], []]
    items = pa.StructArray.from_arrays(
        [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.bool_())],
        names=["kind", "start", "end", "hash", "random"],
    )
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)


@by_value
def with_candidates(df: DataFrame, text_col: str = "text", out: str = "candidates") -> DataFrame:
    scan = F.arrow_udf(_scan, returnType=SPAN_TYPE)
    return df.withColumn(out, scan(text_or_empty(text_col)))


def ownership(df: DataFrame, candidates: str = "candidates", repo_cols=("source",), owner_cols=("source", "lang")) -> DataFrame:
    """hash, repos, owners, seen, live: one row per distinct candidate value of the corpus."""
    repo = F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in repo_cols])
    owner = F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in owner_cols])
    each = df.select(repo.alias("repo"), owner.alias("owner"), F.explode(candidates).alias("c"))
    each = each.select("repo", "owner", F.col("c.hash").alias("hash"), F.col("c.random").alias("random"))
    # distinct pairs first: what follows has a row per owner or repository, not per occurrence
    owners = each.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n")).groupBy("hash").agg(F.count(F.lit(1)).alias("owners"))
    repos = each.groupBy("hash", "repo").agg(F.count(F.lit(1)).alias("seen"), F.max("random").alias("random"))
    repos = repos.groupBy("hash").agg(F.count(F.lit(1)).alias("repos"), F.sum("seen").alias("seen"), F.max("random").alias("random"))
    out = repos.join(owners, "hash")
    few = (F.col("owners") < EXAMPLE_OWNERS) & (F.col("repos") < EXAMPLE_REPOS)
    return out.select("hash", "repos", "owners", "seen", (few & F.col("random")).alias("live"))


def _label(kind):
    return F.element_at(F.array(*[F.lit(k) for k in KINDS]), kind + 1)


def _spans_text(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", _label(s["kind"]), s["start"], s["end"])), ",")


def judged(rows: DataFrame, freq: DataFrame, key: str, candidates: str = "candidates", spans: str = "spans") -> DataFrame:
    """key, ``spans``: per row with candidates its base spans and live added ones, each with owners and live flag.

    ``key`` tells rows apart.  Only rows with candidates take part.
    """
    each = rows.where(F.size(candidates) > 0).select(F.col(key), F.explode(candidates).alias("c")).select(key, "c.*")
    each = each.join(freq, "hash").where((F.col("kind") < len(BASE)) | F.col("live"))
    one = F.struct("start", "kind", "end", "repos", "owners", "live")
    return each.groupBy(key).agg(F.sort_array(F.collect_list(one)).alias(spans))


def secret_scan(df: DataFrame, text_col: str = "text", repo_cols=("source",), owner_cols=("source", "lang")) -> DataFrame:
    """``df`` without its text, with ``candidates`` and ``spans`` (kind, start, end, repos, owners, live).

    Candidates are stored once: the corpus counts and the verdicts read them.
    Where ``df`` has columns of these names, they stay, and the new ones are
    called ``candidates_1`` and ``spans_1``, or the next number that is free.
    """
    c, spans = fresh("candidates", df), fresh("spans", df)
    rows = with_candidates(df, text_col, c).drop(text_col)
    key = fresh("row_key", rows)
    rows = cut(rows.withColumn(key, F.monotonically_increasing_id()))  # stored, so the ids stay
    found = judged(rows, cut(ownership(rows, c, repo_cols, owner_cols)), key, c, spans)
    return rows.join(found, key, "left").drop(key)


def op4_secrets(spark, sf_dir: str) -> DataFrame:
    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    out = secret_scan(docs)
    base = F.filter("candidates", lambda c: c["kind"] < len(BASE))

    def of_kind(i: int):
        return F.size(F.filter("candidates", lambda c: c["kind"] == i)).cast("long")

    spans = F.coalesce(F.col("spans"), F.array().cast("array<struct<start:bigint,kind:int,end:bigint,repos:bigint,owners:bigint,live:boolean>>"))
    return out.select(
        "doc_id",
        *[of_kind(i).alias(f"n_{k}") for i, k in enumerate(BASE)],
        F.sha2(_spans_text(base), 256).alias("base_sha256"),
        _spans_text(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: s["live"])).cast("long").alias("n_live"),
        F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["repos"], s["owners"])), ",").alias("ownership"),
    )


def _mask_udf():
    """Arrow function (text, hashes of live values) -> text with the live values' spans replaced."""

    def mask(text: pa.Array, live: pa.Array) -> pa.Array:
        out = []
        for t, h in zip(text.to_pylist(), live.to_pylist()):
            if t is not None and h:
                h, at, parts = set(h), 0, []
                for k, start, end, value, _ in find_candidates(t):
                    if value in h and end > at:
                        start = max(start, at)
                        parts += [t[at:start], f"<{KINDS[k]}>"]
                        at = end
                t = "".join(parts) + t[at:]
            out.append(t)
        return pa.array(out, pa.string())

    return F.arrow_udf(mask, returnType="string")


@by_value
def redact_live(df: DataFrame) -> DataFrame:
    """Pipeline stage: ``df`` with live credentials replaced by their kind in angle brackets; n_chars follows.

    No row is dropped; a null text stays null, equal rows are redacted alike,
    and an empty table stays empty.  Rows with candidates are stored once, for the corpus
    counts and for the redaction; all others pass through without a shuffle.
    """
    c, key, live = fresh("candidates", df), fresh("row_key", df), fresh("live", df)
    scanned = with_candidates(df, out=c)
    some = cut(scanned.where(F.size(c) > 0).withColumn(key, F.monotonically_increasing_id()))
    freq = ownership(some, c).where("live").select("hash")
    hashes = some.select(key, F.explode(F.array_distinct(f"{c}.hash")).alias("hash"))
    per_row = hashes.join(freq, "hash").groupBy(key).agg(F.collect_set("hash").alias(live))
    out = some.join(per_row, key, "left").withColumn(live, F.coalesce(F.col(live), F.array().cast("array<bigint>")))
    found = F.size(live) > 0
    out = out.withColumn("text", F.when(found, _mask_udf()(F.col("text"), F.col(live))).otherwise(F.col("text")))
    if "n_chars" in df.columns:
        kind = df.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(found, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return scanned.where(F.size(c) == 0).select(*df.columns).unionByName(out.select(*df.columns))
