"""Ranked search, language identification and the prefix trie: brute force, DuckDB, held-out accuracy and odd inputs."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from kiln.llm import langid, lexical, prefix_trie, queries

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def duck(name, sf, *tables):
    c = duckdb.connect()
    for t in tables:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return sorted(c.sql(queries.ORACLE[name]).fetchall(), key=repr)


def duck_of(name, **frames):
    c = duckdb.connect()
    for t, df in frames.items():
        c.register(t, df.toPandas())
    return sorted(c.sql(queries.ORACLE[name]).fetchall(), key=repr)


# ------------------------------------------------------------------- search


def test_search_equals_sql(spark):
    assert rows(lexical.op11_shared_search(spark, SF)) == duck("op11_shared_search", SF, "documents", "benchmark")


@pytest.mark.parametrize("block", [30, 120])
def test_search_in_blocks_and_wide_items(spark, block):
    """Items over several blocks, some with more terms than a block, give the same ranks."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300).cache()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").where("item_id < 4").cache()
    whole = rows(lexical.search(docs, items, top=7))
    assert len(whole) == 28
    pairs, n = lexical.blocks_of(lexical.item_terms(items), block)
    assert n > 1 and pairs.groupBy("block").count().agg(F.max("count")).first()[0] <= block
    assert pairs.where("wide").count() > 0 or block > 30
    assert rows(lexical.search(docs, items, top=7, block_pairs=block)) == whole


def test_search_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "a b", "x"), (2, "A. b", "x"), (2, "a b", "x"), (None, "a b c", "x"), (3, None, "x"), (4, "", "x"), (5, " .\n", "x"), (6, "zz Éa É日本 " * 20_000, "x"), (7, "c d e f g", "x")],
        "doc_id long, text string, score string",
    )
    items = spark.createDataFrame([(1, "A!"), (1, "b"), (2, None), (3, ""), (None, "a"), (4, "éa Éa É日本"), (5, "nowhere")], "item_id long, text string")
    got = rows(lexical.search(docs, items).select("item_id", "rank", "doc_id"))
    assert got == [(1, 1, 1), (1, 2, 2), (1, 3, 2), (4, 1, 6)]  # equal scores by id, a null id is not ranked
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0


def test_query_graph_adds_up():
    """Every item of the graph is the disjoint sum of exactly its terms, and shared nodes are used more than once."""
    rng = np.random.default_rng(5)
    common = [f"c{i}" for i in range(30)]
    pairs = [(i, t, False) for i in range(40) for t in {*rng.choice(common, 12, replace=False), f"own{i}"}]
    plan = lexical.plan_block(pairs)
    leaf_terms = [set() for _ in range(plan.n_leaves)]
    for k in range(len(plan.hashes)):
        leaf_terms[plan.leaf[k]].add(plan.text[plan.at[k] : plan.at[k + 1]].tobytes().decode())
    nodes = [sorted(s) for s in leaf_terms]
    for a, b in plan.sums:
        nodes.append(nodes[a] + nodes[b])
    for item, tops in zip(plan.items, plan.tops):
        terms = [t for n in tops for t in nodes[n]]
        assert len(terms) == len(set(terms)) and set(terms) == {t for i, t, _ in pairs if i == item}
    direct = sum(len({int(plan.leaf[k]) for k in range(len(plan.hashes)) if plan.text[plan.at[k] : plan.at[k + 1]].tobytes().decode() in {t for i, t, _ in pairs if i == item}}) for item in plan.items)
    assert plan.sums and len(plan.sums) + sum(map(len, plan.tops)) < direct


# ----------------------------------------------------------------- language


def grams(text: str) -> set:
    b = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in text.lower().encode())
    return {b[i : i + n] for n in range(1, 5) for i in range(len(b) - n + 1)}


def test_kernel_equals_sets(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(30).collect()] + ["", "é", "x1y", "日本語"]
    marks = texts[:8]
    index = langid.Index(langid.known_codes(pa.array([t.lower() for t in marks])))
    known = set().union(*map(grams, marks))
    assert index.size == len(known)
    got = langid.kernel(pa.array([t.lower() for t in texts]), pa.array([t.lower() for t in marks]), index)
    for i, t in enumerate(texts):
        for j, m in enumerate(marks):
            a, b = grams(t) & known, grams(m)
            assert got[i, j] == pytest.approx(len(a & b) / np.sqrt(max(1, len(a)) * max(1, len(b))), abs=1e-5)


def test_crowded_slots_are_found():
    rng = np.random.default_rng(0)
    codes = np.unique(rng.integers(0, 1 << 32, 50_000, dtype=np.uint32))
    index = langid.Index(codes)
    assert len(index.rest) and (index.find(codes) == np.arange(len(codes))).all()
    others = np.setdiff1d(rng.integers(0, 1 << 32, 50_000, dtype=np.uint32), codes)
    assert (index.find(others) == -1).all()


def test_weights_equal_landmark_expansion(spark, monkeypatch):
    """Scores by n-gram weights are the sums over landmarks of solved coefficient times kernel."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang")
    kept = {}
    solve = np.linalg.lstsq
    monkeypatch.setattr(langid.np.linalg, "lstsq", lambda *a, **k: kept.setdefault("x", solve(*a, **k)))
    model = langid.fit(docs, most=80, landmarks=20)
    monkeypatch.undo()
    sample = langid.training_pieces(docs, "text", "lang", F.lit(True), 80)
    marks = [r["piece"] for r in sample.where("n <= 5").orderBy("lang", "n").collect()]
    texts = [r["text"].lower() for r in docs.orderBy("doc_id").limit(40).collect()]
    f = langid.kernel(pa.array(texts), pa.array(marks), langid.Index(model.codes)) @ kept["x"][0]
    got = langid.with_language(docs, model).orderBy("doc_id").limit(40).collect()
    for r, want in zip(got, f):
        assert r["language"]["lang"] == model.langs[int(want.argmax())]
        assert r["language"]["score"] == pytest.approx(min(1, max(0, (want.max() + 1) / 2)), abs=1e-3)


def test_language_held_out(spark):
    out = langid.op12_string_kernel(spark, "/root/testdata/sf0.1").withColumnRenamed("doc_id", "id")
    truth = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "lang")
    got = out.join(truth, F.col("id") == F.col("doc_id")).collect()
    assert len(got) == 10_000
    assert all(r["held_out"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["lang"] == r["lang_pred"] for r in got if r["held_out"]]) > 0.99


def test_language_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "le chat et la souris", "fr"), (1, "le chat et la souris", "fr"), (2, "the cat and the mouse", "en"), (3, None, "en"), (4, "", None), (5, "12 .. \n", "fr"), (None, "the dog and the house", None), (6, "the and " * 200_000, "en"), (7, "日本語", None)],
        "doc_id long, text string, lang string",
    ).withColumn("judged", F.lit("x"))
    model = langid.fit(docs)
    assert model.langs == ["en", "fr"]
    got = [(r["doc_id"], *r["language"], r["judged"]) for r in langid.with_language(docs, model).collect()]
    by = {i: (lang, score) for i, lang, score, _ in got}
    assert len(got) == 9 and all(x[3] == "x" for x in got)
    assert [by[i][0] for i in (1, 2, None, 6)] == ["fr", "en", "en", "en"]
    assert [by[i] for i in (3, 4, 5)] == [("und", 0.0)] * 3
    assert by[7] == ("en", 0.0)  # no n-gram is known
    with pytest.raises(ValueError):
        langid.with_language(docs.withColumn("language", F.lit(1)), model)
    nothing = langid.fit(docs.limit(0))
    assert {tuple(r["language"]) for r in langid.with_language(docs, nothing).collect()} == {("und", 0.0)}
    assert langid.with_language(docs.limit(0), model).count() == 0


def test_training_sample_takes_copies_once_and_all_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(langid, "PIECE", 10)
    docs = spark.createDataFrame([(i, "same text!", "en") for i in range(500)] + [(1000, "abcdefghij" * 3 + "tail", "en"), (1001, "x", "de")], "doc_id long, text string, lang string")
    got = langid.training_pieces(docs, "text", "lang", F.lit(True), 100).collect()
    assert sorted((r["lang"], r["piece"]) for r in got) == [("de", "x"), ("en", "abcdefghij"), ("en", "same text!"), ("en", "tail")]


# --------------------------------------------------------------------- trie


def brute_trie(turns):
    """turns: (conv, turn, role, text) in a list; the contract, read literally."""
    convs = {}
    for c, t, r, x in turns:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    convs = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = convs.get(c - int(np.fmod(c, 20)), [])[:h] + own[h:]
    nodes = {}
    for c, s in built.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    out = []
    for p, who in nodes.items():
        kids = [q for q in nodes if len(q) == len(p) + 1 and q[: len(p)] == p]
        tree = [q for q in nodes if q[: len(p)] == p]
        leaves = [q for q in tree if not any(len(x) == len(q) + 1 and x[: len(q)] == q for x in nodes)]
        saved = sum((len(nodes[q]) - 1) * len(WORD.findall(q[-1][1])) for q in tree if q)
        ends = ",".join(str(c) for c in sorted(who) if len(built[c]) == len(p))
        out.append((min(who), len(p), min(nodes[p[:-1]]) if p else None, len(who), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def trie(spark, turns, **kw):
    df = spark.createDataFrame([(*t, "x") for t in turns], SCHEMA)
    return rows(prefix_trie.prefix_trie(df, **kw).drop("src_conv_id", "src_place"))


def some_turns():
    """Bases that are missing or short, copies, gaps in turn numbers, nulls, a long conversation and its copy, negative ids."""
    rng = np.random.default_rng(2)
    turns = [(c, t, "ua"[t % 2], f"text {rng.integers(2)} of turn") for c in range(80) if c % 20 or c in (20, 40) for t in range(rng.integers(1, 6))]
    turns += [(60, 0, "u", "only one"), (-21, 3, "u", "x"), (-20, None, None, "first of all"), (-20, 1, "u", None), (-19, 1, None, ""), (None, 1, "u", "no conversation")]
    turns += [(c, t, "u", f"long {t}") for c in (107, 108) for t in range(40)] + [(109, 7, "u", "twice")] * 2
    return turns


def test_trie_equals_sql(spark):
    assert rows(prefix_trie.op13_prefix_trie(spark, SF)) == duck("op13_prefix_trie", SF, "conversations")


def test_trie_against_definition(spark, monkeypatch):
    turns = some_turns()
    want = brute_trie(turns)
    assert trie(spark, turns) == want
    monkeypatch.setattr(prefix_trie, "BLOCK", 4)  # sums carried over many blocks
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 3)  # hashes over many pieces
    assert trie(spark, turns, seed=5) == want
    assert trie(spark, []) == []


def test_trie_notices_colliding_fingerprints(spark, monkeypatch):
    """A base under which different prefixes meet is noticed and replaced."""
    real, asked = prefix_trie.bases, []
    monkeypatch.setattr(prefix_trie, "bases", lambda seed: asked.append(seed) or ([1] * 3 if seed == 0 else real(seed)))
    one, two = [c for c in range(1, 100) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 0][:2]
    turns = [(one, 0, "u", "p"), (one, 1, "u", "q"), (two, 0, "u", "q"), (two, 1, "u", "p")]
    want = brute_trie(turns)
    assert trie(spark, turns) == want
    assert {0, 1} <= set(asked)


def test_trie_hot_keys_are_taken_out(spark):
    """join_hot finds the keys above its share, broadcasts their partners only, and joins as a plain left join does."""
    hot = spark.range(20_000).select((F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))).alias("k"), "id")
    one = spark.range(0, 15_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = prefix_trie.join_hot(hot, one, ["k"])
    assert rows(got.select("k", "id", "v")) == rows(hot.join(one, ["k"], "left").select("k", "id", "v"))


def test_places_of_a_long_conversation_come_from_many_tasks(spark):
    df = spark.range(30_000).select(F.lit(5).alias("conv_id"), (30_000 - F.col("id")).alias("turn"), F.lit("u").alias("role"), F.col("id").cast("string").alias("text"))
    got = prefix_trie.stored_turns(df)
    assert got.agg(F.count_distinct("place"), F.min("place"), F.max("place")).first() == (30_000, 0, 29_999)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "part#" in plan  # the windows are per conversation and range
