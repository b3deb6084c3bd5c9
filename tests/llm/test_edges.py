"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing extra columns, for every operator."""

import public_tokenizers as vocabularies
import pytest
from pyspark.sql import functions as F

from kiln.llm import ann, bpe, minhash, packing, pagetext, quality, secrets, slots, toxicity, urlgraph

LONG = "word%d and the other thing " % 7 * 30_000
DOCS = "doc_id long, text string, lang string, source string, n_chars int, stats string, score string, kept int, candidates int, row_key int, seg int, fit int"
EXTRA = ("s", "sc", 1, 2, 3, 4, 5)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, src, None if t is None else len(t), *EXTRA) for i, t, lang, src in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Two equal rows, a null id, null and empty texts, only white space, one very long text."""
    return frame(
        spark,
        [
            (1, "The cat sat on the mat and the dog sat on the cat", "en", "a"),
            (1, "The cat sat on the mat and the dog sat on the cat", "en", "a"),
            (None, "no id here at all", None, None),
            (3, None, "en", None),
            (4, "", None, "b"),
            (5, " \n\t ", "de", "b"),
            (6, LONG, "en", "a"),
            (7, "é漢字🙂 \x00 token = 'aK9qDEF1Zw3456ghJKL'", "fr", "c"),
        ],
    )


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def test_quality(spark, odd, none):
    clash = quality.quality_rules(odd)  # has columns stats and kept of its own
    assert {"stats", "stats_1", "kept", "kept_1", "distance", "base_failed"} <= set(clash.columns)
    assert clash.where("stats = 's' AND kept = 1").count() == 8
    out = quality.quality_rules(odd.drop("stats", "kept"))
    rows = {(r["doc_id"]): r for r in out.collect()}
    assert out.count() == 8 and all(r["base_failed"] and not r["kept"] for r in rows.values())
    assert rows[3]["stats"]["n_words"] == 0 and rows[5]["stats"]["n_words"] == 0
    assert rows[6]["stats"]["n_words"] == 30_000 * 5
    assert quality.quality_rules(none).count() == 0
    assert quality.keep_quality(odd).columns == odd.columns
    assert quality.keep_quality(none).count() == 0


def test_toxicity(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (6, 0), (None, 1), (9, None)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    out = toxicity.with_scores(odd, model, score="p", segments="hits").collect()
    assert len(out) == 8 and all(0 <= r["p"] <= 1 for r in out)
    assert len({r["p"] for r in out if r["doc_id"] in (3, 4, 5)}) == 1
    nothing = toxicity.fit(none, labels.limit(0))
    assert toxicity.with_scores(odd, nothing, score="p").where("p > 1e-6").count() == 0
    assert toxicity.drop_toxic(odd, labels.limit(0)).columns == odd.columns
    assert toxicity.drop_toxic(none, labels).count() == 0


def test_minhash(spark, odd, none):
    out = minhash.near_copies(odd, width=4).collect()
    got = {}
    for r in out:
        got.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"]))
    assert got[1] == [got[1][0]] * 2 and got[1][0][1] == 1
    assert got[3] == [(0, 3)] and got[4] == [(0, 4)] and got[5] == [(0, 5)]
    assert got[None] == [(2, None)]  # five words make two windows of four
    assert minhash.near_copies(none).count() == 0
    kept = minhash.keep_one_copy(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 7]
    assert minhash.keep_one_copy(none).count() == 0


def test_secrets(spark, odd, none):
    clash = secrets.secret_scan(odd.withColumn("spans", F.lit("mine")))
    assert clash.columns.count("spans") == 1 and {"candidates_1", "spans_1", "row_key"} <= set(clash.columns)
    assert clash.where("spans = 'mine' AND candidates = 2").count() == 8 and clash.where("size(spans_1) = 1").count() == 1
    out = secrets.secret_scan(odd.drop("candidates", "row_key")).collect()
    assert len(out) == 8
    hit = next(r for r in out if r["doc_id"] == 7)
    assert [secrets.KINDS[s["kind"]] for s in hit["spans"]] == ["assign"] and hit["spans"][0]["live"]
    red = {r["doc_id"]: r for r in secrets.redact_live(odd).collect()}
    assert red[7]["text"] == "é漢字🙂 \x00 <assign>'" and red[7]["n_chars"] == len(red[7]["text"])
    assert red[3]["text"] is None and red[6]["text"] == LONG
    assert secrets.redact_live(odd).columns == odd.columns and secrets.redact_live(odd).count() == 8
    assert secrets.secret_scan(none.drop("candidates", "row_key")).count() == 0
    assert secrets.redact_live(none).count() == 0


def test_packing(spark, odd, none):
    path = vocabularies.path("byte_bpe_50k.json")
    out = packing.pack(odd, path).collect()
    assert {r["doc_id"] for r in out} == {None, 1, 3, 4, 5, 6, 7}
    assert sorted(r["length"] for r in out if r["doc_id"] in (3, 4)) == [1, 1]
    long = sorted((r["piece"], r["start"], r["length"]) for r in out if r["doc_id"] == 6)
    assert all(n == 1024 for p, _, n in long if p) and long[0][2] <= 1024
    used = {}
    for r in out:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(none, path).count() == 0
    assert packing.pack_documents(none).count() == 0


def test_bpe(spark, odd, none):
    path, pattern = vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN
    out = bpe.round_trip(odd, path, pattern).collect()
    assert len(out) == 8 and all(r["digest"]["same"] for r in out)
    assert {r["digest"]["n_tokens"] for r in out if r["doc_id"] in (3, 4)} == {0}
    tokens = bpe.with_tokens(odd, path, pattern)
    seven = tokens.where("doc_id = 7").first()
    text = seven["text"]
    assert all(0 <= s < e <= len(text) for s, e in zip(seven["tokens"]["starts"], seven["tokens"]["ends"]))
    back = bpe.with_decoded(tokens.withColumn("ids", F.col("tokens.ids")), path, pattern, out="back")
    assert back.where("coalesce(text, '') != back").count() == 0
    assert bpe.round_trip(none, path, pattern).count() == 0


def test_slots(spark, odd, none):
    out = slots.shard(odd, 4).collect()
    assert len(out) == 8
    by_shard = {}
    for r in out:
        by_shard.setdefault(r["shard"], []).append(r["place"])
    assert all(sorted(p) == list(range(len(p))) for p in by_shard.values())
    assert {r["size"] for r in out if r["doc_id"] in (3, 4)} == {1}
    assert slots.shard(none, 4).count() == 0


def test_urls(spark):
    rows = [
        (1, "http://Good.COM/a?x=/en/", "", 0),
        (2, None, None, 0),
        (3, "no host", "<a href=http://bad.net/es/>", 0),
        (4, "x://bad.net/es/1#q", "", 0),
        (4, "x://bad.net/es/1#q", "", 0),
        (5, "http://linker.org/", "<p><A\nHREF='//BAD.net/es/'>x</a>" + "<a href='/own'>" * 5000, 0),
        (None, "http://island.org", "<a href=", 0),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    got = {r["page_id"]: r for r in urlgraph.judge_urls(pages).collect()}
    assert (got[1]["host"], got[1]["path"], got[1]["rule"], got[1]["verdict"]) == ("good.com", "/a", "com/", "allow")
    assert (got[2]["host"], got[2]["path"], got[2]["rule"], got[2]["verdict"]) == ("", "", None, "allow")
    assert got[3]["host"] == "" and got[4]["rule"] == "net/es/" and got[4]["verdict"] == "block"
    assert got[5]["verdict"] == "block" and got[5]["rule"] is None  # links to a blocked host
    assert got[None]["verdict"] == "allow"
    assert urlgraph.judge_urls(pages.limit(0)).count() == 0


def test_page_text(spark):
    rows = [(1, None, "t"), (2, "", "t"), (3, "<p>" * 50_000 + "x", "t"), (4, "<article><p>Same</p></article>", "t"), (4, "<article><p>Same</p></article>", "t")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = [(r["page_id"], r["out"]) for r in pagetext.with_main_text(pages, out="out").collect()]
    assert sorted(got) == [(1, ""), (2, ""), (3, "x"), (4, "Same"), (4, "Same")]
    assert pagetext.with_main_text(pages.limit(0)).count() == 0


def test_neighbours(spark):
    rows = [
        (1, [1.0, 0.0], "x"),
        (1, [1.0, 0.0], "x"),
        (2, [1.0, 0.0], "x"),
        (3, [2.0, 0.5], "x"),
        (4, None, "x"),
        (5, [0.0, 0.0], "x"),
        (6, [float("nan"), 1.0], "x"),
        (7, [float("inf"), 1.0], "x"),
        (8, [None, 1.0], "x"),
        (9, [], "x"),
        (10, [-1.0, 0.0], "x"),
        (None, [1.0, 1.0], "x"),
        (11, [1.0, 2.0, 3.0], "x"),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = ann.nearest(vectors, lambda i: F.lit(True), 20).collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(by) == {1, 2, 3, 10}
    assert sorted(by[1]) == [(1, 3, 2.0), (2, 2, 1.0), (3, 10, -1.0)]
    assert sorted(by[3]) == [(1, 1, 2.0), (2, 2, 2.0), (3, 10, -2.0)]  # ties to the smaller id
    assert ann.nearest(vectors.limit(0), lambda i: F.lit(True)).count() == 0
