"""Each operator against a brute-force version, an exact round trip or held-out accuracy, on small whole tables."""

import base64
import hashlib
import html
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as vocabularies
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from kiln.llm import ann, bpe, minhash, packing, pagetext, quality, queries, secrets, slots, toxicity, urlgraph

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] for r in rows}


@pytest.fixture(scope="module")
def labels(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def test_quality_counts_and_labels(spark, texts, labels):
    got = queries.QUERIES["op6_quality_rules"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        t = texts[r["doc_id"]]
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        hit = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
        expect = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == expect
        assert r["base_failed"] == (len(w) < 50 or 100 * len(hit) > 50 * len(w))
        assert not (r["base_failed"] and r["kept"])
    judged = [(labels[r["doc_id"]]["quality"], r["kept"]) for r in got if r["doc_id"] in labels and not r["base_failed"]]
    assert np.mean([k for q, k in judged if q == 1]) > 0.98
    assert np.mean([k for q, k in judged if q == 0]) < 0.1


def test_mcd_ignores_planted_outliers(spark):
    """A third of a group is planted far out: centre and verdicts are those of the rest."""
    rng = np.random.default_rng(3)

    def text(odd: bool) -> str:
        w = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(120)]
        return " ".join((x + "%%%" if odd else x) for x in w)

    rows = [(i, text(i % 3 == 0), "en", "hot") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")
    out = quality.quality_rules(df).collect()
    assert all(r["kept"] == (r["doc_id"] % 3 != 0) for r in out)


def test_each_statistic_rejects_alone(spark):
    """In a clean group of plain texts, one planted outlier per statistic; repeated lines and words as far as the base rules let them."""
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefghijklm"), rng.integers(3, 9)))
    words = lambda n: [word() for _ in range(n)]
    plain = lambda: "\n".join(" ".join(words(50)) for _ in range(20))
    passage = words(200)
    planted = [
        " ".join(w * 5 for w in words(400)),
        " ".join(w + "%%%" for w in words(400)),
        " ".join(w.upper() for w in words(400)),
        " ".join(w + "..." for w in words(400)),
        " ".join(passage + words(500) + passage),  # 44 % of the words, one line
        plain() + "\nread more" * 100,  # 82 % of the lines
    ]
    rows = [(i, plain()) for i in range(300)] + [(1000 + i, t) for i, t in enumerate(planted)] + [(2000, "same line of text here\n" * 2 + " ".join(words(400)))]
    df = spark.createDataFrame([(i, t, "en", "hot") for i, t in rows], "doc_id int, text string, lang string, source string")
    out = quality.quality_rules(df).collect()
    assert not any(r["base_failed"] for r in out)
    assert {r["doc_id"] for r in out if not r["kept"]} == {1000 + i for i in range(len(planted))}
    # no group, however quiet, puts a share's reach below the cutoff
    for floor, most in ((quality.SCALE_FLOOR[4], 0.5), (quality.SCALE_FLOOR[5], 1.0)):
        assert (np.log((most + 0.1) / 0.1) / floor) ** 2 > quality.CUTOFF


def test_toxicity_held_out(spark, labels):
    got = queries.QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.1")
    truth = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    rows = got.where("held_out").join(truth, "doc_id").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.97
    assert np.mean([r["predicted"] for r in rows if r["toxic"]]) > 0.85
    assert np.mean([r["predicted"] for r in rows if not r["toxic"]]) < 0.02


def test_segments_are_maximal(spark):
    """The linear scan against the definition: recursively the best contiguous part, then left and right of it."""

    def brute(s, lo, hi):
        best = max(((sum(s[a:b]), a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0, 0, 0), key=lambda x: (x[0], x[1] - x[2]))
        if best[0] <= 0:
            return []
        return brute(s, lo, best[1]) + [(best[1], best[2] - 1)] + brute(s, best[2], hi)

    rng = np.random.default_rng(1)
    for _ in range(200):
        s = rng.integers(-6, 7, rng.integers(1, 14)) + rng.random() * 0.01
        through = np.cumsum(s)
        up = np.flatnonzero(s > 0)
        got = toxicity.maximal_segments(through[up] - s[up], through[up], up)
        assert [(a, b) for _, a, b in got] == brute(s.tolist(), 0, len(s))


def test_segments_of_a_long_text_do_not_drift(monkeypatch):
    """After millions of tokens the cost of a token still counts: two weights apart by clean text stay apart."""
    n = 4_000_000
    bucket = np.zeros(n, np.int64)
    bucket[[n - 30, n - 10]] = 1
    place = np.arange(n, dtype=np.int64)
    monkeypatch.setattr(toxicity, "token_buckets", lambda data, off: (bucket, place * 0, place, place + 1))
    monkeypatch.setattr(toxicity.F, "arrow_udf", lambda f, returnType: f)
    weights = type("W", (), {"value": np.array([-2.0, 3.0], np.float32)})
    got = toxicity._segment_udf(weights)(toxicity.pa.array(["a" * n])).to_pylist()[0]
    assert len(got["scores"]) == 2
    assert np.allclose(got["scores"], 3.0 - toxicity.TOKEN_COST, atol=1e-6)


def _shingles(text, width):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)])


def _components(sets):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for i, s in sets.items():
        for g in s:
            where.setdefault(g, []).append(i)
    for i, s in sets.items():
        common = Counter(j for g in s for j in where[g] if j > i)
        for j, k in common.items():
            if 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def test_minhash_against_all_pairs(spark, texts):
    got = {r["doc_id"]: r for r in queries.QUERIES["op7_minhash"](spark, SF).collect()}
    sets = {i: _shingles(t, 4) for i, t in texts.items()}
    expect = _components(sets)
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r["component_id"] for i, r in got.items()} == expect
    assert all(r["kept"] == (i == expect[i]) for i, r in got.items())


def test_minhash_chain_and_shared_passage(spark):
    """Links that only a chain joins, in a bucket of many texts that share a long passage but are no copies."""
    rng = np.random.default_rng(5)
    fresh = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    base = fresh(400)
    rows, chain = [], list(base)
    for i in range(12):  # each differs from the last in 20 words; ends are not similar
        rows.append((i, " ".join(chain)))
        at = i * 30
        chain[at : at + 20] = fresh(20)
    passage = fresh(200)
    rows += [(100 + i, " ".join(passage + fresh(60))) for i in range(60)]  # similarity about 0.6
    rows += [(300, rows[70][1] + " tail")]
    sets = {i: _shingles(t, 5) for i, t in rows}
    got = minhash.near_copies(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == _components(sets)


def test_secret_base_spans(spark, texts):
    got = queries.QUERIES["op4_secrets"](spark, SF).collect()
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for r in got:
        t = texts[r["doc_id"]]
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 12]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        shown = [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans)]
        assert r["base_sha256"] == hashlib.sha256(",".join(shown).encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == i for _, k, _ in spans) for i in range(3))
        assert set(shown) <= set(r["spans"].split(",")) | {""}


def test_ownership_separates_examples(spark):
    live, example = "token: 9fK2mQ7xLp3Zt8Wc", "token: aB3dE5gH7jK9mN1p"
    rows = [(0, f"x {live} y", "s0", "en"), (1, f"{live}", "s0", "en")] + [(2 + i, f"see {example}", f"s{i}", "en") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string, lang string")
    spans = {r["doc_id"]: r["spans"][0] for r in secrets.secret_scan(df).collect()}
    assert spans[0]["live"] and spans[0]["owners"] == 1
    assert not spans[5]["live"] and spans[5]["owners"] == 8 and spans[5]["repos"] == 8
    red = {r["doc_id"]: r["text"] for r in secrets.redact_live(df).collect()}
    assert red[0] == "x <assign> y" and red[5] == f"see {example}"


def _tiktoken():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(vocabularies.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_against_tiktoken(spark, texts):
    tk = _tiktoken()
    for r in queries.QUERIES["op3_byte_bpe"](spark, SF).collect():
        ids = tk.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_bpe_odd_characters():
    import pyarrow as pa

    rng = np.random.default_rng(0)
    alphabet = list(" \n\t\r\x0b\x1c\x85\u00a0\u2003\u3000ab'sréÀÿ×÷1½9.,!?\"Zß漢字🙂\u0301ก") + ["'ll", "'re", " the", "<|endoftext|>", "\n\n "]
    tests = ["".join(rng.choice(alphabet, rng.integers(0, 25))) for _ in range(5000)] + ["", " ", "a" * 5000, " " * 700 + "x"]
    tk = _tiktoken()
    for path in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json"):
        enc = bpe.Encoder(bpe.load_tokenizer(vocabularies.path(path), vocabularies.PATTERN))
        got = []
        for lo, hi, ids, off, _, _ in enc.slices(pa.array(tests)):
            got += [ids[off[i] : off[i + 1]].tolist() for i in range(hi - lo)]
        # a rank file knows no special tokens; a tokenizer's file does
        library = enc.tokenizer.from_file(vocabularies.path(path)) if path.endswith("json") else None
        assert got == [library.encode(x, add_special_tokens=False).ids if library else tk.encode_ordinary(x) for x in tests]


def test_packing_is_tight(spark, texts):
    got = queries.QUERIES["op2_best_fit_packing"](spark, SF).collect()
    tk = _tiktoken()
    pieces, used = {}, {}
    for r in got:
        pieces.setdefault(r["doc_id"], []).append(r)
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, t in texts.items():
        ids = np.array([*tk.encode_ordinary(t), 2], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["piece"]):
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids) and len(pieces[i]) == -(-len(ids) // 1024)
    for spans in used.values():
        ends = [a + n for a, n in sorted(spans)]
        assert [a for a, _ in sorted(spans)] == [0, *ends[:-1]] and ends[-1] <= 1024
    least = -(-sum(r["length"] for r in got) // 1024)
    assert len(used) <= least + max(2, least // 100)


def test_page_text_against_articles(spark):
    got = {r["page_id"]: r for r in queries.QUERIES["op8_html_blocks"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(</article>|<footer|$)", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1|div|article)>", article)]
        assert got[r["page_id"]]["text"] == "\n\n".join(p for p in parts if p)
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])


def test_page_text_without_furniture():
    page = """<html><head><title>T</title></head><body><header><a href=/>Home</a></header><div class="cookie-notice">We use cookies for you and for us.</div>
    <main><h1>Head</h1><p>This is the first part of the story and it has all that one would want of it &amp; more.</p>
    <p>Short.</p><aside>Aside</aside><ul class="share"><li>Share</li></ul><form><label>Mail</label></form></main>
    <section id="comments"><p>I was here and this is the comment of a reader who was not in the story at all.</p></section>
    <div class="sidebar"><p>More</p></div><footer>(c)</footer></body></html>"""
    assert pagetext.main_text(page).split("\n\n") == ["Head", "This is the first part of the story and it has all that one would want of it & more.", "Short."]


STORY = "This is the first part of the story and it has all that one would want of it and more."


@pytest.mark.parametrize(
    "page",
    [
        f'<body><div class="layout has-sidebar"><article><p>{STORY}</p></article><div class="sidebar"><p>More</p></div></div></body>',
        f'<article class="post category-social"><p>{STORY}</p></article>',
        f"<form><main><p>{STORY}</p></main></form>",
        f"<html><head><title>T</title><body><article><p>{STORY}</p></article></body></html>",
        f"<head><title>T</title><article><p>{STORY}</p></article>",
        f'<svg><title>Icon</title></svg><noscript>On</noscript><article><p>{STORY.replace("story", "<math><mi>story</mi></math>")}</p></article>',
        f"<article><noscript><p>{STORY}</p></noscript></article>",
    ],
)
def test_page_text_of_articles_in_odd_places(page):
    assert pagetext.main_text(page) == STORY


def test_rank_against_power_iteration(spark):
    edges = [("a", "b", 2.0), ("b", "c", 1.0), ("a", "c", 1.0), ("c", "a", 1.0), ("d", "c", 3.0)]
    seeds = [("a", 1.0, 0.0), ("b", 0.0, 0.0), ("c", 0.0, 1.0), ("d", 0.0, 0.0)]
    graph = spark.createDataFrame(edges, "src string, dst string, weight double"), spark.createDataFrame(seeds, "host string, allowed double, blocked double")
    got = urlgraph.propagate(*graph, tolerance=1e-6)
    names = "abcd"
    m = np.zeros((4, 4))
    for s, d, w in edges:
        m[names.index(s), names.index(d)] = w
    out, into = m / np.maximum(m.sum(1, keepdims=True), 1e-9), (m / np.maximum(m.sum(0), 1e-9)).T
    t0, d0 = np.array([1.0, 0, 0, 0]), np.array([0, 0, 1.0, 0])
    t, d, u0 = t0, d0, np.full(4, 0.25)
    u = u0
    for _ in range(300):
        t, d, u = 0.15 * t0 + 0.85 * t @ out, 0.15 * d0 + 0.85 * d @ into, 0.15 * u0 + 0.85 * u @ out
    for r in got.collect():
        i = names.index(r["host"])
        for x, name in ((t, "trust"), (d, "distrust"), (u, "reference")):
            assert abs(r[name] - x[i] / x.sum()) < 1e-6


def test_ranks_of_the_given_pages(spark):
    """Rules by Python, ranks by power iteration over the tree of names (the pages link to no other host)."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()
    judged, ruled = {}, {}
    for r in pages:
        host, path = re.match(r".*?://([^/?#]*)([^?#]*)", r["url"]).groups()
        host = host.lower()
        fits = [(len(h) + len(p), h + p, v) for h, p, v in urlgraph.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        judged[r["page_id"]] = (host, path, *(max(fits)[1:] if fits else (None, None)))
        ruled.setdefault(host, []).append(judged[r["page_id"]][3])
    names = {""} | {".".join(h.split(".")[i:]) for h in ruled for i in range(len(h.split(".")))}
    names = sorted(names)
    m = np.zeros((len(names), len(names)))
    for h in filter(None, names):
        up = h.partition(".")[2]
        m[names.index(h), names.index(up)] = m[names.index(up), names.index(h)] = 1
    step = m / m.sum(1, keepdims=True)
    start = np.array([[v.count("allow") / len(v), v.count("block") / len(v), 1.0] if (v := ruled.get(h)) else [0.0, 0.0, 0.0] for h in names])
    start /= start.sum(0)
    x = start
    for _ in range(300):
        x = 0.15 * start + 0.85 * step.T @ x
    rank = dict(zip(names, x / x.sum(0)))
    got = queries.QUERIES["op9_url_graph"](spark, SF).collect()
    assert len(got) == len(pages)
    near, other = 0, 0
    for r in got:
        host, path, rule, verdict = judged[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        t, d, u = rank[host]
        assert max(abs(r["trust"] - t), abs(r["distrust"] - d), abs(r["reference"] - u)) < 1e-3
        if verdict:
            assert r["verdict"] == verdict
        elif abs(d - u) > 1e-3:
            assert r["verdict"] == ("block" if d > t and d > u else "allow")
            other += r["verdict"] == "block"
        else:
            near += 1
    assert near < 0.5 * len(got) and min(rank[h][1] for h in ruled) > 0


def test_slots_balance_and_rebalance(spark, scratch):
    got = queries.QUERIES["op10_virtual_slots"](spark, SF).toPandas()
    loads = got.groupby("shard")["size"].sum()
    assert len(loads) == 16 and loads.max() < 1.02 * loads.mean()
    assert all(sorted(g) == list(range(len(g))) for _, g in got.groupby("shard").slot)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = slots.shard(docs, 8, store=scratch).toPandas().set_index("doc_id").shard
    b = slots.shard(docs, 9, store=scratch).toPandas().set_index("doc_id").shard
    moved = a[a != b.reindex(a.index)]
    assert len(moved) < 0.2 * len(a) and (b.reindex(moved.index) == 8).mean() > 0.9
    assert slots.load_map(spark, scratch).first()["version"] == 2


def test_shards_do_not_depend_on_how_rows_are_stored(spark):
    rows = [(7, "same")] * 600 + [(i, f"text {i}" * (i % 9)) for i in range(100, 500)] + [(None, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [sorted(map(repr, slots.shard(df.repartition(n), 4).select("doc_id", "size", "shard").collect())) for n in (3, 7)]
    assert got[0] == got[1] and len(got[0]) == len(rows)


def test_map_and_edit_against_plain_loops(spark):
    rng = np.random.default_rng(6)
    cells = [(i, 0, False, int(b)) for i, b in enumerate(rng.integers(1, 1000, 700))]
    sums = spark.createDataFrame(cells, "slot int, part int, split boolean, bytes long")
    want, loads = {}, [0] * 5
    for slot, _, _, b in sorted(cells, key=lambda c: (-c[3], c[0])):
        want[slot] = loads.index(min(loads))
        loads[want[slot]] += b
    mapping = slots.slot_map(sums, 5)
    first = {r["slot"]: r["shard"] for r in mapping.collect()}
    assert first == want
    edit = {r["slot"]: (r["shard"], r["version"]) for r in slots.rebalance(mapping, sums, 6).collect()}
    size = {c[0]: c[3] for c in cells}
    after = [sum(size[s] for s, (k, _) in edit.items() if k == j) for j in range(6)]
    moved = sum(size[s] for s in first if edit[s][0] != first[s])
    share = sum(size.values()) / 6
    assert max(after) < 1.01 * share and {v for _, v in edit.values()} == {2}
    assert moved < 1.1 * share  # what the new shard takes, and little else


def test_one_hot_record_is_split(spark):
    """A third of the rows are one record: its slot is split, loads stay even."""
    rows = [(7, "same text")] * 1000 + [(100 + i, "some text") for i in range(2000)]
    got = slots.shard(spark.createDataFrame(rows, "doc_id int, text string"), 16).toPandas()
    loads = got.groupby("shard")["size"].sum()
    assert len(got) == 3000 and loads.max() < 1.05 * loads.mean()
    assert all(sorted(g) == list(range(len(g))) for _, g in got.groupby("shard").place)


def test_neighbours_recall(spark):
    got = queries.QUERIES["op1_nn_descent"](spark, SF).toPandas()
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    ids, x = rows.vec_id.to_numpy(), np.array([np.asarray(v, float) for v in rows.embedding])
    hits = total = 0
    for q in ids[ids % 20 == 0]:
        s = x @ x[np.flatnonzero(ids == q)[0]]
        s[ids == q] = -np.inf
        top = ids[np.lexsort((ids, -s))[:20]]
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21)) and (np.diff(mine.score) <= 0).all()
        assert np.allclose(mine.score, [x[np.flatnonzero(ids == v)[0]] @ x[np.flatnonzero(ids == q)[0]] for v in mine.vec_id], atol=1e-12)
        hits, total = hits + len(set(top) & set(mine.vec_id)), total + 20
    assert hits / total >= 0.9


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_neighbours_of_mixed_lengths(spark, spread):
    """One vector 100 times as long as the others, which are of one length or of many."""
    rng = np.random.default_rng(9)
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("embedding").collect()
    x = np.unique(np.array([r["embedding"] for r in rows], float), axis=0)
    x *= rng.lognormal(0, spread, len(x))[:, None]
    x[7] *= 100 * np.linalg.norm(x, axis=1).max() / np.linalg.norm(x[7])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id int, embedding array<double>")
    got = ann.nearest(table, lambda i: i % 20 == 0).toPandas()
    hits = []
    for q in range(0, len(x), 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits.append(len(set(np.argsort(-s)[:20]) & set(got[got.query_id == q].vec_id)) / 20)
    assert np.mean(hits) >= 0.9


def test_beam_grows_until_the_checked_queries_are_answered(spark, monkeypatch):
    """The check of a search result counts against all vectors; while it says no, the beam is widened."""
    monkeypatch.setattr(ann, "BEAM", 24)
    x = np.random.default_rng(4).standard_normal((600, 24))
    x[500] = x[3]  # equal scores count as found
    classes = ann.cut(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node long, v array<double>"))
    nodes = ann.cut(classes.select("node", ann._coder(10.0)("v").alias("code"), F.sqrt(ann._dot("v", "v")).alias("length")))
    q = ann.cut(nodes.where("node % 20 = 0").select(F.col("node").alias("query"), "code", F.col("node").alias("own")))
    enough = ann._checker(q, classes, 20)
    rows = []
    for i in range(0, 600, 20):
        s = x @ x[i]
        s[i] = -np.inf
        rows += [(i, int(j), r) for r, j in enumerate(np.argsort(-s)[:20])]
    truth = ann.cut(spark.createDataFrame(rows, "query long, node long, r int"))
    assert enough(truth.select("query", "node")) and enough(truth.where("r < 19").select("query", "node"))
    assert not enough(truth.where("r < 18").select("query", "node")) and not enough(truth.limit(0).select("query", "node"))
    widths = []

    def twice(found):
        widths.append(found.groupBy("query").count().agg(F.max("count")).first()[0])
        return len(widths) == 3

    found = ann.greedy_search(q, nodes, ann.build_graph(nodes), twice)
    assert widths == [24, 48, 96] and enough(found)


def test_only_checked_queries_are_searched_again(spark, monkeypatch):
    """Each width is tried on the checked queries; the others are searched once, with the last width."""
    monkeypatch.setattr(ann, "BEAM", 24)
    monkeypatch.setattr(ann, "CHECKED", 5)
    x = np.random.default_rng(4).standard_normal((600, 24))
    classes = ann.cut(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node long, v array<double>"))
    nodes = ann.cut(classes.select("node", ann._coder(10.0)("v").alias("code"), F.sqrt(ann._dot("v", "v")).alias("length")))
    q = ann.cut(nodes.where("node % 20 = 0").select(F.col("node").alias("query"), "code", F.col("node").alias("own")))
    tried = []

    def twice(found):
        counts = {r["query"]: r["count"] for r in found.groupBy("query").count().collect()}
        tried.append((len(counts), max(counts.values())))
        return len(tried) == 2

    found = ann.greedy_search(q, nodes, ann.build_graph(nodes), twice).groupBy("query").agg(F.count("node").alias("n"), F.countDistinct("node").alias("d")).collect()
    assert tried == [(5, 24), (5, 48)]
    assert len(found) == 30 and all(r["n"] == r["d"] == 48 for r in found)


def test_search_goes_on_while_open_nodes_are_left(spark, monkeypatch):
    """A path of neighbours: the best nodes are more rounds away from the landmarks than any fixed few."""
    monkeypatch.setattr(ann, "LANDMARKS", 1)
    n = 60
    t = np.linspace(0, np.pi, n)
    rows = [(i, [float(np.cos(a)), float(np.sin(a))], 1.0) for i, a in enumerate(t)]
    nodes = ann.cut(spark.createDataFrame(rows, "node long, v array<double>, length double").select("node", ann._coder(1.0)("v").alias("code"), "length"))
    path = [(i, j, 0.0) for i in range(n) for j in (i - 2, i - 1, i + 1, i + 2) if 0 <= j < n]
    graph = spark.createDataFrame(path, "node long, nbr long, sim float")
    asked = nodes.select(F.col("node").alias("query"), "code", F.lit(None).cast("long").alias("own")).where(f"query in (0, {n // 2}, {n - 1})")
    found = {}
    for r in ann.greedy_search(asked, nodes, graph).collect():
        found.setdefault(r["query"], set()).add(r["node"])
    assert all(found[q] >= set(sorted(range(n), key=lambda i: abs(i - q))[:20]) for q in (0, n // 2, n - 1))


def test_size_that_the_planner_sees_stays_small(spark, monkeypatch):
    """A search of many rounds: the planner's size of the result is no product over the rounds, which filled the driver."""
    monkeypatch.setattr(ann, "LANDMARKS", 1)
    n = 60
    t = np.linspace(0, np.pi, n)
    rows = [(i, [float(np.cos(a)), float(np.sin(a))], 1.0) for i, a in enumerate(t)]
    nodes = ann.cut(spark.createDataFrame(rows, "node long, v array<double>, length double").select("node", ann._coder(1.0)("v").alias("code"), "length"))
    graph = spark.createDataFrame([(i, j, 0.0) for i in range(n) for j in (i - 2, i - 1, i + 1, i + 2) if 0 <= j < n], "node long, nbr long, sim float")
    asked = nodes.select(F.col("node").alias("query"), "code", F.lit(None).cast("long").alias("own")).where("query in (0, 30, 59)")
    found = ann.greedy_search(asked, nodes, graph)
    assert found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 1000


def test_nodes_left_out_are_none_of_the_best(spark):
    """What the codes rule out is not among the best by the vectors themselves, for vectors of many lengths."""
    x = np.random.default_rng(8).standard_normal((500, 16)) * np.random.default_rng(9).lognormal(0, 1, 500)[:, None]
    longest = np.linalg.norm(x, axis=1).max()
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node long, v array<double>")
    nodes = ann.cut(nodes.select("node", ann._coder(float(longest))("v").alias("code"), F.sqrt(ann._dot("v", "v")).alias("length")))
    asked = ann.cut(nodes.where("node % 10 = 0").select(F.col("node").alias("query"), "code", F.col("node").alias("own")))
    graph = ann.cut(ann.build_graph(nodes))
    whole, some = ({}, {})
    for out, best in ((whole, None), (some, 21)):
        for r in ann.greedy_search(asked, nodes, graph, best=best).collect():
            out.setdefault(r["query"], set()).add(r["node"])
    assert sum(map(len, some.values())) < sum(map(len, whole.values()))
    for q, found in whole.items():
        others = sorted(found - {q}, key=lambda i: -(x[i] @ x[q]))
        assert some[q] <= found and some[q] >= {q, *others[:21]}


def test_pipeline_stages(spark, texts, labels, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(f"{scratch}/{name}")
        docs = spark.read.parquet(f"{scratch}/{name}")
        ids[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if name != "packing":
            assert docs.columns == columns
    base = {i for i, t in texts.items() if len(WORD.findall(t)) >= 50}
    assert ids["quality"] <= base and ids["toxicity"] <= ids["quality"]
    expect = _components({i: _shingles(texts[i], 5) for i in ids["toxicity"]})
    assert ids["near_copies"] == {i for i, c in expect.items() if i == c}
    assert ids["secrets"] == ids["near_copies"] == ids["packing"]


def test_every_operator_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_owners_and_repositories_are_counted_apart(spark):
    """One owner with a value in five repositories, and one repository with a value of five owners."""
    rows = [("one", f"r{i}", "token = 'aK9qDEF1Zw3456ghJKL'") for i in range(5)] + [(f"o{i}", "same", "token = 'bK9qDEF1Zw3456ghJKL'") for i in range(5)] + [("one", "r0", "token = 'cK9qDEF1Zw3456ghJKL' token = 'cK9qDEF1Zw3456ghJKL'")]
    df = spark.createDataFrame(rows, "owner string, repo string, text string")
    got = secrets.ownership(secrets.with_candidates(df), repo_cols=("repo",), owner_cols=("owner",)).collect()
    assert sorted((r["repos"], r["owners"], r["seen"], r["live"]) for r in got) == [(1, 1, 2, True), (1, 5, 5, False), (5, 1, 5, False)]


def test_long_added_secrets(spark):
    head = "-----BEGIN " + "VERY " * 12 + "PRIVATE KEY-----"
    text = f"x://{'u' * 90}:{'p9' * 100}@h {head}\n{'QUJD' * 20}\n{head.replace('BEGIN', 'END')}"
    kinds = [secrets.KINDS[k] for k, *_ in secrets.find_candidates(text)]
    assert kinds == ["urlpass", "pem"]


def test_scatter_against_every_subset(spark):
    """The verdicts are those of the subset with the least determinant among all subsets of its size."""
    from itertools import combinations

    rng = np.random.default_rng(8)
    word = lambda m: "".join(rng.choice(list("abcdefghijklm"), m))
    plain = [" ".join(word(rng.integers(3, 8)) for _ in range(rng.integers(80, 140))) for _ in range(10)]
    odd = [" ".join(word(30) + "%%%" for _ in range(100)), " ".join(word(4).upper() + "!!" for _ in range(100)), " ".join(word(3) + "$" for _ in range(300))]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(plain + odd)], "doc_id int, text string, lang string, source string")
    feats = quality.with_text_stats(df).orderBy("doc_id").select(*quality.feature_columns(F.col("stats")))
    x = np.array([tuple(r) for r in feats.collect()])
    floor = np.array(quality.SCALE_FLOOR)
    h = int(np.ceil(quality.SHARE * len(x)))

    def scatter(rows):
        c = np.cov(rows.T, bias=True) / floor[:, None] / floor
        w, v = np.linalg.eigh(c)
        return (v * np.maximum(w, 1)) @ v.T * floor[:, None] * floor

    best = min((np.linalg.slogdet(scatter(x[list(s)]))[1], s) for s in combinations(range(len(x)), h))[1]
    d = x - x[list(best)].mean(0)
    d2 = np.einsum("ij,jk,ik->i", d, np.linalg.inv(scatter(x[list(best)])), d)
    d2 /= max(1.0, np.median(d2) / quality.MEDIAN_CHI2)
    got = {r["doc_id"]: r["kept"] for r in quality.quality_rules(df, min_group=1).collect()}
    assert got == {i: bool(v <= quality.CUTOFF) for i, v in enumerate(d2)}
    assert [i for i, k in got.items() if not k] == [10, 11, 12]


def test_special_tokens_as_the_library_has_them(spark):
    from tokenizers import Tokenizer

    path = vocabularies.path("byte_bpe_50k.json")
    library, rng = Tokenizer.from_file(path), np.random.default_rng(2)
    s = "<|endoftext|>"
    parts = [s, " ", "a", "<", "|>", "endoftext", " word", "\n", "é", s, "日本", "  ", "'s"]
    texts = [f"a {s} b", s, s + s, "", f" {s} ", s[:6], s[6:], "q" * 5000 + s] + ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: r["tokens"]["ids"] for r in bpe.with_tokens(df, path).collect()}
    assert all(got[i] == library.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts))


def test_few_tokens_are_alive_at_once():
    """Words are tokenised by the hundred, so that their tokens stay in the processor's cache; ids are the library's."""
    enc = bpe.Encoder(bpe.load_tokenizer(vocabularies.path("byte_bpe_50k.json")))
    words = [f" {a}{b}é" for a in "abcdefghijklmnopqrstuvwxyz" for b in ("th", "Zq", "ness", "xyzzy") for a in (a, a * 2, a.upper(), a + "o", a + "ing", "re" + a, "un" + a, a + "ly")]
    parts = list(enc._word_ids(words))
    assert len(words) > 500 and max(len(counts) for counts, _ in parts) <= 250 and sum(len(counts) for counts, _ in parts) == len(words)
    assert np.concatenate([ids for _, ids in parts]).tolist() == [i for w in words for i in enc.tokenizer.encode(w).ids]


def test_pieces_of_texts_side_by_side(spark):
    """Pieces and their checksums, with empty texts between others and texts of just a whole number of pieces."""
    import zlib

    from tokenizers import Tokenizer

    path = vocabularies.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = ["", "a", None, "", " the" * 7, " the" * 8, " the" * 15, " the" * 16, "<|endoftext|>", "日本 é×Ã." * 9, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(1)
    for r in packing.with_pieces(df, path, 8, 2).collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        cuts = [0, *range(len(ids) % 8 or 8, len(ids) + 1, 8)]
        want = [(k, a, z - a, zlib.crc32(np.array(ids[a:z], "<u4").tobytes())) for k, (a, z) in enumerate(zip(cuts, cuts[1:]))]
        assert [tuple(p) for p in r["pieces"]] == want


def test_store_of_chunks_is_bounded(monkeypatch):
    import pyarrow as pa

    enc = bpe.Encoder(bpe.load_tokenizer(vocabularies.path("byte_bpe_50k.json")))
    monkeypatch.setattr(enc, "MOST_CACHED", 500, raising=False)
    monkeypatch.setattr(enc, "MOST_IDS", 2000, raising=False)
    fresh_one = bpe.Encoder(enc.tokenizer)
    rng = np.random.default_rng(1)
    for _ in range(20):
        texts = [" ".join("".join(rng.choice(list("abcdé"), rng.integers(1, 7))) for _ in range(100)) + "漢" * 400 for _ in range(3)]
        col = pa.array(texts)
        a, b = next(enc.slices(col)), next(fresh_one.slices(col))
        assert (a[2] == b[2]).all() and (a[3] == b[3]).all()
        assert max(map(len, enc.seen)) <= enc.LONGEST and len(enc.seen) <= 1000


def test_page_text_without_articles_and_classes(spark):
    """Labels come from density, links and neighbours: with article and main tags, classes, ids and roles gone, the same blocks are found."""
    pages = [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    found = wanted = extra = 0
    for page in pages:
        want = Counter(pagetext.main_text(page).split("\n\n"))
        bare = re.sub(r"</?(?:article|main)\b[^>]*>", "", page)
        bare = re.sub(r"""\s(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", "", bare)
        got = Counter(pagetext.main_text(bare).split("\n\n"))
        found += sum((want & got).values())
        wanted += sum(want.values())
        extra += sum((got - want).values())
    assert found >= 0.95 * wanted and extra < 0.15 * wanted


def test_an_article_decides_only_between_neighbours():
    """Inside an article, a block made of links is no text, and density finds the text of a page whose article is mislabelled."""
    links = "".join(f"<a href=/{i}>Read the story of the day {i}</a> " for i in range(9))
    assert pagetext.main_text(f"<article><p>{STORY}</p><p>{links}</p></article>") == STORY
    bare = f"<div>{links}</div><p>{STORY}</p><div>{STORY}</div><div>{links}</div>"
    assert pagetext.main_text(bare) == f"{STORY}\n\n{STORY}"


def test_deep_nesting_is_linear():
    start = time.time()
    assert pagetext.main_text("<div>" * 100_000 + "<p>x" + "</div>" * 100_000) == "x"
    assert time.time() - start < 5
