"""Operators over pairs and whole tables, and the pipeline, against brute force."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from panelrep.llm import histshard, lattice, minhash
from panelrep.llm.common import components
from panelrep.llm.lattice import near_points, near_vectors
from panelrep.llm.queries import QUERIES
from panelrep.llm.shingles import shingle_sets, words


def union_find(n, links):
    top = list(range(n))

    def find(x):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def word_sets(texts, width):
    out = []
    for t in texts:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall("[^\x20\x09-\x0D]+", low)
        out.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else
                   {tuple(w)} if w else set())
    return out


def brute_components(ids, texts, width):
    s = word_sets(texts, width)
    links = [(i, j) for i in range(len(s)) for j in range(i) if s[i] and s[j] and
             100 * len(s[i] & s[j]) >= 80 * len(s[i] | s[j])]
    return [len(x) for x in s], [ids[r] for r in union_find(len(s), links)]


def test_components(spark):
    g = random.Random(1)
    links = [(g.randrange(200), g.randrange(200)) for _ in range(120)] + [(0, i) for i in range(150, 200)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = union_find(200, links)
    assert all(got.get(i, i) == want[i] for i in range(200))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, sf_small, width):
    rows = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    rows = sorted((r.doc_id, r.text) for r in rows)
    g = random.Random(5)
    base = [g.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(i) for i in range(60)]
    for k in range(40):  # a chain: each text one word on from the last, so neighbours link and ends do not
        rows.append((10_000 + k, " ".join(base[k // 4:k // 4 + 40])))
    ids = [d for d, _ in rows]
    n, want = brute_components(ids, [t for _, t in rows], width)
    got = {r.doc_id: r for r in minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), width).collect()}
    assert [got[d].n_shingles for d in ids] == n
    assert [got[d].component_id for d in ids] == want
    assert all(got[d].kept == (d == got[d].component_id) for d in ids)


def test_near_duplicates_odd(odd_docs, no_docs, odd_rows):
    got = minhash.near_duplicates(odd_docs).collect()
    assert len(got) == len(odd_rows)
    by = {r.doc_id: r for r in got}
    assert by[5].component_id == by[1].component_id == by[11].component_id == 1 and by[1].kept and not by[5].kept
    assert by[2].n_shingles == by[3].n_shingles == by[4].n_shingles == 0
    assert by[2].component_id == 2 and by[9].n_shingles == 1
    assert by[None].component_id is None and by[None].kept
    assert minhash.near_duplicates(no_docs).count() == 0
    kept = minhash.keep_one(odd_docs, 2)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10]
    twice = odd_docs.filter("doc_id = 7").unionByName(odd_docs.filter("doc_id = 7"))
    assert minhash.keep_one(twice, 2).count() == 1
    assert minhash.keep_one(no_docs).count() == 0


def test_shared_doc_id_is_one_document(spark):
    a, b = " ".join(f"u{i}" for i in range(30)), " ".join(f"v{i}" for i in range(30))
    got = minhash.near_duplicates(spark.createDataFrame([(3, a), (3, b), (1, a), (2, b)], "doc_id long, text string"))
    assert {r.component_id for r in got.collect()} == {1}


def test_shingles_of_texts_in_a_row():
    texts = ["a b c", "", "a b", "c a b c", " A\tb\x0bc "]
    data = "".join(texts).encode()
    at = np.append(0, np.cumsum([len(t) for t in texts]))
    got = shingle_sets(np.frombuffer(data, np.uint8), at, 2)
    assert [len(x) for x in got] == [2, 0, 1, 3, 2]
    assert set(got[0].tolist()) == set(got[4].tolist()) and got[2][0] in got[0]


# embeddings

def test_nearest_lattice_point():
    z = np.random.default_rng(1).normal(0, 1.5, (300, 8))
    points, dist = near_points(z, 6)
    assert np.allclose(((points / 2 - z[:, None]) ** 2).sum(axis=2), dist) and (np.diff(dist, axis=1) >= 0).all()
    doubled = points.astype(int)
    assert ((doubled % 2 == doubled[:, :, :1] % 2).all(axis=2) & (doubled.sum(axis=2) % 4 == 0)).all()
    steps = np.random.default_rng(2).integers(-1, 2, (400, 8))
    steps = steps[steps.sum(axis=1) % 2 == 0]
    near = points[:, 0] / 2  # no lattice neighbour is nearer
    for s in steps:
        assert (((near + s - z) ** 2).sum(axis=1) >= dist[:, 0] - 1e-9).all()


def test_near_vectors(spark):
    g = np.random.default_rng(4)
    rows = []
    for group, size, spread in ((0, 60, 0.15), (1, 30, 0.40), (2, 5, 0.05)):
        centre = g.normal(size=64)
        centre /= np.linalg.norm(centre)
        for _ in range(size):
            noise = g.normal(size=64)
            rows.append((centre + spread * noise / np.linalg.norm(noise)).tolist())
    rows += [g.normal(size=64).tolist() for _ in range(200)]
    rows += [rows[0], rows[0], [3 * x for x in rows[1]]]
    odd = [None, [], [0.0] * 64, [float("nan")] * 64, [1.0, None] * 32, [float("inf")] + [0.0] * 63, [1.0, 2.0]]
    x = np.array(rows)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    same = x @ x.T >= 0.9
    want = union_find(len(rows), [(i, j) for i, j in zip(*np.nonzero(same)) if i != j])
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(rows + odd)],
                               "vec_id long, embedding array<double>, node int")
    got = {r.vec_id: r for r in near_vectors(df).collect()}
    assert len(got) == len(rows) + len(odd)
    links = np.array([got[i].n_links for i in range(len(rows))])
    true = same.sum(axis=1) - 1
    assert (links <= true).all() and links.sum() >= 0.95 * true.sum()
    assert np.mean([got[i].component_id == want[i] for i in range(len(rows))]) >= 0.98
    for i in range(len(rows), len(rows) + len(odd)):
        assert got[i].n_links == 0 and got[i].component_id == i and got[i].kept
    assert near_vectors(df.limit(0)).count() == 0


def pairs_at(g, dims, cosine, n):
    """Unit vectors a and b in pairs of that cosine."""
    a, b = g.normal(size=(2, n, dims))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    return a, cosine * a + np.sqrt(1 - cosine ** 2) * b


@pytest.mark.parametrize("dims", [4, 8, 16, 32, 48, 64, 128, 768])
def test_linked_pairs_share_cells_in_any_dimension(dims):
    for cosine, link in ((0.9, 0.9), (0.91, 0.9), (0.93, 0.9), (0.8, 0.8), (0.95, 0.95)):
        a, b = pairs_at(np.random.default_rng(dims), dims, cosine, 300)
        hit = np.zeros(300, bool)
        for t in range(lattice.TABLES):
            x, y = lattice.cell_keys(a, t, link), lattice.cell_keys(b, t, link)
            hit |= (x[:, :1] == y).any(axis=1) | (y[:, :1] == x).any(axis=1)
        assert hit.mean() >= 0.96, (cosine, link)


def test_planted_pairs_in_32_dimensions(spark):
    a, b = pairs_at(np.random.default_rng(5), 32, 0.905, 150)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.concatenate([a, b]))],
                               "vec_id long, embedding array<double>")
    got = {r.vec_id: r.component_id for r in near_vectors(df, 0.9).collect()}
    assert sum(got[i] == got[150 + i] for i in range(150)) >= 0.95 * 150


def test_equal_vectors_and_null_ids(spark):
    df = spark.createDataFrame([(4, [1.0, 0.0]), (2, [1.0, 0.0]), (None, [1.0, 0.0]), (4, [1.0, 0.0])],
                               "vec_id long, embedding array<float>")
    got = near_vectors(df).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(3, 2)}
    assert [r.kept for r in sorted(got, key=lambda r: r.vec_id or 0)] == [True, True, False, False]


# shards

def check_shards(docs, out, shards=40):
    want = sorted((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in docs if d is not None)
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in out if r.doc_id is not None) == want
    assert len(out) == len(docs)
    total, biggest = sum(r.size for r in out), max(r.size for r in out)
    held = [0] * shards
    slots = [[] for _ in range(shards)]
    for r in out:
        held[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    assert max(abs(h - total / shards) for h in held) <= biggest + 0.001 * total / shards


def test_shards(spark, sf_small, odd_docs, no_docs, odd_rows):
    for sf in (sf_small, "/root/testdata/sf0.01"):
        docs = spark.read.parquet(f"{sf}/documents.parquet")
        check_shards([(r.doc_id, r.text) for r in docs.collect()], QUERIES["op10_histogram_sort"](spark, sf).collect())
    check_shards(odd_rows, histshard.shard_documents(odd_docs).collect())
    assert histshard.shard_documents(no_docs).count() == 0


def test_hot_text_and_repeated_rows(spark):
    hot = [(i, "the same text") for i in range(3000)] + [(i, f"other {i}") for i in range(3000, 4000)]
    check_shards(hot, histshard.shard_documents(spark.createDataFrame(hot, "doc_id long, text string"),
                                                leaf_rows=50, leaves=100).collect())
    rows = [(7, "one row again and again")] * 2000 + [(8, "x")]
    check_shards(rows, histshard.shard_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect())


# registration and the pipeline

def test_ten_operators_and_the_pipeline_are_registered():
    names = __spark_entry__.queries()
    assert [sum(q.startswith(f"op{n}_") for q in names) for n in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "secrets",
                                                      "tokens"]


def test_pipeline(spark, sf_small, tokenizers_at):
    import sentencepiece

    from panelrep.llm.secretscan import BASE, RULES

    lib = sentencepiece.SentencePieceProcessor(model_file=tokenizers_at("piece_bpe_32k.model"))
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect())
    items = [re.sub(r"\s+", " ", r.text.lower()) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    docs = [(d, t) for d, t in docs if any(c.isalpha() for c in t or "")]
    _, part = brute_components([d for d, _ in docs], [t for _, t in docs], 5)
    docs = [x for x, p in zip(docs, part) if x[0] == p]
    docs = [(d, t) for d, t in docs if not any(i in re.sub(r"\s+", " ", t.lower()) for i in items)]
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_small).collect()}
    assert got.keys() <= {d for d, _ in docs}  # items with edits go as well
    assert len(got) >= 0.97 * len(docs)
    rules = [re.compile((f"(?i:{r.head})" if r.any_case else r.head) + f"{r.tail}{{{r.least},}}") for r in RULES]
    for d, t in docs:
        if d in got and not any(x.search(t) for x in rules):
            assert got[d].ids == lib.encode(t, add_bos=True, add_eos=True) and got[d].n_tokens == len(got[d].ids)
        elif d in got:
            assert "[SECRET]" in lib.decode(got[d].ids)
    assert BASE


def test_language_stage_with_columns_of_its_own_names(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").withColumns(
        {c: F.lit(7) for c in ("__score", "__called", "score", "lang_pred")})
    out = corpus_pipeline.language_id(spark, docs, sf_small)
    assert out.columns == docs.columns and out.filter("__score = 7 and __called = 7").count() == out.count() > 0


def test_pipeline_stages_on_odd_tables(spark, odd_docs, no_docs, sf_small):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_small)
            assert name == "tokens" or out.columns == docs.columns
            if name == "language_id" and docs is odd_docs:
                assert out.count() == docs.count() - 4  # null, empty, blank and without a letter
            elif name in ("secrets", "tokens", "decontamination"):
                assert out.count() == docs.count()
            else:
                assert out.count() <= docs.count()


@pytest.mark.parametrize("lang", ["cast(null as string)", "'und'", "if(crc32(cast(doc_id as string)) % 3 = 1, lang, null)"])
def test_language_id_drops_no_lettered_document_for_its_lang(spark, sf_small, odd_docs, lang):
    clean = spark.read.parquet(f"{sf_small}/documents.parquet").withColumn("lang", F.expr(lang))
    assert corpus_pipeline.language_id(spark, clean, sf_small).count() == clean.count()
    odd = odd_docs.withColumn("lang", F.expr(lang))
    assert corpus_pipeline.language_id(spark, odd, sf_small).count() == odd.count() - 4


def test_language_id_fills_in_null_languages_only(spark, sf_small):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    holes = docs.withColumn("lang", F.expr("if(doc_id % 5 = 0, null, lang)"))
    got = {r.doc_id: r.lang for r in corpus_pipeline.language_id(spark, holes, sf_small).select("doc_id", "lang").collect()}
    assert all(got[d] == lang[d] for d in got if d % 5)
    filled = [got[d] == lang[d] for d in got if d % 5 == 0]
    assert len(filled) > 50 and sum(filled) / len(filled) > 0.97


def test_remainders(spark):
    row = spark.range(1).select(F.crc32(F.lit(17).cast("string")).alias("c")).first()
    assert row.c == zlib.crc32(b"17")


def test_blocks_find_what_pairs_find(spark, monkeypatch):
    from panelrep.llm import minhash as m

    g = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(70):  # copies that differ from the base in a quarter of their words: some link, some do not
        t = list(base)
        for p in g.sample(range(60), g.choice([1, 3, 5, 9])):
            t[p] = f"x{i}_{p}"
        rows.append((i, " ".join(t)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, want = brute_components([d for d, _ in rows], [t for _, t in rows], 2)
    assert len(set(want)) > 3
    for block, pairwise in ((256, 16), (4, 0)):
        monkeypatch.setattr(m, "BLOCK", block)
        monkeypatch.setattr(m, "PAIRWISE", pairwise)
        got = {r.doc_id: r.component_id for r in m.near_duplicates(docs).collect()}
        assert [got[i] for i in range(70)] == want


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") & 1] for i in range(n))


def test_words_that_polynomial_hashes_confuse(spark):
    """The Thue-Morse word and its complement agree under any polynomial hash modulo 2^64."""
    one = thue_morse(1024)
    two = one.translate(str.maketrans("ab", "ba"))
    short = [thue_morse(64), thue_morse(64).translate(str.maketrans("ab", "ba"))]
    rows = [(1, one), (2, two), (3, one + " x"), (4, two + " x"), (5, short[0]), (6, short[1]), (7, one)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 1}


def test_word_hashes_depend_on_every_byte():
    g = random.Random(8)
    texts = ["".join(g.choices("abc", k=n)) for n in range(1, 150) for _ in range(4)]
    texts += [t + c for t in texts for c in "ab"] + [c + t for t in texts for c in "ab"] + ["a" * n for n in range(1, 200)]
    texts = sorted(set(texts))
    raw = np.frombuffer(" ".join(texts).encode(), np.uint8)
    h, at = words(raw, np.array([0, len(raw)]))
    assert len(h) == len(texts) == len(set(h.tolist())) and at.tolist() == [0, len(texts)]
    upper, _ = words(np.frombuffer(" ".join(texts).upper().encode(), np.uint8), np.array([0, len(raw)]))
    assert (h == upper).all()


def test_rare_shingles_miss_no_similar_set():
    g = np.random.default_rng(6)
    base = g.choice(5000, 120, replace=False).astype(np.uint64)
    sets = []
    for _ in range(150):
        keep = base[g.random(120) < g.uniform(0.6, 1)]
        sets.append(np.unique(np.append(keep, g.integers(0, 5000, g.integers(0, 40)).astype(np.uint64))))
    sets += [np.array([7], np.uint64), np.array([7], np.uint64), base[:2]]
    index = minhash.RareShingles(sets[:100], 80)
    tried = 0
    for x in sets[100:] + sets[:10]:
        near = {i for i, y in enumerate(sets[:100])
                if 100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y))}
        found = set(index.candidates(x).tolist())
        assert near <= found
        tried += len(found)
    assert tried < 0.8 * 63 * 100
    assert minhash.RareShingles([], 80).candidates(base).tolist() == []


def test_form_letters_below_the_threshold(spark):
    """Letters that share two thirds of their shingles meet in buckets and link with none; copies of them link."""
    g = random.Random(12)
    form = [f"form{i}" for i in range(120)]
    rows = [(k, " ".join(form + [f"own{g.randrange(10**9)}" for _ in range(30)])) for k in range(400)]
    rows += [(1000 + k, rows[k][1] + " ps") for k in range(0, 400, 40)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: d - 1000 if d >= 1000 else d for d, _ in rows}
