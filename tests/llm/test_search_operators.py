"""Lexical search, quality scores and hard negatives against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from panelrep.llm import lemp, lexical, quality

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_search(docs, items, top):
    counts = [(d, Counter(TERM.findall(fold(t)))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(TERM.findall(fold(t)))
    out = []
    for i, ts in wanted.items():
        scored = []
        for d, c in counts:
            m = 100 - 90 + (90 * sum(c.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) *
                    ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in ts if c[t])
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(i, r + 1, None if o else d, -s) for r, (s, o, d) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


def test_search_odd(spark, odd_docs, odd_rows, no_docs):
    items = [(1, "The RIVER ran"), (2, None), (3, ""), (4, "año 漢字 -- 123"), (None, "word river"), (1, "mill, word!"),
             (5, "nothing-like-this"), (6, "the river ran"), (6, "the river ran")]
    table = spark.createDataFrame([(i, t, 7, 8) for i, t in items], "item_id long, text string, score int, term int")
    assert found(lexical.search(odd_docs, table, 3)) == brute_search(odd_rows, items, 3)
    assert lexical.search(no_docs, table).count() == 0
    assert lexical.search(odd_docs, table.limit(0)).count() == 0


def test_search_blocks(spark, monkeypatch):
    g = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    docs = [(d, " ".join(g.choices(vocabulary, range(60, 0, -1), k=g.randrange(0, 40)))) for d in range(300)]
    docs += [(1000 + d, docs[5][1]) for d in range(30)]  # ties
    items = [(i, " ".join(g.sample(vocabulary, g.randrange(1, 30)))) for i in range(25)]
    monkeypatch.setattr(lexical, "ITEM_TERMS", 100)
    monkeypatch.setattr(lexical, "CELLS", 500)
    got = lexical.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(7),
                         spark.createDataFrame(items, "item_id long, text string"), 10)
    assert found(got) == brute_search(docs, items, 10)


def test_share():
    g = np.random.default_rng(4)
    items = [np.sort(g.choice(80, g.integers(0, 40), replace=False)) for _ in range(50)] + [np.arange(30)] * 3
    s = lexical.share(items, 80)
    value = g.integers(0, 1000, (80, 6))
    atoms = np.zeros((s.atoms, 6), np.int64)
    np.add.at(atoms, s.atom, value)
    assert (s.totals(atoms) == np.array([value[i].sum(axis=0) for i in items])).all()
    assert len(s.left) + sum(map(len, s.roots)) < sum(map(len, items))  # parts are shared
    assert len(lexical.share([], 0).roots) == 0


def brute_negatives(rows, positives, negatives, every):
    able = [(v, (lab + 1) % 10 if v is not None and v % 7 == 0 else lab, [math.floor(256 * x) for x in e], k)
            for k, (v, e, lab) in enumerate(rows)
            if lab is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for v, lab, e, k in able:
        if v is None or v % every:
            continue
        scored = sorted((-max(-lemp.LAST, min(lemp.LAST, sum(a * b for a, b in zip(e, f)))), w is None, w or 0, j, m) for w, m, f, j in able
                        if j != k and len(f) == len(e))
        for p in [x for x in scored if x[4] == lab][:positives]:
            fit = [x for x in scored if x[4] != lab and 50 * -p[0] <= 100 * -x[0] <= 95 * -p[0]][:negatives]
            out += [(v, None if p[1] else p[2], r + 1, None if x[1] else x[2], -p[0], -x[0])
                    for r, x in enumerate(fit)]
    return sorted(out, key=repr)


def mined(df):
    return sorted(((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score)
                   for r in df.collect()), key=repr)


VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("dims, spread", [(3, 0.2), (16, 0.3), (64, 1.0)])
def test_negatives(spark, monkeypatch, dims, spread):
    monkeypatch.setattr(lemp, "BUCKET_ROWS", 40)
    monkeypatch.setattr(lemp, "ANCHOR_CELLS", 20 * dims)
    monkeypatch.setattr(lemp, "SEEDS", 12)
    g = np.random.default_rng(dims)
    centre = g.normal(size=(8, dims))
    rows = [(i, [float(np.float32(x)) for x in (centre[g.integers(8)] + spread * g.normal(size=dims)) * g.choice([0.3, 1, 2])],
             int(g.choice([0, 0, 0, 1, 2, 9]))) for i in range(500)]
    rows += [(600 + i, rows[50][1], 1) for i in range(12)] + [(700 + i, rows[100][1], 2) for i in range(30)]  # ties
    got = lemp.mine_negatives(spark.createDataFrame(rows, VECTORS).repartition(5), every=25)
    assert mined(got) == brute_negatives(rows, 5, 3, 25)


def test_negatives_odd(spark):
    g = random.Random(6)

    def vec(n):
        return [float(np.float32(g.uniform(-1, 1))) for _ in range(n)]

    rows = [(50 * i, vec(4), i % 3) for i in range(6)] + [(1, None, 0), (2, [1.0, None, 0.0, 1.0], 0), (3, vec(4), None),
            (4, [math.nan] * 4, 1), (5, [math.inf, 0.0, 0.0, 0.0], 1), (None, vec(4), 1), (None, vec(4), 0), (6, [0.0] * 4, 0),
            (8, [], 0), (9, vec(2), 1), (10, vec(2), 0), (150, vec(2), 1), (151, vec(2), 1), (152, vec(2), 1)]
    rows += [(11 + i, [abs(x) for x in vec(4)], i % 3) for i in range(40)]
    rows.append((300, [3e11, 1.0, 0.0, 0.0], 1))  # beyond doubles' whole numbers: products in integers
    rows.append((350, [3e14, 1.0, 0.0, 0.0], 1))  # beyond 64 bits
    rows.append((302, [2.0, 1.0, 0.0, 0.0], 1))
    rows.append((303, [1.5, 1.0, 0.0, 0.0], 0))
    schema = "vec_id long, embedding array<double>, label int, row int, value int, search int"
    table = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], schema)
    assert mined(lemp.mine_negatives(table)) == brute_negatives(rows, 5, 3, 50)
    assert lemp.mine_negatives(table.limit(0)).count() == 0


def test_pruning_leaves_out_members(monkeypatch):
    """Most members of a bucket are not verified where the bound is tight, and none that reaches it is missed."""
    g = np.random.default_rng(9)
    value = g.normal(size=(1000, 8))
    value = np.floor(256 * value / np.linalg.norm(value, axis=1)[:, None] * g.uniform(0.95, 1, (1000, 1)))
    b = lemp.Bucket.of(0, np.arange(1000), np.arange(1000), np.zeros(1000, bool), value)
    q = np.floor(256 * g.normal(size=(5, 8)))
    length = np.linalg.norm(q, axis=1)
    exact = q @ value.T
    least = np.sort(exact, axis=1)[:, -3]
    seen = np.zeros(exact.shape, bool)
    meets = []
    whole = lemp.pair_products
    monkeypatch.setattr(lemp, "pair_products", lambda a, b, bound: meets.append(len(a)) or whole(a, b, bound))
    top = np.full(5, np.inf)
    for i, members, scores in lemp.by_anchor(lemp.verified(b, q, length, least, top)):
        seen[i, members] = True
        assert (scores == exact[i, members]).all()
    assert (seen == (exact >= least[:, None])).all()
    assert sum(meets) < 0.2 * exact.size
    assert not list(lemp.verified(b, q, length, length * b.longest * 1.01, top))


def labelled(n):
    """Texts in which words follow each other freely, and ones that repeat or shout."""
    g = random.Random(n)
    stems = [a + b for a in ("ka", "lo", "mi", "ru", "te", "so") for b in ("n", "ra", "sil", "ver", "t", "mon")]
    rows, labels = [], []
    for d in range(n):
        w = [g.choice(stems) for _ in range(g.randrange(20, 120))]
        good = g.random() < 0.8
        if not good:
            w = [w[0]] * 20 + [w[1]] * 30 if d % 2 else [x.upper() + "!!" for x in w]
        rows.append((d, " ".join(w)))
        labels.append((d, int(good), 0))
    return rows, labels


def test_quality_held_out(spark):
    rows, labels = labelled(900)
    got = quality.quality_table(spark.createDataFrame(rows, "doc_id long, text string"),
                                spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    y = {d: q for d, q, _ in labels}
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {d for d, _ in rows if zlib.crc32(str(d).encode()) % 5 == 0}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert np.mean([r.predicted == y[r.doc_id] for r in held]) > 0.95


def test_quality_odd(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(d, d % 2, 0) for d in range(1, 12)] + [(None, 1, 0), (5, 0, 0), (1, None, 0), (1, 7, 1)],
                                   "doc_id long, quality int, toxic int")
    got = quality.quality_table(odd_docs, labels).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.score)
    assert by[2] == by[3] == by[4] and len(by[5]) == 1
    assert quality.quality_table(no_docs, labels).count() == 0
    alone = quality.quality_table(odd_docs, labels.limit(0)).collect()
    assert {r.score for r in alone} == {0.5}


def test_pooling_by_hand():
    """Word vectors and pooled vectors equal a plain loop, also where a text comes in pieces."""
    s = quality.Settings(dims=5, signs=2)
    vocabulary = quality.Vocabulary(["one", "two", "!!"])
    index = quality.index_vectors(vocabulary.size, s.dims, s.signs)
    text = "one two one !! Three one two FOUR 55 two one __ two " * 3
    seq = [vocabulary.number.get(w, vocabulary.number[quality.shape(w)]) for w in quality._WORD.findall(text)]
    assert np.concatenate(list(vocabulary.numbers(text))).tolist() == seq
    want = np.zeros(index.shape)
    for i in range(len(seq)):
        for j in range(len(seq)):
            if 0 < abs(i - j) <= 2:
                want[seq[i]] += index[seq[j]] / abs(i - j)
    for cut in (1, 4, len(seq)):
        got = np.zeros(index.shape)
        pieces = [np.array(seq[k:k + cut], np.int32) for k in range(0, len(seq), cut)]
        quality.contexts(iter(pieces), quality.entries(index), 2, got)
        assert np.allclose(got, want)
        x = index[seq].astype(float)
        assert np.allclose(quality.pooled(iter(pieces), index),
                           np.concatenate([x.mean(axis=0), np.abs(np.diff(x, axis=0)).mean(axis=0)]), atol=1e-6)


def test_network_slopes_lower_the_loss():
    g = np.random.default_rng(2)
    x = g.normal(size=(800, 6))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)  # no single layer can tell
    net = quality.fit_network(x, y, np.ones(800), quality.Settings(epochs=150))
    assert ((net.probability(x) > 0.5) == y)[600:].mean() > 0.85
    z = net.logits(x[600:])
    assert quality._loss(z / net.temperature, y[600:], np.ones(200)) <= quality._loss(z, y[600:], np.ones(200)) + 1e-9
