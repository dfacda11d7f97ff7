"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network.

Every word has a sparse random index vector.  A word's own vector is its index
vector together with the sum of those of the words around it, gathered over the
training texts, without the part that all words share.  A document is the mean
of its words' vectors and the mean distance, coordinate by coordinate, of
neighbouring ones.  A network with one hidden layer, trained by gradient steps,
turns that into a score; its temperature is set on texts it has not learned from.

Words are runs of letters (case counts), of digits or of other signs.  Rare words
stand for their shape: lower, capital or mixed case, digits, the sign they begin with.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_folder
from .common import blocks

_WORD = re.compile(r"[^\W\d_]+|\d+|(?:[^\w\s]|_)+")
#: Characters of a text that are split into words at a time; a piece ends at white space where there is some.
PIECE = 1 << 18
#: Words whose vectors are laid out at a time.
STEP = 1 << 13
SHAPES = ("aa", "Aa", "AA", "aA", "99", *(f"_{k}" for k in range(64)))


@dataclass(frozen=True)
class Settings:
    """``per_class``: most labelled documents of a class that are learned from, whole; ``words``: most words with a
    vector of their own; ``share`` of the documents train the network, the rest set its length and temperature."""

    per_class: int = 3000
    words: int = 20_000
    least: int = 3
    dims: int = 48
    signs: int = 6
    reach: int = 2
    hidden: int = 24
    epochs: int = 60
    batch: int = 64
    share: float = 0.75


def words(text: str) -> Iterator[list[str]]:
    """The words of a text, piece by piece."""
    lo = 0
    while lo < len(text):
        hi = lo + PIECE
        if hi < len(text):
            while hi < min(len(text), lo + 2 * PIECE) and not text[hi].isspace():
                hi += 1
        yield _WORD.findall(text, lo, hi)
        lo = hi


def shape(word: str) -> str:
    c = word[0]
    if c.isalpha():
        return "aa" if word.islower() else "AA" if word.isupper() and len(word) > 1 else \
            "Aa" if word[1:].islower() or len(word) == 1 else "aA"
    return "99" if c.isdigit() else f"_{ord(c) % 64}"


class Vocabulary:
    """Numbers of words; those without a vector of their own have that of their shape."""

    def __init__(self, own: list[str]) -> None:
        names = [*SHAPES, *own]
        self.number = {w: i for i, w in enumerate(names)}
        self.size = len(names)

    def numbers(self, text: str) -> Iterator[np.ndarray]:
        get = self.number.get
        for found in words(text):
            out = np.fromiter((get(w, -1) for w in found), np.int32, len(found))
            for i in np.flatnonzero(out < 0).tolist():
                out[i] = self.number[shape(found[i])]
            yield out


def index_vectors(count: int, dims: int, signs: int) -> np.ndarray:
    """Sparse random vectors of -1, 0 and 1 with ``signs`` entries that are not 0."""
    g = np.random.default_rng((count, dims, 12))
    at = np.argsort(g.random((count, dims)), axis=1)[:, :signs]
    out = np.zeros((count, dims), np.float32)
    np.put_along_axis(out, at, g.choice(np.array([-1, 1], np.float32), at.shape), axis=1)
    return out


def entries(index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places and values of the entries of index vectors that are not 0."""
    place = np.argsort(index == 0, axis=1, kind="stable")[:, :int((index != 0).sum(axis=1).max(initial=0))]
    return place, np.take_along_axis(index, place, axis=1).astype(np.float64)


def contexts(numbers: Iterator[np.ndarray], index: tuple[np.ndarray, np.ndarray], reach: int, into: np.ndarray) -> None:
    """Adds to every word the index vectors, given by their entries, of the words up to ``reach`` places from it."""
    last, (place, value), flat, dims = np.zeros(0, np.int32), index, into.reshape(-1), into.shape[1]
    for new in numbers:
        seq = np.concatenate([last, new])
        for d in range(1, reach + 1):
            lo = max(0, len(last) - d)
            a, b = seq[lo:-d] if len(seq) > d else seq[:0], seq[lo + d:]
            for x, y in ((a, b), (b, a)):
                np.add.at(flat, (x.astype(np.int64) * dims)[:, None] + place[y], value[y] / d)
        last = seq[-reach:]


def word_vectors(index: np.ndarray, context: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Unit vectors of own and context parts, without the direction that all words share."""
    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    c = context - (context.sum(axis=0) / max(1.0, count.sum())) * count[:, None]
    return (0.5 * unit(index) + unit(c)).astype(np.float32)


def pooled(numbers: Iterator[np.ndarray], vectors: np.ndarray) -> np.ndarray:
    """Mean of the words' vectors, and mean absolute difference of neighbouring ones; zeros without words."""
    dims = vectors.shape[1]
    mean, apart, n, last = np.zeros(dims), np.zeros(dims), 0, None
    for seq in numbers:
        for lo in range(0, len(seq), STEP):
            x = vectors[seq[lo:lo + STEP]]
            mean += x.sum(axis=0)
            if last is not None:
                apart += np.abs(x[0] - last)
            apart += np.abs(x[1:] - x[:-1]).sum(axis=0)
            n, last = n + len(x), x[-1]
    return np.concatenate([mean / max(n, 1), apart / max(n - 1, 1)])


@dataclass
class Network:
    """Two layers over standardised inputs; ``temperature`` divides the output before the logistic function."""

    centre: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray] = field(default_factory=list)
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        return np.tanh((x - self.centre) / self.scale @ a + b) @ c + d[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def _loss(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    return float((w * (np.logaddexp(0, z) - y * z)).sum() / w.sum())


def fit_network(x: np.ndarray, y: np.ndarray, weight: np.ndarray, s: Settings) -> Network:
    """Trains on the first ``share`` of the rows; the rest choose the epoch and the temperature."""
    cut = max(1, int(len(x) * s.share))
    held = slice(cut, None) if cut < len(x) else slice(0, None)
    net = Network(x[:cut].mean(axis=0), x[:cut].std(axis=0) + 1e-3)
    g = np.random.default_rng(12)
    p = [g.normal(0, x.shape[1] ** -0.5, (x.shape[1], s.hidden)), np.zeros(s.hidden),
         g.normal(0, s.hidden ** -0.5, s.hidden), np.array([np.log((weight * y).sum() / (weight * (1 - y)).sum())])]
    first, second, step = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
    best, net.layers = np.inf, p
    inputs = (x - net.centre) / net.scale
    for _ in range(s.epochs):
        order = g.permutation(cut)
        for lo in range(0, cut, s.batch):
            i = order[lo:lo + s.batch]
            h = np.tanh(inputs[i] @ p[0] + p[1])
            z = h @ p[2] + p[3][0]
            e = weight[i] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[i]) / weight[i].sum()
            back = e[:, None] * p[2] * (1 - h * h)
            step += 1
            for k, slope in enumerate((inputs[i].T @ back + 1e-3 * p[0], back.sum(axis=0), h.T @ e + 1e-3 * p[2],
                                       np.array([e.sum()]))):
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope * slope
                p[k] = p[k] - 0.003 * (first[k] / (1 - 0.9 ** step)) / \
                    (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
        now = _loss(np.tanh(inputs[held] @ p[0] + p[1]) @ p[2] + p[3][0], y[held], weight[held])
        if now < best:
            best, net.layers = now, list(p)
    z = net.logits(x[held])
    tried = np.geomspace(0.25, 8, 101)
    net.temperature = float(min(tried, key=lambda t: _loss(z / t, y[held], weight[held])))
    return net


@dataclass
class QualityModel:
    """Without documents of both classes there is no network and every text scores ``prior``."""

    prior: float
    vocabulary: Vocabulary | None = None
    vectors: np.ndarray | None = None
    network: Network | None = None

    def features(self, text: str) -> np.ndarray:
        return pooled(self.vocabulary.numbers(text), self.vectors)

    def score(self, texts: list[str]) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.prior)
        x = np.array([self.features(t) for t in texts]).reshape(len(texts), -1)
        return self.network.probability(x)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for rows, raw, at in blocks(batches, "text"):
        whole = raw.tobytes()
        yield rows, [whole[a:b].decode() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def _sample(docs: DataFrame, labels: DataFrame, s: Settings) -> tuple[DataFrame | None, dict[int, int]]:
    """Labelled documents by hash, at most about ``per_class`` of each class; and how many there are of each."""
    known = labels.filter("quality in (0, 1) and doc_id is not null") \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.min("quality").alias("y"), F.max("quality").alias("most")).filter("y = most") \
        .select("doc_id", F.col("y").cast("int").alias("y"), F.xxhash64("doc_id").alias("h"))
    n = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return None, n
    scale = 1 << 30
    part = {c: int(min(1.0, s.per_class / n[c]) * scale) for c in n}
    drawn = known.filter(F.pmod("h", F.lit(scale)) < F.when(F.col("y") == 1, part[1]).otherwise(part[0]))
    # F.broadcast: at most about 2 * per_class rows of 20 bytes
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").filter("text <> ''") \
        .join(F.broadcast(drawn), "doc_id").select("h", "doc_id", "y", "text"), n


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> QualityModel:
    """Fits on a hashed sample of labelled documents, bounded in rows by ``settings``; their texts stay on executors.

    The driver gets the counts of the most frequent words, a fixed number of
    matrices of context sums and one pooled vector for each document.
    """
    s, spark = settings, docs.sparkSession
    rows, n = _sample(docs, labels, s)
    prior = (n.get(1, 0) + 1) / (n.get(0, 0) + n.get(1, 0) + 2)
    if rows is None:
        return QualityModel(prior)
    at = f"{scratch_folder(spark, 'quality')}/sample"
    rows.repartition(8, "h", "doc_id").write.parquet(at)
    rows = spark.read.parquet(at)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _texts(batches):
            seen: dict[str, int] = {}
            for text in texts:
                for w in set().union(*words(text)):
                    seen[w] = seen.get(w, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                             ["word", "n"])

    own = rows.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")) \
        .filter(F.col("n") >= s.least).orderBy(F.desc("n"), "word").limit(s.words).collect()
    vocabulary = Vocabulary(sorted(r.word for r in own))
    index = index_vectors(vocabulary.size, s.dims, s.signs)
    sparse = entries(index)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, times = np.zeros(index.shape, np.float64), np.zeros(len(index), np.float64)
        for _, texts in _texts(batches):
            for text in texts:
                seq = list(vocabulary.numbers(text))
                contexts(iter(seq), sparse, s.reach, context)
                for q in seq:
                    times += np.bincount(q, minlength=len(times))
        yield pa.RecordBatch.from_arrays([pa.array([context.tobytes()]), pa.array([times.tobytes()])], ["context", "times"])

    context, times = np.zeros(index.shape), np.zeros(len(index))
    for r in rows.select("text").coalesce(8).mapInArrow(gather, "context binary, times binary").toLocalIterator():
        context += np.frombuffer(r.context).reshape(index.shape)
        times += np.frombuffer(r.times)
    model = QualityModel(prior, vocabulary, word_vectors(index, context, times))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _texts(batches):
            x = np.array([model.features(t) for t in texts])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("h", "doc_id", "y")), pa.array([v.tobytes() for v in x])],
                ["h", "doc_id", "y", "x"])

    got = rows.mapInArrow(features, "h long, doc_id long, y int, x binary").collect()
    got.sort(key=lambda r: (r.h, r.doc_id, bytes(r.x)))
    x, y = np.array([np.frombuffer(r.x) for r in got]), np.array([float(r.y) for r in got])
    if not 0 < y.sum() < len(y):
        return QualityModel(prior)
    weight = np.where(y == 1, n[1] / y.sum(), n[0] / (len(y) - y.sum()))
    model.network = fit_network(x, y, weight / weight.mean(), s)
    return model


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score (0 to 1, higher: likelier of quality 1) of every whole text, by nothing but the text.

    A null or empty text, or one without words, has the network's score of no
    words.  Repeated rows are rows of their own; an empty table gives an empty result.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in _texts(batches):
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(model.score(texts))], ["doc_id", "score"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(work, "doc_id long, score double")


def quality_table(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.3) \
        -> DataFrame:
    """doc_id, held_out, score, predicted: learned from rows whose crc32(doc_id) mod 5 is not 0, applied to all.

    Rows with a null doc_id have no label and count as not held out; a document
    whose labels disagree is not learned from.
    """
    rest = F.crc32(F.col("doc_id").cast("string")) % 5
    model = train(docs, labels.filter(rest != 0), settings)
    return score(docs, model).select(
        "doc_id", F.coalesce(rest == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
