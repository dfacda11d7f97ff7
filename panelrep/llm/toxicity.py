"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

A label marks a whole document, but few of its words carry it.  Toxic text for
the dictionary is therefore the short windows of toxic documents that hold
byte runs far more frequent there than in ordinary ones.  Both dictionaries are
trained apart; a window's distance is the length it compresses to with the
ordinary dictionary less the length with the toxic one put before it.
Distances are turned into log-likelihood ratios, a threshold for each length.
A passage's ratios give its log odds as if it were a document; a document's
probability is that of the whole where it is short, and where it is long that of
its likeliest passage against a threshold that grows with the number of windows,
so that a toxic passage counts in a short and in a very long text.  All steps are
calibrated on labelled documents that the dictionaries have not seen, alone and
joined to others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks

RUN = 5  # bytes of the runs that are counted
LONG_RUN = 12  # of those that tell copies of a document
REACH = 10  # distances beyond it count as it
PASSAGE = 8  # windows of the shortest passage
SHORT, LONG = 48, 192  # windows up to which a text is judged as a whole, and from which by its passages only


@dataclass(frozen=True)
class Settings:
    """``toxic``, ``ordinary``: most labelled documents of each kind that are learned from, whole;
    ``share``: of them for the dictionaries, the rest calibrates; ``samples``: most windows of ordinary documents,
    drawn evenly over all of them, that the ordinary dictionary is trained on; ``joined``: numbers of ordinary
    documents that calibrating ones are joined to."""

    toxic: int = 2400
    ordinary: int = 6000
    share: float = 0.7
    samples: int = 240_000
    joined: tuple[int, ...] = (4, 20, 80)
    window: int = 160
    toxic_bytes: int = 4096
    ordinary_bytes: int = 8192
    level: int = 16


def windows(text: bytes, size: int, slack: int = 0) -> list[bytes]:
    """The text, A-Z lowered, cut at the first space from ``size`` bytes on, ``slack`` (or ``size``) bytes later at most."""
    b, out, i = text.lower(), [], 0
    reach = size + (slack or size)
    while i < len(b):
        j = b.find(b" ", i + size, i + reach)
        j = min(len(b), i + reach) if j < 0 else j
        out.append(b[i:j])
        i = j
    return out


def _runs(b: bytes, size: int, bits: int) -> np.ndarray:
    """Hashes of the byte runs of a text."""
    a = np.frombuffer(b, np.uint8).astype(np.uint64)
    n = len(a) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = h * np.uint64(0x100000001B3) + a[k:k + n] + np.uint64(1)
    h ^= h >> np.uint64(29)
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def _unlike(texts: list[bytes]) -> list[bytes]:
    """The texts without those that mostly repeat earlier ones, so that copies do not count as frequency."""
    seen, out = np.zeros(1 << 24, bool), []
    for b in texts:
        g = _runs(b.lower(), LONG_RUN, 24)
        if len(g) and seen[g].mean() < 0.5:
            out.append(b.lower())
            seen[g] = True
    return out


def _dictionary(samples: list[bytes], size: int, segment: int, level: int) -> bytes:
    """A trained dictionary; of too few samples the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=6, level=level).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[:size]


@dataclass(frozen=True)
class ToxicModel:
    settings: Settings
    toxic: bytes = b""
    ordinary: bytes = b""
    passage: np.ndarray = field(default_factory=lambda: np.array([0.0, 0.0, 0.0, -20.0]), compare=False)
    ratio: tuple[float, ...] = field(default=(0.0,) * (2 * REACH + 1))
    weights: tuple[float, ...] = (0.0, 0.0, 0.0, -20.0)

    def distances(self, text: bytes) -> np.ndarray:
        """Distances of the text's windows, from 0 to 2 * REACH."""
        plain, both = _compressors(self)
        out = [len(plain(w)) - len(both(w)) for w in windows(text, self.settings.window)]
        return np.clip(np.array(out, np.int64), -REACH, REACH) + REACH

    def _part(self, sums: np.ndarray, strong: np.ndarray, size: int) -> np.ndarray:
        """Log odds of passages of ``size`` windows, from the sums of all their ratios and of the three strongest."""
        return self.passage @ np.array([sums / 10, strong, np.full(len(sums), np.log1p(size)), np.ones(len(sums))])

    def features(self, distances: np.ndarray) -> tuple[float, list[float]]:
        """Log odds of the whole text as one passage; log odds of its likeliest passage, and its number of windows.

        Passages of ``PASSAGE`` windows, twice as many and so on, each beginning
        where the one before is half over, are taken as documents of their own.
        """
        r, n, most = np.array(self.ratio)[distances], len(distances), []
        size = PASSAGE
        while size < n:
            for lo in {0, size // 2, n % size}:
                part = r[lo:lo + (n - lo) // size * size].reshape(-1, size)
                if len(part):
                    most.append(self._part(part.sum(axis=1), np.partition(part, -3, axis=1)[:, -3:].sum(axis=1), size).max())
            size *= 2
        whole = float(self._part(r.sum(keepdims=True), np.sort(r)[-3:].sum(keepdims=True), n)[0])
        many = float(np.log1p(n))
        return whole, [max([whole, *most]), many, many * many / 10, 1.0]

    def log_odds(self, distances: np.ndarray) -> float:
        """Of a short text those of the whole, of a long one those by its likeliest passage, between them a blend."""
        whole, x = self.features(distances)
        short = np.clip(np.log(LONG / max(1, len(distances))) / np.log(LONG / SHORT), 0.0, 1.0)
        return float(short * whole + (1 - short) * np.dot(self.weights, x))

    def score(self, text: bytes) -> float:
        if not self.toxic:
            return 0.0
        s = self.log_odds(self.distances(text))
        return float(1 / (1 + np.exp(-np.clip(s, -30, 30))))


@lru_cache(maxsize=4)
def _compressors(model: ToxicModel) -> tuple:
    out, s = [], model.settings
    for content in (model.ordinary, model.toxic + model.ordinary):
        size = max(len(content), 8)
        params = zstandard.ZstdCompressionParameters.from_level(
            s.level, source_size=s.window, dict_size=size, min_match=3, write_checksum=0, write_content_size=0,
            write_dict_id=0)
        if len(content) >= 8:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            out.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress)
        else:
            out.append(zstandard.ZstdCompressor(compression_params=params).compress)
    return tuple(out)


def fit(toxic: list[bytes], ordinary: list[bytes], settings: Settings = Settings(), odds: float | None = None) \
        -> ToxicModel:
    """A model from labelled texts; ``odds``: toxic to ordinary documents in all labels (default: as given).

    Without texts of both kinds the model scores everything 0.
    """
    if not toxic or not ordinary:
        return ToxicModel(settings)
    cut = [max(1, int(len(x) * settings.share)) for x in (toxic, ordinary)]
    a, o = _unlike(toxic[:cut[0]]), _unlike(ordinary[:cut[1]])
    na, no = max(1, len(a)), max(1, len(o))
    counts = [np.zeros(1 << 22, np.int64), np.zeros(1 << 22, np.int64)]
    for c, texts in zip(counts, (a, o)):
        for b in texts:
            c[np.unique(_runs(b, RUN, 22))] += 1
    ca, co = counts
    p = (ca + co) / (na + no)
    z = (ca - na * p) / np.sqrt(np.maximum(na * p * (1 - p), 1e-9))
    few = min(6, max(2, na // 8))
    marked = (ca >= few) & (ca / na >= 6 * (co + 0.5) / no) & (z >= (5 if na >= 100 else 3))
    bad = [w for b in a for w in windows(b, 3, 45) if marked[_runs(w, RUN, 22)].any()]
    good = [w for b in o for w in windows(b, 64)]
    good = good[::-(-len(good) // settings.samples)] if good else good
    model = ToxicModel(settings, _dictionary(bad, settings.toxic_bytes, 48, settings.level),
                       _dictionary(good, settings.ordinary_bytes, 32, settings.level))
    if not model.toxic:
        return ToxicModel(settings)
    held = [toxic[cut[0]:] or toxic, ordinary[cut[1]:] or ordinary]
    seen = [[model.distances(b) for b in texts] for texts in held]
    hist = [np.bincount(np.concatenate(d), minlength=2 * REACH + 1) + 0.5 for d in seen]
    ratio = np.log(hist[0] / hist[0].sum()) - np.log(hist[1] / hist[1].sum())
    odds = len(toxic) / len(ordinary) if odds is None else odds
    # a passage is judged as a document of its length; then documents by their passages
    x = np.array([[r.sum() / 10, np.sort(r)[-3:].sum(), np.log1p(len(r)), 1.0] for r in (ratio[d] for d in seen[0] + seen[1])])
    passage = _logistic(x, np.repeat([1.0, 0.0], [len(seen[0]), len(seen[1])]), odds)
    model = ToxicModel(settings, model.toxic, model.ordinary, passage, tuple(ratio))
    return ToxicModel(settings, model.toxic, model.ordinary, passage, tuple(ratio),
                      tuple(_logistic(*_joined(model, seen, settings), odds)))


def _logistic(x: np.ndarray, y: np.ndarray, odds: float) -> np.ndarray:
    """Weights of a lightly damped logistic fit, with ``odds`` of label 1 to label 0."""
    share = np.where(y == 1, odds * (y == 0).sum() / (y == 1).sum(), 1.0)
    w = np.zeros(x.shape[1])
    for _ in range(60):  # Newton steps
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (y - q)) - 0.1 * w
        bend = (x * (share * q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += step / max(1.0, np.abs(step).max())
    return w


def _joined(model: ToxicModel, seen: list[list[np.ndarray]], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of calibrating documents, given by their distances, with ordinary ones around them."""
    g, x, y = np.random.default_rng(5), [], []
    for more in settings.joined:
        for label, docs in ((1.0, seen[0]), (0.0, seen[1])):
            for d in docs[:600]:  # they only tell how a passage's log odds rise with length
                others = [seen[1][i] for i in g.integers(0, len(seen[1]), more)]
                at = int(g.integers(0, more + 1))
                x.append(model.features(np.concatenate([*others[:at], d, *others[at:]]))[1])
                y.append(label)
    return np.array(x), np.array(y)


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> ToxicModel:
    """Fits on a hashed sample, bounded by ``settings``, of the labelled documents.

    The drawn labels, a bounded number, are broadcast to find their texts.
    """
    known = labels.filter("toxic in (0, 1) and doc_id is not null") \
        .select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").withColumn("h", F.xxhash64("doc_id"))
    n = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return ToxicModel(settings)
    scale, most = 1 << 30, {1: settings.toxic, 0: settings.ordinary}
    part = {t: int(min(1.0, 1.1 * most[t] / n[t]) * scale) for t in n}
    drawn = known.filter(F.pmod("h", F.lit(scale)) < F.when(F.col("toxic") == 1, part[1]).otherwise(part[0]))
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text").filter("text <> ''").join(F.broadcast(drawn), "doc_id") \
        .select("toxic", "h", "doc_id", "text").collect()
    rows.sort(key=lambda r: (r.h, r.doc_id, r.text))
    texts = {t: list(dict.fromkeys(r.text.encode() for r in rows if r.toxic == t))[:most[t]] for t in (0, 1)}
    return fit(texts[1], texts[0], settings, n[1] / n[0])


def score(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """doc_id and score (0 to 1, higher: likelier toxic) of every whole text, by nothing but the text.

    Null and empty texts have no window and get the model's score for that.
    Repeated rows are rows of their own; an empty table gives an empty result.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, at in blocks(batches, "text"):
            whole = raw.tobytes()
            found = [model.score(whole[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(found, pa.float64())],
                                             ["doc_id", "score"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(work, "doc_id long, score double")


def toxicity_table(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.3) \
        -> DataFrame:
    """doc_id, held_out, score, predicted: learned from rows whose crc32(doc_id) mod 4 is not 2, applied to all.

    Rows with a null doc_id have no label and count as not held out.
    """
    rest = F.crc32(F.col("doc_id").cast("string")) % 4
    model = train(docs, labels.filter(rest != 2), settings)
    return score(docs, model).select(
        "doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
