"""Language ID: a bidirectional recurrent network labels every byte, documents pool the probabilities."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blocks
from .gru import PAD, BiGru

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """``per_lang``: most training texts of a language; ``chars``: most characters of one, from a hashed place."""

    per_lang: int = 300
    chars: int = 256
    train_window: int = 48
    window: int = 128
    units: int = 10
    steps: int = 240
    batch: int = 96
    lanes: int = 2048


@dataclass
class LangModel:
    names: list[str]
    net: BiGru | None
    settings: Settings

    def predict(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class, pooled probability) of every text that has bytes; every byte is labelled."""
        texts = len(at) - 1
        pooled = np.zeros((texts, len(self.names)))
        if self.net is not None and len(raw):
            size = self.settings.window
            per = -(-np.diff(at) // size)
            text = np.repeat(np.arange(texts), per)
            index = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
            start = at[text] + index * size
            length = np.minimum(size, at[text + 1] - start)
            for lo in range(0, len(text), self.settings.lanes):
                hi = min(len(text), lo + self.settings.lanes)
                where = start[lo:hi][None, :] + np.arange(size)[:, None]
                real = np.arange(size)[:, None] < length[lo:hi][None, :]
                windows = np.where(real, raw[np.minimum(where, len(raw) - 1)], PAD).astype(np.int16)
                logits = self.net.logits(windows)
                logits -= logits.max(axis=1, keepdims=True)
                np.exp(logits, out=logits)
                logits /= logits.sum(axis=1, keepdims=True)
                logits *= real[:, None, :]
                np.add.at(pooled, text[lo:hi], logits.sum(axis=0, dtype=np.float64).T)
        pooled /= np.maximum(np.diff(at), 1)[:, None]
        best = pooled.argmax(axis=1) if len(self.names) else np.zeros(texts, int)
        return best, (pooled[np.arange(texts), best] if len(self.names) else np.zeros(texts))


def remainder(ident: Column, parts: int) -> Column:
    return F.crc32(ident.cast("string")) % parts


def train(labelled: DataFrame, settings: Settings = Settings()) -> LangModel:
    """Fits the network on a bounded, hashed sample of the rows' text and non-null lang.

    At most ``per_lang`` texts of a language reach the driver, each as at most
    ``chars`` characters from a hashed place in it.  Without labelled rows the
    model knows no language and calls everything ``und``.
    """
    rows = labelled.filter("lang is not null and text <> ''").withColumn("h", F.xxhash64("doc_id", "lang"))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    names = sorted(counts)
    if not names:
        return LangModel([], None, settings)
    scale = 1 << 30
    share = F.create_map(*[F.lit(x) for n in names for x in
                           (n, int(min(1.0, 1.3 * settings.per_lang / counts[n] + 20 / counts[n]) * scale))])
    place = F.pmod(F.shiftright("h", 7), F.greatest(F.length("text") - settings.chars // 2, F.lit(1))).cast("int") + 1
    sample = rows.filter(F.pmod("h", F.lit(scale)) < F.element_at(share, F.col("lang"))) \
        .select("lang", "h", F.col("text").substr(place, F.lit(settings.chars)).alias("text")).collect()
    windows, labels = [], []
    size = settings.train_window
    for c, name in enumerate(names):
        mine = sorted((r.h, r.text) for r in sample if r.lang == name)[:settings.per_lang]
        for _, text in mine:
            b = text.encode()
            for lo in range(0, max(1, len(b) - size // 2), size):
                w = np.full(size, PAD, np.int16)
                part = np.frombuffer(b[lo:lo + size], np.uint8)
                w[:len(part)] = part
                windows.append(w)
                labels.append(c)
    net = BiGru(settings.units, len(names))
    net.train(np.array(windows).T, np.array(labels), settings.steps if len(names) > 1 else 0, settings.batch)
    return LangModel(names, net, settings)


def _lettered(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether each text has a letter."""
    lower = raw | 0x20
    ascii_ = np.append(0, np.cumsum((lower >= 97) & (lower <= 122)))
    out = ascii_[at[1:]] > ascii_[at[:-1]]
    for i in np.flatnonzero(~out & (np.diff(at) > 0)):
        out[i] = any(ch.isalpha() for ch in raw[at[i]:at[i + 1]].tobytes().decode())
    return out


def lettered(docs: DataFrame) -> DataFrame:
    """The documents, with all columns, whose text has a letter."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, at in blocks(batches, "text"):
            yield rows.filter(pa.array(_lettered(raw, at)))

    return docs.mapInArrow(work, docs.schema)


def identify(docs: DataFrame, model: LangModel, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Adds two columns to every document, its language and the score, from nothing but its whole text.

    ``und`` with score 0: the text is null or has no letter, or no language was
    learned.  Other columns and repeated rows are kept as they are; an empty
    table gives an empty result.
    """
    schema = T.StructType([*docs.schema, T.StructField(names[0], T.StringType()),
                           T.StructField(names[1], T.DoubleType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, at in blocks(batches, "text"):
            best, score = model.predict(raw, at)
            lettered = _lettered(raw, at)
            lettered &= bool(model.names)
            called = [model.names[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered.tolist())]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(called, pa.string()),
                 pa.array(np.where(lettered, np.clip(score, 0, 1), 0.0))], schema=pa.schema(
                    [*rows.schema, (names[0], pa.string()), (names[1], pa.float64())]))

    return docs.mapInArrow(work, schema)


def language_table(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from documents whose crc32(doc_id) mod 3 is not 1, applied to all.

    Rows with a null doc_id are never learned from and count as not held out.
    """
    rest = remainder(F.col("doc_id"), 3)
    model = train(docs.filter(rest != 1).select("doc_id", "text", "lang"), settings)
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(rest == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
