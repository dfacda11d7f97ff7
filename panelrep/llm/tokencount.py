"""Token counts under a unigram vocabulary: Aho-Corasick matches, count-only Viterbi.

The vocabulary is the pieces of a public tokenizer file; their log
probabilities follow from their rank by a Zipf rule (nothing is trained) and
are whole 64ths, so that sums are exact.  The segmentation is the unigram
tokenizer's: the best sum wins, ties go to the piece that begins first, a
character without a piece of its own costs the least score less ten and counts
as its UTF-8 bytes.  Only the best score and its piece count are carried.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks
from .wordcache import WordCache

SPACE = "▁"
UNIT = 64  # scores are multiples of 1 / 64
UNKNOWN_PENALTY = 10 * UNIT


def vocabulary(path: str) -> dict[str, int]:
    """Plain pieces of the file by rank, each with its score: -64 ln(rank + 2), rounded."""
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(lib.get_piece_size())
           if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
    ids.sort(key=lambda i: (-lib.get_score(i), i))
    return {lib.id_to_piece(i): -round(UNIT * math.log(r + 2)) for r, i in enumerate(ids)}


class Unigram:
    def __init__(self, scores: dict[str, int]) -> None:
        self.find = ahocorasick.Automaton()
        for piece, score in scores.items():
            self.find.add_word(piece, (len(piece), score))
        self.find.make_automaton()
        self.single = {p for p in scores if len(p) == 1}
        self.unknown = min(scores.values()) - UNKNOWN_PENALTY
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in scores)
        self.cache = WordCache(lambda words: [self.count(w) for w in words])

    def count(self, word: str) -> int:
        """Pieces of the best segmentation of a text in which spaces are already marked."""
        size = len(word)
        if not self.single.issuperset(word):
            return self._count_with_unknown(word)
        best, pieces, met = [0] * (size + 1), [0] * (size + 1), -1
        for end, (length, score) in self.find.iter(word):  # by end, the longest match of an end first
            start = end + 1 - length
            value = best[start] + score
            if end != met:
                met = end
            elif value <= best[end + 1]:
                continue
            best[end + 1], pieces[end + 1] = value, pieces[start] + 1
        return pieces[size]

    def _count_with_unknown(self, word: str) -> int:
        ends: dict[int, list[tuple[int, int]]] = {}
        for end, match in self.find.iter(word):
            ends.setdefault(end, []).append(match)
        best, pieces = [0], [0]
        for end, c in enumerate(word):
            options = [(best[end + 1 - n] + s, pieces[end + 1 - n] + 1) for n, s in ends.get(end, ())]
            if c not in self.single:
                options.append((best[end] + self.unknown, pieces[end] + len(c.encode("utf-8", "surrogatepass"))))
            top = max(o[0] for o in options)
            score, n = next(o for o in options if o[0] == top)
            best.append(score)
            pieces.append(n)
        return pieces[-1]

    def words(self, text: str) -> list[str]:
        """The text with a space before it, spaces marked, cut before each run of marks."""
        if not text:
            return []
        if not self.by_word:
            return [SPACE + text.replace(" ", SPACE)]
        if "  " in text or SPACE in text or text[0] == " ":
            return re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE))
        return (SPACE + text.replace(" ", " " + SPACE)).split(" ")

    def counts(self, texts: list[str | None]) -> list[int]:
        split = [self.words(t or "") for t in texts]
        known = self.cache.add({w for s in split for w in s})
        return [sum(map(known.__getitem__, s)) for s in split]


@lru_cache(maxsize=2)
def model(path: str) -> Unigram:
    return Unigram(vocabulary(path))


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every whole text (null and empty: 0).

    Repeated rows are rows of their own; an empty table gives an empty result;
    other columns are not read.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for rows, _, at in blocks(batches, "text", 4 << 20):
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(np.diff(at)),
                 pa.array(m.counts(rows.column("text").to_pylist()), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text") \
        .mapInArrow(work, "doc_id long, n_bytes long, n_tokens long")


def totals(counted: DataFrame, by: list[str]) -> DataFrame:
    """Documents, bytes and tokens by the columns ``by``; partial sums come before the shuffle."""
    return counted.groupBy(*by).agg(F.count("*").alias("n_docs"), F.sum("n_bytes").alias("n_bytes"),
                                    F.sum("n_tokens").alias("n_tokens"))
