"""Ranked lexical search of many items at once, by sharing what their term sets have in common.

Items are taken in blocks of bounded size.  In a block, sets of terms that occur
in two items or more are mined: terms of exactly the same items form an atom,
and node pairs that stand side by side in several items, in the order of the
atoms' frequency, become nodes of their own, round by round.  The nodes form a
graph in which items share their parts.  Documents are turned into postings of
the block's terms once; in blocks of documents every node's partial score of all
of them is computed once, from its two parts, and an item's score is the sum of
the few nodes left of it.  Tasks hand on their best rows of each item only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_folder
from .common import blocks, top_rows

#: Terms of items (an item's terms once each) that are taken together, about; a larger item makes a block of its own.
ITEM_TERMS = 200_000
#: Partial scores (nodes x documents) held at a time.
CELLS = 1 << 21

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and bytes from 128 on, A-Z lower-cased."""
    return text.translate(_FOLD).split()


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term: the distinct terms of every item; rows of one item_id are one item."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, at in blocks(batches, "text"):
            whole, ids = raw.tobytes(), rows.column("item_id").to_pylist()
            for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                found = list(set(terms(whole[a:b])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i]] * len(found), pa.int64()), pa.array(found, pa.binary())], ["item_id", "term"])

    return items.selectExpr("cast(item_id as long) item_id", "text") \
        .mapInArrow(work, "item_id long, term binary").distinct()


@dataclass
class Sharing:
    """``atom``: of every term; ``left``, ``right``: parts of the nodes after the atoms; ``roots``: of every item.

    ``levels`` holds the numbers of the nodes in the order they can be computed, those of a level together.
    """

    atoms: int
    atom: np.ndarray
    left: np.ndarray
    right: np.ndarray
    roots: list[np.ndarray]
    levels: list[np.ndarray] = field(default_factory=list)

    @property
    def nodes(self) -> int:
        return self.atoms + len(self.left)

    def totals(self, atoms: np.ndarray) -> np.ndarray:
        """Values of all items from those of the atoms: (atoms, n) to (items, n)."""
        part = np.empty((self.nodes, atoms.shape[1]), atoms.dtype)
        part[:self.atoms] = atoms
        for level in self.levels:
            part[self.atoms + level] = part[self.left[level]] + part[self.right[level]]
        out = np.zeros((len(self.roots), atoms.shape[1]), atoms.dtype)
        for i, nodes in enumerate(self.roots):
            for node in nodes.tolist():
                out[i] += part[node]
        return out


def share(items: list[np.ndarray], count: int) -> Sharing:
    """Mines the parts that items, given as sorted term numbers below ``count``, have in common."""
    held_by: list[list[int]] = [[] for _ in range(count)]
    for i, mine in enumerate(items):
        for t in mine.tolist():
            held_by[t].append(i)
    known: dict[tuple[int, ...], int] = {}
    atom = np.array([known.setdefault(tuple(h), len(known)) for h in held_by], np.int64)
    atoms = len(known)
    often = np.array([len(h) for h in known], np.int64)
    rank = np.empty(atoms, np.int64)
    rank[np.lexsort((np.arange(atoms), -often))] = np.arange(atoms)
    lists = [np.unique(atom[mine]) for mine in items]
    lists = [a[np.argsort(rank[a])] for a in lists]
    node = np.concatenate(lists) if lists else np.zeros(0, np.int64)
    item = np.repeat(np.arange(len(lists)), [len(a) for a in lists])
    left, right, depth, levels, total = [], [], np.zeros(atoms, np.int64), [], atoms
    while len(node) > 1:
        pair = np.where(item[1:] == item[:-1], node[:-1] * total + node[1:], -1)
        values, which, n = np.unique(pair, return_inverse=True, return_counts=True)
        worth = np.where((n >= 2) & (values >= 0), n, 0)
        order = np.empty(len(values), np.int64)
        order[np.lexsort((values, -worth))] = np.arange(len(values), 0, -1)
        order[worth == 0] = 0
        p = order[which]
        best = (p > 0) & (p > np.append(0, p[:-1])) & (p > np.append(p[1:], 0))
        taken = np.bincount(which[best], minlength=len(values)) >= 2
        best &= taken[which]
        at = np.flatnonzero(best)
        if not len(at):
            break
        number = np.cumsum(taken) - 1
        made = np.flatnonzero(taken)
        a, b = values[made] // total, values[made] % total
        left.append(a)
        right.append(b)
        depth = np.concatenate([depth, np.maximum(depth[a], depth[b]) + 1])
        node[at] = total + number[which[at]]
        keep = np.ones(len(node), bool)
        keep[at + 1] = False
        node, item = node[keep], item[keep]
        total += len(made)
    first = np.searchsorted(item, np.arange(len(items) + 1))
    inner = depth[atoms:]
    levels = [np.flatnonzero(inner == d) for d in range(1, int(inner.max(initial=0)) + 1)]
    empty = [np.zeros(0, np.int64)]
    return Sharing(atoms, atom, np.concatenate(left or empty), np.concatenate(right or empty),
                   [node[x:y] for x, y in zip(first[:-1], first[1:])], levels)


def postings(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n, term, tf of the documents with terms: n counts them all, the arrays hold those of the vocabulary."""
    number = {t: i for i, t in enumerate(vocabulary)}
    width = max(1, len(vocabulary))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, at in blocks(batches, "text"):
            whole = raw.tobytes().translate(_FOLD)
            found, n = [], np.zeros(len(at) - 1, np.int64)
            for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                words = whole[a:b].split()
                n[i] = len(words)
                x = np.fromiter(map(number.get, words, repeat(-1)), np.int64, len(words))
                found.append(x[x >= 0] + i * width)
            seen, tf = np.unique(np.concatenate(found), return_counts=True)
            ends = np.searchsorted(seen, np.arange(len(n) + 1) * width).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(n),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array((seen % width).astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(tf.astype(np.int32)))],
                ["doc_id", "n", "term", "tf"]).filter(pa.array(n > 0))

    return docs.selectExpr("cast(doc_id as long) doc_id", "text") \
        .mapInArrow(work, "doc_id long, n long, term array<int>, tf array<int>")


class Best:
    """The ``top`` best rows of every item so far; ties by ascending doc_id, a null doc_id last."""

    def __init__(self, items: int, top: int) -> None:
        self.top = top
        self.rows = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))] * items
        self.least = np.ones(items, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """``scores`` is (items, documents)."""
        for i in np.flatnonzero((scores >= self.least[:, None]).any(axis=1)).tolist():
            s = scores[i]
            at = np.flatnonzero(s >= self.least[i])
            if len(at) > self.top:
                at = at[s[at] >= np.partition(s[at], -self.top)[-self.top]]
            old = self.rows[i]
            s, d, o = (np.concatenate(x) for x in zip(old, (s[at], ids[at], null[at])))
            order = np.lexsort((d, o, -s))[:self.top]
            self.rows[i] = (s[order], d[order], o[order])
            if len(order) == self.top:
                self.least[i] = s[order[-1]]


def _score(posted: DataFrame, sharing: Sharing, weight: np.ndarray, ids: list[int | None], total: tuple[int, int],
           top: int) -> DataFrame:
    """item_id, doc_id, score: the best rows of every item in every task."""
    docs_n, terms_n = total
    step = max(1, CELLS // max(1, sharing.nodes + len(sharing.roots)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(ids), top)
        for batch in batches:
            n = batch.column("n").to_numpy()
            doc = batch.column("doc_id")
            null = doc.is_null().to_numpy(zero_copy_only=False)
            doc = doc.fill_null(0).to_numpy()
            size = batch.column("term").value_lengths().to_numpy()
            at = np.append(0, np.cumsum(size))
            term = batch.column("term").flatten().to_numpy().astype(np.int64)
            tf = batch.column("tf").flatten().to_numpy().astype(np.int64)
            m = 10 + (90 * n * docs_n) // terms_n
            value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, size)))
            place = np.repeat(np.arange(len(n)), size)
            for lo in range(0, len(n), step):
                hi = min(len(n), lo + step)
                mine = slice(at[lo], at[hi])
                atoms = np.zeros((sharing.atoms, hi - lo), np.int64)
                np.add.at(atoms.reshape(-1), sharing.atom[term[mine]] * (hi - lo) + place[mine] - lo, value[mine])
                best.add(sharing.totals(atoms), doc[lo:hi], null[lo:hi])
        for item, (s, d, o) in zip(ids, best.rows):
            if len(s):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(s), pa.int64()), pa.array(d, mask=o), pa.array(s)],
                    ["item_id", "doc_id", "score"])

    return posted.mapInArrow(work, "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: every item's ``top`` best documents with a score above 0.

    A null text has no term.  Rows of ``items`` with one item_id (null counts as
    one) are one item with the terms of all.  Every row of ``docs`` is a
    document of its own; one with a null doc_id takes part and comes after equal
    scores.  Items or documents without terms give no row.
    """
    spark = docs.sparkSession
    home = scratch_folder(spark, "lexical")
    wanted = f"{home}/items"
    pairs = item_terms(items)
    pairs.write.parquet(f"{home}/pairs")
    pairs = spark.read.parquet(f"{home}/pairs")
    parts = max(1, math.ceil(pairs.count() / ITEM_TERMS))
    pairs.groupBy("item_id").agg(F.collect_set("term").alias("terms")) \
        .withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(parts)).cast("int")) \
        .write.partitionBy("part").parquet(wanted)
    out = spark.createDataFrame([], "item_id long, doc_id long, score long, rank int")
    total = None
    for part in range(parts):  # one bounded block of items at a time
        block = spark.read.schema("item_id long, terms array<binary>, part int").parquet(wanted) \
            .filter(F.col("part") == part).select("item_id", "terms").collect()
        if not block:
            continue
        vocabulary = sorted({bytes(t) for r in block for t in r.terms})
        number = {t: i for i, t in enumerate(vocabulary)}
        at = f"{home}/postings-{part}"
        postings(docs, vocabulary).write.parquet(at)
        posted = spark.read.parquet(at)
        total = total or tuple(posted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first())
        if not total[1]:
            break
        df = np.zeros(len(vocabulary), np.int64)
        for r in posted.select(F.explode("term").alias("t")).groupBy("t").count().collect():  # a row per known term
            df[r.t] = r["count"]
        weight = np.array([math.floor(1000 * math.log((2 * total[0] + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        sharing = share([np.sort([number[bytes(t)] for t in r.terms]) for r in block], len(vocabulary))
        found = _score(posted, sharing, weight, [r.item_id for r in block], total, top)
        top_rows(found, ["item_id"], [F.desc("score"), F.col("doc_id").asc_nulls_last()], top) \
            .write.parquet(f"{home}/ranked-{part}")
        out = out.unionByName(spark.read.parquet(f"{home}/ranked-{part}"))
    return out.select("item_id", "rank", "doc_id", "score")
