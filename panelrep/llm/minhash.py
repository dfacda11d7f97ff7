"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two permutations of a fixed universe make a whole signature: the first
scatters a shingle, coordinate k is the least value of the second one shifted
by k places, so a shingle's values for all coordinates lie side by side.

Documents with equal sets form one class, and only class representatives are
compared.  A band bucket is never expanded into pairs: its members are first
verified against the bucket's smallest id.  Those left outside the bucket's
largest component are compared with all of it in blocks, and then with each
other, so that no pair that shares a band and is similar enough stays in two
components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, components, cut, meet
from .shingles import common, mix, shingle_sets

UNIVERSE_BITS = 21
BANDS, ROWS = 40, 8
#: Members of a block, and of a bucket up to which its left-over members are compared pair by pair.
BLOCK, PAIRWISE = 512, 16
#: Ids of the documents in shared buckets are broadcast up to this size and joined by a shuffle beyond it.
BROADCAST_BYTES = 16 << 20


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and all circular shifts of the second one as overlapping rows."""
    g, size, k = np.random.default_rng(7), 1 << UNIVERSE_BITS, BANDS * ROWS
    scatter = g.permutation(size).astype(np.uint32)
    ring = g.permutation(size).astype(np.uint32)
    return scatter, np.lib.stride_tricks.sliding_window_view(np.concatenate([ring, ring[:k - 1]]), k)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The signature of a non-empty set."""
    scatter, shifts = _permutations()
    place = scatter[shingles & np.uint64((1 << UNIVERSE_BITS) - 1)]
    out = shifts[place[:1024]].min(axis=0)
    for lo in range(1024, len(place), 1024):
        np.minimum(out, shifts[place[lo:lo + 1024]].min(axis=0), out=out)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, of signatures (document, coordinate)."""
    part = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    key = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sig), 1))
    for r in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + part[:, :, r])
    return key.view(np.int64)


def sketch(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, a 128-bit fingerprint of the set, and the band keys, of every whole text."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, at in blocks(batches, "text"):
            sets = shingle_sets(raw, at, width)
            full = [i for i, s in enumerate(sets) if len(s)]
            keys = band_keys(np.array([signature(sets[i]) for i in full])) if full else np.zeros((0, BANDS), np.int64)
            size = np.zeros(len(sets), np.int64)
            size[full] = BANDS
            prints = [np.array([mix(s + np.uint64(c)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                      for c in (1, 2)]
            ends = np.append(0, np.cumsum(size)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), *map(pa.array, prints),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel()))],
                ["doc_id", "n", "f1", "f2", "bands"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text") \
        .mapInArrow(work, "doc_id long, n long, f1 long, f2 long, bands array<long>")


def set_table(docs: DataFrame, width: int) -> DataFrame:
    """id and the set's sorted hashes as bytes."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, at in blocks(batches, "text"):
            sets = [s.tobytes() for s in shingle_sets(raw, at, width)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(sets, pa.binary())], ["id", "value"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(work, "id long, value binary")


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= percent * union.

    Members ``a`` travel to a copy of the set of ``b``, see :func:`meet`.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, against = None, []
        for batch in batches:
            a, b = [], []
            cols = [batch.column(c).to_pylist() for c in ("b", "copy", "role", "a")]
            for leader, copy, role, member, raw in zip(*cols, batch.column("value")):
                own = np.frombuffer(raw.as_buffer(), np.uint64)
                if (leader, copy) != here:
                    here, against = (leader, copy), []
                if not role:
                    against.append(own.copy())
                    continue
                for other in against:
                    both = common(own, other)
                    if 100 * both >= percent * (len(own) + len(other) - both):
                        a.append(member)
                        b.append(leader)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return meet(pairs, sets).mapInArrow(work, "a long, b long")


class RareShingles:
    """Sets by their rarest members: which of them may have 100 * intersection >= percent * union with another.

    In an order of all shingles, a set of n has its first n - ceil(percent * n / 100) + 1 as prefix.  Two sets that
    are similar enough share one of these, as neither can lack more than the rest.
    """

    def __init__(self, sets: list[np.ndarray], percent: int) -> None:
        self.percent, self.size = percent, np.array([len(x) for x in sets], np.int64)
        self.known, self.often = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_counts=True)
        first = [self.prefix(x) for x in sets]
        flat = np.concatenate([np.zeros(0, np.uint64), *first])
        order = np.argsort(flat, kind="stable")
        self.values = flat[order]
        self.owners = np.repeat(np.arange(len(sets)), [len(x) for x in first])[order]

    def prefix(self, x: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.known, x), len(self.known) - 1)
        often = np.where(self.known[at] == x, self.often[at], 0) if len(self.known) else np.zeros(len(x), np.int64)
        return x[np.lexsort((x, often))[:len(x) - -(-self.percent * len(x) // 100) + 1]]

    def candidates(self, x: np.ndarray) -> np.ndarray:
        mine = self.prefix(x)
        lo, hi = np.searchsorted(self.values, mine, "left"), np.searchsorted(self.values, mine, "right")
        count = hi - lo
        at = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        found = np.unique(self.owners[at])
        least, most = np.minimum(self.size[found], len(x)), np.maximum(self.size[found], len(x))
        return found[100 * least >= self.percent * most]


def verify_blocks(sides: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the sides 1 and 0 of each group g that join all that the groups' similar pairs join.

    ``sides`` has (g, a, role).  Side 0 is dealt into blocks of about ``BLOCK``
    members, side 1 is compared with every block, so what is shuffled is side 1
    once per block, never a row per pair.  In a block only members that share
    one of their rarest shingles are compared: of two similar sets, each in the
    order of the shingles' frequency in the block, the first ones overlap.
    """
    blocks_ = sides.filter("role = 0").groupBy("g").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = sides.filter("role = 0").join(blocks_, "g") \
        .select("g", F.pmod(F.xxhash64("a"), "blocks").cast("int").alias("block"), "role", "a")
    other = sides.filter("role = 1").join(blocks_, "g") \
        .select("g", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "role", "a")
    rows = own.unionByName(other).join(sets, F.col("a") == F.col("id")).select("g", "block", "role", "a", "value")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, index, top = None, [], None, {}

        def root(x: int) -> int:
            while top.setdefault(x, x) != x:
                top[x] = x = top[top[x]]
            return x

        for batch in batches:
            a, b = [], []
            cols = [batch.column(c).to_pylist() for c in ("g", "block", "role", "a")]
            for g, block, role, member, raw in zip(*cols, batch.column("value")):
                mine = np.frombuffer(raw.as_buffer(), np.uint64)
                if (g, block) != here:
                    here, held, index, top = (g, block), [], None, {}
                if not role:
                    held.append((member, mine.copy()))
                    continue
                if index is None:
                    index = RareShingles([x for _, x in held], percent)
                for i in index.candidates(mine).tolist():
                    other_, own = held[i]
                    if root(member) != root(other_):
                        both = common(mine, own)
                        if 100 * both >= percent * (len(mine) + len(own) - both):
                            top[root(member)] = root(other_)
                            a.append(max(member, other_))
                            b.append(min(member, other_))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.repartition("g", "block").sortWithinPartitions("g", "block", "role").mapInArrow(work, "a long, b long")


def _split_seats(shared: DataFrame, parts: DataFrame) -> DataFrame:
    """key, rep, n, part: the members, by component, of buckets that hold several components."""
    seats = shared.select("key", "rep", "n").join(parts, F.col("rep") == F.col("id"), "left") \
        .select("key", "rep", "n", F.coalesce("component", "rep").alias("part"))
    split = seats.groupBy("key").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q").select("key")
    return seats.join(split, "key", "left_semi")


def near_duplicates(docs: DataFrame, width: int = 2, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Texts are compared whole, A-Z as a-z.  A document without words, or with a
    null text, links with nothing.  Rows that share a doc_id are one document
    with several texts; a row with a null doc_id links with nothing, has a null
    component and is kept.  An empty table gives an empty result.
    """
    slim = cut(sketch(docs, width))
    able = slim.filter("n > 0 and doc_id is not null")
    classes = able.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("size"),
                                                F.min_by("bands", "doc_id").alias("bands"))
    classes = cut(classes)
    # buckets of one class are of no use; the others' rows are all that is kept
    rows = classes.select("rep", "n", F.explode("bands").alias("key"))
    buckets = rows.groupBy("key").agg(F.min("rep").alias("leader"), F.count("*").alias("size"),
                                      F.min_by("n", "rep").alias("leader_n")).filter("size > 1")
    shared = cut(rows.join(buckets.select("key", "leader", "leader_n"), "key"))
    alike = f"100 * least(x, y) >= {percent} * greatest(x, y)"  # else the sizes rule a link out
    first = shared.filter("rep <> leader").select(F.col("rep").alias("a"), F.col("leader").alias("b"),
                                                  F.col("n").alias("x"), F.col("leader_n").alias("y")) \
        .filter(alike).select("a", "b").distinct()
    tried = cut(first)
    nodes = cut(shared.select(F.col("rep").alias("doc_id")).distinct())
    small = nodes.count() * 8 <= BROADCAST_BYTES
    texts = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    sets = cut(set_table(texts.join(F.broadcast(nodes) if small else nodes, "doc_id", "left_semi"), width))
    links = cut(verify(tried, sets, percent))
    parts = components(links)
    # members outside a bucket's largest component: first against all of that component, block by block
    seats = cut(_split_seats(shared, parts))
    size = seats.groupBy("key", "part").agg(F.count("*").alias("m"))
    main = size.groupBy("key").agg(F.max(F.struct("m", "part")).alias("s")).select("key", F.col("s.part").alias("g"))
    seated = cut(seats.join(main, "key"))
    rest = seated.filter("part <> g")
    sides = seated.filter("part = g").select("g", F.col("rep").alias("a"), F.lit(0).alias("role")).distinct() \
        .unionByName(rest.select("g", F.col("rep").alias("a"), F.lit(1).alias("role")).distinct())
    more = verify_blocks(sides, sets, percent)
    # then among themselves: pair by pair in small buckets, block by block in others
    again = rest.select("key", "rep", "n", "part")
    count = again.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
    again = cut(again.join(count, "key"))
    few, many = again.filter(f"m <= {PAIRWISE}"), again.filter(f"m > {PAIRWISE}")
    left = few.select("key", F.col("rep").alias("a"), F.col("n").alias("x"), F.col("part").alias("p"))
    right = few.select("key", F.col("rep").alias("b"), F.col("n").alias("y"), F.col("part").alias("q"))
    pairs = left.join(right, "key").filter("a > b and p <> q").filter(alike).select("a", "b").distinct()
    sides = many.select(F.col("key").alias("g"), F.col("rep").alias("a"), F.explode(F.array(F.lit(0), F.lit(1))).alias("role"))
    more = cut(more.unionByName(verify(cut(pairs.join(tried, ["a", "b"], "left_anti")), sets, percent))
               .unionByName(verify_blocks(sides, sets, percent)))
    links = links.unionByName(more)
    parts = components(links)
    # rows of a doc_id in several classes tie these together
    member = slim.join(classes.select("f1", "f2", "n", "rep"), ["f1", "f2", "n"], "left").select(
        "doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep"))
    several = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).filter("a <> z") \
        .select("doc_id", "a")
    several = cut(member.join(several, "doc_id").select("a", F.col("rep").alias("b")))
    if not several.isEmpty():
        parts = components(links.unionByName(several))
    found = member.join(parts, F.col("rep") == F.col("id"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those that repeat another: one of each group stays, with all its columns.

    Of rows that share a doc_id one stays; rows with a null doc_id all stay.
    """
    found = cut(near_duplicates(docs, width, percent))
    out = docs.join(found.filter("not kept").select("doc_id").distinct(), "doc_id", "left_anti")
    again = found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if not again.isEmpty():
        one = out.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        out = out.join(again, "doc_id", "left_anti").unionByName(one)
    return out.select(docs.columns)
