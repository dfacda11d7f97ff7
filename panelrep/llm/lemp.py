"""Hard negatives by exact inner-product search with coordinate pruning (LEMP).

Rows lie in buckets of one label and length of the vector: similar Euclidean
length, longest first.  A bucket keeps, for each coordinate, its members sorted
by that coordinate of their unit vectors.  An anchor that needs a score of
``least`` meets a bucket's members only at a cosine of ``least / (its length x
the bucket's longest)`` or more: above 1 the bucket is skipped; otherwise that
angle gives a feasible range for every coordinate, the members within the
ranges of the anchor's focus coordinates are intersected, and only they are
verified, exactly in integers.  Where the ranges hold most of a bucket, all its
members are verified with one matrix product.

Anchors are taken in blocks of bounded size; each block makes one pass over the
buckets for its positives and one for its negatives.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_folder
from .common import top_rows

#: Components of a bucket's vectors, about, and most members of one.
BUCKET_CELLS, BUCKET_ROWS = 1 << 17, 2048
#: Components of the vectors of a block of anchors, about.
ANCHOR_CELLS = 1 << 20
#: Focus coordinates of an anchor, and the expected share of a bucket up to which candidates are intersected.
FOCUS, SPARSE = 5, 0.2
#: Anchors that meet a bucket at a time.
STEP = 512
#: Anchors of a block that give the others their first bounds.
SEEDS = 2048
LAST = 2 ** 63 - 1


def _prepared(vectors: DataFrame) -> DataFrame:
    """vec_id, label, dims, norm, value (whole numbers as bytes) of the rows that take part."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("embedding")
            dims = pc.fill_null(pc.list_value_length(v), 0).to_numpy().astype(np.int64)
            at = np.append(0, np.cumsum(dims))
            flat = v.flatten().cast(pa.float64())
            x = flat.to_numpy(zero_copy_only=False)
            with np.errstate(all="ignore"):
                good = np.isfinite(x) & ~flat.is_null().to_numpy(zero_copy_only=False)
                x = np.floor(256 * np.where(good, x, 0.0)) + 0.0
            bad = np.append(0, np.cumsum(~(good & np.isfinite(x))))
            able = (bad[at[1:]] == bad[at[:-1]]) & v.is_valid().to_numpy(zero_copy_only=False) & \
                batch.column("label").is_valid().to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(able)
            value, norm = [], np.zeros(len(rows))
            for k, (a, b) in enumerate(zip(at[rows].tolist(), at[rows + 1].tolist())):
                y = x[a:b]
                norm[k] = math.sqrt(y @ y)
                value.append(y.tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(rows)) for c in ("vec_id", "label")), pa.array(dims[rows]),
                 pa.array(norm), pa.array(value, pa.binary())], ["vec_id", "label", "dims", "norm", "value"])

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), "embedding") \
        .mapInArrow(work, "vec_id long, label long, dims long, norm double, value binary")


@dataclass
class Bucket:
    """Rows of one label and dimension: numbers, ids, whole vectors, and the unit vectors' sorted coordinate lists."""

    label: int
    row: np.ndarray
    vec: np.ndarray
    null: np.ndarray
    value: np.ndarray
    unit: np.ndarray
    order: np.ndarray
    longest: float
    places: np.ndarray | None = None

    @classmethod
    def of(cls, label: int, row: np.ndarray, vec: np.ndarray, null: np.ndarray, value: np.ndarray,
           order: np.ndarray | None = None) -> Bucket:
        size = np.array([math.sqrt(v @ v) for v in value])
        unit = value / np.where(size > 0, size, 1.0)[:, None]
        return cls(label, row, vec, null, value, unit, np.argsort(unit, axis=0) if order is None else order,
                   float(size.max(initial=0.0)))

    def rank(self) -> np.ndarray:
        """The members' places in every coordinate's list: (dims, members)."""
        if self.places is None:
            self.places = np.empty(self.order.T.shape, np.int32)
            np.put_along_axis(self.places, self.order.T.astype(np.int64), np.arange(len(self.row))[None, :], axis=1)
        return self.places


INDEX = "label long, dims long, row binary, vec binary, isnull binary, value binary, lists binary"


def _bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets of consecutive rows that come sorted by dimension, label and length."""
    kind, held = None, []

    def made() -> Iterator[pa.RecordBatch]:
        if held:
            label, dims = kind
            value = np.array([h[3] for h in held], np.float64).reshape(len(held), dims)
            b = Bucket.of(label, np.array([h[0] for h in held], np.int64),
                          np.array([h[1] or 0 for h in held], np.int64), np.array([h[1] is None for h in held], bool), value)
            yield pa.RecordBatch.from_arrays(
                [pa.array([label]), pa.array([dims]), *(pa.array([x.tobytes()], pa.binary()) for x in
                 (b.row, b.vec, b.null, b.value, b.order.astype(np.uint16)))],
                ["label", "dims", "row", "vec", "isnull", "value", "lists"])
            held.clear()

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("label", "dims", "row", "vec_id", "value")]
        for label, dims, row, vec, value in zip(*cols):
            if kind != (label, dims) or len(held) >= min(BUCKET_ROWS, max(16, BUCKET_CELLS // max(1, dims))):
                yield from made()
                kind = (label, dims)
            held.append((row, vec, None, np.frombuffer(value, np.float64)))
    yield from made()


def build_index(rows: DataFrame) -> DataFrame:
    """The buckets of prepared rows with a number ``row`` each; a label of any size is dealt over tasks by length."""
    keys = ["dims", "label", F.desc("norm"), "row"]
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys) \
        .select("label", "dims", "row", "vec_id", "value").mapInArrow(_bucketed, INDEX)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[Bucket]:
    for batch in batches:
        for k in range(batch.num_rows):
            label, dims = batch.column("label")[k].as_py(), batch.column("dims")[k].as_py()
            row, vec, null, value, lists = (np.frombuffer(batch.column(c)[k].as_py(), t) for c, t in (
                ("row", np.int64), ("vec", np.int64), ("isnull", bool), ("value", np.float64), ("lists", np.uint16)))
            yield Bucket.of(label, row, vec, null, value.reshape(len(row), dims), lists.reshape(len(row), dims))


def products(a: np.ndarray, b: np.ndarray, bound: float) -> np.ndarray:
    """Exact inner products of whole-number rows of a and b; ``bound``: of the products of their lengths.

    Beyond what doubles hold exactly they are Python's integers, and those beyond 64 bits count as the last that fits.
    """
    if bound * 100 < 2 ** 53:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(e) for e in row] for row in x], object).reshape(x.shape) for x in (a, b)]
    return np.clip(whole[0] @ whole[1].T, -LAST, LAST)


def pair_products(a: np.ndarray, b: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """As ``products``, of row i of a with row i of b."""
    if not len(a) or bound.max() * 100 < 2 ** 53:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    return np.array([products(a[k:k + 1], b[k:k + 1], math.inf)[0, 0] for k in range(len(a))], object)


def below(x: float | int) -> float:
    """A double that is not above x."""
    return float(x) if abs(x) < 2 ** 53 else float(np.nextafter(float(x), -np.inf))


def above(x: float | int) -> float:
    return -below(-x)


def verified(bucket: Bucket, anchors: np.ndarray, length: np.ndarray, least: np.ndarray, most: np.ndarray) \
        -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor numbers, members, exact scores) of pairs, by anchor: all that score from ``least`` to ``most``.

    Both are bounds for each anchor, infinite where there is none yet.
    """
    bound = length * bucket.longest
    alive = np.flatnonzero(least <= bound * (1 + 1e-9) + 1e-9)  # the bucket is long enough
    n = len(bucket.row)
    if not len(alive) or not n:
        return
    with np.errstate(all="ignore"):
        cosine = np.where(bound[alive] > 0, least[alive] / bound[alive], -1.0)
    angle = np.arccos(np.clip(cosine, -1.0, 1.0))
    unit = anchors[alive] / np.where(length[alive] > 0, length[alive], 1.0)[:, None]
    focus = np.argsort(-np.abs(unit), axis=1)[:, :FOCUS]
    own = np.arccos(np.clip(np.take_along_axis(unit, focus, axis=1), -1.0, 1.0))
    low = np.cos(np.minimum(np.pi, own + angle[:, None])) - 1e-7
    high = np.cos(np.maximum(0.0, own - angle[:, None])) + 1e-7
    first, last = np.zeros(focus.shape, np.int64), np.full(focus.shape, n)
    for f in np.unique(focus):
        at = focus == f
        coordinate = bucket.unit[bucket.order[:, f], f]
        first[at] = np.searchsorted(coordinate, low[at], "left")
        last[at] = np.searchsorted(coordinate, high[at], "right")
    few = ((last - first) / n).prod(axis=1) <= SPARSE
    for lo in range(0, len(alive), STEP):
        part = slice(lo, lo + STEP)
        some = np.flatnonzero(few[part]) + lo
        if len(some):
            rank = bucket.rank()
            mask = np.ones((len(some), n), bool)
            for k in range(focus.shape[1]):
                at = rank[focus[some, k]]
                mask &= (at >= first[some, k, None]) & (at < last[some, k, None])
            i, members = np.nonzero(mask)
            who = alive[some[i]]
            for x in range(0, len(who), n):
                y = slice(x, x + n)
                yield _within(who[y], members[y], pair_products(anchors[who[y]], bucket.value[members[y]], bound[who[y]]),
                              least, most)
        many = alive[np.flatnonzero(~few[part]) + lo]
        if len(many):
            s = products(anchors[many], bucket.value, float(bound[many].max()))
            i, members = np.nonzero((s >= least[many][:, None]) & (s <= most[many][:, None]))
            yield many[i], members, s[i, members]


def _within(who: np.ndarray, members: np.ndarray, scores: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple:
    fit = np.flatnonzero((scores >= least[who]) & (scores <= most[who]))
    return who[fit], members[fit], scores[fit]


def by_anchor(found: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor number, members, scores) of pairs that come by anchor."""
    for who, members, scores in found:
        start = np.flatnonzero(np.append(True, who[1:] != who[:-1])) if len(who) else ()
        for x, y in zip(start, [*start[1:], len(who)]):
            yield int(who[x]), members[x:y], scores[x:y]


class Kept:
    """The first ``top`` rows found for each of some searches: highest score, then smallest vec_id, null last, then row."""

    def __init__(self, searches: int, top: int, least: np.ndarray) -> None:
        self.top, self.least = top, least.astype(np.float64)
        self.found: list[list[np.ndarray]] = [[] for _ in range(searches)]

    def add(self, i: int, scores: np.ndarray, bucket: Bucket, members: np.ndarray) -> None:
        if len(members) > self.top:
            at = scores >= np.partition(scores, -self.top)[-self.top]
            scores, members = scores[at], members[at]
        new = [scores, bucket.vec[members], bucket.null[members], bucket.row[members]]
        s, v, o, r = (np.concatenate(x) for x in zip(self.found[i], new)) if self.found[i] else new
        order = np.lexsort((r, v, o, -s))[:self.top]
        self.found[i] = [s[order], v[order], o[order], r[order]]
        if len(order) == self.top:
            self.least[i] = max(self.least[i], below(s[order[-1]]))


@dataclass
class Anchors:
    """A block of anchors of one dimension; ``scores``: of their positives, NaN where one has fewer."""

    row: np.ndarray
    vec: np.ndarray
    label: np.ndarray
    value: np.ndarray
    length: np.ndarray


def _positives(anchors: Anchors, buckets: Iterator[Bucket], top: int, least: np.ndarray) -> Kept:
    kept = Kept(len(anchors.row), top, least)
    for b in buckets:
        same = np.flatnonzero(anchors.label == b.label) if b.value.shape[1] == anchors.value.shape[1] else ()
        if not len(same):
            continue
        pairs = verified(b, anchors.value[same], anchors.length[same], kept.least[same], np.full(len(same), np.inf))
        for i, members, scores in by_anchor(pairs):
            others = b.row[members] != anchors.row[same[i]]
            if others.any():
                kept.add(int(same[i]), scores[others], b, members[others])
    return kept


def _negatives(anchors: Anchors, scores: np.ndarray, have: np.ndarray, buckets: Iterator[Bucket], top: int,
               least: np.ndarray) -> Kept:
    """``scores`` (anchors, positives) and which of them there are; search i * positives + j is of anchor i's j-th."""
    n, per = scores.shape
    kept = Kept(n * per, top, least)
    widest = np.where(have, scores, -1).max(axis=1, initial=-1)
    most = np.array([above(0.95 * w) + 1 for w in widest.tolist()])
    for b in buckets:
        other = np.flatnonzero((anchors.label != b.label) & (widest >= 0)) \
            if b.value.shape[1] == anchors.value.shape[1] else ()
        if not len(other):
            continue
        need = kept.least.reshape(n, per)[other].min(axis=1)
        for k, members, s in by_anchor(verified(b, anchors.value[other], anchors.length[other], need, most[other])):
            i = int(other[k])
            for j in range(per):
                if have[i, j]:
                    ps = int(scores[i, j])
                    fit = (100 * s <= 95 * ps) & (100 * s >= 50 * ps) & (s >= kept.least[i * per + j])
                    if fit.any():
                        kept.add(i * per + j, s[fit], b, members[fit])
    return kept


def _seeds(anchors: Anchors) -> list[Bucket]:
    """Some anchors of the block as buckets: rows of the table, so what they score bounds a search from below."""
    at = np.arange(min(SEEDS, len(anchors.row)))
    return [Bucket.of(int(c), anchors.row[m], anchors.vec[m], np.zeros(len(m), bool), anchors.value[m])
            for c in np.unique(anchors.label[at]) for m in [at[anchors.label[at] == c]]]


def mine_negatives(vectors: DataFrame, positives: int = 5, negatives: int = 3, every: int = 50) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null label, a null vector or a null or non-finite component take
    no part; vectors are compared with those of their own dimension.  A row with
    a null vec_id can be found, after equal scores, and is no anchor.  Each row
    is one of its own, also where a vec_id repeats: other rows with an anchor's
    vec_id are found like any, and an anchor's repeats each have their results.
    Without rows, or without anchors, the result is empty.
    """
    spark = vectors.sparkSession
    home = scratch_folder(spark, "lemp")
    _prepared(vectors).withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{home}/rows")
    rows = spark.read.parquet(f"{home}/rows")
    build_index(rows).write.parquet(f"{home}/index")
    index = spark.read.schema(INDEX).parquet(f"{home}/index")
    asked = rows.filter(F.col("vec_id") % every == 0)
    sizes = asked.groupBy("dims").count().collect()  # a row per length of vector
    parts = {r.dims: max(1, math.ceil(r["count"] * max(1, r.dims) / ANCHOR_CELLS)) for r in sizes}
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                    "positive_score long, negative_score long")
    found = "search long, score long, other long"
    order = [F.desc("score"), F.col("other").asc_nulls_last(), "row"]

    def result(kept: Kept) -> Iterator[pa.RecordBatch]:
        for i, got in enumerate(kept.found):
            if got:
                s, v, o, r = got
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * len(s), pa.int64()), pa.array([int(e) for e in s], pa.int64()),
                     pa.array(v, mask=o), pa.array(r)], ["search", "score", "other", "row"])

    for dims, count in sorted(parts.items()):
        for part in range(count):  # one bounded block of anchors at a time
            block = asked.filter((F.col("dims") == dims) & (F.pmod(F.xxhash64("row"), F.lit(count)) == part)) \
                .select("row", "vec_id", "label", "value").collect()
            if not block:
                continue
            block.sort(key=lambda r: r.row)
            value = np.frombuffer(b"".join(bytes(r.value) for r in block), np.float64).reshape(len(block), dims)
            anchors = Anchors(*(np.array([r[k] for r in block], np.int64) for k in range(3)), value,
                              np.array([math.sqrt(v @ v) for v in value]))
            n = len(block)
            mine = index.filter(F.col("dims") == dims)
            bound = _positives(anchors, iter(_seeds(anchors)), positives, np.full(n, -np.inf)).least

            def near(batches, anchors=anchors, bound=bound):
                return result(_positives(anchors, _buckets(batches), positives, bound))

            best = top_rows(mine.mapInArrow(near, found + ", row long"), ["search"], order, positives).collect()
            scores, have = np.zeros((n, positives), np.int64), np.zeros((n, positives), bool)
            name: list[int | None] = [None] * (n * positives)
            for r in best:
                scores[r.search, r["rank"] - 1], have[r.search, r["rank"] - 1] = r.score, True
                name[r.search * positives + r["rank"] - 1] = r.other
            half = np.array([below(x / 2) if ok and x >= 0 else np.inf
                             for x, ok in zip(scores.reshape(-1).tolist(), have.reshape(-1).tolist())])
            bound = _negatives(anchors, scores, have, iter(_seeds(anchors)), negatives, half).least

            def hard(batches, anchors=anchors, scores=scores, have=have, bound=bound):
                return result(_negatives(anchors, scores, have, _buckets(batches), negatives, bound))

            top_rows(mine.mapInArrow(hard, found + ", row long"), ["search"], order, negatives) \
                .write.parquet(f"{home}/hard-{dims}-{part}")
            asks = spark.createDataFrame(
                [(k, int(anchors.vec[k // positives]), name[k], int(scores[k // positives, k % positives]))
                 for k in np.flatnonzero(have.reshape(-1)).tolist()],
                "search long, anchor_id long, positive_id long, positive_score long")
            asks.join(spark.read.parquet(f"{home}/hard-{dims}-{part}"), "search").select(
                "anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score",
                F.col("score").alias("negative_score")).write.parquet(f"{home}/mined-{dims}-{part}")
            out = out.unionByName(spark.read.parquet(f"{home}/mined-{dims}-{part}"))
    return out
