"""Near-duplicate embeddings: E8 lattice hashing with neighbouring cells, exact cosine, hot groups as balls.

A table projects unit vectors at random onto ``BLOCKS`` spaces of eight
dimensions and decodes each to the nearest point of the lattice E8; the points
are the cell.  A vector lies in its own cell and probes ``PROBES`` neighbouring
ones; a pair is a candidate where one's cell is among the other's.

A cell that holds many vectors is not expanded into pairs: vectors within half
the link angle of the cell's pivot are all linked with each other, which the
angles' triangle inequality proves.  They form a ball, their links are counted,
and only pairs of different balls are verified one by one.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, meet
from .shingles import mix

TABLES = 14
BLOCKS = 3
PROBES = 8
CELL = 0.30  # edge of the lattice, in units of the unit vectors, for 64 dimensions and a link cosine of 0.9
#: A cell with so many vectors is searched for balls.
CROWD = 24


def _coset(z: np.ndarray, shift: float, flips: int) -> tuple[np.ndarray, np.ndarray]:
    """Near points of D8 + shift for rows of z: (points doubled as int8 (n, c, 8), squared distances (n, c))."""
    y = z - shift
    r = np.rint(y)
    d = y - r
    base = (d * d).sum(axis=1)
    step = np.where(d >= 0, 1.0, -1.0)
    cost = 1 - 2 * np.abs(d)  # added to the distance when the coordinate goes the other way
    order = np.argsort(cost, axis=1)[:, :flips]
    odd = (r.sum(axis=1).astype(np.int64) & 1).astype(bool)
    c = np.take_along_axis(cost, order, axis=1)
    pairs = [(a, b) for a in range(flips) for b in range(a + 1, flips)][:flips - 1]
    dist = np.empty((len(z), flips))
    pts = np.repeat(r[:, None, :], flips, axis=1)
    rows = np.arange(len(z))
    for k in range(flips):
        first = order[:, k]
        even = base if k == 0 else base + c[:, pairs[k - 1][0]] + c[:, pairs[k - 1][1]]
        dist[:, k] = np.where(odd, base + c[:, k], even)
        hit = rows[odd]
        pts[hit, k, first[odd]] += step[hit, first[odd]]
        if k:
            hit = rows[~odd]
            for e in pairs[k - 1]:
                i = order[~odd, e]
                pts[hit, k, i] += step[hit, i]
    return np.rint(2 * (pts + shift)).astype(np.int8), dist


def near_points(z: np.ndarray, count: int, flips: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` nearest E8 points found for rows of z (n, 8), nearest first: (doubled points, squared distances)."""
    a, da = _coset(z, 0.0, flips)
    b, db = _coset(z, 0.5, flips)
    pts, dist = np.concatenate([a, b], axis=1), np.concatenate([da, db], axis=1)
    order = np.argsort(dist, axis=1, kind="stable")[:, :count]
    return np.take_along_axis(pts, order[:, :, None], axis=1), np.take_along_axis(dist, order, axis=1)


@lru_cache(maxsize=8)
def _projection(dims: int, table: int) -> np.ndarray:
    """Random orthonormal columns; with fewer dimensions than columns the rest is zero."""
    g = np.random.default_rng((dims, table))
    out = np.zeros((dims, 8 * BLOCKS))
    k = min(dims, 8 * BLOCKS)
    out[:, :k] = np.linalg.qr(g.normal(size=(dims, dims)))[0][:, :k]
    return out


_COMBINED = np.array(sorted(itertools.product(range(4), repeat=BLOCKS), key=sum))


def edge(dims: int, cosine: float) -> float:
    """``CELL`` for other dimensions and links: it grows as the distance of a just linked pair in a block of eight does.

    Points are kept in bytes, so it has a least value; a larger edge only adds candidates.
    """
    return max(CELL * math.sqrt(64 / max(dims, 8) * max(1 - cosine, 0.0) / 0.1), 0.02)


def cell_keys(unit: np.ndarray, table: int, cosine: float = 0.9) -> np.ndarray:
    """64-bit cell keys of unit vectors in a table: (n, 1 + PROBES), the own cell first."""
    z = unit @ _projection(unit.shape[1], table) / edge(unit.shape[1], cosine)
    found = [near_points(z[:, 8 * i:8 * i + 8], 4) for i in range(BLOCKS)]
    dist = sum(d[:, _COMBINED[:, i]] for i, (_, d) in enumerate(found))
    order = np.argsort(dist, axis=1, kind="stable")[:, :1 + PROBES]
    order[:, 0] = np.where((order == 0).any(axis=1), 0, order[:, 0])
    key = np.full(order.shape, (unit.shape[1] << 8) + table, np.uint64)
    for i, (points, _) in enumerate(found):
        codes = np.zeros(points.shape[:2], np.uint64)
        for e in range(8):
            codes = mix(codes + points[:, :, e].astype(np.int64).view(np.uint64))
        key = mix(key ^ np.take_along_axis(codes, _COMBINED[:, i][order], axis=1))
    return key.view(np.int64)


def _prepared(vectors: DataFrame) -> DataFrame:
    """vec_id and the vector's bytes in double precision; null for a vector that links with nothing."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column("embedding").to_pylist():
                x = np.array([np.nan if e is None else e for e in v or ()], np.float64)
                with np.errstate(all="ignore"):
                    out.append((x + 0.0).tobytes() if len(x) and np.isfinite(x).all() and x.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary())], ["vec_id", "value"])

    return vectors.selectExpr("cast(vec_id as long) vec_id", "embedding") \
        .mapInArrow(work, "vec_id long, value binary")


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _cells(nodes: DataFrame, cosine: float) -> DataFrame:
    """node, key, home: the cells of every vector."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.array(batch.column("node").to_pylist(), np.int64)
            values = batch.column("value").to_pylist()
            size = np.array([len(v) for v in values])
            for dims in np.unique(size):
                mine = np.flatnonzero(size == dims)
                for lo in range(0, len(mine), 2048):
                    part = mine[lo:lo + 2048]
                    unit = _unit(np.frombuffer(b"".join(values[i] for i in part), np.float64)
                                 .reshape(len(part), -1))
                    for t in range(TABLES):
                        keys = cell_keys(unit, t, cosine)
                        home = np.zeros(keys.shape, bool)
                        home[:, 0] = True
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.repeat(ids[part], keys.shape[1])), pa.array(keys.ravel()),
                             pa.array(home.ravel())], ["node", "key", "home"])

    return nodes.select("node", "value").mapInArrow(work, "node long, key long, home boolean")


def _alike(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose vectors have at least that cosine, in double precision."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, own, norm = None, None, 0.0
        for batch in batches:
            a, b = [], []
            cols = [batch.column(c).to_pylist() for c in ("b", "copy", "role", "a", "value")]
            for leader, copy, role, other, raw in zip(*cols):
                x = np.frombuffer(raw, np.float64)
                x = x / np.abs(x).max()
                if not role:
                    here, own, norm = (leader, copy), x, math.sqrt(x @ x)
                elif (leader, copy) == here and len(x) == len(own) and \
                        float(x @ own) / (math.sqrt(x @ x) * norm) >= least:
                    a.append(other)
                    b.append(leader)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return meet(pairs, nodes.select(F.col("node").alias("id"), "value")).mapInArrow(work, "a long, b long")


def _balls(cells: DataFrame, nodes: DataFrame, cosine: float) -> DataFrame:
    """node, ball: disjoint balls of vectors within half the link angle of a pivot in a crowded cell."""
    near = math.cos(math.acos(cosine) / 2) + 1e-9
    home = cells.filter("home")
    pivots = home.groupBy("key").agg(F.min("node").alias("b"), F.count("*").alias("size")).filter(f"size >= {CROWD}")
    tries = home.join(pivots, "key").select(F.col("node").alias("a"), "b").distinct()
    inside = cut(_alike(cut(tries.filter("a <> b")), nodes, near))
    ball = inside.groupBy("a").agg(F.min("b").alias("b"))
    for _ in range(2):  # members of a pivot that itself lies in another's ball try that one
        ball = cut(ball)
        up = ball.select(F.col("a").alias("b"), F.col("b").alias("c"))
        more = cut(_alike(cut(ball.join(up, "b").select("a", F.col("c").alias("b")).filter("a <> b")), nodes, near))
        ball = ball.unionByName(more).groupBy("a").agg(F.min("b").alias("b"))
    ball = cut(ball)
    # a pivot that lies in no other's ball belongs to its own
    alone = ball.select(F.col("b").alias("a")).distinct().join(ball.select("a"), "a", "left_anti")
    return ball.unionByName(alone.select("a", F.col("a").alias("b"))).select(
        F.col("a").alias("node"), F.col("b").alias("ball"))


def near_vectors(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components,
    and vectors of different lengths, link with nothing.  Equal vectors are one
    node, whose rows are linked with each other.  Repeated rows count as
    vectors of their own; a row with a null vec_id takes part, names no
    component and is kept.  An empty table gives an empty result.
    """
    rows = cut(_prepared(vectors))
    able = rows.filter("value is not null")
    nodes = able.groupBy("value").agg(F.count("*").alias("weight"), F.min("vec_id").alias("low"))
    nodes = cut(nodes.select(F.monotonically_increasing_id().alias("node"), "value", "weight", "low"))
    cells = cut(_cells(nodes, cosine))
    balls = cut(_balls(cells, nodes, cosine))
    seats = cut(cells.join(balls, "node", "left").select(
        "key", "node", "home", F.coalesce("ball", "node").alias("ball"), F.col("ball").isNotNull().alias("dense"))
        .join(cells.groupBy("key").agg(F.count("*").alias("n"), F.max("home").alias("any")).filter("n > 1 and any")
              .select("key"), "key", "left_semi"))
    # cells by ball, then the members of different balls
    own = seats.filter("home").select("key", F.col("ball").alias("p")).distinct()
    other = seats.select("key", F.col("ball").alias("q")).distinct()
    meetings = own.join(other, "key").filter("p <> q")
    left = seats.filter("home").select("key", F.col("ball").alias("p"), F.col("node").alias("x"))
    right = seats.select("key", F.col("ball").alias("q"), F.col("node").alias("y")).distinct()
    pairs = meetings.join(left, ["key", "p"]).join(right, ["key", "q"]).select(
        F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()
    links = cut(_alike(cut(pairs), nodes, cosine))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    outer = both.join(nodes.select(F.col("node").alias("b"), "weight"), "b").groupBy(F.col("a").alias("node")) \
        .agg(F.sum("weight").alias("outer"))
    inside = balls.join(nodes.select("node", "weight"), "node").groupBy("ball") \
        .agg(F.sum("weight").alias("held"), F.min("node").alias("first"))
    placed = balls.join(inside, "ball").select("node", "held", "first")
    parts = components(links.unionByName(placed.select(F.col("node").alias("a"), F.col("first").alias("b"))))
    known = nodes.join(parts, F.col("node") == F.col("id"), "left").select(
        "node", "value", "weight", "low", F.coalesce("component", "node").alias("part"))
    names = known.groupBy("part").agg(F.min("low").alias("component_id"))
    done = known.join(names, "part").join(outer, "node", "left").join(placed, "node", "left").select(
        "value", "component_id",
        (F.coalesce("held", "weight") - 1 + F.coalesce("outer", F.lit(0))).alias("n_links"))
    found = able.join(done, "value").select("vec_id", "n_links", "component_id").unionByName(
        rows.filter("value is null").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                            F.col("vec_id").alias("component_id")))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
