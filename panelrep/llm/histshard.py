"""Sharding by histogram sort: exact byte counts below candidate boundaries, refined, then one exchange.

Rows are ordered by a 62-bit key: 31 bits of the text's hash, then 31 bits of
the hash of id and text.  Equal texts are neighbours, and a text that makes up
a third of all rows is still spread over the key space.  Rounds of counting
split the key space further only where a splitter's share of the bytes is not
met within the tolerance, or where a range holds too many rows for one task.
What reaches the driver per round is one (prefix, rows, bytes) per counted
range, bounded by shards and ``leaves``, never by the number of rows.  Only
DataFrame and SQL functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

KEY_BITS = 62
#: Bits of the key that each round of counting resolves.
ROUNDS = (12, 10, 10, 10, 10, 10)
_LEAF = "leaf int, depth int, prefix long, first_rank long, first_shard int, cuts array<long>"


def sort_key(text: Column, ident: Column) -> Column:
    """62-bit non-negative key; null text counts as empty, null id is a value like any other."""
    t = F.coalesce(text, F.lit(""))
    high = F.shiftrightunsigned(F.xxhash64(t), 33)
    low = F.shiftrightunsigned(F.xxhash64(F.lit(1), ident, t), 33)
    return F.shiftleft(high, 31).bitwiseOR(low)


def _prefix(key: str, depth: int) -> Column:
    return F.shiftright(F.col(key), KEY_BITS - depth)


def ranges(df: DataFrame, key: str, size: str, shards: int, tolerance: float, leaf_rows: int, leaves: int) \
        -> tuple[list[tuple], list[int]]:
    """Counts key ranges until every splitter meets the tolerance; (leaf rows, first rank of each shard)."""
    done: list[list[int]] = []  # depth, prefix, rows, bytes
    depth, opened, total = 0, None, None
    for bits in ROUNDS:
        depth += bits
        rows = df if opened is None else df.filter(_prefix(key, depth - bits).isin(opened))
        found = rows.groupBy(_prefix(key, depth).alias("p")).agg(F.count("*").alias("n"), F.sum(size).alias("b")) \
            .collect()  # bounded: one row per counted range
        fresh = [[depth, r.p, r.n, r.b] for r in found]
        if total is None:
            total, n = sum(x[3] for x in fresh), sum(x[2] for x in fresh)
            slack, most = tolerance * total / shards, max(leaf_rows, n // leaves)
        parts = sorted(done + fresh, key=lambda x: x[1] << (KEY_BITS - x[0]))
        done, opened, below = [], [], 0
        for p in parts:
            inside = any(below + slack < total * k / shards < below + p[3] - slack for k in range(1, shards)
                         if total * k / shards <= below + p[3])
            if p[0] == depth < KEY_BITS and p[2] > 1 and (inside or p[2] > most):
                opened.append(p[1])
            else:
                done.append(p)
            below += p[3]
        if not opened:
            break
    # ranges to shards: a splitter goes to the nearest end of a range; it cuts inside only where all keys are equal
    parts, targets = done, [total * k / shards for k in range(1, shards)]
    out, starts, rank, below, shard = [], [0], 0, 0, 0
    for leaf, (d, p, n, b) in enumerate(parts):
        while shard < shards - 1 and targets[shard] <= below + min(slack, b / 2):
            starts.append(rank)
            shard += 1
        first, cuts = shard, []
        if n > 1 and d == KEY_BITS:
            while shard < shards - 1 and targets[shard] < below + b - slack:
                cuts.append(max(1, round((targets[shard] - below) * n / b)))
                starts.append(rank + cuts[-1])
                shard += 1
        out.append((leaf, d, p, rank, first, cuts))
        if not cuts and n == 1:  # one row across a splitter: it goes where most of it lies
            while shard < shards - 1 and targets[shard] < below + b / 2:
                shard += 1
                starts.append(rank)
                out[-1] = (leaf, d, p, rank, shard, cuts)
        rank, below = rank + n, below + b
    starts += [rank] * (shards - len(starts))
    return out, starts


def histogram_shards(df: DataFrame, key: str, size: str, order: list[str], shards: int = 40,
                     tolerance: float = 0.0005, leaf_rows: int = 50_000, leaves: int = 1024) -> DataFrame:
    """Adds ``shard`` (0 to shards - 1, bytes near equal) and ``slot`` (gapless from 0 in each shard).

    ``df`` is read once per round and once for the exchange, so hand over a
    written table.  ``tolerance``: bytes a splitter may be off, as a share of a
    mean shard.  ``leaf_rows``, ``leaves``: a range is split further while it
    holds more rows than both ``leaf_rows`` and rows / ``leaves``.  Ties in the
    key are ordered by ``order``; rows equal in all of it are cut by rank.  An
    empty table gives an empty result.
    """
    spark = df.sparkSession
    found, starts = ranges(df, key, size, shards, tolerance, leaf_rows, leaves)
    for d in sorted({x[1] for x in found} or {ROUNDS[0]}):
        leaf = spark.createDataFrame([x for x in found if x[1] == d], _LEAF)
        # bounded by leaves and shards, whatever the number of rows
        leaf = F.broadcast(leaf.select(F.col("prefix").alias(f"__p{d}"), F.struct(
            "leaf", "first_rank", "first_shard", "cuts").alias(f"__l{d}")))
        df = df.join(leaf, _prefix(key, d) == F.col(f"__p{d}"), "left")
    depths = sorted({x[1] for x in found} or {ROUNDS[0]})
    df = df.withColumn("__leaf", F.coalesce(*[F.col(f"__l{d}") for d in depths])) \
        .drop(*[f"__{c}{d}" for d in depths for c in "pl"])
    at = F.row_number().over(Window.partitionBy(F.col("__leaf.leaf")).orderBy(key, *order)) - 1
    df = df.withColumn("__at", at.cast("long"))
    inner = F.size(F.filter("__leaf.cuts", lambda c: c <= F.col("__at")))
    df = df.withColumn("shard", (F.col("__leaf.first_shard") + inner).cast("int"))
    start = F.element_at(F.array(*[F.lit(x).cast("long") for x in starts]), F.col("shard") + 1)
    return df.withColumn("slot", F.col("__leaf.first_rank") + F.col("__at") - start).drop("__leaf", "__at")


def shard_documents(docs: DataFrame, shards: int = 40, **options) -> DataFrame:
    """Documents (doc_id, text, any further columns) into shards of near equal bytes, by :func:`histogram_shards`.

    A row's size is its text's UTF-8 bytes (null: none) plus 16.  Returns
    doc_id, size, text_crc32, law, shard, slot, grown_shard (null: the law is
    ``bytes``).  Repeated rows are rows of their own.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = cut(docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                           F.crc32(text).alias("text_crc32"), sort_key(text, F.col("doc_id")).alias("key")))
    out = histogram_shards(slim, "key", "size", ["doc_id", "text_crc32", "size"], shards, **options)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
