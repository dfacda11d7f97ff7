"""Helpers shared by the operators: whole texts as flat byte arrays, lineage cuts, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package

#: Bytes of text an operator turns into numpy arrays at a time; a longer text makes a block of its own.
BLOCK_BYTES = 1 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Lineage cut with checkpoint() in the shared folder that the session names."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column (null: empty) and the n + 1 offsets of its texts in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, starts, data = column.buffers()
    at = np.frombuffer(starts, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str, most: int = BLOCK_BYTES) \
        -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about ``most`` bytes of text each: (rows, bytes, offsets).

    Every row comes in exactly one slice and texts are never split here.
    """
    for batch in batches:
        raw, at = flat(batch.column(batch.schema.get_field_index(text)))
        lo, n = 0, batch.num_rows
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, "right")) - 1)
            hi = min(hi, n)
            yield batch.slice(lo, hi - lo), raw[at[lo]:at[hi]], at[lo:hi + 1] - at[lo]
            lo = hi


def owner(at: np.ndarray) -> np.ndarray:
    """For offsets of n texts, the text number of every byte."""
    return np.repeat(np.arange(len(at) - 1), np.diff(at))


#: Links up to this number are joined into components in one partition, without shuffles; more are dealt out.
FEW_LINKS = 200_000


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links (a, b): rows (id, component), component the smallest id.

    Large-star and small-star rounds (MapReduce connected components): every
    round is joins and grouped minima, the table shrinks towards one star per
    component, and its lineage is cut with checkpoint().  Only counters reach
    the driver.  The links are counted once; few of them take one partition,
    where the same rounds need no shuffle.
    """
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    few = e.count() <= FEW_LINKS
    before = None
    while True:
        e = e.coalesce(1) if few else e
        both = e.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        e = cut(small.filter("u <> v").distinct())
        now = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    e = e.coalesce(1) if few else e
    roots = e.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def meet(pairs: DataFrame, table: DataFrame, per_copy: int = 500) -> DataFrame:
    """Brings the values of pairs (a, b) together: rows (b, copy, role, a, value), sorted within partitions.

    ``table`` has (id, value).  In each (b, copy) the value of b comes first
    (role 0), then those of its partners a (role 1).  A b has a copy for each
    ``per_copy`` of its partners, so a hot one is spread over tasks.
    """
    copies = pairs.groupBy("b").agg(F.ceil(F.count("*") / per_copy).cast("int").alias("copies"))
    placed = pairs.join(copies, "b").select("a", "b", F.pmod(F.xxhash64("a", "b"), "copies").cast("int").alias("copy"))
    partners = placed.join(table, F.col("a") == F.col("id")).select("b", "copy", F.lit(1).alias("role"), "a", "value")
    own = copies.select("b", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")) \
        .join(table, F.col("b") == F.col("id")) \
        .select("b", "copy", F.lit(0).alias("role"), F.col("b").alias("a"), "value")
    return partners.unionByName(own).repartition("b", "copy").sortWithinPartitions("b", "copy", "role")


def top_rows(df: DataFrame, keys: list[str], order: list[Column], top: int, ways: int = 64) -> DataFrame:
    """The first ``top`` rows of every key with their rank; tasks give parts, so that no task gets all rows of a key.

    Each of ``ways`` groups of source partitions keeps its first rows of a key, of which the first are taken.
    """
    part, rank = "__part", "rank"
    first = Window.partitionBy(*keys, part).orderBy(*order)
    some = df.withColumn(part, F.spark_partition_id() % ways).withColumn(rank, F.row_number().over(first)) \
        .filter(F.col(rank) <= top).drop(part)
    return some.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))) \
        .filter(F.col(rank) <= top)
