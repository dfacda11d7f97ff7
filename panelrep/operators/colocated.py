"""Fact-fact joins without an exchange: tables bucketed by one key.

Facts that are joined again and again (harvests, land cover, yields by scenario,
region and leaf) are stored once in buckets of a hash of those columns, each
bucket in one file and sorted.  A join on that hash finds both sides dealt alike,
so no row is shuffled, and the outcome keeps the buckets for the next join.  The
columns themselves, null matching null, and any further ones are compared row by
row after that, so keys that share a hash stay apart.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_KEY = "__bucket_key"


def bucketed(df: DataFrame, keys: Sequence[str], buckets: int, root: str) -> DataFrame:
    """``df`` stored below ``root`` in ``buckets`` buckets of a hash of ``keys``, which it gets as a column.

    The rows are dealt out before writing, so that every bucket is one file.
    The table is known to this session by a name of its own.
    """
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    df.withColumn(BUCKET_KEY, F.xxhash64(*keys)).repartition(buckets, BUCKET_KEY).write.format("parquet") \
        .bucketBy(buckets, BUCKET_KEY).sortBy(BUCKET_KEY).option("path", f"{root}/{name}").saveAsTable(name)
    return spark.table(name)


def same(a: Column, b: Column) -> Column:
    """Null-safe equality that the planner does not take for a join key."""
    return F.coalesce(a == b, a.isNull() & b.isNull())


def colocated_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], how: str = "left") -> DataFrame:
    """Joins two bucketed tables on pairs (left column, right column), null matching null.

    Of the right side, whose columns must have other names, the bucket key is dropped.
    """
    cond = [left[BUCKET_KEY] == right[BUCKET_KEY]] + [same(left[a], right[b]) for a, b in on]
    return left.join(right, reduce(lambda a, b: a & b, cond), how).drop(right[BUCKET_KEY])
