"""Broadcast only what is small by Spark's own size statistics.

A :class:`Small` wraps a lookup DataFrame with an upper bound on its size in
bytes, taken from the optimized plan's statistics or from local rows.
``side()`` returns it with a broadcast hint when the bound is under the limit;
otherwise the plain DataFrame is returned and the planner (size statistics,
AQE at runtime) chooses the join strategy.  No job runs to find a bound.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Bytes up to which a lookup side is broadcast by hint (Spark's default threshold).
BROADCAST_BYTES = 10 << 20


@dataclass(frozen=True)
class Small:
    df: DataFrame
    max_bytes: int | None = None  # upper bound, None when unknown

    @property
    def bounded(self) -> bool:
        return self.max_bytes is not None and self.max_bytes <= BROADCAST_BYTES

    def side(self) -> DataFrame:
        return F.broadcast(self.df) if self.bounded else self.df

    def map_df(self, fn) -> "Small":
        """Apply a transformation that does not make the table larger."""
        return Small(fn(self.df), self.max_bytes)


def plan_bytes(df: DataFrame) -> int:
    """Size estimate of the optimized plan, as the planner itself uses it."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()  # noqa: SLF001
    return int(str(stats.sizeInBytes()))  # a big number's text, or a plain one


def local_table(spark: SparkSession, rows: Iterable[Sequence], schema: str | T.StructType) -> DataFrame:
    """Rows of the driver as a DataFrame whose size the planner knows.

    Made from an Arrow table, it is a local relation; rows given as they are
    become an RDD, of which the planner only knows that it may be large.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = list(rows)
    kinds = to_arrow_schema(schema)
    columns = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(kinds)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=kinds), schema)


def prove_bound(df: DataFrame) -> Small:
    """``df`` with the size that the plan statistics give it."""
    return Small(df, plan_bytes(df))
