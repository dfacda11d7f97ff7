"""Text rules as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nullmath import _col, contains_or_false, if_else3

# Runs of characters that are not letters or digits (Unicode-aware, so that
# accented letters do not split a key).
NON_ALNUM_RUN = r"(?U)[^\p{Alnum}]+"


def split_key(c, n: int) -> list[Column]:
    """Split a composite key into ``n`` parts on runs of non-alphanumerics.

    Short keys are padded with nulls on the right, extra parts are dropped,
    a trailing separator yields an empty last part, a null key gives nulls.
    """
    parts = F.split(_col(c), NON_ALNUM_RUN)
    return [F.get(parts, i) for i in range(n)]


def with_split_key(df, source: str, into: list[str]):
    """Add the parts of ``source`` as columns ``into`` (``source`` is kept)."""
    return df.withColumns(dict(zip(into, split_key(source, len(into)))))


def paste(*cols) -> Column:
    """Join texts with a space; a null part is written as the text ``NA``."""
    return F.concat_ws(" ", *[F.coalesce(_col(c), F.lit("NA")) for c in cols])


def strip_suffix_len(text, suffix) -> Column:
    """``text`` without its last ``len(suffix) + 1`` characters ('' when too short)."""
    text = _col(text)
    return text.substr(F.lit(1), F.length(text) - (F.length(_col(suffix)) + F.lit(1)))


def recover_origin(df, *, meat_export_sector: str, traded_marker: str = "traded",
                   sector: str = "sector", subsector: str = "subsector", region: str = "region"):
    """Export rows: fix the sector of meat exports, and the region of traded goods.

    1. sector ``S`` equal to ``meat_export_sector`` becomes ``"S subsector"``;
    2. if the (new) sector contains ``traded_marker``, the region is the
       subsector label without the trailing ``" " + sector``.
    Applied in that order: the region rule sees the new sector.
    """
    new_sector = if_else3(F.col(sector) == F.lit(meat_export_sector), paste(sector, subsector), F.col(sector))
    df = df.withColumn(sector, new_sector)
    new_region = F.when(contains_or_false(sector, traded_marker),
                        strip_suffix_len(subsector, sector)).otherwise(F.col(region))
    return df.withColumn(region, new_region)
