"""Lookup bridges: wide user CSVs -> long many-to-many maps.

A bridge maps one key (a native region, commodity or land type) to one or
more reporting categories.  The wide files are ragged: a row lists its
categories in columns ``Item1..ItemN`` with blanks where a row has fewer.
All readers here return a :class:`Bridge`, a long ``(key, category)`` table
with a size bound, so that joins against it can be broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import COMMODITY_MAP_NAME_COLUMNS, LAND_MAP_KEY_COLUMN, WASTE_MAP_COMMODITY_COLUMN
from ..operators.bounded import Small, local_table, prove_bound


@dataclass(frozen=True)
class Bridge:
    """Long bridge ``key -> value`` with a size bound."""

    small: Small
    key: str
    value: str

    @property
    def df(self) -> DataFrame:
        return self.small.df

    def side(self) -> DataFrame:
        return self.small.side()

    def values(self) -> Small:
        """Distinct categories of the bridge (bounded by the bridge size)."""
        return Small(self.df.select(self.value).distinct(), self.small.max_bytes)

    def without_null_keys(self) -> "Bridge":
        return Bridge(self.small.map_df(lambda d: d.filter(F.col(self.key).isNotNull())), self.key, self.value)


def read_map_csv(spark: SparkSession, path: str, *, na_text: bool = False,
                 schema: T.StructType | None = None) -> DataFrame:
    """Read a wide map CSV with a header, all columns as strings.

    Blank fields are null.  With ``na_text=True`` the text ``NA`` is null as
    well (the reader default of the reporting workflow for some files);
    otherwise ``NA`` stays text.
    """
    reader = spark.read.option("header", True).option("multiLine", False)
    if na_text:
        reader = reader.option("nullValue", "NA")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", False)
    return reader.csv(path)


def long_bridge(wide: DataFrame, key: str, value: str, value_cols: list[str] | None = None) -> DataFrame:
    """Ragged wide -> long: one row per non-null category column."""
    cols = value_cols or [c for c in wide.columns if c != key]
    return (wide.unpivot([key], cols, "__slot", value)
            .filter(F.col(value).isNotNull())
            .select(key, value))


def alias_bridge(wide: DataFrame, name_cols: list[str], item_cols: list[str], *,
                 key: str = "commodity_key", value: str = "Item", keep_null_keys: bool = True) -> DataFrame:
    """Items x spellings: every spelling of a commodity maps to all its items.

    First the item columns become one column (null items dropped), then the
    name columns become one key column.  A missing spelling yields a row with
    a null key; it is kept when ``keep_null_keys`` (the reference behaviour),
    and dropped otherwise.
    """
    items = (wide.unpivot(name_cols, item_cols, "__slot", value)
             .filter(F.col(value).isNotNull())
             .drop("__slot"))
    out = items.unpivot([value], name_cols, "__name", key).select(value, key)
    if not keep_null_keys:
        out = out.filter(F.col(key).isNotNull())
    return out.select(key, value)


def attribute_surface(fractions_wide: DataFrame, class_col: str, region_classes: DataFrame,
                      commodity_classes: DataFrame, *, region_col: str = "region",
                      region_class_col: str = "food_waste_region", commodity_col: str = "commodity_key",
                      out_col: str = "waste_frac") -> DataFrame:
    """Two-way table (commodity class x region class -> value) -> (region, commodity, value).

    Region classes are the column headers of ``fractions_wide``; both class
    maps are joined with left joins, so a class without members yields a
    row with a null member (as in the reference).
    """
    value_cols = [c for c in fractions_wide.columns if c != class_col]
    long = fractions_wide.unpivot([class_col], value_cols, region_class_col, out_col)
    # class maps are user lookups of unknown size: the planner picks the join
    return (long.join(region_classes, region_class_col, "left")
            .join(commodity_classes, class_col, "left")
            .select(region_col, commodity_col, out_col))


def bridge_from_long(df: DataFrame, key: str, value: str) -> Bridge:
    """Wrap a long DataFrame; its size comes from the plan's statistics."""
    return Bridge(prove_bound(df), key, value)


def bridge_from_rows(spark: SparkSession, rows: list[tuple], key: str, value: str) -> Bridge:
    """Bridge from local ``(key, value)`` pairs."""
    schema = T.StructType([T.StructField(key, T.StringType()), T.StructField(value, T.StringType())])
    return Bridge(prove_bound(local_table(spark, rows, schema)), key, value)


def region_bridge_csv(spark: SparkSession, path: str) -> Bridge:
    wide = read_map_csv(spark, path)
    # the value column is not called ``Region``: Spark names are case-insensitive
    return bridge_from_long(long_bridge(wide, "region", "report_region"), "region", "report_region")


def land_bridge_csv(spark: SparkSession, path: str) -> Bridge:
    wide = read_map_csv(spark, path).withColumnRenamed(LAND_MAP_KEY_COLUMN, "land_type")
    return bridge_from_long(long_bridge(wide, "land_type", "Item"), "land_type", "Item")


def demand_bridge_csv(spark: SparkSession, path: str) -> Bridge:
    wide = read_map_csv(spark, path)
    return bridge_from_long(long_bridge(wide, "sector", "Variable"), "sector", "Variable")


def commodity_bridge_csv(spark: SparkSession, path: str, *, keep_null_keys: bool = True) -> Bridge:
    """Commodity bridge: every spelling (plain, traded, regional) -> all items."""
    wide = read_map_csv(spark, path)
    name_cols = list(COMMODITY_MAP_NAME_COLUMNS)
    item_cols = [c for c in wide.columns if c not in name_cols]
    long = alias_bridge(wide, name_cols, item_cols, key="commodity_key", keep_null_keys=keep_null_keys)
    return bridge_from_long(long, "commodity_key", "Item")


def scenario_pairs_csv(spark: SparkSession, path: str) -> Small:
    return prove_bound(read_map_csv(spark, path))


def waste_surface_csv(spark: SparkSession, regions_path: str, commodities_path: str, fractions_path: str) -> Small:
    regions = read_map_csv(spark, regions_path, na_text=True)
    commodities = read_map_csv(spark, commodities_path, na_text=True).withColumnRenamed(
        WASTE_MAP_COMMODITY_COLUMN, "commodity_key")
    fr = read_map_csv(spark, fractions_path, na_text=True)
    fr = fr.select("commodity", *[F.col(c).cast("double").alias(c) for c in fr.columns if c != "commodity"])
    return prove_bound(attribute_surface(fr, "commodity", regions, commodities))
