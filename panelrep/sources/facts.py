"""Fact tables: one long table per model query, all scenarios stacked.

A project is stored as :mod:`panelrep.sources.store` describes: Parquet files per
query and scenario, named by a manifest.  A load takes the files of the wanted
scenarios from the manifest, and the reporting-year filter is pushed into the
Parquet scan.  Plain ``<root>/query=<name>/scenario=<s>/`` folders without a
manifest can be read as well.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import file_system
from . import store

# Query tables of a model project (name in the project -> short name used here).
QUERY_TABLES = {
    "Population": "population",
    "GDP MER": "gdp",
    "land_cover": "land_cover",
    "harvests per year": "harvests",
    "ag production by tech": "ag_prod",
    "meat and dairy production by type": "an_prod",
    "ag commodity prices": "ag_prices",
    "meat and dairy prices": "an_prices",
    "ag tech yield": "ag_yield",
    "demand balances by crop commodity": "ag_use",
    "demand balances by animal commodity": "an_use",
    "imports": "imports",
    "exports": "exports",
    "fertilizer consumption by crop type": "fertilizer",
    "irrigation water withdrawals by crop type": "water",
    "food consumption (Pcal)": "food",
    "emissions by sector": "emissions",
    "LUC emissions by region": "luc_emissions",
    "feed consumption by animal commodity": "feed",
    "CO2 prices": "co2_prices",
}
OPTIONAL_TABLES = frozenset({"co2_prices"})


def normalize(df: DataFrame, years: Sequence[int]) -> DataFrame:
    """Keep the reporting years; ``scenario``/``year`` become ``Scenario``/``Year``."""
    return (df.filter(F.col("year").isin(list(years)))
            .withColumnsRenamed({"scenario": "Scenario", "year": "Year"})
            .withColumn("Year", F.col("Year").cast("int")))


def stack_scenarios(frames: Iterable[DataFrame]) -> DataFrame:
    """Stack per-scenario frames by column name; a missing column is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


class Project:
    """Named fact tables, each normalized on access (year filter, renames).

    ``first_years`` gives for a table the first reporting year of each scenario
    where the store knows it.
    """

    def __init__(self, tables: Mapping[str, DataFrame], years: Sequence[int],
                 first_years: Mapping[str, Mapping[str | None, int]] | None = None):
        self._tables = dict(tables)
        self.years = tuple(years)
        self.first_years = dict(first_years or {})
        self._normalized: dict[str, DataFrame] = {}

    def has(self, name: str) -> bool:
        return name in self._tables

    def raw(self, name: str) -> DataFrame:
        return self._tables[name]

    def table(self, name: str) -> DataFrame | None:
        if name not in self._tables:
            if name in OPTIONAL_TABLES:
                return None
            raise KeyError(f"query table {name!r} is missing")
        # one normalized DataFrame per table: identical scans in a plan are reused
        if name not in self._normalized:
            self._normalized[name] = normalize(self._tables[name], self.years)
        return self._normalized[name]

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, years: Sequence[int],
                     scenarios: Sequence[str] | None = None, names: Sequence[str] | None = None,
                     version: int | None = None) -> "Project":
        """Open every query table under ``root`` (absent optional ones are skipped).

        All tables are of one version of the project, the latest or the one
        given.  Scenario names are always read as text.
        """
        snap = store.snapshot(spark, root, version)
        tables, first = {}, {}
        for short in names or list(dict.fromkeys(list(QUERY_TABLES.values()) + listed(spark, root))):
            if snap is None:
                df = read_plain(spark, root, short)
                if df is not None and scenarios is not None:
                    df = df.filter(F.col("scenario").isin(list(scenarios)))
            else:
                df = store.read(spark, root, short, snap, scenarios)
                known = snap.first_years(short, years)
                if known is not None:
                    first[short] = {s: y for s, y in known.items() if scenarios is None or s in scenarios}
            if df is None:
                if short in OPTIONAL_TABLES:
                    continue
                raise FileNotFoundError(f"{root}/query={short}")
            tables[short] = df
        return cls(tables, years, first)


def read_table(spark: SparkSession, root: str, query: str, key: str = "scenario",
               version: int | None = None) -> DataFrame | None:
    """One stored query table, all scenarios stacked by column name; ``None`` when it is not stored.

    A column that only some scenarios have is null in the others, and scenario
    names are text whatever they look like.
    """
    snap = store.snapshot(spark, root, version)
    return read_plain(spark, root, query, key) if snap is None else store.read(spark, root, query, snap, key=key)


def read_plain(spark: SparkSession, root: str, query: str, key: str = "scenario") -> DataFrame | None:
    """:func:`read_table` for plain folders without a manifest: the columns come from the files' footers.

    What an ingest has written but not committed is left out.
    """
    path = f"{root}/query={query}"
    paths = [f"{path}/{n}" for n in folders(spark, path) if n.startswith(f"{key}=")]
    if not paths:
        return None
    found = spark.read.option("mergeSchema", True).option("basePath", path).parquet(*paths).schema
    fields = [T.StructField(f.name, T.StringType()) if f.name == key else f for f in found]
    return spark.read.schema(T.StructType(fields)).option("basePath", path).parquet(*paths)


def folders(spark: SparkSession, path: str) -> list[str]:
    fs, p = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def listed(spark: SparkSession, root: str) -> list[str]:
    """Query names present under ``root`` (directory names ``query=<name>``)."""
    return [n[len("query="):] for n in folders(spark, root) if n.startswith("query=")]


def write_project(tables: Mapping[str, DataFrame], root: str, threads: int = 8) -> dict[str, list[str]]:
    """Store query tables in one commit, without clobbering; the added scenarios per table."""
    if not tables:
        return {}
    new = store.Ingest(next(iter(tables.values())).sparkSession, root)
    new.add_all(tables, threads)
    return new.commit()


def rows_to_append(incoming: DataFrame, existing: DataFrame | None, key: str = "scenario") -> DataFrame:
    """Rows of ``incoming`` whose scenario is not stored yet (no clobbering)."""
    if existing is None:
        return incoming
    return incoming.join(existing.select(key).distinct(), key, "left_anti")


def ingest_no_clobber(spark: SparkSession, incoming: DataFrame, root: str, query: str,
                      key: str = "scenario") -> list[str]:
    """Adds the scenarios of ``incoming`` that ``root/query=<query>`` lacks; the names of the added ones.

    They become visible together, with the commit at the end.  Stored scenarios
    are never touched.
    """
    return ingest_project(spark, {query: incoming}, root, key)[query]


def ingest_project(spark: SparkSession, tables: Mapping[str, DataFrame], root: str, key: str = "scenario",
                   threads: int = 8) -> dict[str, list[str]]:
    """Adds the scenarios of all query tables in one commit, without clobbering; the added names per table.

    Stopped before the commit, nothing of the call is visible, and the same
    call does it all again.
    """
    new = store.Ingest(spark, root, key)
    new.add_all(tables, threads)
    return new.commit()
