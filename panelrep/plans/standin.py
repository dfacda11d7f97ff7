"""A stand-in scenario project built from the generic test tables.

The model results the recipes are written for are not available, so the
operators are exercised on a *panel* derived from the TPC-H-like tables
(one row per line item; the reporting years are 1995, 1997, 1999, 2001,
rows of other years are stored as well and left to the year filter):

* scenario = return flag (A, N, R), region = supplier nation,
* sector = part type (``unlisted`` for Brand#25, absent from the bridges),
* technology = ``<type>_N<nation>_<IRR|RFD>_<hi|lo>`` (a 4-part leaf key),
* disposition by part size, gas by line number (null for one in four),
* quantity, price and discount as ``decimal(18,2)`` measures.

Every query table of a model project is then a projection or aggregate of
this panel, and the bridges are small invented tables (the region bridge
is derived from ``nation`` x ``region``).  All of it is lazy: the tables grow
with the input data, and nothing is collected.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ReportConfig
from ..operators.bounded import Small, local_table, prove_bound
from ..sources import store
from ..sources.bridges import (Bridge, alias_bridge, attribute_surface, bridge_from_long, bridge_from_rows,
                               long_bridge)
from ..session import ensure_checkpoint_dir, file_system, scratch_folder
from ..sources.facts import Project, write_project
from .recipes.common import Bridges

PANEL_YEARS = (1995, 1997, 1999, 2001)
DEC = "decimal(18,2)"
ANIMAL_SECTORS = ("MEDIUM", "SMALL", "unlisted")

# Invented bridges and lists of the stand-in study (test fixtures).
ITEM_BRIDGE_WIDE = [
    # name, traded name, regional name, Item1..Item4
    ("ECONOMY", "traded economy", "regional economy", "CER", None, "CRP", "ALL"),
    ("STANDARD", "traded standard", "regional standard", "VEG", "VEG|LEAF", "CRP", "ALL"),
    ("PROMO", "traded promo", None, "VEG", "VEG|ROOT", "CRP", "ALL"),
    ("MEDIUM", "Exports_M medium", None, "RUM", None, "LSP", "ALL"),
    ("SMALL", None, None, "NRM", "NRM|A", "LSP", "ALL"),
    ("LARGE", "traded large", "total large", "NRG", None, None, None),
]
LAND_BRIDGE = [
    ("ECONOMY", "CER"), ("ECONOMY", "CRP"), ("ECONOMY", "ALL"),
    ("STANDARD", "VEG"), ("STANDARD", "VEG|LEAF"), ("STANDARD", "CRP"), ("STANDARD", "ALL"),
    ("PROMO", "VEG"), ("PROMO", "VEG|ROOT"), ("PROMO", "CRP"), ("PROMO", "ALL"),
    ("MEDIUM", "RUM"), ("MEDIUM", "LSP"), ("MEDIUM", "ALL"),
    ("SMALL", "NRM"), ("SMALL", "NRM|A"), ("SMALL", "LSP"), ("SMALL", "ALL"),
    ("LARGE", "NRG"), ("LARGE", "CRP"), ("LARGE", "ALL"),
]
DEMAND_BRIDGE = [("food_use", "FOOD"), ("food_use", "CONS"), ("feed_use", "FEED"),
                 ("other_use", "OTHU"), ("other_use", "CONS")]
BASELINE_PAIRS = [("A", "N"), ("R", "N")]
WASTE_REGION_CLASS = [("AFRICA", "AFR_w"), ("AMERICA", "AMR_w"), ("ASIA", "ASA_w"), ("EUROPE", "EUR_w"),
                      ("MIDDLE EAST", "EMR_w")]
WASTE_COMMODITY_CLASS = [("ECONOMY", "cereals"), ("STANDARD", "cereals"), ("PROMO", "veg"),
                         ("MEDIUM", "meat"), ("SMALL", "meat")]
WASTE_FRACTIONS = [  # class, AFR_w, AMR_w, ASA_w, EUR_w, EMR_w
    ("cereals", "0.05", "0.10", "0.08", "0.12", "0.07"),
    ("veg", "0.15", "0.20", "0.18", "0.25", "0.16"),
    ("meat", "0.03", "0.06", "0.04", "0.08", "0.05"),
    ("eggs", "0.02", "0.04", "0.03", "0.05", "0.02"),
]
AREA_ITEMS = ("CER", "VEG", "VEG|LEAF", "VEG|ROOT", "CRP", "ALL", "NRG")


def standin_config() -> ReportConfig:
    prod = ("CER", "VEG", "VEG|LEAF", "VEG|ROOT", "CRP", "RUM", "NRM", "LSP", "ALL", "NRG")
    price = tuple(i for i in prod if i != "VEG|ROOT")
    return ReportConfig(
        years=PANEL_YEARS, land_items=("CER", "VEG", "CRP", "LSP", "ALL", "NRG"), area_items=AREA_ITEMS,
        prod_items=prod, price_items=price, trade_items=price, frtn_items=AREA_ITEMS, watr_items=AREA_ITEMS,
        yexo_exclude="NRG", biomass_sector="LARGE", biomass_weight_year=1997, meat_export_sector="Exports_M",
        feed_classes=("food_use", "feed_use", "outside"), passthrough_feed_class="other_use",
        passthrough_feed_input="PROMO", feed_alloc_items=(("FRUM", "RUM"), ("FDRY", "NRM"), ("FNRM", "LSP")),
        ech4_ghgs=("CH4_AGR",), en2o_ghgs=("N2O_AGR",), emis_ghgs=("CO2", "CH4_AGR", "N2O_AGR"),
        studies={"main": ("A", "N", "R"), "alt": ("N",)}, parity=True, model="PANEL")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item, of every year (see module docstring)."""
    li = (read(spark, sf_dir, "lineitem")
          .select("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                  "l_returnflag", "l_linestatus", "l_shipdate"))
    sup = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    if not prove_bound(part).bounded:
        # a reader of few columns leaves little but the keys of a large part, which would look small enough to broadcast
        part = part.hint("merge")
    # one lookup after another, so that each is judged by its own size: supplier joined to nation first is taken for as
    # large as their product, and every line item is shuffled to it; part comes first, while the rows are narrowest
    df = (li.join(part, li.l_partkey == part.p_partkey).join(sup, li.l_suppkey == sup.s_suppkey)
          .join(nat, sup.s_nationkey == nat.n_nationkey))
    water = F.when(F.col("l_linestatus") == "O", "IRR").otherwise("RFD")
    level = F.when(F.col("p_size") > 25, "hi").otherwise("lo")
    gas = (F.when(F.col("l_linenumber") % 4 == 0, "CO2").when(F.col("l_linenumber") % 4 == 1, "CH4_AGR")
           .when(F.col("l_linenumber") % 4 == 2, "N2O_AGR"))
    disp = (F.when(F.col("p_size") <= 20, "food_use").when(F.col("p_size") <= 35, "feed_use")
            .when(F.col("p_size") <= 45, "other_use").otherwise("outside"))
    return df.select(
        F.col("l_returnflag").alias("scenario"),
        F.col("n_name").alias("region"),
        F.when(F.col("p_brand") == "Brand#25", "unlisted").otherwise(F.col("p_type")).alias("sector"),
        F.concat(F.col("p_type"), F.lit("_N"), F.col("s_nationkey").cast("string"), F.lit("_"), water,
                 F.lit("_"), level).alias("technology"),
        disp.alias("disposition"),
        gas.alias("ghg"),
        F.year("l_shipdate").cast("int").alias("yr"),
        F.col("l_quantity").cast(DEC).alias("qty"),
        F.col("l_extendedprice").cast(DEC).alias("price"),
        F.col("l_discount").cast(DEC).alias("frac"),
    )


def _sum(c: str) -> "F.Column":
    return F.sum(c).cast(DEC).alias("value")


def query_tables(spark: SparkSession, sf_dir: str, p: DataFrame | None = None) -> dict[str, DataFrame]:
    """The model query tables of the stand-in project (raw: ``scenario``, ``year``)."""
    p = panel(spark, sf_dir) if p is None else p
    y = F.col("yr").alias("year")
    animal = F.col("sector").isin(list(ANIMAL_SECTORS))
    cust = (read(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("value"))
            .join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("n_name").alias("region"), "value"))
    t: dict[str, DataFrame] = {}
    t["population"] = p.select("scenario", "region", "yr").distinct().join(cust, "region").select(
        "scenario", "region", y, "value")
    t["pop_qty"] = p.select("scenario", "region", y, F.col("qty").alias("value"))
    t["gdp"] = t["pop_qty"]
    # small lines lie on a land type of their own, which no harvest names: missing matches without missing rows
    leaf = F.when(F.col("qty") > 15, F.col("technology")).otherwise(
        F.concat(F.lit("BARREN_"), F.substring_index("technology", "_", -3)))
    t["land_cover"] = (p.groupBy("scenario", "region", leaf.alias("landleaf"), "yr").agg(_sum("qty"))
                       .select("scenario", "region", "landleaf", y, "value"))
    t["harvests"] = (p.groupBy("scenario", "region", "technology", "yr").agg(_sum("frac"))
                     .select("scenario", "region", "technology", y, "value"))
    # large parts of the first year have a sector of their own, which no bridge names: a hole in their item's years
    early = (F.col("sector") == "LARGE") & (F.col("yr") == PANEL_YEARS[0])
    t["ag_prod"] = (p.withColumn("sector", F.when(early, "LARGE_start").otherwise(F.col("sector")))
                    .groupBy("scenario", "region", "sector", "technology", "yr").agg(_sum("qty"))
                    .select("scenario", "region", "sector", "technology", y, "value"))
    t["an_prod"] = (p.filter(animal).groupBy("scenario", "region", "sector", "yr").agg(_sum("qty"))
                    .select("scenario", "region", "sector", y, "value"))
    t["ag_prices"] = (p.groupBy("scenario", "region", "sector", "yr").agg(F.max("price").alias("value"))
                      .select("scenario", "region", "sector", y, "value"))
    t["an_prices"] = (p.filter(animal).groupBy("scenario", "region", "sector", "yr")
                      .agg(F.max("price").alias("value")).select("scenario", "region", "sector", y, "value"))
    known = (F.col("frac") < F.lit(0.09).cast(DEC)) & (F.col("qty") < 40)  # the others' technology has no area
    tech = F.when(known, F.col("technology")).otherwise(F.concat("technology", F.lit("_none")))
    t["ag_yield"] = (p.groupBy("scenario", "region", tech.alias("technology"), "sector", "yr")
                     .agg(F.max("frac").alias("value"))
                     .select("scenario", "region", "technology", "sector", y, "value"))
    t["ag_use"] = (p.groupBy("scenario", "region", "disposition", "sector", "yr").agg(_sum("qty"))
                   .select("scenario", "region", F.col("disposition").alias("sector"), F.col("sector").alias("input"),
                           y, "value"))
    t["an_use"] = (p.filter(animal).groupBy("scenario", "region", "disposition", "sector", "yr").agg(_sum("qty"))
                   .select("scenario", "region", F.col("disposition").alias("sector"), F.col("sector").alias("input"),
                           y, "value"))
    t["imports"] = (p.groupBy("scenario", "region", "sector", "yr").agg(_sum("qty"))
                    .select("scenario", "region", "sector", y, "value"))
    meat = F.col("sector") == "MEDIUM"
    lower = F.lower(F.col("sector"))
    t["exports"] = (p.select(
        "scenario", "yr", "qty",
        F.when(meat, F.col("region")).otherwise(F.lit("GLOBAL")).alias("region"),
        F.when(meat, F.lit("Exports_M")).otherwise(F.concat(F.lit("traded "), lower)).alias("x_sector"),
        F.when(meat, F.lit("medium")).otherwise(F.concat(F.col("region"), F.lit(" traded "), lower)).alias("subsector"))
        .groupBy("scenario", "region", "x_sector", "subsector", "yr").agg(_sum("qty"))
        .select("scenario", "region", F.col("x_sector").alias("sector"), "subsector", y, "value"))
    t["fertilizer"] = (p.groupBy("scenario", "region", "sector", "yr").agg(_sum("frac"))
                       .select("scenario", "region", "sector", y, "value"))
    t["water"] = t["imports"]
    t["food"] = (p.filter(F.col("disposition") == "food_use").groupBy("scenario", "region", "sector", "yr")
                 .agg(_sum("qty")).select("scenario", "region", F.col("sector").alias("subsector"), y, "value"))
    t["emissions"] = (p.filter(F.col("ghg").isNotNull()).groupBy("scenario", "region", "sector", "ghg", "yr")
                      .agg(_sum("qty")).select("scenario", "region", "sector", "ghg", y, "value"))
    t["luc_emissions"] = (p.filter(F.col("ghg").isNull()).groupBy("scenario", "region", "yr").agg(_sum("qty"))
                          .select("scenario", "region", y, "value"))
    t["feed"] = (p.filter(animal).groupBy("scenario", "region", "sector", "disposition", "yr").agg(_sum("price"))
                 .select("scenario", "region", "sector", F.col("disposition").alias("input"), y, "value"))
    # scenario A has land-use prices only, which the report does not take
    luc = (F.col("disposition") == "outside") | (F.col("scenario") == "A")
    t["co2_prices"] = (p.withColumn("market", F.when(luc, "global_LUC").otherwise("global"))
                       .groupBy("scenario", "market", "yr").agg(F.max("frac").alias("value"))
                       .select("scenario", "market", y, "value"))
    return t


QUERY_NAMES = ("population", "pop_qty", "gdp", "land_cover", "harvests", "ag_prod", "an_prod", "ag_prices",
               "an_prices", "ag_yield", "ag_use", "an_use", "imports", "exports", "fertilizer", "water", "food",
               "emissions", "luc_emissions", "feed", "co2_prices")


def project(spark: SparkSession, sf_dir: str) -> Project:
    """The stand-in project as lazy tables (no materialization)."""
    return Project(query_tables(spark, sf_dir), PANEL_YEARS)


def region_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide: nation, 'G<key mod 7>', its region name (none for MIDDLE EAST), 'WLD'; nation 24 left out."""
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    return (n.filter(F.col("n_nationkey") != 24).join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("n_name").alias("region"),
                    F.concat(F.lit("G"), (F.col("n_nationkey") % 7).cast("string")).alias("Region1"),
                    F.when(F.col("r_name") != "MIDDLE EAST", F.col("r_name")).alias("Region2"),
                    F.lit("WLD").alias("Region3")))


def region_bridge(spark: SparkSession, sf_dir: str) -> Bridge:
    wide = region_map(spark, sf_dir)
    return bridge_from_long(long_bridge(wide, "region", "report_region"), "region", "report_region")


def item_bridge(spark: SparkSession, keep_null_keys: bool = True) -> Bridge:
    cols = ["commodity_key", "traded_commodity", "regional_commodity", "Item1", "Item2", "Item3", "Item4"]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
    wide = local_table(spark, ITEM_BRIDGE_WIDE, schema)
    long = alias_bridge(wide, cols[:3], cols[3:], keep_null_keys=keep_null_keys)
    return Bridge(prove_bound(long), "commodity_key", "Item")


def waste_surface(spark: SparkSession, sf_dir: str) -> Small:
    cls = ["AFR_w", "AMR_w", "ASA_w", "EUR_w", "EMR_w"]
    schema = T.StructType([T.StructField("commodity", T.StringType())]
                          + [T.StructField(c, T.StringType()) for c in cls])
    fr = local_table(spark, WASTE_FRACTIONS, schema)
    fr = fr.select("commodity", *[F.col(c).cast("decimal(4,2)").alias(c) for c in cls])
    rc = local_table(spark, WASTE_REGION_CLASS, "r_name string, food_waste_region string")
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    regions = (n.join(r, n.n_regionkey == r.r_regionkey).join(rc, "r_name")
               .select(F.col("n_name").alias("region"), "food_waste_region"))
    commodities = local_table(spark, WASTE_COMMODITY_CLASS, "commodity_key string, commodity string")
    return prove_bound(attribute_surface(fr, "commodity", regions, commodities))


def pairs(spark: SparkSession) -> Small:
    return prove_bound(local_table(spark, BASELINE_PAIRS, "CC_Scenario string, NoCC_Scenario string"))


def bridges(spark: SparkSession, sf_dir: str, cfg: ReportConfig | None = None, *, waste: bool = True) -> Bridges:
    cfg = cfg or standin_config()
    return Bridges(
        region=region_bridge(spark, sf_dir),
        item=item_bridge(spark, keep_null_keys=cfg.parity),
        land=bridge_from_rows(spark, LAND_BRIDGE, "land_type", "Item"),
        demand=bridge_from_rows(spark, DEMAND_BRIDGE, "sector", "Variable"),
        pairs=pairs(spark),
        waste=waste_surface(spark, sf_dir) if waste else None,
    )


_ROOTS: dict[tuple[str, str], str] = {}
_DONE = "_panelrep_complete"
_BUILD_LOCK = threading.Lock()  # one project build at a time per process


def _fs_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def _fs_touch(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.create(p, True).close()


@dataclass
class StandIn:
    """Everything a stand-in query needs, built from one test-data folder.

    The panel and the query tables are written once, as a model project is
    stored in practice: ``<root>/panel`` and ``<root>/query=<name>/``
    under the shared ``spark.checkpoint.dir`` (written tables cut the lineage
    of the panel join).  A query table is written, whole, when a query first
    reads it; :attr:`project` has them all.  What is written is found again by
    later sessions of the same process.  The panel is written for queries that
    read it several times over; those that read each row of it once or twice,
    and few columns, take :attr:`rows`.
    """

    spark: SparkSession
    sf_dir: str

    def __post_init__(self):
        self.cfg = standin_config()
        self._bridges: Bridges | None = None
        self._opened: dict[tuple[str, ...], Project] = {}
        self._stored: set[str] = set()
        self.project_root: str | None = None

    @property
    def br(self) -> Bridges:
        if self._bridges is None:
            self._bridges = bridges(self.spark, self.sf_dir, self.cfg)
        return self._bridges

    @property
    def safe_br(self) -> Bridges:
        """Bridges for ``parity=False``: the item bridge without null spellings."""
        b = self.br
        return Bridges(region=b.region, item=item_bridge(self.spark, keep_null_keys=False), land=b.land,
                       demand=b.demand, pairs=b.pairs, waste=b.waste)

    def _key(self) -> tuple[str, str]:
        return self.sf_dir, ensure_checkpoint_dir(self.spark).rstrip("/")

    def _written(self) -> str | None:
        """The project's folder where its panel is written already."""
        root = _ROOTS.get(self._key())
        return root if root is not None and _fs_exists(self.spark, f"{root}/{_DONE}") else None

    def _root(self) -> str:
        with _BUILD_LOCK:
            return self._root_locked()

    def _root_locked(self) -> str:
        if self.project_root is None:
            root = self._written()
            if root is None:
                root = scratch_folder(self.spark, "panelrep-project")
                panel(self.spark, self.sf_dir).write.mode("overwrite").parquet(f"{root}/panel")
                _fs_touch(self.spark, f"{root}/{_DONE}")
                _ROOTS[self._key()] = root
            self.project_root = root
        return self.project_root

    @property
    def panel(self) -> DataFrame:
        return self.spark.read.parquet(f"{self._root()}/panel")

    @property
    def rows(self) -> DataFrame:
        """The panel's rows without writing them first: as stored if they are, else as the join, for the columns read."""
        with _BUILD_LOCK:
            root = self._written()
        return panel(self.spark, self.sf_dir) if root is None else self.spark.read.parquet(f"{root}/panel")

    def store(self, *names: str) -> str:
        """Stores those of the query tables that the project lacks, in one commit; the project's folder."""
        with _BUILD_LOCK:
            root = self._root_locked()
            if not self._stored.issuperset(names):
                have = store.snapshot(self.spark, root) or store.Snapshot()
                written = query_tables(self.spark, self.sf_dir, self.spark.read.parquet(f"{root}/panel"))
                write_project({n: written[n] for n in names if n not in have.schemas}, root)
                self._stored.update(names)
        return root

    def opened(self, *names: str) -> Project:
        """The project with these query tables only."""
        if names not in self._opened:
            self._opened[names] = Project.from_parquet(self.spark, self.store(*names), PANEL_YEARS, names=names)
        return self._opened[names]

    @property
    def project(self) -> Project:
        return self.opened(*QUERY_NAMES)

    @property
    def tables(self) -> dict[str, DataFrame]:
        return {name: self.project.raw(name) for name in QUERY_NAMES}

    def t(self, name: str) -> DataFrame:
        return self.opened(name).table(name)
