"""Named queries over the stand-in project: one per operator / indicator.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame built from
the library's operators and recipes.  Queries read the whole input tables;
nothing is sampled or capped.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nullmath import strict_sum
from ..functions.text import split_key
from ..operators.colocated import bucketed
from ..operators.longlist import in_list
from ..operators.panel import (Via, base_year_rows, expand, expand_and_sum, finish_sum, group_share, heavy_hitters,
                               union_all)
from ..operators.template import conform, convert_by_category
from ..operators.units import converted, factor_table, label_categories
from ..session import scratch_folder
from ..sources import store
from ..sources.bridges import read_map_csv, region_bridge_csv
from ..sources.facts import Project, ingest_no_clobber, normalize, read_table, write_project
from ..sources.sinks import joined_lines, study_subset, study_table, write_ordered_csv, write_studies
from . import standin
from .recipes import emissions, feed, food, land, prices, production, totals, trade, yields
from .recipes.common import KEYS
from .incremental import read_updated, update_report
from .report import REPORTED, build_indicators, final_template, read_report, write_report

_CACHE: dict[str, standin.StandIn] = {}


def stand_in(spark: SparkSession, sf_dir: str, *tables: str) -> standin.StandIn:
    """The stand-in project of a folder, with ``tables`` stored in one go; another session gets one of its own."""
    held = _CACHE.get(sf_dir)
    if held is None or held.spark is not spark:
        held = _CACHE[sf_dir] = standin.StandIn(spark, sf_dir)
    if tables:
        held.store(*tables)
    return held


def _raw(df: DataFrame, value: str = "value") -> DataFrame:
    return df.withColumn(value, F.col(value).cast("double"))


# ---------------------------------------------------------------- sources
def panel_scan(spark, d):
    S = stand_in(spark, d)
    return _raw(S.t("ag_prod"))


def bridge_region(spark, d):
    return stand_in(spark, d).br.region.df


def _part_keys(spark, d):
    p = standin.read(spark, d, "part")
    sector = F.when(F.col("p_brand") == "Brand#25", "unlisted").otherwise(F.col("p_type"))
    disp = (F.when(F.col("p_size") <= 20, "food_use").when(F.col("p_size") <= 35, "feed_use")
            .when(F.col("p_size") <= 45, "other_use").otherwise("outside"))
    return p.select(sector.alias("sector"), disp.alias("disposition"))


def bridge_item(spark, d):
    """Every commodity present in ``part`` with its reporting items (alias bridge, R2 + J2)."""
    S = stand_in(spark, d)
    keys = _part_keys(spark, d).select("sector").distinct()
    out = expand(keys, Via(S.br.item, "sector", "left", "Item"), match_nulls=S.cfg.parity)
    return out.select(F.col("sector").alias("commodity_key"), "Item")


def bridge_land(spark, d):
    """Every land leaf of the land cover, split to its land type and mapped (R4 + J4)."""
    S = stand_in(spark, d)
    leaves = S.t("land_cover").select("landleaf").distinct()
    leaves = leaves.withColumn("land_type", split_key("landleaf", 1)[0])
    return expand(leaves, Via(S.br.land, "land_type", "left", "Item")).select("landleaf", "land_type", "Item")


def bridge_disposition(spark, d):
    """Every disposition present in ``part`` with its reporting variables (R1 + J5)."""
    S = stand_in(spark, d)
    keys = _part_keys(spark, d).select("disposition").distinct()
    out = expand(keys, Via(S.br.demand, "disposition", "left", "Variable"))
    return out.select(F.col("disposition").alias("sector"), "Variable")


def attribute_surface(spark, d):
    return stand_in(spark, d).br.waste.df.withColumn("waste_frac", F.col("waste_frac").cast("double"))


def split_key_q(spark, d):
    S = stand_in(spark, d)
    keys = (S.opened("ag_prod").raw("ag_prod").select(F.col("technology").alias("key"))
            .union(standin.read(spark, d, "part").select(F.col("p_name").alias("key"))).distinct())
    parts = split_key("key", 4)
    return keys.select("key", *[p.alias(f"part{i + 1}") for i, p in enumerate(parts)])


def stack_scenarios_q(spark, d):
    """Scenarios stored one after another, one of them without a column, read as one table."""
    p = stand_in(spark, d).rows
    cols = [F.col("scenario"), F.col("region"), F.col("sector"), F.col("yr").alias("year"),
            F.col("qty").cast("double").alias("value")]
    root = scratch_folder(spark, "panelrep-stacked")
    for name, df in (("R", p.select(*cols).drop("sector")), ("A", p.select(*cols)), ("N", p.select(*cols))):
        ingest_no_clobber(spark, df.filter(F.col("scenario") == name), root, "panel")
    return read_table(spark, root, "panel")


def ingest_no_clobber_q(spark, d):
    p = stand_in(spark, d).rows
    cols = ["scenario", "region", F.col("yr").alias("year"), F.col("qty").cast("double").alias("value")]
    root = scratch_folder(spark, "panelrep-ingest")
    ingest_no_clobber(spark, p.filter(F.col("scenario") == "N").select(*cols), root, "panel")
    added = ingest_no_clobber(spark, p.select(*cols), root, "panel")
    return store.read(spark, root, "panel", store.snapshot(spark, root), added).select("scenario", "region", "year", "value")


def ingest_two_writers(spark, d):
    """A project after one ingest that stopped before its commit and two that overlapped (S4): every scenario whole, once.

    The writer that comes second brings other values for a scenario that is stored by then; they are left out.
    """
    p = stand_in(spark, d).rows.select("scenario", "region", F.col("yr").alias("year"),
                                       F.col("qty").cast("double").alias("value"))
    root, other = scratch_folder(spark, "panelrep-writers"), p.withColumn("value", -F.col("value"))
    store.Ingest(spark, root).add("panel", other)  # never committed
    first, second = store.Ingest(spark, root), store.Ingest(spark, root)
    second.add("panel", other.filter(F.col("scenario") == "A").unionByName(p.filter(F.col("scenario") != "A")))
    first.add("panel", p.filter(F.col("scenario") == "A"))
    first.commit()
    second.commit()
    return read_table(spark, root, "panel")


def per_scenario_base(spark, d):
    """Base-year rows where every scenario has a first year of its own, told by the manifest."""
    S = stand_in(spark, d)
    later = F.when(F.col("scenario") == "N", 2).when(F.col("scenario") == "R", 4).otherwise(0)
    facts = (S.panel.groupBy("scenario", "region", "sector", (F.col("yr") + later).alias("year"))
             .agg(F.sum("qty").cast(standin.DEC).alias("value")))
    root = scratch_folder(spark, "panelrep-base")
    write_project({"ag_prod": facts}, root)
    p = Project.from_parquet(spark, root, S.cfg.years, names=["ag_prod"])
    return _raw(base_year_rows(p.table("ag_prod"), per=["Scenario"], first=p.first_years["ag_prod"])) \
        .select("Scenario", "region", "sector", "Year", "value")


def study_subset_q(spark, d):
    S = stand_in(spark, d)
    popt = totals.popt(S.t("population"), S.br, S.cfg)
    return study_subset(popt, study_table(spark, S.cfg.studies))


def _region_file(spark, d, missing: str) -> str:
    """The region map as a CSV file below a scratch folder, with ``missing`` where a nation has no second region."""
    root = scratch_folder(spark, "panelrep-maps")
    wide = standin.region_map(spark, d).withColumn("Region2", F.coalesce("Region2", F.lit(missing)))
    wide.write.option("header", True).option("emptyValue", "").csv(f"{root}/regions")
    return f"{root}/regions"


def map_blank(spark, d):
    """A map file with blank fields, which are null, and its long form."""
    path = _region_file(spark, d, "")
    wide, long = read_map_csv(spark, path), region_bridge_csv(spark, path)
    slots = long.df.groupBy("region").agg(F.count(F.lit(1)).alias("regions"))
    return wide.join(slots, "region", "left")


def map_na(spark, d):
    """A map file in which ``NA`` is null for one reader and text for the other."""
    path = _region_file(spark, d, "NA")
    text = read_map_csv(spark, path).select("region", F.col("Region2").alias("as_text"))
    return text.join(read_map_csv(spark, path, na_text=True).select("region", F.col("Region2").alias("as_null")), "region")


def optional_source(spark, d):
    """Rows of POPT and CTAX of a project with the optional price table and of one without it."""
    S = stand_in(spark, d)
    root = scratch_folder(spark, "panelrep-optional")
    stored = S.opened("population", "co2_prices")
    write_project({n: stored.raw(n) for n in ("population",)}, root)
    out = []
    for name, p in (("full", stored), ("without", Project.from_parquet(
            spark, root, S.cfg.years, names=["population", "co2_prices"]))):
        found = {"POPT": totals.popt(p.table("population"), S.br, S.cfg),
                 "CTAX": prices.ctax(p.table("co2_prices"), prices.report_scenarios(p.table("population")), S.br, S.cfg)}
        out += [df.select(F.lit(name).alias("project"), "Variable") for df in found.values() if df is not None]
    return union_all(out).groupBy("project", "Variable").agg(F.count(F.lit(1)).alias("rows"))


def template_csv(spark, d):
    """The report's CSV, written in order by many tasks, as the lines of its joined parts."""
    S = stand_in(spark, d, "population", "gdp")
    df = union_all([totals.popt(S.t("population"), S.br, S.cfg), totals.gdpt(S.t("gdp"), S.br, S.cfg)])
    path = f"{scratch_folder(spark, 'panelrep-csv')}/template"
    write_ordered_csv(df, path, [F.array_position(F.lit(list(REPORTED)), F.col("Variable")), *df.columns])
    return joined_lines(spark, path)


def study_files(spark, d):
    """Study subsets in folders named by run date and prefix, and the lines in each."""
    S = stand_in(spark, d)
    popt = totals.popt(S.t("population"), S.br, S.cfg)
    prefixes = {s: f"{S.cfg.model}_{s.upper()}_ALL" for s in S.cfg.studies}
    out = write_studies(popt, study_table(spark, S.cfg.studies), scratch_folder(spark, "panelrep-studies"), prefixes,
                        run_date=dt.date(2021, 3, 4))
    lines = spark.read.option("basePath", out.rsplit("/", 1)[0]).option("header", True).csv(out)
    return lines.groupBy(F.col("run_date").cast("string").alias("run_date"), "study").agg(
        F.count(F.lit(1)).alias("lines"), F.countDistinct("Scenario").alias("scenarios"))


def report_incremental(spark, d):
    """The whole report over two scenarios, then brought up to date with the third."""
    S = stand_in(spark, d)
    S.project
    root = scratch_folder(spark, "panelrep-updated")
    for scenarios in (("N", "R"), None):
        update_report(spark, S.project_root, S.br, S.cfg, root, scenarios)
    return read_updated(spark, S.project_root, S.br, S.cfg, root)


# ---------------------------------------------------------------- sums and conversions
def strict_sum_q(spark, d):
    p = stand_in(spark, d).rows
    v = F.when(F.col("sector") == "unlisted", F.lit(None)).otherwise(F.col("frac"))
    return (p.groupBy(F.col("scenario").alias("Scenario"), "region", "sector")
            .agg(strict_sum(v).cast("double").alias("value")))


def skip_sum(spark, d):
    """Strict and null-skipping sums side by side over groups that mix nulls and values."""
    p = stand_in(spark, d).rows
    v = F.when(F.col("sector") == "unlisted", F.lit(None)).otherwise(F.col("frac"))
    g = p.withColumn("v", v).groupBy(F.col("scenario").alias("Scenario"), "region")
    return g.agg(strict_sum("v").cast("double").alias("strict_value"), F.sum("v").cast("double").alias("skip_value"))


def rollup_total(spark, d):
    S = stand_in(spark, d)
    return totals.popt(S.t("pop_qty"), S.br, S.cfg)


def rollup_total_scaled(spark, d):
    S = stand_in(spark, d)
    return totals.gdpt(S.t("gdp"), S.br, S.cfg)


def rollup_population(spark, d):
    S = stand_in(spark, d)
    return totals.popt(S.t("population"), S.br, S.cfg)


def rollup_items(spark, d):
    S = stand_in(spark, d)
    return conform(production.an_prod(S.t("an_prod"), S.br, S.cfg))


def rollup_items_listed(spark, d):
    S = stand_in(spark, d)
    state = production.crop_state(production.ag_prod_df(S.t("ag_prod"), S.cfg), S.br, S.cfg)
    s = finish_sum(state, KEYS, ["value"]).withColumnRenamed("value", "Value")
    return conform(s, Model=S.cfg.model, Variable="PROD", Unit="1000 t")


def _unlisted_as_null(df: DataFrame) -> DataFrame:
    return df.withColumn("sector", F.when(F.col("sector") != "unlisted", F.col("sector")))


def convert_by_sector(spark, d):
    S = stand_in(spark, d)
    df = _unlisted_as_null(S.t("ag_prod"))
    v = convert_by_category("value", "sector", S.cfg.biomass_sector, 57100, 1000)
    return df.withColumn("value", v.cast("double"))


def null_key_fanout(spark, d):
    S = stand_in(spark, d)
    df = _unlisted_as_null(S.t("ag_prod")).filter(F.col("sector").isNull())
    s = expand_and_sum(df, ["Scenario", "Item"], ["value"], [Via(S.br.item, "sector", "inner", "Item")],
                       match_nulls=True)
    return s.withColumn("value", F.col("value").cast("double"))


def convert_by_pattern(spark, d):
    S = stand_in(spark, d, "emissions", "luc_emissions")
    return emissions.emis(S.t("emissions"), S.t("luc_emissions"), S.br, S.cfg)


# ---------------------------------------------------------------- land and production
def _bucketed(spark, S):
    """Harvests, land cover and yields bucketed by scenario, region and leaf."""
    root = scratch_folder(spark, "panelrep-bucketed")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return [bucketed(S.t(name), ["Scenario", "region", leaf], n, root)
            for name, leaf in (("harvests", "technology"), ("land_cover", "landleaf"), ("ag_yield", "technology"))]


def area_colocated(spark, d):
    """AREA over bucketed facts: the harvest x land join shuffles nothing."""
    S = stand_in(spark, d, "harvests", "land_cover", "ag_yield")
    harvests, cover, _ = _bucketed(spark, S)
    return land.areas(land.harvested_area_df(harvests, land.land_df(cover)), S.br, S.cfg)["AREA"]


def exog_yield_colocated(spark, d):
    """YEXO over bucketed facts: both fact-fact joins shuffle nothing."""
    S = stand_in(spark, d, "harvests", "land_cover", "ag_yield")
    harvests, cover, ag_yield = _bucketed(spark, S)
    return yields.yexo(land.harvested_area_df(harvests, land.land_df(cover)), ag_yield, S.br, S.cfg,
                       S.opened("harvests").first_years)


def long_list(spark, d):
    """Line items of the orders in a list of 100,000 names, by a bloom filter and a semi join."""
    names = spark.range(100_000).select(F.concat(F.lit("order "), (F.col("id") * 3).cast("string")).alias("name"))
    li = standin.read(spark, d, "lineitem").select(
        F.concat(F.lit("order "), F.col("l_orderkey").cast("string")).alias("order_name"), "l_returnflag", "l_quantity")
    return in_list(li, "order_name", names, "name").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("l_quantity").cast(standin.DEC)).cast("double").alias("quantity"))


#: Units of the stand-in's sectors and gases and the factors between them, as a study would keep them in a file.
UNIT_FACTORS = [("LARGE", "EJ", "Mt", Decimal("57.1")), (None, "Mt", "kt", Decimal(1000)),
                ("CH4", "Mt gas", "MtCO2e", Decimal(28)), ("N2O", "Mt gas", "MtCO2e", Decimal(298)),
                ("C", "Mt gas", "MtCO2e", Decimal(repr(44 / 12)))]


def unit_graph(spark, d):
    """Totals of convert_by_sector and convert_by_pattern from one factor table."""
    S = stand_in(spark, d, "ag_prod", "emissions", "luc_emissions")
    crops = _unlisted_as_null(S.t("ag_prod")) \
        .withColumn("unit", F.when(F.col("sector") == S.cfg.biomass_sector, "EJ").otherwise("Mt"))
    crops = converted(crops, "value", "unit", "sector", factor_table(spark, UNIT_FACTORS, "kt"))
    gases = S.t("emissions").filter(F.col("ghg").isin(list(S.cfg.emis_ghgs))).select("Scenario", "ghg", "Year", "value") \
        .unionByName(S.t("luc_emissions").select("Scenario", F.lit("CO2").alias("ghg"), "Year", "value"))
    kinds = label_categories(gases, "ghg", [("N2O", "N2O"), ("CH4", "CH4")], "C")
    gases = gases.join(kinds, "ghg").withColumn("unit", F.lit("Mt gas"))
    gases = converted(gases, "value", "unit", "category", factor_table(spark, UNIT_FACTORS, "MtCO2e"))
    return union_all([df.groupBy("Scenario", "Year").agg(strict_or_skip("value").cast("double").alias("value"))
                      .select(F.lit(name).alias("measure"), "Scenario", "Year", "value")
                      for name, df, strict_or_skip in (("production", crops, F.sum), ("emissions", gases, strict_sum))])


def land_cover(spark, d):
    S = stand_in(spark, d)
    return land.land(S.t("land_cover"), S.br, S.cfg)


def _areas(S):
    harvested = land.harvested_area_df(S.t("harvests"), land.land_df(S.t("land_cover")))
    return land.areas(harvested, S.br, S.cfg)


def area_rollup(spark, d):
    return _areas(stand_in(spark, d, "harvests", "land_cover"))["AREA"]


def area_rainfed(spark, d):
    return _areas(stand_in(spark, d, "harvests", "land_cover"))["ARRF"]


def area_irrigated(spark, d):
    return _areas(stand_in(spark, d, "harvests", "land_cover"))["ARIR"]


def production_union(spark, d):
    S = stand_in(spark, d, "ag_prod", "an_prod")
    return production.prod(S.t("ag_prod"), S.t("an_prod"), S.br, S.cfg)


def densify_years(spark, d):
    S = stand_in(spark, d)
    return conform(production.ag_prod_variants(S.t("ag_prod"), S.br, S.cfg)["AG_PROD"])


def _ratio(S, area_key, prod_key, fn):
    ag = production.ag_prod_variants(S.t("ag_prod"), S.br, S.cfg)
    return fn(_areas(S)[area_key], ag[prod_key])


def ratio_yield(spark, d):
    return _ratio(stand_in(spark, d, "harvests", "land_cover", "ag_prod"), "AREA", "AG_PROD", yields.yild)


def ratio_yield_irrigated(spark, d):
    return _ratio(stand_in(spark, d, "harvests", "land_cover", "ag_prod"), "ARIR", "AG_PROD_IR", yields.yiir)


def ratio_yield_rainfed(spark, d):
    return _ratio(stand_in(spark, d, "harvests", "land_cover", "ag_prod"), "ARRF", "AG_PROD_RF", yields.yirf)


def base_year_rows_q(spark, d):
    S = stand_in(spark, d)
    return _raw(base_year_rows(S.t("ag_prod")))


def base_year_override(spark, d):
    S = stand_in(spark, d)
    cond = (F.col("sector") == S.cfg.biomass_sector) & (F.col("Year") == S.cfg.biomass_weight_year)
    return _raw(base_year_rows(S.t("ag_prod"), override=cond))


def price_index(spark, d):
    S = stand_in(spark, d, "ag_prod", "an_prod", "ag_prices", "an_prices")
    return prices.xprp(S.t("ag_prod"), S.t("an_prod"), S.t("ag_prices"), S.t("an_prices"), S.br, S.cfg,
                       S.opened("ag_prod", "an_prod").first_years)


def exog_yield_index(spark, d):
    S = stand_in(spark, d, "harvests", "land_cover", "ag_yield")
    harvested = land.harvested_area_df(S.t("harvests"), land.land_df(S.t("land_cover")))
    return yields.yexo(harvested, S.t("ag_yield"), S.br, S.cfg, S.opened("harvests").first_years)


def price_index_safe(spark, d):
    """XPRP with the safe defaults: no null bridge keys, weights without a price dropped."""
    S = stand_in(spark, d, "ag_prod", "an_prod", "ag_prices", "an_prices")
    return prices.xprp(S.t("ag_prod"), S.t("an_prod"), S.t("ag_prices"), S.t("an_prices"), S.safe_br,
                       S.cfg.with_(parity=False), S.opened("ag_prod", "an_prod").first_years)


def exog_yield_index_safe(spark, d):
    """YEXO with the safe defaults: no null-key fan-out, areas without a yield dropped."""
    S = stand_in(spark, d, "harvests", "land_cover", "ag_yield")
    harvested = land.harvested_area_df(S.t("harvests"), land.land_df(S.t("land_cover")))
    return yields.yexo(harvested, S.t("ag_yield"), S.safe_br, S.cfg.with_(parity=False),
                       S.opened("harvests").first_years)


def per_capita_net_waste_skip(spark, d):
    """CALI with ``null_policy='skip'``: rows without a waste fraction drop out of the sum
    instead of nulling their group."""
    S = stand_in(spark, d, "food", "population")
    cfg = S.cfg.with_(null_policy="skip")
    return food.cali(S.t("food"), totals.popt(S.t("population"), S.br, cfg), S.br, cfg)


def rollup_items_mapped(spark, d):
    """Animal production without the unmapped (null Item) group."""
    S = stand_in(spark, d)
    return conform(production.an_prod(S.t("an_prod"), S.br, S.cfg.with_(drop_unmapped=True)))


def baseline_shift(spark, d):
    S = stand_in(spark, d)
    return yields.yecc(exog_yield_index(spark, d), S.br)


# ---------------------------------------------------------------- demand, trade, inputs
def disposition(spark, d):
    S = stand_in(spark, d, "ag_use", "an_use")
    return food.demand(S.t("ag_use"), S.t("an_use"), S.br, S.cfg)


def trade_imports(spark, d):
    S = stand_in(spark, d)
    return trade.impo(S.t("imports"), S.br, S.cfg)


def trade_exports(spark, d):
    S = stand_in(spark, d)
    return trade.expo(S.t("exports"), S.br, S.cfg)


def net_trade(spark, d):
    S = stand_in(spark, d, "exports", "imports")
    return trade.nett(trade.expo(S.t("exports"), S.br, S.cfg), trade.impo(S.t("imports"), S.br, S.cfg))


def inputs_densified(spark, d):
    S = stand_in(spark, d)
    return trade.frtn(S.t("fertilizer"), S.br, S.cfg)


def inputs_densified_keep_null(spark, d):
    S = stand_in(spark, d)
    return trade.watr(S.t("water"), S.br, S.cfg)


def densify_items(spark, d):
    """Imports recipe over regions that hold large lines only, so that grid cells are missing."""
    S = stand_in(spark, d)
    p = S.panel.withColumn("region", F.when(F.col("qty") > 45, F.col("region")).otherwise("elsewhere"))
    sparse = (p.groupBy("scenario", "region", "sector", "yr").agg(F.sum("qty").cast(standin.DEC).alias("value"))
              .select("scenario", "region", "sector", F.col("yr").alias("year"), "value"))
    return trade.impo(normalize(sparse, S.cfg.years), S.br, S.cfg)


def densify_observed(spark, d):
    S = stand_in(spark, d)
    return emissions.ech4(S.t("emissions"), S.br, S.cfg)


def densify_observed_2(spark, d):
    S = stand_in(spark, d)
    return emissions.en2o(S.t("emissions"), S.br, S.cfg)


def per_capita(spark, d):
    S = stand_in(spark, d, "food", "population")
    return food.calo(S.t("food"), totals.popt(S.t("population"), S.br, S.cfg), S.br, S.cfg)


def per_capita_net_waste(spark, d):
    S = stand_in(spark, d, "food", "population")
    return food.cali(S.t("food"), totals.popt(S.t("population"), S.br, S.cfg), S.br, S.cfg)


def union_missing_cols(spark, d):
    S = stand_in(spark, d, "emissions", "luc_emissions")
    return emissions.eco2(S.t("emissions"), S.t("luc_emissions"), S.br, S.cfg)


# ---------------------------------------------------------------- feed and shares
def feed_efficiency(spark, d):
    S = stand_in(spark, d, "an_prod", "feed")
    an = production.an_prod(S.t("an_prod"), S.br, S.cfg)
    return feed.feef(an, feed.feed_inputs(S.t("feed"), S.br, S.cfg))


def group_share_q(spark, d):
    S = stand_in(spark, d)
    g = (S.panel.groupBy(F.col("scenario").alias("Scenario"), "technology", "disposition", F.col("yr").alias("Year"))
         .agg(F.sum("frac").alias("value")))
    s = group_share(g, ["Scenario", "technology", "Year"], "value", target_rows=S.cfg.share_target_rows)
    return s.withColumn("value", F.col("value").cast("double"))


def heavy_groups(spark, d):
    """Sectors and dispositions that hold more than 1 / 40 of all rows, found by a sketch and counted."""
    p = stand_in(spark, d).panel.select("sector", "disposition")
    keys, most = ["sector", "disposition"], 40
    hot = heavy_hitters(p, keys, most).select("key_hash")
    found = p.withColumn("key_hash", F.xxhash64(*keys)).join(F.broadcast(hot), "key_hash") \
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return found.filter(F.col("rows") * most > p.agg(F.count(F.lit(1))).scalar())


def feed_alloc_scaled(spark, d):
    """FRUM, FDRY and FNRM with a factor of their own (Q3)."""
    S = stand_in(spark, d, "feed", "ag_use")
    return feed.feed_alloc(S.t("feed"), S.t("ag_use"), S.br, S.cfg.with_(feed_alloc_factor=1000))


def _feed_alloc(spark, d, variable):
    S = stand_in(spark, d, "feed", "ag_use")
    return feed.feed_alloc(S.t("feed"), S.t("ag_use"), S.br, S.cfg).filter(F.col("Variable") == variable)


def feed_alloc_a(spark, d):
    return _feed_alloc(spark, d, "FRUM")


def feed_alloc_b(spark, d):
    return _feed_alloc(spark, d, "FDRY")


def feed_alloc_c(spark, d):
    return _feed_alloc(spark, d, "FNRM")


def price_grid(spark, d):
    S = stand_in(spark, d, "co2_prices", "population")
    return prices.ctax(S.t("co2_prices"), prices.report_scenarios(S.t("population")), S.br, S.cfg)


def final_template_q(spark, d):
    """The whole report: every indicator written as its own job under the
    shared checkpoint folder, then read back as one template table."""
    S = stand_in(spark, d)
    root = write_report(build_indicators(S.project, S.br, S.cfg), scratch_folder(spark, "panelrep-report"))
    return read_report(spark, root)


def final_template_plan(spark, d):
    """The whole report as one lazy plan (a union of all indicators)."""
    S = stand_in(spark, d)
    return final_template(build_indicators(S.project, S.br, S.cfg))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "panel_scan": panel_scan,
    "bridge_region": bridge_region,
    "bridge_item": bridge_item,
    "bridge_land": bridge_land,
    "bridge_disposition": bridge_disposition,
    "attribute_surface": attribute_surface,
    "split_key": split_key_q,
    "stack_scenarios": stack_scenarios_q,
    "ingest_no_clobber": ingest_no_clobber_q,
    "ingest_two_writers": ingest_two_writers,
    "per_scenario_base": per_scenario_base,
    "study_subset": study_subset_q,
    "map_blank": map_blank,
    "map_na": map_na,
    "optional_source": optional_source,
    "template_csv": template_csv,
    "study_files": study_files,
    "report_incremental": report_incremental,
    "strict_sum": strict_sum_q,
    "skip_sum": skip_sum,
    "rollup_total": rollup_total,
    "rollup_total_scaled": rollup_total_scaled,
    "rollup_population": rollup_population,
    "rollup_items": rollup_items,
    "rollup_items_listed": rollup_items_listed,
    "convert_by_sector": convert_by_sector,
    "null_key_fanout": null_key_fanout,
    "convert_by_pattern": convert_by_pattern,
    "land_cover": land_cover,
    "area_rollup": area_rollup,
    "area_colocated": area_colocated,
    "exog_yield_colocated": exog_yield_colocated,
    "long_list": long_list,
    "unit_graph": unit_graph,
    "area_rainfed": area_rainfed,
    "area_irrigated": area_irrigated,
    "production_union": production_union,
    "densify_years": densify_years,
    "ratio_yield": ratio_yield,
    "ratio_yield_irrigated": ratio_yield_irrigated,
    "ratio_yield_rainfed": ratio_yield_rainfed,
    "base_year_rows": base_year_rows_q,
    "base_year_override": base_year_override,
    "price_index": price_index,
    "exog_yield_index": exog_yield_index,
    "disposition": disposition,
    "trade_imports": trade_imports,
    "trade_exports": trade_exports,
    "net_trade": net_trade,
    "inputs_densified": inputs_densified,
    "inputs_densified_keep_null": inputs_densified_keep_null,
    "densify_items": densify_items,
    "densify_observed": densify_observed,
    "densify_observed_2": densify_observed_2,
    "per_capita": per_capita,
    "per_capita_net_waste": per_capita_net_waste,
    "union_missing_cols": union_missing_cols,
    "feed_efficiency": feed_efficiency,
    "group_share": group_share_q,
    "heavy_groups": heavy_groups,
    "feed_alloc_scaled": feed_alloc_scaled,
    "feed_alloc_a": feed_alloc_a,
    "feed_alloc_b": feed_alloc_b,
    "feed_alloc_c": feed_alloc_c,
    "price_grid": price_grid,
    "baseline_shift": baseline_shift,
    "price_index_safe": price_index_safe,
    "exog_yield_index_safe": exog_yield_index_safe,
    "rollup_items_mapped": rollup_items_mapped,
    "per_capita_net_waste_skip": per_capita_net_waste_skip,
    "final_template": final_template_q,
}
