"""Producer prices XPRP (base-year production weights) and the carbon price CTAX."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import config as C
from ...config import ReportConfig
from ...functions.nullmath import contains_or_false, ieee_div
from ...operators.bounded import Small
from ...operators.panel import attach_grid, base_year_rows, densify, grouped_sum, union_all
from ...operators.template import conform, convert_by_category, scaled
from .common import KEYS, Bridges, FirstYears, by_item, by_region, left_join_on, only, rollup
from .production import ag_prod_df, an_prod_df

BASE_KEYS = ["Scenario", "region", "sector"]


def _base_revenue(base: DataFrame, prices: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Base-year production per (Scenario, region, sector), joined to every price year.

    Production is summed to the price grain *before* the join: revenue
    ``Σ_t prod_t x price = price x Σ_t prod_t``, so the join sees one row per
    key instead of one per technology.
    """
    w = grouped_sum(base, BASE_KEYS, ["value"], strict=cfg.strict, exact=cfg.exact_sums) \
        .withColumnRenamed("value", "prod")
    p = prices.drop("Units").select(*BASE_KEYS, "Year", F.col("value").alias("price"))
    joined = left_join_on(w, p, BASE_KEYS, how=cfg.weight_join, match_nulls=cfg.parity)
    return joined.withColumn("revenue", F.col("prod") * F.col("price")).drop("price")


def xprp(ag_prod: DataFrame, an_prod_tbl: DataFrame, ag_prices: DataFrame, an_prices: DataFrame,
         br: Bridges, cfg: ReportConfig, first: FirstYears | None = None) -> DataFrame:
    """Price index; ``first`` has the first years of ``ag_prod`` and ``an_prod`` where they are known."""
    first = first or {}
    per = ["Scenario"] if cfg.per_scenario_base else None
    crops = ag_prod_df(ag_prod, cfg)
    override = (F.col("sector") == cfg.biomass_sector) & (F.col("Year") == cfg.biomass_weight_year)
    crop_base = base_year_rows(crops, override=override, per=per, first=first.get("ag_prod"))
    crop_base = crop_base.withColumn("value", convert_by_category("value", "sector", cfg.biomass_sector,
                                                                  C.CONV_BIO_EJ_TO_MT, 1))
    animal_base = base_year_rows(an_prod_df(an_prod_tbl), per=per, first=first.get("an_prod"))
    both = union_all([_base_revenue(crop_base, ag_prices, cfg), _base_revenue(animal_base, an_prices, cfg)])
    s = rollup(both, KEYS, ["revenue", "prod"],
               [by_item(only(br.item, cfg.price_items), "sector", "inner"), by_region(br)], cfg)
    value = scaled(ieee_div("revenue", "prod"), C.CONV_KG_T, C.CONV_1975_2010_USD)
    return conform(s.withColumn("Value", value), Model=cfg.model, Variable="XPRP", Unit="USD/t")


def ctax(co2_prices: DataFrame | None, scenarios: Small, br: Bridges, cfg: ReportConfig) -> DataFrame | None:
    """Distinct non-LUC carbon prices, 0 for scenarios without one, repeated over regions.

    ``scenarios`` are the scenarios to report (those of POPT); absent price
    table gives ``None`` (the indicator is skipped).
    """
    return None if co2_prices is None else ctax_grid(observed_prices(co2_prices), scenarios, br, cfg)


def observed_prices(co2_prices: DataFrame) -> DataFrame:
    return (co2_prices.filter(~contains_or_false("market", C.LUC_MARKER))
            .select("Scenario", "Year", "value").distinct())


def ctax_grid(prices: DataFrame, scenarios: Small, br: Bridges, cfg: ReportConfig) -> DataFrame:
    """CTAX from the prices that were observed, which may come from several runs."""
    grid = densify(prices, ["Year"], {"Scenario": scenarios}, {"value": 0})
    regions = br.region.values().map_df(lambda d: d.select(F.col(br.region.value).alias("Region")))
    out = attach_grid(grid, regions)
    value = scaled("value", C.CONV_1990_2010_USD) / F.lit(C.CONV_C_TO_CO2)
    return conform(out.withColumn("Value", value), Model=cfg.model, Variable="CTAX", Unit="USD/tCO2e", Item="TOT")


def report_scenarios(population: DataFrame) -> Small:
    """Scenarios of the population table (= those of POPT), however many there are.

    Read from the population facts rather than the finished POPT indicator,
    so this is one cheap distinct (a partition column in the stored
    project) and does not run the region roll-up twice.
    """
    return Small(population.select("Scenario").distinct())
