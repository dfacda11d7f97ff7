"""Indicator recipes under the reference configuration, on hand-computed inputs."""

import math

from pyspark.sql import functions as F

from panelrep.config import ReportConfig
from panelrep.operators.bounded import Small
from panelrep.plans.recipes import emissions, prices, totals, yields
from panelrep.plans.recipes.common import Bridges
from panelrep.sources.bridges import bridge_from_rows
from panelrep.sources.facts import normalize

CFG = ReportConfig()


def _bridges(spark):
    return Bridges(
        region=bridge_from_rows(spark, [("r1", "R1"), ("r1", "WLD"), ("r2", "WLD")], "region", "report_region"),
        item=bridge_from_rows(spark, [("Corn", "CGR"), ("Corn", "AGR"), ("biomass", "ECP")], "commodity_key", "Item"),
        land=bridge_from_rows(spark, [("Corn", "CGR")], "land_type", "Item"),
        demand=bridge_from_rows(spark, [("Food", "FOOD")], "sector", "Variable"),
    )


def _facts(spark, rows, schema):
    return normalize(spark.createDataFrame(rows, schema), CFG.years)


def test_producer_price_uses_base_year_weights_and_biomass_2020(spark):
    br = _bridges(spark)
    prod_schema = "scenario string, region string, sector string, technology string, year int, value double"
    ag = _facts(spark, [("S", "r1", "Corn", "Corn_B1_IRR_hi", 2010, 2.0), ("S", "r1", "Corn", "Corn_B1_IRR_hi", 2020, 3.0),
                        ("S", "r1", "biomass", "biomass_B1_IRR_hi", 2020, 0.5)], prod_schema)
    pr_schema = "scenario string, region string, sector string, year int, value double"
    agp = _facts(spark, [("S", "r1", "Corn", 2010, 0.1), ("S", "r1", "Corn", 2020, 0.2),
                         ("S", "r1", "biomass", 2010, 4.0), ("S", "r1", "biomass", 2020, 5.0)], pr_schema)
    an = _facts(spark, [], "scenario string, region string, sector string, year int, value double")
    anp = _facts(spark, [], pr_schema)
    got = {(r.Region, r.Item, r.Year): r.Value for r in prices.xprp(ag, an, agp, anp, br, CFG).collect()}
    assert len(got) == 12
    for region in ("R1", "WLD"):
        for item in ("CGR", "AGR"):
            assert math.isclose(got[(region, item, 2010)], 0.1 * 1000 * 3.228)
            assert math.isclose(got[(region, item, 2020)], 0.2 * 1000 * 3.228)
        assert math.isclose(got[(region, "ECP", 2010)], 4.0 * 1000 * 3.228)
        assert math.isclose(got[(region, "ECP", 2020)], 5.0 * 1000 * 3.228)


def test_yield_keeps_inf_and_zeroes_nan_and_missing(spark):
    keys = "Model string, Scenario string, Region string, Item string, Variable string, Year int, Unit string"
    area = spark.createDataFrame([("M", "S", "R", "A", "AREA", 2010, "1000 ha", 0.0),
                                  ("M", "S", "R", "B", "AREA", 2010, "1000 ha", 0.0),
                                  ("M", "S", "R", "C", "AREA", 2010, "1000 ha", 4.0),
                                  ("M", "S", "R", "D", "AREA", 2010, "1000 ha", 2.0)], keys + ", Value double")
    prod = spark.createDataFrame([("M", "S", "R", "A", 2010, 5.0), ("M", "S", "R", "B", 2010, 0.0),
                                  ("M", "S", "R", "C", 2010, 2.0)],
                                 "Model string, Scenario string, Region string, Item string, Year int, Value double")
    got = {r.Item: r.Value for r in yields.yild(area, prod).collect()}
    assert got == {"A": math.inf, "B": 0.0, "C": 0.5, "D": 0.0}


def test_population_total_and_unmapped_region(spark):
    br = _bridges(spark)
    pop = _facts(spark, [("S", "r1", 2010, 1000.0), ("S", "r2", 2010, 3000.0), ("S", "r3", 2010, 7.0),
                         ("S", "r1", 2011, 9.0)], "scenario string, region string, year int, value double")
    got = {(r.Region, r.Year): r.Value for r in totals.popt(pop, br, CFG).collect()}
    assert got == {("R1", 2010): 1.0, ("WLD", 2010): 4.0, (None, 2010): 0.007}


def test_emissions_factor_per_gas_and_luc_as_co2(spark):
    br = _bridges(spark)
    em = _facts(spark, [("S", "r1", "Corn", "N2O_AGR", 2010, 1.0), ("S", "r1", "Corn", "CH4", 2010, 1.0),
                        ("S", "r1", "Corn", "CO2", 2010, 3.0), ("S", "r1", "Corn", "SO2", 2010, 100.0)],
                "scenario string, region string, sector string, ghg string, year int, value double")
    luc = _facts(spark, [("S", "r1", 2010, 6.0)], "scenario string, region string, year int, value double")
    got = {r.Region: r.Value for r in emissions.emis(em, luc, br, CFG).collect()}
    assert math.isclose(got["R1"], 298 + 28 + 9 * 44 / 12)
    co2 = {r.Region: r.Value for r in emissions.eco2(em, luc, br, CFG).collect()}
    assert math.isclose(co2["R1"], 9 * 44 / 12)


def test_carbon_price_fills_missing_scenarios_and_skips_luc_markets(spark):
    br = _bridges(spark)
    co2 = _facts(spark, [("S", "global", 2020, 12.0), ("S", "global_LUC", 2020, 99.0), ("S", None, 2030, 1.0)],
                 "scenario string, market string, year int, value double")
    scen = Small(spark.createDataFrame([("S",), ("T",)], "Scenario string"))
    rows = prices.ctax(co2, scen, br, CFG).collect()
    got = {(r.Scenario, r.Region, r.Year): r.Value for r in rows}
    assert len(rows) == 2 * 2 * 2  # scenarios x years x regions (R1, WLD)
    assert math.isclose(got[("S", "WLD", 2020)], 12.0 * 1.516 / (44 / 12))
    assert math.isclose(got[("S", "R1", 2030)], 1.0 * 1.516 / (44 / 12))  # null market is kept
    assert got[("T", "R1", 2020)] == 0.0
    assert prices.ctax(None, scen, br, CFG) is None


def test_year_filter_keeps_reporting_years_only(spark):
    df = spark.createDataFrame([("S", 2005, 1.0), ("S", 2010, 2.0)], "scenario string, year int, value double")
    assert [r.Year for r in normalize(df, CFG.years).collect()] == [2010]
    assert normalize(df, CFG.years).filter(F.col("Scenario") == "S").count() == 1
