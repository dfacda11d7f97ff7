"""Switches for the reference's oddities (ReportConfig)."""

from pyspark.sql import functions as F

from panelrep.plans import catalog
from panelrep.plans.recipes import feed, land, prices, production, yields
from panelrep.plans.recipes.common import Bridges
from panelrep.plans.standin import item_bridge
from panelrep.plans.recipes.common import rollup, by_item


def test_null_policy_skip_ignores_nulls(spark, sf_small):
    S = catalog.stand_in(spark, sf_small)
    fact = spark.createDataFrame([("s", "ECONOMY", 1.0), ("s", "ECONOMY", None)],
                                 "Scenario string, sector string, value double")
    strict = rollup(fact, ["Scenario", "Item"], ["value"], [by_item(S.br.item, "sector")], S.cfg).collect()
    skip = rollup(fact, ["Scenario", "Item"], ["value"], [by_item(S.br.item, "sector")],
                  S.cfg.with_(null_policy="skip")).collect()
    assert {r.value for r in strict} == {None}
    assert {r.value for r in skip} == {1.0}


def test_drop_unmapped_removes_null_item_groups(spark, sf_small):
    S = catalog.stand_in(spark, sf_small)
    keep = production.an_prod(S.t("an_prod"), S.br, S.cfg)
    drop = production.an_prod(S.t("an_prod"), S.br, S.cfg.with_(drop_unmapped=True))
    assert keep.filter(F.col("Item").isNull()).count() > 0
    assert drop.filter(F.col("Item").isNull()).count() == 0
    assert drop.count() == keep.filter(F.col("Item").isNotNull()).count()


def test_safe_mode_drops_null_keys_and_unmatched_weights(spark, sf_small):
    S = catalog.stand_in(spark, sf_small)
    safe = S.cfg.with_(parity=False)
    br = Bridges(region=S.br.region, item=item_bridge(spark, keep_null_keys=False), land=S.br.land,
                 demand=S.br.demand, pairs=S.br.pairs, waste=S.br.waste)
    harvested = land.harvested_area_df(S.t("harvests"), land.land_df(S.t("land_cover")))
    par = yields.yexo(harvested, S.t("ag_yield"), S.br, S.cfg)
    saf = yields.yexo(harvested, S.t("ag_yield"), br, safe)
    assert par.filter(F.col("Year").isNull()).count() > 0
    assert saf.filter(F.col("Year").isNull()).count() == 0
    assert br.item.df.filter(F.col("commodity_key").isNull()).count() == 0


def test_per_scenario_base_equals_global_when_all_share_first_year(spark, sf_small):
    S = catalog.stand_in(spark, sf_small)
    t = S.t
    a = prices.xprp(t("ag_prod"), t("an_prod"), t("ag_prices"), t("an_prices"), S.br, S.cfg)
    b = prices.xprp(t("ag_prod"), t("an_prod"), t("ag_prices"), t("an_prices"), S.br,
                    S.cfg.with_(per_scenario_base=True))
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_feed_alloc_factor(spark, sf_small):
    S = catalog.stand_in(spark, sf_small)
    one = {(r.Scenario, r.Region, r.Item, r.Variable, r.Year): r.Value
           for r in feed.feed_alloc(S.t("feed"), S.t("ag_use"), S.br, S.cfg).collect()}
    k = {(r.Scenario, r.Region, r.Item, r.Variable, r.Year): r.Value
         for r in feed.feed_alloc(S.t("feed"), S.t("ag_use"), S.br, S.cfg.with_(feed_alloc_factor=1000)).collect()}
    for key, v in one.items():
        if v is not None and v == v:
            assert abs(k[key] - 1000 * v) <= 1e-9 * max(1.0, abs(k[key]))
