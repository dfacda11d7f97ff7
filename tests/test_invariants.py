"""Invariants of the reporting rules on the stand-in project."""

import math
from collections import defaultdict

from pyspark.sql import functions as F

from panelrep.plans import catalog
from panelrep.plans.recipes import totals


def test_leaf_groups_add_up_to_world(spark, sf_small):
    rows = catalog.rollup_total(spark, sf_small).collect()
    leaf = defaultdict(float)
    world = {}
    for r in rows:
        if r.Region and r.Region.startswith("G"):
            leaf[(r.Scenario, r.Year)] += r.Value
        elif r.Region == "WLD":
            world[(r.Scenario, r.Year)] = r.Value
    assert world and all(math.isclose(leaf[k], v, rel_tol=1e-12) for k, v in world.items())


def test_shares_sum_to_one(spark, sf_small):
    df = catalog.group_share_q(spark, sf_small)
    sums = (df.filter(~F.isnan("share")).groupBy("Scenario", "technology", "Year")
            .agg(F.sum("share").alias("s")).collect())
    assert sums and all(math.isclose(r.s, 1.0, rel_tol=1e-9) for r in sums)


def test_net_trade_is_exports_minus_imports(spark, sf_small):
    keys = ["Scenario", "Region", "Item", "Year"]
    e = catalog.trade_exports(spark, sf_small).select(*keys, F.col("Value").alias("e"))
    i = catalog.trade_imports(spark, sf_small).select(*keys, F.col("Value").alias("i"))
    n = catalog.net_trade(spark, sf_small).select(*keys, F.col("Value").alias("n"))
    j = n.join(e, [n[k].eqNullSafe(e[k]) for k in keys]).drop(*[e[k] for k in keys])
    j = j.join(i, [j[k].eqNullSafe(i[k]) for k in keys], "left")
    assert all(r.n == r.e - (r.i if r.i is not None else float("nan")) or r.i is None for r in j.collect())


def test_densified_grid_is_complete(spark, sf_small):
    S = catalog.stand_in(spark, sf_small)
    df = catalog.trade_imports(spark, sf_small)
    pairs = df.select("Scenario", "Region").distinct().count()
    on_grid = df.filter(F.col("Item").isin(list(S.cfg.trade_items)) & F.col("Year").isin(list(S.cfg.years)))
    assert on_grid.count() == pairs * len(S.cfg.trade_items) * len(S.cfg.years)


def test_parity_and_safe_mode_agree_without_null_keys(spark, sf_small):
    S = catalog.stand_in(spark, sf_small)
    a = totals.popt(S.t("population"), S.br, S.cfg).collect()
    b = totals.popt(S.t("population"), S.br, S.cfg.with_(parity=False, pre_aggregate=False)).collect()
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)
