"""Panel operators on hand-made inputs."""

import math
from decimal import Decimal

from pyspark.sql import functions as F

from panelrep.operators.bounded import Small
from panelrep.operators.panel import (OBSERVED, Via, baseline_shift, base_year_rows, densify, expand_and_sum,
                                      group_share, heavy_hitters)
from panelrep.sources.bridges import alias_bridge, bridge_from_rows


def _bridge(spark):
    return bridge_from_rows(spark, [(None, "J"), (None, "K"), ("x", "I")], "key", "Item")


def test_null_key_parity_fans_out(spark):
    fact = spark.createDataFrame([("s", None, 1.0)], "Scenario string, k string, value double")
    out = expand_and_sum(fact, ["Scenario", "Item"], ["value"], [Via(_bridge(spark), "k")], match_nulls=True)
    assert sorted(r.Item for r in out.collect()) == ["J", "K"]


def test_null_key_safe_mode_keeps_one_unmatched_row(spark):
    fact = spark.createDataFrame([("s", None, 1.0)], "Scenario string, k string, value double")
    out = expand_and_sum(fact, ["Scenario", "Item"], ["value"], [Via(_bridge(spark), "k")], match_nulls=False)
    rows = out.collect()
    assert len(rows) == 1 and rows[0].Item is None and rows[0].value == 1.0


def test_pre_aggregation_matches_plain_expansion(spark):
    fact = spark.createDataFrame([("s", "x", 1.0), ("s", "x", 2.0), ("s", None, 4.0), ("t", "x", None)],
                                 "Scenario string, k string, value double")
    br = _bridge(spark)
    a = expand_and_sum(fact, ["Scenario", "Item"], ["value"], [Via(br, "k")], pre_aggregate=True)
    b = expand_and_sum(fact, ["Scenario", "Item"], ["value"], [Via(br, "k")], pre_aggregate=False)
    key = lambda r: (r.Scenario, r.Item or "")
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    got = {key(r): r.value for r in a.collect()}
    assert got[("s", "I")] == 3.0 and got[("s", "J")] == 4.0 and got[("t", "I")] is None


def test_double_unpivot_keeps_null_spellings(spark):
    wide = spark.createDataFrame([("F", None, None, "G", None)], "name string, traded string, regional string, "
                                 "i1 string, i2 string")
    long = alias_bridge(wide, ["name", "traded", "regional"], ["i1", "i2"], key="k", value="Item")
    got = sorted((r.Item, r.k or "") for r in long.collect())
    assert got == [("G", ""), ("G", ""), ("G", "F")]
    safe = alias_bridge(wide, ["name", "traded", "regional"], ["i1", "i2"], key="k", value="Item",
                        keep_null_keys=False)
    assert [(r.k, r.Item) for r in safe.collect()] == [("F", "G")]


def test_densify_fills_grid_and_keeps_off_grid(spark):
    df = spark.createDataFrame([("a", "r1", 1, None), ("a", "r1", 9, 5.0)],
                               "Scenario string, Region string, Year int, Value double")
    out = densify(df, ["Scenario", "Region"], {"Year": [1, 2]}, {"Value": 0})
    got = sorted((r.Year, r.Value) for r in out.collect())
    assert got == [(1, 0.0), (2, 0.0), (9, 5.0)]


def test_densify_null_region_is_its_own_key(spark):
    df = spark.createDataFrame([("a", None, 1, 2.0)], "Scenario string, Region string, Year int, Value double")
    out = densify(df, ["Scenario", "Region"], {"Year": [1, 2]}, {"Value": 0})
    got = sorted((r.Region, r.Year, r.Value) for r in out.collect())
    assert got == [(None, 1, 2.0), (None, 2, 0)]


def test_densify_with_observed_values(spark):
    df = spark.createDataFrame([("a", "r", "X", 1, 1.0), ("b", "r", "Y", 1, 2.0)],
                               "Scenario string, Region string, Item string, Year int, Value double")
    for items in (Small(df.select("Item").distinct(), 10), Small(df.select("Item").distinct()), OBSERVED):
        out = densify(df, ["Scenario", "Region"], {"Item": items, "Year": [1]}, {"Value": 0})
        assert sorted((r.Scenario, r.Item, r.Value) for r in out.collect()) == [
            ("a", "X", 1.0), ("a", "Y", 0.0), ("b", "X", 0.0), ("b", "Y", 2.0)]


def test_densify_keeps_null_items_and_rows_outside_the_grid(spark):
    df = spark.createDataFrame([("a", "r", None, 1, 1.0), ("a", "r", "X", 9, None), ("a", "q", "X", 1, 3.0)],
                               "Scenario string, Region string, Item string, Year int, Value double")
    out = densify(df, ["Scenario", "Region"], {"Item": OBSERVED, "Year": [1, 2]}, {"Value": 0})
    got = {(r.Region, r.Item, r.Year): r.Value for r in out.collect()}
    assert out.columns == df.columns and len(got) == out.count() == 9
    assert got["r", None, 1] == 1.0 and got["q", None, 2] == 0.0 and got["r", "X", 9] == 0.0


def test_group_share_and_zero_group(spark):
    df = spark.createDataFrame([("g", "a", 1.0), ("g", "b", 3.0), ("z", "a", 0.0), ("z", "b", 0.0)],
                               "grp string, input string, value double")
    for target in (10, 1):
        got = {(r.grp, r.input): r.share for r in group_share(df, ["grp"], "value", target_rows=target).collect()}
        assert got[("g", "a")] == 0.25 and got[("g", "b")] == 0.75
        assert math.isnan(got[("z", "a")]) and math.isnan(got[("z", "b")])


def test_group_share_splits_a_hot_group(spark):
    # one group holds 3 of 4 thirds of the rows; a null group key is a group too
    rows = [("hot", i, 1.0) for i in range(300)] + [("cold", i, 2.0) for i in range(50)] + [(None, 0, 5.0)]
    df = spark.createDataFrame(rows, "grp string, i int, value double")
    plain = {(r.grp, r.i): r.share for r in group_share(df, ["grp"], "value").collect()}
    split = group_share(df, ["grp"], "value", target_rows=10)  # 30 parts of the hot group
    got = {(r.grp, r.i): r.share for r in split.collect()}
    assert got == plain and len(got) == split.count() == 351
    assert got[("hot", 0)] == 1 / 300 and got[(None, 0)] == 1.0


def test_group_share_splits_any_number_of_groups(spark):
    # 1,200 groups over the target, with tied sizes, and equal rows within a group
    df = spark.range(1200 * 6).selectExpr("cast(id % 1200 as int) grp", "1.0D value")
    out = group_share(df, ["grp"], "value", target_rows=2)
    assert out.count() == 7200 and out.filter("abs(share - 1 / 6D) > 1e-12").count() == 0


def test_hot_group_is_spread_over_tasks(spark):
    """With shuffle joins only: no partition gets more than its share of a group that holds three quarters of the rows."""
    df = spark.range(40_000).selectExpr("if(id % 4 < 3, 'hot', cast(id % 97 as string)) grp", "cast(id as double) value")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = group_share(df, ["grp"], "value", target_rows=500)
        plan = out._jdf.queryExecution().executedPlan().toString()
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        rows = out.filter("grp = 'hot'").agg(F.count("*"), F.sum("share")).first()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" in plan
    assert sum(sizes) == 40_000 and max(sizes) < 0.35 * 40_000  # 8 partitions
    assert rows[0] == 30_000 and math.isclose(rows[1], 1.0)


def test_heavy_hitters_are_found_and_bounded(spark):
    df = spark.range(60_000).selectExpr("if(id % 3 = 0, 'a', if(id % 10 = 1, null, cast(id as string))) k")
    got = {r.key_hash: r.rows for r in heavy_hitters(df, ["k"], 20).collect()}
    want = {r.h: r.n for r in df.groupBy(F.xxhash64("k").alias("h")).agg(F.count("*").alias("n")).collect()}
    hot = [h for h, n in want.items() if n * 20 > 60_000]
    assert len(hot) == 2 and len(got) <= 20 and all(got[h] >= want[h] for h in hot)
    assert heavy_hitters(df.limit(0), ["k"]).count() == 0


def test_baseline_shift(spark):
    df = spark.createDataFrame([("CC", "r", 3.0), ("NoCC", "r", 2.0), ("CC", "q", 1.0)],
                               "Scenario string, Region string, Value double")
    pairs = Small(spark.createDataFrame([("CC", "NoCC")], "CC_Scenario string, NoCC_Scenario string"), 1)
    got = {r.Region: r.Value for r in baseline_shift(df, pairs, ["Region"]).collect()}
    assert got == {"r": 50.0, "q": None}


def test_base_year_global_min_and_override(spark):
    df = spark.createDataFrame([("A", "corn", 2010, 1.0), ("B", "corn", 2020, 2.0), ("A", "biomass", 2020, 3.0)],
                               "Scenario string, sector string, Year int, value double")
    assert [r.value for r in base_year_rows(df).collect()] == [1.0]
    over = base_year_rows(df, override=(F.col("sector") == "biomass") & (F.col("Year") == 2020))
    assert sorted(r.value for r in over.collect()) == [1.0, 3.0]
    per = base_year_rows(df, per=["Scenario"])
    assert sorted(r.value for r in per.collect()) == [1.0, 2.0]


def test_local_rows_have_a_known_size(spark):
    from panelrep.operators.bounded import local_table, prove_bound
    df = local_table(spark, [("a", 1, None), (None, 2, Decimal("1.50"))], "k string, n int, d decimal(4,2)")
    assert prove_bound(df).bounded and [tuple(r) for r in df.collect()] == [("a", 1, None), (None, 2, Decimal("1.50"))]
    assert local_table(spark, [], "k string").count() == 0


def test_bound_is_the_size_of_the_plan(spark):
    from panelrep.operators.bounded import BROADCAST_BYTES, prove_bound
    small = prove_bound(spark.range(5))
    assert small.bounded and small.max_bytes == 40
    big = prove_bound(spark.range(BROADCAST_BYTES))
    assert not big.bounded and big.side() is big.df  # no broadcast hint for a large table


def test_base_year_per_scenario_does_not_shuffle_the_facts(spark, tmp_path):
    spark.createDataFrame([("A", 2010, 1.0), (None, 2020, 2.0), (None, 2030, 3.0), ("A", 2020, 4.0)],
                          "Scenario string, Year int, value double").write.parquet(str(tmp_path / "f"))
    out = base_year_rows(spark.read.parquet(str(tmp_path / "f")), per=["Scenario"])
    assert sorted(r.value for r in out.collect()) == [1.0, 2.0]
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
