"""Bucketed joins, long lists and unit graphs."""

import itertools
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from panelrep.operators import longlist
from panelrep.operators.colocated import bucketed, colocated_join
from panelrep.operators.longlist import in_list
from panelrep.operators.units import compose, converted, factor_table, label_categories
from panelrep.plans import catalog
from panelrep.plans.recipes import land, yields


@pytest.fixture
def shuffle_joins(spark):
    """No broadcast, no adaptive plans: what the static plan shuffles, it shuffles."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_harvest_join_has_no_exchange(spark, sf_small, shuffle_joins):
    S = catalog.stand_in(spark, sf_small)
    harvests, cover, ag_yield = catalog._bucketed(spark, S)
    joined = land.harvested_area_df(harvests, land.land_df(cover))
    assert "SortMergeJoin" in _plan(joined) and "Exchange" not in _plan(joined)
    plain = land.harvested_area_df(S.t("harvests"), land.land_df(S.t("land_cover")))
    assert "Exchange" in _plan(plain)
    assert sorted(map(str, joined.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
    # the second fact-fact join keeps the buckets; what is shuffled is already summed
    yexo = _plan(yields.yexo(joined, ag_yield, S.br, S.cfg, S.project.first_years))
    deepest = [line for line in yexo.splitlines() if "Exchange" in line]
    assert deepest and yexo.count("SortMergeJoin") >= 2
    lines = yexo.splitlines()
    at = next(i for i, line in enumerate(lines) if "SortMergeJoin [__bucket_key" in line)  # the upper fact join
    depth = lines[at].index("SortMergeJoin")
    below = [line for line in itertools.takewhile(lambda x: len(x) - len(x.lstrip(" :+-*()0123456789")) > depth, lines[at + 1:])]
    assert any("SortMergeJoin [__bucket_key" in line for line in below)
    assert not any("Exchange" in line for line in below)


def test_colocated_join_matches_nulls_and_keeps_hash_twins_apart(spark, tmp_path):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, x int")
    right = spark.createDataFrame([("a", 10), (None, 20), ("c", 30)], "r string, y int")
    a = bucketed(left, ["k"], 3, str(tmp_path))
    b = bucketed(right, ["r"], 3, str(tmp_path))
    got = sorted((r.k or "", r.x, r.y) for r in colocated_join(a, b, [("k", "r")]).collect())
    assert got == [("", 2, 20), ("a", 1, 10), ("b", 3, None)]
    twins = colocated_join(a.withColumn("__bucket_key", F.lit(0)), b.withColumn("__bucket_key", F.lit(0)), [("k", "r")])
    assert sorted((r.k or "", r.x, r.y) for r in twins.collect()) == got


@pytest.mark.parametrize("n", [0, 5, 3000])
def test_lists_of_any_length(spark, n):
    names = [f"n{3 * k}" for k in range(n)] + [None, "n0"][: 2 if n else 0]
    df = spark.range(5000).selectExpr("if(id % 7 = 0, null, concat('n', id)) k", "id")
    want = {f"n{3 * k}" for k in range(n)}
    for given, column in ((names, None), (spark.createDataFrame([(x,) for x in names], "name string"), "name")):
        got = [r.k for r in in_list(df, "k", given, column).collect()]
        assert sorted(got) == sorted(f"n{i}" for i in range(5000) if i % 7 and f"n{i}" in want)


def test_bloom_filter_acts_before_the_shuffle(spark, tmp_path, shuffle_joins):
    spark.range(20_000).selectExpr("concat('n', id) k").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    names = spark.range(4000).selectExpr("concat('n', id * 5) name")
    plan = _plan(in_list(df, "k", names, "name"))
    join = plan.index("Join")
    left = plan[join:]
    assert left.index("Exchange") < left.index("getbit") or left.index("Exchange") < left.index("get(")
    bits = longlist.bloom(names, "name")
    assert len(bits.first().bits) == longlist.BITS // 64
    passed = df.filter(longlist.might_hold(F.col("k"), bits.scalar())).count()
    assert 4000 <= passed < 4000 + 0.01 * 16_000


def test_unit_paths():
    rows = [("LARGE", "EJ", "Mt", Decimal("57.1")), (None, "Mt", "kt", Decimal(1000)), (None, "lb", "kg", Decimal(3)),
            ("odd", "Mt", "kt", Decimal(7))]
    got = {(c, u): f for c, u, _, f in compose(rows, "kt")}
    assert got[None, "Mt"] == 1000 and got["LARGE", "EJ"] == 57100 and got["LARGE", "Mt"] == 1000
    assert got["odd", "Mt"] == 7 and got[None, "kt"] == 1 and (None, "EJ") not in got and (None, "lb") not in got
    back = {(c, u): f for c, u, _, f in compose(rows, "Mt")}
    assert back[None, "kt"] == Decimal("0.001") and (None, "lb") not in back  # 1 / 1000 is a finite decimal
    assert ("odd", "kt") not in {(c, u) for c, u, _, f in compose(rows, "Mt") if f == Decimal(1) / 7}


def test_conversion_by_category_and_unit(spark):
    f = factor_table(spark, [("LARGE", "EJ", "Mt", Decimal("57.1")), (None, "Mt", "kt", Decimal(1000))], "kt")
    df = spark.createDataFrame([("LARGE", "EJ", 2.0), ("LARGE", "Mt", 2.0), ("x", "Mt", 3.0), (None, "Mt", 4.0),
                                ("x", "EJ", 5.0), ("x", None, 6.0)], "sector string, unit string, value double") \
        .withColumn("value", F.col("value").cast("decimal(18,2)"))
    got = [None if r.value is None else float(r.value) for r in converted(df, "value", "unit", "sector", f).collect()]
    assert sorted(got, key=str) == sorted([114200.0, 2000.0, 3000.0, None, None, None], key=str)
    df = spark.createDataFrame([("xN2Oy",), ("CH4_N2O",), (None,), ("z",)], "ghg string")
    kinds = {r.ghg: r.category for r in label_categories(df, "ghg", [("N2O", "n"), ("CH4", "c")], "d").collect()}
    assert kinds == {"xN2Oy": "n", "CH4_N2O": "n", None: "d", "z": "d"}
