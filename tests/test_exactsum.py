"""Sums of doubles that do not depend on order."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from panelrep.functions import exactsum
from panelrep.operators.panel import Via, expand_and_sum, finish_sum, grouped_sum, sum_state
from panelrep.plans import catalog
from panelrep.sources.bridges import bridge_from_rows


def bits(x):
    return None if x is None else struct.pack(">d", x)


def values(seed, n):
    g = random.Random(seed)
    return [g.choice([-1, 1]) * g.random() * 2.0 ** g.randrange(-300, 300) for _ in range(n)]


def test_sum_is_the_exact_one_and_free_of_order(spark):
    g = random.Random(1)
    groups = {"wide": values(1, 4000), "near": [g.uniform(0, 1000) for _ in range(4000)],
              "gone": [x for v in values(2, 1000) for x in (v, -v)], "tiny": [5e-324] * 7 + [2.0 ** -1060],
              "huge": [1.7e308, -1.7e308, 1e300], "powers": [2.0 ** k for k in range(-60, 60)] + [2.0 ** 60 - 128],
              "zero": [0.0, -0.0], "one": [0.1]}
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    seen = set()
    for order, parts in ((1, 1), (2, 7), (3, 40)):
        random.Random(order).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, v double").repartition(parts)
        got = {r.k: r.v for r in grouped_sum(df, ["k"], ["v"]).collect()}
        for k, vs in groups.items():  # to the last place; often the nearest double
            assert abs(got[k] - math.fsum(vs)) <= math.ulp(math.fsum(vs)) and (k in ("wide", "powers") or got[k] == math.fsum(vs))
        seen.add(tuple(bits(got[k]) for k in groups))
    assert len(seen) == 1


def test_special_values_and_nulls(spark):
    inf, nan = math.inf, math.nan
    rows = [("inf", inf), ("inf", 1.0), ("both", inf), ("both", -inf), ("nan", nan), ("nan", 2.0), ("null", None),
            ("null", 3.0), ("none", None), ("over", 1.7e308), ("over", 1.7e308)]
    df = spark.createDataFrame(rows, "k string, v double")
    strict = {r.k: r.v for r in grouped_sum(df, ["k"], ["v"]).collect()}
    skip = {r.k: r.v for r in grouped_sum(df, ["k"], ["v"], strict=False).collect()}
    for got in (strict, skip):
        assert got["inf"] == inf and got["over"] == inf and math.isnan(got["both"]) and math.isnan(got["nan"])
    assert strict["null"] is None and skip["null"] == 3.0 and strict["none"] is None and skip["none"] is None


@pytest.mark.parametrize("pre", [True, False])
def test_bridged_sums_of_two_doubles(spark, pre):
    br = bridge_from_rows(spark, [("a", "X"), ("b", "X"), ("b", "Y")], "k", "Item")
    rows = [(k, v, -2 * v) for k, v in zip("aab" * 500, values(3, 1500))] + [("b", None, 1.0)]
    df = spark.createDataFrame(rows, "k string, v double, w double").repartition(5)
    got = {r.Item: (r.v, r.w) for r in expand_and_sum(df, ["Item"], ["v", "w"], [Via(br, "k")], pre_aggregate=pre).collect()}
    x = [(v, w) for _, v, w in rows]
    y = [(v, w) for k, v, w in rows if k == "b"]
    for item, mine in (("X", x), ("Y", y)):
        assert got[item][0] is None and math.isclose(got[item][1], math.fsum(w for _, w in mine), rel_tol=1e-15)
    state = sum_state(df.filter("v is not null"), ["k"], ["v"])
    total = finish_sum(state, [], ["v"]).first().v  # states merge to coarser keys
    assert math.isclose(total, math.fsum(v for _, v, _ in rows if v is not None), rel_tol=1e-15)


def test_decimals_stay_decimals(spark):
    df = spark.createDataFrame([("a", 1.5)], "k string, v double").withColumn("d", F.col("v").cast("decimal(10,2)"))
    out = grouped_sum(df, ["k"], ["d", "v"])
    assert dict(out.dtypes)["d"].startswith("decimal") and dict(out.dtypes)["v"] == "double"
    assert out.first().v == 1.5


def test_feed_shares_are_bit_equal_for_any_partitioning(spark, sf_small):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    try:
        for n in (1, 3, 17):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            S = catalog.stand_in(spark, sf_small)
            rows = catalog.feed.feed_alloc(S.t("feed").repartition(n), S.t("ag_use").repartition(2 * n), S.br, S.cfg)
            seen.append(sorted((str(r[:-1]), bits(r.Value)) for r in rows.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) > 1000


def test_limbs_hold_the_value(spark):
    vs = values(9, 2000) + [2.0 ** k for k in range(-1074, 1024, 7)] + [math.nextafter(2.0 ** k, 0) for k in range(-900, 1000, 6)]
    df = spark.createDataFrame([(v,) for v in vs], "v double")
    low, mid, high, rest = exactsum.limbs(F.col("v"))
    for r in df.select("v", exactsum.bin_of(F.col("v")).alias("b"), low.alias("l"), mid.alias("m"), high.alias("h"),
                       rest.alias("x")).collect():
        whole = (r.h << 42) + (r.m << 21) + r.l
        num, den = r.v.as_integer_ratio()
        unit = 6 * r.b - 54
        assert whole * den * 2 ** max(unit, 0) == num * 2 ** max(-unit, 0) and r.x == 0
