"""Null, NaN, division and text rules (micro fixtures, hand-computed)."""

import math

from pyspark.sql import functions as F

from panelrep.functions.nullmath import contains_or_false, fill_missing, ieee_div, if_else3, strict_sum
from panelrep.functions.text import recover_origin, split_key


def test_strict_sum_null_poisons_group(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", None), ("h", 2.0), ("h", 3.0)], "k string, v double")
    got = dict(df.groupBy("k").agg(strict_sum("v").alias("s")).collect())
    assert got["g"] is None
    assert got["h"] == 5.0


def test_ieee_division(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (-1.0, 0.0), (None, 0.0), (6.0, 3.0), (1.0, None)],
                               "n double, d double")
    got = [r[0] for r in df.select(ieee_div("n", "d")).collect()]
    assert got[0] == math.inf and math.isnan(got[1]) and got[2] == -math.inf
    assert got[3] is None and got[4] == 2.0 and got[5] is None


def test_ieee_division_of_decimals(spark):
    df = spark.createDataFrame([("1.50", "0.00"), ("3.00", "1.50")], "n string, d string")
    df = df.select(F.col("n").cast("decimal(10,2)").alias("n"), F.col("d").cast("decimal(10,2)").alias("d"))
    got = [r[0] for r in df.select(ieee_div("n", "d")).collect()]
    assert got == [math.inf, 2.0]


def test_if_else_null_condition_gives_null(spark):
    df = spark.createDataFrame([("biomass",), ("corn",), (None,)], "s string")
    got = [r[0] for r in df.select(if_else3(F.col("s") == "biomass", 2, 3)).collect()]
    assert got == [2, 3, None]


def test_contains_on_null_is_false_so_negation_keeps_row(spark):
    df = spark.createDataFrame([("global_LUC",), ("global",), (None,)], "m string")
    kept = [r[0] for r in df.filter(~contains_or_false("m", "_LUC")).collect()]
    assert kept == ["global", None]


def test_fill_missing_replaces_null_and_nan_not_inf(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (2.5,)], "v double")
    got = [r[0] for r in df.select(fill_missing("v", 0)).collect()]
    assert got == [0, 0, math.inf, 2.5]


def test_split_key_pads_and_drops(spark):
    df = spark.createDataFrame([("A_b.c-d_e",), ("A_b",), ("x-",), (None,), ("Café_1",)], "k string")
    got = [tuple(r) for r in df.select(*split_key("k", 4)).collect()]
    assert got[0] == ("A", "b", "c", "d")
    assert got[1] == ("A", "b", None, None)
    assert got[2] == ("x", "", None, None)
    assert got[3] == (None, None, None, None)
    assert got[4] == ("Café", "1", None, None)  # accented letters do not split


def test_origin_region_rules(spark):
    df = spark.createDataFrame([
        ("USA", "traded corn", "South Africa traded corn"),
        ("USA", "Exports_Meat", "Beef"),
        ("Brazil", None, "x"),
        ("EU", "wheat", "EU wheat"),
    ], "region string, sector string, subsector string")
    got = [tuple(r) for r in recover_origin(df, meat_export_sector="Exports_Meat").collect()]
    assert got[0] == ("South Africa", "traded corn", "South Africa traded corn")
    assert got[1] == ("USA", "Exports_Meat Beef", "Beef")
    assert got[2] == ("Brazil", None, "x")
    assert got[3] == ("EU", "wheat", "EU wheat")


def test_paste_writes_na_for_null_and_substr_never_fails(spark):
    from panelrep.functions.text import paste, strip_suffix_len
    df = spark.createDataFrame([("Exports_Meat", None, "ab", "abcdef"), ("a", "b", "x", "y")],
                               "s string, t string, short string, long string")
    got = [tuple(r) for r in df.select(paste("s", "t"), strip_suffix_len("short", "long")).collect()]
    assert got == [("Exports_Meat NA", ""), ("a b", "")]


def test_traded_label_with_null_subsector_gives_null_region(spark):
    df = spark.createDataFrame([("USA", "traded corn", None)], "region string, sector string, subsector string")
    r = recover_origin(df, meat_export_sector="Exports_Meat").collect()[0]
    assert r.region is None and r.sector == "traded corn"
