"""The stand-in project: a query table is stored, whole, when a query first reads it."""

import datetime as dt

import pytest

from panelrep.operators import bounded
from panelrep.operators.bounded import plan_bytes
from panelrep.plans import catalog, standin
from panelrep.sources import store

TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "ASIA"), (1, "EUROPE")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "CHINA", 0), (1, "FRANCE", 1)]),
    "supplier": ("s_suppkey long, s_nationkey int", [(1, 0), (2, 1)]),
    "customer": ("c_custkey long, c_nationkey int", [(1, 0), (2, 1), (3, 1)]),
    "part": ("p_partkey long, p_brand string, p_type string, p_size int",
             [(1, "Brand#11", "ECONOMY", 10), (2, "Brand#25", "MEDIUM", 30), (3, "Brand#13", "LARGE", 40),
              (4, "Brand#13", "SMALL", 48), (5, None, None, None)]),
    "lineitem": ("l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                 "l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
                 [(1 + k % 5, 1 + k % 2, 1 + k % 7, float(k % 50), 10.0 + k, None if k % 11 == 0 else (k % 10) / 100,
                   "ANR"[k % 3], "OF"[k % 2], dt.datetime(1995 + k % 7, 3, 4)) for k in range(211)]),
}


@pytest.fixture
def own_rows(spark, tmp_path):
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def _rows(df):
    return sorted(map(str, df.collect()))


def _stored(spark, d):
    snap = store.snapshot(spark, catalog.stand_in(spark, d)._root())
    return set(snap.queries()) if snap else set()


@pytest.mark.parametrize("query, read", [
    ("production_union", {"ag_prod", "an_prod"}),
    ("convert_by_pattern", {"emissions", "luc_emissions"}),
    ("exog_yield_colocated", {"harvests", "land_cover", "ag_yield"}),
    ("skip_sum", set()),
    ("ingest_no_clobber", set()),
])
def test_query_stores_the_tables_it_reads(spark, own_rows, query, read):
    assert catalog.QUERIES[query](spark, own_rows).count() and _stored(spark, own_rows) == read


def _read_without_panel(spark, d, query):
    first = _rows(catalog.QUERIES[query](spark, d))
    assert first and not [of for of in standin._ROOTS if of[0] == d]  # nothing was written for it
    assert catalog.stand_in(spark, d).panel.count() == catalog.stand_in(spark, d).rows.count()
    assert [of for of in standin._ROOTS if of[0] == d] and "panel" in catalog.stand_in(spark, d).rows.inputFiles()[0]
    assert _rows(catalog.QUERIES[query](spark, d)) == first


@pytest.mark.parametrize("query", ["skip_sum", "strict_sum"])
def test_sums_of_the_panel_do_not_write_it(spark, own_rows, query):
    _read_without_panel(spark, own_rows, query)


@pytest.mark.parametrize("query", ["ingest_no_clobber", "ingest_two_writers", "stack_scenarios"])
def test_ingests_of_the_panel_do_not_write_it(spark, own_rows, query):
    _read_without_panel(spark, own_rows, query)


def test_large_part_is_not_broadcast_for_a_reader_of_few_columns(spark, own_rows, monkeypatch):
    part = standin.read(spark, own_rows, "part")
    keys, whole = (plan_bytes(part.select(*c)) for c in (["p_partkey"], ["p_partkey", "p_brand", "p_type", "p_size"]))
    monkeypatch.setattr(bounded, "BROADCAST_BYTES", (keys + whole) // 2)  # the keys alone are below the limit
    plan = standin.panel(spark, own_rows).select("scenario", "qty")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 2


def test_tables_stored_one_by_one_are_whole(spark, own_rows):
    S = catalog.stand_in(spark, own_rows)
    want = standin.query_tables(spark, own_rows)
    for name in ("ag_prod", "land_cover", "population", "emissions"):
        assert _rows(S.opened(name).raw(name).select(want[name].columns)) == _rows(want[name])
    root = S.store("ag_prod", "gdp")
    assert root == S.project_root and _stored(spark, own_rows) == {"ag_prod", "land_cover", "population", "emissions", "gdp"}
    assert S.opened("gdp").first_years["gdp"] == S.project.first_years["gdp"]
    assert _stored(spark, own_rows) == set(standin.QUERY_NAMES)
    assert _rows(S.project.raw("ag_prod")) == _rows(S.opened("ag_prod").raw("ag_prod"))


def test_panel_shuffles_no_line_to_a_small_lookup(spark, own_rows):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    sizes = {n: plan_bytes(standin.read(spark, own_rows, n)) for n in ("lineitem", "supplier", "nation", "part")}
    most = max(sizes[n] for n in ("supplier", "nation", "part"))
    assert most < sizes["lineitem"] / 2 < sizes["supplier"] * sizes["nation"] / 100
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(most))  # the least that each lookup alone is below
    try:
        plan = standin.panel(spark, own_rows)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 3


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_panel_rows_with_repeated_and_null_keys(spark, tmp_path, limit):
    lines = TABLES["lineitem"][1] + [(None, 1, 1, 5.0, 1.0, 0.0, "A", "O", dt.datetime(1995, 1, 1)),
                                     (1, None, 1, 6.0, 1.0, 0.0, "A", "O", dt.datetime(1995, 1, 1)),
                                     (1, 9, 1, 7.0, 1.0, 0.0, None, "O", None)]
    rows = {**{n: r for n, (_, r) in TABLES.items()}, "lineitem": lines}
    rows["supplier"] = rows["supplier"] + [(2, 0), (2, 1), (None, 1), (3, None), (9, 7)]
    rows["nation"] = rows["nation"] + [(1, "FRANCE", 0), (None, "NOWHERE", 0)]
    rows["part"] = rows["part"] + [(2, "Brand#13", "LARGE", 20), (None, "Brand#13", "SMALL", 1)]
    for name, (schema, _) in TABLES.items():
        spark.createDataFrame(rows[name], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    want = sorted(str((f, n[1], "unlisted" if p[1] == "Brand#25" else p[2], None if d is None else d.year, q))
                  for lp, ls, _, q, _, _, f, _, d in lines
                  for p in rows["part"] if lp is not None and p[0] == lp
                  for s in rows["supplier"] if ls is not None and s[0] == ls
                  for n in rows["nation"] if s[1] is not None and n[0] == s[1])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        got = standin.panel(spark, str(tmp_path)).select("scenario", "region", "sector", "yr", "qty").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(str((r.scenario, r.region, r.sector, r.yr, float(r.qty))) for r in got) == want
