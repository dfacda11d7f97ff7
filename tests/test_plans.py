"""Physical-plan properties that matter at scale."""

from panelrep.plans import catalog


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bridges_are_broadcast_and_facts_pre_aggregated(spark, sf_small):
    df = catalog.rollup_total(spark, sf_small)
    plan = _plan(df)
    assert "BroadcastHashJoin" in plan
    # two aggregation levels: native grain before the fan-out, report grain after
    assert plan.count("HashAggregate") >= 4


def test_no_python_udfs_and_no_cartesian_in_full_report(spark, sf_small):
    plan = _plan(catalog.final_template_plan(spark, sf_small))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct"):
        assert bad not in plan


def test_scan_prunes_columns_and_pushes_year_filter(spark, sf_small):
    from panelrep.plans import standin
    plan = _plan(standin.panel(spark, sf_small).select("scenario", "qty"))
    assert "l_tax" not in plan and "l_orderkey" not in plan
    facts = catalog.stand_in(spark, sf_small)
    stored = facts.project.raw("imports")
    assert stored.select("year").distinct().count() > len(standin.PANEL_YEARS)  # the filter has rows to drop
    assert "In(year" in _plan(facts.t("imports"))
    assert facts.t("imports").select("Year").distinct().count() == len(standin.PANEL_YEARS)


def test_share_join_is_salted(spark, sf_small):
    plan = _plan(catalog.group_share_q(spark, sf_small))
    assert "xxhash64" in plan


def test_base_year_filter_reaches_the_scan(spark, sf_small):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(catalog.base_year_rows_q(spark, sf_small))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line and "ScalarSubquery" in line]
    assert pushed, "the minimum year should be pushed into the Parquet scan"


def test_report_uses_no_window_operator(spark, sf_small):
    plan = _plan(catalog.final_template_plan(spark, sf_small))
    assert "Window" not in plan


def test_densify_scans_its_facts_once(spark, sf_small):
    """Static plans (AQE off): one scan of the fact table, also where the grid holds the observed items."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("trade_imports", "densify_years", "densify_observed"):
            plan = catalog.QUERIES[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
            assert plan.count("FileScan parquet") - plan.count("nation.parquet") - plan.count("region.parquet") == 1, name
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
