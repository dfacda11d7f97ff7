"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the reporting rules directly (strict sums, null-safe matching,
IEEE division, densify with off-grid rows kept), not from the Spark code.
Tables ``region nation customer supplier part lineitem`` are views.
Measures stay decimal until a sum is finished, then become double once,
so both engines produce identical doubles.
"""

from __future__ import annotations

YEARS = "(1995, 1997, 1999, 2001)"
YEAR_ROWS = "(VALUES (1995), (1997), (1999), (2001)) AS yy(Year)"


def strict(v: str) -> str:
    return f"(CASE WHEN count({v}) = count(*) THEN sum({v}) END)"


def d(x) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def lst(xs) -> str:
    return "(" + ", ".join(f"'{x}'" for x in xs) + ")"


def nsafe(a: str, b: str, cols) -> str:
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)


PROD_ITEMS = ("CER", "VEG", "VEG|LEAF", "VEG|ROOT", "CRP", "RUM", "NRM", "LSP", "ALL", "NRG")
PRICE_ITEMS = tuple(i for i in PROD_ITEMS if i != "VEG|ROOT")
AREA_ITEMS = ("CER", "VEG", "VEG|LEAF", "VEG|ROOT", "CRP", "ALL", "NRG")
LAND_ITEMS = ("CER", "VEG", "CRP", "LSP", "ALL", "NRG")
ANIMAL = "('MEDIUM', 'SMALL', 'unlisted')"

# --------------------------------------------------------------------------
# stand-in project: panel, query tables, bridges
# --------------------------------------------------------------------------
SOURCES = f"""
panel_all AS (
  SELECT l.l_returnflag AS scenario, n.n_name AS region,
         CASE WHEN p.p_brand = 'Brand#25' THEN 'unlisted' ELSE p.p_type END AS sector,
         p.p_type || '_N' || CAST(s.s_nationkey AS VARCHAR) || '_'
           || CASE WHEN l.l_linestatus = 'O' THEN 'IRR' ELSE 'RFD' END || '_'
           || CASE WHEN p.p_size > 25 THEN 'hi' ELSE 'lo' END AS technology,
         CASE WHEN p.p_size <= 20 THEN 'food_use' WHEN p.p_size <= 35 THEN 'feed_use'
              WHEN p.p_size <= 45 THEN 'other_use' ELSE 'outside' END AS disposition,
         CASE l.l_linenumber % 4 WHEN 0 THEN 'CO2' WHEN 1 THEN 'CH4_AGR' WHEN 2 THEN 'N2O_AGR' END AS ghg,
         CAST(year(l.l_shipdate) AS INTEGER) AS yr,
         CAST(l.l_quantity AS DECIMAL(18,2)) AS qty,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS price,
         CAST(l.l_discount AS DECIMAL(18,2)) AS frac
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
panel AS (SELECT * FROM panel_all WHERE yr IN {YEARS}),
shifted AS (
  SELECT scenario, region, sector, yr + CASE scenario WHEN 'N' THEN 2 WHEN 'R' THEN 4 ELSE 0 END AS year,
         CAST(sum(qty) AS DECIMAL(18,2)) AS value
  FROM panel_all GROUP BY 1, 2, 3, 4),
cust AS (
  SELECT n.n_name AS region, c.cnt AS value
  FROM (SELECT c_nationkey, count(*) AS cnt FROM customer GROUP BY c_nationkey) c
  JOIN nation n ON c.c_nationkey = n.n_nationkey),
population AS (
  SELECT k.scenario, k.region, k.yr AS year, c.value
  FROM (SELECT DISTINCT scenario, region, yr FROM panel) k JOIN cust c ON k.region = c.region),
pop_qty AS (SELECT scenario, region, yr AS year, qty AS value FROM panel),
land_cover AS (
  SELECT scenario, region,
         CASE WHEN qty > 15 THEN technology
              ELSE 'BARREN_' || regexp_extract(technology, '([^_]*_[^_]*_[^_]*)$', 1) END AS landleaf,
         yr AS year, CAST(sum(qty) AS DECIMAL(18,2)) AS value
  FROM panel GROUP BY 1, 2, 3, 4),
harvests AS (
  SELECT scenario, region, technology, yr AS year, CAST(sum(frac) AS DECIMAL(18,2)) AS value
  FROM panel GROUP BY scenario, region, technology, yr),
ag_prod AS (
  SELECT scenario, region, CASE WHEN sector = 'LARGE' AND yr = 1995 THEN 'LARGE_start' ELSE sector END AS sector,
         technology, yr AS year, CAST(sum(qty) AS DECIMAL(18,2)) AS value
  FROM panel GROUP BY 1, 2, 3, 4, 5),
an_prod AS (
  SELECT scenario, region, sector, yr AS year, CAST(sum(qty) AS DECIMAL(18,2)) AS value
  FROM panel WHERE sector IN {ANIMAL} GROUP BY scenario, region, sector, yr),
ag_prices AS (
  SELECT scenario, region, sector, yr AS year, max(price) AS value FROM panel GROUP BY scenario, region, sector, yr),
an_prices AS (
  SELECT scenario, region, sector, yr AS year, max(price) AS value
  FROM panel WHERE sector IN {ANIMAL} GROUP BY scenario, region, sector, yr),
ag_yield AS (
  SELECT scenario, region,
         CASE WHEN frac < 0.09 AND qty < 40 THEN technology ELSE technology || '_none' END AS technology,
         sector, yr AS year, max(frac) AS value
  FROM panel GROUP BY 1, 2, 3, 4, 5),
ag_use AS (
  SELECT scenario, region, disposition AS sector, sector AS input, yr AS year, CAST(sum(qty) AS DECIMAL(18,2)) AS value
  FROM panel GROUP BY scenario, region, disposition, sector, yr),
an_use AS (
  SELECT scenario, region, disposition AS sector, sector AS input, yr AS year, CAST(sum(qty) AS DECIMAL(18,2)) AS value
  FROM panel WHERE sector IN {ANIMAL} GROUP BY scenario, region, disposition, sector, yr),
imports AS (
  SELECT scenario, region, sector, yr AS year, CAST(sum(qty) AS DECIMAL(18,2)) AS value
  FROM panel GROUP BY scenario, region, sector, yr),
exports AS (
  SELECT scenario, x_region AS region, x_sector AS sector, x_sub AS subsector, yr AS year,
         CAST(sum(qty) AS DECIMAL(18,2)) AS value
  FROM (SELECT scenario, yr, qty,
               CASE WHEN sector = 'MEDIUM' THEN region ELSE 'GLOBAL' END AS x_region,
               CASE WHEN sector = 'MEDIUM' THEN 'Exports_M' ELSE 'traded ' || lower(sector) END AS x_sector,
               CASE WHEN sector = 'MEDIUM' THEN 'medium' ELSE region || ' traded ' || lower(sector) END AS x_sub
        FROM panel) e
  GROUP BY scenario, x_region, x_sector, x_sub, yr),
fertilizer AS (
  SELECT scenario, region, sector, yr AS year, CAST(sum(frac) AS DECIMAL(18,2)) AS value
  FROM panel GROUP BY scenario, region, sector, yr),
water AS (SELECT * FROM imports),
food AS (
  SELECT scenario, region, sector AS subsector, yr AS year, CAST(sum(qty) AS DECIMAL(18,2)) AS value
  FROM panel WHERE disposition = 'food_use' GROUP BY scenario, region, sector, yr),
emissions AS (
  SELECT scenario, region, sector, ghg, yr AS year, CAST(sum(qty) AS DECIMAL(18,2)) AS value
  FROM panel WHERE ghg IS NOT NULL GROUP BY scenario, region, sector, ghg, yr),
luc_emissions AS (
  SELECT scenario, region, yr AS year, CAST(sum(qty) AS DECIMAL(18,2)) AS value
  FROM panel WHERE ghg IS NULL GROUP BY scenario, region, yr),
feed AS (
  SELECT scenario, region, sector, disposition AS input, yr AS year, CAST(sum(price) AS DECIMAL(18,2)) AS value
  FROM panel WHERE sector IN {ANIMAL} GROUP BY scenario, region, sector, disposition, yr),
co2_prices AS (
  SELECT scenario, market, yr AS year, max(frac) AS value
  FROM (SELECT scenario, yr, frac,
               CASE WHEN disposition = 'outside' OR scenario = 'A' THEN 'global_LUC' ELSE 'global' END AS market
        FROM panel) c
  GROUP BY scenario, market, yr),
rb_wide AS (
  SELECT n.n_name AS region, 'G' || CAST(n.n_nationkey % 7 AS VARCHAR) AS r1,
         CASE WHEN r.r_name <> 'MIDDLE EAST' THEN r.r_name END AS r2, 'WLD' AS r3
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE n.n_nationkey <> 24),
rb AS (
  SELECT region, r1 AS report_region FROM rb_wide
  UNION ALL SELECT region, r2 FROM rb_wide WHERE r2 IS NOT NULL
  UNION ALL SELECT region, r3 FROM rb_wide),
ib_wide(name, traded, regional, i1, i2, i3, i4) AS (VALUES
  ('ECONOMY', 'traded economy', 'regional economy', 'CER', NULL, 'CRP', 'ALL'),
  ('STANDARD', 'traded standard', 'regional standard', 'VEG', 'VEG|LEAF', 'CRP', 'ALL'),
  ('PROMO', 'traded promo', NULL, 'VEG', 'VEG|ROOT', 'CRP', 'ALL'),
  ('MEDIUM', 'Exports_M medium', NULL, 'RUM', NULL, 'LSP', 'ALL'),
  ('SMALL', NULL, NULL, 'NRM', 'NRM|A', 'LSP', 'ALL'),
  ('LARGE', 'traded large', 'total large', 'NRG', NULL, NULL, NULL)),
ib_items AS (
  SELECT name, traded, regional, i1 AS Item FROM ib_wide WHERE i1 IS NOT NULL
  UNION ALL SELECT name, traded, regional, i2 FROM ib_wide WHERE i2 IS NOT NULL
  UNION ALL SELECT name, traded, regional, i3 FROM ib_wide WHERE i3 IS NOT NULL
  UNION ALL SELECT name, traded, regional, i4 FROM ib_wide WHERE i4 IS NOT NULL),
ib AS (
  SELECT name AS commodity_key, Item FROM ib_items
  UNION ALL SELECT traded, Item FROM ib_items
  UNION ALL SELECT regional, Item FROM ib_items),
lb(land_type, Item) AS (VALUES
  ('ECONOMY', 'CER'), ('ECONOMY', 'CRP'), ('ECONOMY', 'ALL'),
  ('STANDARD', 'VEG'), ('STANDARD', 'VEG|LEAF'), ('STANDARD', 'CRP'), ('STANDARD', 'ALL'),
  ('PROMO', 'VEG'), ('PROMO', 'VEG|ROOT'), ('PROMO', 'CRP'), ('PROMO', 'ALL'),
  ('MEDIUM', 'RUM'), ('MEDIUM', 'LSP'), ('MEDIUM', 'ALL'),
  ('SMALL', 'NRM'), ('SMALL', 'NRM|A'), ('SMALL', 'LSP'), ('SMALL', 'ALL'),
  ('LARGE', 'NRG'), ('LARGE', 'CRP'), ('LARGE', 'ALL')),
db(sector, Variable) AS (VALUES
  ('food_use', 'FOOD'), ('food_use', 'CONS'), ('feed_use', 'FEED'), ('other_use', 'OTHU'), ('other_use', 'CONS')),
pairs(CC_Scenario, NoCC_Scenario) AS (VALUES ('A', 'N'), ('R', 'N')),
wf(cls, AFR_w, AMR_w, ASA_w, EUR_w, EMR_w) AS (VALUES
  ('cereals', 0.05, 0.10, 0.08, 0.12, 0.07),
  ('veg', 0.15, 0.20, 0.18, 0.25, 0.16),
  ('meat', 0.03, 0.06, 0.04, 0.08, 0.05),
  ('eggs', 0.02, 0.04, 0.03, 0.05, 0.02)),
wf_long AS (
  SELECT cls, 'AFR_w' AS food_waste_region, CAST(AFR_w AS DECIMAL(4,2)) AS waste_frac FROM wf
  UNION ALL SELECT cls, 'AMR_w', CAST(AMR_w AS DECIMAL(4,2)) FROM wf
  UNION ALL SELECT cls, 'ASA_w', CAST(ASA_w AS DECIMAL(4,2)) FROM wf
  UNION ALL SELECT cls, 'EUR_w', CAST(EUR_w AS DECIMAL(4,2)) FROM wf
  UNION ALL SELECT cls, 'EMR_w', CAST(EMR_w AS DECIMAL(4,2)) FROM wf),
wrc(r_name, food_waste_region) AS (VALUES
  ('AFRICA', 'AFR_w'), ('AMERICA', 'AMR_w'), ('ASIA', 'ASA_w'), ('EUROPE', 'EUR_w'), ('MIDDLE EAST', 'EMR_w')),
wreg AS (
  SELECT n.n_name AS region, w.food_waste_region
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey JOIN wrc w ON r.r_name = w.r_name),
wcom(commodity_key, cls) AS (VALUES
  ('ECONOMY', 'cereals'), ('STANDARD', 'cereals'), ('PROMO', 'veg'), ('MEDIUM', 'meat'), ('SMALL', 'meat')),
waste AS (
  SELECT g.region, c.commodity_key, l.waste_frac
  FROM wf_long l LEFT JOIN wreg g ON l.food_waste_region = g.food_waste_region
  LEFT JOIN wcom c ON l.cls = c.cls)
"""

# --------------------------------------------------------------------------
# indicators (reporting rules)
# --------------------------------------------------------------------------
INDICATORS = f"""
popt AS (
  SELECT f.scenario AS Scenario, b.report_region AS Region, f.year AS Year,
         CAST({strict('f.value')} AS DOUBLE) * {d(0.001)} AS Value
  FROM population f LEFT JOIN rb b ON f.region = b.region
  GROUP BY f.scenario, b.report_region, f.year),
land_df AS (
  SELECT scenario, region, landleaf, year, value,
         regexp_split_to_array(landleaf, '[^[:alnum:]]+')[1] AS land_type,
         regexp_split_to_array(landleaf, '[^[:alnum:]]+')[2] AS basin,
         regexp_split_to_array(landleaf, '[^[:alnum:]]+')[3] AS IRR_RFD,
         regexp_split_to_array(landleaf, '[^[:alnum:]]+')[4] AS MGMT_level
  FROM land_cover),
land_ind AS (
  SELECT l.scenario AS Scenario, b.report_region AS Region, m.Item, l.year AS Year,
         CAST({strict('l.value')} AS DOUBLE) * {d(100.0)} AS Value
  FROM land_df l JOIN lb m ON l.land_type = m.land_type AND m.Item IN {lst(LAND_ITEMS)}
  LEFT JOIN rb b ON l.region = b.region
  GROUP BY l.scenario, b.report_region, m.Item, l.year),
ha AS (
  SELECT h.scenario, h.region, h.technology, h.year, l.land_type, l.basin, l.IRR_RFD, l.MGMT_level,
         h.value * l.value AS value
  FROM harvests h LEFT JOIN land_df l
    ON h.scenario IS NOT DISTINCT FROM l.scenario AND h.region IS NOT DISTINCT FROM l.region
   AND h.technology IS NOT DISTINCT FROM l.landleaf AND h.year IS NOT DISTINCT FROM l.year),
area_rows AS (
  SELECT a.scenario, b.report_region AS Region, m.Item, a.year, a.IRR_RFD, a.value
  FROM ha a JOIN lb m ON a.land_type = m.land_type AND m.Item IN {lst(AREA_ITEMS)}
  LEFT JOIN rb b ON a.region = b.region),
area AS (
  SELECT scenario AS Scenario, Region, Item, year AS Year, CAST({strict('value')} AS DOUBLE) * {d(100.0)} AS Value
  FROM area_rows GROUP BY scenario, Region, Item, year),
arrf AS (
  SELECT scenario AS Scenario, Region, Item, year AS Year, CAST({strict('value')} AS DOUBLE) * {d(100.0)} AS Value
  FROM area_rows WHERE IRR_RFD = 'RFD' GROUP BY scenario, Region, Item, year),
arir AS (
  SELECT scenario AS Scenario, Region, Item, year AS Year, CAST({strict('value')} AS DOUBLE) * {d(100.0)} AS Value
  FROM area_rows WHERE IRR_RFD = 'IRR' GROUP BY scenario, Region, Item, year),
ag_prod_df AS (
  SELECT scenario, region, sector, technology, year,
         regexp_split_to_array(technology, '[^[:alnum:]]+')[3] AS IRR_RFD,
         CASE WHEN sector IS NULL THEN NULL WHEN sector = 'LARGE' THEN value * 57100 ELSE value * 1000 END AS value
  FROM ag_prod),
crop_rows AS (
  SELECT p.scenario, b.report_region AS Region, m.Item, p.year, p.IRR_RFD, p.value
  FROM ag_prod_df p JOIN ib m ON p.sector IS NOT DISTINCT FROM m.commodity_key AND m.Item IN {lst(PROD_ITEMS)}
  LEFT JOIN rb b ON p.region = b.region),
ag_sum AS (
  SELECT scenario AS Scenario, Region, Item, year AS Year, {strict('value')} AS Value
  FROM crop_rows GROUP BY scenario, Region, Item, year),
ag_sum_ir AS (
  SELECT scenario AS Scenario, Region, Item, year AS Year, {strict('value')} AS Value
  FROM crop_rows WHERE IRR_RFD = 'IRR' GROUP BY scenario, Region, Item, year),
ag_sum_rf AS (
  SELECT scenario AS Scenario, Region, Item, year AS Year, {strict('value')} AS Value
  FROM crop_rows WHERE IRR_RFD = 'RFD' GROUP BY scenario, Region, Item, year),
ag_full AS (
  SELECT Scenario, Region, Item, Year, coalesce(Value, 0) AS Value FROM (
    SELECT Scenario, Region, Item, Year, Value FROM ag_sum
    UNION ALL
    SELECT k.Scenario, k.Region, k.Item, yy.Year, NULL
    FROM (SELECT DISTINCT Scenario, Region, Item FROM ag_sum) k CROSS JOIN {YEAR_ROWS}
    WHERE NOT EXISTS (SELECT 1 FROM ag_sum s WHERE {nsafe('s', 'k', ['Scenario', 'Region', 'Item'])}
                      AND s.Year = yy.Year))),
ag_full_ir AS (
  SELECT Scenario, Region, Item, Year, coalesce(Value, 0) AS Value FROM (
    SELECT Scenario, Region, Item, Year, Value FROM ag_sum_ir
    UNION ALL
    SELECT k.Scenario, k.Region, k.Item, yy.Year, NULL
    FROM (SELECT DISTINCT Scenario, Region, Item FROM ag_sum_ir) k CROSS JOIN {YEAR_ROWS}
    WHERE NOT EXISTS (SELECT 1 FROM ag_sum_ir s WHERE {nsafe('s', 'k', ['Scenario', 'Region', 'Item'])}
                      AND s.Year = yy.Year))),
ag_full_rf AS (
  SELECT Scenario, Region, Item, Year, coalesce(Value, 0) AS Value FROM (
    SELECT Scenario, Region, Item, Year, Value FROM ag_sum_rf
    UNION ALL
    SELECT k.Scenario, k.Region, k.Item, yy.Year, NULL
    FROM (SELECT DISTINCT Scenario, Region, Item FROM ag_sum_rf) k CROSS JOIN {YEAR_ROWS}
    WHERE NOT EXISTS (SELECT 1 FROM ag_sum_rf s WHERE {nsafe('s', 'k', ['Scenario', 'Region', 'Item'])}
                      AND s.Year = yy.Year))),
an_sum AS (
  SELECT a.scenario AS Scenario, b.report_region AS Region, m.Item, a.year AS Year, {strict('a.value * 1000')} AS Value
  FROM an_prod a LEFT JOIN ib m ON a.sector IS NOT DISTINCT FROM m.commodity_key
  LEFT JOIN rb b ON a.region = b.region
  GROUP BY a.scenario, b.report_region, m.Item, a.year),
prod AS (
  SELECT Scenario, Region, Item, Year, CAST({strict('Value')} AS DOUBLE) AS Value
  FROM (SELECT Scenario, Region, Item, Year, Value FROM ag_full
        UNION ALL SELECT Scenario, Region, Item, Year, Value FROM an_sum) u
  GROUP BY Scenario, Region, Item, Year),
xprp_base AS (
  SELECT scenario, region, sector,
         CASE WHEN sector IS NULL THEN NULL WHEN sector = 'LARGE' THEN value * 57.1 ELSE value END AS prod
  FROM ag_prod_df
  WHERE year = (SELECT min(year) FROM ag_prod_df) OR (sector = 'LARGE' AND year = 1997)),
xprp_an_base AS (
  SELECT scenario, region, sector, value * 1000 AS prod
  FROM an_prod WHERE year = (SELECT min(year) FROM an_prod)),
xprp_rows AS (
  SELECT b.scenario, b.region, b.sector, p.year, b.prod, b.prod * p.value AS revenue
  FROM xprp_base b LEFT JOIN ag_prices p ON {nsafe('b', 'p', ['scenario', 'region', 'sector'])}
  UNION ALL
  SELECT b.scenario, b.region, b.sector, p.year, b.prod, b.prod * p.value AS revenue
  FROM xprp_an_base b LEFT JOIN an_prices p ON {nsafe('b', 'p', ['scenario', 'region', 'sector'])}),
xprp AS (
  SELECT Scenario, Region, Item, Year,
         CAST(rev AS DOUBLE) / CAST(prd AS DOUBLE) * {d(1000.0)} * {d(3.228)} AS Value
  FROM (SELECT r.scenario AS Scenario, g.report_region AS Region, m.Item, r.year AS Year,
               {strict('r.revenue')} AS rev, {strict('r.prod')} AS prd
        FROM xprp_rows r JOIN ib m ON r.sector IS NOT DISTINCT FROM m.commodity_key AND m.Item IN {lst(PRICE_ITEMS)}
        LEFT JOIN rb g ON r.region = g.region
        GROUP BY r.scenario, g.report_region, m.Item, r.year) s),
yexo AS (
  SELECT Scenario, Region, Item, Year, CAST(p AS DOUBLE) / CAST(a AS DOUBLE) * {d(10.0)} AS Value
  FROM (SELECT r.scenario AS Scenario, g.report_region AS Region, m.Item, r.year AS Year,
               {strict('r.prod')} AS p, {strict('r.area')} AS a
        FROM (SELECT b.scenario, b.region, y.sector, y.year, b.area, b.area * y.yv AS prod
              FROM (SELECT scenario, region, technology, value AS area FROM ha
                    WHERE year = (SELECT min(year) FROM ha)) b
              LEFT JOIN (SELECT scenario, region, technology, sector, year,
                                CASE WHEN sector IS NULL THEN NULL WHEN sector = 'LARGE' THEN value * 57.1
                                     ELSE value END AS yv
                         FROM ag_yield) y
                ON {nsafe('b', 'y', ['scenario', 'region', 'technology'])}) r
        JOIN ib m ON r.sector IS NOT DISTINCT FROM m.commodity_key AND m.Item <> 'NRG'
        LEFT JOIN rb g ON r.region = g.region
        GROUP BY r.scenario, g.report_region, m.Item, r.year) s),
demand AS (
  SELECT u.scenario AS Scenario, g.report_region AS Region, v.Variable, m.Item, u.year AS Year,
         CAST({strict('u.value')} AS DOUBLE) * {d(1000.0)} AS Value
  FROM (SELECT scenario, region, sector, input, year, value FROM ag_use
        UNION ALL SELECT scenario, region, sector, input, year, value FROM an_use) u
  JOIN db v ON u.sector = v.sector
  LEFT JOIN ib m ON u.input IS NOT DISTINCT FROM m.commodity_key
  LEFT JOIN rb g ON u.region = g.region
  GROUP BY u.scenario, g.report_region, v.Variable, m.Item, u.year),
impo_sum AS (
  SELECT f.scenario AS Scenario, g.report_region AS Region, m.Item, f.year AS Year,
         CAST({strict('f.value')} AS DOUBLE) * {d(1000.0)} AS Value
  FROM imports f JOIN ib m ON f.sector IS NOT DISTINCT FROM m.commodity_key
  LEFT JOIN rb g ON f.region = g.region
  GROUP BY f.scenario, g.report_region, m.Item, f.year),
expo_fixed AS (
  SELECT scenario, year, value, sector2 AS sector,
         CASE WHEN coalesce(contains(sector2, 'traded'), false)
              THEN substr(subsector, 1, length(subsector) - (length(sector2) + 1)) ELSE region END AS region
  FROM (SELECT scenario, year, value, region, subsector,
               CASE WHEN sector = 'Exports_M' THEN sector || ' ' || coalesce(subsector, 'NA') ELSE sector END AS sector2
        FROM exports) e),
expo_sum AS (
  SELECT f.scenario AS Scenario, g.report_region AS Region, m.Item, f.year AS Year,
         CAST({strict('f.value')} AS DOUBLE) * {d(1000.0)} AS Value
  FROM expo_fixed f JOIN ib m ON f.sector IS NOT DISTINCT FROM m.commodity_key
  LEFT JOIN rb g ON f.region = g.region
  GROUP BY f.scenario, g.report_region, m.Item, f.year),
frtn_sum AS (
  SELECT f.scenario AS Scenario, g.report_region AS Region, m.Item, f.year AS Year,
         CAST({strict('f.value')} AS DOUBLE) * {d(1000.0)} AS Value
  FROM fertilizer f LEFT JOIN ib m ON f.sector IS NOT DISTINCT FROM m.commodity_key
  LEFT JOIN rb g ON f.region = g.region
  WHERE m.Item IS NOT NULL
  GROUP BY f.scenario, g.report_region, m.Item, f.year),
watr_sum AS (
  SELECT f.scenario AS Scenario, g.report_region AS Region, m.Item, f.year AS Year,
         CAST({strict('f.value')} AS DOUBLE) AS Value
  FROM water f LEFT JOIN ib m ON f.sector IS NOT DISTINCT FROM m.commodity_key
  LEFT JOIN rb g ON f.region = g.region
  GROUP BY f.scenario, g.report_region, m.Item, f.year),
calo AS (
  SELECT c.Scenario, c.Region, c.Item, c.Year,
         CAST(c.v AS DOUBLE) * {d(1e6)} / p.Value / {d(365.25)} AS Value
  FROM (SELECT f.scenario AS Scenario, g.report_region AS Region, m.Item, f.year AS Year, {strict('f.value')} AS v
        FROM food f LEFT JOIN ib m ON f.subsector IS NOT DISTINCT FROM m.commodity_key
        LEFT JOIN rb g ON f.region = g.region
        GROUP BY f.scenario, g.report_region, m.Item, f.year) c
  LEFT JOIN popt p ON {nsafe('c', 'p', ['Scenario', 'Region', 'Year'])}),
cali AS (
  SELECT c.Scenario, c.Region, c.Item, c.Year,
         CAST(c.v AS DOUBLE) * {d(1e6)} / p.Value / {d(365.25)} AS Value
  FROM (SELECT f.scenario AS Scenario, g.report_region AS Region, m.Item, f.year AS Year,
               {strict('f.value * (1 - w.waste_frac)')} AS v
        FROM food f LEFT JOIN ib m ON f.subsector IS NOT DISTINCT FROM m.commodity_key
        LEFT JOIN rb g ON f.region = g.region
        LEFT JOIN waste w ON f.region IS NOT DISTINCT FROM w.region
                         AND f.subsector IS NOT DISTINCT FROM w.commodity_key
        GROUP BY f.scenario, g.report_region, m.Item, f.year) c
  LEFT JOIN popt p ON {nsafe('c', 'p', ['Scenario', 'Region', 'Year'])}),
eco2 AS (
  SELECT u.scenario AS Scenario, g.report_region AS Region, u.year AS Year,
         CAST({strict('u.value')} AS DOUBLE) * {d(44 / 12)} AS Value
  FROM (SELECT scenario, region, year, value FROM emissions WHERE ghg = 'CO2'
        UNION ALL SELECT scenario, region, year, value FROM luc_emissions) u
  LEFT JOIN rb g ON u.region = g.region
  GROUP BY u.scenario, g.report_region, u.year),
ech4_sum AS (
  SELECT f.scenario AS Scenario, g.report_region AS Region, m.Item, f.year AS Year,
         CAST({strict('f.value')} AS DOUBLE) * {d(28.0)} AS Value
  FROM emissions f LEFT JOIN rb g ON f.region = g.region
  JOIN ib m ON f.sector IS NOT DISTINCT FROM m.commodity_key
  WHERE f.ghg IN ('CH4_AGR')
  GROUP BY f.scenario, g.report_region, m.Item, f.year),
en2o_sum AS (
  SELECT f.scenario AS Scenario, g.report_region AS Region, m.Item, f.year AS Year,
         CAST({strict('f.value')} AS DOUBLE) * {d(298.0)} AS Value
  FROM emissions f LEFT JOIN rb g ON f.region = g.region
  JOIN ib m ON f.sector IS NOT DISTINCT FROM m.commodity_key
  WHERE f.ghg IN ('N2O_AGR')
  GROUP BY f.scenario, g.report_region, m.Item, f.year),
emis AS (
  SELECT u.scenario AS Scenario, g.report_region AS Region, u.year AS Year,
         CAST({strict('u.v')} AS DOUBLE) AS Value
  FROM (SELECT scenario, region, year,
               CASE WHEN contains(gas, 'N2O') THEN value * 298
                    WHEN contains(gas, 'CH4') THEN value * 28
                    ELSE value * {44 / 12!r} END AS v
        FROM (SELECT scenario, region, ghg AS gas, year, value FROM emissions
              WHERE ghg IN ('CO2', 'CH4_AGR', 'N2O_AGR')
              UNION ALL SELECT scenario, region, 'CO2', year, value FROM luc_emissions) e) u
  LEFT JOIN rb g ON u.region = g.region
  GROUP BY u.scenario, g.report_region, u.year),
feed_in AS (
  SELECT f.scenario AS Scenario, g.report_region AS Region, m.Item, f.year AS Year,
         CAST({strict('f.value')} AS DOUBLE) * {d(1000.0)} AS Value
  FROM feed f LEFT JOIN rb g ON f.region = g.region
  LEFT JOIN ib m ON f.sector IS NOT DISTINCT FROM m.commodity_key
  GROUP BY f.scenario, g.report_region, m.Item, f.year),
feef AS (
  SELECT a.Scenario, a.Region, a.Item, a.Year, CAST(a.Value AS DOUBLE) / f.Value AS Value
  FROM an_sum a LEFT JOIN feed_in f ON {nsafe('a', 'f', ['Scenario', 'Region', 'Item', 'Year'])}),
shares AS (
  SELECT u.scenario, u.region, u.sector, u.input, u.year,
         CAST(u.value AS DOUBLE) / CAST(t.total AS DOUBLE) AS share
  FROM ag_use u JOIN (SELECT scenario, region, sector, year, {strict('value')} AS total
                      FROM ag_use WHERE sector IN ('food_use', 'feed_use', 'outside')
                      GROUP BY scenario, region, sector, year) t
    ON {nsafe('u', 't', ['scenario', 'region', 'sector', 'year'])}
  WHERE u.sector IN ('food_use', 'feed_use', 'outside')),
feed_by_crop AS (
  SELECT f.scenario, f.region, f.sector, f.year,
         CASE WHEN f.input IS NULL THEN NULL WHEN f.input = 'other_use' THEN 'PROMO' ELSE s.input END AS input,
         CAST(f.value AS DOUBLE)
           * CASE WHEN f.input IS NULL THEN NULL WHEN f.input = 'other_use' THEN 1.0 ELSE s.share END AS value
  FROM feed f LEFT JOIN shares s
    ON f.scenario IS NOT DISTINCT FROM s.scenario AND f.region IS NOT DISTINCT FROM s.region
   AND f.input IS NOT DISTINCT FROM s.sector AND f.year IS NOT DISTINCT FROM s.year),
feed_alloc AS (
  SELECT r.scenario AS Scenario, g.report_region AS Region, m2.Item, v.Variable, r.year AS Year,
         {strict('r.value')} AS Value
  FROM feed_by_crop r
  JOIN (SELECT commodity_key,
               CASE Item WHEN 'RUM' THEN 'FRUM' WHEN 'NRM' THEN 'FDRY' WHEN 'LSP' THEN 'FNRM' END AS Variable
        FROM ib WHERE Item IN ('RUM', 'NRM', 'LSP')) v ON r.sector IS NOT DISTINCT FROM v.commodity_key
  LEFT JOIN ib m2 ON r.input IS NOT DISTINCT FROM m2.commodity_key
  LEFT JOIN rb g ON r.region = g.region
  GROUP BY r.scenario, g.report_region, m2.Item, v.Variable, r.year),
ctax AS (
  SELECT c.Scenario, reg.Region, c.Year, CAST(c.value AS DOUBLE) * {d(1.516)} / {d(44 / 12)} AS Value
  FROM (SELECT Scenario, Year, coalesce(value, 0) AS value FROM (
          SELECT Scenario, Year, value FROM (SELECT DISTINCT scenario AS Scenario, year AS Year, value
                                             FROM co2_prices WHERE NOT coalesce(contains(market, '_LUC'), false)) pr
          UNION ALL
          SELECT sc.Scenario, yr.Year, NULL
          FROM (SELECT DISTINCT year AS Year FROM co2_prices WHERE NOT coalesce(contains(market, '_LUC'), false)) yr
          CROSS JOIN (SELECT DISTINCT Scenario FROM popt) sc
          WHERE NOT EXISTS (SELECT 1 FROM co2_prices q WHERE NOT coalesce(contains(q.market, '_LUC'), false)
                            AND q.scenario IS NOT DISTINCT FROM sc.Scenario AND q.year = yr.Year)) x) c
  CROSS JOIN (SELECT DISTINCT report_region AS Region FROM rb) reg),
yecc AS (
  SELECT n.Scenario, n.Region, n.Item, n.Year,
         (n.Value / b.Value - 1) * {d(100.0)} AS Value
  FROM yexo n JOIN pairs m ON n.Scenario = m.CC_Scenario
  LEFT JOIN yexo b ON b.Scenario IS NOT DISTINCT FROM m.NoCC_Scenario
                  AND {nsafe('b', 'n', ['Region', 'Item', 'Year'])})
"""


def template(src: str, variable: str | None, unit: str, item: str | None = None) -> str:
    var = f"'{variable}'" if variable else "Variable"
    it = f"'{item}'" if item else "Item"
    return (f"SELECT 'PANEL' AS Model, Scenario, Region, {it} AS Item, {var} AS Variable, "
            f"CAST(Year AS INTEGER) AS Year, '{unit}' AS Unit, CAST(Value AS DOUBLE) AS Value FROM {src}")


def densified(src: str, items, fill_value: str = "0") -> str:
    """Grid (Scenario, Region) x items x years, missing cells added, null/NaN -> 0."""
    item_rows = "(VALUES " + ", ".join(f"('{i}')" for i in items) + ") AS it(Item)"
    return f"""(SELECT Scenario, Region, Item, Year,
        CASE WHEN Value IS NULL OR isnan(Value) THEN {fill_value} ELSE Value END AS Value FROM (
      SELECT Scenario, Region, Item, Year, Value FROM {src}
      UNION ALL
      SELECT k.Scenario, k.Region, it.Item, yy.Year, NULL
      FROM (SELECT DISTINCT Scenario, Region FROM {src}) k CROSS JOIN {item_rows} CROSS JOIN {YEAR_ROWS}
      WHERE NOT EXISTS (SELECT 1 FROM {src} s WHERE {nsafe('s', 'k', ['Scenario', 'Region'])}
                        AND s.Item IS NOT DISTINCT FROM it.Item AND s.Year = yy.Year)) g)"""


def densified_observed(src: str) -> str:
    """Grid (Scenario, Region) x observed items x years."""
    return f"""(SELECT Scenario, Region, Item, Year,
        CASE WHEN Value IS NULL OR isnan(Value) THEN 0 ELSE Value END AS Value FROM (
      SELECT Scenario, Region, Item, Year, Value FROM {src}
      UNION ALL
      SELECT k.Scenario, k.Region, it.Item, yy.Year, NULL
      FROM (SELECT DISTINCT Scenario, Region FROM {src}) k
      CROSS JOIN (SELECT DISTINCT Item FROM {src}) it CROSS JOIN {YEAR_ROWS}
      WHERE NOT EXISTS (SELECT 1 FROM {src} s WHERE {nsafe('s', 'k', ['Scenario', 'Region'])}
                        AND s.Item IS NOT DISTINCT FROM it.Item AND s.Year = yy.Year)) g)"""


def ratio(area: str, prod: str) -> str:
    return f"""(SELECT a.Scenario, a.Region, a.Item, a.Year,
        CASE WHEN v IS NULL OR isnan(v) THEN 0 ELSE v END AS Value
      FROM (SELECT a.*, CAST(p.Value AS DOUBLE) / a.Value AS v
            FROM {area} a LEFT JOIN {prod} p ON {nsafe('a', 'p', ['Scenario', 'Region', 'Item', 'Year'])}) a)"""


def with_all(body: str) -> str:
    return "WITH " + SOURCES.strip() + ",\n" + INDICATORS.strip() + "\n" + body


TRADE = PRICE_ITEMS

BODIES: dict[str, str] = {
    "panel_scan": "SELECT scenario AS Scenario, region, sector, technology, CAST(year AS INTEGER) AS Year, "
                  "CAST(value AS DOUBLE) AS value FROM ag_prod WHERE year IN " + YEARS,
    "bridge_region": "SELECT region, report_region FROM rb",
    "bridge_item": """SELECT s.sector AS commodity_key, ib.Item
      FROM (SELECT DISTINCT CASE WHEN p_brand = 'Brand#25' THEN 'unlisted' ELSE p_type END AS sector FROM part) s
      LEFT JOIN ib ON s.sector IS NOT DISTINCT FROM ib.commodity_key""",
    "bridge_land": """SELECT l.landleaf, l.land_type, lb.Item
      FROM (SELECT DISTINCT landleaf, regexp_split_to_array(landleaf, '[^[:alnum:]]+')[1] AS land_type
            FROM land_cover) l
      LEFT JOIN lb ON l.land_type = lb.land_type""",
    "bridge_disposition": """SELECT s.sector, db.Variable
      FROM (SELECT DISTINCT CASE WHEN p_size <= 20 THEN 'food_use' WHEN p_size <= 35 THEN 'feed_use'
                                 WHEN p_size <= 45 THEN 'other_use' ELSE 'outside' END AS sector FROM part) s
      LEFT JOIN db ON s.sector = db.sector""",
    "attribute_surface": "SELECT region, commodity_key, CAST(waste_frac AS DOUBLE) AS waste_frac FROM waste",
    "split_key": """SELECT k AS key,
        regexp_split_to_array(k, '[^[:alnum:]]+')[1] AS part1, regexp_split_to_array(k, '[^[:alnum:]]+')[2] AS part2,
        regexp_split_to_array(k, '[^[:alnum:]]+')[3] AS part3, regexp_split_to_array(k, '[^[:alnum:]]+')[4] AS part4
      FROM (SELECT DISTINCT technology AS k FROM panel_all UNION SELECT DISTINCT p_name FROM part) s""",
    "stack_scenarios": """SELECT scenario, region, sector, yr AS year, CAST(qty AS DOUBLE) AS value FROM panel_all WHERE scenario = 'A'
      UNION ALL SELECT scenario, region, sector, yr, CAST(qty AS DOUBLE) FROM panel_all WHERE scenario = 'N'
      UNION ALL SELECT scenario, region, NULL, yr, CAST(qty AS DOUBLE) FROM panel_all WHERE scenario = 'R'""",
    "ingest_no_clobber": """SELECT scenario, region, yr AS year, CAST(qty AS DOUBLE) AS value FROM panel_all
      WHERE scenario NOT IN (SELECT DISTINCT scenario FROM panel_all WHERE scenario = 'N')""",
    "ingest_two_writers": "SELECT scenario, region, yr AS year, CAST(qty AS DOUBLE) AS value FROM panel_all",
    "per_scenario_base": """SELECT f.scenario AS Scenario, f.region, f.sector, f.year AS Year, CAST(f.value AS DOUBLE) AS value
      FROM shifted f JOIN (SELECT scenario, min(year) AS first FROM shifted WHERE year IN """ + YEARS + """
                           GROUP BY scenario) b ON f.scenario = b.scenario AND f.year = b.first""",
    "study_subset": """SELECT s.study, t.* FROM (""" + template("popt", "POPT", "million", "TOT") + """) t
      JOIN (VALUES ('main', 'A'), ('main', 'N'), ('main', 'R'), ('alt', 'N')) AS s(study, scenario)
        ON t.Scenario = s.scenario""",
    "map_blank": """SELECT region, r1 AS Region1, r2 AS Region2, r3 AS Region3,
        1 + CASE WHEN r2 IS NULL THEN 0 ELSE 1 END + 1 AS regions FROM rb_wide""",
    "map_na": "SELECT region, coalesce(r2, 'NA') AS as_text, r2 AS as_null FROM rb_wide",
    "optional_source": """SELECT 'full' AS project, 'POPT' AS Variable, count(*) AS rows FROM popt
      UNION ALL SELECT 'full', 'CTAX', count(*) FROM ctax UNION ALL SELECT 'without', 'POPT', count(*) FROM popt""",
    "template_csv": f"""SELECT 1 AS line_no,
        '"Model","Scenario","Region","Item","Variable","Year","Unit","Value"' AS line
      UNION ALL SELECT 1 + row_number() OVER (ORDER BY place, Scenario, Region NULLS LAST, Year, line), line
      FROM (SELECT *, '"' || Model || '","' || Scenario || '",' || coalesce('"' || Region || '"', 'NA') || ',"' || Item
                   || '","' || Variable || '",' || Year || ',"' || Unit || '",' || coalesce(CAST(Value AS VARCHAR), 'NA') AS line
            FROM (SELECT 1 AS place, * FROM ({template("popt", "POPT", "million", "TOT")})
                  UNION ALL SELECT 2, * FROM (
                    SELECT 'PANEL' AS Model, f.scenario AS Scenario, b.report_region AS Region, 'TOT' AS Item,
                           'GDPT' AS Variable, CAST(f.year AS INTEGER) AS Year, 'bn USD 2005 MER' AS Unit,
                           CAST({strict('f.value')} AS DOUBLE) * {d(0.001)} * {d(1.377)} AS Value
                    FROM pop_qty f LEFT JOIN rb b ON f.region = b.region GROUP BY f.scenario, b.report_region, f.year)) t)""",
    "study_files": """SELECT '04Mar2021' AS run_date, s.name AS study, count(*) AS lines,
        count(DISTINCT t.Scenario) AS scenarios
      FROM popt t JOIN (VALUES ('PANEL_MAIN_ALL', 'A'), ('PANEL_MAIN_ALL', 'N'), ('PANEL_MAIN_ALL', 'R'),
                               ('PANEL_ALT_ALL', 'N')) AS s(name, scenario) ON t.Scenario = s.scenario
      GROUP BY s.name""",
    "strict_sum": f"""SELECT scenario AS Scenario, region, sector,
        CAST({strict("CASE WHEN sector = 'unlisted' THEN NULL ELSE frac END")} AS DOUBLE) AS value
      FROM panel_all GROUP BY scenario, region, sector""",
    "skip_sum": f"""SELECT scenario AS Scenario, region,
        CAST({strict("CASE WHEN sector = 'unlisted' THEN NULL ELSE frac END")} AS DOUBLE) AS strict_value,
        CAST(sum(CASE WHEN sector = 'unlisted' THEN NULL ELSE frac END) AS DOUBLE) AS skip_value
      FROM panel_all GROUP BY scenario, region""",
    "rollup_total": f"""SELECT 'PANEL' AS Model, f.scenario AS Scenario, b.report_region AS Region, 'TOT' AS Item,
        'POPT' AS Variable, CAST(f.year AS INTEGER) AS Year, 'million' AS Unit,
        CAST({strict('f.value')} AS DOUBLE) * {d(0.001)} AS Value
      FROM pop_qty f LEFT JOIN rb b ON f.region = b.region
      GROUP BY f.scenario, b.report_region, f.year""",
    "rollup_total_scaled": f"""SELECT 'PANEL' AS Model, f.scenario AS Scenario, b.report_region AS Region, 'TOT' AS Item,
        'GDPT' AS Variable, CAST(f.year AS INTEGER) AS Year, 'bn USD 2005 MER' AS Unit,
        CAST({strict('f.value')} AS DOUBLE) * {d(0.001)} * {d(1.377)} AS Value
      FROM pop_qty f LEFT JOIN rb b ON f.region = b.region
      GROUP BY f.scenario, b.report_region, f.year""",
    "rollup_population": template("popt", "POPT", "million", "TOT"),
    "rollup_items": "SELECT 'PANEL' AS Model, Scenario, Region, Item, 'PROD' AS Variable, CAST(Year AS INTEGER) AS Year, "
                    "'1000 t' AS Unit, CAST(Value AS DOUBLE) AS Value FROM an_sum",
    "rollup_items_listed": "SELECT 'PANEL' AS Model, Scenario, Region, Item, 'PROD' AS Variable, "
                           "CAST(Year AS INTEGER) AS Year, '1000 t' AS Unit, CAST(Value AS DOUBLE) AS Value FROM ag_sum",
    "convert_by_sector": """SELECT scenario AS Scenario, region, s AS sector, technology, CAST(year AS INTEGER) AS Year,
        CAST(CASE WHEN s IS NULL THEN NULL WHEN s = 'LARGE' THEN value * 57100 ELSE value * 1000 END AS DOUBLE) AS value
      FROM (SELECT *, CASE WHEN sector = 'unlisted' THEN NULL ELSE sector END AS s FROM ag_prod) a""",
    "null_key_fanout": f"""SELECT a.scenario AS Scenario, m.Item, CAST({strict('a.value')} AS DOUBLE) AS value
      FROM ag_prod a JOIN ib m ON m.commodity_key IS NULL
      WHERE a.sector = 'unlisted'
      GROUP BY a.scenario, m.Item""",
    "convert_by_pattern": template("emis", "EMIS", "MtCO2e", "TOT"),
    "land_cover": template("land_ind", "LAND", "1000 ha"),
    "area_rollup": template("area", "AREA", "1000 ha"),
    "area_colocated": template("area", "AREA", "1000 ha"),
    "exog_yield_colocated": template("yexo", "YEXO", "t/ha"),
    "long_list": """SELECT l_returnflag, count(*) AS lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
      FROM lineitem WHERE l_orderkey % 3 = 0 AND l_orderkey < 300000 AND l_orderkey >= 0 GROUP BY l_returnflag""",
    "unit_graph": f"""SELECT 'production' AS measure, scenario AS Scenario, CAST(year AS INTEGER) AS Year,
        CAST(sum(CASE WHEN sector = 'unlisted' THEN NULL WHEN sector = 'LARGE' THEN value * 57100 ELSE value * 1000 END)
             AS DOUBLE) AS value
      FROM ag_prod GROUP BY scenario, year
      UNION ALL SELECT 'emissions', scenario, CAST(year AS INTEGER), CAST({strict('v')} AS DOUBLE)
      FROM (SELECT scenario, year, CASE WHEN contains(gas, 'N2O') THEN value * 298 WHEN contains(gas, 'CH4') THEN value * 28
                                        ELSE value * {44 / 12!r} END AS v
            FROM (SELECT scenario, ghg AS gas, year, value FROM emissions WHERE ghg IN ('CO2', 'CH4_AGR', 'N2O_AGR')
                  UNION ALL SELECT scenario, 'CO2', year, value FROM luc_emissions) e) u
      GROUP BY scenario, year""",
    "area_rainfed": template("arrf", "ARRF", "1000 ha"),
    "area_irrigated": template("arir", "ARIR", "1000 ha"),
    "production_union": template("prod", "PROD", "1000 t"),
    "densify_years": template("ag_full", "PROD", "1000 t"),
    "ratio_yield": template(ratio("area", "ag_full"), "YILD", "t/ha"),
    "ratio_yield_irrigated": template(ratio("arir", "ag_full_ir"), "YIIR", "t/ha"),
    "ratio_yield_rainfed": template(ratio("arrf", "ag_full_rf"), "YIRF", "t/ha"),
    "base_year_rows": """SELECT scenario AS Scenario, region, sector, technology, CAST(year AS INTEGER) AS Year,
        CAST(value AS DOUBLE) AS value FROM ag_prod WHERE year = (SELECT min(year) FROM ag_prod)""",
    "base_year_override": """SELECT scenario AS Scenario, region, sector, technology, CAST(year AS INTEGER) AS Year,
        CAST(value AS DOUBLE) AS value FROM ag_prod
      WHERE year = (SELECT min(year) FROM ag_prod) OR (sector = 'LARGE' AND year = 1997)""",
    "price_index": template("xprp", "XPRP", "USD/t"),
    "exog_yield_index": template("yexo", "YEXO", "t/ha"),
    "disposition": template("demand", None, "1000 t"),
    "trade_imports": template(densified("impo_sum", TRADE), "IMPO", "1000 t"),
    "trade_exports": template(densified("expo_sum", TRADE), "EXPO", "1000 t"),
    "net_trade": template(f"""(SELECT e.Scenario, e.Region, e.Item, e.Year, e.Value - i.Value AS Value
        FROM {densified('expo_sum', TRADE)} e LEFT JOIN {densified('impo_sum', TRADE)} i
          ON {nsafe('e', 'i', ['Scenario', 'Region', 'Item', 'Year'])})""", "NETT", "1000 t"),
    "inputs_densified": template(densified("frtn_sum", AREA_ITEMS), "FRTN", "1000 t"),
    "inputs_densified_keep_null": template(densified("watr_sum", AREA_ITEMS), "WATR", "km3"),
    "densify_items": template(densified(f"""(SELECT f.scenario AS Scenario, g.report_region AS Region, m.Item,
          f.year AS Year, CAST({strict('f.value')} AS DOUBLE) * {d(1000.0)} AS Value
        FROM (SELECT scenario, CASE WHEN qty > 45 THEN region ELSE 'elsewhere' END AS region, sector, yr AS year,
                     CAST(sum(qty) AS DECIMAL(18,2)) AS value
              FROM panel GROUP BY 1, 2, 3, 4) f
        JOIN ib m ON f.sector IS NOT DISTINCT FROM m.commodity_key
        LEFT JOIN rb g ON f.region = g.region
        GROUP BY f.scenario, g.report_region, m.Item, f.year)""", TRADE), "IMPO", "1000 t"),
    "densify_observed": template(densified_observed("ech4_sum"), "ECH4", "MtCO2e"),
    "densify_observed_2": template(densified_observed("en2o_sum"), "EN2O", "MtCO2e"),
    "per_capita": template("calo", "CALO", "kcal/cap/d"),
    "per_capita_net_waste": template("cali", "CALI", "kcal/cap/d"),
    "union_missing_cols": template("eco2", "ECO2", "MtCO2e", "TOT"),
    "feed_efficiency": template("feef", "FEEF", "kg prt/kg prt"),
    "group_share": f"""SELECT g.scenario AS Scenario, g.technology, g.disposition, g.yr AS Year,
        CAST(g.value AS DOUBLE) AS value, CAST(g.value AS DOUBLE) / CAST(t.total AS DOUBLE) AS share
      FROM (SELECT scenario, technology, disposition, yr, sum(frac) AS value FROM panel_all
            GROUP BY scenario, technology, disposition, yr) g
      JOIN (SELECT scenario, technology, yr, sum(frac) AS total FROM panel_all
            GROUP BY scenario, technology, yr) t
        ON {nsafe('g', 't', ['scenario', 'technology', 'yr'])}""",
    "heavy_groups": """SELECT sector, disposition, count(*) AS rows FROM panel_all GROUP BY sector, disposition
      HAVING count(*) * 40 > (SELECT count(*) FROM panel_all)""",
    "feed_alloc_scaled": template("(SELECT * REPLACE (Value * CAST(1000 AS DOUBLE) AS Value) FROM feed_alloc)", None, "1000 t"),
    "feed_alloc_a": template("(SELECT * FROM feed_alloc WHERE Variable = 'FRUM')", "FRUM", "1000 t"),
    "feed_alloc_b": template("(SELECT * FROM feed_alloc WHERE Variable = 'FDRY')", "FDRY", "1000 t"),
    "feed_alloc_c": template("(SELECT * FROM feed_alloc WHERE Variable = 'FNRM')", "FNRM", "1000 t"),
    "price_grid": template("ctax", "CTAX", "USD/tCO2e", "TOT"),
    "baseline_shift": template("yecc", "YECC", "%"),
    "per_capita_net_waste_skip": template(f"""(SELECT c.Scenario, c.Region, c.Item, c.Year,
        CAST(c.v AS DOUBLE) * {d(1e6)} / p.Value / {d(365.25)} AS Value
      FROM (SELECT f.scenario AS Scenario, g.report_region AS Region, m.Item, f.year AS Year,
                   sum(f.value * (1 - w.waste_frac)) AS v
            FROM food f LEFT JOIN ib m ON f.subsector IS NOT DISTINCT FROM m.commodity_key
            LEFT JOIN rb g ON f.region = g.region
            LEFT JOIN waste w ON f.region IS NOT DISTINCT FROM w.region
                             AND f.subsector IS NOT DISTINCT FROM w.commodity_key
            GROUP BY f.scenario, g.report_region, m.Item, f.year) c
      LEFT JOIN (SELECT f.scenario AS Scenario, b.report_region AS Region, f.year AS Year,
                        CAST(sum(f.value) AS DOUBLE) * {d(0.001)} AS Value
                 FROM population f LEFT JOIN rb b ON f.region = b.region
                 GROUP BY f.scenario, b.report_region, f.year) p
        ON {nsafe('c', 'p', ['Scenario', 'Region', 'Year'])})""", "CALI", "kcal/cap/d"),
    "rollup_items_mapped": "SELECT 'PANEL' AS Model, Scenario, Region, Item, 'PROD' AS Variable, "
                           "CAST(Year AS INTEGER) AS Year, '1000 t' AS Unit, CAST(Value AS DOUBLE) AS Value "
                           "FROM an_sum WHERE Item IS NOT NULL",
    "price_index_safe": template(f"""(SELECT Scenario, Region, Item, Year,
        CAST(rev AS DOUBLE) / CAST(prd AS DOUBLE) * {d(1000.0)} * {d(3.228)} AS Value
      FROM (SELECT r.scenario AS Scenario, g.report_region AS Region, m.Item, r.year AS Year,
                   {strict('r.revenue')} AS rev, {strict('r.prod')} AS prd
            FROM (SELECT b.scenario, b.region, b.sector, p.year, b.prod, b.prod * p.value AS revenue
                  FROM xprp_base b JOIN ag_prices p
                    ON b.scenario = p.scenario AND b.region = p.region AND b.sector = p.sector
                  UNION ALL
                  SELECT b.scenario, b.region, b.sector, p.year, b.prod, b.prod * p.value
                  FROM xprp_an_base b JOIN an_prices p
                    ON b.scenario = p.scenario AND b.region = p.region AND b.sector = p.sector) r
            JOIN ib m ON r.sector = m.commodity_key AND m.Item IN {lst(PRICE_ITEMS)}
            LEFT JOIN rb g ON r.region = g.region
            GROUP BY r.scenario, g.report_region, m.Item, r.year) s)""", "XPRP", "USD/t"),
    "exog_yield_index_safe": template(f"""(SELECT Scenario, Region, Item, Year,
        CAST(p AS DOUBLE) / CAST(a AS DOUBLE) * {d(10.0)} AS Value
      FROM (SELECT r.scenario AS Scenario, g.report_region AS Region, m.Item, r.year AS Year,
                   {strict('r.prod')} AS p, {strict('r.area')} AS a
            FROM (SELECT b.scenario, b.region, y.sector, y.year, b.area, b.area * y.yv AS prod
                  FROM (SELECT scenario, region, technology, value AS area FROM ha
                        WHERE year = (SELECT min(year) FROM ha)) b
                  JOIN (SELECT scenario, region, technology, sector, year,
                               CASE WHEN sector = 'LARGE' THEN value * 57.1 ELSE value END AS yv
                        FROM ag_yield) y
                    ON b.scenario = y.scenario AND b.region = y.region AND b.technology = y.technology) r
            JOIN ib m ON r.sector = m.commodity_key AND m.Item <> 'NRG'
            LEFT JOIN rb g ON r.region = g.region
            GROUP BY r.scenario, g.report_region, m.Item, r.year) s)""", "YEXO", "t/ha"),
}

FINAL_PARTS = [
    template("popt", "POPT", "million", "TOT"),
    BODIES["rollup_total_scaled"].replace("FROM pop_qty", "FROM pop_qty"),
    BODIES["land_cover"], BODIES["area_rollup"], BODIES["area_rainfed"], BODIES["area_irrigated"],
    BODIES["production_union"], BODIES["price_index"], BODIES["ratio_yield"], BODIES["ratio_yield_irrigated"],
    BODIES["ratio_yield_rainfed"], BODIES["exog_yield_index"], BODIES["disposition"], BODIES["trade_imports"],
    BODIES["trade_exports"], BODIES["net_trade"], BODIES["inputs_densified"], BODIES["inputs_densified_keep_null"],
    BODIES["per_capita"], BODIES["per_capita_net_waste"], BODIES["convert_by_pattern"], BODIES["union_missing_cols"],
    BODIES["densify_observed"], BODIES["densify_observed_2"], BODIES["feed_efficiency"],
    template("feed_alloc", None, "1000 t"), BODIES["price_grid"],
]
BODIES["final_template"] = BODIES["report_incremental"] = "\nUNION ALL\n".join(f"({p})" for p in FINAL_PARTS)


def oracle_sql() -> dict[str, str]:
    return {k: with_all(v) for k, v in BODIES.items()}
