"""Shared DuckDB CTE text.

Every oracle query is ``WITH <ctes> SELECT ...`` over the driver's
pre-registered views (``lineitem``, ``part``). The rules mirror
``weekcast.sources.panel`` and ``weekcast.operators.features`` but are
written independently in SQL.
"""

from __future__ import annotations

W = "PARTITION BY sku_id ORDER BY week"


def prev(n: int) -> str:
    return f"({W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


PANEL = """
pk AS (
  SELECT p_partkey, p_type, p_retailprice,
         CAST(substr(p_brand, 7) AS INTEGER) AS brand_no,
         CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'LARGE' THEN 1 WHEN 'MEDIUM' THEN 2
                     WHEN 'PROMO' THEN 3 WHEN 'SMALL' THEN 4 WHEN 'STANDARD' THEN 5 END AS type_no
  FROM part
),
pks AS (SELECT *, CAST(brand_no * 6 + type_no AS BIGINT) AS sku_num FROM pk),
weekly AS (
  SELECT s.sku_num, CAST(date_trunc('week', l.l_shipdate) AS DATE) AS week, sum(l.l_quantity) AS qty
  FROM lineitem l JOIN pks s ON l.l_partkey = s.p_partkey
  GROUP BY 1, 2
),
cal AS (
  SELECT CAST(unnest(generate_series(CAST(min(week) AS TIMESTAMP), CAST(max(week) AS TIMESTAMP),
                                     INTERVAL 7 DAY)) AS DATE) AS week
  FROM weekly
),
calf AS (
  SELECT week,
         CAST(date_diff('day', DATE '1995-01-02', week) // 7 AS INTEGER) AS week_idx,
         CAST(weekofyear(week) IN (1, 2, 26, 51, 52) AS INTEGER) AS holiday_flag,
         CAST((weekofyear(week) BETWEEN 14 AND 21 OR weekofyear(week) BETWEEN 40 AND 47)
              AND (date_diff('day', DATE '1995-01-02', week) // 7) % 2 = 0 AS INTEGER) AS promotion_flag
  FROM cal
),
dense AS (
  SELECT g.sku_num, g.week, coalesce(w.qty, 0.0) AS true_demand
  FROM (SELECT s.sku_num, c.week FROM (SELECT DISTINCT sku_num FROM weekly) s CROSS JOIN cal c) g
  LEFT JOIN weekly w ON w.sku_num = g.sku_num AND w.week = g.week
),
panel AS (
  SELECT d.sku_num, 'PART-' || CAST(d.sku_num + 10000 AS VARCHAR) AS sku_id, d.week, c.week_idx,
         d.true_demand,
         CAST((d.sku_num * 13 + (c.week_idx // 3) * 7) % 17 = 0 AS INTEGER) AS stockout_flag,
         CAST((d.sku_num * 7 + c.week_idx * 11) % 40 = 0 AS INTEGER) AS missing_flag,
         CASE WHEN (d.sku_num * 7 + c.week_idx * 11) % 40 = 0 THEN NULL
              WHEN (d.sku_num * 13 + (c.week_idx // 3) * 7) % 17 = 0 THEN 0.0
              ELSE d.true_demand END AS demand,
         c.holiday_flag, c.promotion_flag
  FROM dense d JOIN calf c ON c.week = d.week
),
meta AS (
  SELECT 'PART-' || CAST(sku_num + 10000 AS VARCHAR) AS sku_id,
         min(CASE p_type WHEN 'ECONOMY' THEN 'fast_moving' WHEN 'STANDARD' THEN 'fast_moving'
                         WHEN 'SMALL' THEN 'slow_moving' WHEN 'MEDIUM' THEN 'intermittent'
                         WHEN 'PROMO' THEN 'intermittent' WHEN 'LARGE' THEN 'seasonal' END) AS category,
         min(CASE brand_no % 3 WHEN 0 THEN 'APAC' WHEN 1 THEN 'EMEA' WHEN 2 THEN 'NA' END) AS supplier_region,
         CAST(CAST(floor((sum(round(p_retailprice * 100)) * 2 + count(*)) / (count(*) * 2)) AS BIGINT) AS DOUBLE)
           / 100 AS unit_cost,
         CAST(1 + sku_num % 8 AS INTEGER) AS lead_time_weeks
  FROM pks
  WHERE sku_num IN (SELECT sku_num FROM weekly)
  GROUP BY sku_num
)"""

def features_sql(src: str = "panel", out: str = "features", p: str = "") -> str:
    return f"""
{p}filled AS (
  SELECT *, coalesce(
      last_value(demand IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value(demand IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    ) AS demand_filled
  FROM {src}
),
{p}adjusted AS (
  SELECT *, CASE WHEN stockout_flag = 1
                 THEN coalesce(avg(CASE WHEN stockout_flag = 0 THEN demand_filled END) OVER {prev(12)},
                               demand_filled)
                 ELSE demand_filled END AS demand_adjusted
  FROM {p}filled
),
{p}tfeat AS (
  SELECT *,
    lag(demand_adjusted, 1) OVER ({W}) AS lag_1,
    lag(demand_adjusted, 2) OVER ({W}) AS lag_2,
    lag(demand_adjusted, 4) OVER ({W}) AS lag_4,
    lag(demand_adjusted, 8) OVER ({W}) AS lag_8,
    lag(demand_adjusted, 12) OVER ({W}) AS lag_12,
    lag(demand_adjusted, 26) OVER ({W}) AS lag_26,
    lag(demand_adjusted, 52) OVER ({W}) AS lag_52,
    avg(demand_adjusted) OVER {prev(4)} AS rolling_mean_4w,
    coalesce(stddev_samp(demand_adjusted) OVER {prev(4)}, 0.0) AS rolling_std_4w,
    avg(demand_adjusted) OVER {prev(12)} AS rolling_mean_12w,
    coalesce(stddev_samp(demand_adjusted) OVER {prev(12)}, 0.0) AS rolling_std_12w,
    min(demand_adjusted) OVER {prev(4)} AS rolling_min_4w,
    max(demand_adjusted) OVER {prev(4)} AS rolling_max_4w,
    lag(demand_adjusted, 1) OVER ({W}) / nullif(lag(demand_adjusted, 2) OVER ({W}), 0) - 1 AS demand_change_1w,
    lag(demand_adjusted, 1) OVER ({W}) / nullif(lag(demand_adjusted, 5) OVER ({W}), 0) - 1 AS demand_change_4w,
    CAST(weekofyear(week) AS INTEGER) AS week_of_year,
    CAST(month(week) AS INTEGER) AS month,
    CAST(quarter(week) AS INTEGER) AS quarter,
    CAST(quarter(week) = 1 AS INTEGER) AS is_q1,
    CAST(quarter(week) = 4 AS INTEGER) AS is_q4,
    CASE WHEN count(demand_adjusted) OVER {prev(12)} > 0
         THEN sum(CAST(demand_adjusted = 0 AS INTEGER)) OVER {prev(12)}
              / least(row_number() OVER ({W}), 12) END AS zero_demand_ratio_12w
  FROM {p}adjusted
),
{out} AS (
  SELECT t.*, m.category, m.supplier_region, m.unit_cost, m.lead_time_weeks,
    CAST(coalesce(CASE m.supplier_region WHEN 'APAC' THEN 0 WHEN 'EMEA' THEN 1 WHEN 'NA' THEN 2 END, -1)
         AS INTEGER) AS supplier_region_enc,
    CAST(coalesce(CASE m.category WHEN 'fast_moving' THEN 0 WHEN 'intermittent' THEN 1
                                  WHEN 'seasonal' THEN 2 WHEN 'slow_moving' THEN 3 END, -1)
         AS INTEGER) AS category_enc,
    CAST(coalesce(m.category = 'fast_moving', false) AS INTEGER) AS cat_fast_moving,
    CAST(coalesce(m.category = 'intermittent', false) AS INTEGER) AS cat_intermittent,
    CAST(coalesce(m.category = 'seasonal', false) AS INTEGER) AS cat_seasonal,
    CAST(coalesce(m.category = 'slow_moving', false) AS INTEGER) AS cat_slow_moving,
    CAST(coalesce(m.supplier_region = 'APAC', false) AS INTEGER) AS region_APAC,
    CAST(coalesce(m.supplier_region = 'EMEA', false) AS INTEGER) AS region_EMEA,
    CAST(coalesce(m.supplier_region = 'NA', false) AS INTEGER) AS region_NA,
    ln(1 + m.unit_cost) AS log_unit_cost
  FROM {p}tfeat t LEFT JOIN meta m ON m.sku_id = t.sku_id
)"""


FEATURES = features_sql()


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts)


def rnd(*cols: str, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c.split('.')[-1]}" for c in cols)
