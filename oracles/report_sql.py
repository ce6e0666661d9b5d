"""Oracle SQL for reporting aggregates."""

from __future__ import annotations

from oracles.ctes import FEATURES, PANEL, with_ctes
from oracles.eval_sql import BASE, ONE_STEP, SCORED, baselines_sql, metric_sql, MODEL

F = with_ctes(PANEL, FEATURES)
LB = with_ctes(PANEL, FEATURES, MODEL, baselines_sql("train", "sku_id", "13", ""), SCORED, ONE_STEP) + f""",
lb AS (SELECT model, {metric_sql()} FROM scored GROUP BY model
       UNION ALL SELECT model, {metric_sql(lo='p10', hi='p90')} FROM oi GROUP BY model)"""

SQL: dict[str, str] = {}
SQL["weekly_totals"] = F + """
SELECT week, round(avg(demand), 6) AS mean_demand, round(coalesce(sum(demand), 0.0), 6) AS total_demand,
       round(stddev_samp(demand), 6) AS std_demand FROM features GROUP BY week"""
SQL["category_mix"] = with_ctes(PANEL) + "\nSELECT category, count(*) AS n_skus FROM meta GROUP BY category"
SQL["demand_box_by_category"] = F + """
SELECT category, count(*) AS n,
       round(quantile_cont(demand, 0.0), 6) AS min, round(quantile_cont(demand, 0.25), 6) AS q1,
       round(quantile_cont(demand, 0.5), 6) AS median, round(quantile_cont(demand, 0.75), 6) AS q3,
       round(quantile_cont(demand, 1.0), 6) AS max, round(avg(demand), 6) AS mean
FROM features WHERE category IS NOT NULL AND demand IS NOT NULL GROUP BY category"""
SQL["sku_stats"] = F + """
SELECT sku_id, round(avg(demand), 6) AS avg_demand, round(max(demand), 6) AS max_demand,
       round(avg(CAST(coalesce(demand = 0, false) AS DOUBLE)), 6) AS zero_share,
       CAST(sum(stockout_flag) AS BIGINT) AS stockout_weeks, CAST(sum(promotion_flag) AS BIGINT) AS promo_weeks
FROM features GROUP BY sku_id"""
SQL["weekly_by_category"] = F + """
SELECT week, category, round(avg(demand), 6) AS mean_demand FROM features WHERE category IS NOT NULL
GROUP BY week, category"""
SQL["zero_ratio_histogram"] = F + """
SELECT category, CAST(least(29, floor(zero_demand_ratio_12w * 30)) AS INTEGER) AS bin, count(*) AS n
FROM features WHERE zero_demand_ratio_12w IS NOT NULL AND category IS NOT NULL GROUP BY 1, 2"""
SQL["intermittency_summary"] = F + """
SELECT category, round(avg(zero_demand_ratio_12w), 3) AS mean_zero_ratio,
       round(median(zero_demand_ratio_12w), 3) AS median_zero_ratio,
       round(stddev_samp(zero_demand_ratio_12w), 3) AS std_zero_ratio
FROM features WHERE category IS NOT NULL GROUP BY category"""
SQL["demand_by_region"] = F + """
SELECT supplier_region, round(avg(demand), 6) AS mean_demand, round(coalesce(sum(demand), 0.0), 6) AS total_demand,
       count(demand) AS n_rows FROM features WHERE supplier_region IS NOT NULL GROUP BY supplier_region"""
SQL["distinct_skus"] = F + "\nSELECT count(DISTINCT sku_id) AS n_skus FROM features"
SQL["top20_skus"] = F + """
SELECT sku_id, category, round(avg(demand), 6) AS mean_demand FROM features WHERE category IS NOT NULL
GROUP BY sku_id, category ORDER BY avg(demand) DESC NULLS LAST, sku_id LIMIT 20"""
SQL["model_name_filter"] = LB + """
SELECT model, round(wape, 6) AS wape, regexp_matches(model, 'Naive') AS matches FROM lb"""
SQL["leaderboard_kpis"] = LB + """
SELECT round(min(CASE WHEN regexp_matches(model, 'RollingInterval') THEN wape END), 6) AS production_wape,
       round(min(CASE WHEN regexp_matches(model, 'RollingInterval') THEN coverage_80pct END), 6) AS production_coverage,
       round(min(CASE WHEN NOT regexp_matches(model, 'RollingInterval') THEN wape END), 6) AS best_baseline_wape,
       round(min(CASE WHEN NOT regexp_matches(model, 'RollingInterval') THEN wape END)
             - min(CASE WHEN regexp_matches(model, 'RollingInterval') THEN wape END), 6) AS gap_pp
FROM lb"""
FEATURES_34 = ["lag_1", "lag_2", "lag_4", "lag_8", "lag_12", "lag_26", "lag_52", "rolling_mean_4w",
               "rolling_mean_12w", "rolling_std_4w", "rolling_std_12w", "rolling_min_4w", "rolling_max_4w",
               "demand_change_1w", "demand_change_4w", "week_of_year", "month", "quarter", "is_q1", "is_q4",
               "holiday_flag", "promotion_flag", "lead_time_weeks", "log_unit_cost", "zero_demand_ratio_12w",
               "supplier_region_enc", "category_enc", "cat_fast_moving", "cat_slow_moving", "cat_intermittent",
               "cat_seasonal", "region_APAC", "region_EMEA", "region_NA"]
SQL["feature_group_label"] = F + """,
wide AS (SELECT sku_id, week, """ + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES_34) + """ FROM features),
long AS (UNPIVOT wide ON """ + ", ".join(FEATURES_34) + """ INTO NAME feature VALUE value)
SELECT feature, CASE WHEN starts_with(feature, 'lag_') THEN 'lag'
    WHEN starts_with(feature, 'rolling_') THEN 'rolling' WHEN starts_with(feature, 'demand_change') THEN 'velocity'
    WHEN feature IN ('week_of_year', 'month', 'quarter', 'is_q1', 'is_q4') THEN 'seasonality'
    WHEN feature IN ('promotion_flag', 'holiday_flag') THEN 'promo_holiday' ELSE 'other' END AS "group",
    count(value) AS n_values, round(avg(value), 6) AS mean_value
FROM long GROUP BY 1, 2"""
del BASE
