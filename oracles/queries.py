"""DuckDB oracle SQL, one entry per catalogue key."""

from __future__ import annotations

from oracles.ctes import FEATURES, PANEL, rnd, with_ctes

# fixed values: the 34 model inputs, in order
FEATURE_INPUTS = [
    "lag_1", "lag_2", "lag_4", "lag_8", "lag_12", "lag_26", "lag_52",
    "rolling_mean_4w", "rolling_mean_12w", "rolling_std_4w", "rolling_std_12w",
    "rolling_min_4w", "rolling_max_4w", "demand_change_1w", "demand_change_4w",
    "week_of_year", "month", "quarter", "is_q1", "is_q4", "holiday_flag", "promotion_flag",
    "lead_time_weeks", "log_unit_cost", "zero_demand_ratio_12w", "supplier_region_enc", "category_enc",
    "cat_fast_moving", "cat_slow_moving", "cat_intermittent", "cat_seasonal",
    "region_APAC", "region_EMEA", "region_NA",
]
DOUBLE_FEATURES = {
    "lag_1", "lag_2", "lag_4", "lag_8", "lag_12", "lag_26", "lag_52",
    "rolling_mean_4w", "rolling_mean_12w", "rolling_std_4w", "rolling_std_12w",
    "rolling_min_4w", "rolling_max_4w", "demand_change_1w", "demand_change_4w",
    "log_unit_cost", "zero_demand_ratio_12w", "demand", "demand_filled", "demand_adjusted",
    "unit_cost", "true_demand",
}


def cols(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" if n in DOUBLE_FEATURES else n for n in names)


def fview(*names: str) -> str:
    return with_ctes(PANEL, FEATURES) + f"\nSELECT sku_id, week, {cols(*names)} FROM features"


SQL: dict[str, str] = {}

# ---------------------------------------------------------------- panel
SQL["week_calendar"] = with_ctes(PANEL) + "\nSELECT week, week_idx, holiday_flag, promotion_flag FROM calf"
SQL["dense_panel"] = with_ctes(PANEL) + "\nSELECT sku_id, sku_num, week, week_idx, round(true_demand, 6) AS true_demand FROM panel"
SQL["observed_demand"] = with_ctes(PANEL) + f"""
SELECT sku_num, sku_id, week, week_idx, {cols('true_demand')}, stockout_flag, missing_flag, {cols('demand')},
       holiday_flag, promotion_flag FROM panel"""
SQL["sku_dimension"] = with_ctes(PANEL) + f"""
SELECT sku_id, category, supplier_region, {rnd('unit_cost')}, lead_time_weeks FROM meta"""
SQL["dataset_profile"] = with_ctes(PANEL) + """
SELECT count(*) AS n_rows, count(DISTINCT sku_id) AS n_skus, min(week) AS first_week, max(week) AS last_week,
       round(avg(CAST(demand IS NULL AS DOUBLE)) * 100, 6) AS pct_missing,
       round(avg(CAST(coalesce(demand = 0, false) AS DOUBLE)) * 100, 6) AS pct_zero
FROM panel"""
SQL["profile_inner_join"] = with_ctes(PANEL) + """
SELECT m.category, round(avg(p.demand), 6) AS mean_demand,
       round(avg(CAST(coalesce(p.demand = 0, false) AS DOUBLE)) * 100, 6) AS pct_zero
FROM panel p JOIN meta m ON m.sku_id = p.sku_id GROUP BY m.category"""

# ---------------------------------------------------------------- features
SQL["fill_gaps"] = fview("demand", "demand_filled")
SQL["stockout_adjusted"] = fview("stockout_flag", "demand_filled", "demand_adjusted")
SQL["lags"] = fview("lag_1", "lag_2", "lag_4", "lag_8", "lag_12", "lag_26", "lag_52")
SQL["rolling_mean"] = fview("rolling_mean_4w", "rolling_mean_12w")
SQL["rolling_std"] = fview("rolling_std_4w", "rolling_std_12w")
SQL["rolling_min_max"] = fview("rolling_min_4w", "rolling_max_4w")
SQL["demand_velocity"] = fview("demand_change_1w", "demand_change_4w")
SQL["calendar_features"] = fview("week_of_year", "month", "quarter", "is_q1", "is_q4")
SQL["zero_ratio_12w"] = fview("zero_demand_ratio_12w")
SQL["join_metadata"] = fview("category", "supplier_region", "unit_cost", "lead_time_weeks")
SQL["ordinal_encode"] = fview("supplier_region_enc", "category_enc")
SQL["one_hot"] = fview("cat_fast_moving", "cat_intermittent", "cat_seasonal", "cat_slow_moving",
                       "region_APAC", "region_EMEA", "region_NA")
SQL["log_unit_cost"] = fview("unit_cost", "log_unit_cost")
SQL["model_matrix"] = fview("demand", *FEATURE_INPUTS)

from oracles.eval_sql import SQL as _EVAL  # noqa: E402

SQL.update(_EVAL)
from oracles.drift_sql import SQL as _DRIFT  # noqa: E402

SQL.update(_DRIFT)
from oracles.report_sql import SQL as _REPORT  # noqa: E402

SQL.update(_REPORT)
from oracles.gate_sql import SQL as _GATE  # noqa: E402

SQL.update(_GATE)
from oracles.scoring_sql import SQL as _SCORING  # noqa: E402

SQL.update(_SCORING)

# ---------------------------------------------------------------- scale key: one SKU per part
_BRAND_TYPE = "CAST(brand_no * 6 + type_no AS BIGINT) AS sku_num"
assert _BRAND_TYPE in PANEL


def part_key(sql: str) -> str:
    """The same query over the panel with one SKU per part."""
    return sql.replace(_BRAND_TYPE, "CAST(p_partkey AS BIGINT) AS sku_num")


from oracles.drift_sql import DRIFT, ks_sql  # noqa: E402

SQL["features_part_key"] = part_key(SQL["model_matrix"])
SQL["leaderboard_part_key"] = part_key(SQL["leaderboard_sorted"])
SQL["batch_score_part_key"] = part_key(SQL["batch_score"])
SQL["ks_part_key"] = part_key(with_ctes(PANEL, FEATURES, """
model_rows AS (SELECT * FROM features WHERE demand IS NOT NULL),
recent AS (SELECT * FROM model_rows WHERE week IN (SELECT DISTINCT week FROM model_rows ORDER BY week DESC LIMIT 6))""",
    ks_sql("features", "recent", DRIFT))) + """
SELECT feature, n_ref, n_cur, round(ks_statistic, 6) AS ks_statistic, round(p_value, 6) AS p_value,
       p_value < 0.05 AS drifted FROM ks"""

SQL["scan_rejected_rows"] = with_ctes(PANEL) + """,
spoiled AS (
  SELECT CASE WHEN sku_num % 11 = 5 THEN NULL ELSE demand END AS demand, promotion_flag, stockout_flag,
         array_to_string(list_filter([
           CASE WHEN sku_num % 13 = 6 THEN 'sku_id: missing' END,
           CASE WHEN sku_num % 5 = 2 AND week_idx % 3 = 0 THEN 'week: not a date: notadate' END,
           CASE WHEN sku_num % 7 = 3 THEN 'demand: not a number: oops' END], lambda x: x IS NOT NULL), '; ') AS reasons
  FROM panel)
SELECT reasons, count(*) AS n_rows, CASE WHEN reasons = '' THEN count(demand) END AS n_demand,
       CASE WHEN reasons = '' THEN round(sum(demand), 6) END AS demand,
       CASE WHEN reasons = '' THEN CAST(sum(promotion_flag) AS BIGINT) END AS promotions,
       CASE WHEN reasons = '' THEN CAST(sum(stockout_flag) AS BIGINT) END AS stockouts
FROM spoiled GROUP BY reasons"""
