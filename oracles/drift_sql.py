"""Oracle SQL for the drift demo."""

from __future__ import annotations

from oracles.ctes import FEATURES, PANEL, features_sql, with_ctes
from oracles.eval_sql import metric_sql

DRIFT = ["lag_1", "rolling_mean_4w", "rolling_mean_12w", "zero_demand_ratio_12w", "lead_time_weeks",
         "promotion_flag"]

SHOCK = """
shock_weeks AS (SELECT DISTINCT week FROM panel ORDER BY week DESC LIMIT 6),
shocked_panel AS (
  SELECT p.sku_num, p.sku_id, p.week, p.week_idx, p.true_demand, p.stockout_flag, p.missing_flag,
         CASE WHEN p.sku_id IN (SELECT sku_id FROM meta WHERE supplier_region = 'APAC')
               AND p.week IN (SELECT week FROM shock_weeks) THEN p.demand * 2.0 ELSE p.demand END AS demand,
         CAST(p.sku_id IN (SELECT sku_id FROM meta WHERE supplier_region = 'APAC')
              AND p.week IN (SELECT week FROM shock_weeks) AS INTEGER) AS shocked,
         p.holiday_flag, p.promotion_flag
  FROM panel p)"""

CURRENT = """
s_rows AS (SELECT * FROM sfeat WHERE demand IS NOT NULL),
s_pred AS (SELECT *, coalesce(rolling_mean_4w, (SELECT median(demand) FROM s_rows)) AS p50 FROM s_rows),
cur AS (SELECT * FROM s_pred WHERE week IN (SELECT DISTINCT week FROM s_pred ORDER BY week DESC LIMIT 6))"""


def ks_sql(ref: str, cur: str, feats: list[str], cur_feats: list[str] | None = None, tag: str = "ks") -> str:
    cur_feats = cur_feats or feats
    parts = []
    for f in feats:
        parts.append(f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value, 0 AS side FROM {ref} WHERE {f} IS NOT NULL")
    for f, c in zip(feats, cur_feats):
        parts.append(f"SELECT '{f}' AS feature, CAST({c} AS DOUBLE) AS value, 1 AS side FROM {cur} WHERE {c} IS NOT NULL")
    union = "\n  UNION ALL ".join(parts)
    return f"""
{tag}_long AS ({union}),
{tag}_counts AS (SELECT feature, value, sum(1 - side) AS c_ref, sum(side) AS c_cur FROM {tag}_long GROUP BY feature, value),
{tag}_cdf AS (
  SELECT feature,
    CAST(sum(c_ref) OVER (PARTITION BY feature) AS BIGINT) AS n_ref,
    CAST(sum(c_cur) OVER (PARTITION BY feature) AS BIGINT) AS n_cur,
    sum(c_ref) OVER (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cr,
    sum(c_cur) OVER (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cc
  FROM {tag}_counts),
{tag}_stat AS (
  SELECT feature, n_ref, n_cur, max(abs(cr / n_ref - cc / n_cur)) AS ks_statistic
  FROM {tag}_cdf WHERE n_ref > 0 AND n_cur > 0 GROUP BY feature, n_ref, n_cur),
{tag}_lam AS (
  SELECT *, (sqrt(n_ref * n_cur / (n_ref + n_cur)) + 0.12 + 0.11 / sqrt(n_ref * n_cur / (n_ref + n_cur)))
            * ks_statistic AS lam FROM {tag}_stat),
{tag} AS (
  SELECT feature, n_ref, n_cur, ks_statistic,
    CAST(CASE WHEN lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, 2.0 * list_sum(list_transform(range(1, 101),
         lambda j: (CASE WHEN j % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * j * j * lam * lam))))) END AS DOUBLE) AS p_value
  FROM {tag}_lam)"""


DEMO = with_ctes(PANEL, FEATURES, SHOCK, features_sql("shocked_panel", "sfeat", "s_"), CURRENT,
                 ks_sql("features", "cur", DRIFT), ks_sql("features", "cur", ["x"], ["p50"], "pdk").replace(
                     "CAST(x AS DOUBLE) AS value, 0 AS side FROM features WHERE x IS NOT NULL",
                     "CAST(demand AS DOUBLE) AS value, 0 AS side FROM features WHERE demand IS NOT NULL"))
STATUS = f"""
dd AS (
  SELECT CAST(6 AS INTEGER) AS n_features, CAST(coalesce(sum(CAST(p_value < 0.05 AS INTEGER)), 0) AS BIGINT) AS n_drifted,
         coalesce(sum(CAST(p_value < 0.05 AS INTEGER)) / 6.0, 0.0) AS drift_fraction FROM ks),
dds AS (SELECT *, CASE WHEN drift_fraction >= 0.5 THEN 'retrain' WHEN drift_fraction >= 0.3 THEN 'warning'
                       ELSE 'ok' END AS status FROM dd),
pd AS (
  SELECT CASE WHEN k.ks_statistic IS NULL THEN 'skipped' WHEN k.p_value < 0.05 THEN 'drift' ELSE 'ok' END AS status,
         k.ks_statistic, k.p_value, k.p_value < 0.05 AS drifted
  FROM (SELECT 1 AS one) o LEFT JOIN pdk k ON true),
recent AS (SELECT * FROM cur WHERE week IN (SELECT DISTINCT week FROM cur ORDER BY week DESC LIMIT 4)),
pw AS (SELECT sum(CASE WHEN demand IS NOT NULL AND p50 IS NOT NULL THEN abs(demand - p50) END)
              / (sum(CASE WHEN demand IS NOT NULL AND p50 IS NOT NULL THEN abs(demand) END) + 1e-8) * 100 AS recent_wape,
              count(CASE WHEN demand IS NULL OR p50 IS NULL THEN 1 END) AS n_dropped_pairs FROM recent),
pf AS (SELECT CASE WHEN (recent_wape - 34.9) / (34.9 + 1e-8) > 0.15 THEN 'retrain' ELSE 'ok' END AS status,
              CAST(34.9 AS DOUBLE) AS baseline_wape, recent_wape,
              round((recent_wape - 34.9) / (34.9 + 1e-8) * 100, 2) AS degradation_pct,
              CAST(15.0 AS DOUBLE) AS threshold_pct, n_dropped_pairs FROM pw),
act AS (
  SELECT d.status AS data_status, d.drift_fraction, d.n_drifted, p.status AS prediction_status, p.ks_statistic,
         p.p_value, f.status AS performance_status, f.recent_wape, f.degradation_pct,
         CASE WHEN f.status = 'retrain' AND d.status IN ('retrain', 'warning') THEN 'immediate_retrain_and_alert'
              WHEN f.status = 'retrain' THEN 'immediate_retrain'
              WHEN d.status = 'retrain' THEN 'scheduled_retrain'
              WHEN d.status = 'warning' OR p.status = 'drift' THEN 'warning'
              ELSE 'no_action' END AS action
  FROM dds d, pd p, pf f)"""
FULL = DEMO + "," + STATUS

SQL: dict[str, str] = {}
SQL["scenario_shock"] = with_ctes(PANEL, SHOCK) + """
SELECT sku_id, week, round(demand, 6) AS demand, shocked FROM shocked_panel"""
SQL["region_semi_join"] = with_ctes(PANEL) + """
SELECT sku_id, week FROM panel WHERE sku_id IN (SELECT sku_id FROM meta WHERE supplier_region = 'APAC')"""
SQL["ks_two_sample"] = DEMO + """
SELECT feature, n_ref, n_cur, round(ks_statistic, 6) AS ks_statistic, round(p_value, 6) AS p_value,
       p_value < 0.05 AS drifted FROM ks"""
SQL["data_drift_status"] = FULL + "\nSELECT n_features, n_drifted, round(drift_fraction, 6) AS drift_fraction, status FROM dds"
SQL["prediction_drift"] = FULL + """
SELECT status, round(ks_statistic, 6) AS ks_statistic, round(p_value, 6) AS p_value, drifted FROM pd"""
SQL["performance_drift"] = FULL + """
SELECT status, baseline_wape, round(recent_wape, 6) AS recent_wape, round(degradation_pct, 6) AS degradation_pct,
       threshold_pct, n_dropped_pairs FROM pf"""
SQL["drift_action"] = FULL + "\nSELECT action FROM act"
SQL["shock_to_action"] = FULL + """
SELECT data_status, round(drift_fraction, 6) AS drift_fraction, n_drifted, prediction_status,
       round(ks_statistic, 6) AS ks_statistic, round(p_value, 6) AS p_value, performance_status,
       round(recent_wape, 6) AS recent_wape, round(degradation_pct, 6) AS degradation_pct, action FROM act"""
SQL["rolling_wape_timeline"] = DEMO + """,
wk AS (SELECT week,
              coalesce(sum(CASE WHEN demand IS NOT NULL AND p50 IS NOT NULL THEN abs(demand - p50) END), 0.0) AS e,
              coalesce(sum(CASE WHEN demand IS NOT NULL AND p50 IS NOT NULL THEN abs(demand) END), 0.0) AS a
       FROM s_pred GROUP BY week)
SELECT week, round(e / (a + 1e-8) * 100, 6) AS wape,
       round(sum(e) OVER (ORDER BY week ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)
             / (sum(a) OVER (ORDER BY week ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) + 1e-8) * 100, 6) AS rolling_wape,
       round(CAST(34.9 AS DOUBLE) * CAST(1.15 AS DOUBLE), 6) AS retrain_threshold,
       sum(e) OVER (ORDER BY week ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)
             / (sum(a) OVER (ORDER BY week ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) + 1e-8) * 100 > CAST(34.9 AS DOUBLE) * CAST(1.15 AS DOUBLE)
         AS above_threshold
FROM wk"""
SQL["chi_square_drift"] = DEMO + """,
cl AS (SELECT 'promotion_flag' AS feature, CAST(promotion_flag AS DOUBLE) AS value, 0 AS side FROM features WHERE promotion_flag IS NOT NULL
       UNION ALL SELECT 'lead_time_weeks', CAST(lead_time_weeks AS DOUBLE), 0 FROM features WHERE lead_time_weeks IS NOT NULL
       UNION ALL SELECT 'promotion_flag', CAST(promotion_flag AS DOUBLE), 1 FROM cur WHERE promotion_flag IS NOT NULL
       UNION ALL SELECT 'lead_time_weeks', CAST(lead_time_weeks AS DOUBLE), 1 FROM cur WHERE lead_time_weeks IS NOT NULL),
cc AS (SELECT feature, value, sum(1 - side) AS c_ref, sum(side) AS c_cur FROM cl GROUP BY feature, value),
cs AS (SELECT feature, sum(c_ref) AS n_ref, sum(c_cur) AS n_cur, count(*) AS n_values FROM cc GROUP BY feature),
cells AS (SELECT c.*, s.n_ref, s.n_cur, s.n_values,
                 s.n_ref * (c.c_ref + c.c_cur) / (s.n_ref + s.n_cur) AS e_ref,
                 s.n_cur * (c.c_ref + c.c_cur) / (s.n_ref + s.n_cur) AS e_cur
          FROM cc c JOIN cs s USING (feature) WHERE s.n_ref > 0 AND s.n_cur > 0)
, chi AS (
SELECT feature, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur,
       sum(pow(c_ref - e_ref, 2) / e_ref + pow(c_cur - e_cur, 2) / e_cur) AS x, max(n_values) - 1 AS dof
FROM cells GROUP BY feature, n_ref, n_cur),
pv AS (SELECT *, CASE WHEN dof < 1 OR x <= 0 THEN 1.0 ELSE greatest(0.0, 1.0 - list_sum(list_transform(
         range(0, CAST(ceil(x) AS BIGINT) + 200),
         lambda n: exp((dof / 2.0 + n) * ln(x / 2) - x / 2 - lgamma(dof / 2.0 + n + 1))))) END AS p FROM chi)
SELECT feature, n_ref, n_cur, round(x, 6) AS chi2_statistic, dof, round(CAST(p AS DOUBLE), 6) AS p_value, p < 0.05 AS drifted FROM pv"""
SQL["drift_report_flat"] = FULL + """
SELECT '20240201_000000' AS timestamp, d.status AS data_drift_status, round(d.drift_fraction, 6) AS data_drift_fraction,
       p.status AS prediction_drift_status, f.status AS performance_drift_status, round(f.recent_wape, 6) AS current_wape,
       f.baseline_wape, a.action, CAST(NULL AS VARCHAR) AS html_report_url
FROM dds d, pd p, pf f, act a"""

# ---------------------------------------------------------------- numeric and categorical columns in one report
_CATEGORICAL = ["promotion_flag", "lead_time_weeks", "category", "supplier_region"]
_CELLS = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, {side} AS side FROM {rows} WHERE {c} IS NOT NULL"
                            for c in _CATEGORICAL for side, rows in ((0, "features"), (1, "cur")))
_MIXED = DEMO + ",\ncl AS (" + _CELLS + ")," + SQL["chi_square_drift"].split("lead_time_weeks IS NOT NULL),", 1)[1].rsplit("SELECT feature, n_ref", 1)[0] + """,
mixed AS (
  SELECT feature, 'ks' AS test, n_ref, n_cur, ks_statistic AS statistic, p_value FROM ks WHERE feature NOT IN ('promotion_flag', 'lead_time_weeks')
  UNION ALL SELECT feature, 'chi_square', n_ref, n_cur, x, CAST(p AS DOUBLE) FROM pv)"""
SQL["column_drift"] = _MIXED + """
SELECT feature, test, n_ref, n_cur, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value, p_value < 0.05 AS drifted FROM mixed"""
SQL["column_drift_status"] = _MIXED + """
SELECT CAST(8 AS INTEGER) AS n_features, n_drifted, round(n_drifted / 8.0, 6) AS drift_fraction,
       CASE WHEN n_drifted / 8.0 >= 0.5 THEN 'retrain' WHEN n_drifted / 8.0 >= 0.3 THEN 'warning' ELSE 'ok' END AS status
FROM (SELECT CAST(count(*) FILTER (WHERE p_value < 0.05) AS BIGINT) AS n_drifted FROM mixed)"""
