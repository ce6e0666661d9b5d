"""Oracle SQL for the promotion gate and stage replay."""

from __future__ import annotations

from oracles.ctes import FEATURES, PANEL, with_ctes
from oracles.eval_sql import CV, CV_FOLD_METRICS, METRICS, MODEL, ONE_STEP, SCORED, baselines_sql, metric_sql

MT = with_ctes(PANEL, FEATURES, MODEL, baselines_sql("train", "sku_id", "13", ""), SCORED, ONE_STEP) + f""",
wide AS (
  SELECT model, 'all' AS segment, {metric_sql()} FROM scored GROUP BY model
  UNION ALL SELECT model, 'all' AS segment, {metric_sql(lo='p10', hi='p90')} FROM oi GROUP BY model
  UNION ALL SELECT model, category AS segment, {metric_sql()} FROM scored WHERE category IS NOT NULL GROUP BY model, category
  UNION ALL SELECT model, category AS segment, {metric_sql(lo='p10', hi='p90')} FROM oi
            WHERE category IS NOT NULL GROUP BY model, category),
mt AS (SELECT * FROM wide UNPIVOT INCLUDE NULLS (value FOR metric IN ({", ".join(METRICS)})))"""

SQL: dict[str, str] = {}
SQL["promotion_gate"] = MT + """,
pairs AS (
  SELECT c.model AS candidate, c.segment, c.metric, c.value AS candidate_value, p.value AS production_value
  FROM (SELECT * FROM mt WHERE model <> 'SeasonalNaive') c
  LEFT JOIN (SELECT * FROM mt WHERE model = 'SeasonalNaive') p ON p.segment = c.segment AND p.metric = c.metric),
g AS (
  SELECT *, CASE WHEN metric IN ('wape', 'mae', 'rmse', 'mape', 'smape')
                 THEN (production_value - candidate_value) / (production_value + 1e-8)
                 WHEN metric IN ('coverage_80pct') THEN (candidate_value - production_value) / (production_value + 1e-8)
            END AS gain,
            metric IN ('wape', 'mae', 'rmse', 'mape', 'smape', 'coverage_80pct') AS known
  FROM pairs)
SELECT candidate, segment, metric, round(candidate_value, 6) AS candidate_value,
       round(production_value, 6) AS production_value, round(round(gain * 100, 4), 6) AS improvement_pct,
       CAST(2.0 AS DOUBLE) AS threshold_pct,
       CASE WHEN NOT known THEN 'rejected' WHEN candidate_value IS NULL THEN 'rejected'
            WHEN production_value IS NULL THEN 'promoted' WHEN gain > 0.02 THEN 'promoted'
            ELSE 'rejected' END AS promotion_status,
       CASE WHEN NOT known THEN 'unknown_metric' WHEN candidate_value IS NULL THEN 'missing_candidate_metric'
            WHEN production_value IS NULL THEN 'missing_production_metric' WHEN gain > 0.02 THEN 'improved'
            ELSE 'below_threshold' END AS reason
FROM g"""
SQL["current_stage"] = with_ctes(PANEL, FEATURES, MODEL, CV,
                                 baselines_sql("cv_train", "fold, sku_id", "size", "cv_")) + "," + CV_FOLD_METRICS + """,
best AS (SELECT fold, model AS best_model, wape AS best_wape FROM cv_fold
         QUALIFY row_number() OVER (PARTITION BY fold ORDER BY wape ASC NULLS LAST, model) = 1),
chain AS (SELECT *, lag(best_model) OVER (ORDER BY fold) AS prev_model FROM best),
ev AS (
  SELECT 'demand-forecaster' AS model_name, 'v' || CAST(c.fold AS VARCHAR) AS version, c.best_model AS model,
         'promote' AS event_type, CAST(c.fold AS BIGINT) AS event_time
  FROM chain c LEFT JOIN cv_fold p ON p.fold = c.fold AND p.model = c.prev_model
  WHERE c.prev_model IS NULL OR p.wape IS NULL OR (p.wape - c.best_wape) / (p.wape + 1e-8) > 0.02),
latest AS (SELECT model_name, arg_max(version, event_time) AS production_version FROM ev GROUP BY model_name),
seen AS (SELECT model_name, version, max(event_time) AS last_event_time FROM ev GROUP BY model_name, version)
SELECT s.model_name, s.version, s.last_event_time,
       CASE WHEN s.version = l.production_version THEN 'Production' ELSE 'Archived' END AS stage
FROM seen s JOIN latest l ON l.model_name = s.model_name"""

SQL["version_run_join"] = SQL["current_stage"].rsplit("SELECT s.model_name", 1)[0] + """,
st AS (SELECT s.model_name, s.version,
              CASE WHEN s.version = l.production_version THEN 'Production' ELSE 'Archived' END AS stage
       FROM seen s JOIN latest l ON l.model_name = s.model_name)
SELECT st.model_name, st.version, st.stage, e.model, round(f.wape, 6) AS wape
FROM st JOIN ev e ON e.version = st.version
LEFT JOIN cv_fold f ON 'v' || CAST(f.fold AS VARCHAR) = st.version AND f.model = e.model"""
