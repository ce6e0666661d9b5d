"""Oracle SQL for splits, baselines, metrics, leaderboard and CV."""

from __future__ import annotations

from oracles.ctes import FEATURES, PANEL, with_ctes

NAIVE, AVERAGE, SEASONAL = "Naive", "MovingAverage(w=4)", "SeasonalNaive"
METRICS = ["mae", "rmse", "mape", "smape", "wape", "bias", "coverage_80pct", "interval_width"]

MODEL = """
model_rows AS (SELECT * FROM features WHERE demand IS NOT NULL),
cut AS (SELECT min(week) AS cutoff_week FROM (SELECT DISTINCT week FROM model_rows ORDER BY week DESC LIMIT 13)),
train AS (SELECT m.* FROM model_rows m, cut WHERE m.week < cut.cutoff_week),
test AS (SELECT m.* FROM model_rows m, cut WHERE m.week >= cut.cutoff_week)"""


def metric_sql(y: str = "demand", p: str = "p50", lo: str | None = None, hi: str | None = None) -> str:
    v = f"({y} IS NOT NULL AND {p} IS NOT NULL)"
    out = f"""
    avg(CASE WHEN {v} THEN abs({y} - {p}) END) AS mae,
    sqrt(avg(CASE WHEN {v} THEN ({y} - {p}) * ({y} - {p}) END)) AS rmse,
    avg(CASE WHEN {v} AND abs({y}) > 1e-8 THEN abs(({y} - {p}) / {y}) END) * 100 AS mape,
    avg(CASE WHEN {v} THEN 2.0 * abs({y} - {p}) / (abs({y}) + abs({p}) + 1e-8) END) * 100 AS smape,
    sum(CASE WHEN {v} THEN abs({y} - {p}) END) / (sum(CASE WHEN {v} THEN abs({y}) END) + 1e-8) * 100 AS wape,
    avg(CASE WHEN {v} THEN {p} - {y} END) AS bias,"""
    if lo and hi:
        out += f"""
    avg(CASE WHEN {v} THEN CAST(coalesce({y} >= {lo} AND {y} <= {hi}, false) AS DOUBLE) END) * 100 AS coverage_80pct,
    CASE WHEN count(CASE WHEN {v} AND ({hi} - {lo}) IS NULL THEN 1 END) > 0 THEN NULL
         ELSE avg(CASE WHEN {v} THEN {hi} - {lo} END) END AS interval_width"""
    else:
        out += """
    CAST(NULL AS DOUBLE) AS coverage_80pct,
    CAST(NULL AS DOUBLE) AS interval_width"""
    return out


def rm(prefix: str = "") -> str:
    return ", ".join(f"round({prefix}{m}, 6) AS {m}" for m in METRICS)


def baselines_sql(train: str, keys: str, horizon: str, tag: str) -> str:
    """CTEs ``{tag}fc`` (model, keys, week, p50) for the three baselines."""
    part = f"PARTITION BY {keys}"
    kcols = ", ".join(f"a.{k.strip()}" for k in keys.split(","))
    return f"""
{tag}anch AS (
  SELECT {keys}, max(week) AS last_week, max({horizon}) AS h,
         coalesce(arg_max(demand, week) FILTER (WHERE demand IS NOT NULL), 0.0) AS last_demand
  FROM {train} GROUP BY {keys}),
{tag}steps AS (SELECT a.*, CAST(unnest(range(1, a.h + 1)) AS INTEGER) AS step FROM {tag}anch a),
{tag}ma AS (
  SELECT {keys}, avg(coalesce(demand, 0.0)) AS p50 FROM (
    SELECT {keys}, demand FROM {train} QUALIFY row_number() OVER ({part} ORDER BY week DESC) <= 4)
  GROUP BY {keys}),
{tag}sn_t AS (
  SELECT {kcols}, CAST(a.last_week + 7 * a.step AS DATE) AS week,
         CAST(a.last_week + 7 * a.step - 364 AS DATE) AS target_week FROM {tag}steps a),
{tag}sn AS (
  SELECT {", ".join(f"t.{k.strip()}" for k in keys.split(","))}, t.week, coalesce(h.demand, 0.0) AS p50
  FROM {tag}sn_t t LEFT JOIN (SELECT {keys}, week, coalesce(demand, 0.0) AS demand FROM {train}) h
    ON {" AND ".join(f"h.{k.strip()} = t.{k.strip()}" for k in keys.split(","))}
  QUALIFY row_number() OVER (PARTITION BY {", ".join(f"t.{k.strip()}" for k in keys.split(","))}, t.week
                             ORDER BY abs(date_diff('day', h.week, t.target_week)), h.week) = 1),
{tag}fc AS (
  SELECT 'Naive' AS model, {kcols}, CAST(a.last_week + 7 * a.step AS DATE) AS week, a.last_demand AS p50
  FROM {tag}steps a
  UNION ALL
  SELECT 'MovingAverage(w=4)' AS model, {kcols}, CAST(a.last_week + 7 * a.step AS DATE) AS week, m.p50
  FROM {tag}steps a JOIN {tag}ma m ON {" AND ".join(f"m.{k.strip()} = a.{k.strip()}" for k in keys.split(","))}
  UNION ALL
  SELECT 'SeasonalNaive' AS model, {keys}, week, p50 FROM {tag}sn)"""


BASE = with_ctes(PANEL, FEATURES, MODEL)
FC = with_ctes(PANEL, FEATURES, MODEL, baselines_sql("train", "sku_id", "13", ""))
ONE_STEP = """
oi AS (
  SELECT 'RollingInterval(4w, one-step)' AS model, sku_id, week, demand, category,
         greatest(rolling_mean_4w - 1.28 * coalesce(rolling_std_4w, rolling_mean_4w * 0.12), 0.0) AS p10,
         rolling_mean_4w AS p50,
         rolling_mean_4w + 1.28 * coalesce(rolling_std_4w, rolling_mean_4w * 0.12) AS p90
  FROM test)"""
SCORED = """
scored AS (SELECT f.model, t.sku_id, t.week, t.demand, t.category, f.p50
           FROM test t JOIN fc f ON f.sku_id = t.sku_id AND f.week = t.week),
scored_left AS (SELECT m.model, t.sku_id, t.week, t.demand, t.category, f.p50
                FROM test t CROSS JOIN (SELECT DISTINCT model FROM fc) m
                LEFT JOIN fc f ON f.model = m.model AND f.sku_id = t.sku_id AND f.week = t.week)"""
FCS = with_ctes(PANEL, FEATURES, MODEL, baselines_sql("train", "sku_id", "13", ""), SCORED)

CV = """
wpos AS (SELECT week, CAST(row_number() OVER (ORDER BY week) - 1 AS INTEGER) AS week_pos
         FROM (SELECT DISTINCT week FROM model_rows)),
fstats AS (SELECT count(*) AS n_weeks FROM wpos),
folds0 AS (SELECT CAST(f.range AS INTEGER) AS fold, s.n_weeks, CAST(s.n_weeks // 6 AS INTEGER) AS size
           FROM fstats s CROSS JOIN range(1, 6) f),
folds AS (SELECT fold, n_weeks, size, n_weeks - 5 * size + (fold - 1) * size AS val_start,
                 n_weeks - 5 * size + (fold - 1) * size + size AS val_end FROM folds0),
fr AS (SELECT m.*, p.week_pos, f.fold, f.size,
              CASE WHEN p.week_pos < f.val_start THEN 'train' ELSE 'val' END AS role
       FROM model_rows m JOIN wpos p ON p.week = m.week JOIN folds f ON p.week_pos < f.val_end),
cv_train AS (SELECT * FROM fr WHERE role = 'train'),
cv_val AS (SELECT * FROM fr WHERE role = 'val')"""
CVFC = with_ctes(PANEL, FEATURES, MODEL, CV, baselines_sql("cv_train", "fold, sku_id", "size", "cv_"))
CV_FOLD_METRICS = f"""
cv_fold AS (
  SELECT f.model, v.fold, {metric_sql()}
  FROM cv_val v JOIN cv_fc f ON f.fold = v.fold AND f.sku_id = v.sku_id AND f.week = v.week
  GROUP BY f.model, v.fold)"""

SQL: dict[str, str] = {}
SQL["drop_null_target"] = BASE + "\nSELECT sku_id, week, round(demand, 6) AS demand FROM model_rows"
SQL["sku_filter"] = BASE + """
SELECT sku_id, week, round(demand, 6) AS demand, round(demand_adjusted, 6) AS demand_adjusted
FROM features WHERE sku_id = 'PART-10050'"""
SQL["latest_weeks"] = BASE + "\nSELECT DISTINCT week FROM model_rows ORDER BY week DESC LIMIT 13"
SQL["in_week_set"] = BASE + """
SELECT sku_id, week, round(demand, 6) AS demand FROM model_rows
WHERE week IN (SELECT DISTINCT week FROM model_rows ORDER BY week DESC LIMIT 13)"""
SQL["promo_weeks"] = BASE + "\nSELECT DISTINCT week FROM features WHERE promotion_flag = 1"
SQL["holdout_split"] = BASE + """
SELECT sku_id, week, 'train' AS split FROM train UNION ALL SELECT sku_id, week, 'test' AS split FROM test"""
SQL["validation_split"] = BASE + """,
vcut AS (SELECT min(week) AS c FROM (SELECT DISTINCT week FROM train ORDER BY week DESC LIMIT 13))
SELECT sku_id, week, CASE WHEN week < (SELECT c FROM vcut) THEN 'fit' ELSE 'val' END AS split FROM train"""
SQL["walk_forward_folds"] = with_ctes(PANEL, FEATURES, MODEL, CV) + """
SELECT f.fold, f.n_weeks, f.size, f.val_start, f.val_end, f.val_start AS n_train_weeks,
       a.week AS train_end_week, b.week AS val_start_week, c.week AS val_end_week
FROM folds f
LEFT JOIN wpos a ON a.week_pos = f.val_start - 1
LEFT JOIN wpos b ON b.week_pos = f.val_start
LEFT JOIN wpos c ON c.week_pos = f.val_end - 1"""
SQL["last_value_per_sku"] = with_ctes(PANEL) + """
SELECT sku_id, round(coalesce(arg_max(demand, week) FILTER (WHERE demand IS NOT NULL), 0.0), 6) AS last_demand
FROM panel GROUP BY sku_id"""
SQL["last_n_rows"] = BASE + """
SELECT sku_id, week, round(demand, 6) AS demand FROM train
QUALIFY row_number() OVER (PARTITION BY sku_id ORDER BY week DESC) <= 4"""
SQL["horizon_weeks"] = BASE + """
SELECT a.sku_id, CAST(s.range AS INTEGER) AS step, CAST(a.last_week + 7 * CAST(s.range AS INTEGER) AS DATE) AS week
FROM (SELECT sku_id, max(week) AS last_week FROM model_rows GROUP BY sku_id) a CROSS JOIN range(1, 5) s"""
SQL["naive_forecast"] = FC + "\nSELECT sku_id, week, round(p50, 6) AS p50 FROM fc WHERE model = 'Naive'"
SQL["moving_average_forecast"] = FC + "\nSELECT sku_id, week, round(p50, 6) AS p50 FROM fc WHERE model = 'MovingAverage(w=4)'"
SQL["seasonal_naive_forecast"] = FC + "\nSELECT sku_id, week, round(p50, 6) AS p50 FROM fc WHERE model = 'SeasonalNaive'"
SQL["seasonal_asof_join"] = BASE + """
SELECT t.sku_id, t.week, t.target_week, h.week AS matched_week, round(h.demand, 6) AS matched_value
FROM (SELECT sku_id, week, CAST(week - 364 AS DATE) AS target_week FROM panel) t
LEFT JOIN (SELECT sku_id, week, demand FROM model_rows) h ON h.sku_id = t.sku_id
QUALIFY row_number() OVER (PARTITION BY t.sku_id, t.week
                           ORDER BY abs(date_diff('day', h.week, t.target_week)), h.week) = 1"""
SQL["rolling_interval_forecast"] = BASE + """,
tail AS (SELECT sku_id, week, demand, rolling_mean_4w, rolling_std_4w FROM features
         QUALIFY row_number() OVER (PARTITION BY sku_id ORDER BY week DESC) <= 8),
iv AS (SELECT sku_id,
              coalesce(rolling_mean_4w, median(demand) OVER (PARTITION BY sku_id)) AS p50,
              coalesce(rolling_std_4w, coalesce(rolling_mean_4w, median(demand) OVER (PARTITION BY sku_id)) * 0.12) AS sd,
              CAST(max(week) OVER (PARTITION BY sku_id)
                   + 7 * CAST(row_number() OVER (PARTITION BY sku_id ORDER BY week) AS INTEGER) AS DATE) AS week
       FROM tail)
SELECT sku_id, week, round(greatest(p50 - 1.28 * sd, 0.0), 6) AS p10, round(p50, 6) AS p50,
       round(p50 + 1.28 * sd, 6) AS p90 FROM iv"""
SQL["union_frames"] = FC + "\nSELECT model, sku_id, week, round(p50, 6) AS p50 FROM fc"
SQL["eval_inner_join"] = FCS + """
SELECT model, sku_id, week, round(demand, 6) AS demand, category, round(p50, 6) AS p50 FROM scored"""
SQL["eval_left_join"] = FCS + """
SELECT model, sku_id, week, round(demand, 6) AS demand, category, round(p50, 6) AS p50 FROM scored_left"""
SQL["drop_invalid_pairs"] = FCS + """
SELECT model, sku_id, week, round(demand, 6) AS demand, round(p50, 6) AS p50 FROM scored_left
WHERE demand IS NOT NULL AND p50 IS NOT NULL"""
SQL["metrics_overall"] = FCS + f"""
SELECT model, {rm()} FROM (SELECT model, {metric_sql()} FROM scored GROUP BY model)"""
SQL["interval_metrics"] = with_ctes(PANEL, FEATURES, MODEL, ONE_STEP) + f"""
SELECT model, {rm()} FROM (SELECT model, {metric_sql(lo='p10', hi='p90')} FROM oi GROUP BY model)"""
SQL["metrics_by_segment"] = FCS + f"""
SELECT model, category, {rm()} FROM (
  SELECT model, category, {metric_sql()} FROM scored WHERE category IS NOT NULL GROUP BY model, category)"""
SQL["segment_metrics_long"] = FCS + f""",
seg AS (SELECT model, category, {metric_sql()} FROM scored WHERE category IS NOT NULL GROUP BY model, category)
SELECT model, category || '_' || metric AS name, round(value, 6) AS value
FROM (UNPIVOT seg ON {", ".join(METRICS)} INTO NAME metric VALUE value)
WHERE value IS NOT NULL"""
SQL["leaderboard_sorted"] = with_ctes(PANEL, FEATURES, MODEL, baselines_sql("train", "sku_id", "13", ""),
                                      SCORED, ONE_STEP) + f""",
lb AS (SELECT model, {metric_sql()} FROM scored GROUP BY model
       UNION ALL SELECT model, {metric_sql(lo='p10', hi='p90')} FROM oi GROUP BY model)
SELECT CAST(row_number() OVER (ORDER BY wape ASC NULLS LAST, model) AS INTEGER) AS rank, model, {rm()},
       '< 1' AS inference_ms FROM lb"""
SQL["evaluate_model"] = FCS + f"""
SELECT 'MovingAverage(w=4)' AS model, {rm()}, '< 1' AS inference_ms FROM (
  SELECT {metric_sql()} FROM scored WHERE model = 'MovingAverage(w=4)')"""
SQL["walk_forward_cv"] = CVFC + "," + CV_FOLD_METRICS + f"""
SELECT model, fold, {rm()} FROM cv_fold"""
SQL["cv_summary"] = CVFC + "," + CV_FOLD_METRICS + f"""
SELECT model, {", ".join(f"round(avg({m}), 6) AS {m}_mean, round(stddev_pop({m}), 6) AS {m}_std" for m in METRICS)},
       count(*) AS n_folds
FROM cv_fold GROUP BY model"""

LB_SQL = with_ctes(PANEL, FEATURES, MODEL, baselines_sql("train", "sku_id", "13", ""), SCORED, ONE_STEP) + f""",
lb AS (SELECT model, {metric_sql()} FROM scored GROUP BY model
       UNION ALL SELECT model, {metric_sql(lo='p10', hi='p90')} FROM oi GROUP BY model),
board AS (SELECT CAST(row_number() OVER (ORDER BY wape ASC NULLS LAST, model) AS INTEGER) AS rank, model,
                 round(wape, 6) AS wape, round(rmse, 6) AS rmse, round(bias, 6) AS bias,
                 round(coverage_80pct, 6) AS coverage_80pct, '< 1' AS inference_ms FROM lb)"""

SQL["baseline_modes"] = with_ctes(PANEL, FEATURES, MODEL, baselines_sql("train", "sku_id", "13", ""), SCORED) + f""",
prior AS (
  SELECT sku_id, week, demand,
         coalesce(lag(demand) OVER (PARTITION BY sku_id ORDER BY week), 0.0) AS naive,
         coalesce(avg(demand) OVER (PARTITION BY sku_id ORDER BY week ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), 0.0) AS average
  FROM model_rows),
near AS (
  SELECT t.sku_id, t.week, h.week AS matched_week, h.demand AS matched
  FROM test t JOIN model_rows h ON h.sku_id = t.sku_id
  QUALIFY row_number() OVER (PARTITION BY t.sku_id, t.week
                             ORDER BY abs(date_diff('day', h.week, CAST(t.week - 364 AS DATE))), h.week) = 1),
one AS (
  SELECT t.sku_id, t.week, t.demand, p.naive, p.average,
         CASE WHEN n.matched_week < t.week THEN n.matched ELSE 0.0 END AS seasonal
  FROM test t JOIN prior p USING (sku_id, week) LEFT JOIN near n USING (sku_id, week)),
modes AS (
  SELECT 'multi_step' AS mode, model, {metric_sql()} FROM scored GROUP BY model
  UNION ALL SELECT 'one_step', '{NAIVE}', {metric_sql(p="naive")} FROM one
  UNION ALL SELECT 'one_step', '{AVERAGE}', {metric_sql(p="average")} FROM one
  UNION ALL SELECT 'one_step', '{SEASONAL}', {metric_sql(p="seasonal")} FROM one)
SELECT mode, model, {rm()} FROM modes"""
