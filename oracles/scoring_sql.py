"""Oracle SQL for request validation and batch scoring."""

from __future__ import annotations

from oracles.ctes import FEATURES, PANEL, with_ctes
from oracles.report_sql import FEATURES_34

DOUBLES = {"lag_1", "lag_2", "lag_4", "lag_8", "lag_12", "lag_26", "lag_52", "rolling_mean_4w", "rolling_mean_12w",
           "rolling_std_4w", "rolling_std_12w", "rolling_min_4w", "rolling_max_4w", "demand_change_1w",
           "demand_change_4w", "log_unit_cost", "zero_demand_ratio_12w"}

REQ = """
req AS (
  SELECT p_partkey AS request_id, p_partkey // 400 AS batch_id,
         ' PART-' || CAST(p_partkey + 10000 AS VARCHAR) || ' ' AS sku_id,
         CAST(1 + p_partkey % 60 AS INTEGER) AS horizon_weeks, p_partkey % 5 <> 0 AS include_intervals
  FROM part),
chk AS (
  SELECT request_id, batch_id, sku AS sku_id, h AS horizon_weeks, coalesce(include_intervals, true) AS include_intervals,
         count(*) OVER (PARTITION BY batch_id) > 500 AS large_batch,
         CASE WHEN sku IS NULL OR sku = '' THEN 'blank_sku_id'
              WHEN NOT (h BETWEEN 1 AND 52) THEN 'horizon_out_of_range' END AS reason
  FROM (SELECT *, regexp_replace(sku_id, '^\\s+|\\s+$', '', 'g') AS sku,
               CAST(coalesce(horizon_weeks, 4) AS INTEGER) AS h FROM req)),
chk2 AS (SELECT *, reason IS NULL AS valid FROM chk),
latest AS (SELECT * FROM features QUALIFY row_number() OVER (PARTITION BY sku_id ORDER BY week DESC) = 1),
known AS (SELECT * FROM chk2 WHERE valid AND sku_id IN (SELECT sku_id FROM latest)),
frame AS (
  SELECT k.request_id, k.sku_id, k.horizon_weeks, k.include_intervals, l.category, s.step,
         CAST(l.week + 7 * s.step AS DATE) AS week, l.demand_adjusted AS lag_1_new, l.*
  FROM known k JOIN latest l ON l.sku_id = k.sku_id
  CROSS JOIN LATERAL (SELECT CAST(unnest(range(1, k.horizon_weeks + 1)) AS INTEGER) AS step) s),
sframe AS (
  SELECT request_id, sku_id, horizon_weeks, include_intervals, category, step, week, """ + ", ".join(
    (f"coalesce(lag_1_new, 0.0) AS lag_1" if c == "lag_1" else
     f"coalesce({c}, {'0.0' if c in DOUBLES else '0'}) AS {c}") for c in FEATURES_34) + """
  FROM frame)"""

SC = with_ctes(PANEL, FEATURES, REQ)


def serve(p50raw: str, p10: str | None, p90: str | None) -> str:
    p50 = f"greatest(0.0, coalesce({p50raw}, 0.0))"
    lo = f"coalesce({p10}, {p50} * 0.7)" if p10 else f"{p50} * 0.7"
    hi = f"coalesce({p90}, {p50} * 1.3)" if p90 else f"{p50} * 1.3"
    return f"""
SELECT request_id, sku_id, category, horizon_weeks, step, week,
       round(CASE WHEN include_intervals THEN greatest(0.0, {lo}) END, 6) AS p10,
       round({p50}, 6) AS p50,
       round(CASE WHEN include_intervals THEN greatest({p50}, {hi}) END, 6) AS p90
FROM sframe"""


SQL: dict[str, str] = {}
SQL["request_clean"] = SC + """
SELECT request_id, batch_id, sku_id, horizon_weeks, include_intervals, large_batch, reason, valid FROM chk2"""
AWKWARD = """
  SELECT request_id, CAST(1 AS BIGINT) AS batch_id,
         CASE WHEN request_id % 29 = 0 THEN chr(9) WHEN request_id % 31 = 0 THEN NULL
              WHEN request_id % 7 = 0 THEN chr(10) || sku_id ELSE sku_id END AS sku_id,
         CAST(CASE WHEN request_id % 5 = 0 THEN NULL WHEN request_id % 41 = 0 THEN 0 WHEN request_id % 43 = 0 THEN 53
                   ELSE horizon_weeks END AS INTEGER) AS horizon_weeks,
         CASE WHEN request_id % 3 = 0 THEN NULL ELSE include_intervals END AS include_intervals
  FROM plain),
chk AS ("""
SQL["request_outcomes"] = SC.replace("\nreq AS (", "\nplain AS (").replace("req AS (\n  SELECT p_partkey", "plain AS (\n  SELECT p_partkey").replace(
    "\nchk AS (", "\nreq AS (" + AWKWARD, 1) + """
SELECT c.request_id, CASE WHEN NOT c.valid THEN 'rejected' WHEN l.sku_id IS NULL THEN 'unknown' ELSE 'forecast' END AS outcome,
       CAST(CASE WHEN c.valid AND l.sku_id IS NOT NULL THEN c.horizon_weeks ELSE 0 END AS BIGINT) AS n_rows,
       CASE WHEN NOT c.valid THEN c.reason WHEN l.sku_id IS NULL THEN 'SKU not found in feature store' END AS reason
FROM chk2 c LEFT JOIN latest l ON l.sku_id = c.sku_id"""
SQL["request_join"] = SC + "\nSELECT request_id, sku_id, horizon_weeks FROM known"
SQL["unknown_sku_anti_join"] = SC + """
SELECT request_id, sku_id, 'SKU not found in feature store' AS error FROM chk2
WHERE valid AND sku_id NOT IN (SELECT sku_id FROM latest)"""
SQL["fill_features_zero"] = SC + "\nSELECT request_id, step, week, " + ", ".join(
    f"round({c}, 6) AS {c}" if c in DOUBLES else c for c in FEATURES_34) + " FROM sframe"
SQL["batch_score"] = SC + serve("rolling_mean_4w", "rolling_mean_4w - 1.28 * rolling_std_4w",
                                "rolling_mean_4w + 1.28 * rolling_std_4w")
SQL["response_nested"] = f"""
WITH f AS ({SQL["batch_score"]})
SELECT request_id, sku_id, horizon_weeks, category AS sku_segment,
       CAST(row_number() OVER (PARTITION BY request_id ORDER BY step) - 1 AS INTEGER) AS place,
       strftime(week, '%Y-%m-%d') AS week, p10, p50, p90
FROM f"""
SQL["interval_fallback"] = SC + serve("rolling_mean_4w", None, None)

# ---------------------------------------------------------------- sources / sinks
from oracles.eval_sql import LB_SQL  # noqa: E402

SQL["scan_demand"] = with_ctes(PANEL) + """
SELECT sku_id, week, round(demand, 6) AS demand, stockout_flag, holiday_flag, promotion_flag FROM panel"""
SQL["drop_hidden_truth"] = with_ctes(PANEL) + """
SELECT sku_id, week, round(demand, 6) AS demand, stockout_flag, holiday_flag, promotion_flag,
       round(true_demand, 6) AS true_demand FROM panel"""
SQL["scan_sku_metadata"] = with_ctes(PANEL) + """
SELECT sku_id, category, supplier_region, round(unit_cost, 6) AS unit_cost, lead_time_weeks FROM meta"""
SQL["read_leaderboard"] = LB_SQL + """
SELECT rank, model, round(wape, 1) AS wape, round(rmse, 1) AS rmse, round(bias, 2) AS bias,
       round(coverage_80pct, 1) AS coverage_80pct, inference_ms FROM board"""

# ---------------------------------------------------------------- sequences
from oracles.ctes import W  # noqa: E402

SEQ = ["lag_1", "rolling_mean_4w", "zero_demand_ratio_12w", "promotion_flag"]
FRAME = f"({W} ROWS BETWEEN 26 PRECEDING AND 1 PRECEDING)"
SQL["lookback_sequences"] = with_ctes(PANEL, FEATURES) + f""",
n AS (SELECT *, row_number() OVER ({W}) AS rn FROM features)
SELECT * FROM (
  SELECT sku_id, week, CAST(count(*) OVER {FRAME} AS INTEGER) AS seq_len,
         first_value(week) OVER {FRAME} AS first_week, last_value(week) OVER {FRAME} AS last_week,
         """ + ",\n         ".join(
    f"round(sum(rn * coalesce(CAST({c} AS DOUBLE), 0.0)) OVER {FRAME}"
    f" - (rn - 27) * sum(coalesce(CAST({c} AS DOUBLE), 0.0)) OVER {FRAME}, 6) AS sum_{c}" for c in SEQ) + """,
         round(coalesce(demand, 0.0), 6) AS target
  FROM n) WHERE seq_len = 26"""
SQL["zero_pad_sequence"] = with_ctes(PANEL, FEATURES) + """,
last AS (SELECT *, row_number() OVER (PARTITION BY sku_id ORDER BY week DESC) AS back FROM features),
grid AS (SELECT s.sku_id, CAST(p.place AS INTEGER) AS place
         FROM (SELECT DISTINCT sku_id FROM features) s CROSS JOIN (SELECT unnest(range(0, 26)) AS place) p)
SELECT g.sku_id, g.place, """ + ", ".join(f"round(coalesce(CAST(l.{c} AS DOUBLE), 0.0), 6) AS {c}" for c in SEQ) + """
FROM grid g LEFT JOIN last l ON l.sku_id = g.sku_id AND l.back = 26 - g.place"""
SQL["feature_store_versions"] = with_ctes(PANEL, FEATURES) + """
SELECT 'v10' AS feature_version, count(*) AS n_rows, 'v10' AS latest_version FROM features"""
SQL["feature_scaling"] = with_ctes(PANEL, FEATURES) + """,
wt AS (SELECT *, greatest(0, least(count(*) OVER (PARTITION BY sku_id) - 1,
                                   row_number() OVER (PARTITION BY sku_id ORDER BY week) - 1 + 26)
                           - greatest(26, row_number() OVER (PARTITION BY sku_id ORDER BY week)) + 1) AS w
       FROM features),
lg AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, coalesce(CAST({c} AS DOUBLE), 0.0) AS x, w FROM wt WHERE w > 0" for c in SEQ) + """),
ag AS (SELECT feature, sum(w) AS sw, sum(x * w) AS sx FROM lg GROUP BY feature)
SELECT a.feature, round(a.sx / a.sw, 6) AS mean,
       round(sqrt(sum(l.w * pow(l.x - a.sx / a.sw, 2)) / a.sw) + 1e-8, 6) AS std
FROM lg l JOIN ag a USING (feature) GROUP BY a.feature, a.sx, a.sw"""

SQL["replace_inf"] = with_ctes(PANEL, FEATURES) + f""",
l5 AS (SELECT *, lag(demand_adjusted, 5) OVER ({W}) AS lag_5 FROM features)
SELECT sku_id, week, round(demand_change_1w, 6) AS demand_change_1w, round(demand_change_4w, 6) AS demand_change_4w
FROM l5 WHERE lag_2 = 0 OR lag_5 = 0"""
SQL["clamp_nonneg"] = with_ctes(PANEL, FEATURES) + """
SELECT sku_id, week, round(CASE WHEN demand_change_1w IS NULL THEN NULL ELSE greatest(0.0, demand_change_1w) END, 6)
       AS clamped FROM features"""

# ---------------------------------------------------------------- recursive steps, cold start, weekly store
SQL["batch_score_recursive"] = SC.replace("WITH ", "WITH RECURSIVE ", 1) + """,
past AS (SELECT sku_id, list(demand_adjusted ORDER BY week) AS s FROM (
           SELECT * FROM features QUALIFY row_number() OVER (PARTITION BY sku_id ORDER BY week DESC) <= 4) GROUP BY sku_id),
steps AS (
  SELECT sku_id, 0 AS step, s, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std FROM past
  UNION ALL
  SELECT sku_id, step + 1, list_append(s[greatest(len(s) - 2, 1):], greatest(0.0, coalesce(list_avg(s), 0.0))), list_avg(s), coalesce(list_stddev_samp(s), 0.0)
  FROM steps WHERE step < 52),
rframe AS (SELECT f.* EXCLUDE (rolling_mean_4w, rolling_std_4w), p.mean AS rolling_mean_4w, p.std AS rolling_std_4w
           FROM sframe f JOIN steps p ON p.sku_id = f.sku_id AND p.step = f.step)""" + serve(
    "rolling_mean_4w", "rolling_mean_4w - 1.28 * rolling_std_4w", "rolling_mean_4w + 1.28 * rolling_std_4w").replace("FROM sframe", "FROM rframe")
COLD = """,
cold AS (SELECT * FROM meta WHERE CAST(regexp_extract(sku_id, '([0-9]+)$', 1) AS BIGINT) % 10 = 3),
hist AS (SELECT * FROM features WHERE demand IS NOT NULL AND sku_id NOT IN (SELECT sku_id FROM cold)),
means AS (SELECT category, avg(demand) AS mean FROM hist GROUP BY category)"""
SQL["cold_start_forecast"] = with_ctes(PANEL, FEATURES) + COLD + """,
base AS (SELECT sku_id, max_by(demand, week) AS p50, max(week) AS last_week, 'sku' AS level FROM hist GROUP BY sku_id
         UNION ALL
         SELECT c.sku_id, coalesce(m.mean, (SELECT avg(demand) FROM hist)), (SELECT max(week) FROM hist),
                CASE WHEN m.mean IS NULL THEN 'global' ELSE 'category' END
         FROM meta c LEFT JOIN means m ON m.category = c.category WHERE c.sku_id NOT IN (SELECT sku_id FROM hist))
SELECT sku_id, CAST(last_week + 7 * step AS DATE) AS week, round(p50, 6) AS p50, level
FROM (SELECT *, unnest([1, 2, 3, 4]) AS step FROM base)"""
SQL["batch_score_cold_start"] = SC + COLD + """,
warm AS (SELECT * FROM sframe WHERE sku_id NOT IN (SELECT sku_id FROM cold)),
new AS (SELECT k.*, c.category FROM chk2 k LEFT JOIN meta c ON c.sku_id = k.sku_id
        WHERE k.valid AND (k.sku_id IN (SELECT sku_id FROM cold) OR k.sku_id NOT IN (SELECT sku_id FROM latest))),
cframe AS (
  SELECT n.request_id, n.sku_id, n.horizon_weeks, n.include_intervals, n.category, s.step,
         CAST((SELECT max(week) FROM features WHERE sku_id NOT IN (SELECT sku_id FROM cold)) + 7 * s.step AS DATE) AS week,
         coalesce(m.mean, (SELECT avg(demand) FROM hist)) AS prior
  FROM new n LEFT JOIN means m ON m.category = n.category
  CROSS JOIN LATERAL (SELECT CAST(unnest(range(1, n.horizon_weeks + 1)) AS INTEGER) AS step) s)""" + serve(
    "rolling_mean_4w", "rolling_mean_4w - 1.28 * rolling_std_4w", "rolling_mean_4w + 1.28 * rolling_std_4w").replace("FROM sframe", "FROM warm") + """
UNION ALL""" + serve("prior", None, None).replace("FROM sframe", "FROM cframe")
SQL["feature_store_weeks"] = with_ctes(PANEL, FEATURES) + """
SELECT CAST(year(week) AS INTEGER) AS year, count(*) AS n_rows, max(week) AS last_week,
       round(sum(demand + CASE WHEN year(week) = 1996 THEN 1 ELSE 0 END), 6) AS demand
FROM features WHERE week >= DATE '1996-06-03' GROUP BY 1"""
