"""Fixed values.

These must equal the analysed application's values for identical results;
they are stated here plainly and in one place.
"""

# --- fixed values: ordinal encodings (unknown or missing -> -1) -------------
REGION_CODES = {"APAC": 0, "EMEA": 1, "NA": 2}
CATEGORY_CODES = {"fast_moving": 0, "intermittent": 1, "seasonal": 2, "slow_moving": 3}

# --- fixed values: feature windows -----------------------------------------
LAGS = (1, 2, 4, 8, 12, 26, 52)
ROLLING_WINDOWS = (4, 12)
MIN_MAX_WINDOW = 4
ZERO_RATIO_WINDOW = 12
STOCKOUT_LOOKBACK = 12

# --- fixed values: the 34 model inputs, in order ----------------------------
FEATURE_COLUMNS = [
    "lag_1", "lag_2", "lag_4", "lag_8", "lag_12", "lag_26", "lag_52",
    "rolling_mean_4w", "rolling_mean_12w",
    "rolling_std_4w", "rolling_std_12w",
    "rolling_min_4w", "rolling_max_4w",
    "demand_change_1w", "demand_change_4w",
    "week_of_year", "month", "quarter", "is_q1", "is_q4",
    "holiday_flag", "promotion_flag",
    "lead_time_weeks", "log_unit_cost",
    "zero_demand_ratio_12w",
    "supplier_region_enc", "category_enc",
    "cat_fast_moving", "cat_slow_moving", "cat_intermittent", "cat_seasonal",
    "region_APAC", "region_EMEA", "region_NA",
]

# --- fixed values: evaluation ----------------------------------------------
EPSILON = 1e-8
TEST_WEEKS = 13
CV_FOLDS = 5
QUANTILES = {"p10": 0.10, "p50": 0.50, "p90": 0.90}
LOOKBACK = 26
SEASON_WEEKS = 52
MOVING_AVERAGE_WINDOW = 4
INTERVAL_Z = 1.28              # p50 -/+ 1.28 sigma in the rolling interval view
INTERVAL_STD_FALLBACK = 0.12   # sigma = 0.12 * p50 when the rolling std is missing
SERVE_P10_FACTOR = 0.7         # served p10 when the model gives none
SERVE_P90_FACTOR = 1.3         # served p90 when the model gives none
MAX_HORIZON = 52
MAX_BATCH_SKUS = 500
DEFAULT_HORIZON = 4

# --- fixed values: drift ----------------------------------------------------
DRIFT_FEATURES = [
    "lag_1",
    "rolling_mean_4w",
    "rolling_mean_12w",
    "zero_demand_ratio_12w",
    "lead_time_weeks",
    "promotion_flag",
]
DATA_DRIFT_WARNING = 0.30
DATA_DRIFT_RETRAIN = 0.50
PVALUE_THRESHOLD = 0.05
PERF_DEGRADATION_THRESHOLD = 0.15
PERF_RECENT_WEEKS = 4

# --- fixed values: promotion gate -------------------------------------------
LOWER_IS_BETTER = ("wape", "mae", "rmse", "mape", "smape")
HIGHER_IS_BETTER = ("coverage_80pct",)
GATE_THRESHOLD = 0.02

# --- fixed values: metric names and model labels ----------------------------
METRIC_NAMES = ["mae", "rmse", "mape", "smape", "wape", "bias", "coverage_80pct", "interval_width"]
NAIVE_NAME = "Naive"
MOVING_AVERAGE_NAME = "MovingAverage(w=4)"
SEASONAL_NAIVE_NAME = "SeasonalNaive"

# --- fixed values: dashboard feature groups --------------------------------
CALENDAR_FEATURES = ("week_of_year", "month", "quarter", "is_q1", "is_q4")
PROMO_HOLIDAY_FEATURES = ("promotion_flag", "holiday_flag")

# --- fixed values: test-fixture panel rules (ours, see FIXTURES.md) -------
WEEK_ANCHOR = "1995-01-02"
TYPE_CODES = {"ECONOMY": 0, "LARGE": 1, "MEDIUM": 2, "PROMO": 3, "SMALL": 4, "STANDARD": 5}
TYPE_CATEGORY = {
    "ECONOMY": "fast_moving", "STANDARD": "fast_moving",
    "SMALL": "slow_moving",
    "MEDIUM": "intermittent", "PROMO": "intermittent",
    "LARGE": "seasonal",
}
BRAND_REGION = {0: "APAC", 1: "EMEA", 2: "NA"}
HOLIDAY_ISO_WEEKS = (1, 2, 26, 51, 52)
PROMO_ISO_WEEK_RANGES = ((14, 21), (40, 47))
