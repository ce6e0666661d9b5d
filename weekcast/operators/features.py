"""Per-SKU time-series features.

All windows use one spec, ``partitionBy(sku_id).orderBy(week)``, with row
frames that end one row before the current one (features never see the
current week). Spark plans one exchange and one sort for the whole chain;
each dependent step (fill -> impute -> features) adds a Window node that
reuses the same partitioning and ordering. The panel must be dense (one
row per SKU and week), since frames count rows, not weeks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekcast.functions.columns import category_code, one_hot, region_code, safe_ratio
from weekcast.functions.constants import (
    CATEGORY_CODES,
    LAGS,
    MIN_MAX_WINDOW,
    REGION_CODES,
    ROLLING_WINDOWS,
    STOCKOUT_LOOKBACK,
    ZERO_RATIO_WINDOW,
)



def sku_week():
    """The one window spec every per-SKU feature uses."""
    return Window.partitionBy("sku_id").orderBy("week")

META_COLUMNS = ["sku_id", "category", "supplier_region", "unit_cost", "lead_time_weeks"]


def _prev(n: int):
    """Frame of the n rows before the current one."""
    return sku_week().rowsBetween(-n, -1)


def fill_gaps(df: DataFrame, col: str = "demand", out: str = "demand_filled") -> DataFrame:
    """Forward fill, then back fill what is still missing (leading nulls)."""
    past = sku_week().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # after the forward fill only leading nulls are left: the group's first value fills them all
    whole = sku_week().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn(out, F.coalesce(F.last(col, True).over(past), F.first(col, True).over(whole)))


def impute_stockout(df: DataFrame, window: int = STOCKOUT_LOOKBACK,
                    filled: str = "demand_filled", out: str = "demand_adjusted") -> DataFrame:
    """in stockout weeks, mean of the filled values of non-stockout rows
    among the previous ``window`` rows; the filled value when there are none."""
    df = fill_gaps(df, out=filled) if filled not in df.columns else df
    past_ok = F.avg(F.when(F.col("stockout_flag") == 0, F.col(filled))).over(_prev(window))
    adj = F.when(F.col("stockout_flag") == 1, F.coalesce(past_ok, F.col(filled))).otherwise(F.col(filled))
    return df.withColumn(out, adj)


def lag_columns(src: str = "demand_adjusted", lags=LAGS) -> list[Column]:
    """F2."""
    return [F.lag(src, k).over(sku_week()).alias(f"lag_{k}") for k in lags]


def rolling_columns(src: str = "demand_adjusted") -> list[Column]:
    """Means and sample stds over 4 and 12 rows; min/max over 4 rows."""
    cols = []
    for n in ROLLING_WINDOWS:
        cols.append(F.avg(src).over(_prev(n)).alias(f"rolling_mean_{n}w"))
        cols.append(F.coalesce(F.stddev_samp(src).over(_prev(n)), F.lit(0.0)).alias(f"rolling_std_{n}w"))
    cols.append(F.min(src).over(_prev(MIN_MAX_WINDOW)).alias(f"rolling_min_{MIN_MAX_WINDOW}w"))
    cols.append(F.max(src).over(_prev(MIN_MAX_WINDOW)).alias(f"rolling_max_{MIN_MAX_WINDOW}w"))
    return cols


def velocity_columns(src: str = "demand_adjusted") -> list[Column]:
    """change of the previous row vs 1 and 4 rows before it; x/0 -> null."""
    lag1 = F.lag(src, 1).over(sku_week())
    return [
        (safe_ratio(lag1, F.lag(src, 2).over(sku_week())) - 1).alias("demand_change_1w"),
        (safe_ratio(lag1, F.lag(src, 5).over(sku_week())) - 1).alias("demand_change_4w"),
    ]


def zero_ratio_column(src: str = "demand_adjusted", n: int = ZERO_RATIO_WINDOW) -> Column:
    """F8: zeros among the previous n rows over min(row_number, n).

    Early rows divide by one more than the rows they see (the empty slot
    before the first row counts in the denominator); null when the frame
    holds no value.
    """
    frame = _prev(n)
    zeros = F.sum((F.col(src) == 0).cast("int")).over(frame)
    seen = F.count(src).over(frame)
    denom = F.least(F.row_number().over(sku_week()), F.lit(n))
    return F.when(seen > 0, zeros / denom).alias(f"zero_demand_ratio_{n}w")


def calendar_columns(week: str = "week") -> list[Column]:
    """ISO week, month, quarter, is_q1, is_q4."""
    q = F.quarter(week)
    return [
        F.weekofyear(week).alias("week_of_year"),
        F.month(week).alias("month"),
        q.alias("quarter"),
        (q == 1).cast("int").alias("is_q1"),
        (q == 4).cast("int").alias("is_q4"),
    ]


def encoding_columns() -> list[Column]:
    """F10-F12, of the SKU dimension: computed once per SKU and not once per week."""
    cols = [region_code().alias("supplier_region_enc"), category_code().alias("category_enc")]
    cols += [one_hot("category", c).alias(f"cat_{c}") for c in CATEGORY_CODES]
    cols += [one_hot("supplier_region", r).alias(f"region_{r}") for r in REGION_CODES]
    cols.append(F.log1p("unit_cost").alias("log_unit_cost"))
    return cols


def time_features(panel: DataFrame) -> DataFrame:
    """Fill, impute, then all window features in one pass over the same spec."""
    adjusted = impute_stockout(fill_gaps(panel))
    return adjusted.select(
        "*",
        *lag_columns(),
        *rolling_columns(),
        *velocity_columns(),
        *calendar_columns(),
        zero_ratio_column(),
    )


def join_metadata(df: DataFrame, meta: DataFrame) -> DataFrame:
    """Left join to the SKU dimension.

    No hint: the optimizer broadcasts a small dimension; otherwise this is a
    shuffle join whose fact side is already partitioned on ``sku_id`` by the
    windows.
    """
    return df.join(meta, "sku_id", "left")


def build_features(panel: DataFrame, meta: DataFrame) -> DataFrame:
    """generate_features: panel + SKU dimension -> feature table."""
    encoded = meta.select("*", *encoding_columns())
    made = [c for c in encoded.columns if c not in meta.columns]
    # a SKU outside the dimension is encoded like one whose values are unknown
    unknown = {c: -1 if c.endswith("_enc") else 0 for c in made if c != "log_unit_cost"}
    return join_metadata(time_features(panel), encoded).fillna(unknown)
