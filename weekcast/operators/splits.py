"""Time-ordered selections: latest weeks, holdout split, walk-forward folds (V1-V3, W1-W3, N*).

Cutoffs are one-row DataFrames joined back with a broadcast hint: the row
count is one by construction, so the broadcast is bounded, and the plan
stays lazy. Distinct-week tables are bounded by the calendar span (52 rows
per year), so the global windows over them run in one small task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekcast.functions.constants import CV_FOLDS, TEST_WEEKS
from weekcast.sources.store import YEAR
from weekcast.sources.versions import in_weeks


def drop_null_target(df: DataFrame, target: str = "demand") -> DataFrame:
    """Drop rows with an unknown target (after features are computed)."""
    return df.dropna(subset=[target])


def sku_filter(df: DataFrame, sku_id: str) -> DataFrame:
    """One SKU's rows, ordered by week."""
    return df.filter(F.col("sku_id") == F.lit(sku_id)).orderBy("week")


def latest_weeks(df: DataFrame, n: int) -> DataFrame:
    """The n most recent distinct weeks."""
    return df.select("week").distinct().orderBy(F.col("week").desc()).limit(n)


def in_week_set(df: DataFrame, weeks: DataFrame) -> DataFrame:
    """Keep rows whose week is in ``weeks`` (bounded by the calendar); of a yearly table only their years are read."""
    if YEAR in df.columns:
        df = in_weeks(df, weeks.agg(F.min("week")).scalar(), weeks.agg(F.max("week")).scalar())
    return df.join(F.broadcast(weeks.select("week").distinct()), "week", "left_semi")


def promo_weeks(df: DataFrame) -> DataFrame:
    """Distinct weeks with a promotion."""
    return df.filter(F.col("promotion_flag") == 1).select("week").distinct()


def cutoff_week(df: DataFrame, n: int = TEST_WEEKS) -> DataFrame:
    """One-row frame: the n-th most recent distinct week."""
    return latest_weeks(df, n).agg(F.min("week").alias("cutoff_week"))


def holdout_split(df: DataFrame, n: int = TEST_WEEKS) -> tuple[DataFrame, DataFrame]:
    """V1/V2: train = weeks before the cutoff, test = the cutoff and after.

    The cutoff is a scalar subquery, so the week filter reaches the scan, and
    of a yearly table only the years of a side are read.
    """
    cutoff = cutoff_week(df, n).scalar()
    return in_weeks(df, last=cutoff).filter(F.col("week") < cutoff), in_weeks(df, first=cutoff)


def week_positions(df: DataFrame) -> DataFrame:
    """Distinct weeks with their 0-based position in time order."""
    w = Window.orderBy("week")
    return df.select("week").distinct().select("week", (F.row_number().over(w) - 1).alias("week_pos"))


def walk_forward_folds(df: DataFrame, k: int = CV_FOLDS) -> DataFrame:
    """V3: expanding-window folds over distinct weeks.

    Validation blocks have size n // (k+1); fold i validates positions
    [n - (k-i+1)*size, n - (k-i)*size) and trains on all earlier positions
    (the first fold's train block takes the remainder).
    """
    pos = week_positions(df)
    stats = pos.agg(F.count("*").alias("n_weeks"))
    folds = stats.select(
        "n_weeks",
        F.explode(F.sequence(F.lit(1), F.lit(k))).alias("fold"),
        (F.col("n_weeks") / F.lit(k + 1)).cast("int").alias("size"),
    ).select(
        "fold", "n_weeks", "size",
        (F.col("n_weeks") - F.lit(k) * F.col("size") + (F.col("fold") - 1) * F.col("size")).alias("val_start"),
    ).withColumn("val_end", F.col("val_start") + F.col("size"))
    # week lookup for the fold edges; ``pos`` is one row per calendar week
    edges = folds.join(F.broadcast(pos).alias("a"), F.col("a.week_pos") == F.col("val_start") - 1, "left") \
        .select("fold", "n_weeks", "size", "val_start", "val_end", F.col("a.week").alias("train_end_week"))
    edges = edges.join(F.broadcast(pos).alias("b"), F.col("b.week_pos") == F.col("val_start"), "left") \
        .select("*", F.col("b.week").alias("val_start_week")).drop("week", "week_pos")
    edges = edges.join(F.broadcast(pos).alias("c"), F.col("c.week_pos") == F.col("val_end") - 1, "left") \
        .select("*", F.col("c.week").alias("val_end_week")).drop("week", "week_pos")
    return edges.select(
        "fold", "n_weeks", "size", "val_start", "val_end",
        F.col("val_start").alias("n_train_weeks"), "train_end_week", "val_start_week", "val_end_week",
    )


def fold_rows(df: DataFrame, folds: DataFrame) -> DataFrame:
    """Tag rows with every fold they take part in (role = train / val).

    Each row is repeated at most k times (k folds), a fixed factor.
    """
    pos = week_positions(df)
    f = F.broadcast(folds.select("fold", "val_start", "val_end", "size"))
    rows = df.join(F.broadcast(pos), "week", "inner")
    tagged = rows.join(f, F.col("week_pos") < F.col("val_end"), "inner")
    role = F.when(F.col("week_pos") < F.col("val_start"), F.lit("train")).otherwise(F.lit("val"))
    return tagged.withColumn("role", role).drop("val_start", "val_end")


def last_value_per_sku(df: DataFrame, col: str = "demand", keys=("sku_id",)) -> DataFrame:
    """Last non-null value per SKU by week, 0 when there is none."""
    last = F.expr(f"max_by({col}, week) FILTER (WHERE {col} IS NOT NULL)")
    return df.groupBy(*keys).agg(F.coalesce(last, F.lit(0.0)).alias(f"last_{col}"))


def last_n_rows(df: DataFrame, n: int, keys=("sku_id",)) -> DataFrame:
    """The last n rows per SKU (top-k per group, pushed below the window)."""
    w = Window.partitionBy(*keys).orderBy(F.col("week").desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
