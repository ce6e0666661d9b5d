"""Lookback sequences for sequence models.

Each row's previous ``lookback`` rows (nulls -> 0) come from one bounded
row frame over the per-SKU window, so a sequence never needs its SKU's full
history in one place beyond the frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekcast.functions.constants import LOOKBACK
from weekcast.operators.cumulative import one_row_attach


def lookback_sequences(features: DataFrame, cols: list[str], lookback: int = LOOKBACK) -> DataFrame:
    """(sku_id, week, seq, target) for rows with a full lookback; seq[i] = struct(week, cols...)."""
    w = Window.partitionBy("sku_id").orderBy("week")
    cell = F.struct(F.col("week").alias("week"),
                    *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    seq = F.collect_list(cell).over(w.rowsBetween(-lookback, -1))
    return (features.select("sku_id", "week", seq.alias("seq"),
                            F.coalesce(F.col("demand"), F.lit(0.0)).alias("target"))
            .filter(F.size("seq") == lookback))


def zero_pad_sequence(features: DataFrame, cols: list[str], lookback: int = LOOKBACK) -> DataFrame:
    """Each SKU's last ``lookback`` rows as value arrays, left-padded with zero rows."""
    w = Window.partitionBy("sku_id").orderBy(F.col("week").desc())
    tail = features.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= lookback)
    row = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
    per = tail.groupBy("sku_id").agg(F.sort_array(F.collect_list(F.struct("week", row.alias("x")))).alias("_s"))
    zero = F.array(*[F.lit(0.0) for _ in cols])
    values = F.transform("_s", lambda s: s["x"])
    return per.select("sku_id", F.concat(F.array_repeat(zero, F.lit(lookback) - F.size("_s")), values).alias("seq"))


def sequence_weights(features: DataFrame, lookback: int = LOOKBACK) -> DataFrame:
    """How many full lookback windows contain each row (targets t in [lookback, n-1])."""
    w = Window.partitionBy("sku_id").orderBy("week")
    n = F.count("*").over(Window.partitionBy("sku_id"))
    i = F.row_number().over(w) - 1
    hi = F.least(n - 1, i + lookback)
    lo = F.greatest(F.lit(lookback), i + 1)
    return features.withColumn("seq_weight", F.greatest(F.lit(0), hi - lo + 1))


def feature_scaling(features: DataFrame, cols: list[str], lookback: int = LOOKBACK) -> DataFrame:
    """Per feature mean and population std (+1e-8) over all sequence cells.

    Rows are weighted by their window counts (no array expansion). Two grouped
    passes over the wide rows, the second around the first one's means; only
    the last one-row frame is unpivoted.
    """
    wt = sequence_weights(features, lookback).filter(F.col("seq_weight") > 0)
    wide = wt.select("seq_weight", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    w = F.col("seq_weight")
    means = wide.agg(F.sum(w).alias("_w"), *[(F.sum(F.col(c) * w) / F.sum(w)).alias(f"_mean_{c}") for c in cols])
    spread = one_row_attach(wide, means).groupBy(*means.columns).agg(
        *[F.sum(w * (F.col(c) - F.col(f"_mean_{c}")) ** 2).alias(f"_ss_{c}") for c in cols])
    one = spread.select(*[F.struct(F.col(f"_mean_{c}").alias("mean"), (F.sqrt(F.col(f"_ss_{c}") / F.col("_w")) + 1e-8).alias("std")).alias(c)
                          for c in cols])
    return one.unpivot([], cols, "feature", "made").select("feature", "made.mean", "made.std")
