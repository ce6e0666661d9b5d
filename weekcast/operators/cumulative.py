"""Exact running sums over ordered values without a single-task window.

A value's 64-bit order code (a double's bits, put in numeric order) is cut into
three digits of 20, 22 and 22 bits. ``running_sums`` adds up each digit's
totals, runs a window over the first digits of a group, one over the second
digits under each first one and one over the values under each pair; a value's
sum is its own window's plus two offsets. No window holds more rows than a digit
has values, however many rows the group has, and nothing depends on the number
of tasks. Digits only deal out the work; the sums are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGIT = 22
LEAST = -(1 << (63 - 2 * DIGIT))


def order_code(value: Column) -> Column:
    """A signed 64-bit code in the order of the value as a double (NaN last, null for null)."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToRawLongBits"), F.coalesce(value.cast("double"), F.lit(0.0)) + F.lit(0.0)).cast("long")
    return F.when(value.isNotNull(), F.when(bits < 0, bits.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(bits))


def one_row_attach(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame to every row (broadcast of one row)."""
    return df.join(F.broadcast(scalars), how="inner")


def running_sums(df: DataFrame, groups: list[str], order_col: str, sum_cols: list[str]) -> DataFrame:
    """Add ``cum_<c>`` = sum of ``c`` over rows with order_col <= current, per group.

    ``df`` must hold one row per (groups, order_col) value (aggregate first);
    ``order_col`` is numeric, a null comes before every value. Group keys must
    not be null.
    """
    code = order_code(F.col(order_col))
    first = F.coalesce(F.shiftright(code, 2 * DIGIT), F.lit(LEAST - 1))
    second = F.coalesce(F.shiftright(code, DIGIT).bitwiseAND(F.lit((1 << DIGIT) - 1)), F.lit(0))
    tagged = df.withColumn("_first", first.cast("long")).withColumn("_second", second.cast("long"))
    keys = [*groups, "_first", "_second"]
    total = lambda frame, by, name: frame.groupBy(*by).agg(*[F.sum(c).alias(f"{name}{c}") for c in sum_cols])

    def before(by: list[str], order: str, name: str) -> list[Column]:
        window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return [F.coalesce(F.sum(f"{name}{c}").over(window), F.lit(0)).alias(f"_{name}{c}") for c in sum_cols]

    seconds = total(tagged, keys, "s_")
    firsts = seconds.groupBy(*groups, "_first").agg(*[F.sum(f"s_{c}").alias(f"f_{c}") for c in sum_cols])
    outer = firsts.select(*groups, "_first", *before(groups, "_first", "f_"))
    inner = seconds.select(*keys, *before([*groups, "_first"], "_second", "s_"))
    offsets = inner.join(outer, [*groups, "_first"]).select(*keys, *[(F.col(f"_s_{c}") + F.col(f"_f_{c}")).alias(f"_o_{c}") for c in sum_cols])
    running = Window.partitionBy(*keys).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    out = tagged.join(offsets, keys)
    return out.select(*df.columns, *[(F.col(f"_o_{c}") + F.sum(c).over(running)).alias(f"cum_{c}") for c in sum_cols])


def exact_median(df: DataFrame, col: str, groups: list[str] | None = None) -> DataFrame:
    """Exact median (mean of the two middle values when the count is even), nulls skipped.

    Works from (value, count) pairs, so heavy ties cost one row each.
    """
    groups = groups or []
    counts = df.filter(F.col(col).isNotNull()).groupBy(*groups, col).agg(F.count("*").alias("n"))
    cum = running_sums(counts, groups, col, ["n"])
    n_all = (counts.groupBy(*groups) if groups else counts.groupBy()).agg(F.sum("n").alias("_n"))
    cum = cum.join(n_all, groups, "inner") if groups else one_row_attach(cum, n_all)
    lo_rank = F.floor((F.col("_n") - 1) / 2)       # 0-based middle ranks
    hi_rank = F.ceil((F.col("_n") - 1) / 2)
    first_rank = F.col("cum_n") - F.col("n")
    last_rank = F.col("cum_n") - 1
    covers = lambda r: (first_rank <= r) & (last_rank >= r)
    agg = cum.groupBy(*groups).agg(
        F.max(F.when(covers(lo_rank), F.col(col))).alias("_lo"),
        F.max(F.when(covers(hi_rank), F.col(col))).alias("_hi"))
    return agg.select(*groups, ((F.col("_lo") + F.col("_hi")) / 2).alias(f"median_{col}"))



def exact_quantiles(df: DataFrame, col: str, probs: dict[str, float], groups: list[str] | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles per group, nulls skipped.

    position = q * (n - 1); value = v[floor] + (v[ceil] - v[floor]) * frac,
    with v the sorted values. Built from (value, count) pairs and running
    sums, so no task buffers a whole group.
    """
    groups = groups or []
    counts = df.filter(F.col(col).isNotNull()).groupBy(*groups, col).agg(F.count("*").alias("n"))
    cum = running_sums(counts, groups, col, ["n"])
    n_all = (counts.groupBy(*groups) if groups else counts.groupBy()).agg(F.sum("n").alias("_n"))
    cum = cum.join(n_all, groups, "inner") if groups else one_row_attach(cum, n_all)
    first_rank = F.col("cum_n") - F.col("n")
    last_rank = F.col("cum_n") - 1
    aggs = []
    for name, q in probs.items():
        pos = F.lit(q) * (F.col("_n") - 1)
        for side, r in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            aggs.append(F.max(F.when((first_rank <= r) & (last_rank >= r), F.col(col))).alias(f"_{name}_{side}"))
        aggs.append(F.max(pos - F.floor(pos)).alias(f"_{name}_frac"))
    agg = cum.groupBy(*groups).agg(*aggs)
    return agg.select(*groups, *[
        (F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_frac")).alias(n)
        for n in probs])
