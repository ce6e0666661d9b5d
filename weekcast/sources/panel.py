"""Demand panel and SKU dimension derived from the driver tables.

The transaction table (``lineitem``) is reduced to SKU x week quantities with
a partial (map-side) aggregation, densified against a week calendar whose size
is bounded by the date span, and hash-partitioned once on ``sku_id`` so every
per-SKU window downstream reuses that partitioning.

Two SKU keys are supported:

* ``"brand_type"`` -- brand x type (at most 150 SKUs); the correctness key.
* ``"part"``       -- one SKU per part; the scale key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekcast.operators.cumulative import one_row_attach
from weekcast.functions.constants import (
    BRAND_REGION,
    HOLIDAY_ISO_WEEKS,
    PROMO_ISO_WEEK_RANGES,
    TYPE_CATEGORY,
    TYPE_CODES,
    WEEK_ANCHOR,
)

PANEL_COLUMNS = [
    "sku_num", "sku_id", "week", "week_idx", "true_demand", "stockout_flag",
    "missing_flag", "demand", "holiday_flag", "promotion_flag",
]


def _brand_no() -> Column:
    return F.substring("p_brand", 7, 10).cast("int")


def _type_no() -> Column:
    expr = None
    for name, code in TYPE_CODES.items():
        expr = (F.when(F.col("p_type") == name, F.lit(code)) if expr is None
                else expr.when(F.col("p_type") == name, F.lit(code)))
    return expr.cast("int")


def part_keys(part: DataFrame, key: str = "brand_type") -> DataFrame:
    """p_partkey -> (sku_num, brand_no, type_no, p_type, p_retailprice)."""
    p = part.select(
        "p_partkey", "p_type", "p_retailprice",
        _brand_no().alias("brand_no"), _type_no().alias("type_no"),
    )
    if key == "brand_type":
        sku = (F.col("brand_no") * 6 + F.col("type_no")).cast("long")
    elif key == "part":
        sku = F.col("p_partkey").cast("long")
    else:
        raise ValueError(f"unknown SKU key {key!r}")
    return p.withColumn("sku_num", sku)


def sku_id_of(sku_num: Column) -> Column:
    return F.concat(F.lit("PART-"), (sku_num + F.lit(10000)).cast("string"))


def monday_of(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "week")


def weekly_quantities(lineitem: DataFrame, part: DataFrame, key: str = "brand_type", tasks: int | None = None, buckets: int | None = None) -> DataFrame:
    """(sku_num, week, qty): partial aggregation before the shuffle.

    With the part key no join is needed, and there are few lines for each SKU
    and week: with ``tasks`` the lines themselves are dealt over that many tasks
    by ``sku_id`` (an additional column then), the one shuffle for the sums, the
    dense panel and everything per SKU. With ``buckets`` they are dealt by the
    bucket of their SKU (a column, too). With the brand x type key the part
    side is joined without a hint: its size grows with the data, so the
    choice between broadcast and shuffle is left to AQE's runtime statistics.
    """
    li = lineitem.select("l_partkey", "l_quantity", monday_of(F.col("l_shipdate")).alias("week"))
    if key == "part" and tasks:
        lines = li.select(F.col("l_partkey").cast("long").alias("sku_num"), "week", "l_quantity")
        if buckets:
            dealt = lines.select(F.pmod(F.xxhash64(sku_id_of(F.col("sku_num"))), F.lit(buckets)).alias("bucket"), "*").repartition(tasks, "bucket")
            return dealt.groupBy("bucket", "sku_num", "week").agg(F.sum("l_quantity").alias("qty")).withColumn("sku_id", sku_id_of(F.col("sku_num")))
        lines = lines.select(sku_id_of(F.col("sku_num")).alias("sku_id"), "*").repartition(tasks, "sku_id")
        return lines.groupBy("sku_id", "sku_num", "week").agg(F.sum("l_quantity").alias("qty"))
    if key == "part":
        lines = li.select(F.col("l_partkey").cast("long").alias("sku_num"), "week", "l_quantity")
    else:
        keys = part_keys(part, key).select("p_partkey", "sku_num")
        lines = li.join(keys, li.l_partkey == keys.p_partkey, "inner").select("sku_num", "week", "l_quantity")
    return lines.groupBy("sku_num", "week").agg(F.sum("l_quantity").alias("qty"))


def week_calendar(lineitem: DataFrame) -> DataFrame:
    """Every Monday from the first to the last shipping week, with flags.

    Two dates from one pass over ``l_shipdate``. One row per week; the row
    count is bounded by the date span (52 per year), which is what makes
    broadcasting it safe.
    """
    bounds = lineitem.agg(F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi")).select(
        monday_of(F.col("lo")).alias("lo"), monday_of(F.col("hi")).alias("hi"))
    cal = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 7 days"))).alias("week"))
    return calendar_flags(cal)


def calendar_flags(cal: DataFrame) -> DataFrame:
    iso = F.weekofyear("week")
    week_idx = F.expr(f"cast(datediff(week, date'{WEEK_ANCHOR}') div 7 as int)")
    promo_iso = None
    for lo, hi in PROMO_ISO_WEEK_RANGES:
        c = iso.between(lo, hi)
        promo_iso = c if promo_iso is None else (promo_iso | c)
    return cal.select(
        "week",
        week_idx.alias("week_idx"),
        iso.isin(*HOLIDAY_ISO_WEEKS).cast("int").alias("holiday_flag"),
        (promo_iso & (week_idx % 2 == 0)).cast("int").alias("promotion_flag"),
    )


def dense_panel(weekly: DataFrame, calendar: DataFrame) -> DataFrame:
    """Every active SKU x every calendar week, zero where nothing shipped.

    Only the sparse weekly rows are shuffled, once, by ``sku_id``; all later
    per-SKU windows reuse that exchange. Then each row stands for its own week
    and the empty weeks up to the SKU's next active one (the first row also
    for the weeks before it) and expands to them with a generator.
    """
    bounds = calendar.agg(F.min("week").alias("lo"), F.max("week").alias("hi"))
    per_sku = Window.partitionBy("sku_id").orderBy("active")
    sku_id = F.col("sku_id") if "sku_id" in weekly.columns else sku_id_of(F.col("sku_num")).alias("sku_id")
    sparse = weekly.select(sku_id, "sku_num", F.col("week").alias("active"), "qty")
    spans = one_row_attach(sparse.select("*", F.lag("active").over(per_sku).alias("before"), F.lead("active").over(per_sku).alias("after")), bounds)
    first = F.when(F.col("before").isNull(), F.col("lo")).otherwise(F.col("active"))
    last = F.when(F.col("after").isNull(), F.col("hi")).otherwise(F.date_sub("after", 7))
    dense = (spans.select("sku_id", "sku_num", "active", "qty", F.explode(F.sequence(first, last, F.expr("interval 7 days"))).alias("week"))
             .select("week", "sku_id", "sku_num", F.when(F.col("week") == F.col("active"), F.col("qty")).otherwise(F.lit(0.0)).alias("true_demand")))
    return dense.join(F.broadcast(calendar), "week", "inner")


def observed_demand(panel: DataFrame) -> DataFrame:
    """Stockout weeks observe 0, missing weeks observe null (missing wins)."""
    stockout = ((F.col("sku_num") * 13 + F.expr("week_idx div 3") * 7) % 17 == 0)
    missing = ((F.col("sku_num") * 7 + F.col("week_idx") * 11) % 40 == 0)
    return (panel
            .withColumn("stockout_flag", stockout.cast("int"))
            .withColumn("missing_flag", missing.cast("int"))
            .withColumn("demand", F.when(missing, F.lit(None).cast("double"))
                        .when(stockout, F.lit(0.0)).otherwise(F.col("true_demand")))
            .select(*PANEL_COLUMNS))


def sku_dimension(part: DataFrame, active: DataFrame, key: str = "brand_type") -> DataFrame:
    """One row per SKU of the panel (``active`` has their ``sku_num``).

    unit_cost is avg(p_retailprice) rounded half-up to cents, computed in
    integer cents so every engine rounds the same way.
    """
    keys = part_keys(part, key)
    cents = F.round(F.col("p_retailprice") * 100).cast("long")
    category = None
    for name, cat in TYPE_CATEGORY.items():
        category = (F.when(F.col("p_type") == name, F.lit(cat)) if category is None
                    else category.when(F.col("p_type") == name, F.lit(cat)))
    region = None
    for rem, reg in BRAND_REGION.items():
        region = (F.when(F.col("brand_no") % 3 == rem, F.lit(reg)) if region is None
                  else region.when(F.col("brand_no") % 3 == rem, F.lit(reg)))
    per_sku = keys.groupBy("sku_num").agg(
        F.min(category).alias("category"),
        F.min(region).alias("supplier_region"),
        F.floor((F.sum(cents) * 2 + F.count("*")) / (F.count("*") * 2)).alias("cost_cents"),
    )
    present = active.select("sku_num").distinct()
    return (per_sku.join(present, "sku_num", "left_semi")
            .select(
                sku_id_of(F.col("sku_num")).alias("sku_id"),
                "category", "supplier_region",
                (F.col("cost_cents") / F.lit(100.0)).alias("unit_cost"),
                (F.lit(1) + F.col("sku_num") % 8).cast("int").alias("lead_time_weeks"),
            ))


def dataset_profile(panel: DataFrame) -> DataFrame:
    """P5 (overall): rows, SKUs, first/last week, % missing, % zero.

    A null demand counts as "not zero" but stays in the denominator.
    """
    return panel.agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("sku_id").alias("n_skus"),
        F.min("week").alias("first_week"),
        F.max("week").alias("last_week"),
        (F.avg(F.col("demand").isNull().cast("double")) * 100).alias("pct_missing"),
        (F.avg(F.coalesce(F.col("demand") == 0, F.lit(False)).cast("double")) * 100).alias("pct_zero"),
    )


def category_profile(panel: DataFrame, meta: DataFrame) -> DataFrame:
    """P5 (per category): mean demand and % zero after an inner join."""
    joined = panel.join(meta.select("sku_id", "category"), "sku_id", "inner")
    return joined.groupBy("category").agg(
        F.avg("demand").alias("mean_demand"),
        (F.avg(F.coalesce(F.col("demand") == 0, F.lit(False)).cast("double")) * 100).alias("pct_zero"),
    )
