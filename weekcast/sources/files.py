"""File sources and sinks (S1, S2, S7-S10) with declared schemas.

CSV columns are found by header name, whatever their order; values are parsed
to the declared types, and a row that doesn't parse is a rejected row with its
reasons, not a null. Empty, NaN and infinite numbers are null; the region "NA"
stays a string (Spark's CSV reader has no default null token but the empty
string).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


DEMAND_SCHEMA = T.StructType([
    T.StructField("sku_id", T.StringType()),
    T.StructField("week", T.DateType()),
    T.StructField("demand", T.DoubleType()),
    T.StructField("stockout_flag", T.IntegerType()),
    T.StructField("holiday_flag", T.IntegerType()),
    T.StructField("promotion_flag", T.IntegerType()),
])
DEMAND_TRUTH_SCHEMA = T.StructType(DEMAND_SCHEMA.fields + [T.StructField("true_demand", T.DoubleType())])
META_SCHEMA = T.StructType([
    T.StructField("sku_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("supplier_region", T.StringType()),
    T.StructField("unit_cost", T.DoubleType()),
    T.StructField("lead_time_weeks", T.IntegerType()),
])
LEADERBOARD_SCHEMA = T.StructType([
    T.StructField("rank", T.IntegerType()),
    T.StructField("model", T.StringType()),
    *[T.StructField(m, T.DoubleType()) for m in
      ("mae", "rmse", "mape", "smape", "wape", "bias", "coverage_80pct", "interval_width")],
    T.StructField("inference_ms", T.StringType()),
])
DRIFT_SUMMARY_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("baseline_wape", T.DoubleType()),
    T.StructField("data_drift", T.StructType([
        T.StructField("status", T.StringType()),
        T.StructField("drift_fraction", T.DoubleType()),
        T.StructField("drifted_features", T.MapType(T.StringType(), T.BooleanType())),
        T.StructField("method", T.StringType()),
    ])),
    T.StructField("prediction_drift", T.StructType([
        T.StructField("status", T.StringType()),
        T.StructField("ks_statistic", T.DoubleType()),
        T.StructField("p_value", T.DoubleType()),
        T.StructField("drifted", T.BooleanType()),
    ])),
    T.StructField("performance_drift", T.StructType([
        T.StructField("status", T.StringType()),
        T.StructField("baseline_wape", T.DoubleType()),
        T.StructField("recent_wape", T.DoubleType()),
        T.StructField("degradation_pct", T.DoubleType()),
        T.StructField("threshold_pct", T.DoubleType()),
    ])),
    T.StructField("action", T.StringType()),
])


CORRUPT = "_corrupt_record"
NO_NUMBER = ("", "nan", "inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")    # fixed: texts of a number that is null


def read_declared(spark: SparkSession, path: str, schema: T.StructType, required: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows of a CSV folder with a header.

    ``accepted`` has the declared columns in their order; other columns of the
    file are left out. ``rejected`` is (file, line, reasons): rows with a wrong
    number of fields, values that aren't of their type, and missing
    ``required`` values. Every row is in one of the two. A declared column that
    the header lacks is an error, and so are files whose headers differ.
    """
    raw = spark.read.option("header", True).csv(path).columns if _has_files(spark, path) else []
    if not raw:
        return (spark.createDataFrame([], schema), spark.createDataFrame([], "file string, line string, reasons array<string>"))
    where = {name.strip().lstrip("\ufeff"): k for k, name in reversed(list(enumerate(raw)))}
    absent = [f.name for f in schema.fields if f.name not in where]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}; its header is {', '.join(raw)}")
    texts = T.StructType([*[T.StructField(c, T.StringType()) for c in raw], T.StructField(CORRUPT, T.StringType())])
    rows = (spark.read.schema(texts).option("header", True).option("enforceSchema", False).option("columnNameOfCorruptRecord", CORRUPT).csv(path)
            .select(F.input_file_name().alias("file"), F.col(CORRUPT), *[F.col(f"`{raw[where[f.name]]}`").alias(f.name) for f in schema.fields]))
    made, reasons = [], [F.when(F.col(CORRUPT).isNotNull(), "wrong number of fields")]
    for f in schema.fields:
        text = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            value = text
        else:
            text = F.trim(text)
            text = F.when(~F.lower(text).isin(*NO_NUMBER), text)
            value = F.try_to_date(text, "yyyy-MM-dd") if isinstance(f.dataType, T.DateType) else text.try_cast(f.dataType)
            if isinstance(f.dataType, T.IntegerType):
                value = F.coalesce(value, F.when(text.rlike(r"^[+-]?\d+\.0*$"), text.try_cast("double").try_cast("int")))     # 1.0, as a column with nulls is written
            reasons.append(F.when(text.isNotNull() & value.isNull(), F.concat(F.lit(f"{f.name}: not {_kind(f.dataType)}: "), text)))
        if f.name in required:
            reasons.append(F.when(text.isNull() | (F.trim(text) == ""), f"{f.name}: missing"))
        made.append(value.alias(f.name))
    bad = F.array_compact(F.array(*reasons))
    line = F.coalesce(F.col(CORRUPT), F.array_join(F.array(*[F.col(f.name) for f in schema.fields]), ",", ""))
    checked = rows.withColumn("_reasons", bad)
    accepted = checked.filter(F.size("_reasons") == 0).select(*made)
    rejected = checked.filter(F.size("_reasons") > 0).select("file", line.alias("line"), F.col("_reasons").alias("reasons"))
    return accepted, rejected


def _kind(t: T.DataType) -> str:
    return {"date": "a date", "double": "a number", "int": "a whole number"}.get(t.simpleString(), t.simpleString())


def _has_files(spark: SparkSession, path: str) -> bool:
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hp):
        raise FileNotFoundError(path)
    status = fs.getFileStatus(hp)
    return not status.isDirectory() or any(st.getLen() > 0 for st in fs.listStatus(hp) if not st.getPath().getName().startswith(("_", ".")))


def read_demand(spark: SparkSession, path: str, with_truth: bool = False) -> tuple[DataFrame, DataFrame]:
    """S1 with its rejected rows; sku_id and week are required."""
    return read_declared(spark, path, DEMAND_TRUTH_SCHEMA if with_truth else DEMAND_SCHEMA, ("sku_id", "week"))


def read_sku_metadata(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S2 with its rejected rows; sku_id is required."""
    return read_declared(spark, path, META_SCHEMA, ("sku_id",))


def scan_demand(spark: SparkSession, path: str, with_truth: bool = False) -> DataFrame:
    """The accepted rows of a demand history CSV, ``week`` parsed as a date."""
    return read_demand(spark, path, with_truth)[0]


def scan_sku_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The accepted rows of the SKU dimension CSV; 'NA' is a region, not a null."""
    return read_sku_metadata(spark, path)[0]


def publish_history(panel: DataFrame, path: str, with_truth: bool = False) -> str:
    """The demand history as CSV, without ``true_demand`` unless asked for."""
    schema = DEMAND_TRUTH_SCHEMA if with_truth else DEMAND_SCHEMA
    return write_csv(panel.select(*[f.name for f in schema.fields]), path)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    return path


def write_leaderboard(board: DataFrame, path: str) -> str:
    """S7 sink: the leaderboard as CSV."""
    return write_csv(board.coalesce(1), path)


def read_leaderboard(spark: SparkSession, path: str) -> DataFrame:
    """S7 reader: wape / rmse / coverage to 1 dp, bias to 2 dp."""
    lb = spark.read.schema(LEADERBOARD_SCHEMA).option("header", True).csv(path)
    return lb.select("rank", "model", F.round("wape", 1).alias("wape"), F.round("rmse", 1).alias("rmse"),
                     F.round("bias", 2).alias("bias"), F.round("coverage_80pct", 1).alias("coverage_80pct"),
                     "inference_ms")


def drift_summary(timestamp: str, baseline_wape: float, ks: DataFrame, data: DataFrame,
                  prediction: DataFrame, performance: DataFrame, action: DataFrame) -> DataFrame:
    """The nested drift summary as one row (map of drifted features included)."""
    drifted = ks.agg(F.map_from_entries(F.collect_list(F.struct("feature", "drifted"))).alias("drifted_features"))
    from weekcast.operators.cumulative import one_row_attach

    row = one_row_attach(one_row_attach(one_row_attach(one_row_attach(
        data.select(F.struct("status", "drift_fraction").alias("_d")), drifted),
        prediction.select(F.struct("status", "ks_statistic", "p_value", "drifted").alias("prediction_drift"))),
        performance.select(F.struct("status", "baseline_wape", "recent_wape", "degradation_pct",
                                    "threshold_pct").alias("performance_drift"))),
        action.select("action"))
    return row.select(
        F.lit(timestamp).alias("timestamp"), F.lit(float(baseline_wape)).alias("baseline_wape"),
        F.struct(F.col("_d.status").alias("status"), F.col("_d.drift_fraction").alias("drift_fraction"),
                 "drifted_features", F.lit("ks").alias("method")).alias("data_drift"),
        "prediction_drift", "performance_drift", "action")


def write_drift_summary(summary: DataFrame, root: str) -> str:
    """S8 sink: append to the log of summaries; the timestamp is a column."""
    summary.coalesce(1).write.mode("append").json(root)
    return root


def latest_drift_summary(spark: SparkSession, root: str) -> DataFrame:
    """S8 reader: the summary with the greatest timestamp; of equal ones the greatest as JSON text.

    One row at most: none where nothing was written.
    """
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(root)
    if not hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hp):
        return spark.createDataFrame([], DRIFT_SUMMARY_SCHEMA)
    log = spark.read.schema(DRIFT_SUMMARY_SCHEMA).json(root)
    row = F.struct(*log.columns)
    order = F.struct(F.coalesce("timestamp", F.lit("")), F.to_json(row))
    return log.agg(F.max_by(row, order).alias("_row")).filter(F.col("_row").isNotNull()).select("_row.*")


def drift_report_flat(summary: DataFrame) -> DataFrame:
    """The nine-column report; missing statuses -> 'unknown'."""
    unknown = F.lit("unknown")
    return summary.select(
        F.coalesce("timestamp", F.lit("")).alias("timestamp"),
        F.coalesce("data_drift.status", unknown).alias("data_drift_status"),
        F.col("data_drift.drift_fraction").alias("data_drift_fraction"),
        F.coalesce("prediction_drift.status", unknown).alias("prediction_drift_status"),
        F.coalesce("performance_drift.status", unknown).alias("performance_drift_status"),
        F.col("performance_drift.recent_wape").alias("current_wape"),
        F.col("performance_drift.baseline_wape").alias("baseline_wape"),
        F.coalesce("action", unknown).alias("action"),
        F.lit(None).cast("string").alias("html_report_url"))
