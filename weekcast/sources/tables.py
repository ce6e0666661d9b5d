"""Driver table access with declared schemas: only these columns are read, and reading starts no job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LINEITEM = "l_partkey long, l_quantity double, l_shipdate timestamp_ntz"
PART = "p_partkey long, p_brand string, p_type string, p_retailprice double"


def table(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem", LINEITEM)


def part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part", PART)
