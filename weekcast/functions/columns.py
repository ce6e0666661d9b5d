"""Column builders shared by operators (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from weekcast.functions.constants import CATEGORY_CODES, REGION_CODES


def code_of(col: str, codes: dict[str, int]) -> Column:
    """Fixed-vocabulary ordinal code; unknown or null -> -1."""
    mapping = F.create_map(*[x for k, v in codes.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(mapping[F.col(col)], F.lit(-1)).cast("int")


def region_code(col: str = "supplier_region") -> Column:
    return code_of(col, REGION_CODES)


def category_code(col: str = "category") -> Column:
    return code_of(col, CATEGORY_CODES)


def one_hot(col: str, value: str) -> Column:
    """1 when col == value, 0 otherwise (null -> 0)."""
    return F.coalesce(F.col(col) == F.lit(value), F.lit(False)).cast("int")


def clamp_nonneg(c: Column) -> Column:
    """max(0, x) with null kept null (F16)."""
    return F.when(c.isNull(), c).otherwise(F.greatest(F.lit(0.0), c))


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, null when den is 0 or null (ANSI-safe)."""
    return F.try_divide(num, den)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Normalise NaN to null in every floating column (entry rule)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            out.append(F.when(F.isnan(f.name), F.lit(None).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (stable value hashing across engines)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
