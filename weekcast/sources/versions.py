"""The versioned feature store (S3-S5): runs of files by year, made visible by a manifest.

``root/version=v/data/run=<id>/week_year=<y>/`` holds what one write added;
``root/version=v/manifest-<n>.json`` says which runs make up each year. Data
files come first, the manifest last, and a manifest is created only where its
number is free: a failed or lost write leaves files that nobody reads, and of
two writers at once one has to start over. Adding a week writes that week.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekcast.sources.store import YEAR, _fs, _read_text, by_year, exists

WHOLE = "all"               # the one part of a table without weeks


def _base(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/version={version}"


def _manifest(spark: SparkSession, base: str) -> tuple[int, dict | None]:
    """(number, content) of the newest manifest; (0, None) where there is none."""
    hp, fs = _fs(spark, base)
    if not fs.exists(hp):
        return 0, None
    numbers = [int(m[1]) for st in fs.listStatus(hp) if (m := re.fullmatch(r"manifest-(\d+)\.json", st.getPath().getName()))]
    if not numbers:
        return 0, None
    return max(numbers), json.loads(_read_text(spark, f"{base}/manifest-{max(numbers):08d}.json"))


def _commit(spark: SparkSession, base: str, number: int, content: dict) -> None:
    """Publish a manifest under the next number; an error if another writer took it."""
    hp, fs = _fs(spark, f"{base}/manifest-{number:08d}.json")
    stream = fs.create(hp, False)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()


def _write_run(df: DataFrame, base: str) -> tuple[str, dict[str, list[str]]]:
    """(run, {year: [first week, last week]}) of the rows written: sorted by week, so row groups can be skipped too."""
    run = uuid.uuid4().hex[:12]
    path = f"{base}/data/run={run}"
    if "week" not in df.columns:
        df.write.parquet(path)
        return run, {WHOLE: []}
    by_year(df).repartitionByRange("week").sortWithinPartitions("week").write.partitionBy(YEAR).parquet(path)
    written = df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField(YEAR, T.IntegerType())])).parquet(path)
    found = written.groupBy(YEAR).agg(F.min("week").cast("string").alias("first"), F.max("week").cast("string").alias("last")).collect()
    return run, {str(r[YEAR]): [r.first, r.last] for r in found}           # a row for each year


def write_feature_version(df: DataFrame, root: str, version: str) -> str:
    """S3: the rows of ``version`` are those of ``df`` from now on (overwrite)."""
    spark, base = df.sparkSession, _base(root, version)
    number, _ = _manifest(spark, base)
    run, years = _write_run(df, base)
    _commit(spark, base, number + 1, {"schema": df.schema.json(), "years": {y: [[run, *span]] for y, span in years.items()}})
    return base


def append_weeks(df: DataFrame, root: str, version: str) -> str:
    """Add weeks to a version; nothing that is there is rewritten. Weeks within a span that a year already has are refused."""
    spark, base = df.sparkSession, _base(root, version)
    number, old = _open(spark, root, version)
    check_schema(df, T.StructType.fromJson(json.loads(old["schema"])))
    run, years = _write_run(df.select(*[f.name for f in T.StructType.fromJson(json.loads(old["schema"])).fields]), base)
    made = {y: list(runs) for y, runs in old["years"].items()}
    for y, (first, last) in years.items():
        for _, a, b in made.get(y, []):
            if first <= b and a <= last:
                raise ValueError(f"version {version} already has weeks from {a} to {b}; replace_years() writes a year anew")
        made.setdefault(y, []).append([run, first, last])
    _commit(spark, base, number + 1, {**old, "years": made})
    return base


def replace_years(df: DataFrame, root: str, version: str) -> str:
    """Write the years that ``df`` has anew; other years stay as they are (a dynamic partition overwrite, made visible at once)."""
    spark, base = df.sparkSession, _base(root, version)
    number, old = _open(spark, root, version)
    check_schema(df, T.StructType.fromJson(json.loads(old["schema"])))
    run, years = _write_run(df.select(*[f.name for f in T.StructType.fromJson(json.loads(old["schema"])).fields]), base)
    _commit(spark, base, number + 1, {**old, "years": old["years"] | {y: [[run, *span]] for y, span in years.items()}})
    return base


def _open(spark: SparkSession, root: str, version: str) -> tuple[int, dict]:
    number, content = _manifest(spark, _base(root, version))
    if content is None:
        raise FileNotFoundError(f"Feature version {version} not found at {_base(root, version)}")
    return number, content


def check_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """S4 schema contract: every expected column is there with its type; extra columns are let through."""
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f"{f.name}: expected {f.dataType.simpleString()}, found {have[f.name].simpleString() if f.name in have else 'nothing'}"
             for f in expected.fields if have.get(f.name) != f.dataType]
    if wrong:
        raise ValueError("feature schema mismatch: " + "; ".join(wrong))
    return df


def in_weeks(df: DataFrame, first: Column | dt.date | None = None, last: Column | dt.date | None = None) -> DataFrame:
    """Rows of the weeks ``first`` to ``last``; where ``df`` has ``week_year``, other years' folders aren't read."""
    for bound, keep in ((first, lambda a, b: a >= b), (last, lambda a, b: a <= b)):
        if bound is not None:
            limit = bound if isinstance(bound, Column) else F.lit(bound)
            df = df.filter(keep(F.col("week"), limit))
            if YEAR in df.columns:
                df = df.filter(keep(F.col(YEAR), F.year(limit)))
    return df


def read_feature_version(spark: SparkSession, root: str, version: str, expected: T.StructType | None = None,
                         first: Column | dt.date | None = None, last: Column | dt.date | None = None) -> DataFrame:
    """One version's rows (from week ``first`` to ``last``); an error when it doesn't exist or breaks the ``expected`` schema."""
    _, content = _open(spark, root, version)
    schema = T.StructType.fromJson(json.loads(content["schema"]))
    names, data = [f.name for f in schema.fields], f"{_base(root, version)}/data"
    paths = sorted({f"{data}/run={run}" + ("" if y == WHOLE else f"/{YEAR}={y}") for y, runs in content["years"].items() for run, *_ in runs})
    if not paths:
        df = spark.createDataFrame([], schema)
    else:
        own = schema if "week" not in names else T.StructType([*schema.fields, T.StructField(YEAR, T.IntegerType())])
        df = in_weeks(spark.read.schema(own).option("basePath", data).parquet(*paths), first, last).select(*names)
    return df if expected is None else check_schema(df, expected)


def list_versions(spark: SparkSession, root: str) -> list[str]:
    if not exists(spark, root):
        return []
    hp, fs = _fs(spark, root)
    names = [st.getPath().getName() for st in fs.listStatus(hp)]
    return [n.split("=", 1)[1] for n in names if n.startswith("version=") and _manifest(spark, f"{root.rstrip('/')}/{n}")[1] is not None]


def version_number(version: str) -> int:
    """Numeric part of a 'v<N>' version name (v10 sorts after v2)."""
    m = re.search(r"(\d+)$", version)
    return int(m.group(1)) if m else -1


def latest_feature_version(spark: SparkSession, root: str) -> tuple[DataFrame, str]:
    """Newest version by its numeric suffix (not by text order)."""
    versions = list_versions(spark, root)
    if not versions:
        raise FileNotFoundError(f"No versioned feature files found in {root}")
    latest = max(versions, key=version_number)
    return read_feature_version(spark, root, latest), latest
