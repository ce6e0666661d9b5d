"""Materialised tables (shared inputs of the queries).

``materialize`` writes a DataFrame once as Parquet under the session's
checkpoint folder (``spark.checkpoint.dir``, a shared folder on a cluster)
and reads it back. That cuts long lineages (the drift demo would otherwise
plan the feature pipeline dozens of times), lets a lost executor's work be
re-read instead of recomputed, and keeps column pruning and filter pushdown
for every consumer. Paths are keyed by the inputs' sizes and modification
times and by a hash of this package's code, so stale results are never
reused.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekcast.session import ensure_checkpoint_dir

_PKG_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_CODE_HASH: str | None = None


def code_hash() -> str:
    global _CODE_HASH
    if _CODE_HASH is None:
        h = hashlib.sha1()
        for root, _, files in sorted(os.walk(_PKG_ROOT)):
            for f in sorted(files):
                if f.endswith(".py"):
                    with open(os.path.join(root, f), "rb") as fh:
                        h.update(fh.read())
        _CODE_HASH = h.hexdigest()[:12]
    return _CODE_HASH


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    return hp, hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hp, fs = _fs(spark, path)
    return bool(fs.exists(hp))


def input_fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Hash of every input file's path, length and modification time (folder times say nothing on object stores)."""
    parts = []
    for p in paths:
        hp, fs = _fs(spark, p)
        files = fs.listFiles(hp, True)
        while files.hasNext():
            f = files.next()
            parts.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
    return hashlib.sha1("|".join(sorted(parts)).encode()).hexdigest()[:12]


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file, or of all files of a folder."""
    hp, fs = _fs(spark, path)
    return fs.getContentSummary(hp).getLength()


def store_root(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark).rstrip("/") + "/weekcast-store"


YEAR = "week_year"          # partition column of tables that are filtered by week


def by_year(df: DataFrame) -> DataFrame:
    """``df`` with the year of its week as last column."""
    return df.withColumn(YEAR, F.year("week"))


def materialize(spark: SparkSession, build: Callable[[], DataFrame], name: str, fingerprint: str, yearly: bool = False) -> DataFrame:
    """The stored table ``name``; built and written first where the store lacks it.

    A ``yearly`` table has a folder for each year of its weeks and the column
    ``week_year``, so filters on weeks that also name years skip folders.

    A writer publishes its own folder with a ``_SUCCESS`` file and then points
    the name at it. Whoever points last wins; both folders hold the same rows.
    The schema is stored with the pointer, so reading starts no job.
    """
    safe = re.sub(r"[^A-Za-z0-9_.=-]", "_", name)
    pointer = f"{store_root(spark)}/{safe}-{fingerprint}-{code_hash()}.json"
    known = _read_text(spark, pointer)
    if known is None:
        path = f"{store_root(spark)}/{safe}-{fingerprint}-{uuid.uuid4().hex[:8]}"
        df = by_year(build()) if yearly else build()
        (df.write.partitionBy(YEAR) if yearly else df.write).parquet(path)
        known = json.dumps({"path": path, "schema": df.schema.json()})
        _write_text(spark, pointer, known)
    found = json.loads(known)
    return spark.read.schema(T.StructType.fromJson(json.loads(found["schema"]))).parquet(found["path"])


def _read_text(spark: SparkSession, path: str) -> str | None:
    hp, fs = _fs(spark, path)
    if not fs.exists(hp):
        return None
    stream = fs.open(hp)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    hp, fs = _fs(spark, path)
    stream = fs.create(hp, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
