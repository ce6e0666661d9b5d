"""Shared helpers: scratch tables, splits by checksum, shards of documents.

Intermediate tables go to the folder in ``spark.checkpoint.dir``, which all
executors share, so a lost executor costs a re-read and not a recomputation.
"""

from __future__ import annotations

import ctypes
import gc
import math
import tempfile
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekcast.session import ship_code

LAST = (1 << 63) - 1            # order of a null doc_id: after every other
SHARD_BYTES = 4 << 20           # text per shard; one longer text makes a shard of its own
SHARD_SCHEMA = "shard_key string, n_docs int, doc_ids binary, lengths binary, texts binary, carried array<string>"


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder; a temporary one only for a local master that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="weekcast-llm-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


BATCH_ROWS = 1000               # rows that a Python worker gets at a time
BATCH_BYTES = 8 << 20           # and bytes: a batch of shards is held by the JVM, and twice by the worker
LARGE_BYTES = 4 << 20           # arrays from this size on go back to the system as soon as they are freed
_libc = ctypes.CDLL(None)
if hasattr(_libc, "mallopt"):
    _libc.mallopt(-3, LARGE_BYTES)          # fixed: M_MMAP_THRESHOLD
    _libc.mallopt(-1, LARGE_BYTES)          # fixed: M_TRIM_THRESHOLD
pa.set_memory_pool(pa.system_memory_pool())


def trim() -> None:
    """Give freed memory back to the system: Spark keeps idle Python workers, and what they hold, for later tasks."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def lean(run):
    """A mapInPandas function that trims its worker's memory at its end."""
    def trimmed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            yield from run(frames)
        finally:
            trim()
    return trimmed


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors (once per application), so tasks can import its kernels.

    Documents are large rows, so the session's Arrow batches get fewer of them;
    shards and blocks are larger still, so a batch's bytes are limited too.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    limit = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    size = int(limit) if limit.isdigit() else spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)
    if size > BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    ship_code(spark)


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/weekcast-llm/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back; cuts the lineage."""
    path = scratch(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    saved = df.sparkSession.read.schema(df.schema).parquet(path)
    saved._scratch = path
    return saved


def free(spark: SparkSession, *saved: DataFrame) -> None:
    """Delete saved tables that no later step reads, and let Spark drop the shuffle files of finished steps.

    Spark deletes a shuffle's files once nothing refers to it and the driver's
    JVM has collected garbage; a step of several shuffles needs that between.
    It takes two rounds: what Python lets go in the first is collected in the second.
    """
    for df in saved:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.1)


def hashable(value: Column, kind: T.DataType) -> Column:
    """``value`` with every map as its sorted entries, which Spark can hash and compare; equal maps stay equal."""
    if isinstance(kind, T.StructType):
        fields = [hashable(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields)) if fields else value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: hashable(x, kind.elementType))
    if isinstance(kind, T.MapType):
        entry = lambda e: F.struct(hashable(e["key"], kind.keyType).alias("key"), hashable(e["value"], kind.valueType).alias("value"))
        return F.array_sort(F.transform(F.map_entries(value), entry))
    return value


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a whole row, whatever its columns' names and types."""
    return F.xxhash64(*[hashable(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields])


def free_names(df: DataFrame, *stems: str) -> list[str]:
    """Column names that ``df`` doesn't have, one for each stem (Spark takes names that differ in case alone for equal)."""
    taken = {c.lower() for c in df.columns}
    made = []
    for stem in stems:
        name = f"__{stem}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        made.append(name)
    return made


HEAVY_SHARE = 1024              # a key with a 1024th of all rows or more is heavy: there are at most so many


def join_heavy(rows: DataFrame, side: DataFrame, keys: list[str], weight: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``side``, which has one row for each key and, in ``weight``, how many of ``rows`` have it.

    Heavy keys (at most HEAVY_SHARE) are broadcast, so a key with a third of
    all rows isn't shuffled at all; the others meet in a shuffle, in which none
    of them is large. Save both frames first: they are read twice.
    """
    total = side.agg(F.sum(weight)).first()[0] or 0
    heavy = side.filter(F.col(weight) * HEAVY_SHARE >= total)
    light = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(side.filter(F.col(weight) * HEAVY_SHARE < total), keys, how)
    return rows.join(F.broadcast(heavy), keys).unionByName(light)


def id_remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32(doc_id as text) mod ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def order_key(column: str = "doc_id") -> Column:
    """Document order; a null id comes last."""
    return F.coalesce(F.col(column), F.lit(LAST))


def parts_for(total_bytes: int | None, each: int, least: int = 1) -> int:
    """Number of equal parts of about ``each`` bytes, grown with the input."""
    return max(least, math.ceil((total_bytes or 0) / each))


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


# ------------------------------------------------------------------ shards
def pack(doc_ids: list[int], texts: list[bytes]) -> dict:
    packer = zstandard.ZstdCompressor(level=5)       # a shard is moved up to twice
    return {"n_docs": len(doc_ids), "doc_ids": np.array(doc_ids, dtype="<i8").tobytes(),
            "lengths": np.array([len(t) for t in texts], dtype="<i8").tobytes(),
            "texts": packer.compress(b"".join(texts))}


def unpack(doc_ids: bytes, lengths: bytes, texts: bytes) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(document order keys, byte bounds, all texts end to end)."""
    sizes = np.frombuffer(lengths, dtype="<i8")
    bounds = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    return np.frombuffer(doc_ids, dtype="<i8"), bounds, zstandard.ZstdDecompressor().decompress(texts, max_output_size=max(1, int(bounds[-1])))


def _shards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: list[tuple[int, bytes, str | None]] = []
    size = 0

    def flush() -> pd.DataFrame:
        key = uuid.uuid4().hex
        ids, texts, carried = zip(*held, strict=True)
        return pd.DataFrame([{"shard_key": key, **pack(list(ids), list(texts)), "carried": None if carried[0] is None else list(carried)}])

    for frame in frames:
        for doc, text, carried in zip(frame["ord"], frame["text"], frame["carried"], strict=True):
            raw = bytes(text) if text is not None else b""
            if held and size + len(raw) > SHARD_BYTES:
                yield flush()
                held, size = [], 0
            held.append((int(doc), raw, carried))
            size += len(raw)
    if held:
        yield flush()


JSON_OPTIONS = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _entries(kind: T.DataType) -> T.DataType:
    """A map's type as a list of entries: JSON only has text as keys."""
    entry = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)]) if isinstance(kind, T.MapType) else None
    return T.ArrayType(entry) if entry else kind


def carried_json(docs: DataFrame, carry: list[str]) -> Column:
    """Columns of a row as JSON by place, whole: nulls, microseconds and maps with keys of any type."""
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    values = [F.map_entries(F.col(f"`{c}`")) if isinstance(kinds[c], T.MapType) else F.col(f"`{c}`") for c in carry]
    return F.to_json(F.struct(*[v.alias(f"c{k}") for k, v in enumerate(values)]), JSON_OPTIONS)


def carried_columns(carried: Column, docs: DataFrame, carry: list[str]) -> dict[str, Column]:
    """The columns that ``carried_json`` packed, by name."""
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    schema = T.StructType([T.StructField(f"c{k}", _entries(kinds[c])) for k, c in enumerate(carry)])
    row = F.from_json(carried, schema, JSON_OPTIONS)
    return {c: F.map_from_entries(row[f"c{k}"]) if isinstance(kinds[c], T.MapType) else row[f"c{k}"] for k, c in enumerate(carry)}


def shard_documents(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Documents as compressed shards of about 4 MB of text, one row each, in scan order (no shuffle).

    ``carry`` names columns that go along, as one JSON object for each
    document. Saved at once: later passes join their answers to a shard by its
    key, so shards must not change when a task is run again.
    """
    along = carried_json(docs, carry) if carry else F.lit(None).cast("string")
    rows = docs.select(order_key().cast("long").alias("ord"), F.col("text").cast("string").cast("binary").alias("text"), along.alias("carried"))
    return save(rows.mapInPandas(lean(_shards), SHARD_SCHEMA), "shards", compression="none")


def spread(n_docs: int, sizes: np.ndarray, most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of documents with at most ``most`` bytes (or one longer document): arrays stay in cache."""
    ends = np.cumsum(sizes)
    i = 0
    while i < n_docs:
        before = int(ends[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield i, j
        i = j
