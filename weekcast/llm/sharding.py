"""Two-pass external shuffle of records into shards.

Pass 1 scatters the records by seeded hashes into buckets that fit in memory;
pass 2 gives each bucket a Fisher-Yates shuffle and writes it. The buckets laid
end to end are one random order of the table, which is dealt out like cards:
record g goes to shard g mod S, slot g div S. So shard counts differ by one at
most (the law ``rows``), whatever ids or texts repeat.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekcast.llm.common import parts_for, row_hash, save, ship, text_bytes
from weekcast.operators.cumulative import running_sums

BUCKET_BYTES = 16 << 20
SEED = 20_240_229


def external_shuffle(docs: DataFrame, shards: int = 16, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All records as (record, size, text_crc32, bucket, place, shard, slot).

    ``record`` is the whole row, so its columns may have any names. ``size`` is
    the text's UTF-8 bytes plus one (null: one), ``text_crc32`` the checksum of
    those bytes (null: of none). The order depends on the seed and the rows
    alone: a bucket is sorted before its shuffle. Equal rows are
    interchangeable. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"),
                       (F.octet_length(raw) + F.lit(1)).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), row_hash(docs).alias("tie"))
    key = F.xxhash64(F.lit(seed), "record.doc_id", "text_crc32", "size")
    buckets = parts_for(text_bytes(docs), bucket_bytes, 2 * spark.sparkContext.defaultParallelism)
    scattered = rows.withColumn("bucket", F.pmod(key, F.lit(buckets)).cast("int"))

    def shuffle(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        keys = pa.table({"size": table.column("size"), "crc": table.column("text_crc32"), "tie": table.column("tie")})
        order = pc.sort_indices(keys, [("tie", "ascending"), ("crc", "ascending"), ("size", "ascending")]).to_numpy().copy()
        np.random.default_rng([seed, bucket]).shuffle(order)         # Fisher-Yates
        return (table.take(pa.array(order)).drop_columns(["tie"])
                .append_column("place", pa.array(np.arange(len(order), dtype=np.int64))))

    kept = rows.drop("tie")
    names = kept.columns
    out = scattered.groupBy("bucket").applyInArrow(
        lambda table: shuffle(table).select([*names, "bucket", "place"]),
        T.StructType([*kept.schema.fields, T.StructField("bucket", T.IntegerType()), T.StructField("place", T.LongType())]))
    written = save(out, "shuffled", compression="zstd")
    counts = written.groupBy("bucket").agg(F.count("*").alias("n"))             # a row for each bucket
    before = running_sums(counts, [], "bucket", ["n"]).select("bucket", (F.col("cum_n") - F.col("n")).alias("before"))
    at = F.col("before") + F.col("place")
    return (written.join(before, "bucket")
            .withColumn("shard", (at % shards).cast("int")).withColumn("slot", F.floor(at / shards).cast("long")).drop("before"))


def write_shards(shuffled: DataFrame, path: str) -> None:
    """The shuffled records as Parquet files, one folder per shard, in slot order."""
    (shuffled.select("shard", "slot", "record").repartition("shard").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
