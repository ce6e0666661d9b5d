"""Training-corpus pipeline: five operators in a row over ``documents``.

Language identification, SimHash near-dedup, suffix-array dedup, benchmark
decontamination, best-fit packing. Each stage's result is written as Parquet
and read again, so a lost executor costs a re-read of the last stage and no
earlier work. Every stage but the last returns the columns of its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekcast.llm import contamination, langid, packing, simhash, suffixes
from weekcast.llm.common import carried_columns, free_names, id_remainder, save, ship
from weekcast.llm.queries import pieces

LEAST_LANGUAGE_SCORE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the texts that some language claims: not ``und``, a score of LEAST_LANGUAGE_SCORE or more, and ``langid.claimed``.

    Fitted on the documents whose crc32(doc_id as text) mod 3 isn't 1. Null
    texts and texts without a letter go, and so does what holds hardly a
    letter amid 3-grams of the learned languages: other scripts, junk.
    """
    ship(spark)
    model = langid.fit(docs.filter(id_remainder(3) != 1))
    (name,) = free_names(docs, "made")
    made = docs.withColumn(name, langid.claimed(F.col("text"), model))
    found = F.col(f"`{name}`")
    return made.filter((found["lang_pred"] != langid.UND) & (found["score"] >= LEAST_LANGUAGE_SCORE) & found["claimed"]).drop(name)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of least doc_id of each SimHash component (of equal ids the least row hash, once).

    Null, empty and wordless texts have fingerprint zero and are linked like any
    other. All columns are kept; an empty table stays empty.
    """
    return simhash.keep_one(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes 50-byte repeats of earlier documents out of the texts.

    A character of which a byte is left alone goes too; n_chars follows the
    text. A document of which nothing is left goes; null and empty texts stay.
    """
    ship(spark)
    (empty,) = free_names(docs, "null")
    marked = docs.withColumn(empty, F.col("text").isNull())
    others = [c for c in marked.columns if c != "text"]
    out = suffixes.deduplicate(marked, others, characters=True)
    out = out.select("n_units", "n_removed", "carried", F.col("kept").cast("string").alias("left")).filter((F.length("left") > 0) | (F.col("n_units") == 0))
    columns = carried_columns(F.col("carried"), marked, others)
    columns["text"] = F.when(~columns[empty], F.col("left"))
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length("left").cast(docs.schema["n_chars"].dataType)).otherwise(columns["n_chars"])
    return out.select(*[columns[c].alias(c) for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold ten consecutive words of a benchmark item (or a whole shorter item).

    Null and wordless texts stay; rows equal in id and text go or stay together.
    All columns are kept; an empty table or benchmark drops nothing.
    """
    return contamination.clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their sequence and offset.

    A null or empty text is one piece of its end token; repeated rows and null
    ids are packed like any other. Other columns are left out; no documents give
    no rows.
    """
    return packing.pack(pieces(docs))


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_dedup),
    ("benchmark_decontamination", decontaminate),
    ("best_fit_packing", pack),
]

ORACLE_SQL = None       # SQL can't express the stages; tests compare run() with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
