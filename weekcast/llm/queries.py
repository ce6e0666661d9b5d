"""The operators bound to the tables: one query opN_<name> each, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekcast.llm import collocations, contamination, extraction, langid, packing, ppm, prefixes, sharding, simhash, sketches, substrings, suffixes, tokens, toxicity
from weekcast.llm.common import save, ship
from weekcast.llm.oracles import SQL as SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> bytes:
    """A public vocabulary file, read on the driver."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def pieces(docs: DataFrame) -> DataFrame:
    """Token pieces by the public byte_bpe_50k vocabulary with its added tokens, saved."""
    added = tokens.added_tokens(vocabulary("byte_bpe_50k.json"))
    return save(packing.cut(docs, vocabulary("byte_bpe_50k.tiktoken"), added=added), "pieces")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.external_shuffle(_table(spark, sf_dir, "documents"), shards=16)
    return dealt.select("record.doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.deduplicate(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.deduplicate(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("n_units").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(pieces(_table(spark, sf_dir, "documents")))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.link(_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(_table(spark, sf_dir, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(_table(spark, sf_dir, "documents"))


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.edited_likeness(_table(spark, sf_dir, "documents"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.trie(_table(spark, sf_dir, "conversations"))


def op13_phrase_collocation_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_sharding": op2_sharding,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_language_id": op7_language_id,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_document_fingerprints": op10_document_fingerprints,
    "op11_html_extraction": op11_html_extraction,
    "op12_conversation_prefix_trie": op12_conversation_prefix_trie,
    "op13_phrase_collocation_mining": op13_phrase_collocation_mining,
}

