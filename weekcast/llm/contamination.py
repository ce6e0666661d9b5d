"""Benchmark decontamination with a positional inverted index.

DataFrame operations only. The index stores one posting (term, document,
position) for each training token that some test item also uses. A window of
test words is searched from its rarest term: each posting of that term gives
a possible start of the window, adjusted by the term's place in it. The starts
are intersected with the next rarest terms' adjusted postings, and the ones
left with the rest. So frequent terms are only looked up where the rare ones
already agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekcast.llm.common import free_names, order_key, save

WINDOW = 10
FEW_DOCS = 1 << 20               # document keys (16 bytes each) that are broadcast
RARE = 3                        # terms of a window that are intersected one by one
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text, lower-cased in A-Z; null text has none."""
    return F.filter(F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), BETWEEN), lambda w: w != "")


def items_with_words(benchmark: DataFrame) -> DataFrame:
    """(item_id as text, words); an item without words has no window and is left out, a null id counts as empty text."""
    return (benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words(F.col("text")).alias("words"))
            .filter(F.size("words") > 0).distinct())


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, window, n, words): every run of ``size`` words; a shorter item is one window."""
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("words") - size))
    cut = items.select("item_id", "words", F.explode(starts).alias("at")).select("item_id", F.slice("words", F.col("at") + 1, size).alias("words"))
    distinct = cut.groupBy("words").agg(F.collect_set("item_id").alias("items"))
    return distinct.select(F.xxhash64("words").alias("window"), F.size("words").alias("n"), "words", "items")


def document_key(docs: DataFrame) -> list[Column]:
    """A document is known by its order key and a hash of its text; equal rows share their hits."""
    return [order_key().cast("long").alias("ord"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("txt")]


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, ord, txt, pos): the index over the test items' terms; ``terms`` is (word, term)."""
    tokens = docs.select(*document_key(docs), words(F.col("text")).alias("words")).select("ord", "txt", F.posexplode("words").alias("pos", "word"))
    return tokens.join(terms, "word").select("term", "ord", "txt", "pos")


def occurrences(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, slop: int = 0) -> DataFrame:
    """(ord, txt, window, start, n, items): every place where a window of the test items occurs.

    With ``slop`` 0 the window's words stand there exactly, one after the
    other; otherwise each may stand up to ``slop`` words from its place
    relative to the rarest one (proximity match).
    """
    items = save(items_with_words(benchmark), "items")
    grams = save(windows(items, size), "windows")
    slots = grams.select("window", "n", F.posexplode("words").alias("off", "word"))
    terms = save(slots.select("word").distinct().select("word", F.xxhash64("word").alias("term")), "terms")
    index = save(postings(docs, terms), "postings")
    # places of each window's terms, rarest first; a window with an unknown term has no occurrence
    frequency = index.groupBy("term").agg(F.count("*").alias("freq"))
    ranked = (slots.withColumn("term", F.xxhash64("word")).join(frequency, "term", "left")
              .withColumn("rank", F.row_number().over(Window.partitionBy("window").orderBy(F.coalesce("freq", F.lit(0)), "off"))))
    ranked = save(ranked.withColumn("least", F.min(F.coalesce("freq", F.lit(0))).over(Window.partitionBy("window")))
                  .filter("least > 0").select("window", "n", "off", "term", "rank"), "ranked")
    first = ranked.filter("rank = 1").select("window", "n", "off", "term")
    found = index.join(first, "term").select("ord", "txt", "window", "n", (F.col("pos") - F.col("off")).alias("start")).distinct()     # equal rows have equal postings
    if not slop:
        found = found.filter("start >= 0")
    near = F.explode(F.sequence(F.col("place") - slop, F.col("place") + slop)).alias("pos") if slop else F.col("place").alias("pos")
    for rank in range(2, RARE + 1):
        found = save(found, "candidates")
        slot = ranked.filter(F.col("rank") == rank).select("window", "off", "term")
        probe = found.join(slot, "window").withColumn("place", F.col("start") + F.col("off")).select("ord", "txt", "window", "n", "start", "term", near)
        match = probe.join(index.join(slot.select("term").distinct(), "term", "left_semi"), ["term", "ord", "txt", "pos"]).select("ord", "txt", "window", "n", "start")
        short = found.filter(F.col("n") < rank)             # all its terms are met
        found = match.distinct().unionByName(short.select("ord", "txt", "window", "n", "start"))
    found = save(found, "candidates")
    # the terms that are left, all at once
    slot = ranked.filter(F.col("rank") > RARE).select("window", "off", "term")
    probe = found.join(slot, "window").withColumn("place", F.col("start") + F.col("off")).select("ord", "txt", "window", "n", "start", "off", "term", near)
    # only postings of the documents that still have a candidate; up to FEW_DOCS of those are broadcast, more are shuffled
    held = save(found.select("ord", "txt").distinct(), "candidate-docs")
    postings_left = index.join(F.broadcast(held) if held.count() <= FEW_DOCS else held, ["ord", "txt"], "left_semi")
    met = (probe.join(postings_left, ["term", "ord", "txt", "pos"]).groupBy("ord", "txt", "window", "n", "start")
           .agg(F.countDistinct("off").alias("met")).filter(F.col("met") == F.col("n") - RARE).drop("met"))
    every = met.unionByName(found.filter(F.col("n") <= RARE))
    return every.join(grams.select("window", "items"), "window")


def report(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null and wordless texts have no word and no hit; items_sha256 is then that of the empty text.
    """
    found = save(occurrences(docs, benchmark, size), "occurrences")
    hit = (found.select("ord", "txt", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("pos")).distinct()
           .groupBy("ord", "txt").agg(F.count("*").alias("n_hit")))
    named = (found.select("ord", "txt", F.explode("items").alias("item_id")).distinct()
             .groupBy("ord", "txt").agg(F.sort_array(F.collect_list("item_id")).alias("items")))     # the items of one document
    per_doc = docs.select("doc_id", *document_key(docs), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    marks = hit.join(named, ["ord", "txt"])
    items = F.coalesce("items", F.array().cast("array<string>"))
    return per_doc.join(marks, ["ord", "txt"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items).cast("binary"), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold a window of a test item."""
    place, mark = free_names(docs, "ord", "txt")
    found = occurrences(docs, benchmark, size).select(F.col("ord").alias(place), F.col("txt").alias(mark)).distinct()
    order, text = document_key(docs)
    return docs.withColumn(place, order).withColumn(mark, text).join(found, [place, mark], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
