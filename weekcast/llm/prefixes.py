"""Conversation prefix trie by collapsing whole sequences.

Identical conversations collapse into one weighted sequence with the list of
conversations that end there. Sequences that are proper prefixes of others go
by an anti-join; what is left are the trie's leaves. The prefixes of the
distinct sequences, weighted, are then aggregated to nodes, so a conversation
that occurs a million times is expanded once.

A prefix is known by its depth and the XOR over its turns of two 64-bit hashes
of (place, SHA-256 of role and text), a running aggregate of a window: no
conversation is ever held as one list, and texts are shuffled once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekcast.llm.common import join_heavy, save, ship

KEY = ["hi", "lo", "depth"]
EVERY = 5                   # conversations c, c + 1, ... share the opening of the one that EVERY divides
HEADS = 9                   # an opening has 0 to HEADS - 1 turns
CHUNK = 8192                # ids of one end list that travel as one row


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, a, b, size): every turn in order, its text replaced by a 128-bit digest and its UTF-8 length.

    Ordered by turn, null first; equal turns by role, then text. Null role or
    text counts as empty; rows without a conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    half = lambda at: F.conv(F.substring("digest", at, 16), 16, -10).cast("long")
    return (rows.withColumn("pos", place.cast("long")).select("conv_id", "pos", digest.alias("digest"), F.octet_length("text").cast("long").alias("size"))
            .select("conv_id", "pos", half(1).alias("a"), half(17).alias("b"), "size"))


def rebuild(table: DataFrame, every: int = EVERY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: (conv_id, n) of each, and their turns (conv_id, n, pos, a, b, size).

    Conversation c opens with the first h turns of conversation c - c % every
    (h is crc32 of c's decimal text mod ``heads``), its own turns follow after
    the first h. A join of each conversation with one short opening.
    """
    own = table.groupBy("conv_id").agg(F.max("pos").alias("n_own"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h")
    convs = own.select("conv_id", "n_own", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), h)
    lengths = own.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    opening = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = convs.join(lengths, "base", "left").select("conv_id", "base", "h", opening.alias("head"), (opening + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("n"))
    convs = save(convs, "conversations")
    rest = (table.join(convs, "conv_id").filter(F.col("pos") > F.col("h"))
            .select("conv_id", "n", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "a", "b", "size"))
    first = table.filter(F.col("pos") < heads).withColumnRenamed("conv_id", "base")
    first = first.join(convs, "base").filter(F.col("pos") <= F.col("h")).select("conv_id", "n", "pos", "a", "b", "size")
    return convs.select("conv_id", "n"), rest.unionByName(first)


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """(conv_id, n, depth, hi, lo, up_hi, up_lo, size): each prefix's key, its parent's key and its last text's bytes."""
    so_far = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lane = lambda k: F.xxhash64(F.lit(k), "pos", "a", "b")
    marked = rebuilt.select("conv_id", "n", "pos", "size", lane(1).alias("x"), lane(2).alias("y"))
    keyed = marked.select("conv_id", "n", F.col("pos").alias("depth"), F.bit_xor("x").over(so_far).alias("hi"), F.bit_xor("y").over(so_far).alias("lo"), "x", "y", "size")
    return keyed.select("conv_id", "n", "depth", "hi", "lo", F.col("hi").bitwiseXOR(F.col("x")).alias("up_hi"), F.col("lo").bitwiseXOR(F.col("y")).alias("up_lo"), "size")


def _runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted ids, run by run: (key, first id, ids as text), at most CHUNK of them a row."""
    key, ids = None, []

    def row():
        return pd.DataFrame([(*key, ids[0], ",".join(map(str, ids)))], columns=[*KEY, "first", "ids"])

    for frame in frames:
        for *at, conv in frame[[*KEY, "conv_id"]].itertuples(index=False, name=None):
            if ids and (at != key or len(ids) == CHUNK):
                yield row()
                ids = []
            key = at
            ids.append(conv)
    if ids:
        yield row()


def _digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each key's runs, fed one after the other: only the digest's state is held."""
    key, state, out = None, None, []
    for frame in frames:
        for *at, ids in frame[[*KEY, "ids"]].itertuples(index=False, name=None):
            if at != key:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = at, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if out:
            yield pd.DataFrame(out, columns=[*KEY, "ends_sha256"])
            out = []
    if key is not None:
        yield pd.DataFrame([(*key, state.hexdigest())], columns=[*KEY, "ends_sha256"])


def end_digests(ends: DataFrame, sequences: DataFrame) -> DataFrame:
    """(key, ends_sha256): the digest of each sequence's ascending, comma-joined conversations.

    A list of any length is cut into sorted runs by range; one task only feeds
    a list's runs to the digest, in order.
    """
    spark = ends.sparkSession
    alone = sequences.filter("weight = 1").select(*KEY, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256).alias("ends_sha256"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    several = ends.join(sequences.filter("weight > 1").select(*KEY), KEY, "left_semi").select(*KEY, "conv_id")
    schema = "hi long, lo long, depth long, first long, ids string"
    runs = several.repartitionByRange(parts, *KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id").mapInPandas(_runs, schema)
    digests = runs.repartition(parts, *KEY).sortWithinPartitions(*KEY, "first").mapInPandas(_digests, "hi long, lo long, depth long, ends_sha256 string")
    return alone.unionByName(digests)


def _key(hi: Column, lo: Column, depth: Column) -> list[Column]:
    return [hi.alias("hi"), lo.alias("lo"), depth.alias("depth")]


def trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of rebuilt conversations, a row per node.

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256; all but the last long. A
    table without conversations has no node, not even a root. Repeated rows are
    turns like any other; columns other than conv_id, turn, role and text are
    not read. Equal sequences are told by 128 bits.
    """
    spark = conversations.sparkSession
    ship(spark)
    none = F.lit(0).cast("long")
    convs, rebuilt = rebuild(save(turns(conversations), "turns"))
    chains = save(prefixes(rebuilt), "prefixes")
    root = convs.select("conv_id", "n", none.alias("depth"), none.alias("hi"), none.alias("lo"), none.alias("up_hi"), none.alias("up_lo"), none.alias("size"))

    # whole sequences: one row for all conversations that are equal from end to end
    ends = chains.filter("depth = n").select("conv_id", *KEY).unionByName(root.filter("n = 0").select("conv_id", *KEY))
    sequences = save(ends.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("weight")), "sequences")
    weighted = save(chains.unionByName(root).join(sequences.select("conv_id", "weight"), "conv_id"), "weighted")

    # leaves: sequences that are no proper prefix of another
    proper = weighted.filter("depth < n").select(*KEY).distinct()
    leaves = sequences.join(proper, KEY, "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    weighted = weighted.join(leaves, "conv_id", "left")
    nodes = save(weighted.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.coalesce(F.sum("leaf"), none).alias("n_leaves"),
                                            F.max("up_hi").alias("up_hi"), F.max("up_lo").alias("up_lo"), F.max("size").alias("size")), "nodes")

    # each node's own saving is booked once, on the sequence it is named after; what a sequence holds from
    # a node on is then a running sum from its end, and a subtree's sum adds up its sequences
    own = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("size")).alias("own"))
    from_end = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    below = weighted.select("conv_id", *KEY).join(own, ["conv_id", "depth"], "left").select(*KEY, F.sum(F.coalesce("own", none)).over(from_end).alias("below"))
    saved = below.groupBy(*KEY).agg(F.sum("below").alias("saved_tokens"))

    # parents: one with very many children is looked up by broadcast, others by shuffle
    child_of = nodes.filter("depth > 0").groupBy(*_key(F.col("up_hi"), F.col("up_lo"), F.col("depth") - 1)).agg(F.count("*").alias("n_children"))
    inner = save(child_of.join(nodes.select(*KEY, "conv_id"), KEY), "parents")
    parent = inner.select(F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    below_root = nodes.filter("depth > 0")
    named = join_heavy(below_root, parent, ["up_hi", "up_lo", "depth"], "n_children").drop("n_children")
    every = named.unionByName(nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")))

    out = (every.join(saved, KEY).join(inner.select(*KEY, "n_children"), KEY, "left")
           .join(end_digests(ends, sequences), KEY, "left"))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", none).alias("n_children"), "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
