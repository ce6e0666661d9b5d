"""SimHash near-dedup over a Gray-order hierarchical index.

A text's fingerprint takes the majority of the 64 hash bits over its word
shingles. Fingerprints within ``max_bits`` differing bits are linked, and the
linked ones form components.

Search: distinct fingerprints only. Two fingerprints within d differing bits
agree fully on one of d + 1 parts of the word, so each fingerprint is filed
under d + 1 (mask, pattern) nodes. A node with many members is split again the
same way on its remaining bits, so no task gets a large one. Inside a node the
members are sorted by Gray rank; runs of them form groups that share a mask and
a pattern, runs of groups form upper nodes, each holding only the bits its
parent lacks. A query walks down from the root, adds up the differences met so
far, and leaves out a whole group as soon as they exceed the limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekcast.llm.common import order_key, row_hash, save, ship, trim

SHINGLE = 3
MAX_BITS = 2
SEED = 42
FANOUT = 8                  # members of a group, groups of an upper node
LARGE = 128                 # a node with more members is split
ALL = (1 << 64) - 1


# ------------------------------------------------------------------ fingerprints
def fingerprints(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of each UTF-8 text (uint64); zero where there is no word."""
    out = np.zeros(len(texts), dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        words = text.lower().split()            # bytes: A-Z, and U+0020 and U+0009..U+000D
        if not words:
            continue
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        if len(words) <= shingle:
            hashes = [digest(joined, SEED)]
        else:
            starts = [0, *(ends[:len(words) - shingle] + 1).tolist()]
            hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist(), strict=True)]
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts = bits.sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(counts * 2 > len(hashes)).view(">u8")[0]
    return out


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """Signed 64-bit SimHash of a text column; null text has no word."""
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        made = fingerprints([t.encode() if isinstance(t, str) else b"" for t in texts], shingle)
        trim()
        return pd.Series(made.astype(np.int64))
    return simhash(text.cast("string"))


# ------------------------------------------------------------------ index inside nodes
def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of a code word in the reflected Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.uint8)


class GrayIndex:
    """Hierarchical index over the members of many nodes at once."""

    def __init__(self, node: np.ndarray, codes: np.ndarray, fanout: int = FANOUT):
        order = np.lexsort((gray_rank(codes), node))
        self.node, self.codes = node[order], codes[order]
        # levels[0]: members; each next level groups runs of the level below, inside one node
        self.levels = [(np.full(len(codes), ALL, dtype=np.uint64), self.codes, np.arange(len(codes) + 1))]
        owner = self.node
        while True:
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            size = np.diff(np.append(first, len(owner)))
            if size.max(initial=1) == 1 and len(self.levels) > 1:
                break
            within = np.arange(len(owner)) - np.repeat(first, size)
            cut = np.flatnonzero(within % fanout == 0)
            mask, pattern, _ = self.levels[-1]
            shared = np.bitwise_and.reduceat(mask, cut) & ~(np.bitwise_or.reduceat(pattern, cut) ^ np.bitwise_and.reduceat(pattern, cut))
            self.levels.append((shared, pattern[cut] & shared, np.append(cut, len(owner))))
            owner = owner[cut]
        self.root_of = np.cumsum(np.concatenate(([0], (self.node[1:] != self.node[:-1]).astype(np.int64))))

    def pairs(self, limit: int, chunk: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Member pairs (i < j) of one node within ``limit`` differing bits, in blocks of queries."""
        for low in range(0, len(self.codes), chunk):
            query = np.arange(low, min(low + chunk, len(self.codes)))
            at = self.root_of[query]
            mask, pattern, _ = self.levels[-1]
            differ = _popcount((self.codes[query] ^ pattern[at]) & mask[at])
            for level in range(len(self.levels) - 1, 0, -1):
                keep = differ <= limit
                query, at, differ = query[keep], at[keep], differ[keep]
                above, _, edges = self.levels[level]
                mask, pattern, below = self.levels[level - 1]
                many = edges[at + 1] - edges[at]
                ends = np.cumsum(many)
                child = np.repeat(edges[at] - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)
                query, parent, differ = np.repeat(query, many), np.repeat(at, many), np.repeat(differ, many)
                if level == 1:
                    later = child > query
                    query, parent, differ, child = query[later], parent[later], differ[later], child[later]
                own = mask[child] & ~above[parent]                  # the bits that the upper node lacks
                differ = differ + _popcount((self.codes[query] ^ pattern[child]) & own)
                at = child
            hit = differ <= limit
            yield query[hit], at[hit]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each of n members' component."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
        if (label == before).all():
            break
    return label


def _links(frame: pd.DataFrame, limit: int) -> pd.DataFrame:
    codes = frame["fp"].to_numpy().view(np.uint64)
    mask, pattern = frame["mask"].to_numpy(), frame["pattern"].to_numpy()
    order = np.lexsort((pattern, mask))
    change = np.concatenate(([False], (mask[order][1:] != mask[order][:-1]) | (pattern[order][1:] != pattern[order][:-1])))
    index = GrayIndex(np.cumsum(change), codes[order])
    found = list(index.pairs(limit))
    a, b = (np.concatenate([x[k] for x in found] or [np.zeros(0, np.int64)]) for k in (0, 1))
    # members are joined to the least fingerprint of their linked set: at most one edge for each member of a node
    root = _roots(len(codes), a, b)
    far = np.flatnonzero(root != np.arange(len(codes)))
    return pd.DataFrame({"a": index.codes[far].view(np.int64), "b": index.codes[root[far]].view(np.int64)}).drop_duplicates()


# ------------------------------------------------------------------ distributed search
def _bits(mask: int) -> list[int]:
    return [i for i in range(63, -1, -1) if mask >> i & 1]


def _parts(mask: int, n: int) -> list[int]:
    """The bits outside ``mask`` in n even parts."""
    free = _bits(ALL & ~mask)
    cuts = [round(k * len(free) / n) for k in range(n + 1)]
    return [sum(1 << i for i in free[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def similar(codes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints ``fp`` within ``max_bits`` bits of each other."""
    spark = codes.sparkSession

    def split(level: DataFrame) -> DataFrame:
        masks = [r.mask for r in level.select("mask").distinct().collect()]     # (max_bits + 1) ** depth at most
        rows = None
        for mask in masks:
            parts = [F.lit(_signed((mask & ALL) | part)) for part in _parts(mask & ALL, max_bits + 1) if part]
            here = level.filter(F.col("mask") == mask).select("fp", F.explode(F.array(*parts)).alias("mask"))
            rows = here if rows is None else rows.unionByName(here)
        if rows is None:                # an empty table
            rows = level.select("fp", "mask")
        return rows.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("pattern"))

    edges: list[DataFrame] = []
    todo = codes.select("fp", F.lit(0).cast("long").alias("mask"))
    while todo is not None:
        nodes = save(split(todo), "simhash-nodes")
        sizes = nodes.groupBy("mask", "pattern").agg(F.count("*").alias("n")).filter("n > 1")
        sized = save(nodes.join(sizes, ["mask", "pattern"]), "simhash-sized")
        small = sized.filter(F.col("n") <= LARGE)
        parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        buckets = max(4 * parts, -(-small.count() // 50_000))
        found = (small.withColumn("bucket", F.pmod(F.xxhash64("mask", "pattern"), F.lit(buckets)))
                 .groupBy("bucket").applyInPandas(lambda frame: _links(frame, max_bits), "a long, b long"))
        edges.append(save(found, "simhash-edges"))
        large = sized.filter(F.col("n") > LARGE).select("fp", "mask")
        todo = None if large.isEmpty() else large
    out = edges[0]
    for more in edges[1:]:
        out = out.unionByName(more)
    return out.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, root): every node that has a link, with the least node it can reach.

    Alternating star contraction: each round links a node's larger and then
    its smaller neighbours to its least one. The number of rounds grows with
    the logarithm of the longest path; each round is written to the shared
    folder.
    """
    edges = save(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "stars")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        large = save(large, "stars")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = save(small.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen is not None and tuple(state) == seen:
            return edges.select("a", F.col("b").alias("root"))
        seen = tuple(state)


def component_of(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root) for every distinct fingerprint of ``fps``."""
    codes = save(fps.select("fp").distinct(), "simhash-codes")
    roots = components(similar(codes, max_bits)).withColumnRenamed("a", "fp")
    return codes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def link(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the least doc_id that links reach.

    A null doc_id comes after every other and names a component (as null)
    only where all its ids are null.
    """
    ship(docs.sparkSession)
    fps = save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint_column(F.col("text"), shingle).alias("fp")), "simhash-docs")
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = least.join(component_of(fps, max_bits), "fp")
    named = save(roots.join(roots.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id"), "simhash-named")
    return fps.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the least doc_id, then the least row hash."""
    ship(docs.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    fps = save(docs.select(order_key().alias("ord"), row_hash(docs).alias("tie"), fingerprint_column(F.col("text"), shingle).alias("fp")), "simhash-docs")
    best = (fps.groupBy("fp").agg(F.min(F.struct("ord", "tie")).alias("key")).join(component_of(fps, max_bits), "fp")
            .groupBy("root").agg(F.min("key").alias("key")).select("key.ord", "key.tie"))
    keyed = docs.select(row.alias("record"), order_key().alias("ord"), row_hash(docs).alias("tie"))
    return keyed.join(save(best, "simhash-best"), ["ord", "tie"]).groupBy("ord", "tie").agg(F.first("record").alias("record")).select("record.*")
