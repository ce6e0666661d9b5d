"""Passages that repeat across documents: the exchange that brings their places together.

A window (so many consecutive units of one document) is to go if it also
starts in a document of smaller order. Winnowing gives each window one anchor,
chosen by the window's content, so equal windows have equal anchors:

1. Each shard of documents sends its anchors' hashes to buckets; a bucket tells
   each shard which of them more than one document holds. Texts that a smaller
   document repeats whole are found the same way and need nothing more.
2. Each shard sends the surroundings of its shared anchors to buckets, equal
   ones once, under their least document. A ``Method`` compares a bucket's
   surroundings and tells each shard which windows a smaller document holds.
   An anchor that stands in many different surroundings (a frequent phrase, the
   edge of a passage) is hot: buckets count them in step 1. Of a hot anchor
   each window goes by itself to the bucket of its own hash, so equal windows
   still meet and no bucket gets all of the anchor's surroundings.
3. Each shard takes out what those windows cover.

Inside a passage in very many documents, an anchor costs one entry for each
shard; where it meets text that differs, one for each different surrounding or
window. Nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekcast.llm import winnow
from weekcast.llm.common import LAST, free, parts_for, save, shard_documents, ship, text_bytes, trim, unpack

ANCHOR_BUCKET_BYTES = 16 << 20          # text for each bucket of anchors
CONTEXT_BUCKET_BYTES = 8 << 20          # text for each bucket of surroundings
HOT_ENTRIES = 1 << 15                   # different surroundings, shard by shard, from which an anchor is hot
HEAVY = 4                               # a shard tells how many a key of its own has from so many on; fewer count as one
TAKE_ANCHORS = 1 << 14                  # anchors whose windows are laid out at a time
PARTS = 4                               # parts of a bucket that a method may compare one after the other
BLOCK = 1 << 19
ASKED = "shard_key string, bucket long, anchors binary, heavy binary, docs binary"
OUT_SCHEMA = ("doc_id long, n_units long, n_removed long, n_spans long, "
              "spans array<struct<start:long,end:long>>, kept binary, carried string")


@dataclass
class Entries:
    """Distinct surroundings: units[first : first + size], the anchor's place in it, the least document with it, its hash, and its part of the bucket (equal windows have equal parts)."""

    first: np.ndarray
    size: np.ndarray
    anchor: np.ndarray
    order: np.ndarray
    content: np.ndarray
    part: np.ndarray


class Method:
    """What differs between byte and word passages."""

    window: int
    seed: int

    def units(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(units, per-document unit bounds, byte start and byte end of each unit)."""
        raise NotImplementedError

    def message(self, units: np.ndarray, entries: Entries) -> bytes:
        """What a shard sends to one bucket."""
        raise NotImplementedError

    def solve(self, messages: list[bytes]) -> list[np.ndarray]:
        """Of each message, a flag for each window of each entry: a smaller document holds it."""
        raise NotImplementedError

    def kept(self, text: bytes, start: np.ndarray, end: np.ndarray, keep: np.ndarray) -> bytes:
        """What is left of a text."""
        raise NotImplementedError


def _blocks(bounds: np.ndarray, window: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first unit, relative bounds) of runs of documents; a longer document in overlapping pieces."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + BLOCK, side="right")) - 1)
        if bounds[j] - bounds[i] <= BLOCK:
            yield int(bounds[i]), bounds[i:j + 1] - bounds[i]
        else:
            for a in range(int(bounds[i]), int(bounds[j]), BLOCK):
                yield a, np.array([0, min(BLOCK + window - 1, int(bounds[j]) - a)])
        i = j


def _anchors(units: np.ndarray, bounds: np.ndarray, method: Method) -> tuple[np.ndarray, ...]:
    """(position, hash, first window, last window, hash of the surroundings) of every anchor of a shard."""
    found = []
    for a, inner in _blocks(bounds, method.window):
        part = units[a:a + inner[-1]]
        p, h, first, last = winnow.anchors(part, inner, method.window, method.seed)
        content = winnow.span_hash(winnow.prefix_sums(part), first, last + method.window)
        found.append((p + a, h, first + a, last + a, content))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none, none.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _window_hashes(units: np.ndarray, bounds: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """Hash of the window at each of the ascending starts, some documents at a time."""
    out = np.empty(len(starts), dtype=np.uint64)
    for a, inner in _blocks(bounds, window):
        i, j = np.searchsorted(starts, [a, a + min(BLOCK, int(inner[-1]))])
        if i < j:
            at = starts[i:j] - a
            out[i:j] = winnow.span_hash(winnow.prefix_sums(units[a:a + inner[-1]]), at, at + window)
    return out


def _split(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stable order by bucket, filled buckets, edges)."""
    at = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    filled, first = np.unique(at[order], return_index=True)
    return order, filled, np.append(first, len(keys))


class _Shard:
    """One shard's documents as units and anchors."""

    def __init__(self, row, method: Method, buckets: int):
        self.ids, self.bounds, self.text = unpack(row.doc_ids, row.lengths, row.texts)
        data = np.frombuffer(self.text, dtype=np.uint8)
        self.units, self.unit_bounds, self.start, self.end = method.units(data, self.bounds)
        self.position, self.hash, self.first, self.last, self.content = _anchors(self.units, self.unit_bounds, method)
        self.doc = np.searchsorted(self.unit_bounds, self.position, side="right") - 1
        self.keys, self.of_key = np.unique(self.hash, return_inverse=True)
        self.order, self.filled, self.edges = _split(self.keys, buckets)
        long = np.flatnonzero(np.diff(self.unit_bounds) >= method.window)
        whole = [xxhash.xxh3_128_digest(self.text[self.bounds[d]:self.bounds[d + 1]]) for d in long]
        digest = np.array([np.frombuffer(w, "<u8") for w in whole], dtype="<u8").reshape(-1, 2)
        self.long, self.digest = long, digest
        self.doc_order, self.doc_filled, self.doc_edges = _split(digest[:, 0], buckets)


def _ask(row, method: Method, buckets: int) -> pd.DataFrame:
    s = _Shard(row, method, buckets)
    low = np.full(len(s.keys), LAST)
    high = np.full(len(s.keys), -LAST - 1)
    np.minimum.at(low, s.of_key, s.ids[s.doc])
    np.maximum.at(high, s.of_key, s.ids[s.doc])
    body = (((s.keys // np.uint64(buckets)) << np.uint64(1)) & np.uint64(0xFFFFFFFF) | (low != high).astype(np.uint64)).astype("<u4")[s.order]
    times = np.bincount(s.of_key, minlength=len(s.keys))
    some = np.flatnonzero(times[s.of_key] >= HEAVY)
    pairs = np.unique(np.stack([s.of_key[some].astype(np.uint64), s.content[some]], axis=1), axis=0)
    many = np.bincount(pairs[:, 0].astype(np.int64), minlength=len(s.keys))[s.order]
    docs = np.hstack([s.digest, s.ids[s.long].astype("<u8")[:, None]])[s.doc_order]
    anchors = {int(b): body[x:y].tobytes() for b, x, y in zip(s.filled, s.edges, s.edges[1:], strict=False)}
    heavy = {}
    for b, x, y in zip(s.filled, s.edges, s.edges[1:], strict=False):
        at = np.flatnonzero(many[x:y] >= HEAVY)
        heavy[int(b)] = np.stack([at, many[x:y][at]]).astype("<u4").tobytes()
    wholes = {int(b): docs[x:y].tobytes() for b, x, y in zip(s.doc_filled, s.doc_edges, s.doc_edges[1:], strict=False)}
    filled = sorted(anchors.keys() | wholes.keys())
    return pd.DataFrame({"shard_key": row.shard_key, "bucket": filled, "anchors": [anchors.get(b, b"") for b in filled],
                         "heavy": [heavy.get(b, b"") for b in filled], "docs": [wholes.get(b, b"") for b in filled]})


def _answer(frame: pd.DataFrame, hot_entries: int) -> pd.DataFrame:
    """Per shard: which anchors several documents hold, which are hot, and which texts a smaller document holds whole."""
    parts = [np.frombuffer(b, "<u4") for b in frame["anchors"]]
    every = np.concatenate(parts)
    _, inverse, times = np.unique(every >> np.uint32(1), return_inverse=True, return_counts=True)
    several = np.bincount(inverse, weights=every & 1) + times > 1
    shared = several[inverse]
    edges = np.cumsum([0, *map(len, parts)])
    load = np.ones(len(every))
    for a, body in zip(edges.tolist(), frame["heavy"], strict=False):
        at, many = np.frombuffer(body, "<u4").reshape(2, -1)
        load[a + at.astype(np.int64)] = many
    hot = (np.bincount(inverse, weights=load) > hot_entries)[inverse]
    docs = [np.frombuffer(b, "<u8").reshape(-1, 3) for b in frame["docs"]]
    rows = np.concatenate(docs)
    order = np.lexsort((rows[:, 2].astype(np.int64), rows[:, 1], rows[:, 0]))
    sorted_rows = rows[order]
    new = np.concatenate(([True], (sorted_rows[1:, :2] != sorted_rows[:-1, :2]).any(axis=1))) if len(rows) else np.zeros(0, bool)
    least = sorted_rows[:, 2].astype(np.int64)[np.flatnonzero(new)][np.cumsum(new) - 1] if len(rows) else np.zeros(0, np.int64)
    copy = np.zeros(len(rows), dtype=bool)
    copy[order] = least < sorted_rows[:, 2].astype(np.int64)
    doc_edges = np.cumsum([0, *map(len, docs)])
    return pd.DataFrame({"shard_key": frame["shard_key"], "bucket": frame["bucket"],
                         "anchors": [np.packbits(shared[a:b]).tobytes() for a, b in zip(edges, edges[1:], strict=False)],
                         "heavy": [np.packbits(hot[a:b]).tobytes() if hot[a:b].any() else b"" for a, b in zip(edges, edges[1:], strict=False)],
                         "docs": [np.packbits(copy[a:b]).tobytes() for a, b in zip(doc_edges, doc_edges[1:], strict=False)]})


def _unpack_bits(replies: dict[int, bytes], filled: np.ndarray, edges: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Answers of all buckets, back in the order of the keys; an empty answer is all no."""
    out = np.zeros(len(order), dtype=bool)
    for b, x, y in zip(filled.tolist(), edges, edges[1:], strict=False):
        if replies[b]:
            out[order[x:y]] = np.unpackbits(np.frombuffer(replies[b], np.uint8), count=y - x).astype(bool)
    return out


def _gather(row, method: Method, buckets: int, context_buckets: int) -> pd.DataFrame:
    """Messages with the surroundings of shared anchors, and (bucket -1) what the shard must remember."""
    s = _Shard(row, method, buckets)
    anchors = {r["bucket"]: r["anchors"] for r in row.replies} if row.replies is not None else {}
    wholes = {r["bucket"]: r["docs"] for r in row.replies} if row.replies is not None else {}
    heavy = {r["bucket"]: r["heavy"] for r in row.replies} if row.replies is not None else {}
    copies = np.zeros(len(s.ids), dtype=bool)
    copies[s.long] = _unpack_bits(wholes, s.doc_filled, s.doc_edges, s.doc_order)
    shared = _unpack_bits(anchors, s.filled, s.edges, s.order)
    at = np.flatnonzero(shared[s.of_key] & ~copies[s.doc])
    first, size, key, content = s.first[at], s.last[at] - s.first[at] + method.window, s.hash[at], s.content[at]
    alone = _unpack_bits(heavy, s.filled, s.edges, s.order)[s.of_key[at]]
    if alone.any():                                         # a hot anchor's windows, one by one
        many = np.where(alone, size - method.window + 1, 1)
        at, key, content = np.repeat(at, many), np.repeat(key, many), np.repeat(content, many)
        step = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        alone, first = np.repeat(alone, many), np.repeat(first, many) + step
        size = np.where(alone, method.window, np.repeat(size, many))
        key[alone] = content[alone] = _window_hashes(s.units, s.unit_bounds, first[alone], method.window)
    doc = s.doc[at]
    order = np.lexsort((s.ids[doc], content, key))
    new = np.concatenate(([True], (content[order][1:] != content[order][:-1]) | (key[order][1:] != key[order][:-1]))) if len(at) else np.zeros(0, bool)
    head = order[np.flatnonzero(new)]                       # the least document's
    entry = np.empty(len(at), dtype=np.int64)
    entry[order] = np.cumsum(new) - 1
    least = s.ids[doc[head]]
    lay, filled, edges = _split(key[head], context_buckets)
    place = np.empty(len(head), dtype=np.int64)
    place[lay] = np.arange(len(head))
    part = (key[head] // np.uint64(context_buckets) % np.uint64(PARTS)).astype(np.uint8)
    packer = zstandard.ZstdCompressor(level=1)
    sent = []
    for b, x, y in zip(filled.tolist(), edges, edges[1:], strict=False):
        own = head[lay[x:y]]
        sent.append((row.shard_key, b, packer.compress(method.message(s.units, Entries(first[own], size[own], s.position[at[own]] - first[own], s.ids[doc[own]], content[own], part[lay[x:y]])))))
    state = np.concatenate([[len(at), len(head)], first, size, place[entry], s.ids[doc] > least[entry], size[head][lay]]).astype("<i8").tobytes()
    sent.append((row.shard_key, -1, packer.compress(np.packbits(copies).tobytes().ljust(-(-len(s.ids) // 8)) + state)))
    return pd.DataFrame(sent, columns=["shard_key", "bucket", "body"])


def _take_out(row, method: Method, characters: bool = False) -> pd.DataFrame:
    """The shard's documents without what repeated windows cover; of ``characters`` that lost a byte nothing is kept."""
    ids, bounds, text = unpack(row.doc_ids, row.lengths, row.texts)
    units, unit_bounds, start, end = method.units(np.frombuffer(text, np.uint8), bounds)
    raw = zstandard.ZstdDecompressor().decompress(row.state)
    head = -(-len(ids) // 8)
    copies = np.unpackbits(np.frombuffer(raw[:head], np.uint8), count=len(ids)).astype(bool)
    state = np.frombuffer(raw[head:], "<i8")
    n, m = int(state[0]), int(state[1])
    first, size, place, later = (state[2 + k * n:2 + (k + 1) * n] for k in range(4))
    runs = state[2 + 4 * n:2 + 4 * n + m] - method.window + 1
    edges = np.concatenate(([0], np.cumsum(runs)))
    flags, at = np.zeros(int(edges[-1]), dtype=bool), 0
    for reply in sorted(row.replies, key=lambda r: r["bucket"]) if row.replies is not None else []:
        got = np.unpackbits(np.frombuffer(reply["body"], np.uint8), count=reply["n"]).astype(bool)
        flags[at:at + len(got)] = got
        at += len(got)
    change = np.zeros(len(units) + 1, dtype=np.int32)
    for a in range(0, n, TAKE_ANCHORS):
        b = min(n, a + TAKE_ANCHORS)
        many = size[a:b] - method.window + 1
        ends = np.cumsum(many)
        step = np.arange(int(ends[-1])) - np.repeat(ends - many, many)
        hit = flags[np.repeat(edges[place[a:b]], many) + step] | np.repeat(later[a:b] > 0, many)
        starts = (np.repeat(first[a:b], many) + step)[hit]
        np.add.at(change, starts, 1)
        np.add.at(change, starts + method.window, -1)
    gone = np.cumsum(change[:-1], dtype=np.int32) > 0
    rows = []
    carried = row.carried if row.carried is not None else [None] * len(ids)
    for d in range(len(ids)):
        a, b = int(unit_bounds[d]), int(unit_bounds[d + 1])
        body = text[bounds[d]:bounds[d + 1]]
        here = np.ones(b - a, dtype=bool) if copies[d] else gone[a:b]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], here.astype(np.int8), [0]))))
        spans = [{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2], strict=True)]
        kept = method.kept(body, start[a:b] - bounds[d], end[a:b] - bounds[d], ~here)
        if characters:
            kept = kept.decode("utf-8", "ignore").encode()
        rows.append((b - a, int(here.sum()), len(spans), spans, kept, carried[d]))
    out = pd.DataFrame(rows, columns=["n_units", "n_removed", "n_spans", "spans", "kept", "carried"])
    out.insert(0, "doc_id", pd.array([None if k == LAST else k for k in ids.tolist()], dtype="Int64"))
    return out


def remove_repeats(docs: DataFrame, method: Method, carry: list[str] | None = None, hot_entries: int = HOT_ENTRIES, characters: bool = False) -> DataFrame:
    """Per document: doc_id, n_units, n_removed, n_spans, spans (in units), kept (bytes), carried.

    ``carry`` names columns to take along as JSON in ``carried``; with
    ``characters``, ``kept`` leaves out characters that lost some of their bytes. Null texts
    count as empty. A null doc_id comes after every other; documents of equal
    id take nothing from each other.
    """
    spark = docs.sparkSession
    ship(spark)
    size = text_bytes(docs)
    least = 2 * spark.sparkContext.defaultParallelism
    buckets, context_buckets = parts_for(size, ANCHOR_BUCKET_BYTES, least), parts_for(size, CONTEXT_BUCKET_BYTES, 2 * least)
    shards = shard_documents(docs, carry)

    def each(step):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for row in frame.itertuples(index=False):
                    yield step(row)
                    trim()
        return run

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        opener = zstandard.ZstdDecompressor()
        flags = method.solve([opener.decompress(b) for b in frame["body"]])
        trim()
        return pd.DataFrame({"shard_key": frame["shard_key"], "bucket": frame["bucket"], "n": [len(f) for f in flags], "body": [np.packbits(f).tobytes() for f in flags]})

    # each exchange is dropped before the next one: the surroundings and the windows' answers are saved
    text = shards.drop("carried")
    replies = (text.mapInPandas(each(lambda row: _ask(row, method, buckets)), ASKED)
               .groupBy("bucket").applyInPandas(lambda frame: _answer(frame, hot_entries), ASKED)
               .groupBy("shard_key").agg(F.collect_list(F.struct("bucket", "anchors", "heavy", "docs")).alias("replies")))
    asked = text.join(replies, "shard_key", "left")
    sent = save(asked.mapInPandas(each(lambda row: _gather(row, method, buckets, context_buckets)), "shard_key string, bucket long, body binary"), "contexts", compression="none")
    del replies, asked
    free(spark)
    found = save(sent.filter("bucket >= 0").groupBy("bucket").applyInPandas(solve, "shard_key string, bucket long, n int, body binary"), "windows", compression="none")
    free(spark)
    found = found.groupBy("shard_key").agg(F.collect_list(F.struct("bucket", "n", "body")).alias("replies"))
    states = sent.filter("bucket < 0").select("shard_key", F.col("body").alias("state"))
    return shards.join(states.join(found, "shard_key", "left"), "shard_key").mapInPandas(each(lambda row: _take_out(row, method, characters)), OUT_SCHEMA)
