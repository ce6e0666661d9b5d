"""Language-model scoring by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER`` bytes, counted over all
training documents. A symbol is coded in its longest known context; where that
context has not seen it, an escape is coded and the next shorter context is tried, without the symbols
already ruled out (symbol exclusion). Below order 0 the symbols left are
equally likely. The escape estimate is method D: each distinct symbol of a
context gives half a count to the escape. Shorter contexts count a symbol once
for each longer context that holds it (update exclusion). A document's score is the log10 probability of its lower-cased
UTF-8 bytes and of its end.

Counting and scoring work on arrays: a block's positions are reduced to their
distinct (context, symbol) codes first, and only those walk down the trie.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekcast.llm import winnow
from weekcast.llm.common import LAST, parts_for, save, shard_documents, ship, spread, text_bytes, unpack

ORDER = 5
DISCOUNT = 0.5                  # method D
EDGE = 0xFF                     # never a byte of UTF-8: stands before the first byte and for the end
SUFFIX = 0xFFFF                 # contexts are filed by their last two bytes
TRIE_BYTES = 64 << 20           # a pass holds this much of the trie
ENTRY_BYTES = 12
BUCKET_BYTES = 16 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def codes_of(texts: np.ndarray, bounds: np.ndarray, order: int = ORDER) -> np.ndarray:
    """(context, symbol) code of every byte and every end: the symbol is the lowest byte, then the latest context byte."""
    n = len(bounds) - 1
    sizes = np.diff(bounds)
    line = np.full(len(texts) + n * (order + 1), EDGE, dtype=np.uint8)
    line[np.arange(len(texts)) + np.repeat(order + (order + 1) * np.arange(n), sizes)] = LOWER[texts]
    codes = np.zeros(max(len(line) - order, 0), dtype=np.uint64)
    for k in range(order + 1):
        codes = (codes << np.uint64(8)) | line[k:len(line) - order + k]
    first = bounds[:-1] + (order + 1) * np.arange(n)
    keep = np.zeros(len(codes) + 1, dtype=np.int8)
    np.add.at(keep, first, 1)
    np.add.at(keep, np.minimum(first + sizes + 1, len(codes)), -1)
    return codes[np.cumsum(keep[:-1]).astype(bool)]


def _blocks(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    yield from spread(len(bounds) - 1, np.diff(bounds))


def add_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of counts by code."""
    codes = np.concatenate([p[0] for p in parts] or [np.zeros(0, np.uint64)])
    counts = np.concatenate([p[1] for p in parts] or [np.zeros(0, np.int64)])
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def shorter(codes: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Order-``order`` codes, each with the number of codes one order higher that end in it."""
    codes = codes & np.uint64((1 << 8 * (order + 1)) - 1)
    return np.unique(codes, return_counts=True)


class Trie:
    """Lookup tables of all orders, compiled from the counts of full-length codes."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, low: tuple[np.ndarray, np.ndarray], order: int = ORDER):
        """``low`` has the order-1 codes and counts of the whole corpus; ``codes`` may be one pass's part."""
        self.order = order
        entries = {order: (codes, counts)}
        for k in range(order - 1, -1, -1):
            entries[k] = low if k == 1 else shorter(entries[k + 1][0], k)
        self.entries = entries
        self.contexts: dict[int, tuple[np.ndarray, ...]] = {}
        for k, (code, n) in entries.items():
            context = code >> np.uint64(8)
            first = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1]))) if len(code) else np.zeros(0, np.int64)
            total = np.add.reduceat(n, first) if len(first) else n
            distinct = np.diff(np.append(first, len(code)))
            self.contexts[k] = (context[first], total, distinct, first)
        # what is left one order lower, once this context's symbols are excluded
        self.below: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for k in range(order, 0, -1):
            code, _ = entries[k]
            context, _, distinct, first = self.contexts[k]
            parent, total, kinds, _ = self.contexts[k - 1]
            at = np.searchsorted(entries[k - 1][0], code & np.uint64((1 << 8 * k) - 1))
            taken = np.add.reduceat(entries[k - 1][1][at], first) if len(first) else first
            up = np.searchsorted(parent, context & np.uint64((1 << 8 * (k - 1)) - 1))
            self.below[k] = (total[up] - taken, kinds[up] - distinct)
        self.symbols = len(entries[0][0])

    def cost(self, codes: np.ndarray) -> np.ndarray:
        """Natural-log code length of each (context, symbol) code."""
        cost = np.zeros(len(codes))
        left = np.arange(len(codes))
        room = np.zeros(len(codes))                 # denominator and escapes at the order at hand
        escapes = np.zeros(len(codes))
        escaped = np.zeros(len(codes), dtype=bool)
        for k in range(self.order, -1, -1):
            here = codes[left] & np.uint64((1 << 8 * (k + 1)) - 1)
            context, total, distinct, _ = self.contexts[k]
            at, known = _find(context, here >> np.uint64(8))
            fresh = known & ~escaped[left]
            room[left[fresh]] = total[at[fresh]]
            escapes[left[fresh]] = distinct[at[fresh]]
            entry, seen = _find(self.entries[k][0], here)
            hit = left[seen]
            cost[hit] += np.log(room[hit]) - np.log(self.entries[k][1][entry[seen]] - DISCOUNT)
            miss = known & ~seen
            out = left[miss]
            pay = out[escapes[out] > 0]
            cost[pay] += np.log(room[pay]) - np.log(DISCOUNT * escapes[pay])
            if k:
                room[out], escapes[out] = (x[at[miss]] for x in self.below[k])
                escaped[out] = True
            left = left[~seen]
        cost[left] += np.log(max(1, 256 - self.symbols))
        return cost


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


# ------------------------------------------------------------------ shards of documents
def _trains(order_keys: np.ndarray, modulus: int, held: int) -> np.ndarray:
    return np.array([zlib.crc32(b"" if k == LAST else str(k).encode()) % modulus != held for k in order_keys.tolist()], dtype=bool)


def _tokens(texts: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, per-document offsets), block by block to stay in cache."""
    hashes, counts = [], [np.zeros(1, np.int64)]
    for i, j in _blocks(bounds):
        data = LOWER[texts[bounds[i]:bounds[j]]]
        start, end, offsets = winnow.words(data, bounds[i:j + 1] - bounds[i])
        hashes.append(winnow.span_hash(winnow.prefix_sums(data), start, end))
        counts.append(np.diff(offsets))
    return np.concatenate(hashes or [np.zeros(0, np.uint64)]), np.cumsum(np.concatenate(counts))


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (winnow.mix(keys) % np.uint64(buckets)).astype(np.int64)


def _by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, filled buckets, edges) that lay sorted keys out bucket by bucket."""
    at = _bucket(keys, buckets)
    order = np.argsort(at, kind="stable")
    filled, first = np.unique(at[order], return_index=True)
    return order, filled, np.append(first, len(keys))


def score(docs: DataFrame, modulus: int = 7, held: int = 2, order: int = ORDER) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The documents whose crc32(doc_id as text) mod ``modulus`` is ``held`` train
    nothing. base_score is the add-one unigram log10 probability of the
    lower-cased words and one end. Null texts count as empty, null ids as
    empty text. Without any training document every symbol is equally likely.
    Repeated rows are each scored and each count; only doc_id and text are read;
    an empty table gives no rows.

    Word counts: each shard of documents asks for its distinct words' counts,
    giving its own training counts along; a bucket of word hashes adds them up
    and answers the shard. So a frequent word costs one entry for each shard.
    """
    spark = docs.sparkSession
    ship(spark)
    shards = shard_documents(docs)
    size = text_bytes(docs)
    least = 2 * spark.sparkContext.defaultParallelism
    buckets = parts_for(size, BUCKET_BYTES, least)

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                ids, bounds, raw = unpack(row.doc_ids, row.lengths, row.texts)
                hashes, offsets = _tokens(np.frombuffer(raw, np.uint8), bounds)
                trains = np.repeat(_trains(ids, modulus, held), np.diff(offsets))
                keys, inverse = np.unique(hashes, return_inverse=True)
                counts = np.bincount(inverse[trains], minlength=len(keys))
                lay, filled, edges = _by_bucket(keys, buckets)
                keys, counts = keys[lay].astype("<u8"), counts[lay].astype("<u4")
                yield pd.DataFrame({"shard_key": row.shard_key, "bucket": filled,
                                    "keys": [keys[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)],
                                    "counts": [counts[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]})

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(k, "<u8") for k in frame["keys"]]
        every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate([np.frombuffer(c, "<u4") for c in frame["counts"]]), minlength=len(every))
        replies = total[inverse].astype("<f8")
        edges = np.cumsum([0, *map(len, keys)])
        out = pd.DataFrame({"shard_key": frame["shard_key"], "bucket": frame["bucket"],
                            "body": [replies[a:b].astype("<u8").tobytes() for a, b in zip(edges, edges[1:], strict=False)], "tokens": 0, "kinds": 0})
        out.loc[0, ["tokens", "kinds"]] = [int(total.sum()), int((total > 0).sum())]
        return out

    answers = save(shards.mapInPandas(ask, "shard_key string, bucket long, keys binary, counts binary")
                   .groupBy("bucket").applyInPandas(answer, "shard_key string, bucket long, body binary, tokens long, kinds long"), "word-counts", compression="zstd")
    tokens, kinds = answers.agg(F.sum("tokens"), F.sum("kinds")).first()
    ends = docs.filter(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus != held).count()
    tokens, kinds = (tokens or 0) + ends, (kinds or 0) + (ends > 0)
    end_cost = float(np.log10((ends + 1) / (tokens + kinds + 1)))

    trie = save(count_contexts(shards, modulus, held, order, buckets), "trie", compression="zstd")
    passes, low = plan_passes(trie)
    replies = (answers.groupBy("shard_key").agg(F.sort_array(F.collect_list(F.struct("bucket", "body"))).alias("replies"))
               .select("shard_key", F.transform("replies", lambda r: r["body"]).alias("replies")))
    asked = shards.join(replies, "shard_key", "left")

    def scorer(held_trie, bucket_range: tuple[int, int], with_words: bool):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = Trie(*held_trie.value, order)
            for frame in frames:
                for row in frame.itertuples(index=False):
                    yield _score_shard(row, model, bucket_range if passes[1:] else None, buckets, with_words)
        return run

    def _score_shard(row, model: Trie, only: tuple[int, int] | None, buckets: int, with_words: bool) -> pd.DataFrame:
        ids, bounds, raw = unpack(row.doc_ids, row.lengths, row.texts)
        data = np.frombuffer(raw, np.uint8)
        n = len(ids)
        nats = np.zeros(n)
        for i, j in _blocks(bounds):
            codes = codes_of(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i], order)
            distinct, inverse = np.unique(codes, return_inverse=True)
            cost = model.cost(distinct)
            if only:
                at = _bucket((distinct >> np.uint64(8)) & np.uint64(SUFFIX), buckets)
                cost[(at < only[0]) | (at >= only[1])] = 0
            nats[i:j] = np.add.reduceat(cost[inverse], bounds[i:j] - bounds[i] + np.arange(j - i))
        out = pd.DataFrame({"shard_key": row.shard_key, "place": np.arange(n), "doc_id": pd.array([None if k == LAST else k for k in ids.tolist()], dtype="Int64"),
                            "held_out": ~_trains(ids, modulus, held), "nats": nats, "n_tokens": 0, "n_known": 0, "base": 0.0})
        if with_words:
            hashes, offsets = _tokens(data, bounds)
            keys, inverse = np.unique(hashes, return_inverse=True)
            lay, _, _ = _by_bucket(keys, buckets)
            counts = np.zeros(len(keys))
            counts[lay] = np.frombuffer(b"".join(row.replies) if row.replies is not None else b"", "<u8")
            of = np.repeat(np.arange(n), np.diff(offsets))
            out["n_tokens"] = np.diff(offsets) + 1
            out["n_known"] = np.bincount(of, weights=counts[inverse] > 0, minlength=n).astype(np.int64) + (1 if ends else 0)
            out["base"] = np.bincount(of, weights=np.log10((counts[inverse] + 1) / (tokens + kinds + 1)), minlength=n) + end_cost
        return out

    schema = "shard_key string, place int, doc_id long, held_out boolean, nats double, n_tokens long, n_known long, base double"
    parts = []
    for k, (first, last) in enumerate(passes):
        rows = trie.filter((F.col("bucket") >= first) & (F.col("bucket") < last)).select("codes", "counts").collect()   # at most TRIE_BYTES, or one suffix bucket
        codes, counts = add_counts([(np.frombuffer(r.codes, "<u8"), np.frombuffer(r.counts, "<i8")) for r in rows])
        held_trie = spark.sparkContext.broadcast((codes, counts, low))
        parts.append((asked if not k else shards).mapInPandas(scorer(held_trie, (first, last), not k), schema))
    scored = parts[0]
    if parts[1:]:
        for part in parts[1:]:
            scored = scored.unionByName(part)
        scored = scored.groupBy("shard_key", "place").agg(
            F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"), F.sum("nats").alias("nats"),
            F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base").alias("base"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
                         F.col("base").alias("base_score"), (-F.col("nats") / float(np.log(10))).alias("score"))


def count_contexts(shards: DataFrame, modulus: int, held: int, order: int, buckets: int, most: int = 2_000_000) -> DataFrame:
    """(bucket, codes, counts, low_codes, low_counts): the training counts of all codes, filed by the context's last two bytes.

    A task adds up its shards' counts and hands them on whenever it holds ``most`` codes, and at its end.
    """
    def emit(parts: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
        codes, counts = add_counts(parts)
        at = _bucket((codes >> np.uint64(8)) & np.uint64(SUFFIX), buckets)
        lay = np.argsort(at, kind="stable")
        filled, first = np.unique(at[lay], return_index=True)
        edges = np.append(first, len(codes))
        codes, counts = codes[lay].astype("<u8"), counts[lay].astype("<i8")
        return pd.DataFrame({"bucket": filled, "codes": [codes[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)],
                             "counts": [counts[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]})

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for frame in frames:
            for row in frame.itertuples(index=False):
                ids, bounds, raw = unpack(row.doc_ids, row.lengths, row.texts)
                data, trains = np.frombuffer(raw, np.uint8), _trains(ids, modulus, held)
                here = []
                for i, j in _blocks(bounds):
                    pick = np.flatnonzero(trains[i:j]) + i
                    keep = np.repeat(trains[i:j], np.diff(bounds[i:j + 1]))
                    sizes = bounds[pick + 1] - bounds[pick]
                    codes = codes_of(data[bounds[i]:bounds[j]][keep], np.concatenate(([0], np.cumsum(sizes))), order)
                    here.append(np.unique(codes, return_counts=True))
                parts = [add_counts(parts + here)]
                if len(parts[0][0]) > most:
                    yield emit(parts)
                    parts = []
        if parts and len(parts[0][0]):
            yield emit(parts)

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        codes, counts = add_counts([(np.frombuffer(a, "<u8"), np.frombuffer(b, "<i8")) for a, b in zip(frame["codes"], frame["counts"], strict=True)])
        low = shorter(np.unique(codes & np.uint64(0xFFFFFF)), 1)
        return pd.DataFrame([{"bucket": frame["bucket"].iloc[0], "n": len(codes), "codes": codes.tobytes(), "counts": counts.tobytes(),
                              "low_codes": low[0].tobytes(), "low_counts": low[1].astype("<i8").tobytes()}])

    return (shards.mapInPandas(count, "bucket long, codes binary, counts binary").groupBy("bucket")
            .applyInPandas(total, "bucket long, n long, codes binary, counts binary, low_codes binary, low_counts binary"))


def plan_passes(trie: DataFrame) -> tuple[list[tuple[int, int]], tuple[np.ndarray, np.ndarray]]:
    """(ranges of buckets that fit in one pass each, order-1 counts of the whole corpus).

    Sizes come from the table itself; a trie of any size is scored exactly, in
    as many passes as it takes. Order-1 counts have at most 65,536 entries.
    """
    def pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a, b in zip(frame["low_codes"], frame["low_counts"], strict=True):
                yield pd.DataFrame({"code": np.frombuffer(a, "<u8").astype(np.int64), "n": np.frombuffer(b, "<i8")})

    low = (trie.select("low_codes", "low_counts").mapInPandas(pairs, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").toPandas())
    passes: list[tuple[int, int]] = []
    first, held = 0, 0
    sizes = trie.select("bucket", "n").orderBy("bucket").collect()              # a row for each bucket
    for r in sizes:
        if held and (held + r.n) * ENTRY_BYTES > TRIE_BYTES:
            passes.append((first, r.bucket))
            first, held = r.bucket, 0
        held += r.n
    passes.append((first, LAST))
    return passes, (low["code"].to_numpy().astype(np.uint64), low["n"].to_numpy().astype(np.int64))
