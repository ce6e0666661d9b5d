"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch is the ``k`` least distinct 48-bit hashes of a text's shingles. It is
mergeable (the sketch of a union is the ``k`` least of both sketches), and
estimates resemblance, containment and the number of distinct shingles. Words
are lower-cased in A-Z and split at white space; a text with fewer than five
words has one shingle, its whole word sequence; a text without words, or null,
has the empty sketch. Two empty sketches resemble each other fully (1.0), an
empty and a filled one not at all (0.0).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekcast.llm import winnow
from weekcast.llm.common import LAST, order_key, parts_for, spread, text_bytes

K = 128
SHINGLE = 5
BITS = 48
BUCKET_BYTES = 8 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def sketch_many(texts: list[bytes], k: int = K, shingle: int = SHINGLE) -> list[np.ndarray]:
    """Sorted bottom-k hashes of each UTF-8 text."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    out: list[np.ndarray] = []
    for i, j in spread(len(texts), sizes):
        data = LOWER[np.frombuffer(b"".join(texts[i:j]), dtype=np.uint8)]
        bounds = np.concatenate(([0], np.cumsum(sizes[i:j])))
        start, end, offsets = winnow.words(data, bounds)
        units = winnow.span_hash(winnow.prefix_sums(data), start, end)
        sums = winnow.prefix_sums(units)
        grams = winnow.gram_hash(sums, shingle) >> np.uint64(64 - BITS)
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            if b - a >= shingle:
                h = grams[a:b - shingle + 1]
                if len(h) > 4 * k:      # the least hashes first: sort only what can be in the sketch
                    low = np.unique(h[h <= np.partition(h, 3 * k)[3 * k]])
                    h = low if len(low) >= k else h
                out.append(np.unique(h)[:k])
            elif b > a:
                out.append(winnow.span_hash(sums, np.array([a]), np.array([b])) >> np.uint64(64 - BITS))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def encode(sketch: np.ndarray) -> str:
    """Text form: base64 of the 6-byte big-endian hashes, ascending."""
    wide = sketch.astype(">u8").view(np.uint8).reshape(-1, 8)
    return base64.b64encode(wide[:, 8 - BITS // 8:].tobytes()).decode()


def decode(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(text), dtype=np.uint8).reshape(-1, BITS // 8)
    wide = np.zeros((len(raw), 8), dtype=np.uint8)
    wide[:, 8 - BITS // 8:] = raw
    return wide.reshape(-1).view(">u8").astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of the union of two parts."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard likeness: share of the union's bottom-k that both sketches hold."""
    union = merge(a, b, k)
    if not len(union):
        return 1.0
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.count_nonzero(common <= union[-1])) / len(union)


def distinct_count(sketch: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact while the sketch isn't full."""
    return float(len(sketch)) if len(sketch) < k else (k - 1) / ((float(sketch[k - 1]) + 1) / float(1 << BITS))


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b holds; 1.0 for an empty a."""
    n = distinct_count(a, k)
    return 1.0 if not n else min(1.0, resemblance(a, b, k) * distinct_count(merge(a, b, k), k) / n)


def fingerprint(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with ``fingerprint`` (text form) and ``distinct_shingles``; any other columns are kept."""
    names = [c for c in docs.columns if c not in ("fingerprint", "distinct_shingles")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = sketch_many([t.encode() if isinstance(t, str) else b"" for t in frame["text"]], k, shingle)
            yield frame.assign(fingerprint=[encode(s) for s in made], distinct_shingles=[distinct_count(s, k) for s in made])

    kept = docs.select(names)
    schema = T.StructType([*kept.schema.fields, T.StructField("fingerprint", T.StringType()), T.StructField("distinct_shingles", T.DoubleType())])
    return kept.mapInPandas(run, schema)


# ------------------------------------------------------------------ edited neighbours
EDIT_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
               "near_edited double, near_next double, distinct_shingles double")


def _compare(docs: list[tuple[int, str]], last_next: str) -> pd.DataFrame:
    texts = [t for _, t in docs] + [last_next]
    edited = []
    for own, following in zip(texts, texts[1:], strict=False):
        cut = len(own) // 4
        edited.append((own[:len(own) - cut] + following[:cut]).encode())
    made = sketch_many([t.encode() for t in texts] + edited)
    own, changed = made[:len(texts)], made[len(texts):]
    return pd.DataFrame({
        "doc_id": pd.array([None if d == LAST else d for d, _ in docs], dtype="Int64"), "n_chars": [len(t) for t in texts[:-1]],
        "edited_sha256": [hashlib.sha256(t).hexdigest() for t in edited],
        "fingerprint": [encode(s) for s in own[:-1]], "edited_fingerprint": [encode(s) for s in changed],
        "near_edited": [resemblance(a, b) for a, b in zip(own, changed, strict=False)],
        "near_next": [resemblance(a, b) for a, b in zip(own, own[1:], strict=False)],
        "distinct_shingles": [distinct_count(s) for s in own[:-1]]})


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Each text against its edited form and its next document, in ascending doc_id.

    The edited text replaces the last quarter of the code points by the first
    as many of the next document (after the last: the first). A null id comes
    last; equal ids follow each other by text; a null text is empty. Repeated
    rows are each other's neighbours. Only doc_id and text are read; an empty
    table gives no rows, a single document is its own neighbour.

    Documents are dealt into ranges of doc_id of about 8 MB of text, in one
    shuffle. The first document of each range also goes to the range before,
    as the neighbour of its last document.
    """
    spark = docs.sparkSession
    rows = docs.select(order_key().cast("long").alias("ord"), F.col("text").cast("string").alias("text"))
    n = parts_for(text_bytes(docs), BUCKET_BYTES, 2 * spark.sparkContext.defaultParallelism)
    cuts = rows.agg(F.percentile_approx("ord", [(i + 1) / n for i in range(n - 1)] or [0.5], 20 * n)).first()[0] or []
    cuts = np.unique(np.array(cuts, dtype=np.int64))

    def first_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            at = np.searchsorted(cuts, frame["ord"].to_numpy(), side="left")
            yield pd.DataFrame({"bucket": at, "least": frame["ord"].to_numpy()}).groupby("bucket", as_index=False).min()

    firsts = rows.select("ord").mapInPandas(first_of, "bucket int, least long").groupBy("bucket").agg(F.min("least").alias("least")).orderBy("bucket").collect()
    filled = [r.bucket for r in firsts]     # a row for each range at most
    before = {r.least: filled[i - 1] for i, r in enumerate(firsts)}

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame = frame.assign(bucket=np.searchsorted(cuts, frame["ord"].to_numpy(), side="left"), extra=0, text=frame["text"].fillna(""))
            copies = frame[frame["ord"].isin(before.keys())]
            yield frame
            if len(copies):
                yield copies.assign(bucket=[before[o] for o in copies["ord"]], extra=1)

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[int, str]] = []
        bucket, size = None, 0
        for frame in frames:
            for doc, at, extra, text in zip(frame["ord"], frame["bucket"], frame["extra"], frame["text"], strict=True):
                if extra and at != bucket:
                    continue                                # a later copy of the neighbour's id
                if held and (extra or size > 1 << 20):      # the text at hand is the last one's neighbour
                    yield _compare(held, text)
                    held, size = [], 0
                bucket = None if extra else at
                if not extra:
                    held.append((int(doc), text))
                    size += len(text)

    dealt = rows.mapInPandas(deal, "ord long, text string, bucket int, extra int")
    return dealt.repartition(n, "bucket").sortWithinPartitions("bucket", "extra", "ord", "text").mapInPandas(walk, EDIT_SCHEMA)
