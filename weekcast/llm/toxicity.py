"""Toxic spans by a linear-chain conditional random field.

Tokens are runs of letters and digits, lower-cased. Token labels come from the
document labels: in toxic training documents the tokens whose word or
word stem best tells them from clean ones are toxic, all other tokens are
clean. The field has two states, word, stem and suffix features, and transitions; it is fitted by
gradient steps on forward-backward marginals. A document's score is a logistic
function of its tokens' marginals; tokens likelier toxic than not are spans.

Forward-backward works on segments of ``SEGMENT`` tokens side by side: products
of transition matrices carry messages from segment to segment, so one very
long text costs no more steps than many short ones.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekcast.llm import winnow
from weekcast.llm.common import id_remainder, ship, spread

SAMPLE = 1500               # training documents of each label
SAMPLE_BYTES = 4 << 20      # text of the training documents, at most
SAMPLE_CHARS = 8192         # of a longer training document, a random segment of so many characters
SEGMENT = 128
FEATURES = 1 << 18
STEMS = (4, 5, 6, 7, 8)     # bytes of a word's stems
ROUNDS = 40
_FOLD = np.zeros(256, dtype=np.uint8)           # 0: between tokens
_FOLD[48:58] = np.arange(48, 58)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def tokenize(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, per-document offsets, hashes of word, stems and suffix) of the tokens of documents laid end to end."""
    folded = _FOLD[data]
    ink = folded > 0
    first, last = ink.copy(), ink.copy()
    first[1:] &= ~ink[:-1]
    last[:-1] &= ~ink[1:]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    first[inner] = ink[inner]
    last[inner - 1] = ink[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = winnow.prefix_sums(folded)
    marks = [winnow.span_hash(sums, start, end)]
    marks += [winnow.span_hash(sums, start, np.minimum(start + k, end)) for k in STEMS]
    marks.append(winnow.mix(winnow.span_hash(sums, np.maximum(end - 4, start), end)))       # apart from stems
    return start, end, np.searchsorted(start, bounds).astype(np.int64), np.stack(marks)


def _slots(marks: np.ndarray) -> np.ndarray:
    return (marks & np.uint64(FEATURES - 1)).astype(np.int32)


# ------------------------------------------------------------------ forward-backward
def marginals(unary: np.ndarray, offsets: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(P(toxic) of each token, expected transition counts 2 x 2).

    ``unary`` is the toxic state's score against the clean one, ``trans`` the
    log transition scores. Before its first token a document is clean.
    """
    counts = np.diff(offsets)
    per_doc = -(-counts // SEGMENT)
    n = int(per_doc.sum())
    if not n:
        return np.zeros(0), np.zeros((2, 2))
    doc_first = np.cumsum(per_doc) - per_doc
    token_doc = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(unary)) - np.repeat(offsets[:-1], counts)
    seg, col = doc_first[token_doc] + within // SEGMENT, within % SEGMENT
    real = np.zeros((SEGMENT, n), dtype=bool)
    real[col, seg] = True
    e = np.ones((SEGMENT, n))
    e[col, seg] = np.exp(np.clip(unary, -30, 30))
    a = np.exp(trans)
    # the product of each segment's matrices
    p = np.zeros((2, 2, n))
    p[0, 0] = p[1, 1] = 1
    for t in range(SEGMENT):
        q = np.empty_like(p)
        for y in (0, 1):
            q[y, 0] = p[y, 0] * a[0, 0] + p[y, 1] * a[1, 0]
            q[y, 1] = (p[y, 0] * a[0, 1] + p[y, 1] * a[1, 1]) * e[t]
        q /= q.max(axis=(0, 1))
        p = np.where(real[t], q, p)
    # messages at segment borders, all documents at once
    into = np.zeros((2, n))
    into[0] = 1
    back = np.ones((2, n))
    for k in range(1, int(per_doc.max())):
        s = doc_first[per_doc > k] + k
        v = np.einsum("yn,yzn->zn", into[:, s - 1], p[:, :, s - 1])
        into[:, s] = v / v.max(axis=0)
    for k in range(int(per_doc.max()) - 2, -1, -1):
        s = doc_first[per_doc > k + 1] + k
        v = np.einsum("yzn,zn->yn", p[:, :, s + 1], back[:, s + 1])
        back[:, s] = v / v.max(axis=0)
    # inside the segments, as ratios toxic : clean
    before = np.empty((SEGMENT, n))
    r = into[1] / np.maximum(into[0], 1e-300)
    for t in range(SEGMENT):
        before[t] = r
        r = np.where(real[t], e[t] * (a[0, 1] + r * a[1, 1]) / (a[0, 0] + r * a[1, 0]), r)
    after = np.empty((SEGMENT, n))
    q = back[1] / np.maximum(back[0], 1e-300)
    for t in range(SEGMENT - 1, -1, -1):
        after[t] = q
        x = e[t] * q
        q = np.where(real[t], (a[1, 0] + a[1, 1] * x) / (a[0, 0] + a[0, 1] * x), q)
    x = e * after
    pair = np.stack([np.broadcast_to(a[0, 0], x.shape), a[0, 1] * x, before * a[1, 0], before * a[1, 1] * x])
    pair = pair / pair.sum(axis=0)
    toxic = (pair[1] + pair[3])[col, seg]
    return toxic, (pair * real).sum(axis=(1, 2)).reshape(2, 2)


# ------------------------------------------------------------------ model
def _summary(p: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per document: log-odds that any token is toxic (independent tokens), and log of the expected number plus one."""
    clean = np.concatenate(([0.0], np.cumsum(np.log1p(-np.minimum(p, 1 - 1e-9)))))
    many = np.concatenate(([0.0], np.cumsum(p)))
    none = clean[offsets[1:]] - clean[offsets[:-1]]
    some = np.log(np.maximum(-np.expm1(none), 1e-9)) - none
    return np.stack([np.clip(some, -20, 20), np.log1p(many[offsets[1:]] - many[offsets[:-1]])], axis=1)


@dataclass
class Field:
    weights: np.ndarray
    bias: float
    trans: np.ndarray
    calibration: np.ndarray     # of the two summaries, and a constant

    def tag(self, texts: list[bytes]) -> list[tuple[float, list[tuple[int, int, float]]]]:
        """(score, spans as code-point offsets with their marginal) of each UTF-8 text."""
        out = []
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        for i, j in spread(len(texts), sizes):
            data = np.frombuffer(b"".join(texts[i:j]), dtype=np.uint8)
            bounds = np.concatenate(([0], np.cumsum(sizes[i:j])))
            start, end, offsets, marks = tokenize(data, bounds)
            p, _ = marginals(self.weights[_slots(marks)].sum(axis=0) + self.bias, offsets, self.trans)
            score = 1 / (1 + np.exp(-(np.hstack([_summary(p, offsets), np.ones((j - i, 1))]) @ self.calibration)))
            spans: list[list[tuple[int, int, float]]] = [[] for _ in range(j - i)]
            hot = np.flatnonzero(p > 0.5)
            if len(hot):
                point = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                for k, d in zip(hot.tolist(), (np.searchsorted(offsets, hot, side="right") - 1).tolist(), strict=True):
                    base = point[bounds[d]]
                    spans[d].append((int(point[start[k]] - base), int(point[end[k]] - base), float(p[k])))
            out += zip(score.tolist(), spans, strict=True)
        return out


def telling_marks(sets: list[np.ndarray], toxic: np.ndarray, least: int = 3, least_share: float = 0.01, sure_share: float = 0.04, odds: float = 2.5) -> np.ndarray:
    """Words and stems that tell toxic documents from clean ones.

    ``sets`` has each document's distinct marks. Marks that are rare in clean
    documents (log-odds of ``odds`` or more) and found in ``sure_share`` of the
    toxic ones are taken at once. Then a greedy cover takes the mark found in
    most toxic documents that no chosen mark explains yet, as long as it
    explains ``least_share`` of them. Near copies, with the same five least marks, count
    once: what only they share tells nothing.
    """
    once = {(m[:5].tobytes(), bool(t)): k for k, (m, t) in enumerate(zip(sets, toxic, strict=True))}
    bad = [sets[k] for (_, t), k in once.items() if t]
    good = [sets[k] for (_, t), k in once.items() if not t]
    if not bad:
        return np.zeros(0, np.uint64)
    marks, n = np.unique(np.concatenate(bad), return_counts=True)
    marks, n = marks[n >= least], n[n >= least]
    clean, m = np.unique(np.concatenate([np.zeros(0, np.uint64), *good]), return_counts=True)
    at = np.minimum(np.searchsorted(clean, marks), max(0, len(clean) - 1))
    also = np.where(clean[at] == marks, m[at], 0) if len(clean) else np.zeros(len(marks))
    telling = (np.log((n + 0.5) / len(bad)) - np.log((also + 0.5) / max(1, len(good))) >= odds)
    strong, sure = marks[telling], marks[telling & (n >= max(least, len(bad) * sure_share))]
    left = [set(x[np.isin(x, strong)].tolist()) for x in bad if not np.isin(x, sure).any()]
    chosen: list[int] = sure.tolist()
    while True:
        support = Counter(w for words in left for w in words)
        if not support:
            break
        mark, hits = max(support.items(), key=lambda x: (x[1], x[0]))
        if hits < max(least, len(bad) * least_share):
            break
        chosen.append(mark)
        left = [words for words in left if mark not in words]
    return np.array(chosen, dtype=np.uint64)


def fit_field(texts: list[bytes], toxic: np.ndarray, rounds: int = ROUNDS, prior: float | None = None) -> Field:
    """Fit tags, then the document score, on labelled texts.

    ``prior`` is the share of toxic documents among all labelled ones; the
    score is moved from the sample's share to it.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    _, _, offsets, marks = tokenize(data, np.concatenate(([0], np.cumsum(sizes))))
    chosen = telling_marks([np.unique(marks[:-1, a:b]) for a, b in zip(offsets, offsets[1:], strict=False)], toxic)
    label = np.isin(marks[:-1], chosen).any(axis=0) & np.repeat(toxic, np.diff(offsets))
    previous = np.concatenate(([False], label[:-1]))
    previous[offsets[:-1][np.diff(offsets) > 0]] = False
    seen = np.bincount(previous.astype(np.int8) * 2 + label, minlength=4).reshape(2, 2)
    features = np.stack([_slots(m) for m in marks])
    del marks

    blocks = list(spread(len(texts), np.diff(offsets), 1 << 16))

    def by_feature(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(f, weights=x, minlength=FEATURES) for f in features)

    def tagged() -> tuple[np.ndarray, np.ndarray]:
        """Marginals and transition counts, some documents at a time."""
        p, pairs = np.zeros(len(label)), np.zeros((2, 2))
        for i, j in blocks:
            a, b = offsets[i], offsets[j]
            p[a:b], here = marginals(weights[features[:, a:b]].sum(axis=0) + bias, offsets[i:j + 1] - a, trans)
            pairs += here
        return p, pairs

    observed = by_feature(label)
    weights, bias, trans = np.zeros(FEATURES), -3.0, np.zeros((2, 2))
    pace_w, pace_b, pace_t = np.full(FEATURES, 1e-8), 1e-8, np.full((2, 2), 1e-8)
    for _ in range(rounds if len(label) else 0):
        p, pairs = tagged()
        slope = by_feature(p) - observed + 0.05 * weights
        pace_w += slope ** 2
        weights -= 0.7 * slope / np.sqrt(pace_w)
        slope_b = p.sum() - label.sum()
        pace_b += slope_b ** 2
        bias -= 0.7 * slope_b / np.sqrt(pace_b)
        slope_t = pairs - seen + 0.05 * trans
        pace_t += slope_t ** 2
        trans -= 0.3 * slope_t / np.sqrt(pace_t)
    p, _ = tagged()
    x = np.hstack([_summary(p, offsets), np.ones((len(texts), 1))])
    y = toxic.astype(float)
    calibration = np.zeros(3)
    for _ in range(25):                                         # Newton steps, lightly penalised
        q = 1 / (1 + np.exp(-x @ calibration))
        h = x.T @ (x * (q * (1 - q))[:, None]) + 0.1 * np.eye(3)
        calibration -= np.linalg.solve(h, x.T @ (q - y) + 0.1 * calibration)
    share = y.mean()
    if prior is not None and 0 < prior < 1 and 0 < share < 1:
        calibration[2] += np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    return Field(weights, float(bias), trans, calibration)


def fit(docs: DataFrame, labels: DataFrame, train: Column, sample: int = SAMPLE, most_bytes: int = SAMPLE_BYTES) -> Field:
    """Fit on at most ``sample`` labelled documents of each label, picked by a hash of the id.

    Rows without a label count for nothing; a document labelled both ways is
    toxic. An id counts once, with one of its texts; of a text longer than
    SAMPLE_CHARS a random segment stands for it. Each label has half of
    ``most_bytes``, filled in hash order; a text that doesn't fit is skipped.
    Without labelled texts nothing is found toxic.
    """
    known = (labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .filter(train).withColumn("pick", F.xxhash64(F.lit("toxicity"), "doc_id")))
    picked = known.filter("toxic = 1").orderBy("pick", "doc_id").limit(sample).unionByName(known.filter("toxic = 0").orderBy("pick", "doc_id").limit(sample))
    whole = F.col("text").cast("string")
    over = F.greatest(F.length(whole) - SAMPLE_CHARS, F.lit(0))
    begin = (F.pmod(F.xxhash64(F.lit("segment"), "doc_id"), over + 1) + 1).cast("int")
    texts = (docs.join(F.broadcast(picked), "doc_id").filter("text is not null")                    # 2 * sample ids
             .select("doc_id", "toxic", "pick", whole.substr(begin, F.lit(SAMPLE_CHARS)).alias("text"))
             .withColumn("one", F.struct(F.octet_length("text").alias("size"), F.xxhash64("text").alias("hash"))))
    sized = texts.groupBy("doc_id", "toxic", "pick").agg(F.min("one").alias("one")).select("doc_id", "toxic", "pick", "one.*").collect()
    room, ids = {1: most_bytes // 2, 0: most_bytes // 2}, []
    for r in sorted(sized, key=lambda r: (r["pick"], r["doc_id"])):
        if r["size"] <= room[r["toxic"]]:
            room[r["toxic"]] -= r["size"]
            ids.append((r["doc_id"], r["size"], r["hash"]))
    if not ids:
        return Field(np.zeros(FEATURES), -20.0, np.zeros((2, 2)), np.array([0.0, 0.0, -20.0]))
    chosen = docs.sparkSession.createDataFrame(ids, "doc_id long, size int, hash long")
    one = (texts.select("doc_id", "toxic", "pick", "text", "one.*").join(F.broadcast(chosen), ["doc_id", "size", "hash"])
           .groupBy("doc_id", "pick", "toxic").agg(F.first("text").alias("text")))                  # its equal rows
    rows = sorted(one.collect(), key=lambda r: (r["pick"], r["doc_id"]))
    prior = known.filter("toxic in (0, 1)").agg(F.avg("toxic")).first()[0]
    return fit_field([r["text"].encode() for r in rows], np.array([r["toxic"] == 1 for r in rows], dtype=bool), prior=prior)


def tag(text: Column, field: Field) -> Column:
    """Struct (score, spans); null text counts as empty."""
    @F.pandas_udf("score double, spans array<struct<start:int,end:int,marginal:double>>")
    def toxic(texts: pd.Series) -> pd.DataFrame:
        made = field.tag([t.encode() if isinstance(t, str) else b"" for t in texts])
        return pd.DataFrame({"score": [s for s, _ in made], "spans": [[{"start": a, "end": b, "marginal": m} for a, b, m in spans] for _, spans in made]})
    return toxic(text.cast("string"))


def score(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted, spans of every row; learns from labels that aren't held out.

    A null or empty text has the score of a text without a toxic mark and no
    span; a null id counts as empty text for the hold-out. Repeated rows are
    each scored; of rows that share an id one teaches. Without labelled texts
    every score is the same. Only doc_id and text are read; an empty table gives
    no rows.
    """
    ship(docs.sparkSession)
    field = fit(docs, labels, id_remainder(modulus) != held)
    return (docs.select("doc_id", (id_remainder(modulus) == held).alias("held_out"), tag(F.col("text"), field).alias("made"))
            .select("doc_id", "held_out", "made.score", (F.col("made.score") >= 0.5).cast("int").alias("predicted"), "made.spans"))
