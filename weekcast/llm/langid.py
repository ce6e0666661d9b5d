"""Language identification with string kernels.

The kernel of two texts counts the byte n-grams (n = 1..3, the blended
spectrum, presence only) that both hold, normalised by their gram numbers.
A Nyström map over landmark texts turns it into a short feature vector, and
one kernel ridge regressor per language (one against the rest) is fitted on
it. Scoring is a product of a block of presence rows with the landmarks'
presence matrix, then with the fitted weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekcast.llm.common import id_remainder, ship, trim

LANDMARKS = 128             # landmark texts, shared out among the languages
SAMPLE = 4000               # texts that the regressors are fitted on, shared out likewise
RIDGE = 1e-3
BLOCK_DOCS, BLOCK_BYTES = 64, 1 << 19
CLAIM_QUANTILE, CLAIM_SHARE = 0.01, 0.25    # a claim of less than this share of the sampled texts' low quantile is none
UND = "und"
CODES = 256 + (1 << 16) + (1 << 24)
_FOLD = np.full(256, 0x20, dtype=np.uint8)      # what isn't a letter byte is a space
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def has_letter(text: str | None) -> bool:
    return isinstance(text, str) and any(map(str.isalpha, text))


def grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the 1-, 2- and 3-grams that begin at each byte."""
    b = data.astype(np.int32)
    two = (b[:-1] << 8) | b[1:]
    return b, two + 256, ((two[:-1] << 8) | b[2:]) + 256 + (1 << 16)


def folded(text: str) -> np.ndarray:
    return _FOLD[np.frombuffer(text.lower().encode(), dtype=np.uint8)]


def distinct_grams(text: str) -> np.ndarray:
    return np.unique(np.concatenate(grams(folded(text))))


@dataclass
class Model:
    """Landmark grams and fitted weights; no text."""

    languages: list[str]
    codes: np.ndarray           # gram codes that landmarks share, ascending
    presence: np.ndarray        # grams x landmarks
    sizes: np.ndarray           # grams of each landmark
    weights: np.ndarray         # landmarks + 1 x languages
    floors: np.ndarray          # least claim of each language's own texts

    def kernel(self, texts: list[str]) -> np.ndarray:
        """Normalised kernel of each text with each landmark."""
        column = self._columns()
        out = np.zeros((len(texts), self.presence.shape[1]), dtype=np.float32)
        i = 0
        while i < len(texts):
            j, size, parts = i, 0, []
            while j < len(texts) and j - i < BLOCK_DOCS and (not parts or size < BLOCK_BYTES):
                parts.append(folded(texts[j]))
                size += len(parts[-1])
                j += 1
            data = np.zeros(size + 3 * len(parts), dtype=np.uint8)      # a zero byte is in no landmark's gram
            owner = np.repeat(np.arange(len(parts)), [len(p) + 3 for p in parts])
            at = 0
            for p in parts:
                data[at:at + len(p)] = p
                at += len(p) + 3
            rows = np.zeros((len(parts), len(self.codes)), dtype=np.float32)
            for codes in grams(data):
                hit = column[codes]
                known = hit >= 0
                rows[owner[:len(codes)][known], hit[known]] = 1
            out[i:j] = rows @ self.presence / np.sqrt(np.maximum(1, rows.sum(axis=1))[:, None] * np.maximum(1, self.sizes))
            i = j
        return out

    def _columns(self) -> np.ndarray:
        if not hasattr(self, "_lookup"):
            self._lookup = np.full(CODES, -1, dtype=np.int16 if len(self.codes) <= np.iinfo(np.int16).max else np.int32)
            self._lookup[self.codes] = np.arange(len(self.codes))
        return self._lookup

    def claim(self, text: str) -> float:
        """Share of the visible bytes that are letters amid a 3-gram that landmarks share; 0 for an unknown script."""
        data = folded(f" {text} ")
        visible = sum(len(word.encode()) for word in text.lower().split())
        known = self._columns()[grams(data)[2]] >= 0
        return float((known & (data[1:-1] != 0x20)).sum()) / max(1, visible)

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(language number, score from 0 to 1) of each text."""
        kernel = self.kernel(texts)
        value = kernel @ self.weights[:-1] + self.weights[-1]
        best = value.argmax(axis=1)
        return best, np.clip((value[np.arange(len(texts)), best] + 1) / 2, 0, 1)


def _share(rows: DataFrame, counts: dict[str, int], total: int, salt: str) -> DataFrame:
    """About ``total`` rows, as many for each language (all of a rare one), picked by a hash of id and text; rows equal in both count once."""
    each = max(1, total // max(1, len(counts)))
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, each / n))])
    place = F.pmod(F.xxhash64(F.lit(salt), "doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    return rows.filter(place < share[F.col("lang")]).dropDuplicates(["doc_id", "text"])


def fit(labelled: DataFrame, landmarks: int = LANDMARKS, sample: int = SAMPLE, ridge: float = RIDGE) -> Model | None:
    """Fit on a bounded sample of rows (doc_id, text, lang); None where no row has a language and a letter.

    Both samples take about the same number of texts of each language. Tasks
    turn the sampled texts into gram sets and kernel rows; the driver gets
    those only: about ``landmarks`` sets and ``sample`` rows.
    """
    spark = labelled.sparkSession
    ship(spark)
    rows = labelled.filter("lang is not null and text is not null").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None

    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame = frame[frame["text"].map(has_letter)]
            yield pd.DataFrame({"codes": [distinct_grams(t).astype("<i4").tobytes() for t in frame["text"]]})

    chosen = sorted(r.codes for r in _share(rows, counts, landmarks, "landmark").mapInPandas(sets, "codes binary").collect())
    if not chosen:
        return None
    held = [np.frombuffer(c, "<i4") for c in chosen]
    codes, times = np.unique(np.concatenate(held), return_counts=True)
    codes = codes[(times > 1) | (len(held) == 1)]
    presence = np.array([np.isin(codes, h, assume_unique=True) for h in held], dtype=np.float32).T.copy()
    languages = sorted(counts)
    model = Model(languages, codes, presence, presence.sum(axis=0), np.zeros((len(held) + 1, len(languages)), dtype=np.float32), np.zeros(len(languages)))
    number = {lang: k for k, lang in enumerate(languages)}

    def kernels(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame = frame[frame["text"].map(has_letter)]
            k = model.kernel(list(frame["text"]))
            yield pd.DataFrame({"lang": [number[x] for x in frame["lang"]], "row": [r.astype("<f4").tobytes() for r in k], "claim": [model.claim(t) for t in frame["text"]]})

    fitted = _share(rows, counts, sample, "sample").mapInPandas(kernels, "lang int, row binary, claim double").toPandas()
    fitted = fitted.sort_values(["lang", "row"], ignore_index=True)
    if not len(fitted):
        return None
    x = np.array([np.frombuffer(r, "<f4") for r in fitted["row"]], dtype=np.float64)
    y = np.where(fitted["lang"].to_numpy()[:, None] == np.arange(len(languages)), 1.0, -1.0)
    for lang, claims in fitted.groupby("lang")["claim"]:
        model.floors[lang] = CLAIM_SHARE * claims.quantile(CLAIM_QUANTILE)
    norm = np.sqrt(np.maximum(1, model.sizes))
    values, vectors = np.linalg.eigh((presence.T @ presence / norm[:, None] / norm).astype(np.float64))
    good = values > 1e-6 * values.max()
    nystrom = vectors[:, good] / np.sqrt(values[good])          # K_nm times this is the feature map
    z = np.hstack([x @ nystrom, np.ones((len(x), 1))])
    each = 1 / np.maximum(1, (y > 0).sum(axis=0))[fitted["lang"]]   # languages weigh the same
    gram = z.T @ (z * each[:, None]) + ridge * np.diag([*np.ones(z.shape[1] - 1), 0])
    w = np.linalg.solve(gram + 1e-9 * np.eye(len(gram)), z.T @ (y * each[:, None]))
    model.weights = np.vstack([nystrom @ w[:-1], w[-1:]]).astype(np.float32)
    return model


def identify(text: Column, model: Model | None) -> Column:
    """Struct (lang_pred, score); ``und`` with score 0 for null, for texts without a letter, and without a model."""
    @F.pandas_udf("lang_pred string, score double")
    def language(texts: pd.Series) -> pd.DataFrame:
        good = np.array([model is not None and has_letter(t) for t in texts], dtype=bool)
        lang = np.full(len(texts), UND, dtype=object)
        score = np.zeros(len(texts))
        if good.any():
            best, score[good] = model.predict([t for t, g in zip(texts, good, strict=True) if g])
            lang[good] = np.array(model.languages, dtype=object)[best]
        trim()
        return pd.DataFrame({"lang_pred": lang, "score": score})
    return language(text.cast("string"))


def claimed(text: Column, model: Model | None) -> Column:
    """Struct (lang_pred, score, claimed): ``claimed`` if the text's claim reaches the floor of its language.

    Scores can't tell this: the languages' values always sum to 2 - L, so the
    best of L scores is 1 / L or more for any text.
    """
    @F.pandas_udf("lang_pred string, score double, claimed boolean")
    def language(texts: pd.Series) -> pd.DataFrame:
        good = np.array([model is not None and has_letter(t) for t in texts], dtype=bool)
        lang = np.full(len(texts), UND, dtype=object)
        score, sure = np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
        if good.any():
            some = [t for t, g in zip(texts, good, strict=True) if g]
            best, score[good] = model.predict(some)
            lang[good] = np.array(model.languages, dtype=object)[best]
            sure[good] = np.array([model.claim(t) for t in some]) >= model.floors[best]
        trim()
        return pd.DataFrame({"lang_pred": lang, "score": score, "claimed": sure})
    return language(text.cast("string"))


def predict(docs: DataFrame, modulus: int = 3, held: int = 1) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learns from the rows that aren't held out.

    A null text and one without a letter is ``und`` with score 0, and so is every
    text where no row to learn from has a language and a letter. A null id counts
    as empty text for the hold-out. Repeated rows are each answered. Only doc_id,
    text and lang are read; an empty table gives no rows.
    """
    remainder = id_remainder(modulus)
    model = fit(docs.filter(remainder != held))
    return (docs.select("doc_id", (remainder == held).alias("held_out"), identify(F.col("text"), model).alias("made"))
            .select("doc_id", "held_out", "made.lang_pred", "made.score"))
