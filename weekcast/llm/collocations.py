"""Phrase collocation mining by set-oriented (SETM) relations.

The relation of length k holds the occurrences of frequent k-word phrases,
sorted by piece and position. It is written as a table, one row for the
occurrences of about BLOCK_BYTES of text; positions count words and jump at the
end of a piece, so neighbours within a piece are one apart. For the next length

1. a merge-join of the relation with itself by piece and adjacent position gives
   the occurrences whose first and last k words are frequent;
2. a group-count: GROUP blocks of a task add up their phrases, Spark those sums;
3. a semi-join of the occurrences with the frequent groups, block by block, gives
   the next relation.

The frequent phrases of all lengths are then a table; cuts, scores, containment
and ranks are joins and aggregations over it. Words and phrases are told apart
by 64-bit hashes of language and words until then.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekcast.llm import winnow
from weekcast.llm.common import free, join_heavy, lean, save, ship, trim

LONGEST = 4
SUPPORT = 30
SCALE = 2_000_000
COVER = 80                      # percent of a phrase's occurrences inside a longer one from which it goes
TOP = 2000
BLOCK_BYTES = 8 << 20           # text for each row of a relation
GROUP = 8                       # rows of one task that count together and get one answer
PART_BYTES = 1 << 19            # longer texts are cut at a separator
BETWEEN = re.compile(rb"[.,;:!?\n-\r]")
SCHEMA = "grp long, keys binary, phrases binary, langs binary, names array<string>, f binary, own binary, at binary, pos binary"
NO_LANG = "und"

# fixed: 0 belongs to a word, 1 stands between words, 2 between pieces
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _pack(values: np.ndarray) -> bytes:
    """Compressed, byte by byte: the high bytes of small numbers are long runs of zeros."""
    size = values.dtype.itemsize
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, size).T).tobytes())


def _unpack(blob: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def cut(text: bytes, most: int = PART_BYTES) -> Iterator[bytes]:
    """The text in parts of at most ``most`` bytes that end at a separator; longer only where it has none."""
    a = 0
    while len(text) - a > most:
        b = max(text.rfind(c, a, a + most) for c in (b".", b",", b";", b":", b"!", b"?", b"\n", b"\x0b", b"\x0c", b"\r"))
        if b < a:
            found = BETWEEN.search(text, a + most)
            if found is None:
                break
            b = found.start()
        yield text[a:b]
        a = b + 1
    yield text[a:]


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash, piece) of the words of lower-cased bytes."""
    kind = _KIND[data]
    ink = kind == 0
    first, last = ink.copy(), ink.copy()
    first[1:] &= ~ink[:-1]
    last[:-1] &= ~ink[1:]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, winnow.span_hash(winnow.prefix_sums(data), start, end), np.cumsum(kind == 2)[start]


def _block(grp: int, held: list[tuple[bytes, str]]) -> pd.DataFrame:
    """All word occurrences of some texts as one row: the relation of length 1 before its semi-join."""
    keys, places, langs, spans = [], [], [], []
    number: dict[str, int] = {}
    place, i = 0, 0
    laid = []
    while i < len(held):
        j, size = i, 0
        while j < len(held) and (j == i or size + len(held[j][0]) <= PART_BYTES):
            size += len(held[j][0]) + 1
            j += 1
        joined = b"\n".join(t for t, _ in held[i:j])
        data = _LOWER[np.frombuffer(joined, np.uint8)] if joined else np.zeros(0, np.uint8)
        if len(data):
            start, end, hashes, piece = _words(data)
            text = np.searchsorted(np.cumsum([len(t) + 1 for t, _ in held[i:j]]), start, side="right")
            salt = np.array([xxhash.xxh3_64_intdigest(lang) for _, lang in held[i:j]], dtype=np.uint64)
            keys.append(winnow.mix(hashes + salt[text]))
            places.append(place + np.arange(len(start)) + piece)          # one more at each piece's end
            langs.append(np.array([number.setdefault(lang, len(number)) for _, lang in held[i:j]])[text])
            spans.append(np.stack([start, end]) + sum(map(len, laid)))
            laid.append(data)
            place = int(place + len(start) + piece[-1] + 1) if len(start) else place
        i = j
    if not keys:
        keys, places, langs, spans = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros((2, 0), np.int64)]
    distinct, where, at = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    raw = b"".join(d.tobytes() for d in laid)
    start, end = np.concatenate(spans, axis=1)[:, where]
    phrases = [raw[a:b].decode("utf-8", "replace") for a, b in zip(start.tolist(), end.tolist(), strict=True)]
    return _row(grp, distinct, phrases, np.concatenate(langs)[where], list(number), None, None, at, np.concatenate(places))


def _row(grp: int, keys, phrases: list[str], langs: np.ndarray, names: list[str], f, own, at, pos) -> pd.DataFrame:
    """A relation's row; entries in falling order of their occurrences, so frequent ones have small numbers."""
    order = np.argsort(-np.bincount(at, minlength=len(keys)), kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    text = zstandard.ZstdCompressor(level=3).compress("\n".join([phrases[i] for i in order.tolist()]).encode())       # no word holds a line feed
    return pd.DataFrame([{"grp": grp, "keys": _pack(keys[order].astype("<u8")), "phrases": text, "langs": _pack(langs[order].astype("<i4")), "names": names,
                          "f": None if f is None else _pack(f[order].astype("<i8")), "own": None if own is None else _pack(own[order].astype(np.uint8)),
                          "at": _pack(rank[at].astype("<i4")), "pos": _pack(np.diff(pos, prepend=0).astype("<i4"))}])


def _phrases(row) -> list[str]:
    text = zstandard.ZstdDecompressor().decompress(row.phrases).decode()
    return text.split("\n") if text else []


def occurrences(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held, size, made, grp = [], 0, 0, 0
    for frame in frames:
        for text, lang in zip(frame["text"], frame["lang"], strict=True):
            for part in cut(bytes(text)):
                held.append((part, lang))
                size += len(part) + 1
                if size >= BLOCK_BYTES:
                    grp = grp if made % GROUP else uuid.uuid4().int >> 65
                    yield _block(grp, held)
                    held, size, made = [], 0, made + 1
    if held:
        yield _block(grp if made % GROUP else uuid.uuid4().int >> 65, held)


def _joined(row, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge-join by piece and adjacent position: (key, left entry, right entry) of each distinct phrase, entry and position of each occurrence."""
    keys, at, pos = _unpack(row.keys, "<u8"), _unpack(row.at, "<i4").astype(np.int64), np.cumsum(_unpack(row.pos, "<i4"), dtype=np.int64)
    if length == 1:
        every = np.arange(len(keys))
        return keys, every, every, at, pos
    next_to = np.flatnonzero(pos[1:] == pos[:-1] + 1)
    m = max(len(keys), 1)
    codes, entry = np.unique(at[next_to] * m + at[next_to + 1], return_inverse=True)
    left, right = codes // m, codes % m
    key = winnow.mix(keys[left] * np.uint64(0x9E3779B97F4A7C15) + winnow.mix(keys[right] + np.uint64(length)))
    return key, left, right, entry, pos[next_to]


def _merged(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ascending distinct keys, their sums)."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n[order], first) if len(first) else n


RANGES = 16                     # parts of the key space that a group's counts are added up in, one after the other


def _group_counts(grp: int, held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pd.DataFrame]:
    place = [(key >> 60) & (RANGES - 1) for key, _ in held]
    for r in range(RANGES):
        picked = [np.flatnonzero(at == r) for at in place]
        key, n = _merged(np.concatenate([k[p] for (k, _), p in zip(held, picked, strict=True)]), np.concatenate([n[p] for (_, n), p in zip(held, picked, strict=True)]))
        if len(key):
            yield pd.DataFrame({"key": key, "grp": grp, "n": n.astype(np.int64)})


def _counts(length: int):
    """(key, grp, n): each group's phrases with their occurrences; a group that several tasks read has a row from each."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grp, held = None, []
        for frame in frames:
            for row in frame.itertuples(index=False):
                if row.grp != grp and held:
                    yield from _group_counts(grp, held)
                    held = []
                    trim()
                grp = row.grp
                found, _, _, entry, _ = _joined(row, length)
                held.append((found.view(np.int64), np.bincount(entry, minlength=len(found)).astype(np.int32)))
                del found, entry
        if held:
            yield from _group_counts(grp, held)
    return lean(run)


def _semi_join(length: int):
    """The group's occurrences of frequent phrases; of the group that is to name a phrase, the first row that has it does."""
    def run(relation: pd.DataFrame, frequent: pd.DataFrame) -> pd.DataFrame:
        found, first = np.unique(frequent["key"].to_numpy().astype(np.int64), return_index=True)
        f, names = frequent["f"].to_numpy()[first].astype(np.int64), frequent["own"].to_numpy()[first].astype(bool)
        named = np.zeros(len(found), dtype=bool)
        out = []
        for row in relation.itertuples(index=False):
            key, left, right, entry, pos = _joined(row, length)
            signed = key.view(np.int64)
            to = np.searchsorted(found, signed)
            hit = np.zeros(len(key), dtype=bool)
            inside = to < len(found)
            hit[inside] = found[to[inside]] == signed[inside]
            pick = np.flatnonzero(hit)
            reply = to[pick]
            every = _phrases(row)
            if length == 1:
                phrases = [every[i] for i in pick.tolist()]
            else:
                phrases = [f"{every[a]} {every[b].rsplit(' ', 1)[-1]}" for a, b in zip(left[pick].tolist(), right[pick].tolist(), strict=True)]
            number = np.cumsum(hit) - 1
            kept = np.flatnonzero(hit[entry])
            own = names[reply] & ~named[reply]
            named[reply] = True
            out.append(_row(row.grp, key[pick], phrases, _unpack(row.langs, "<i4")[left[pick]], list(row.names), f[reply], own, number[entry[kept]], pos[kept]))
        trim()
        return pd.concat(out) if out else pd.DataFrame(columns=[c.split()[0] for c in SCHEMA.split(", ")])
    return run


def _owned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The frequent phrases that this block is to name: (lang, phrase, f)."""
    for frame in frames:
        for row in frame.itertuples(index=False):
            mine = np.flatnonzero(_unpack(row.own, np.uint8))
            if len(mine):
                yield pd.DataFrame({"lang": np.asarray(row.names, dtype=object)[_unpack(row.langs, "<i4")[mine]], "phrase": np.asarray(_phrases(row), dtype=object)[mine],
                                    "f": _unpack(row.f, "<i8")[mine]})


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, support: int = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, k, f) of every phrase of at most ``longest`` words with f >= ``support``, (lang, n) word counts)."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"))
    relation = save(rows.mapInPandas(lean(occurrences), SCHEMA), "occurrences-1", compression="none")
    words = save(relation.mapInPandas(_lang_words, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n")), "words")
    of_key = Window.partitionBy("key")
    found = []
    for k in range(1, longest + 1):
        counts = relation.mapInPandas(_counts(k), "key long, grp long, n long")
        groups = (counts.withColumn("f", F.sum("n").over(of_key)).withColumn("owner", F.min("grp").over(of_key))        # a key has few rows for each group
                  .filter(F.col("f") >= support).select("grp", "key", "f", (F.col("owner") == F.col("grp")).alias("own")))
        groups = save(groups, f"groups-{k}")
        del counts
        free(spark)                                         # the counts go before the relation is shuffled
        before, relation = relation, save(relation.groupBy("grp").cogroup(groups.groupBy("grp")).applyInPandas(_semi_join(k), SCHEMA), f"relation-{k}", compression="none")
        found.append(save(relation.mapInPandas(lean(_owned), "lang string, phrase string, f long").withColumn("k", F.lit(k)), f"frequent-{k}"))
        free(spark, before, groups)
        del groups
    free(spark, relation)
    every = found[0]
    for level in found[1:]:
        every = every.unionByName(level)
    return every, words


def _lang_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for row in frame.itertuples(index=False):
            many = np.bincount(_unpack(row.langs, "<i4")[_unpack(row.at, "<i4")], minlength=len(row.names))
            yield pd.DataFrame({"lang": list(row.names), "n": many})


def mine(docs: DataFrame, longest: int = LONGEST, support: int = SUPPORT, cover: int = COVER, top: int = TOP) -> DataFrame:
    """Each language's ``top`` collocations: lang, rank, phrase, a, l, r, n, score.

    Candidates are phrases of 2 to ``longest`` words within a piece that occur
    ``support`` times or more. A cut into a first part (l times) and a rest (r
    times) scores floor(2000000 a / (l + r)); the lowest cut counts, of equal
    ones the first. A candidate goes if a longer one holds it in at least
    ``cover`` percent of a. Integers only; products are decimals of 38 digits.

    A null text counts as empty, a null lang as ``und``; repeated rows count
    each time; a table without candidates gives no row. Only text and lang are
    read.
    """
    frequent, words = frequent_phrases(docs, longest, support)
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    candidates = frequent.filter("k >= 2")
    split = candidates.select("lang", "phrase", F.col("f").alias("a"), "k", F.split("phrase", " ").alias("words"))

    # what the two parts of each cut occur: every part is frequent itself
    joined = lambda start, n: F.array_join(F.slice("words", start, n), " ")
    cuts = split.select("lang", "phrase", "a", "words", "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    parts = cuts.select("lang", "phrase", "a", "cut", F.explode(F.array(F.struct(F.lit(0).alias("rest"), joined(F.lit(1), F.col("cut")).alias("part")),
                                                                        F.struct(F.lit(1).alias("rest"), joined(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("part")))).alias("p"))
    parts = save(parts.select("lang", "phrase", "a", "cut", "p.rest", "p.part"), "parts")
    asked = parts.groupBy("lang", "part").agg(F.count("*").alias("asked"))
    side = save(asked.join(frequent.select("lang", F.col("phrase").alias("part"), "f"), ["lang", "part"]), "asked")
    known = join_heavy(parts, side, ["lang", "part"], "asked")
    both = known.groupBy("lang", "phrase", "a", "cut").agg(F.max(F.when(F.col("rest") == 0, F.col("f"))).alias("l"), F.max(F.when(F.col("rest") == 1, F.col("f"))).alias("r"))
    score = F.expr(f"(cast({SCALE} as decimal(10,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = (both.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
              .select("lang", "phrase", "a", "best.l", "best.r", "best.score"))

    # the most frequent longer candidate around each candidate
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("k") - n + 1), lambda i: F.array_join(F.slice("words", i, n), " "))))
    longer = split.filter("k >= 3").select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    covered = F.coalesce(wide("longer") * 100 >= wide("a") * cover, F.lit(False))
    left = scored.join(longer, ["lang", "phrase"], "left").filter(~covered)

    # first the best of each of 64 hashed parts of a language, then the best of those
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    left = left.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    few = left.withColumn("at", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))).filter(F.col("at") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
