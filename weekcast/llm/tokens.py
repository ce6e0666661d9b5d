"""Byte-level BPE ids of many texts at once.

The split into pre-tokens (runs of letters, digits, other signs and white
space, each with one leading space, and the seven contractions) is done on
whole arrays of code points. Each distinct pre-token is encoded once per
worker, by the public vocabulary's ranks, and its ids are copied to all its
places. A text is cut at the vocabulary's added tokens (special ones too)
before anything else, and those get their own ids.
"""

from __future__ import annotations

import base64
import json
import re
import unicodedata
from functools import cache

import numpy as np
import tiktoken

from weekcast.llm import winnow
from weekcast.llm.common import spread

OTHER, LETTER, DIGIT, SPACE = 0, 1, 2, 3
# Code points of Unicode's White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# The vocabulary's contractions.
CONTRACTIONS = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d"]
CACHE_LIMIT = 300_000


@cache
def classes() -> np.ndarray:
    """Class of every code point."""
    table = np.zeros(0x110000, dtype=np.uint8)
    kind = {"L": LETTER, "N": DIGIT}
    table[:] = [kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)]
    table[WHITE_SPACE] = SPACE
    return table


def pretoken_starts(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Mask of the code points that begin a pre-token; documents are points[bounds[i]:bounds[i+1]]."""
    n = len(points)
    kind = classes()[points]
    begin = np.zeros(n + 1, dtype=bool)
    begin[bounds] = True
    run = begin[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    start = np.append(run, True)
    # the last white-space sign before other text stands alone, or leads that text if it is a space
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~begin[1:n]) if n > 1 else np.zeros(0, np.int64)
    start[last] = True
    start[last[points[last] == 0x20] + 1] = False
    quotes = np.flatnonzero((points == 0x27) & start[:n] & run)
    if len(quotes):
        padded = np.append(points, [0, 0, 0])
        place = np.append(begin, [True, True, True])
        for ending in CONTRACTIONS:
            size = len(ending)
            fits = np.ones(len(quotes), dtype=bool)
            for k in range(1, size):
                fits &= (padded[quotes + k] == ord(ending[k])) & ~place[quotes + k]
            at = quotes[fits]
            for k in range(1, size):
                start[at + k] = False
            start[at + size] = True
    return start[:n]


def added_tokens(tokenizer_json: bytes) -> dict[str, int]:
    """String and id of each added token of a ``tokenizers`` file."""
    listed = json.loads(tokenizer_json)["added_tokens"]
    if any(t[flag] for t in listed for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens that take white space or whole words only aren't supported")
    return {t["content"]: t["id"] for t in listed}


class Encoder:
    """Ids of texts, with each distinct pre-token encoded once (forgotten when the cache is full).

    ``added`` has the strings that are tokens of their own wherever they
    stand; without it every text is ordinary.
    """

    def __init__(self, ranks_text: bytes, added: dict[str, int] | None = None):
        self.added = {t: np.array([i], dtype="<u4") for t, i in (added or {}).items()}
        self.marker = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_text.splitlines())}
        self.encode = tiktoken.Encoding("bytes", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_ordinary
        self.reset()

    def reset(self) -> None:
        self.known: dict[int, int] = {}
        self.pieces: list[np.ndarray] = []

    def many(self, texts: list[str]) -> list[np.ndarray]:
        marked = [k for k, t in enumerate(texts) if any(a in t for a in self.added)]
        if not marked:
            return self._plain(texts)
        parts = {k: self.marker.split(texts[k]) for k in marked}        # every second part is an added token
        plain = iter(self._plain([p for k, t in enumerate(texts) for p in (parts[k][::2] if k in parts else [t])]))
        return [np.concatenate([self.added[p] if x % 2 else next(plain) for x, p in enumerate(parts[k])]) if k in parts else next(plain)
                for k in range(len(texts))]

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        for i, j in spread(len(texts), sizes, 1 << 20):
            out += self._block(texts[i:j], sizes[i:j])
        return out

    def _block(self, texts: list[str], sizes: np.ndarray) -> list[np.ndarray]:
        joined = "".join(texts)
        if not joined:
            return [np.zeros(0, "<u4") for _ in texts]
        points = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        start = np.flatnonzero(pretoken_starts(points, bounds))
        end = np.append(start[1:], len(points))
        key = winnow.span_hash(winnow.prefix_sums(points), start, end)
        distinct, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        if len(self.pieces) > CACHE_LIMIT:
            self.reset()
        where = np.empty(len(distinct), dtype=np.int64)
        known, pieces, encode = self.known, self.pieces, self.encode
        for k, (h, a, b) in enumerate(zip(distinct.tolist(), start[first].tolist(), end[first].tolist(), strict=True)):
            at = known.get(h)
            if at is None:
                at = known[h] = len(pieces)
                pieces.append(np.array(encode(joined[a:b]), dtype="<u4"))
            where[k] = at
        each = [pieces[w] for w in where]
        lengths = np.array([len(p) for p in each], dtype=np.int64)
        flat = np.concatenate(each)
        base = (np.cumsum(lengths) - lengths)[inverse]
        many = lengths[inverse]
        ends = np.cumsum(many)
        ids = flat[np.repeat(base - (ends - many), many) + np.arange(ends[-1])]
        cuts = np.append(0, ends)[np.searchsorted(start, bounds)]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
