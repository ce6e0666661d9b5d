"""Substring dedup on words, by seed and extend.

Documents meet on winnowed anchors: runs of ``SEED`` words. Occurrences of one
seed are extended word by word to the right and to the left; at each length
they carry the number of the class that they still match, so all pairs are
extended at once without being listed. A class pair (so far left, so far
right) that spans the threshold is a match; matched windows that overlap or
touch make up the maximal repeats. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from weekcast.llm import winnow
from weekcast.llm.passages import Entries, Method, remove_repeats

WINDOW = 50
SEED = 10


def _number(*keys: np.ndarray) -> np.ndarray:
    """Class numbers of equal key tuples."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), dtype=bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


class WordPassages(Method):
    window = WINDOW
    seed = SEED

    def units(self, data, bounds):
        start, end, offsets = winnow.words(data, bounds)
        return winnow.span_hash(winnow.prefix_sums(data), start, end), offsets, start, end

    def kept(self, text, start, end, keep):
        return b" ".join(text[a:b] for a, b in zip(start[keep].tolist(), end[keep].tolist(), strict=True))

    def message(self, units: np.ndarray, entries: Entries) -> bytes:
        at = np.repeat(entries.first - (np.cumsum(entries.size) - entries.size), entries.size) + np.arange(int(entries.size.sum()))
        head = np.concatenate([[len(entries.size)], entries.size, entries.anchor, entries.order]).astype("<i8")
        return head.tobytes() + units[at].astype("<u8").tobytes()

    def solve(self, messages: list[bytes]) -> list[np.ndarray]:
        sizes, anchors, orders, lines, counts = [], [], [], [], []
        for body in messages:
            m = int(np.frombuffer(body, "<i8", 1)[0])
            size, anchor, order = np.frombuffer(body, "<i8", 3 * m, offset=8).reshape(3, m)
            sizes.append(size)
            anchors.append(anchor)
            orders.append(order)
            lines.append(np.frombuffer(body, "<u8", offset=8 + 24 * m))
            counts.append(int((size - self.window + 1).sum()))
        flags = extend(np.concatenate(lines), np.concatenate(sizes), np.concatenate(anchors), np.concatenate(orders), self.window, self.seed)
        edges = np.cumsum([0, *counts])
        return [flags[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def extend(line: np.ndarray, size: np.ndarray, anchor: np.ndarray, order: np.ndarray, window: int, seed: int) -> np.ndarray:
    """Flags, entry by entry, the windows that a document of smaller order shares."""
    n = len(size)
    first = np.cumsum(size) - size
    run = size - window + 1
    flag_at = np.concatenate(([0], np.cumsum(run)))
    flags = np.zeros(int(flag_at[-1]), dtype=bool)
    if not n:
        return flags
    place = first + anchor
    seeds = winnow.span_hash(winnow.prefix_sums(line), place, place + seed)
    same = _number(seeds)
    rest = window - seed

    def grow(next_word: np.ndarray, room: np.ndarray, step: int) -> list[np.ndarray]:
        """Class of each entry at every extension length; -1 where its surroundings end."""
        classes = [same]
        for length in range(rest):
            now = np.full(n, -1, dtype=np.int64)
            can = np.flatnonzero(room > length)
            if len(can):
                now[can] = _number(line[next_word[can] + step * length], classes[-1][can])
            classes.append(now)
        return classes

    right = grow(place + seed, size - anchor - seed, 1)
    left = grow(place - 1, anchor, -1)
    for back in range(rest + 1):
        at = anchor - back                                  # the window's place among the entry's windows
        here = np.flatnonzero((at >= 0) & (at < run))
        if not len(here):
            continue
        group = _number(left[back][here], right[rest - back][here])
        least = np.full(int(group.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, group, order[here])
        flags[flag_at[here] + at[here]] = least[group] < order[here]
    return flags


def deduplicate(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Words left of each text without 50-word windows that also start in a smaller document (see ``passages``)."""
    return remove_repeats(docs, WordPassages(), carry)
