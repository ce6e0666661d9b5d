"""Suffix-array dedup: byte passages, by merging shards' Burrows-Wheeler transforms.

Each shard sorts the suffixes of its own strings and sends their
Burrows-Wheeler transform. A bucket merges the shards' transforms without
sorting suffixes again: the interleave starts with the shards one after the
other, and each round refines it by one symbol, as a stable distribution by the
symbol before each suffix (the last-to-first mapping keeps each shard's own
order). A border that opens in round d says that its neighbours have d - 1
symbols in common; after as many rounds as a window has bytes, the rows between
two borders are a repeated interval. Only suffixes from which a window's start
is still to be reached take part, equal strings of several shards are walked
once, and intervals of one document drop out early. A bucket's strings are
merged in four parts, one after the other, by the hash of their anchors.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from weekcast.llm.passages import PARTS, Entries, Method, remove_repeats

WINDOW = 50
SEED = 26
PRUNE_FROM, PRUNE_EVERY = 16, 8


def transform(strings: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Burrows-Wheeler transform of strings laid end to end, each closed by a least symbol 0.

    Symbols are bytes plus one. The closing rows come first, in string order;
    equal suffixes keep string order. Suffixes are sorted by prefix doubling.
    """
    m = len(size)
    ends = np.cumsum(size + 1) - 1
    line = np.zeros(int(ends[-1]) + 1 if m else 0, dtype=np.uint8)
    inside = np.ones(len(line), dtype=bool)
    inside[ends] = False
    line[inside] = strings + 1
    n = len(line)
    left = (np.repeat(ends, size + 1) - np.arange(n)).astype(np.int32)          # symbols up to the closing one
    padded = np.append(line, np.zeros(8, np.uint8)).astype(np.uint64)
    word = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | np.where(left > k, padded[k:n + k], np.uint64(0))
    order = np.argsort(word, kind="stable")
    key = word[order]
    head = np.ones(n, dtype=bool)                           # differs from the suffix before, as far as compared
    head[1:] = key[1:] != key[:-1]
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.cumsum(head)
    width, longest = 8, int(size.max(initial=0)) + 1
    while width < longest:
        tied = ~head
        tied[:-1] |= ~head[1:]
        place = np.flatnonzero(tied)                        # only suffixes that equal a neighbour are sorted on
        if not len(place):
            break
        at = order[place]
        after = np.where(left[at] >= width, rank[np.minimum(at + width, n - 1)], 0)
        key = (rank[at] << 32) | after
        again = np.argsort(key, kind="stable")
        order[place], key = at[again], key[again]
        head[place[1:]] |= key[1:] != key[:-1]
        rank[order] = np.cumsum(head)
        width *= 2
    before = np.append(line[-1:], line[:-1])
    before[np.concatenate(([0], ends[:-1] + 1))] = 0
    return before[order]


def last_to_first(bwt: np.ndarray) -> np.ndarray:
    """Row of the suffix one symbol longer, for every row."""
    out = np.empty(len(bwt), dtype=np.int32)
    out[np.argsort(bwt, kind="stable")] = np.arange(len(bwt), dtype=np.int32)
    return out


def rows_of(bwt: np.ndarray, step: np.ndarray, closing: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Walk strings backwards from their closing rows: (sizes, strings alive, their rows) by distance from the end."""
    size = np.zeros(len(closing), dtype=np.int64)
    alive, row = np.arange(len(closing), dtype=np.int32), closing.astype(np.int32)
    names, rows = [alive], [row]
    while True:
        going = bwt[row] > 0
        alive, row = alive[going], step[row[going]]
        if not len(alive):
            return size, names, rows
        size[alive] += 1
        names.append(alive)
        rows.append(row)


class BytePassages(Method):
    window = WINDOW
    seed = SEED

    def units(self, data, bounds):
        at = np.arange(len(data) + 1, dtype=np.int32 if len(data) < 1 << 31 else np.int64)
        return data, bounds, at[:-1], at[1:]

    def kept(self, text, start, end, keep):
        return text if keep.all() else np.frombuffer(text, np.uint8)[keep].tobytes()

    def message(self, units: np.ndarray, entries: Entries) -> bytes:
        total = int(entries.size.sum())
        at = np.repeat(entries.first - (np.cumsum(entries.size) - entries.size), entries.size) + np.arange(total)
        bwt = transform(units[at], entries.size)
        head = np.concatenate([[len(entries.size)], entries.order, entries.content.astype(np.int64)]).astype("<i8")
        return head.tobytes() + entries.part.tobytes() + bwt.tobytes()

    def solve(self, messages: list[bytes]) -> list[np.ndarray]:
        heads = [np.frombuffer(body, "<i8", 2 * int(np.frombuffer(body, "<i8", 1)[0]), offset=8).reshape(2, -1) for body in messages]
        part = np.concatenate([np.frombuffer(body, np.uint8, head.shape[1], offset=8 + head.nbytes) for body, head in zip(messages, heads, strict=True)])
        bwts = [np.frombuffer(body, np.uint8, offset=8 + head.nbytes + head.shape[1]) for body, head in zip(messages, heads, strict=True)]
        base = np.cumsum([0, *map(len, bwts)])
        order, content = np.concatenate(heads, axis=1)
        closing = np.concatenate([b + np.arange(head.shape[1]) for b, head in zip(base, heads, strict=False)])
        step = np.empty(int(base[-1]), dtype=np.int32)
        for bwt, b in zip(bwts, base.tolist(), strict=False):
            np.add(last_to_first(bwt), np.int32(b), out=step[b:b + len(bwt)])
        bwt = np.concatenate(bwts)
        # equal strings are walked once, under their least document
        by = np.lexsort((order, content, part))
        new = np.concatenate(([True], (content[by][1:] != content[by][:-1]) | (part[by][1:] != part[by][:-1])))
        own = by[new]
        like = np.empty(len(by), dtype=np.int64)
        like[by] = np.cumsum(new) - 1
        # ``own`` is in the order of the parts: each is walked and merged by itself
        bounds = np.searchsorted(part[own], np.arange(PARTS + 1))
        runs, flags = zip(*(self._part(bwt, step, closing[own[a:b]], order[own[a:b]]) for a, b in zip(bounds, bounds[1:], strict=False) if a < b), strict=True)
        run, flags = np.concatenate(runs), np.concatenate(flags)
        first = np.cumsum(run) - run
        many = run[like]
        ends = np.cumsum(many)
        all_flags = flags[np.repeat(first[like] - (ends - many), many) + np.arange(int(ends[-1]))] | np.repeat(order > order[own][like], many)
        edges = np.concatenate(([0], ends))[np.cumsum([0, *(head.shape[1] for head in heads)])]
        return [all_flags[a:b] for a, b in zip(edges, edges[1:], strict=False)]

    def _part(self, bwt: np.ndarray, step: np.ndarray, closing: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(windows of each string, flags of all windows) of some distinct strings."""
        size, names, rows = rows_of(bwt, step, closing)
        run = size - self.window + 1
        first = np.concatenate(([0], np.cumsum(run)))
        # before the first round, window j stands at the suffix that begins right after it
        start = np.empty(int(first[-1]), dtype=np.int32)
        for back, (name, row) in enumerate(zip(names, rows, strict=True)):
            j = size[name] - back - self.window
            fits = j >= 0
            start[first[name[fits]] + j[fits]] = row[fits]
        del names, rows
        return run, merge(bwt, step, start, np.repeat(order, run), self.window)


def merge(bwt: np.ndarray, step: np.ndarray, row: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Refine the interleave ``depth`` times; flags the windows that a document of smaller order shares.

    ``bwt`` and ``step`` hold all shards' rows one shard after the other,
    ``row`` each window's row to begin with, ``order`` its document.
    """
    flags = np.zeros(len(row), dtype=bool)
    item = np.argsort(row, kind="stable").astype(np.int32)  # shard after shard, each in its own order
    row = row[item]
    border = np.zeros(len(row), dtype=bool)                 # True: differs from the row above
    for d in range(1, depth + 1):
        symbol = bwt[row]
        move = np.argsort(symbol, kind="stable")
        block = np.cumsum(border, dtype=np.int32)[move]
        symbol, row, item = symbol[move], step[row[move]], item[move]
        border = np.zeros(len(row), dtype=bool)
        border[1:] = (block[1:] != block[:-1]) | (symbol[1:] != symbol[:-1])    # common prefix of d - 1 at a new border
        if d == depth or (d >= PRUNE_FROM and d % PRUNE_EVERY == 0):
            if not len(row):
                break
            head = border.copy()
            head[0] = True
            first = np.flatnonzero(head)
            documents = order[item]
            least, most = np.minimum.reduceat(documents, first), np.maximum.reduceat(documents, first)
            many = np.diff(np.append(first, len(row)))
            if d == depth:
                flags[item] = np.repeat(least, many) < documents
            else:
                keep = np.repeat(least != most, many)
                row, item, border = row[keep], item[keep], head[keep]
    return flags


def deduplicate(docs: DataFrame, carry: list[str] | None = None, characters: bool = False) -> DataFrame:
    """Texts without the bytes of 50-byte strings that also start in a smaller document (see ``passages``); whole ``characters`` only, if asked."""
    return remove_repeats(docs, BytePassages(), carry, characters=characters)
