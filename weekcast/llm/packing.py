"""Best-fit packing of token pieces into sequences, improved by swap-based local search.

Pieces are dealt into groups of bounded size. A group is packed best-fit,
longest first; then documents are moved or exchanged (one for one, two for
one) between underfull bins, each step raising the sum of squared fills, until
no step helps or bins empty. The underfull bins are dealt whole, by a salted
hash, into a next round of groups; their number follows the measured number of
pieces still open, so every round's groups have about the same size. Rounds end
when all is in one group, when no bin could be spared any more, or when rounds
free hardly any bins.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekcast.llm import tokens
from weekcast.llm.common import LAST, lean, order_key, save, ship

CAPACITY = 1024
END_ID = 2
GROUP_PIECES = 20_000
LEAST_FREED, IDLE_ROUNDS = 0.01, 2     # so many rounds in a row that free less than this share of the open bins are the last
LEVELS = 32                 # rounds that a sequence number has room for
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(docs: DataFrame, ranks: bytes, capacity: int = CAPACITY, end_id: int = END_ID, added: dict[str, int] | None = None) -> DataFrame:
    """Pieces of every document: its ids and then ``end_id``; null text counts as empty.

    ``added`` has the vocabulary's added tokens; without it their strings are ordinary text.
    A null doc_id is held as the largest long until ``pack`` gives it back.

    Only a document of more than ``capacity`` ids is cut; its first piece takes the remainder.
    """
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(ranks)      # one vocabulary file
    tail = np.array([end_id], dtype="<u4")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = tokens.Encoder(held.value, added)
        for frame in frames:
            rows = []
            texts = [t if isinstance(t, str) else "" for t in frame["text"]]
            for doc, ids in zip(frame["doc_id"], encoder.many(texts), strict=True):
                ids = np.append(ids, tail).astype("<u4")
                first = len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
                rows += [(doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(order_key().cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(lean(run), PIECE_SCHEMA)


# ------------------------------------------------------------------ one group
def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each piece goes to the fullest bin that still takes it."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0                                      # bit r: some bin has r free
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        size = lengths[i]
        fits = open_rooms >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                open_rooms ^= 1 << r
        else:
            r, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if r > size:
            room[r - size].append(b)
            open_rooms |= 1 << (r - size)
    return bins


class _Search:
    """Underfull bins with indexes of what a bin could give: free room plus one piece, or plus two."""

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int):
        self.bins, self.lengths, self.capacity = bins, lengths, capacity
        self.fill = [sum(lengths[i] for i in b) for b in bins]
        self.rooms: list[set[int]] = [set() for _ in range(capacity + 1)]
        self.offers: list[dict[int, dict[tuple[int, int, int], None]]] = [{} for _ in range(capacity + 1)]
        self.mine: list[list[tuple[int, int, tuple[int, int, int]]]] = [[] for _ in bins]
        self.room_bits = self.offer_bits = 0

    def add(self, b: int) -> None:
        free = self.capacity - self.fill[b]
        if not free or not self.bins[b]:
            return
        self.rooms[free].add(b)
        self.room_bits |= 1 << free
        content = self.bins[b]
        for x, i in enumerate(content):
            self._offer(b, free, i, -1)
            for j in content[x + 1:]:
                self._offer(b, free, i, j)

    def _offer(self, b: int, free: int, i: int, j: int) -> None:
        back = self.lengths[i] + (self.lengths[j] if j >= 0 else 0)
        reach = free + back
        if reach <= self.capacity:
            self.offers[reach].setdefault(back, {})[(b, i, j)] = None
            self.offer_bits |= 1 << reach
            self.mine[b].append((reach, back, (b, i, j)))

    def drop(self, b: int) -> None:
        free = self.capacity - self.fill[b]
        self.rooms[free].discard(b)
        if not self.rooms[free]:
            self.room_bits &= ~(1 << free)
        for reach, back, key in self.mine[b]:
            level = self.offers[reach]
            level[back].pop(key)
            if not level[back]:
                del level[back]
                if not level:
                    self.offer_bits &= ~(1 << reach)
        self.mine[b] = []

    def place(self, x: int, source: int) -> bool:
        """Move or exchange piece ``x`` of bin ``source`` (out of the indexes); True if squared fill rose.

        With piece i (or two pieces) coming back, bin b is filled up to
        capacity - (reach - size); that beats the source's fill only for the
        lower reaches, which are tried first.
        """
        size, fill = self.lengths[x], self.fill
        fits = self.room_bits >> size
        if fits:                                        # a move to the fullest bin that takes it
            b = next(iter(self.rooms[size + (fits & -fits).bit_length() - 1]))
            if fill[b] + size > fill[source]:
                self._change(source, b, [x], [])
                return True
        gain = self.capacity - fill[source]
        bits = (self.offer_bits >> size) & ((1 << gain) - 1)
        while bits:
            reach = size + (bits & -bits).bit_length() - 1
            back = min(self.offers[reach])
            if back < size:
                b, i, j = next(iter(self.offers[reach][back]))
                self._change(source, b, [x], [i] if j < 0 else [i, j])
                return True
            bits &= bits - 1
        return False

    def _change(self, source: int, b: int, out: list[int], back: list[int]) -> None:
        self.drop(b)
        gone = set(out) | set(back)
        moved = sum(self.lengths[i] for i in out) - sum(self.lengths[i] for i in back)
        self.bins[source] = [i for i in self.bins[source] if i not in gone] + back
        self.bins[b] = [i for i in self.bins[b] if i not in gone] + out
        self.fill[source] -= moved
        self.fill[b] += moved
        self.add(b)


def pack_group(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of piece numbers: best fit, then local search from the emptiest bin upwards."""
    bins = best_fit(lengths, capacity)
    state = _Search(bins, lengths, capacity)
    for b in range(len(bins)):
        state.add(b)
    for source in sorted(range(len(bins)), key=lambda b: state.fill[b]):
        if state.fill[source] == capacity:
            continue
        state.drop(source)
        improved = True
        while improved and state.bins[source]:
            improved = any(state.place(x, source) for x in sorted(state.bins[source], key=lambda i: -lengths[i]))
        if state.bins[source]:
            state.add(source)
    return [b for b in bins if b]


# ------------------------------------------------------------------ all groups
def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` (gapless from 0 in each sequence).

    A null or empty text has one piece, its end token. Pieces of repeated rows
    and of null ids are packed like any other; equal lengths go by id, piece and
    checksum. Only the pieces' own columns come along. No pieces give no rows.
    """
    spark = pieces.sparkSession
    ship(spark)
    names = pieces.columns
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields]
    schema = ", ".join([*fields, "sequence_id long", "offset long", "open boolean"])

    def packer(level: int):
        def run(frame: pd.DataFrame) -> pd.DataFrame:
            group = int(frame["grp"].iloc[0])
            frame = frame.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable", ignore_index=True)
            lengths = frame["length"].tolist()
            bins = pack_group(lengths, capacity)
            if level and len(bins) > frame["bin"].nunique():        # never more bins than came in
                bins = [b.tolist() for b in frame.groupby("bin").indices.values()]
            order, sequence, offset, is_open = [], [], [], []
            for k, b in enumerate(bins):
                at = 0
                for i in b:
                    order.append(i)
                    sequence.append((level << 58) | (group << 20) | k)
                    offset.append(at)
                    at += lengths[i]
                is_open += [at < capacity] * len(b)
            return frame[names].iloc[order].assign(sequence_id=sequence, offset=offset, open=is_open)
        return run

    groups = -(-max(1, pieces.count()) // group_pieces)
    # rows may be equal in all columns, so the row's own number decides
    todo = pieces.withColumn("bin", F.monotonically_increasing_id()).withColumn("grp", F.pmod(F.xxhash64("bin"), F.lit(groups)))
    done: list[DataFrame] = []
    before, idle = None, 0
    for level in range(LEVELS):
        packed = save(todo.groupBy("grp").applyInPandas(packer(level), schema), "packed")
        left = packed.filter("open").agg(F.count("*").alias("pieces"), F.count_distinct("sequence_id").alias("bins"), F.sum("length").alias("length")).first()
        spare = left.bins - -(-(left.length or 0) // capacity)
        idle = idle + 1 if before is not None and before - left.bins < LEAST_FREED * before else 0
        if groups == 1 or not spare or idle == IDLE_ROUNDS or level == LEVELS - 1:
            done.append(packed)
            break
        done.append(packed.filter(~F.col("open")))
        before, groups = left.bins, -(-left.pieces // group_pieces)
        dealt = F.pmod(F.xxhash64(F.lit(level), "sequence_id"), F.lit(groups))
        todo = packed.filter("open").select(*names, F.col("sequence_id").alias("bin"), dealt.alias("grp"))
    out = done[0].drop("open")
    for more in done[1:]:
        out = out.unionByName(more.drop("open"))
    return out.select(*[F.when(F.col(c) != LAST, F.col(c)).alias(c) if c == "doc_id" else c for c in names], "sequence_id", "offset")
