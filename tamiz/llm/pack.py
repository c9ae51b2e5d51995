"""Best-fit packing of token sequences with a swap-based local search.

Documents are tokenised where they lie; only those longer than a sequence are cut, so that every piece but the
first fills one. Full pieces are sequences already. The others are dealt by hash into shards of bounded size; a
shard is packed best-fit by decreasing length, then a local search moves and exchanges documents between
underfull bins (each step raises the sum of squared fills) until bins are empty or no step helps. What a shard
leaves underfull is gathered over some shards and packed again.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Callable
from heapq import heapify, heappop, heappush
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.columns import quoted
from tamiz.llm.common import append, unused
from tamiz.llm.tokens import Library, ids, pack
from tamiz.session import materialise

# Documents of one shard. A bin filled less than this goes into the next round.
SHARD_ROWS, FILLED = 10_000, 0.99
END = 0


def cut(length: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``length`` ids: all of ``most`` ids but for the first."""
    first = length % most or min(length, most)
    return [(0, first)] + [(start, most) for start in range(first, length, most)]


def token_pieces(docs: DataFrame, path: str, most: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per piece: key, row (a number for each row of ``docs``), piece, start, length, ids_crc32."""

    def make():
        encoder = ids(Library(path))
        end = pack([END])

        def step(texts: pa.Array) -> list:
            out = []
            for t in texts.to_pylist():
                packed = b"".join([*encoder.values_of(t), end])
                out.append(
                    [
                        (i, start, n, zlib.crc32(packed[4 * start : 4 * (start + n)]))
                        for i, (start, n) in enumerate(cut(len(packed) // 4, most))
                    ]
                )
            return out

        return step

    df = docs.select(quoted(key), quoted(text))
    name = unused(df.columns, "pieces")
    df = append(df, [text], make, "array<struct<piece:int,start:long,length:long,ids_crc32:long>>", name)
    df = df.select(quoted(key).alias("key"), F.monotonically_increasing_id().alias("row"), F.col(name).alias("p"))
    return df.select("key", "row", F.inline("p"))


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: each item, the longest first, goes to the fullest bin that it fits."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms: list[int] = []
    for i in order:
        at = bisect_left(rooms, lengths[i])
        if at == len(rooms):
            bins.append([i])
            b, room = len(bins) - 1, capacity
        else:
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
            bins[b].append(i)
        room -= lengths[i]
        if room:
            if not by_room[room]:
                insort(rooms, room)
            by_room[room].append(b)
    return bins


def fewest(lengths: list[int], capacity: int) -> int:
    """A lower bound on the bins: for each k, items above capacity - k share with none of k or more, those above half
    share with no other such, and the rest fill what room is left."""
    count = np.bincount(np.asarray(lengths, dtype=np.int64), minlength=capacity + 1)
    size = count * np.arange(capacity + 1)
    half = capacity // 2
    above, size_above = count[half + 1 :].sum(), size[half + 1 :].sum()
    best = -(-int(size.sum()) // capacity)
    small = 0
    for k in range(half, 0, -1):
        small += int(size[k])
        alone = int(count[capacity - k + 1 :].sum())
        size_alone = int(size[capacity - k + 1 :].sum())
        room = capacity * int(above - alone) - int(size_above - size_alone)
        best = max(best, int(above) + max(0, -(-(small - room) // capacity)))
    return best


class Takers:
    """What bins can give back (nothing, one document or two) with the room they have: flat arrays of slots."""

    def __init__(self, sizes: Callable[[int], list[int]]) -> None:
        self.sizes = sizes
        self.size, self.room, self.bin = (np.zeros(1024, dtype=np.int64) for _ in range(3))
        self.end, self.slots = 0, {}

    def add(self, b: int, room: int) -> None:
        sizes = sorted(set(self.sizes(b)))
        if self.end + len(sizes) > len(self.size):
            live = np.flatnonzero(self.room[: self.end] > 0)
            more = max(1024, 2 * (len(live) + len(sizes)))
            for name in ("size", "room", "bin"):
                old = getattr(self, name)[live]
                setattr(self, name, np.concatenate([old, np.zeros(more - len(old), dtype=np.int64)]))
            self.end = len(live)
            starts = np.flatnonzero(np.diff(self.bin[: self.end], prepend=-1))
            stops = [*starts[1:], self.end]
            self.slots = {int(self.bin[x]): (int(x), int(y)) for x, y in zip(starts, stops, strict=True)}
        at = slice(self.end, self.end + len(sizes))
        self.size[at], self.room[at], self.bin[at] = sizes, room, b
        self.slots[b] = (at.start, at.stop)
        self.end = at.stop

    def remove(self, b: int) -> None:
        if b in self.slots:
            start, stop = self.slots.pop(b)
            self.room[start:stop] = 0

    def find(self, given: int, spare: int) -> tuple[int, int] | None:
        """(bin, size to take back) for ``given`` units of a bin with ``spare`` room: the fullest bin that can take them,
        with the largest gain. The squared fills grow if the taker is then fuller than the giver was."""
        gain, room = given - self.size[: self.end], self.room[: self.end]
        fits = np.flatnonzero((gain > 0) & (gain <= room) & (room - gain < spare))
        if not len(fits):
            return None
        at = fits[np.argmin((room[fits] << 32) - gain[fits])]
        return int(self.bin[at]), int(self.size[at])


class Search:
    """Local search over underfull bins. The emptiest bin gives: it moves a document into another bin, exchanges one
    for a smaller one, one for two smaller ones, or two for one smaller one. Each step raises the sum of squared
    fills, so the search ends."""

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int) -> None:
        self.bins, self.lengths, self.capacity = bins, lengths, capacity
        self.fill = [sum(lengths[i] for i in b) for b in bins]
        self.one = Takers(self.singles)
        self.two = Takers(self.pairs)
        for b in range(len(bins)):
            self.enter(b)

    def singles(self, b: int) -> list[int]:
        return [0, *(self.lengths[i] for i in self.bins[b])]

    def pairs(self, b: int) -> list[int]:
        return [self.lengths[i] + self.lengths[j] for i, j in combinations(self.bins[b], 2)]

    def enter(self, b: int) -> None:
        if room := self.capacity - self.fill[b]:
            self.one.add(b, room)
            self.two.add(b, room)

    def leave(self, b: int) -> None:
        self.one.remove(b)
        self.two.remove(b)

    def give(self, giver: int) -> bool:
        """One step from ``giver``, which is in no index: a move if there is one, else the exchange with the fullest
        bin."""
        items = sorted(self.bins[giver], key=lambda i: -self.lengths[i])
        singles = [([i], self.lengths[i]) for i in items]
        doubles = [([i, j], self.lengths[i] + self.lengths[j]) for i, j in combinations(items, 2)]
        best = None
        for index, offers in ((self.one, singles), (self.two, singles), (self.one, doubles)):
            for given, size in offers:
                if found := index.find(size, self.capacity - self.fill[giver]):
                    taker, back = found
                    rank = (back > 0, -self.fill[taker], back - size)
                    if best is None or rank < best[0]:
                        best = rank, taker, given, back, index is self.two
        if best is None:
            return False
        _, taker, given, back, two = best
        groups = combinations(self.bins[taker], 1 + two) if back else [()]
        taken = next(list(g) for g in groups if sum(self.lengths[j] for j in g) == back)
        return self.exchange(giver, taker, given, taken)

    def exchange(self, giver: int, taker: int, given: list[int], taken: list[int]) -> bool:
        self.leave(taker)
        change = sum(self.lengths[i] for i in given) - sum(self.lengths[j] for j in taken)
        self.bins[giver] = [i for i in self.bins[giver] if i not in given] + taken
        self.bins[taker] = [j for j in self.bins[taker] if j not in taken] + given
        self.fill[giver] -= change
        self.fill[taker] += change
        self.enter(taker)
        return True

    def run(self, enough: int) -> None:
        """Until no bin can give, or only ``enough`` bins are left."""
        left = sum(1 for b in self.bins if b)
        givers = [(f, b) for b, f in enumerate(self.fill) if 0 < f < self.capacity]
        heapify(givers)
        shut: list[int] = []
        while givers and left > enough:
            fill, giver = heappop(givers)
            if fill != self.fill[giver]:
                if self.fill[giver] < self.capacity:
                    heappush(givers, (self.fill[giver], giver))
                continue
            self.leave(giver)
            if not self.give(giver):
                shut.append(giver)
                self.enter(giver)
            elif self.bins[giver]:
                heappush(givers, (self.fill[giver], giver))
            else:
                left -= 1
                for b in shut:  # a bin less: every bin may give again
                    heappush(givers, (self.fill[b], b))
                shut = []


def improve(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    full = [b for b in bins if sum(lengths[i] for i in b) == capacity]
    part = [list(b) for b in bins if sum(lengths[i] for i in b) < capacity]
    enough = fewest([lengths[i] for b in part for i in b], capacity)
    if len(part) > enough:
        Search(part, lengths, capacity).run(enough)
    return full + [b for b in part if b]


PIECE = ["key", "row", "piece", "start", "length", "ids_crc32", "shard"]


def _pack_shards(pieces: DataFrame, capacity: int, level: int) -> DataFrame:
    """Packs each shard; adds sequence_id, offset and full (the bin is not packed again)."""
    pieces = pieces.select(*PIECE)
    added = T._parse_datatype_string("sequence_id long, offset long, full boolean").fields

    def run(keys: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.select(PIECE).sort_by([("row", "ascending"), ("piece", "ascending")])
        lengths = rows["length"].to_pylist()
        bins = improve(best_fit(lengths, capacity), lengths, capacity)
        bin_of, offset, full = [0] * len(lengths), [0] * len(lengths), [False] * len(lengths)
        # Sequence numbers: round, shard, bin. A shard has fewer than 2^24 bins.
        base = (level << 56) + (keys[0].as_py() << 24)
        for b, members in enumerate(bins):
            at = 0
            for i in members:
                bin_of[i], offset[i] = base + b, at
                at += lengths[i]
            for i in members:
                full[i] = at >= FILLED * capacity
        for name, values in (("sequence_id", pa.array(bin_of, pa.int64())), ("offset", pa.array(offset, pa.int64())), ("full", pa.array(full))):
            rows = rows.append_column(name, values)
        return rows

    return pieces.groupBy("shard").applyInArrow(run, T.StructType([*pieces.schema.fields, *added]))


def pack_documents(
    docs: DataFrame,
    path: str,
    capacity: int = 2048,
    key: str = "doc_id",
    text: str = "text",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Per piece: key, piece, start, length, ids_crc32, sequence_id and offset.

    A document is the ids of its whole text by the tokenizer file at ``path`` and the end mark 0; a NULL or empty
    text is the end mark alone. Keys are of any type, NULL among them. Pieces longer than ``capacity`` do not exist; a cut document fills sequences
    of its own but for its first piece. Repeated rows are packed as documents of their own. No rows, no sequences.
    """
    pieces = materialise(token_pieces(docs, path, capacity, key, text), "pieces")
    whole = pieces.where(F.col("length") == capacity)
    parts = pieces.where(F.col("length") < capacity)
    done = whole.select(
        "key", "piece", "start", "length", "ids_crc32",
        F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    n = max(1, -(-parts.count() // shard_rows))
    level = 1
    while True:
        # A row has one piece below the capacity, so its number deals evenly.
        dealt = parts.withColumn("shard", F.pmod(F.xxhash64("row", F.lit(level)), F.lit(n)))
        packed = _pack_shards(dealt, capacity, level)
        columns = ["key", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        if n == 1:
            return _named(done.unionByName(packed.select(columns)), key)
        packed = materialise(packed, "packed")
        parts = packed.where(~F.col("full")).drop("shard", "sequence_id", "offset", "full")
        fewer = max(1, -(-parts.count() // shard_rows))
        if 2 * fewer > n:  # the shards were filled badly by nature; meeting again would not help
            return _named(done.unionByName(packed.select(columns)), key)
        # Well filled bins stay; the others are gathered.
        done = done.unionByName(packed.where("full").select(columns))
        n = fewer
        level += 1


def _named(df: DataFrame, key: str) -> DataFrame:
    return df.withColumnRenamed("key", key)

