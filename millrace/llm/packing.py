"""Best-fit packing of token pieces after a dominance reduction.

Lengths are whole numbers up to the capacity, so the instance is a histogram with at most
``capacity`` entries, whatever the number of documents. The plan is made on that histogram: a
few kinds of sequences and how many there are of each. First the dominance test of Martello and
Toth fixes sets of up to three pieces that no other set can beat; they leave the instance for
good. The rest goes largest first to the fullest sequence that takes it. Pieces are then
numbered within their length, in salted slices, and find their place from the number alone.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .schemas import extended
from .tokens import WordEncoder, vocabulary

PIECES_PER_SLICE = 50_000
#: Ids in one Arrow batch that a task hands back, about 16 MB.
IDS_PER_BATCH = 4_000_000


class Stock:
    """How many pieces of each length are left."""

    def __init__(self, counts: Mapping[int, int]):
        self.left = {s: n for s, n in counts.items() if n > 0}
        self.sizes = sorted(self.left)

    def take(self, size: int, n: int = 1) -> None:
        self.left[size] -= n
        if not self.left[size]:
            del self.left[size]
            self.sizes.pop(bisect_left(self.sizes, size))

    def put(self, size: int) -> None:
        if size not in self.left:
            self.sizes.insert(bisect_left(self.sizes, size), size)
        self.left[size] = self.left.get(size, 0) + 1

    def fitting(self, room: int) -> int | None:
        """The largest length of at most ``room``."""
        at = bisect_right(self.sizes, room)
        return self.sizes[at - 1] if at else None

    def smallest(self, n: int, above: int = 0) -> list[int]:
        """The ``n`` shortest pieces longer than ``above``, or as many as there are."""
        found: list[int] = []
        for size in self.sizes[bisect_right(self.sizes, above) :]:
            found += [size] * min(self.left[size], n - len(found))
            if len(found) == n:
                break
        return found

    def widest_pair(self, room: int) -> int:
        """The largest sum of two pieces within ``room``; 0 if none fits."""
        best, low, high = 0, 0, len(self.sizes) - 1
        while low <= high:
            total = self.sizes[low] + self.sizes[high]
            if total > room:
                high -= 1
            elif low == high and self.left[self.sizes[low]] < 2:
                break
            else:
                best = max(best, total)
                low += 1
        return best


def dominating(stock: Stock, piece: int, capacity: int) -> list[int] | None:
    """A set holding ``piece`` that is at least as good as every other set with it, or None.

    One set dominates another if the other's pieces can be shared out among those of the first
    without exceeding them; then some best packing has the first. With at most two partners
    possible this can be told from the largest partner, the fullest pair and the next lengths.
    """
    stock.take(piece)
    try:
        room = capacity - piece
        partner = stock.fitting(room)
        if partner is None:
            return [piece]
        least = stock.smallest(3)
        if partner == room or len(least) < 2 or sum(least[:2]) > room:
            return [piece, partner]
        if len(least) == 3 and sum(least) <= room:
            return None
        if stock.widest_pair(room) <= partner:
            return [piece, partner]
        stock.take(partner)
        third = stock.fitting(room - partner)
        stock.put(partner)
        if third is not None:
            longer = stock.smallest(2, third)
            if len(longer) < 2 or sum(longer) > room:
                return [piece, partner, third]
        return None
    finally:
        stock.put(piece)


def reduced(stock: Stock, capacity: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """Take dominating sets out of ``stock``: how often, and which lengths how many times.

    What makes a set dominate stays true as pieces leave, so a set is repeated until one of its
    lengths runs out. Fixing sets can make others dominate; the passes end when none is found.
    """
    changed = True
    while changed:
        changed = False
        for piece in reversed(list(stock.sizes)):
            while piece in stock.left and (chosen := dominating(stock, piece, capacity)):
                parts = sorted(Counter(chosen).items(), reverse=True)
                times = min(stock.left[s] // m for s, m in parts)
                for size, m in parts:
                    stock.take(size, m * times)
                yield times, parts
                changed = True


def best_fit(stock: Stock, capacity: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """Largest first into the fullest sequence with room, many equal sequences at once.

    A sequence that takes a piece stays the fullest with room for the next equal one, so it is
    filled up before another gets any.
    """
    open_rooms: list[int] = []
    by_room: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}

    def keep(room: int, n: int, parts: list[tuple[int, int]]) -> None:
        if n:
            if room not in by_room:
                open_rooms.insert(bisect_left(open_rooms, room), room)
            by_room.setdefault(room, []).append((n, parts))

    for size in reversed(stock.sizes):
        n = stock.left[size]
        while n:
            at = bisect_left(open_rooms, size)
            if at == len(open_rooms):
                room, bins, parts = capacity, n, []
            else:
                room = open_rooms[at]
                bins, parts = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room]
                    open_rooms.pop(at)
            each = room // size
            full = min(bins, n // each)
            keep(room - each * size, full, [*parts, (size, each)])
            n -= full * each
            bins -= full
            if n and bins and n < each:
                keep(room - n * size, 1, [*parts, (size, n)])
                n, bins = 0, bins - 1
            if parts:
                keep(room, bins, parts)
    for groups in by_room.values():
        yield from groups


def plan(counts: Mapping[int, int], capacity: int) -> pd.DataFrame:
    """Runs of equal places: pieces of ``size`` numbered from ``low`` fill ``each`` places per sequence.

    They start at ``offset`` of sequence ``first``. The table has some rows per length, at most
    a few tens of thousands for a capacity of 2048.
    """
    stock, rows, used, first = Stock(counts), [], Counter(), 0
    for n, parts in [*reduced(stock, capacity), *best_fit(stock, capacity)]:
        offset = 0
        for size, each in parts:
            rows.append((size, used[size], each, first, offset))
            used[size] += n * each
            offset += each * size
        first += n
    return pd.DataFrame(rows, columns=["size", "low", "each", "first", "offset"]).astype("int64").sort_values(["size", "low"])


def pieces(
    documents: DataFrame,
    capacity: int = 2048,
    end_id: int = 0,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
    tokenizer: str | None = None,
) -> DataFrame:
    """``keep`` columns, piece, start and ids of every document, each closed by ``end_id``.

    A null text counts as empty and gives the end id alone. Documents longer than ``capacity``
    are cut into full pieces, the last of which may be shorter.
    """
    path, width, end = tokenizer or vocabulary(), 4 * capacity, int(end_id).to_bytes(4, "little")
    chosen = documents.select(*keep, F.coalesce(text, F.lit("")).alias("text"))

    def encode(batches):
        encoder = WordEncoder(path)
        for batch in batches:
            kept = batch.select(list(range(batch.num_columns - 1)))
            rows, number, start, ids, size = [], [], [], [], 0
            for row, text in enumerate(batch.column(batch.num_columns - 1)):
                whole = encoder.of(text.as_py()) + end
                for k in range(0, len(whole), width):
                    rows.append(row)
                    number.append(k // width)
                    start.append(k // 4)
                    ids.append(whole[k : k + width])
                size += len(whole)
                if size >= 4 * IDS_PER_BATCH:
                    yield joined(kept, rows, number, start, ids)
                    rows, number, start, ids, size = [], [], [], [], 0
            if rows:
                yield joined(kept, rows, number, start, ids)

    def joined(kept, rows, number, start, ids):
        columns = [pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(ids, pa.binary())]
        return pa.RecordBatch.from_arrays(
            [*kept.take(pa.array(rows, pa.int64())).columns, *columns], names=[*kept.schema.names, "piece", "start", "ids"]
        )

    return chosen.mapInArrow(encode, extended(chosen.schema.fields[:-1], "piece int, start bigint, ids binary"))


def place(items: DataFrame, order: Sequence[str], capacity: int = 2048, length: str = "length") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to items of at most ``capacity``, gapless from 0 in every sequence.

    ``order`` makes a row's number repeatable; rows that agree in all of it are interchangeable.
    Only the histogram of the lengths reaches the driver. A length that most items share is
    numbered in as many slices as its rows need.
    """
    frozen = cut(items)
    counts = {r[0]: r[1] for r in frozen.groupBy(length).count().collect()}
    if counts and (min(counts) < 1 or max(counts) > capacity):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    table = plan(counts, capacity)
    slices = 32 + sum(counts.values()) // PIECES_PER_SLICE

    sliced = frozen.withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(slices)))
    sizes = sliced.groupBy(length, "_slice").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(length).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(length, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(length, "_slice").orderBy(*order)
    ranked = (
        sliced.withColumn("_rank", F.row_number().over(inside).cast("bigint") - 1)
        .join(bases, [length, "_slice"])
        .select(*[F.col(c) for c in items.columns], (F.col("_rank") + F.col("_base")).alias("_rank"))
    )
    shift = 1 << 44
    keys = (table["size"] * shift + table["low"]).to_numpy()
    low, each, first, offset = (table[c].to_numpy() for c in ("low", "each", "first", "offset"))
    columns = items.columns

    def find(batches):
        for batch in batches:
            size, rank = batch[length].to_numpy(np.int64), batch["_rank"].to_numpy()
            at = np.searchsorted(keys, size * shift + rank, side="right") - 1
            nth = rank - low[at]
            yield batch[columns].assign(sequence_id=first[at] + nth // each[at], offset=offset[at] + nth % each[at] * size)

    return ranked.mapInPandas(find, extended(items.schema.fields, "sequence_id bigint, offset bigint"))


def pack(
    documents: DataFrame, capacity: int = 2048, end_id: int = 0, keep: Sequence[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """Places of all pieces of ``documents``: ``keep``, piece, start, length, ids_crc32, sequence_id, offset.

    An empty table gives no rows. Repeated rows are packed as often as they occur.
    """
    cutting = pieces(documents, capacity, end_id, keep, text)
    lengths = cutting.select(
        *keep, "piece", "start",
        (F.octet_length("ids") / 4).cast("bigint").alias("length"), F.crc32("ids").alias("ids_crc32"),
    )
    return place(lengths, [*keep, "piece", "ids_crc32"], capacity)


def sequences(cutting: DataFrame, places: DataFrame, keys: Sequence[str] = ("doc_id", "piece")) -> DataFrame:
    """The packed sequences, ``sequence_id`` and ``ids``, from pieces and their places; ``keys`` must be unique.

    A sequence holds at most its capacity of ids, so no group grows with the data.
    """
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return (
        places.select(*keys, "sequence_id", "offset")
        .join(cutting.select(*keys, "ids"), list(keys))
        .groupBy("sequence_id")
        .agg(F.aggregate(F.transform(inside, lambda x: x["ids"]), F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"))
    )
