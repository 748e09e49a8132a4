"""Packing documents into as few token sequences as possible: bin completion by branch and bound."""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import release_caches, utf8
from daymark.llm.packing import WORD_BPE, word_ids
from daymark.session import stored


class Filling(NamedTuple):
    """``shard``: pieces that one search packs together; ``steps``: items it may try beyond the best-fit solution,
    ``width``: fillings it branches into at a time, ``choice``: pieces of a filling, next to the largest, that it varies.
    These bound the time of a search, not what is packed."""

    capacity: int = 4096
    end_id: int = 1
    tokenizer: str = WORD_BPE
    shard: int = 100_000
    steps: int = 200_000
    width: int = 8
    choice: int = 3


# --- one shard -------------------------------------------------------------------------------------------------------

Bin = tuple[tuple[int, int], ...]  # pieces of a size, and how many
Run = tuple[int, Bin]  # so many equal bins


def filled(held: Bin) -> int:
    return sum(size * n for size, n in held)


class Remaining:
    """Pieces still to be packed: their number per size, and the sizes that are left as bits of a number."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {size: n for size, n in counts.items() if n}
        self.sizes = sum(1 << size for size in self.counts)

    def take(self, held: Bin, times: int = 1) -> None:
        for size, n in held:
            self.counts[size] -= n * times
            if not self.counts[size]:
                self.sizes ^= 1 << size

    def give(self, held: Bin, times: int = 1) -> None:
        for size, n in held:
            self.counts[size] += n * times
            self.sizes |= 1 << size

    def largest(self, most: int, used: dict[int, int] | None = None) -> int:
        """Largest size up to ``most`` that is left beside the ``used`` pieces; 0 if there is none."""
        while most > 0:
            size = max((self.sizes & ((2 << most) - 1)).bit_length() - 1, 0)
            if not used or self.counts.get(size, 0) > used.get(size, 0):
                return size
            most = size - 1
        return 0


def least_bins(counts: dict[int, int], capacity: int) -> int:
    """A lower bound: no two pieces larger than half a bin share one, and what those that leave room for a piece of some size
    leave free must hold the smaller pieces from that size on."""
    number, total = np.zeros(capacity + 1, np.int64), np.zeros(capacity + 1, np.int64)
    for size, count in counts.items():
        number[size], total[size] = count, size * count
    number, total = np.cumsum(number), np.cumsum(total)
    half, best = capacity // 2, 0
    for least in range(half + 1):
        small = total[half] - (total[least - 1] if least else 0)
        shared = number[capacity - least] - number[half]
        room = shared * capacity - (total[capacity - least] - total[half])
        best = max(best, int(number[capacity] - number[half] + max(0, -(-(small - room) // capacity))))
    return best


def best_fit(left: Remaining, capacity: int) -> list[Run]:
    """Largest pieces first, each into the fullest bin that has room; ``left`` stays as it is."""
    bins: dict[int, list[list[int]]] = {}
    rooms = 0  # the free rooms there are, as bits
    for size in sorted((s for s, count in left.counts.items() if count), reverse=True):
        for _ in range(left.counts[size]):
            fits = rooms >> size << size
            room = (fits & -fits).bit_length() - 1 if fits else capacity
            held = bins[room].pop() if fits else []
            if fits and not bins[room]:
                rooms ^= 1 << room
            held.append(size)
            bins.setdefault(room - size, []).append(held)
            rooms |= 1 << (room - size)
    kinds = Counter(tuple(held) for of_room in bins.values() for held in of_room)
    return [(times, tuple(Counter(held).items())) for held, times in kinds.items()]


def fillings(left: Remaining, room: int, top: int, choice: int, used: dict[int, int]) -> Iterator[Bin | None]:
    """Ways to fill ``room`` with pieces up to ``top``, larger ones first; ``choice`` pieces are varied, those after them are the
    largest that fit. Left out is what a single piece dominates, one that takes no less of the room and stands in the place
    of several. Every piece tried gives a None as well, which counts the work.
    """
    best = size = left.largest(min(room, top), used)
    if not size:
        yield ()
    elif not choice:
        n = min(left.counts[size] - used.get(size, 0), room // size)
        for rest in fillings(left, room - n * size, size - 1, 0, used):
            yield rest if rest is None else ((size, n), *rest)
    else:
        while size:
            yield None
            for rest in fillings(left, room - size, size, choice - 1, used | {size: used.get(size, 0) + 1}):
                if rest is None:
                    yield None
                elif size == best or size + filled(rest) > best:
                    yield ((size, 1), *rest)
            size = left.largest(size - 1, used)


def packed_sizes(counts: dict[int, int], how: Filling) -> list[Run]:
    """Bins for so many pieces of each size; every piece is in one of them.

    The best-fit solution is the first incumbent. If it has more bins than the lower bound, the search completes one bin
    after the other: the largest piece left with each of its undominated fillings, least waste first, for as many bins at
    once as the pieces allow and then for one. A branch is cut when it would waste more than a solution better than the
    incumbent can. When the steps are spent, best fit completes the branch at hand.
    """
    capacity, left = how.capacity, Remaining(counts)
    bound, total = least_bins(counts, capacity), sum(size * n for size, n in counts.items())
    best = best_fit(left, capacity)
    fewest = sum(times for times, _ in best)
    steps, wasted = how.steps, 0
    path: list[Run] = []

    def spare_waste() -> int:
        return (fewest - 1) * capacity - total - wasted

    def choices() -> Iterator[Run]:
        nonlocal steps
        first = left.largest(capacity)
        found: dict[Bin, int] = {}
        for rest in fillings(left, capacity - first, first, how.choice, {first: 1}):
            if rest is None:
                steps -= 1
                if steps <= 0:
                    break
                continue
            pieces: Counter[int] = Counter({first: 1})
            for size, n in rest:
                pieces[size] += n
            waste = capacity - filled(tuple(pieces.items()))
            if waste <= spare_waste() and not left.largest(waste, pieces):  # nothing that is left would still fit
                found[tuple(pieces.items())] = waste
            if not waste or len(found) >= 4 * how.width:
                break
        for held, waste in heapq.nsmallest(how.width, found.items(), key=lambda way: (way[1], sum(n for _, n in way[0]))):
            most = min(left.counts[size] // n for size, n in held)
            if waste:
                most = min(most, spare_waste() // waste)
            if most > 1:
                yield most, held
            if most:
                yield 1, held

    stack = [choices()]
    while stack and fewest > bound:
        if len(path) == len(stack):  # what was chosen here last has been searched
            times, held = path.pop()
            left.give(held, times)
            wasted -= times * (capacity - filled(held))
        if steps <= 0 or not left.sizes:
            whole = path + best_fit(left, capacity)
            if sum(times for times, _ in whole) < fewest:
                best, fewest = whole, sum(times for times, _ in whole)
            if steps <= 0:
                break
            stack.pop()
        elif (chosen := next(stack[-1], None)) is None:
            stack.pop()
        else:
            times, held = chosen
            left.take(held, times)
            path.append(chosen)
            wasted += times * (capacity - filled(held))
            stack.append(choices())
    return best


def bins_of(places: list[int], lengths: list[int], how: Filling) -> Iterator[tuple[int, int, int]]:
    """``place, bin, offset`` of every piece of a shard."""
    waiting: dict[int, list[int]] = {}
    for place, length in zip(places, lengths, strict=True):
        waiting.setdefault(length, []).append(place)
    number = 0
    for times, held in packed_sizes({size: len(of_size) for size, of_size in waiting.items()}, how):
        for _ in range(times):
            offset = 0
            for size, n in held:
                for _ in range(n):
                    yield waiting[size].pop(), number, offset
                    offset += size
            number += 1


# --- all documents ---------------------------------------------------------------------------------------------------


def pieces(docs: DataFrame, how: Filling) -> DataFrame:
    """Every row's ids, cut every ``capacity`` ids, each piece with a number of its own (``place``); stored, so that the numbers
    stay as they are."""
    end = np.array([how.end_id], "<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "place", "ids"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches("ids")
        encode, place = word_ids(how.tokenizer), TaskContext.get().partitionId() << 36
        step = 4 * how.capacity
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                out: list[tuple] = []
                for doc_id, text in zip(part.column(0).to_pylist(), utf8(part.column(1)), strict=True):
                    ids = encode(text) + end
                    for number, at in enumerate(range(0, len(ids), step)):
                        cut = ids[at : at + step]
                        out.append((doc_id, number, at // 4, len(cut) // 4, place, cut))
                        place += 1
                columns = [pa.array(column, kind) for column, kind in zip(zip(*out), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id bigint, piece int, start bigint, length bigint, place bigint, ids binary"
    return stored(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema))


def plan(short: DataFrame, how: Filling) -> DataFrame:
    """``place, sequence_id, offset`` for the pieces ``short(place, length)``, which are dealt to shards of about equal mixture."""
    shards = -(-short.count() // how.shard) or 1
    dealt = short.select("place", "length", F.pmod(F.xxhash64("place"), F.lit(shards)).alias("shard"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = (zip(*(batch.column(name).to_pylist() for name in ("shard", "place", "length"))) for batch in batches)
        for shard, rows in groupby((row for batch in columns for row in batch), key=lambda row: row[0]):
            _, places, lengths = zip(*rows)
            place, number, offset = (np.array(x, np.int64) for x in zip(*bins_of(places, lengths, how)))
            arrays = [pa.array(x) for x in (place, (shard << 32) + number, offset)]
            yield pa.RecordBatch.from_arrays(arrays, ["place", "sequence_id", "offset"])

    ordered = dealt.repartition("shard").sortWithinPartitions("shard", "place")
    return stored(ordered.mapInArrow(run, "place bigint, sequence_id bigint, offset bigint"))


def packed(docs: DataFrame, how: Filling = Filling()) -> DataFrame:
    """Pieces ``doc_id, piece, start, length, ids, sequence_id, offset`` of all rows of ``docs(doc_id, text)``, in few sequences of
    at most ``capacity`` ids.

    A document is its ids and the end id. Only one that is longer than a sequence is cut, into whole sequences and a
    rest. Whole ones take a sequence each; all others are dealt to shards, by number alone, and each shard is packed by
    itself (``packed_sizes``), knowing only how many pieces of each size it has: a task holds two numbers per piece. A
    shard's last sequence may be half empty, one in tens of thousands. ``ids`` are little-endian unsigned 32-bit
    numbers, ``offset`` the place of a piece in its sequence; ``sequence_id`` is below 0 for a whole sequence.

    NULL and empty texts have the end id alone. Rows that repeat an id are packed each for itself; an id may be NULL.
    """
    cut = pieces(docs, how)
    whole, short = cut.where(F.col("length") == how.capacity), cut.where(F.col("length") < how.capacity)
    columns = ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]
    alone = whole.withColumns({"sequence_id": -1 - F.col("place"), "offset": F.lit(0).cast("bigint")})
    joined = short.join(plan(short, how), "place")
    return alone.select(*columns).union(joined.select(*columns))


def packing_report(docs: DataFrame, how: Filling = Filling()) -> DataFrame:
    """The pieces with the CRC-32 of their ids instead of the ids."""
    names = ["doc_id", "piece", "start", "length"]
    return packed(docs, how).select(*names, F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
