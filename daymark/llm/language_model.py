"""Scores of documents by a stupid-backoff bigram model of the whole corpus, worked out by joins on hashed n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import gram_hashes, release_caches, signed, utf8, word_hashes
from daymark.session import stored


class Backoff(NamedTuple):
    """``penalty``: factor when a bigram has fewer than ``least_count`` occurrences in the corpus and the word alone
    decides. ``block_words``: words whose n-grams are brought together before they are exchanged; ``part_grams``:
    n-grams per task that counts. Logarithms are rounded to ``1 / units``, so that sums do not depend on their order."""

    penalty: float = 0.4
    least_count: int = 2
    block_words: int = 1_000_000
    part_grams: int = 2_000_000
    units: int = 1_000_000


def packed(x: np.ndarray) -> bytes:
    """Numbers as bytes, compressed: they are stored and exchanged, and most are small."""
    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def packed_planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte of all of them, compressed: the upper bytes are mostly alike."""
    return packed(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T))


def unpacked_planes(data: bytes, kind: type) -> np.ndarray:
    planes = unpacked(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def packed_sorted(x: np.ndarray) -> bytes:
    """Ascending numbers as their compressed differences."""
    return packed_planes(np.diff(x, prepend=np.uint64(0)))


def unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked_planes(data, np.uint64), dtype=np.uint64)


_BLOCK = "block bigint, ids array<bigint>, lengths binary, places binary, words binary, n_words bigint"


def blocks(docs: DataFrame, how: Backoff) -> DataFrame:
    """Documents in blocks: the sorted hashes of a block's different words, and every word as a place among them."""

    def block(number: int, ids: list, hashes: list[np.ndarray]) -> pa.RecordBatch:
        lengths = np.array([len(h) for h in hashes], np.int64)
        words, places = np.unique(np.concatenate(hashes), return_inverse=True)
        binaries = [packed(lengths), packed_planes(places.astype(np.uint32)), packed_sorted(words)]
        columns = [pa.array([number]), pa.array([ids], pa.list_(pa.int64())), *(pa.array([b]) for b in binaries)]
        names = ["block", "ids", "lengths", "places", "words", "n_words"]
        return pa.RecordBatch.from_arrays([*columns, pa.array([int(lengths.sum())])], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches("words")
        number, ids, hashes, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                ids.append(doc_id)
                hashes.append(word_hashes(text.lower().split() if text else []))  # bytes.lower() changes A-Z only
                size += len(hashes[-1])
                if size >= how.block_words:
                    yield block(number, ids, hashes)
                    number, ids, hashes, size = number + 1, [], [], 0
        if ids:
            yield block(number, ids, hashes)

    return stored(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, _BLOCK))


_SLICE = 1 << 18  # words of a block that are worked on at a time


class Block(NamedTuple):
    """A block's words as places among its different words, and whether they begin a document."""

    lengths: np.ndarray
    places: np.ndarray
    words: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, lengths: bytes, places: bytes, words: bytes) -> Block:
        sizes, at = unpacked(lengths, np.int64), unpacked_planes(places, np.uint32)
        first = np.zeros(len(at), bool)
        first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        return cls(sizes, at, unpacked_sorted(words), first)

    def bigrams(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words from ``start`` to ``end`` that end a bigram, and its hash."""
        at = np.flatnonzero(~self.first[start:end]) + start
        before = max(start - 1, 0)
        return at, gram_hashes(self.words[self.places[before:end]], 2)[at - before - 1]

    def all_bigrams(self) -> np.ndarray:
        """The hash of every bigram, a slice at a time."""
        hashes, size = np.empty(int((~self.first).sum()), np.uint64), 0
        for start in range(0, len(self.places), _SLICE):
            _, some = self.bigrams(start, start + _SLICE)
            hashes[size : size + len(some)] = some
            size += len(some)
        return hashes


def _asked(parts: int):
    """A block's different n-grams with their numbers of occurrences, cut by ranges of the hash."""

    def rows(block: int, size: int, grams: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        part = (grams >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
        starts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(grams) else np.empty(0, np.int64)
        ends = np.append(starts[1:], len(grams))
        columns = [
            pa.array(signed(part[starts].astype(np.uint64))),
            pa.array(np.full(len(starts), block, np.int64)),
            pa.array(np.full(len(starts), size, np.int32)),
            pa.array([packed_sorted(grams[s:e]) for s, e in zip(starts, ends)], pa.binary()),
            pa.array([packed(counts[s:e].astype(np.uint32)) for s, e in zip(starts, ends)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["part", "block", "size", "grams", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches("numbers")
        for batch in batches:
            for i in range(batch.num_rows):
                number, *rest = (batch.column(c)[i].as_py() for c in range(4))
                own = Block.of(*rest)
                yield rows(number, 1, own.words, np.bincount(own.places, minlength=len(own.words)))
                yield rows(number, 2, *np.unique(own.all_bigrams(), return_counts=True))

    return run


def _counted(asked: pa.Table) -> pa.Table:
    """The count table of one range of hashes, joined to the blocks that asked: a count per n-gram of each row."""
    release_caches("numbers")
    sizes, grams, counts = asked["size"].to_numpy(), asked["grams"].to_pylist(), asked["counts"].to_pylist()
    answers: list = [None] * len(sizes)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        slices = [unpacked_sorted(grams[i]) for i in rows]
        cuts = np.cumsum([0, *map(len, slices)])
        keys, own = np.concatenate(slices), np.concatenate([unpacked(counts[i], np.uint32) for i in rows])
        _, number = np.unique(keys, return_inverse=True)
        totals = np.bincount(number, own)[number].astype(np.uint64)
        for i, start, end in zip(rows, cuts, cuts[1:]):
            answers[i] = packed(totals[start:end])
    return pa.table(
        {"block": asked["block"], "size": asked["size"], "part": asked["part"], "totals": pa.array(answers, pa.binary())}
    )


def _terms(own: Block, alone: np.ndarray, together: np.ndarray, total: int, how: Backoff) -> np.ndarray:
    """The rounded logarithm of each word of a block, from the counts of its different words and bigrams."""
    terms, grams = np.empty(len(own.places), np.int64), np.unique(own.all_bigrams())
    for start in range(0, len(terms), _SLICE):
        end = min(start + _SLICE, len(terms))
        factors = np.where(own.first[start:end], 1.0, how.penalty)
        logs = np.log(factors * alone[own.places[start:end]] / total)
        at, hashes = own.bigrams(start, end)
        pairs = together[np.searchsorted(grams, hashes)]
        often = pairs >= how.least_count
        at = at[often]
        logs[at - start] = np.log(pairs[often] / alone[own.places[at - 1]])
        terms[start:end] = np.rint(logs * how.units)
    return terms


def _scored(total: int, how: Backoff):
    def score(block: pa.Table, answers: pa.Table) -> pa.Table:
        release_caches("numbers")
        ids, lengths, scores = [], [], []
        for i in range(block.num_rows):
            own = Block.of(*(block[c][i].as_py() for c in ("lengths", "places", "words")))
            ids += block["ids"][i].as_py()
            lengths.append(own.lengths)
            if not len(own.places):
                scores.append(np.zeros(len(own.lengths), np.int64))
                continue
            by_size = {1: np.empty(0, np.uint64), 2: np.empty(0, np.uint64)}
            ordered = answers.sort_by([("size", "ascending"), ("part", "ascending")])
            for size in by_size:
                of_size = ordered.filter(pa.compute.equal(ordered["size"], size))
                parts = [unpacked(totals, np.uint64) for totals in of_size["totals"].to_pylist()]
                by_size[size] = np.concatenate([by_size[size], *parts])
            sums = np.concatenate([[0], np.cumsum(_terms(own, by_size[1], by_size[2], total, how))])
            ends = np.cumsum(own.lengths)
            scores.append(sums[ends] - sums[ends - own.lengths])
        n, s = np.concatenate(lengths), np.concatenate(scores)
        mean = np.where(n > 0, s / np.maximum(n, 1) / how.units, np.nan)
        columns = {"doc_id": pa.array(ids, pa.int64()), "n_words": n, "log_score": s}
        return pa.table({**columns, "mean_log_score": pa.array(mean, pa.float64(), from_pandas=True)})

    return score


def scored(docs: DataFrame, how: Backoff = Backoff()) -> DataFrame:
    """``doc_id, n_words, log_score, mean_log_score`` per row of ``docs(doc_id, text)``.

    Words are runs without white space, A-Z in lower case. A document's first word has the logarithm of its share of all
    words of the corpus; a later one that of (count of the bigram / count of the word before), or, if the bigram occurs
    less than ``least_count`` times, of ``penalty`` times its share. ``log_score`` is their sum in units of
    1 / ``units``, each term rounded; ``mean_log_score`` the natural logarithm per word.

    The n-grams of a block of documents are brought together, then exchanged by ranges of their 64-bit hash: each range
    holds its part of the count tables and answers every block with the counts it asked for. A frequent n-gram reaches a
    range once per block, so no n-gram unbalances the exchange.

    NULL, empty and blank texts have score 0 and a NULL mean. Rows that repeat an id are counted and scored each.
    """
    in_blocks = blocks(docs, how)
    words = in_blocks.agg(F.sum("n_words").alias("n")).first()["n"] or 0
    parts = -(-2 * words // how.part_grams) or 1
    schema = "part bigint, block bigint, size int, grams binary, counts binary"
    texts = in_blocks.select("block", "lengths", "places", "words")
    asked = texts.mapInArrow(_asked(parts), schema)
    answers = asked.groupBy("part").applyInArrow(_counted, "block bigint, size int, part bigint, totals binary")
    joined = in_blocks.drop("n_words").groupBy("block").cogroup(answers.groupBy("block"))
    return joined.applyInArrow(
        _scored(words, how), "doc_id bigint, n_words bigint, log_score bigint, mean_log_score double"
    )
