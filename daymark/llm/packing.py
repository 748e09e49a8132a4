"""Packing documents into token sequences of one length: concatenate and cut."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daymark.llm.common import Cache, map_batches, release_caches, utf8
from daymark.llm.pieces import byte_characters, simple_pieces
from daymark.session import stored

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


class Packing(NamedTuple):
    """``tokenizer``: file that every executor can read; its ids must not span white space (see ``WordIds``)."""

    capacity: int = 4096
    end_id: int = 2
    tokenizer: str = WORD_BPE


_BYTES = dict(enumerate(byte_characters()))


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class WordIds:
    """Ids of texts by a tokenizer that drops white space and never joins across it.

    Each different word is encoded by itself, by the library; a text's ids are those of its words. This holds for
    ``word_bpe_49k.json``: its split pattern has no white space in a piece, its special strings hold none, and neither
    lower case nor NFC joins a character with a space before it. The pieces of common words go straight to the library's
    merges; other words, and those that could hold a special string, go through its whole path.
    """

    def __init__(self, file: str):
        self._tokenizer = Tokenizer.from_file(file)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._merges = self._tokenizer.model
        self._ids = Cache(self._encode, 300_000, "ids")
        self._pieces = Cache(self._merge, 200_000, "ids")

    def _encode(self, word: bytes) -> bytes:
        # Letters are one piece; ASCII letters and one more ASCII character are two.
        if word.isalpha():
            return self._pieces[word.lower().decode()]
        if word[:-1].isalpha() and word[-1] < 0x80:
            return self._pieces[word[:-1].lower().decode()] + self._pieces[chr(word[-1])]
        text = word.decode("utf-8", "replace")
        pieces = None if "<|" in text else simple_pieces(text)
        if pieces is None:
            return _packed(self._tokenizer.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self._pieces.__getitem__, pieces))

    def _merge(self, piece: str) -> bytes:
        plain = piece.isascii() and piece.isalnum()  # its characters stand for themselves
        characters = piece if plain else piece.encode().decode("latin-1").translate(_BYTES)
        return _packed([token.id for token in self._merges.tokenize(characters)])

    def __call__(self, text: bytes | None) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        return b"".join(map(self._ids.__getitem__, text.split())) if text else b""


@lru_cache(maxsize=2)
def word_ids(file: str) -> WordIds:
    """One per Python worker, so that its words serve all tasks of the worker."""
    return WordIds(file)


_TOKENIZED = "doc_id bigint, task bigint, start_in_task bigint, doc_tokens bigint, ids binary"


def tokenized(docs: DataFrame, how: Packing) -> DataFrame:
    """Every row's ids and where they start among those of its task; stored, so that places stay as they are."""
    end = np.array([how.end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches("ids")
        encode, task, start = word_ids(how.tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                ids = [encode(text) + end for text in utf8(part.column(1))]
                lengths = np.array([len(x) // 4 for x in ids], np.int64)
                starts = start + np.cumsum(lengths) - lengths
                start += int(lengths.sum())
                tasks = np.full(len(ids), task, np.int64)
                columns = [part.column(0), pa.array(tasks), pa.array(starts), pa.array(lengths), pa.array(ids)]
                names = ["doc_id", "task", "start_in_task", "doc_tokens", "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return stored(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, _TOKENIZED))


def _cut(capacity: int):
    def rows(batch: pa.RecordBatch):
        ids = batch.column(3).to_pylist()
        out: dict = {name: [] for name in ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")}
        places = zip(*(batch.column(i).to_pylist() for i in (0, 1, 2)), ids, strict=True)
        for doc_id, start, tokens, raw in places:
            done = 0
            while done < tokens:
                sequence, offset = divmod(start + done, capacity)
                length = min(tokens - done, capacity - offset)
                piece = (doc_id, done, length, raw[4 * done : 4 * (done + length)], tokens, sequence, offset)
                for values, value in zip(out.values(), piece, strict=True):
                    values.append(value)
                done += length
        yield out

    return rows


def packed(docs: DataFrame, how: Packing = Packing()) -> DataFrame:
    """Pieces ``doc_id, start, length, ids, doc_tokens, sequence_id, offset`` of all rows of ``docs(doc_id, text)``.

    All documents' ids, each with the end id, form one line that is cut every ``capacity`` ids. The first pass
    tokenizes and numbers the ids within each task; the totals of the tasks, one row each, give every task its place in
    the line. The second pass cuts. A document over a border gives one piece per sequence; ``ids`` are little-endian
    unsigned 32-bit numbers. Only the last sequence needs padding. No step shuffles ids.

    NULL and empty texts have the end id alone. Rows that repeat an id are packed each for itself; an id may be NULL.
    """
    tokens = tokenized(docs, how)
    totals = tokens.groupBy("task").agg(F.max(F.col("start_in_task") + F.col("doc_tokens")).alias("total"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("task", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    # One row per task of the first pass.
    placed = tokens.join(F.broadcast(bases), "task").select(
        "doc_id", (F.col("base") + F.col("start_in_task")).alias("place"), "doc_tokens", "ids"
    )
    return map_batches(
        placed,
        _cut(how.capacity),
        "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint",
    )


def packing_report(docs: DataFrame, how: Packing = Packing()) -> DataFrame:
    """The pieces with the CRC-32 of their ids instead of the ids."""
    return packed(docs, how).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
