"""Token counts by byte pair encoding in numpy: every sequence of a batch merges its lowest-rank pair at the same time."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daymark.llm.common import Cache, release_caches, utf8
from daymark.llm.pieces import byte_characters, simple_pieces

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
_NO_RANK = np.iinfo(np.int64).max

class Counting(NamedTuple):
    """``tokenizer``: a word-end BPE file that every executor can read; ``limit``: tokens a document may have."""

    limit: int = 2048
    tokenizer: str = WORD_BPE


class Vocabulary:
    """Merge ranks as sorted arrays, special strings, and the first symbol of every byte inside and at the end."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as source:
            content = json.load(source)
        model = content["model"]
        ids, suffix = model["vocab"], model["end_of_word_suffix"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.size = max(ids.values()) + 1
        keys = np.array([ids[a] * self.size + ids[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self._keys, self._ranks = keys[order], order.astype(np.int64)
        self._merged = np.array([ids[a + b] for a, b in merges], np.int64)
        self._inner = np.array([ids[c] for c in byte_characters()], np.int64)
        self._last = np.array([ids[c + suffix] for c in byte_characters()], np.int64)
        self._library = Tokenizer.from_file(file)
        self._special = regex.compile("|".join(regex.escape(t["content"]) for t in content["added_tokens"]))

    def pieces(self, word: str) -> tuple[int, list[bytes]]:
        """Number of special strings in a word without white space, and the pieces of the rest in UTF-8."""
        parts = self._special.split(word)
        found = []
        for part in parts:
            simple = simple_pieces(part)
            if simple is not None:
                found += [piece.encode() for piece in simple]
            else:
                lower = self._library.normalizer.normalize_str(part)
                places = self._library.pre_tokenizer.pre_tokenize_str(lower)
                found += [lower[start:end].encode() for _, (start, end) in places]
        return len(parts) - 1, found

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self._keys, wanted), len(self._keys) - 1)
        return np.where(self._keys[at] == wanted, self._ranks[at], _NO_RANK)

    def symbol_counts(self, pieces: list[bytes]) -> np.ndarray:
        """Number of symbols each non-empty piece is left with after all merges.

        The pieces lie one behind the other in an array. In every round each piece finds its lowest rank among adjacent
        symbols and merges all pairs of that rank, from the left where they overlap; finished pieces leave the array.
        """
        lengths = np.array([len(piece) for piece in pieces], np.int64)
        counts = lengths.copy()
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        symbols = self._inner[raw]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self._last[raw[ends]]
        owner = np.repeat(np.arange(len(pieces)), lengths)
        while True:
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            rank = np.full(len(symbols), _NO_RANK)
            rank[:-1] = np.where(owner[1:] == owner[:-1], self.ranks(symbols[:-1], symbols[1:]), _NO_RANK)
            lowest = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(symbols)))
            counts[owner[first]] = sizes
            going = np.repeat(lowest != _NO_RANK, sizes)
            symbols, owner, rank, lowest = symbols[going], owner[going], rank[going], np.repeat(lowest, sizes)[going]
            if not len(symbols):
                break
            merge = rank == lowest
            # In a run of overlapping pairs every second one is merged, beginning with the first.
            place = np.arange(len(merge))
            start = np.maximum.accumulate(np.where(merge & ~np.append(False, merge[:-1]), place, 0))
            merge &= (place - start) % 2 == 0
            symbols = np.where(merge, self._merged[np.where(merge, rank, 0)], symbols)
            stays = ~np.append(False, merge[:-1])
            symbols, owner = symbols[stays], owner[stays]
        return counts


class TokenCounter:
    """Tokens of texts; every different word is encoded once."""

    def __init__(self, file: str):
        self._vocabulary = Vocabulary(file)
        self._counts = Cache(lambda word: self._of([word])[0], user="counts")

    def _of(self, words: list[bytes]) -> list[int]:
        split = [self._vocabulary.pieces(word.decode()) for word in words]
        different = list(dict.fromkeys(piece for _, pieces in split for piece in pieces))
        sizes = dict(zip(different, self._vocabulary.symbol_counts(different).tolist() if different else [], strict=True))
        return [special + sum(sizes[piece] for piece in pieces) for special, pieces in split]

    def learn(self, words: Iterable[bytes]) -> None:
        new = self._counts.unknown(words)
        for start in range(0, len(new), 50_000):
            part = new[start : start + 50_000]
            for word, count in zip(part, self._of(part), strict=True):
                self._counts.learn(word, count)

    def __call__(self, texts: list[bytes | None]) -> list[int]:
        words = [text.split() if text else [] for text in texts]
        self.learn({word for of_text in words for word in of_text})
        return [sum(map(self._counts.__getitem__, of_text)) for of_text in words]


@lru_cache(maxsize=2)
def token_counter(file: str) -> TokenCounter:
    """One per Python worker, so that its words serve all tasks of the worker."""
    return TokenCounter(file)


def counted(docs: DataFrame, how: Counting = Counting()) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row of ``docs(doc_id, text)``.

    Counts are those of the tokenizer's library on the whole text, without begin, end or added tokens; special strings in
    a text count as the one token the library makes of them. Words between ASCII white space are encoded by themselves,
    which the vocabulary's pattern allows. NULL counts as an empty text. Ids may repeat or be NULL.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches("counts")
        counter = token_counter(how.tokenizer)
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                texts = utf8(part.column(1))
                tokens = np.array(counter(texts), np.int64)
                columns = [part.column(0), [len(t or b"") for t in texts], tokens, tokens > how.limit]
                names = ["doc_id", "n_bytes", "n_tokens", "over_limit"]
                yield pa.RecordBatch.from_arrays([c if i == 0 else pa.array(c) for i, c in enumerate(columns)], names)

    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)
