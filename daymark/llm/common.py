"""What several operators share: words, hashes, frames of Arrow batches."""

from __future__ import annotations

import weakref
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
# ``bytes.split()`` without arguments splits at exactly these six.
WORD = r"[^\x20\x09-\x0D]+"
MAX_CACHED_WORDS = 200_000  # per Python worker; twice as many for a moment


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def utf8(column: pa.Array) -> list[bytes | None]:
    """Values of a string column as bytes."""
    return column.cast(pa.binary()).to_pylist()


def map_batches(
    df: DataFrame, rows: Callable[[pa.RecordBatch], Iterable[dict[str, Any]]], schema: str | StructType
) -> DataFrame:
    """``df`` through a function from an Arrow batch to frames given as ``{column: values}``."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches("words")
        for batch in batches:
            for out in rows(batch):
                columns = [pa.array(out[field.name], field.type) for field in arrow]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(run, fields)


_caches: list[weakref.ref[Cache]] = []


def release_caches(user: str) -> None:
    """Empty the caches of other operators: a Python worker serves one after the other, and its memory holds one's words."""
    alive = [(ref, cache) for ref in _caches if (cache := ref()) is not None]
    _caches[:] = [ref for ref, _ in alive]
    for _, cache in alive:
        if cache._user != user:
            cache.clear()
            cache._older = {}


class Cache(dict):
    """Function of a word, remembered for the last ``limit`` to ``2 * limit`` different words."""

    def __init__(self, function: Callable[[Any], Any], limit: int = MAX_CACHED_WORDS, user: str = "words"):
        super().__init__()
        self._function, self._limit, self._older, self._user = function, limit, {}, user
        _caches.append(weakref.ref(self))

    def __missing__(self, word: Any) -> Any:
        value = self._older.get(word)
        return self.learn(word, self._function(word) if value is None else value)

    def learn(self, word: Any, value: Any) -> Any:
        if len(self) >= self._limit:
            self._older = dict(self)
            self.clear()
        self[word] = value
        return value

    def unknown(self, words: Iterable[Any]) -> list[Any]:
        """The different words without a value; those about to be forgotten are kept."""
        new = {word for word in words if word not in self}
        older = self._older
        for word in new & older.keys():
            self.learn(word, older[word])
        return list(new.difference(older))


_word_hash = Cache(xxhash.xxh3_64_intdigest)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_word_hash.__getitem__, words), np.uint64, len(words))


def _odd_constants(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``; one-to-one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_PLACES = _odd_constants(64, 11)


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of ``size`` words; none if there are fewer words."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.full(count, np.uint64(size))
    for place in range(size):
        total += hashes[place : place + count] * _PLACES[place]
    return mix(total)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def fold_case(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def seeded_order(column: Column, seed: int) -> Column:
    """A fixed random order of rows."""
    return F.xxhash64(column, F.lit(seed))
