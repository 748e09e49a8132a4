"""Phrase collocations from sorted streams of n-gram counts, in the layout of external stream estimation."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymark.session import stored

WORDS = 3  # longest phrase
_LOWEST_SCORE = 1_000_000  # the scale of a score

# Fixed by the operator's contract: characters that end a piece of text, each stands as a word of its own from then on.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_BREAK = b"."
_NORMAL = bytes.maketrans(_ENDS + b"\t", _BREAK * len(_ENDS) + b" ")
_READ_BYTES = 4 << 20
_LOW = re.compile(rb"[\x00-\x08]")
_RAISED = re.compile(rb",(.)", re.DOTALL)


class Mining(NamedTuple):
    """``least``: occurrences of a candidate; ``covered_per_cent``: share of them that a longer candidate must hold to replace
    it; ``top``: phrases per language; ``block_words``: words that are counted in memory before their counts are
    exchanged, below 2^21; ``salts``: parts in which a language is ranked first."""

    least: int = 10
    covered_per_cent: int = 50
    top: int = 2000
    block_words: int = 500_000
    salts: int = 32


# --- keys ------------------------------------------------------------------------------------------------------------
#
# An n-gram is the binary ``lang TAB word TAB word TAB word``, missing words empty. No word holds a tab, and the bytes below it
# are written as a comma, which no word holds either, and a digit. So all n-grams that begin alike lie next to each other,
# a phrase before its extensions. ``back`` has the words in reverse.


def _escaped(lang: str | None) -> bytes:
    return b"und" if lang is None else lang.encode("utf-8", "surrogatepass").replace(b"%", b"%25").replace(b"\t", b"%09")


def _unescaped(lang: bytes) -> bytes:
    return lang.replace(b"%09", b"\t").replace(b"%25", b"%")


def _raised(text: bytes) -> bytes:
    return _LOW.sub(lambda low: b",%d" % low[0][0], text) if _LOW.search(text) else text


def _lowered(phrase: bytes) -> bytes:
    return _RAISED.sub(lambda digit: bytes([int(digit[1])]), phrase) if b"," in phrase else phrase


def _join(*parts) -> pa.Array:
    return pc.binary_join_element_wise(*parts, b"\t")


def _parts(keys: pa.Array) -> list[pa.Array]:
    """Language and three words of each key."""
    lists = pc.split_pattern(keys, b"\t")
    return [pc.list_element(lists, i) for i in range(WORDS + 1)]


# --- counting --------------------------------------------------------------------------------------------------------


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """Words with A-Z in lower case, and a break for every character that ends a piece, a few megabytes at a time."""
    text, start = _raised(text.lower().translate(_NORMAL)), 0  # bytes.lower() changes A-Z only
    while start < len(text):
        end = text.find(b" ", start + _READ_BYTES)
        end = len(text) if end < 0 else end
        yield text[start:end].replace(_BREAK, b" . ").split()
        start = end


def counted(words: list[bytes]) -> tuple[list[pa.Array], np.ndarray]:
    """The different trigrams that begin at any word but the last two of the list, and their numbers, in the order of their
    bytes. A trigram ends at a break, its missing words are empty."""
    encoded = pa.array(words, pa.binary()).dictionary_encode()
    order = pc.sort_indices(encoded.dictionary)
    names = pa.concat_arrays([pa.array([b""], pa.binary()), encoded.dictionary.take(order)])
    places = np.empty(len(order), np.int64)
    places[order.to_numpy()] = np.arange(1, len(names))
    if (ends := pc.index(encoded.dictionary, pa.scalar(_BREAK, pa.binary())).as_py()) >= 0:
        places[ends] = 0
    ids = places[encoded.indices.to_numpy()]
    first, second, third = ids[:-2], ids[1:-1], ids[2:].copy()
    third[second == 0] = 0
    begins = first != 0
    base = len(names)
    values, numbers = np.unique(((first * base + second) * base + third)[begins], return_counts=True)
    columns = [values // (base * base), values // base % base, values % base]
    return [names.take(pa.array(column)) for column in columns], numbers


def _streams(how: Mining):
    """Texts to counts of trigrams, combined over ``block_words`` words at a time. They leave in the order of their keys, so
    what sorts them later merges runs."""

    def flush(held: dict[bytes, list[bytes]]) -> Iterator[pa.RecordBatch]:
        for lang, words in sorted(held.items(), key=lambda item: item[0]):
            if len(words) > 2:
                grams, numbers = counted(words)
                for start in range(0, len(numbers), 65_536):
                    cut = slice(start, start + 65_536)
                    keys = _join(pa.scalar(lang, pa.binary()), *[w[cut] for w in grams])
                    columns = [keys.view(pa.string()), pa.array(numbers[cut], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "n"])
            held[lang] = words[-2:]  # their trigrams may go on

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[bytes]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                lang = _escaped(lang)
                for words in tokens(text.as_py() or b""):
                    for start in range(0, len(words), how.block_words):
                        held.setdefault(lang, []).extend(words[start : start + how.block_words])
                        size += min(how.block_words, len(words) - start)
                        if size >= how.block_words:
                            yield from flush(held)
                            size = 0
                held.setdefault(lang, []).extend([_BREAK, _BREAK])
        yield from flush(held)

    return run


def _levels(least: int):
    """Sorted counts of trigrams to the counts of all that begin them: languages, words, pairs, trigrams.

    A range's first and last groups may go on in its neighbours and leave it whatever their number.
    """

    def rows(parts: list[pa.Array], sums: np.ndarray, level: int) -> pa.RecordBatch:
        empty = pa.scalar(b"", pa.binary())
        key = _join(*[parts[i] if i <= level else empty for i in range(WORDS + 1)])
        words = [*reversed(parts[1 : level + 1]), *[empty] * (WORDS - level)]
        columns = [key, _join(parts[0], *words), pa.array(np.full(len(sums), level, np.int32)), pa.array(sums)]
        return pa.RecordBatch.from_arrays(columns, ["key", "back", "size", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = WORDS + 1
        open_groups: list = [None] * width  # per level: parts and sum of the group that may go on
        started = [False] * width  # whether the first group of the range has left
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = batch.column(1).to_numpy()
            parts = pc.split_pattern(batch.column(0).cast(pa.binary()), b"\t").flatten()  # a row's stand in sequence
            new = np.ones((batch.num_rows, width), bool)
            new[1:] = pc.not_equal(parts[width:], parts[:-width]).to_numpy(zero_copy_only=False).reshape(-1, width)
            new = np.logical_or.accumulate(new, axis=1)
            for level in range(width):
                starts = np.flatnonzero(new[:, level])
                sums = np.add.reduceat(numbers, starts)
                if open_groups[level] is not None:
                    before, total = open_groups[level]
                    if parts[: level + 1].to_pylist() == before:
                        sums[0] += total
                    else:
                        if (total >= least or not started[level]) and (not level or before[level]):
                            yield rows([pa.array([p], pa.binary()) for p in before], np.array([total]), level)
                        started[level] = True
                starts *= width
                open_groups[level] = parts[starts[-1] : starts[-1] + level + 1].to_pylist(), sums[-1]
                leaves = sums[:-1] >= least
                if not started[level] and len(leaves):
                    leaves[0] = started[level] = True
                at, sums = starts[:-1][leaves], sums[:-1][leaves]
                heads = [parts.take(pa.array(at + i)) for i in range(level + 1)]
                if level:  # an empty word stands for the end of a piece
                    some = pc.not_equal(heads[level], b"")
                    heads, sums = [h.filter(some) for h in heads], sums[some.to_numpy(zero_copy_only=False)]
                if len(sums):
                    yield rows(heads, sums, level)
        for level, group in enumerate(open_groups):
            if group is not None and (not level or group[0][level]):
                yield rows([pa.array([p], pa.binary()) for p in group[0]], np.array([group[1]]), level)

    return run


def gram_counts(docs: DataFrame, how: Mining = Mining()) -> DataFrame:
    """``key, back, size, n`` of all n-grams of ``docs(lang, text)`` with ``least`` occurrences, and of the languages (size 0).

    Trigrams alone are exchanged: sorted from the front, they hold the counts of what begins them. A part of a phrase
    occurs as often as the phrase, so nothing that a candidate needs is left out.
    """
    texts = docs.select(F.col("lang").cast("string"), "text")
    # As strings, not checked to be UTF-8: Spark compares them where they lie, and copies binaries for each comparison.
    trigrams = texts.mapInArrow(_streams(how), "key string, n bigint")
    ordered = trigrams.repartitionByRange("key").sortWithinPartitions("key")
    pieces = ordered.mapInArrow(_levels(how.least), "key binary, back binary, size int, n bigint")
    sums = pieces.groupBy("key", "back", "size").agg(F.sum("n").alias("n"))
    return stored(sums.where((F.col("n") >= how.least) | (F.col("size") == 0)))


# --- joining the streams ---------------------------------------------------------------------------------------------


def _lockstep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of a sorted stream: each phrase meets the counts of its first word and of its first two words, and a pair
    the highest count of its extensions. The three streams advance together; only the open word and pair are held."""
    place, word, pair = None, 0, None
    for batch in batches:
        out: list[tuple] = []
        columns = [batch.column(name).to_pylist() for name in ("range", "key", "size", "n")]
        for at, key, size, n in zip(*columns, strict=True):
            if size < 3 or at != place:
                if pair is not None:
                    out.append(pair)
                place, pair = at, None
            if size == 1:
                word = n
            elif size == 2:
                pair = (key, n, word, 0, 0)
            elif size == 3:
                out.append((key, n, word, pair[1], 0))
                pair = (*pair[:4], max(pair[4], n))
        yield _as_batch(out)
    yield _as_batch([] if pair is None else [pair])


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), *[pa.int64()] * 4]
    columns = list(zip(*rows)) if rows else [()] * 5
    arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, ["key", "n", "by_word", "by_pair", "longer"])


def in_order(counts: DataFrame, order: str) -> DataFrame:
    """``key, n, by_word, by_pair, longer`` of the phrases, in the order ``key`` (from the front) or ``back`` (from the end).

    Rows are dealt out by ranges of the order, so a frequent word covers several. What begins a range's first row lies in an
    earlier range and is brought along; ``longer`` may thus come in several parts, the highest counts.
    """
    ranged = counts.where("size > 0").repartitionByRange(order).withColumn("range", F.spark_partition_id())
    placed = stored(ranged.select("key", F.col(order).alias("sorted"), "size", "n", "range"))
    heads = placed.groupBy("range").agg(F.min("sorted").alias("head"))
    begins = heads.mapInArrow(_beginnings, "range int, sorted binary")
    brought = begins.join(placed.drop("range"), "sorted").select(*placed.columns)
    rows = placed.union(brought).repartition("range").sortWithinPartitions("range", "sorted")
    return rows.select("range", "key", "size", "n").mapInArrow(
        _lockstep, "key binary, n bigint, by_word bigint, by_pair bigint, longer bigint"
    )


def _beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of the word and the pair that begin a range's first key, if that is another one."""
    for batch in batches:
        lang, one, two, _ = _parts(batch.column(1))
        empty = pa.scalar(b"", pa.binary())
        for keys in (_join(lang, one, empty, empty), _join(lang, one, two, empty)):
            rows = pa.RecordBatch.from_arrays([batch.column(0), keys], ["range", "sorted"])
            yield rows.filter(pc.not_equal(keys, batch.column(1)))


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lowest-scoring cut of each phrase, in whole numbers of any length."""
    names = ["lang", "phrase", "a", "l", "r", "score"]
    kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 4]
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            a, lang, *words = row["n"], *row["key"].split(b"\t")
            if words[2]:
                cuts = [(row["first"], row["last_pair"]), (row["first_pair"], row["last"])]
            else:
                cuts = [(row["first"], row["last"])]
            scores = [_LOWEST_SCORE * a * a // (left * right) for left, right in cuts]
            k = scores.index(min(scores))
            out.append((_unescaped(lang), _lowered(b" ".join(filter(None, words))), a, *cuts[k], scores[k]))
        columns = list(zip(*out)) if out else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names)


def candidates(counts: DataFrame, how: Mining = Mining()) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of every phrase that no longer one replaces."""
    none = F.lit(0).cast("bigint")
    front = in_order(counts, "key").select(
        "key", "n", F.col("by_word").alias("first"), F.col("by_pair").alias("first_pair"),
        none.alias("last"), none.alias("last_pair"), "longer",
    )
    back = in_order(counts, "back").select(
        "key", "n", none.alias("first"), none.alias("first_pair"),
        F.col("by_word").alias("last"), F.col("by_pair").alias("last_pair"), "longer",
    )
    measures = ["first", "first_pair", "last", "last_pair", "longer"]
    both = front.union(back).groupBy("key", "n").agg(*[F.max(m).alias(m) for m in measures])
    free = both.where(100 * F.col("longer") < how.covered_per_cent * F.col("n")).drop("longer")
    found = free.mapInArrow(_scored, "lang binary, phrase binary, a bigint, l bigint, r bigint, score bigint")
    return found.withColumns({"lang": F.col("lang").cast("string"), "phrase": F.col("phrase").cast("string")})


def mined(docs: DataFrame, how: Mining = Mining()) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of two or three words per language of ``docs(lang, text)``.

    Texts, A-Z in lower case, fall into pieces at ``. , ; : ! ?`` and at line ends, pieces into words at blanks and tabs. A
    phrase with ``a`` occurrences, ``least`` or more, is cut in two; ``l`` and ``r`` are the occurrences of the parts and the
    score is the millionfold of a * a / (l * r), rounded down, of the lowest-scoring cut. A phrase goes if a longer one of
    ``least`` occurrences holds it and has ``covered_per_cent`` of its occurrences. ``n`` counts a language's words. Ranks go
    by score, occurrences and the phrase's bytes.

    1. Blocks of words are counted in memory; their trigrams, sorted from the front, stream through ranges that add up
       what begins them. A frequent word or pair covers several ranges.
    2. Counts in the order of their first words and, once more, of their last words are read in lockstep, which gives each
       phrase the counts of its parts and of its extensions. Nothing is looked up by hash.
    3. Languages are ranked in parts, then the best of the parts.

    A NULL language is ``und``, NULL and blank texts have no words; every row counts, also one that repeats another. Long
    texts are read a few megabytes at a time. Bytes that are no UTF-8 are part of their word.
    """
    counts = gram_counts(docs, how)
    sizes = counts.where("size = 0").select(F.col("key").alias("lang_key"), F.col("n"))
    words = sizes.mapInArrow(_languages, "lang binary, n bigint").withColumn("lang", F.col("lang").cast("string"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = Window.partitionBy("lang", "salt").orderBy(*order)
    whole = Window.partitionBy("lang").orderBy(*order)
    dealt = candidates(counts, how).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(how.salts)))
    best = dealt.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= how.top)
    ranked = best.withColumn("rank", F.row_number().over(whole).cast("bigint")).where(F.col("rank") <= how.top)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _languages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [_unescaped(key.split(b"\t")[0]) for key in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), batch.column(1)], ["lang", "n"])
