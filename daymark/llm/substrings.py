"""Removal of passages that an earlier document holds already: winnowed seeds, extended to maximal matches."""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import gram_hashes, map_batches, signed, utf8, word_hashes
from daymark.session import stored


class Passages(NamedTuple):
    """``window``: words a repeat must have; ``seed``: words of an anchor. Any common run of ``window`` words has an
    anchor at the same place in both documents."""

    window: int = 50
    seed: int = 20


class Repeats(NamedTuple):
    """``spans(doc_id, starts, ends)``: word positions to remove, from start up to end, overlapping in part.
    ``texts(doc_id, text)`` holds at least the documents with spans."""

    spans: DataFrame
    texts: DataFrame


def words_of(text: bytes | None) -> list[bytes]:
    return text.split() if text else []


def winnow(hashes: np.ndarray, how: Passages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a document: their hashes, word positions, and the number of the first window of each.

    Every window has one anchor, its smallest seed hash and the first of equal ones, so that equal windows have equal
    anchors at equal places. Windows with the same anchor follow each other.
    """
    seeds = gram_hashes(hashes, how.seed)
    span = how.window - how.seed + 1
    if len(seeds) < span:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    places = np.lib.stride_tricks.sliding_window_view(seeds, span).argmin(1) + np.arange(len(seeds) - span + 1)
    places, first_windows = np.unique(places, return_index=True)
    return seeds[places], places, first_windows


def _anchors(how: Passages):
    def rows(batch: pa.RecordBatch):
        ids, hashes, places = [], [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
            found, at, _ = winnow(word_hashes(words_of(text)), how)
            ids.append(np.full(len(at), doc_id, np.int64))
            hashes.append(signed(found))
            places.append(at.astype(np.int32))
        if ids:
            yield {name: np.concatenate(x) for name, x in (("doc_id", ids), ("anchor", hashes), ("place", places))}

    return rows


def _agreeing(one: np.ndarray, other: np.ndarray) -> int:
    """Number of leading elements that are equal."""
    length, start, step = min(len(one), len(other)), 0, 64
    while start < length:
        differs = one[start : min(start + step, length)] != other[start : min(start + step, length)]
        if differs.any():
            return start + int(differs.argmax())
        start, step = start + step, step * 2
    return length


def maximal_match(one: np.ndarray, p: int, other: np.ndarray, q: int) -> tuple[int, int]:
    """The longest run of equal words through ``one[p]`` and ``other[q]``, as positions in ``one``."""
    return p - _agreeing(one[:p][::-1], other[:q][::-1]), p + _agreeing(one[p:], other[q:])


def _extend(how: Passages):
    """Matches of a document with the first holder of its anchors, and the windows which that left open."""

    def rows(batch: pa.RecordBatch):
        ids, earlier, seeds = (batch.column(i).to_pylist() for i in range(3))
        texts, firsts = utf8(batch.column(3)), utf8(batch.column(4))
        held, held_text = np.empty(0, np.uint64), None
        for doc_id, first_id, places, text, first_text in zip(ids, earlier, seeds, texts, firsts, strict=True):
            hashes = word_hashes(words_of(text))
            if first_text != held_text:
                held, held_text = word_hashes(words_of(first_text)), first_text
            anchors, at, first_windows = winnow(hashes, how)
            last_windows = np.append(first_windows[1:], len(hashes) - how.window + 1) - 1
            number = {place: i for i, place in enumerate(at.tolist())}
            spans: dict[int, tuple[int, int]] = {}
            found, open_windows, open_anchors = [], [], []
            for seed in sorted(places, key=lambda s: (s["place"], s["first_place"])):
                p, q = seed["place"], seed["first_place"]
                if p not in number:  # only if rows of one id differ
                    continue
                low, high = int(first_windows[number[p]]), int(last_windows[number[p]])
                start = end = p
                if doc_id != first_id:
                    start, end = spans.get(p - q, (0, 0))
                    if not start <= p < end:
                        start, end = spans[p - q] = maximal_match(hashes, p, held, q)
                        if end - start >= how.window:
                            found.append((start, end))
                # Windows from ``start`` to ``end - window`` lie in the match.
                matched = max(start, end - how.window + 1)
                left = [*range(low, min(high + 1, start)), *range(max(low, matched), high + 1)]
                open_windows += left
                open_anchors += [anchors[number[p]]] * len(left)
            windows = gram_hashes(hashes, how.window)[open_windows] if open_windows else np.empty(0, np.uint64)
            yield {
                "doc_id": [doc_id],
                "starts": [[s for s, _ in found]],
                "ends": [[e for _, e in found]],
                "windows": [signed(windows)],
                "anchors": [signed(np.array(open_anchors, np.uint64))],
                "places": [np.array(open_windows, np.int32)],
            }

    return rows


def repeats(docs: DataFrame, how: Passages = Passages()) -> Repeats:
    """Words of ``docs(doc_id, text)`` in a run of ``window`` words that also stands in a document with a smaller id.

    1. Every document gives its anchors; an anchor in several documents is a seed of a match.
    2. A document is compared with the smallest id that has its anchor: the match is extended both ways as far as the
       words agree, and kept if it has ``window`` words or more. Partners per anchor are one, however many share it.
    3. What that leaves open is where another document than the smallest could agree further. Those windows alone are
       grouped by their hash (with the anchor's: 128 bits), and the smallest id of each group decides.

    All documents are judged on the input. NULL, empty and short texts have no windows. Documents without an id are
    neither cut nor the reason for a cut. Rows that repeat an id must have the same text.
    """
    docs = docs.select("doc_id", "text")
    anchors = stored(
        map_batches(docs.where("doc_id IS NOT NULL"), _anchors(how), "doc_id bigint, anchor bigint, place int")
    )
    holders = anchors.groupBy("anchor").agg(
        F.min("doc_id").alias("first_id"),
        F.min_by("place", "doc_id").alias("first_place"),
        F.max("doc_id").alias("last_id"),
    )
    holders = stored(holders.where("first_id < last_id").drop("last_id"))
    # Where the first holder has an anchor twice, its other places only take part in step 3.
    seeds = anchors.join(holders, "anchor").where("doc_id != first_id OR place != first_place")
    seeds = stored(
        seeds.groupBy("doc_id", "first_id").agg(F.collect_set(F.struct("place", "first_place")).alias("places"))
    )
    ids = stored(seeds.select("doc_id").union(seeds.select("first_id")).distinct())
    texts = stored(docs.join(ids.hint("shuffle_hash"), "doc_id").select("doc_id", "text").dropDuplicates(["doc_id"]))
    both = seeds.join(texts, "doc_id").join(texts.toDF("first_id", "first_text"), "first_id")
    extended = stored(
        map_batches(
            both.select("doc_id", "first_id", "places", "text", "first_text"),
            _extend(how),
            "doc_id bigint, starts array<int>, ends array<int>, windows array<bigint>, anchors array<bigint>, "
            "places array<int>",
        )
    )
    left = extended.select("doc_id", F.explode(F.arrays_zip("windows", "anchors", "places")).alias("w"))
    left = left.select("doc_id", "w.windows", "w.anchors", "w.places")
    first = left.groupBy("windows", "anchors").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    first = stored(first.where("first_id < last_id"))
    others = left.join(first, ["windows", "anchors"]).where("doc_id > first_id")
    pieces = extended.select("doc_id", F.explode(F.arrays_zip("starts", "ends")).alias("s")).select(
        "doc_id", F.col("s.starts").alias("start"), F.col("s.ends").alias("end")
    )
    pieces = pieces.union(others.select("doc_id", "places", F.col("places") + how.window)).distinct()
    spans = pieces.groupBy("doc_id").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    return Repeats(stored(spans), texts)


def kept_words(words: list[bytes], starts: list[int], ends: list[int]) -> list[bytes]:
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, np.minimum(starts, len(words)), 1)
    np.add.at(change, np.minimum(ends, len(words)), -1)
    inside = np.cumsum(change[:-1]) > 0
    return [word for word, cut in zip(words, inside.tolist(), strict=True) if not cut]


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _whole(batch: pa.RecordBatch):
    words = [words_of(text) for text in utf8(batch.column(1))]
    yield {"doc_id": batch.column(0), "n_words": [len(w) for w in words], "whole": [_digest(w) for w in words]}


def _cut(batch: pa.RecordBatch):
    out: dict = {"doc_id": batch.column(0), "kept": [], "removed": []}
    for text, starts, ends in zip(utf8(batch.column(1)), *(batch.column(i).to_pylist() for i in (2, 3)), strict=True):
        words = words_of(text)
        kept = kept_words(words, starts, ends)
        out["kept"].append(b" ".join(kept).decode())
        out["removed"].append(len(words) - len(kept))
    yield out


def cut_texts(found: Repeats) -> DataFrame:
    """``doc_id, kept, removed``: the words left, joined by a space, and the number removed, of documents with spans."""
    both = found.texts.join(found.spans, "doc_id").select("doc_id", "text", "starts", "ends")
    return map_batches(both, _cut, "doc_id bigint, kept string, removed bigint")


def removal_report(docs: DataFrame, how: Passages = Passages()) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row."""
    whole = map_batches(docs.select("doc_id", "text"), _whole, "doc_id bigint, n_words bigint, whole string")
    changed = cut_texts(repeats(docs, how))
    changed = changed.select("doc_id", "removed", F.sha2("kept", 256).alias("digest"))
    return whole.join(stored(changed), "doc_id", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("digest", "whole").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, how: Passages = Passages()) -> DataFrame:
    """``docs`` with repeated passages removed from ``text``; all rows and columns stay, ``n_chars`` follows the text.

    Texts with nothing to remove are left as they are, white space included.
    """
    changed = stored(cut_texts(repeats(docs, how))).select(F.col("doc_id").alias("_id"), F.col("kept").alias("_kept"))
    # Columns of the input go by their place on the way, so that none of them can clash with what is added.
    places = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.toDF(*places.values())
    joined = rows.join(changed, rows[places["doc_id"]] == changed["_id"], "left")
    new = {"text": F.coalesce("_kept", places["text"])}
    if "n_chars" in places:
        length = F.length("_kept").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.coalesce(length, places["n_chars"])
    return joined.select(*[new.get(c, F.col(place)).alias(c) for c, place in places.items()])
