"""Bin completion: every piece in one place, few bins, exact ids."""

from __future__ import annotations

import random
import struct
import zlib
from collections import Counter

import pytest
from tokenizers import Tokenizer

from daymark.llm import bin_packing
from daymark.llm.bin_packing import Filling, Remaining, best_fit, filled, least_bins, packed_sizes

FOLDER = "/root/testdata/sf0.001"


def fewest_bins(sizes, capacity):
    """Over all ways to place the pieces."""
    best = len(sizes)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for room in {r for r in rooms if r >= sizes[i]}:
            at = rooms.index(room)
            place(i + 1, [*rooms[:at], room - sizes[i], *rooms[at + 1 :]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    sizes = sorted(sizes, reverse=True)
    place(0, [])
    return best


def number(runs):
    return sum(times for times, _ in runs)


def holds(runs, counts, capacity):
    pieces = Counter()
    for times, held in runs:
        assert times > 0 and filled(held) <= capacity
        for size, n in held:
            pieces[size] += n * times
    return pieces == +Counter(counts)


@pytest.mark.parametrize("seed", range(60))
def test_small_instances_are_optimal(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 20, 50, 100])
    sizes = [rng.randint(1, capacity - 1) for _ in range(rng.randint(1, 10))]
    how, counts = Filling(capacity=capacity), Counter(sizes)
    found = packed_sizes(counts, how)
    assert holds(found, counts, capacity)
    assert least_bins(counts, capacity) <= fewest_bins(sizes, capacity) == number(found)


def test_search_beats_best_fit():
    counts, how = Counter({6: 1, 5: 2, 4: 1, 3: 1, 2: 1, 7: 1, 8: 1}), Filling(capacity=20)
    rng = random.Random(3)
    better = 0
    for _ in range(40):
        counts = Counter(rng.randint(1000, 1700) for _ in range(300))
        incumbent, found = best_fit(Remaining(counts), 4096), packed_sizes(counts, Filling())
        assert holds(found, counts, 4096) and least_bins(counts, 4096) <= number(found) <= number(incumbent)
        better += number(found) < number(incumbent)
    assert better > 30
    assert number(packed_sizes(Counter({6: 2, 4: 2, 5: 4}), how)) == 2


def test_no_steps_and_no_pieces():
    counts = Counter(range(1, 300))
    assert holds(packed_sizes(counts, Filling(capacity=300, steps=0)), counts, 300)
    assert packed_sizes({}, Filling()) == []
    assert sorted(packed_sizes({1: 5000}, Filling())) == [(1, ((1, 904),)), (1, ((1, 4096),))]


def plain(docs, how):
    """Pieces of each row by the library."""
    library = Tokenizer.from_file(how.tokenizer)
    out = Counter()
    for doc_id, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, how.end_id]
        for number, start in enumerate(range(0, len(ids), how.capacity)):
            cut = ids[start : start + how.capacity]
            out[doc_id, number, start, len(cut), zlib.crc32(struct.pack(f"<{len(cut)}I", *cut))] += 1
    return out


def check_places(rows, capacity):
    by_sequence = {}
    for row in rows:
        by_sequence.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


@pytest.mark.parametrize("how", [Filling(), Filling(capacity=64, shard=20), Filling(capacity=1, end_id=2)])
def test_pieces_of_a_table(spark, how):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60 if how.capacity < 4096 else 500)
    texts = [(row["doc_id"], row["text"]) for row in docs.collect()]
    rows = bin_packing.packing_report(docs, how).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == plain(texts, how)
    sequences, tokens = check_places(rows, how.capacity), sum(row["length"] for row in rows)
    if how == Filling():
        assert sequences == -(-tokens // 4096)


def test_edges(spark):
    rows = [(1, "a b c"), (1, "a b c"), (None, None), (None, "x"), (2, ""), (3, " \t\n"), (4, "word " * 20_000), (5, "<|endoftext|> é")]
    schema = "doc_id bigint, text string, place long, ids binary, piece string, shard int, sequence_id int, offset int"
    docs = spark.createDataFrame([(*row, 1, b"", "", 2, 3, 4) for row in rows], schema)
    found = bin_packing.packed(docs).collect()
    report = bin_packing.packing_report(docs).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in report) == plain(rows, Filling())
    assert all(len(row["ids"]) == 4 * row["length"] for row in found)
    check_places(found, 4096)
    assert bin_packing.packed(docs.limit(0)).collect() == []
    odd = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF2062' AS STRING) AS text")
    assert [row["length"] for row in bin_packing.packed(odd).collect()] != []
