from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from daymark.llm import substrings
from daymark.llm.common import word_hashes


def plain_removed(texts, window):
    lists = {doc_id: (text or "").split() for doc_id, text in texts}
    first = {}
    for doc_id, words in lists.items():
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            first[key] = min(first.get(key, doc_id), doc_id)
    kept = {}
    for doc_id, words in lists.items():
        gone = {
            i + k
            for i in range(len(words) - window + 1)
            if first[tuple(words[i : i + window])] < doc_id
            for k in range(window)
        }
        kept[doc_id] = [w for i, w in enumerate(words) if i not in gone]
    return kept


def passages(seed, letters):
    rng = random.Random(seed)
    shared = [[rng.choice(letters) for _ in range(rng.randint(5, 60))] for _ in range(12)]
    texts = []
    for doc_id in range(60):
        words = []
        for _ in range(rng.randint(0, 6)):
            piece = rng.choice(shared) if rng.random() < 0.6 else [rng.choice(letters) for _ in range(rng.randint(1, 30))]
            cut = rng.randrange(len(piece))
            words += piece[cut:] if rng.random() < 0.3 else piece
        texts.append((doc_id * 3 + 1, " ".join(words)))
    return texts


@pytest.mark.parametrize(("seed", "letters"), [(1, "abcdefghijklmnopqrstuvwxyz"), (2, "ab"), (3, "a"), (4, "abcd")])
def test_equals_all_windows(spark, seed, letters):
    texts = passages(seed, letters)
    how = substrings.Passages(window=10, seed=4)
    found = substrings.removal_report(spark.createDataFrame(texts, "doc_id bigint, text string"), how).collect()
    wanted = plain_removed(texts, 10)
    for row, (doc_id, text) in zip(sorted(found), texts, strict=True):
        assert row["doc_id"] == doc_id and row["n_words"] == len(text.split())
        assert row["n_removed"] == row["n_words"] - len(wanted[doc_id])
        assert row["kept_sha256"] == hashlib.sha256(" ".join(wanted[doc_id]).encode()).hexdigest()


def test_every_window_has_its_smallest_seed():
    words = [random.Random(5).choice("abc").encode() for _ in range(300)]
    how = substrings.Passages(window=12, seed=5)
    _, places, firsts = substrings.winnow(word_hashes(words), how)
    assert firsts[0] == 0 and (np.diff(firsts) > 0).all()
    governed = np.repeat(places, np.diff(np.append(firsts, 300 - 12 + 1)))
    assert ((governed >= np.arange(289)) & (governed + 5 <= np.arange(289) + 12)).all()


def test_extension_is_maximal():
    one = word_hashes("x a b c d e y".encode().split())
    other = word_hashes("a b c d e z z".encode().split())
    assert substrings.maximal_match(one, 3, other, 2) == (1, 6)
    assert substrings.maximal_match(one, 0, one, 0) == (0, 7)
