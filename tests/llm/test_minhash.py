from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from daymark.llm import minhash
from daymark.llm.components import components


def plain_components(edges):
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {x: find(x) for x in parent}


@pytest.mark.parametrize(
    "edges",
    [
        [],
        [(i, i + 1) for i in range(60)],
        [(100 - i, 99 - i) for i in range(60)] + [(7, 7)],
        [(500, i) for i in range(50)] + [(500, 900), (900, 3000), (3000, 4000)],
        [tuple(random.Random(seed).sample(range(200), 2)) for seed in range(150)],
    ],
)
def test_components(spark, edges):
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    wanted = plain_components([e for e in edges if e[0] != e[1]])
    assert {row["id"]: row["component"] for row in found} == wanted
    assert len(found) == len(wanted)


def plain_sets(texts):
    sets = {}
    for doc_id, text in texts:
        words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split() if w]
        size = min(5, len(words))
        sets[doc_id] = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()
    return sets


def near_copies(seed=4):
    """Copies with few to many words changed, so that similarities lie on both sides of the threshold."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for group in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([8, 60, 150]))]
        for _ in range(25):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append((len(texts), " ".join(words)))
    rng.shuffle(texts)
    return [(i, text) for i, (_, text) in enumerate(texts)]


def test_equals_all_pairs(spark):
    texts = near_copies()
    sets = plain_sets(texts)
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    wanted = {a: a for a in sets} | plain_components(links)
    found = minhash.near_duplicates(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["n_shingles"] for r in found} == {a: len(s) for a, s in sets.items()}
    assert {r["doc_id"]: r["component_id"] for r in found} == wanted
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_minima_and_maxima_estimate_similarity():
    rng = np.random.default_rng(0)
    shared, own = rng.integers(0, 1 << 63, 800, dtype=np.uint64), rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    one = minhash.extremes(np.unique(shared), 4000, 1)
    other = minhash.extremes(np.unique(np.concatenate([shared, own])), 4000, 1)
    assert abs((one == other).mean() - 0.8) < 0.03
    assert (one[::2] <= one[1::2]).all()


def test_blocks_meet_once(spark):
    """Small blocks give the same groups as large ones."""
    texts = spark.createDataFrame(near_copies(5), "doc_id bigint, text string")
    large = minhash.near_duplicates(texts).collect()
    small = minhash.near_duplicates(texts, minhash.MinMax(block=3)).collect()
    assert sorted(large) == sorted(small)


def test_stage_drops_near_copies_from_four_fifths(spark):
    """Runs of 100 shingles: two changed words leave 90 of 110 (0.82), three 85 of 115 (0.74)."""
    docs = []
    for group in range(40):
        words = [f"g{group}w{i}" for i in range(104)]
        changed = {20: "x", 60: "y"} if group % 2 else {20: "x", 50: "y", 80: "z"}
        docs.append((2 * group, " ".join(words)))
        docs.append((2 * group + 1, " ".join(changed.get(i, word) for i, word in enumerate(words))))
    sets = plain_sets(docs)
    overlaps = {i // 2: len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in range(0, 80, 2)}
    assert all((0.8 < s < 0.85) if group % 2 else s < 0.8 for group, s in overlaps.items())
    found = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(docs, "doc_id bigint, text string"), "").collect()
    assert sorted(r["doc_id"] for r in found) == [i for i in range(80) if i % 4 != 3]
    assert minhash.MinMax().per_cent == 85  # op2's
