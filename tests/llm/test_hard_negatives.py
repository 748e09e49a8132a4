"""Hard negatives against a search of all rows."""

from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymark.llm import hard_negatives
from daymark.llm.hard_negatives import Mining, bounds, dot, hilbert, packed, unpacked

SCHEMA = "vec_id bigint, label bigint, vector array<bigint>, anchor boolean, size string, place int, block int, `group` int"


def plain(rows, how):
    first = {}
    for vec_id, label, vector, anchor in rows:
        if vec_id is None or label is None or vector is None or None in vector:
            continue
        first[vec_id] = min(first.get(vec_id, (label, vector, anchor)), (label, vector, anchor))
    out = []
    for a, (label, vector, anchor) in first.items():
        if not anchor:
            continue
        scores = [
            (max(-(2**63), min(sum(x * y for x, y in zip(vector, v)), 2**63 - 1)), other == label, b)
            for b, (other, v, _) in first.items()
            if b != a and len(v) == len(vector)
        ]
        order = sorted(scores, key=lambda s: (-s[0], s[2]))
        for p, _, positive in [s for s in order if s[1]][: how.positives]:
            fits = [s for s in order if not s[1] and how.low_per_cent * p <= 100 * s[0] <= 100 * p]
            for rank, (score, _, negative) in enumerate(fits[: how.negatives], 1):
                out.append((a, positive, rank, negative, p, score))
    return sorted(out)


def mined(spark, rows, how):
    docs = spark.createDataFrame([(*row, "s", 1, 2, 3) for row in rows], SCHEMA)
    return sorted(tuple(row) for row in hard_negatives.mined(docs, how).collect())


def clustered(rng, n, size, labels=4):
    centres = rng.normal(0, 100, (5, size))
    x = centres[rng.integers(0, 5, n)] + rng.normal(0, 30, (n, size))
    return [(i, int(rng.integers(0, labels)), [int(v) for v in row], i % 7 == 0) for i, row in enumerate(x)]


@pytest.mark.parametrize("how", [Mining(), Mining(block=8, group=3, zones=4, slots=2, seeds=1, low_per_cent=95)])
def test_equals_search_of_all(spark, how):
    rng = np.random.default_rng(how.block)
    rows = clustered(rng, 300, 8)
    found = mined(spark, rows, how)
    assert found == plain(rows, how) and len(found) > 100


def test_ties_edges_and_large_numbers(spark):
    rows = [(i, i % 2, [1, 2, 0], i in (0, 3)) for i in range(20)]  # all equal
    rows += [(None, 1, [1, 2, 0], True), (20, None, [1, 2, 0], True), (21, 1, None, True), (22, 1, [1, None, 0], True)]
    rows += [(3, 1, [1, 2, 0], True), (4, 1, [9, 9, 9], False)]  # repeated rows and ids
    rows += [(30 + i, i % 2, [], True) for i in range(4)]  # no components
    rows += [(40 + i, i % 2, [5], True) for i in range(3)]
    rows += [(50 + i, i % 2, [2**40 + i, -(2**45)], True) for i in range(6)]  # beyond 64 bits
    rows += [(60 + i, i % 3, [-100, 3 * i, 0, 0], i == 0) for i in range(6)]
    rows += [(70 + i, i % 2, [(-1) ** i * 7, 0, 0, 0, 0], True) for i in range(4)]  # scores below 0
    assert mined(spark, rows, Mining()) == plain(rows, Mining())
    assert mined(spark, rows, Mining(block=2, group=1, zones=1, slots=1)) == plain(rows, Mining())
    empty = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mined(empty).collect() == []
    assert mined(spark, [(1, 1, [1], False), (2, 2, [1], False)], Mining()) == []


def test_blocks_that_cannot_matter_are_not_read(spark):
    """Two far clusters: an anchor of one has no need of the other's blocks."""
    rng = np.random.default_rng(0)
    rows = [
        (i, int(rng.integers(0, 3)), [int(v) for v in rng.normal(1000 * (-1) ** (i % 2), 20, 6)], i % 10 == 0) for i in range(400)
    ]
    how = Mining(block=16, group=4)
    docs = spark.createDataFrame([(*row, "s", 1, 2, 3) for row in rows], SCHEMA).select("vec_id", "label", "anchor", "vector")
    index = hard_negatives.Index.of(docs, how)
    windows = index.groups.select(
        "group", F.explode(hard_negatives._numbers(F.col("n"))).alias("i"), F.lit(0).cast("bigint").alias("positive_id"),
        F.lit(True).alias("same"), F.lit(1).cast("bigint").alias("low"), F.lit(2**62).alias("high"),
    )
    pairs = index.needed(index.with_windows(windows)).count()
    assert 0 < pairs <= 0.6 * index.groups.count() * index.blocks.count()
    assert mined(spark, rows, how) == plain(rows, how)


@pytest.mark.parametrize(("axes", "bits"), [(2, 4), (3, 3), (5, 2), (1, 4)])
def test_curve_visits_neighbours(axes, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
    places = hilbert(points, bits)
    assert sorted(places.tolist()) == list(range(len(points)))
    steps = np.abs(np.diff(points[np.argsort(places)], axis=0)).sum(1)
    assert (steps == 1).all()


def test_bounds_hold_and_numbers_pack():
    rng = np.random.default_rng(1)
    x, a = rng.integers(-50, 50, (40, 6)), rng.integers(-50, 50, (7, 6))
    least, most = bounds(a, x.min(0)[None], x.max(0)[None])
    scores = dot(a, x)
    assert (scores >= least).all() and (scores <= most).all()
    for numbers in (x, x * 2**40, np.zeros((0, 3), np.int64), np.zeros((3, 0), np.int64)):
        assert (unpacked(packed(numbers), *numbers.shape) == numbers).all()
    large = np.array([[2**62, 2**62]])
    assert dot(large, large)[0, 0] == 2**63 - 1 and dot(large, -large)[0, 0] == -(2**63)


def test_quantised(spark):
    rows = [(1, [0.5, -0.001]), (2, [float("nan")]), (3, [float("inf"), 1.0]), (4, [None]), (5, None), (6, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = {r["vec_id"]: r["q"] for r in df.select("vec_id", hard_negatives.quantised("embedding").alias("q")).collect()}
    assert found == {1: [128, -1], 2: None, 3: None, 4: None, 5: None, 6: []}
