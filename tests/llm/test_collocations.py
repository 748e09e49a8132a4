"""Phrases from sorted streams against a plain count."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from daymark.llm import collocations
from daymark.llm.collocations import Mining

SCHEMA = "doc_id bigint, lang string, text string, key string, n int, size int, range int, sorted string, phrase string"
EXTRA = ("k", 1, 2, 3, "s", "p")


def plain(rows, how):
    """The contract, word by word."""
    counts = defaultdict(Counter)
    for lang, text in rows:
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", folded):
            words = [w for w in re.split("[ \t]", piece) if w]
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts["und" if lang is None else lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(count for gram, count in f.items() if len(gram) == 1)
        found = {gram: a for gram, a in f.items() if len(gram) > 1 and a >= how.least}
        longer = Counter()
        for gram, a in found.items():
            if len(gram) == 3:
                for part in (gram[:2], gram[1:]):
                    longer[part] = max(longer[part], a)
        kept = []
        for gram, a in found.items():
            if 100 * longer[gram] >= how.covered_per_cent * a:
                continue
            cuts = [(1_000_000 * a * a // (f[gram[:k]] * f[gram[k:]]), k) for k in range(1, len(gram))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(gram).encode(), f[gram[:k]], f[gram[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[: how.top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


WORDS = ["the", "The", "of", "a", "Über", "naïve", "b\x01", "0%", "a%09", "\x00", "of,", "end.", "x;\ty", "\n"]


def texts(seed):
    import random

    rng = random.Random(seed)
    langs = ["en", "de", None, "und", "a\tb%09", ""]
    rows = [(rng.choice(langs), " ".join(rng.choices(WORDS, [9, 4, 5, 4, *[1] * 10], k=rng.randint(0, 60)))) for _ in range(150)]
    return [*rows, rows[0], ("en", None), ("en", " \t\r\n"), (None, "the " * 400 + "of the " * 200)]


@pytest.mark.parametrize("how", [Mining(least=3), Mining(least=2, block_words=7, top=5), Mining(covered_per_cent=90, salts=1)])
def test_equals_plain_count(spark, how):
    rows = texts(how.least)
    docs = spark.createDataFrame([(i, *row, *EXTRA) for i, row in enumerate(rows)], SCHEMA).repartition(5)
    found = [tuple(row) for row in collocations.mined(docs, how).collect()]
    assert Counter(found) == Counter(plain(rows, how)) and found


def test_long_texts_are_read_in_parts(monkeypatch):
    text = " ".join(f"w{i % 17}{'.' if i % 5 == 0 else ''}" for i in range(500)).encode()
    whole = [word for part in collocations.tokens(text) for word in part]
    monkeypatch.setattr(collocations, "_READ_BYTES", 20)
    parts = list(collocations.tokens(text))
    assert [word for part in parts for word in part] == whole and len(parts) > 50


def test_empty_and_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert collocations.mined(empty).collect() == []
    blank = spark.createDataFrame([(1, None, None, *EXTRA), (None, "en", " . ", *EXTRA)], SCHEMA)
    assert collocations.mined(blank).collect() == []
    odd = spark.sql("SELECT 'en' AS lang, CAST(X'61FF2062' AS STRING) AS text FROM range(12)")
    row = collocations.mined(odd).collect()[0]
    assert (row["a"], row["l"], row["r"], row["n"], row["score"]) == (12, 12, 12, 24, 1_000_000)


def test_ranges_meet(spark):
    """One word begins all pairs, and one pair all trigrams; both cover many ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [("en", f"the cat w{i % 300}. the v{i % 200}. u{i % 100} the cat") for i in range(6000)]
        docs = spark.createDataFrame(rows, "lang string, text string")
        found = Counter(tuple(row) for row in collocations.mined(docs, Mining(top=10_000)).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == Counter(plain(rows, Mining(top=10_000)))


def test_blocks_leave_in_the_order_that_spark_sorts_by():
    """Spark then merges runs, and it compares strings where they lie."""
    rows = texts(5)
    docs = pa.RecordBatch.from_pydict({"lang": [row[0] for row in rows], "text": [row[1] for row in rows]})
    batches = list(collocations._streams(Mining())(iter([docs])))
    assert {batch.schema.field("key").type for batch in batches} == {pa.string()}
    keys = [key for batch in batches for key in batch.column(0).cast(pa.binary()).to_pylist()]
    assert keys == sorted(set(keys)) and len(keys) > 500
    words = {row[0]: row[6] for row in plain(rows, Mining(least=1))}
    assert sum(sum(batch.column(1).to_pylist()) for batch in batches) == sum(words.values())


@pytest.mark.parametrize("least", [1, 4])
@pytest.mark.parametrize("rows_each", [1, 2, 7, 1000])
def test_levels_of_batches_cut_anywhere(least, rows_each):
    docs = pa.RecordBatch.from_pydict({"lang": ["en", "de"] * 40, "text": [f"a b{i % 3} c. a{i % 5} b! a" for i in range(80)]})
    streams = collocations._streams(Mining(block_words=20))(iter([docs]))
    ordered = sorted(row for batch in streams for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
    expected = Counter()
    for key, n in ordered:
        parts = key.split("\t")
        for level in range(4):
            if not level or parts[level]:
                expected["\t".join([*parts[: level + 1], *[""] * (3 - level)]).encode(), level] += n
    cuts = [ordered[i : i + rows_each] for i in range(0, len(ordered), rows_each)]
    batches = [pa.RecordBatch.from_arrays([pa.array([k for k, _ in c]), pa.array([n for _, n in c])], ["key", "n"]) for c in cuts]
    found = [row for batch in collocations._levels(least)(iter(batches)) for row in batch.to_pylist()]
    counts = {(row["key"], row["size"]): row["n"] for row in found}
    assert len(counts) == len(found)
    assert all(expected[gram] == n for gram, n in counts.items())
    assert {gram for gram, n in expected.items() if n >= least} <= set(counts)
