"""Every operator on documents with NULLs, blanks, a very long text, repeated rows and columns that clash."""

from __future__ import annotations

import numpy as np
import pytest

from daymark.llm import (
    language_model,
    languages,
    minhash,
    mixing,
    packing,
    quality,
    substrings,
    tokens,
    toxicity,
)

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, a int, band string, component string, "
    "id int, hub int, _range string, _source string, size string, start string, place int, task int, count int, _doc_id int, "
    "_again int, _copies int, _rows int, _kept_text string, _kept int, _id int, c0 int, kept int, removed int"
)
EXTRA = (1, "b", "c", 2, 3, "r", "s", "z", "t", 4, 5, 6, 7, 8, 9, 10, "u", 11, 12, 13, 14, 15)
LONG = " ".join(f"word{i % 7000}x{i % 13}" for i in range(30_000))
TEXTS = [
    (1, "one two three four five six seven", "en", "s1"),
    (2, "one two three four five six seven", "en", "s1"),
    (2, "one two three four five six seven", "en", "s1"),  # a repeated row
    (3, None, "en", "s1"),
    (4, "", None, "s2"),
    (5, " \t\n\r\x0b\x0c ", "de", None),
    (6, LONG, "en", "s2"),
    (7, LONG + " and a little more", "en", None),
    (None, "a document without an id", None, None),
    (None, None, None, None),
    (8, "kurz", "de", "s2"),
    (9, "   İ <|endoftext|> 's \U0001f600", "fr", "s3"),
    (10, "12 345 !!!", "fr", "s3"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*row, None, *EXTRA) for row in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, TEXTS)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def ids(rows):
    return sorted((row["doc_id"] is None, row["doc_id"] or 0) for row in rows)


IDS = sorted((row[0] is None, row[0] or 0) for row in TEXTS)
TOXIC = toxicity.Model({"kurz": 5.0}, np.array([1.0, 3.0]))

OPERATORS = {
    "minhash": minhash.near_duplicates,
    "substrings": substrings.removal_report,
    "without_repeats": substrings.without_repeats,
    "mixing": mixing.mix_report,
    "tokens": tokens.counted,
    "toxicity": lambda df: toxicity.scored(df, TOXIC),
    "quality": lambda df: quality.judged(df, quality.empty_field()),
    "languages": lambda df: languages.predicted(df, languages.Model([], None, 32)),
    "language_model": language_model.scored,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(docs, empty, name):
    assert ids(OPERATORS[name](docs).collect()) == IDS
    assert OPERATORS[name](empty).collect() == []


def test_packing(docs, empty):
    rows = packing.packed(docs).collect()
    assert sum(row["length"] for row in rows) == sum(row["doc_tokens"] for row in rows if row["start"] == 0)
    assert sum(row["start"] == 0 for row in rows) == len(TEXTS)
    by_id = {row["doc_id"]: row["doc_tokens"] for row in rows}
    assert by_id[3] == by_id[4] == by_id[5] == 1
    assert packing.packed(empty).collect() == []


def test_near_duplicates_of_edges(docs):
    rows = {(r["doc_id"], r["n_shingles"]): r for r in minhash.near_duplicates(docs).collect()}
    assert rows[2, 3]["component_id"] == 1 and not rows[2, 3]["kept"]
    assert rows[3, 0]["component_id"] == 3 and rows[3, 0]["kept"]
    assert rows[None, 1]["component_id"] is None and rows[None, 1]["kept"]
    sevens = [r for (doc_id, _), r in rows.items() if doc_id == 7]
    assert sevens[0]["component_id"] == 6


def test_one_of_each_group(docs, empty):
    kept = minhash.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert ids(kept.collect()) == sorted([*((False, i) for i in (1, 3, 4, 5, 6, 8, 9, 10)), (True, 0), (True, 0)])
    assert minhash.one_of_each_group(empty).collect() == []
    again = frame(docs.sparkSession, [*TEXTS, TEXTS[0]])
    assert [r["doc_id"] for r in minhash.one_of_each_group(again).collect()].count(1) == 1


def test_cut_texts(docs):
    cut = {row["doc_id"]: row for row in substrings.without_repeats(docs).collect() if row["doc_id"] is not None}
    assert cut[7]["text"] == "and a little more" and cut[7]["n_chars"] == 17
    assert cut[7][5:] == EXTRA and substrings.without_repeats(docs).columns == docs.columns
    assert cut[6]["text"] == LONG and cut[5]["text"] == TEXTS[5][1] and cut[3]["text"] is None


def test_mixed_rows(docs, empty):
    taken = {}
    for row in mixing.copies(docs).collect():
        taken[row["doc_id"]] = taken.get(row["doc_id"], 0) + row["copies"]
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    counts = {}
    for row in mixed.collect():
        assert row[5:] == EXTRA
        counts[row["doc_id"]] = counts.get(row["doc_id"], 0) + 1
    assert counts == {doc_id: n for doc_id, n in taken.items() if n}
    assert mixing.mixed(empty).collect() == []


def test_filter_keeps_columns(docs, empty):
    kept = toxicity.without_toxic(docs, TOXIC)
    assert kept.columns == docs.columns and ids(kept.collect()) == [x for x in IDS if x != (False, 8)]
    assert toxicity.without_toxic(empty, TOXIC).collect() == []


def test_models_without_labels(docs, empty, spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    odd = spark.createDataFrame([(None, 1, 1), (1, None, None), (77, 0, 1), (1, 2, 3)], labels.schema)
    for table in (labels, odd):
        assert not any(row["toxic"] for row in toxicity.scored(docs, toxicity.fit(docs, table)).collect())
        kept = quality.judged(docs, quality.fit(docs, table)).where("kept")
        assert sorted(row["doc_id"] for row in kept.collect()) == [6, 7]  # all others have fewer than 50 words
    assert languages.fit(empty).languages == []
    assert {row["lang_pred"] for row in languages.predicted(docs, languages.fit(empty)).collect()} == {"und"}
