"""Token counts, packing, mixing and scores against the library or plain versions."""

from __future__ import annotations

import math
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from daymark.llm import language_model, mixing, packing, tokens
from daymark.llm.common import Cache

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.WORD_BPE)


def odd_texts(seed, count):
    """Texts of characters from all planes, with special strings, contractions and every kind of white space."""
    rng = random.Random(seed)
    ranges = [(1, 0x250), (0x250, 0x3000), (0x3000, 0xD7FF), (0xE000, 0x1FFFF)]
    extra = ["'s", "'LL", "<|endoftext|>", "<|startoftext|>", "Á", "İ", "ß", "Σ", "ΑΣ", " ", "\x85", "\x1c", " ", "ab", "12"]
    texts = []
    for _ in range(count):
        low, high = rng.choice(ranges)
        texts.append("".join(rng.choice([chr(rng.randint(low, high)), rng.choice(extra)]) for _ in range(rng.randint(0, 40))))
    return [*texts, "", "a" * 3000, "ab" * 2000, "!?" * 500, "<|endoftext|>" * 3]


def test_counts_are_the_librarys(spark, library):
    texts = odd_texts(1, 3000)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {row["doc_id"]: row for row in tokens.counted(df, tokens.Counting(limit=20)).collect()}
    for i, encoding in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        wanted = (len(texts[i].encode()), len(encoding.ids), len(encoding.ids) > 20)
        assert (found[i]["n_bytes"], found[i]["n_tokens"], found[i]["over_limit"]) == wanted, texts[i]


def test_counts_of_a_table_are_the_librarys(spark, library):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = {row["doc_id"]: row["n_tokens"] for row in tokens.counted(docs).collect()}
    rows = docs.select("doc_id", "text").collect()
    encodings = library.encode_batch([row["text"] or "" for row in rows], add_special_tokens=False)
    assert found == {row["doc_id"]: len(e.ids) for row, e in zip(rows, encodings, strict=True)}


def test_cache_forgets_the_oldest():
    asked = []

    def square(x):
        asked.append(x)
        return x * x

    cache = Cache(square, limit=10)
    assert [cache[x] for x in range(25)] == [x * x for x in range(25)]
    assert cache.unknown(range(15, 30)) and len(cache) <= 11
    assert [cache[x] for x in range(15, 25)] == [x * x for x in range(15, 25)]
    assert len(asked) <= 36
    for start in range(0, 300, 7):  # the words asked for may be about to be forgotten
        for word in cache.unknown(range(start, start + 25)):
            cache.learn(word, word * word)
        assert all(cache[x] == x * x for x in range(start, start + 25))


@pytest.mark.parametrize("capacity", [4096, 64])
def test_packing_is_the_cut_concatenation(spark, library, capacity):
    rows = [(row["doc_id"], row["text"]) for row in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    rows += [(10_000 + i, text) for i, text in enumerate(odd_texts(2, 200))] + [(20_000, None), (20_000, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    pieces = packing.packed(df, packing.Packing(capacity=capacity)).collect()
    ids = [e.ids + [2] for e in library.encode_batch([text or "" for _, text in rows], add_special_tokens=False)]
    wanted = Counter((doc_id, tuple(own)) for (doc_id, _), own in zip(rows, ids, strict=True))

    line = sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"]))
    place, documents, open_piece = 0, Counter(), []
    for piece in line:
        assert piece["sequence_id"] * capacity + piece["offset"] == place
        own = struct.unpack(f"<{piece['length']}I", piece["ids"])
        assert 0 < len(own) <= capacity - piece["offset"] and piece["start"] == len(open_piece)
        place += len(own)
        open_piece += own
        if len(open_piece) == piece["doc_tokens"]:
            documents[piece["doc_id"], tuple(open_piece)] += 1
            open_piece = []
    assert documents == wanted and place == sum(map(len, ids))
    report = packing.packing_report(df, packing.Packing(capacity=capacity)).collect()
    assert Counter(row["ids_crc32"] for row in report) == Counter(zlib.crc32(piece["ids"]) for piece in pieces)


def plain_targets(sizes, weights, share, most):
    """Water-filling one source at a time."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    left, free, target = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[n] for n in free)
        above = {n for n in free if weight[n] * level > most * sizes[n]}
        if not above:
            return target | {n: weight[n] * level for n in free}
        target |= {n: most * sizes[n] for n in above}
        left -= sum(most * sizes[n] for n in above)
        free -= above
    return target


@pytest.mark.parametrize("seed", range(3))
def test_mix_meets_its_targets(spark, seed):
    rng = random.Random(seed)
    sources = ["b", "a", None, "z\U0001f600", "z￿", "", "only blanks"]
    rows = [
        (i, " ".join("x" * rng.randint(0, 60)), rng.choices(sources[:6], [40, 5, 5, 1, 8, 3])[0]) for i in range(1500)
    ] + [(9999, "  \t", "only blanks")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = mixing.mix_report(df).collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    targets = plain_targets(sizes, [3, 1, 2], 1.5, 2)
    source_of, longest = {i: s for i, _, s in rows}, max(len(t.split()) for _, t, _ in rows)
    taken = Counter()
    for row in found:
        source = source_of[row["doc_id"]]
        assert row["source_size"] == sizes[source]
        assert math.isclose(row["target"], targets[source], rel_tol=1e-9)
        assert row["taken"] <= 2 * row["size"] and row["taken"] % max(row["size"], 1) == 0
        taken[source] += row["taken"]
    for source, target in targets.items():
        assert abs(taken[source] - target) <= longest + 1
    again = mixing.mix_report(df.repartition(7)).collect()
    assert sorted(found) == sorted(again)


def plain_scores(texts, penalty=0.4):
    lists = {i: (text or "").lower().split() for i, text in texts}
    alone = Counter(w for words in lists.values() for w in words)
    together = Counter(p for words in lists.values() for p in zip(words, words[1:]))
    total, scores = sum(alone.values()), {}
    for i, words in lists.items():
        terms = [math.log(alone[w] / total) for w in words[:1]]
        for a, b in zip(words, words[1:]):
            seen = together[a, b] >= 2
            terms.append(math.log(together[a, b] / alone[a]) if seen else math.log(penalty * alone[b] / total))
        scores[i] = sum(round(t * 1_000_000) for t in terms)
    return scores


@pytest.mark.parametrize("how", [language_model.Backoff(), language_model.Backoff(block_words=50, part_grams=40)])
def test_scores_are_those_of_plain_counts(spark, how):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [(i, " ".join(rng.choice(vocabulary[: rng.choice([5, 60])]) for _ in range(rng.randint(0, 30)))) for i in range(120)]
    found = language_model.scored(spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4), how).collect()
    wanted = plain_scores(texts)
    for row in found:
        assert abs(row["log_score"] - wanted[row["doc_id"]]) <= 2
        assert (row["mean_log_score"] is None) == (row["n_words"] == 0)
    assert len(found) == len(texts)


def test_unlikely_texts_score_lower(spark):
    common = "the cat sat on the mat and the dog sat on the rug"
    rows = [(i, common) for i in range(20)] + [(20, "mat the on cat dog rug sat and the"), (21, common)]
    scores = {r["doc_id"]: r["mean_log_score"] for r in language_model.scored(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert scores[20] < scores[21] and np.isclose(scores[21], scores[0])
