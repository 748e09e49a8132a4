"""Severity of toxic language by cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import Cache, map_batches, release_caches, seeded_order, utf8
from daymark.session import stored


class Training(NamedTuple):
    """Bounds of the fit: ``per_class`` labelled documents of each class, chosen by a hash of the id; ``features``
    candidates. ``grades`` are 0 for harmless and 1 up to the number of parts toxic documents are divided into."""

    per_class: int = 3000
    features: int = 1000
    least_documents: int = 5
    parts: int = 2
    l1: float = 4e-3
    steps: int = 600
    seed: int = 5


class Model(NamedTuple):
    """P(grade <= k) = 1 / (1 + exp(score - thresholds[k])) with score = weights . log(1 + counts).

    The weights are shared by all thresholds.
    """

    weights: dict[str, float]
    thresholds: np.ndarray

    def above(self, score: float) -> np.ndarray:
        """P(grade > k) for every threshold k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - score, -50, 50)))


_EDGES = regex.compile(r"^[^\p{L}]+|[^\p{L}]+$")


def word_features(word: bytes) -> tuple[str, ...]:
    """The word in lower case without what is not a letter at its ends, and its beginnings of four and five letters."""
    core = _EDGES.sub("", word.decode().lower())
    return tuple({core, *(f"{core[:size]}-" for size in (4, 5) if len(core) >= size)}) if core else ()


# For the sample only, which is small: the words of a corpus have no need to stay.
_features = Cache(word_features, 20_000, "toxicity")


def counts(text: bytes | None, features=_features) -> tuple[Counter, int]:
    words = text.split() if text else []
    return Counter(f for word in words for f in features[word]), len(words)


def _documents_with(batch: pa.RecordBatch):
    """Per feature the number of documents of either class that have it."""
    with_toxic: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for toxic, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
        with_toxic[toxic].update(counts(text)[0].keys())
    names = sorted(with_toxic[0].keys() | with_toxic[1].keys())
    yield {"feature": names, "clean": [with_toxic[0][n] for n in names], "toxic": [with_toxic[1][n] for n in names]}


def _sparse(index: dict[str, int]):
    def rows(batch: pa.RecordBatch):
        out: dict = {"toxic": batch.column(0), "columns": [], "counts": [], "words": []}
        for text in utf8(batch.column(1)):
            found, words = counts(text)
            own = [(index[f], n) for f, n in found.items() if f in index]
            out["columns"].append([c for c, _ in own])
            out["counts"].append([n for _, n in own])
            out["words"].append(words)
        yield out

    return rows


def sample(docs: DataFrame, labels: DataFrame, how: Training) -> DataFrame:
    """``toxic, text`` of at most ``per_class`` labelled documents of either class."""
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").select("doc_id", F.col("toxic").cast("int"))
    order = seeded_order(F.col("doc_id"), how.seed)
    chosen = [known.where(F.col("toxic") == c).orderBy(order, "doc_id").limit(how.per_class) for c in (0, 1)]
    ids = F.broadcast(chosen[0].union(chosen[1]))  # at most twice per_class rows
    return stored(docs.select("doc_id", "text").join(ids, "doc_id").select("toxic", "text"))


def fit(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> Model:
    """A model from the labelled documents.

    The labels say toxic or not. Toxic documents are graded by how often they have features that are at least ten times
    as frequent among toxic as among clean documents: equal parts, the lowest counts grade 1. Candidates are the
    ``features`` most telling ones by the likelihood ratio; the L1 penalty leaves those that carry the decision.
    """
    rows = sample(docs, labels, how)
    totals = {row["toxic"]: row["count"] for row in rows.groupBy("toxic").count().collect()}
    if not totals.get(0) or not totals.get(1):
        return Model({}, np.full(how.parts, 50.0))  # nothing to learn from: nothing is toxic
    with_feature = map_batches(rows, _documents_with, "feature string, clean bigint, toxic bigint")
    with_feature = with_feature.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    n_clean, n_toxic = float(totals[0]), float(totals[1])

    def information(hits, of):
        """Twice the log-likelihood of a class's counts."""
        rest = of - hits
        return 2 * (hits * F.log((hits + 0.5) / (of + 1)) + rest * F.log((rest + 0.5) / (of + 1)))

    gain = information(F.col("clean"), F.lit(n_clean)) + information(F.col("toxic"), F.lit(n_toxic))
    gain = gain - information(F.col("clean") + F.col("toxic"), F.lit(n_clean + n_toxic))
    frequent = with_feature.where(F.col("clean") + F.col("toxic") >= how.least_documents)
    best = frequent.orderBy(gain.desc(), "feature").limit(how.features).collect()  # bounded by ``features``
    names = [row["feature"] for row in best]
    telling = np.array([(r["toxic"] + 0.1) / n_toxic >= 10 * (r["clean"] + 0.1) / n_clean for r in best], bool)

    sparse = map_batches(
        rows, _sparse({name: i for i, name in enumerate(names)}), "toxic int, columns array<int>, counts array<int>, words int"
    ).toPandas()  # at most twice per_class rows of at most ``features`` numbers
    x = np.zeros((len(sparse), len(names)), np.float32)
    for row, columns, numbers in zip(x, sparse["columns"], sparse["counts"], strict=True):
        row[columns] = numbers
    signs = x @ telling.astype(np.float32)
    toxic = sparse["toxic"].to_numpy() == 1
    cuts = np.quantile(signs[toxic], np.arange(1, how.parts) / how.parts)
    grades = np.where(toxic, 1 + np.searchsorted(cuts, signs, side="left"), 0)
    x = np.log1p(x)
    chosen = fit_ordinal(x, grades, how, how.l1)[0] != 0
    # The chosen features again, with a penalty that only bounds the weights: the strong one shrinks them.
    weights = np.zeros(len(names))
    weights[chosen], thresholds = fit_ordinal(x[:, chosen], grades, how, how.l1 / 20)
    kept = {name: float(w) for name, w in zip(names, weights, strict=True) if w != 0}
    return Model(kept, thresholds)


def cumulative(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade <= k), between columns of zeros and ones."""
    inner = 1 / (1 + np.exp(np.clip(score[:, None] - thresholds[None, :], -50, 50)))
    return np.hstack([np.zeros((len(score), 1)), inner, np.ones((len(score), 1))])


def fit_ordinal(x: np.ndarray, grades: np.ndarray, how: Training, l1: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by accelerated proximal gradient steps on the penalised likelihood.

    The first threshold is a parameter; the others follow it at positive gaps, exp of a parameter. Columns are scaled
    for the descent only: the penalty is on the weights as they are used.
    """
    count, levels = len(x), how.parts
    scale = np.maximum(x.std(0), 0.02)
    x = x / scale
    penalty = l1 / scale
    direction = np.ones(x.shape[1], x.dtype)
    for _ in range(30):  # power iteration for the largest curvature
        direction = x.T @ (x @ (direction / np.linalg.norm(direction)))
    step = 4.0 / (1.1 * np.linalg.norm(direction) / count + 1)
    weights, shift = np.zeros(x.shape[1]), np.zeros(levels)
    ahead_w, ahead_s, momentum = weights, shift, 1.0
    for _ in range(how.steps):
        thresholds = np.cumsum(np.concatenate([ahead_s[:1], np.exp(ahead_s[1:])]))
        p = cumulative(x @ ahead_w.astype(x.dtype), thresholds)
        slope = p * (1 - p)
        rows = np.arange(count)
        chance = np.maximum(p[rows, grades + 1] - p[rows, grades], 1e-12)
        by_upper, by_lower = slope[rows, grades + 1] / chance, slope[rows, grades] / chance
        by_score = ((by_upper - by_lower) / count).astype(x.dtype)  # of the negative log-likelihood
        by_threshold = np.zeros(levels)
        for k in range(levels):
            by_threshold[k] = (by_lower[grades == k + 1].sum() - by_upper[grades == k].sum()) / count
        by_shift = np.cumsum(by_threshold[::-1])[::-1]
        by_shift[1:] *= np.exp(ahead_s[1:])
        new_w = ahead_w - step * (x.T @ by_score)
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - step * penalty, 0)
        new_s = ahead_s - step * by_shift
        faster = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        push = (momentum - 1) / faster
        ahead_w, ahead_s = new_w + push * (new_w - weights), new_s + push * (new_s - shift)
        weights, shift, momentum = new_w, new_s, faster
    return weights / scale, np.cumsum(np.concatenate([shift[:1], np.exp(shift[1:])]))


def severity(text: bytes | None, model: Model, features) -> np.ndarray:
    """P(grade > k) per threshold; zeros for a text without words."""
    found, words = counts(text, features)
    if not words:
        return np.zeros(len(model.thresholds))
    return model.above(sum(model.weights[f] * np.log1p(n) for f, n in found.items()))


def _known(model: Model) -> Cache:
    """Features of a word that the model has a weight for."""
    release_caches("toxicity")
    return Cache(lambda word: tuple(f for f in word_features(word) if f in model.weights), 100_000, "toxicity")


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, severity, grade, p_toxic, toxic`` per row of ``docs(doc_id, text)``.

    ``severity`` is the expected grade, ``grade`` the number of thresholds passed with probability 1/2, ``toxic`` whether
    that is one or more. NULL, empty and blank texts have severity 0. Ids are not used and may repeat or be NULL.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _known(model)
        for batch in batches:
            above = np.array([severity(text, model, features) for text in utf8(batch.column(1))])
            above = above.reshape(batch.num_rows, len(model.thresholds))
            grade = (above >= 0.5).sum(1)
            columns = [batch.column(0), above.sum(1), grade.astype(np.int32), above[:, 0], grade > 0]
            names = ["doc_id", "severity", "grade", "p_toxic", "toxic"]
            yield pa.RecordBatch.from_arrays([pa.array(c) if i else c for i, c in enumerate(columns)], names)

    schema = "doc_id bigint, severity double, grade int, p_toxic double, toxic boolean"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with all columns."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _known(model)
        for batch in batches:
            texts = utf8(batch.column(place))
            yield batch.filter(pa.array([severity(t, model, features)[0] < 0.5 for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
