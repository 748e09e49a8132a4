"""Language identification by a bidirectional gated recurrent network over the bytes of words."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.llm.common import map_batches, seeded_order, utf8

UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


class Training(NamedTuple):
    """Bounds of the fit: about ``documents`` per language, chosen by a hash of the id, ``words`` different words of them,
    as many of each language as it has or its share allows, the most frequent ones, and ``languages`` most frequent
    languages. Longer words than ``longest`` bytes are read in pieces."""

    documents: int = 300
    words: int = 30_000
    languages: int = 256
    longest: int = 32
    hidden: int = 16
    epochs: int = 8
    batch: int = 512
    rate: float = 0.01
    seed: int = 7


Weights = dict[str, np.ndarray]


def padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words as rows of bytes, longest first, their lengths, and the order taken."""
    lengths = np.array([len(word) for word in words], np.int64)
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    rows = np.zeros((len(words), int(lengths[0])), np.uint8)
    rows[np.arange(rows.shape[1]) < lengths[:, None]] = np.frombuffer(b"".join(words[i] for i in order), np.uint8)
    return rows, lengths, order


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def run_gates(rows: np.ndarray, active: np.ndarray, inputs: np.ndarray, recurrent: np.ndarray, keep: list | None = None):
    """States after each byte, as (words at work, hidden) per step. ``active``: words that are long enough, per step."""
    size = recurrent.shape[0]
    h = np.zeros((len(rows), size), inputs.dtype)
    for step, count in enumerate(active):
        before = h[:count]
        x, u = inputs[rows[:count, step]], before @ recurrent
        gates = _sigmoid(x[:, : 2 * size] + u[:, : 2 * size])
        z, r = gates[:, :size], gates[:, size:]
        new = np.tanh(x[:, 2 * size :] + r * u[:, 2 * size :])
        h = new + z * (before - new)
        if keep is not None:
            keep.append((before, z, r, new, u[:, 2 * size :]))
        yield h


def _reversed(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    places = lengths[:, None] - 1 - np.arange(rows.shape[1])
    return np.where(places >= 0, np.take_along_axis(rows, np.maximum(places, 0), 1), 0)


def positions(rows: np.ndarray, lengths: np.ndarray, net: Weights, keep: tuple | None = None) -> np.ndarray:
    """Probabilities of the languages at every byte: (words, bytes, languages); past a word's end they are zero."""
    width = rows.shape[1]
    active = [int((lengths > step).sum()) for step in range(width)]
    size = net["forward_u"].shape[0]
    ahead = np.zeros((len(rows), width, size), net["forward_u"].dtype)
    back = np.zeros_like(ahead)
    kept = keep if keep is not None else (None, None)
    for step, h in enumerate(run_gates(rows, active, net["forward_x"], net["forward_u"], kept[0])):
        ahead[: len(h), step] = h
    for step, h in enumerate(run_gates(_reversed(rows, lengths), active, net["back_x"], net["back_u"], kept[1])):
        back[np.arange(len(h)), lengths[: len(h)] - 1 - step] = h
    logits = ahead @ net["forward_o"] + back @ net["back_o"] + net["bias"]
    logits = np.exp(logits - logits.max(-1, keepdims=True))
    out = logits / logits.sum(-1, keepdims=True)
    out *= (np.arange(width) < lengths[:, None])[:, :, None]
    return out if keep is None else (out, ahead, back)


def _back_through(rows, kept, errors, recurrent) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input table and the recurrent weights; ``errors``: of the states, per step."""
    size = recurrent.shape[0]
    by_x, by_u = np.zeros((256, 3 * size), recurrent.dtype), np.zeros_like(recurrent)
    carried = np.zeros((0, size), recurrent.dtype)
    for step in range(len(kept) - 1, -1, -1):
        before, z, r, new, u = kept[step]
        error = errors[step].copy()
        error[: len(carried)] += carried
        by_new = error * (1 - z) * (1 - new**2)
        by_z = error * (before - new) * z * (1 - z)
        by_r = by_new * u * r * (1 - r)
        np.add.at(by_x, rows[: len(before), step], np.hstack([by_z, by_r, by_new]))
        inner = np.hstack([by_z, by_r, by_new * r])
        by_u += before.T @ inner
        carried = error * z + inner @ recurrent.T
    return by_x, by_u


def gradients(rows, lengths, wanted, weight, net: Weights) -> tuple[float, Weights]:
    """Weighted cross-entropy of all positions against the word's language, and its gradients."""
    kept: tuple[list, list] = ([], [])
    p, ahead, back = positions(rows, lengths, net, kept)
    words = np.arange(len(rows))
    inside = np.arange(rows.shape[1]) < lengths[:, None]
    loss = -(weight[:, None] * np.log(np.maximum(p[words, :, wanted], 1e-20)) * inside).sum()
    error = p.copy()
    error[words, :, wanted] -= inside
    error *= weight[:, None, None]
    by_ahead, by_back = error @ net["forward_o"].T, error @ net["back_o"].T
    steps = range(rows.shape[1])
    sizes = [len(k[0]) for k in kept[0]]
    ahead_errors = [by_ahead[: sizes[t], t] for t in steps]
    back_errors = [by_back[np.arange(sizes[t]), lengths[: sizes[t]] - 1 - t] for t in steps]
    out: Weights = {"bias": error.sum((0, 1))}
    for name, states, errors, order, history in (
        ("forward", ahead, ahead_errors, rows, kept[0]),
        ("back", back, back_errors, _reversed(rows, lengths), kept[1]),
    ):
        out[f"{name}_o"] = np.tensordot(states, error, ([0, 1], [0, 1]))
        out[f"{name}_x"], out[f"{name}_u"] = _back_through(order, history, errors, net[f"{name}_u"])
    return float(loss), out


def initial(languages: int, how: Training, dtype=np.float32) -> Weights:
    rng = np.random.default_rng(how.seed)
    h = how.hidden
    shapes = {"x": (256, 3 * h), "u": (h, 3 * h), "o": (h, languages)}
    net = {f"{d}_{k}": rng.normal(0, 0.3, s).astype(dtype) for d in ("forward", "back") for k, s in shapes.items()}
    return net | {"bias": np.zeros(languages, dtype)}


def train(words: list[bytes], wanted: np.ndarray, weight: np.ndarray, languages: int, how: Training) -> Weights:
    """Adam on batches of words of similar length, the rate falling to zero."""
    net = initial(languages, how)
    first, second = ({k: np.zeros_like(v) for k, v in net.items()} for _ in range(2))
    rng = np.random.default_rng(how.seed)
    by_length = np.argsort([len(word) for word in words], kind="stable")
    batches = [by_length[i : i + how.batch] for i in range(0, len(words), how.batch)]
    step, steps = 0, how.epochs * len(batches)
    for _ in range(how.epochs):
        for number in rng.permutation(len(batches)):
            chosen = batches[number]
            rows, lengths, order = padded([words[i] for i in chosen])
            of = weight[chosen][order].astype(np.float32)
            _, slope = gradients(rows, lengths, wanted[chosen][order], of / max(of @ lengths, 1e-9), net)
            step += 1
            for k, g in slope.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                net[k] -= (how.rate * (1 - step / (steps + 1)) * move).astype(net[k].dtype)
    return net


class Model(NamedTuple):
    languages: list[str]
    net: Weights | None
    longest: int


def pieces(word: bytes, longest: int) -> list[bytes]:
    """The word in lower case, cut to length; nothing if it has no letter."""
    text = word.decode()
    if not _LETTER.search(text):
        return []
    lower = text.lower().encode()
    return [lower[i : i + longest] for i in range(0, len(lower), longest)]


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _word_counts(longest: int):
    def rows(batch: pa.RecordBatch):
        counts: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
            counts.setdefault(lang, Counter()).update(text.split())
        for lang, words in counts.items():
            parts: Counter = Counter()
            for word, n in words.items():
                for piece in pieces(word, longest):
                    parts[piece] += n
            yield {"lang": [lang] * len(parts), "word": list(parts), "n": list(parts.values())}

    return rows


def fit(docs: DataFrame, how: Training = Training()) -> Model:
    """A network from text and language of documents that are not held out; ids only choose the sample."""
    known = docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.select("doc_id", "lang", "text")
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(how.languages).collect()
    languages = sorted(row["lang"] for row in counts)
    if not languages:
        return Model([], None, how.longest)
    share = {row["lang"]: how.documents / row["count"] for row in counts}  # one row per language
    table = docs.sparkSession.createDataFrame(sorted(share.items()), "lang string, share double")
    drawn = F.pmod(seeded_order(F.col("doc_id"), how.seed), F.lit(1_000_000)) < F.col("share") * 1_000_000
    sample = known.join(F.broadcast(table), "lang").where(drawn).select("lang", "text")
    words = map_batches(sample, _word_counts(how.longest), "lang string, word binary, n bigint")
    words = words.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    # The languages take turns, so that none is without words; equally frequent words come in the order of a hash.
    own = Window.partitionBy("lang").orderBy(F.desc("n"), seeded_order(F.col("word"), how.seed), "word")
    most = max(how.words, len(languages))
    ranked = words.withColumn("place", F.row_number().over(own)).where(F.col("place") <= most)
    rows = ranked.orderBy("place", F.desc("n"), "lang").limit(most).collect()
    number = {lang: i for i, lang in enumerate(languages)}
    wanted = np.array([number[r["lang"]] for r in rows], np.int64)
    n = np.array([r["n"] for r in rows], float) ** 0.5
    totals = np.bincount(wanted, n, len(languages)) if len(rows) else np.ones(len(languages))
    if not len(rows):
        return Model([], None, how.longest)
    return Model(
        languages, train([bytes(r["word"]) for r in rows], wanted, n / totals[wanted], len(languages), how), how.longest
    )


class Reader:
    """Sums of the position probabilities of texts; every different word is read once and remembered."""

    def __init__(self, model: Model, limit: int = 200_000):
        self._model, self._limit = model, limit
        self._forget()

    def _forget(self) -> None:
        # Row 0 stands for words without a letter.
        self._known: dict[bytes, int] = {}
        self._sums = np.zeros((1, len(self._model.languages)))
        self._bytes = np.zeros(1)

    def _read(self, words: list[bytes]) -> None:
        split = [pieces(word, self._model.longest) for word in words]
        owner = np.repeat(np.arange(len(words)), [len(s) for s in split])
        flat = [piece for s in split for piece in s]
        sums, sizes = np.zeros((len(words), len(self._model.languages))), np.zeros(len(words))
        if flat:
            np.add.at(sizes, owner, [len(piece) for piece in flat])
        order = np.argsort([len(piece) for piece in flat], kind="stable") if flat else []
        for start in range(0, len(flat), 2048):
            chosen = order[start : start + 2048]
            rows, lengths, taken = padded([flat[i] for i in chosen])
            np.add.at(sums, owner[chosen[taken]], positions(rows, lengths, self._model.net).sum(1))
        base = len(self._sums)
        self._known |= {word: base + i if split[i] else 0 for i, word in enumerate(words)}
        self._sums, self._bytes = np.concatenate([self._sums, sums]), np.concatenate([self._bytes, sizes])

    def __call__(self, texts: list[bytes | None]) -> Iterator[tuple[str, float]]:
        if len(self._known) > self._limit:
            self._forget()
        words = [text.split() if text else [] for text in texts]
        new = {word for of_text in words for word in of_text}.difference(self._known)
        if new and self._model.net is not None:
            self._read(sorted(new))
        for of_text in words:
            if self._model.net is None or not of_text:
                yield UNKNOWN, 0.0
                continue
            at = np.fromiter(map(self._known.__getitem__, of_text), np.int64, len(of_text))
            size = self._bytes[at].sum()
            if not size:
                yield UNKNOWN, 0.0
                continue
            pooled = self._sums[at].sum(0) / size
            best = int(pooled.argmax())
            yield self._model.languages[best], float(min(1.0, pooled[best]))


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row of ``docs(doc_id, text)``.

    Every word of the whole text is read byte by byte in both directions; each byte position gets probabilities of the
    languages. Their mean over all positions of words with a letter is the document's; the largest is its ``score``. A
    network starts anew at each word, so that a word's positions are worked out once however often it occurs.

    Texts that are NULL or have no letter are ``und`` with score 0, and so is everything if there was nothing to learn
    from. Ties go to the language first in code point order. Ids may repeat or be NULL (then not held out).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                found = list(reader(utf8(part.column(2))))
                columns = [part.column(0), part.column(1), pa.array([x for x, _ in found], pa.string())]
                columns.append(pa.array([score for _, score in found], pa.float64()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    schema = "doc_id bigint, held_out boolean, lang_pred string, score double"
    rows = docs.select(F.col("doc_id").cast("bigint"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, schema)
