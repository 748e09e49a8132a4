"""Quality rules: counts of a document, and a conditional random field that tells content lines from boilerplate."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import gram_hashes, release_caches, seeded_order, utf8, word_hashes

CONTENT, BOILERPLATE = 1, 0


class Rules(NamedTuple):
    """``least_words``, ``most_repeated`` (per cent of the words in repeated windows of ``window`` words) fail a document
    at once; ``least_content``: share of words in content lines that a kept one has."""

    least_words: int = 50
    most_repeated: int = 50
    window: int = 3
    least_content: float = 0.5


class Training(NamedTuple):
    """Bounds of the fit: ``per_class`` labelled documents of either quality, chosen by a hash of the id, and ``lines``
    lines of them together. If they have more, the longest give evenly spaced ones. Runs of more than ``chain`` lines of a
    document count as several documents, because shorter ones are filled up to the longest."""

    per_class: int = 1500
    lines: int = 200_000
    chain: int = 512
    steps: int = 150
    rate: float = 0.1
    l2: float = 1e-3
    seed: int = 9


class Field(NamedTuple):
    """Scores of feature values per state (one table per feature), of transitions, and of the first state."""

    emission: np.ndarray
    transition: np.ndarray
    start: np.ndarray


# Classes of bytes.
_OTHER, _UPPER, _LOWER, _DIGIT, _SYMBOL, _SPACE, _SHOUT, _STOP, _INNER = range(9)
_CLASS = np.full(256, _OTHER)
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_CLASS[ord("a") : ord("z") + 1] = _LOWER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[list(b"#*$%&|<>")] = _SYMBOL
_CLASS[list(b"\x20\x09\x0a\x0b\x0c\x0d")] = _SPACE
_CLASS[ord("!")] = _SHOUT
_CLASS[list(b".?")] = _STOP
_CLASS[0x80:0xC0] = _INNER  # bytes of a character after its first

# Upper ends of the values of each feature; a feature has one value more.
_STEPS = {
    "words": (0, 1, 3, 7, 15, 31),
    "capitals": (0.05, 0.2, 0.5, 0.8),
    "symbols": (0, 0.1, 0.3, 0.7),
    "digits": (0, 0.1, 0.3),
    "again": (0, 0.1, 0.4),
    "repeated": (0, 0.3, 0.7),
    "shouts": (0, 0.1, 0.3),
    "length": (2, 4, 7, 12),
    "stopped": (0,),
    "copied": (0,),
}
_WIDTH = max(len(s) for s in _STEPS.values()) + 1


class Document(NamedTuple):
    words: int
    word_chars: int
    symbols: int
    dup_lines: int
    repeat_words: int
    line_words: np.ndarray
    features: np.ndarray  # (lines, features): which value


def _with_class(x: np.ndarray) -> np.ndarray:
    classes = _CLASS[x]
    # Letters of Latin-1: the second byte tells their case.
    after = np.append(False, x[:-1] == 0xC3)
    upper = np.flatnonzero(after & (x <= 0x9E))
    classes[upper - 1] = _UPPER
    classes[np.flatnonzero(after & (x > 0x9E)) - 1] = _LOWER
    return classes


def read(text: bytes | None, window: int = 3) -> Document:
    """Counts and line features of a text. Lines end at line feeds; every line counts, also an empty one."""
    text = text or b""
    x = np.frombuffer(text, np.uint8)
    breaks = x == 10
    lines = int(breaks.sum()) + 1
    line = np.cumsum(breaks) - breaks
    classes = _with_class(x) if len(x) else x.astype(np.int64)
    counts = np.bincount(line * 9 + classes, minlength=9 * lines).reshape(lines, 9)
    space = classes == _SPACE
    starts = np.flatnonzero(~space & np.append(True, space[:-1])) if len(x) else np.empty(0, np.int64)
    word_line = line[starts]
    line_words = np.bincount(word_line, minlength=lines)
    hashes = word_hashes(text.split())

    grams = gram_hashes(hashes, window)
    _, number, seen = np.unique(grams, return_inverse=True, return_counts=True)
    change = np.zeros(len(hashes) + 1, np.int64)
    twice = np.flatnonzero(seen[number] > 1)
    np.add.at(change, twice, 1)
    np.add.at(change, twice + window, -1)
    repeated = np.cumsum(change[:-1]) > 0
    same = np.append(False, hashes[1:] == hashes[:-1]) if len(hashes) else repeated

    copied, earlier = np.zeros(lines), set()
    for i, (row, words) in enumerate(zip(text.split(b"\n"), line_words.tolist(), strict=True)):
        if words:
            copied[i] = row in earlier
            earlier.add(row)

    per_word = np.maximum(line_words, 1)
    chars = np.maximum(counts.sum(1) - counts[:, _SPACE] - counts[:, _INNER], 1)
    letters = counts[:, _UPPER] + counts[:, _LOWER]
    ends = np.zeros(lines)
    shown = np.flatnonzero(~space)
    last = np.full(lines, -1)
    last[line[shown]] = shown  # the last one wins
    ends[last >= 0] = np.isin(classes[last[last >= 0]], (_STOP, _SHOUT))
    values = {
        "words": line_words,
        "capitals": counts[:, _UPPER] / np.maximum(letters, 1),
        "symbols": counts[:, _SYMBOL] / per_word,
        "digits": counts[:, _DIGIT] / chars,
        "again": np.bincount(word_line, same, lines) / per_word,
        "repeated": np.bincount(word_line, repeated, lines) / per_word,
        "shouts": counts[:, _SHOUT] / per_word,
        "length": chars / per_word,
        "stopped": ends,
        "copied": copied,
    }
    features = np.stack([np.searchsorted(_STEPS[name], v) for name, v in values.items()], 1).astype(np.int8)
    inner = int((classes == _INNER).sum())
    return Document(
        len(hashes),
        len(x) - inner - int(space.sum()),
        int(counts[:, _SYMBOL].sum()),
        int(copied.sum()),
        int(repeated.sum()),
        line_words,
        features,
    )


def stacked(documents: list[Document], field: Field) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Emission scores as (documents, lines, 2), the longest first; the numbers of lines; the order taken."""
    lengths = np.array([len(d.line_words) for d in documents])
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    scores = np.zeros((len(documents), int(lengths[0]), 2))
    flat = np.concatenate([documents[i].features for i in order])
    inside = np.arange(scores.shape[1]) < lengths[:, None]
    scores[inside] = field.emission[np.arange(len(_STEPS)), flat].sum(1)
    return scores, lengths, order


def viterbi(scores: np.ndarray, lengths: np.ndarray, field: Field) -> np.ndarray:
    """The best states of every document's lines; rows are sorted by length, the longest first."""
    active = [int((lengths > step).sum()) for step in range(scores.shape[1])]
    best = scores[:, 0] + field.start
    came = np.zeros(scores.shape, np.int8)
    for step in range(1, len(active)):
        n = active[step]
        through = best[:n, :, None] + field.transition
        came[:n, step] = through.argmax(1)
        best[:n] = through.max(1) + scores[:n, step]
    states = np.zeros(scores.shape[:2], np.int8)
    rows = np.arange(len(scores))
    states[rows, lengths - 1] = best.argmax(1)
    for step in range(len(active) - 1, 0, -1):
        n = active[step]
        states[:n, step - 1] = came[np.arange(n), step, states[:n, step]]
    return states


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    return np.logaddexp(x.take(0, axis), x.take(1, axis))


def likelihood(scores, lengths, states, field: Field) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihood of the states, and the differences between given and expected counts: of the state at every line,
    of transitions, of first states. Forward-backward over all documents at a time."""
    rows, width = np.arange(len(scores)), scores.shape[1]
    active = [int((lengths > step).sum()) for step in range(width)]
    ahead, back = np.zeros_like(scores), np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0] + field.start
    for step in range(1, width):
        n = active[step]
        ahead[:n, step] = _log_sum(ahead[:n, step - 1, :, None] + field.transition, 1) + scores[:n, step]
    for step in range(width - 2, -1, -1):
        n = active[step + 1]
        onward = (scores[:n, step + 1] + back[:n, step + 1])[:, None, :] + field.transition
        back[:n, step] = _log_sum(onward, 2)
    total = _log_sum(ahead[rows, lengths - 1], 1)
    inside = (np.arange(width) < lengths[:, None])[:, :, None]
    at_state = np.exp(ahead + back - total[:, None, None]) * inside
    given = np.eye(2)[states] * inside
    pairs = inside[:, 1:, :, None]
    moved = ahead[:, :-1, :, None] + field.transition + (scores + back)[:, 1:, None, :] - total[:, None, None, None]
    expected = (np.exp(np.where(pairs, moved, -np.inf))).sum((0, 1))
    taken = (given[:, :-1, :, None] * given[:, 1:, None, :]).sum((0, 1))
    value = (scores * given).sum() + (taken * field.transition).sum() + (given[:, 0] * field.start).sum() - total.sum()
    return float(value), given - at_state, taken - expected, (given[:, 0] - at_state[:, 0]).sum(0)


def empty_field() -> Field:
    """Calls every line content."""
    return Field(np.zeros((len(_STEPS), _WIDTH, 2)), np.zeros((2, 2)), np.array([0.0, 1.0]))


def train(documents: list[Document], content: np.ndarray, how: Training) -> Field:
    """Weights that make the given states likely; all lines of a document have its state. Adam on the whole sample."""
    field = Field(np.zeros((len(_STEPS), _WIDTH, 2)), np.zeros((2, 2)), np.zeros(2))
    flat = np.concatenate([documents[i].features for i in np.argsort([-len(d.line_words) for d in documents], kind="stable")])
    first, second = ([np.zeros_like(x) for x in field] for _ in range(2))
    for step in range(1, how.steps + 1):
        scores, lengths, order = stacked(documents, field)
        states = np.repeat(content[order][:, None], scores.shape[1], 1)
        _, lines, moves, starts = likelihood(scores, lengths, states, field)
        inside = np.arange(scores.shape[1]) < lengths[:, None]
        by_line = lines[inside]
        by_emission = np.zeros_like(field.emission)
        for i in range(len(_STEPS)):
            for state in (0, 1):
                by_emission[i, :, state] = np.bincount(flat[:, i], by_line[:, state], _WIDTH)
        slopes = [by_emission, moves, starts]
        new = []
        for i, (value, slope) in enumerate(zip(field, slopes, strict=True)):
            slope = slope / len(flat) - how.l2 * value
            first[i] += 0.1 * (slope - first[i])
            second[i] += 0.01 * (slope * slope - second[i])
            scale = np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8
            new.append(value + how.rate * first[i] / (1 - 0.9**step) / scale)
        field = Field(*new)
    return field


def quota(sizes: dict[int, int], lines: int) -> int:
    """The most lines a document may give so that all give ``lines`` together, but each one line at least; ``sizes``:
    number of documents by their number of lines."""
    documents, left = sum(sizes.values()), lines
    for size in sorted(sizes):
        if size * documents > left:
            return max(1, left // documents)
        left -= size * sizes[size]
        documents -= sizes[size]
    return max(sizes, default=1)


def evenly_spaced(features: np.ndarray, most: int) -> np.ndarray:
    return features if len(features) <= most else features[np.arange(most) * len(features) // most]


def fit(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> Field:
    """A field from labelled documents: the lines of good ones count as content, those of poor ones as boilerplate.

    The labels are of documents, so the states of single lines are taken to be theirs; what lines of either kind have in
    common gets no weight.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").select("doc_id", F.col("quality").cast("int"))
    order = seeded_order(F.col("doc_id"), how.seed)
    chosen = [known.where(F.col("quality") == q).orderBy(order, "doc_id").limit(how.per_class) for q in (0, 1)]
    ids = F.broadcast(chosen[0].union(chosen[1]))  # at most twice per_class rows
    sample = docs.select("doc_id", "text").join(ids, "doc_id").select("doc_id", "quality", "text")
    breaks = F.length("text") - F.length(F.translate("text", "\n", ""))
    sizes = sample.groupBy((F.coalesce(breaks, F.lit(0)) + 1).alias("lines")).count().collect()
    most = quota({row["lines"]: row["count"] for row in sizes}, how.lines)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [evenly_spaced(read(text).features, most) for text in utf8(batch.column(2))]
            columns = [batch.column(0), batch.column(1), pa.array([f.tobytes() for f in lines], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "quality", "features"])

    rows = sample.mapInArrow(run, "doc_id bigint, quality int, features binary")
    rows = rows.orderBy(order, "doc_id", "quality", "features").collect()  # ten bytes a line
    documents, content = [], []
    for row in rows:
        features = np.frombuffer(row["features"], np.int8).reshape(-1, len(_STEPS))
        for start in range(0, len(features), how.chain):
            part = features[start : start + how.chain]
            documents.append(Document(0, 0, 0, 0, 0, np.zeros(len(part)), part))
            content.append(CONTENT if row["quality"] else BOILERPLATE)
    return train(documents, np.array(content), how) if len(set(content)) == 2 else empty_field()


def content_words(documents: list[Document], field: Field) -> list[int]:
    """Words in lines that the best labelling calls content."""
    if not documents:
        return []
    scores, lengths, order = stacked(documents, field)
    states = viterbi(scores, lengths, field)
    out = [0] * len(documents)
    for row, i in enumerate(order.tolist()):
        out[i] = int(documents[i].line_words[states[row, : lengths[row]] == CONTENT].sum())
    return out


def judged(docs: DataFrame, field: Field, rules: Rules = Rules()) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, content_share`` per row of
    ``docs(doc_id, text)``.

    ``content_share`` is the share of the words that lie in content lines; a document that passes the base rules is kept if
    it is ``least_content`` or more. NULL and blank texts have no words, share 0, and fail. Ids may repeat or be NULL.
    """
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches("words")
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                documents = [read(text, rules.window) for text in utf8(part.column(1))]
                counts = np.array([d[:5] for d in documents], np.int64).reshape(-1, 5)
                words, repeated = counts[:, 0], counts[:, 4]
                failed = (words < rules.least_words) | (100 * repeated > rules.most_repeated * words)
                share = np.array(content_words(documents, field)) / np.maximum(words, 1)
                kept = ~failed & (share >= rules.least_content)
                columns = [*counts.T, failed, kept, share]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c) for c in columns)], [*names, "base_failed", "kept", "content_share"]
                )

    schema = ", ".join([f"{name} bigint" for name in names]) + ", base_failed boolean, kept boolean, content_share double"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)
