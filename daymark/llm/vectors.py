"""Near-duplicate vectors by an inverted multi-index."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from daymark.llm.common import seeded_order
from daymark.llm.components import components
from daymark.session import fresh_folder, remove_folder, scratch, settings, stored


class Search(NamedTuple):
    """``sample``: vectors the codebooks are fitted to; ``cell_rows``: rows per cell of the largest label that the size of
    the codebooks aims at; ``block``: rows that are stored together; ``held``: bytes of a span, the blocks that a task holds
    while others pass by; ``shipped``: bytes that are shuffled at a time, in those of all blocks; ``axes``: directions along
    which vectors are compared before all of their components are."""

    threshold: float = 0.98
    sample: int = 20_000
    cell_rows: int = 200
    block: int = 1024
    seed: int = 3
    held: int = 32 << 20
    shipped: float = 1.5
    axes: int = 16


class Index(NamedTuple):
    """Centroids of either half of the unit vectors, the squared radius of a search, the vectors' length, and orthonormal
    directions in which they differ most."""

    codebooks: tuple[np.ndarray, np.ndarray]
    reach: float
    size: int
    axes: np.ndarray


ROUNDING = 1e-5  # more than single precision loses in a squared distance of unit vectors
SLICE = 1 << 18  # numbers worked on at a time
SIDE = 1 << 9  # most held rows that are compared at a time
LEAST_SHIPPED = 256 << 20
BLOB = 1 << 20
LEFT_BLOCKS = 16


def directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values in double precision, unit vectors, and which rows have a direction; the others are zero."""
    x = x.astype(np.float64) + 0.0  # -0.0 becomes 0.0
    x[~np.isfinite(x).all(1)] = 0
    with np.errstate(over="ignore"):
        norms = np.sqrt(np.einsum("ij,ij->i", x, x))
    if (large := np.isinf(norms)).any():
        x[large] /= np.abs(x[large]).max(1, keepdims=True)
        norms[large] = np.sqrt(np.einsum("ij,ij->i", x[large], x[large]))
    able = norms > 0
    return x, x / np.where(able, norms, 1)[:, None], able


def by_size(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows that lie in ``flat``, a bounded number of one length at a time: their places and their values."""
    for size in np.unique(sizes[sizes > 0]).tolist():
        at = np.flatnonzero(sizes == size)
        step = max(1, SLICE // size)
        for some in (at[i : i + step] for i in range(0, len(at), step)):
            yield some, flat[starts[some][:, None] + np.arange(size)]


def _offsets(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros(1, np.int32)
    return np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``flat, starts, sizes`` of lists; a NULL component becomes NaN, a NULL list has no components."""
    offsets = _offsets(column)
    sizes = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
    return column.values.to_numpy(zero_copy_only=False), offsets[:-1].astype(np.int64), sizes


def _binaries(column: pa.BinaryArray, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    offsets = _offsets(column).astype(np.int64) // np.dtype(kind).itemsize
    data = column.buffers()[2] if offsets[-1] else b""
    return np.frombuffer(data, kind, count=int(offsets[-1])), offsets[:-1], np.diff(offsets)


def k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centroids = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        nearest = distances(x, centroids).argmin(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, x)
        counts = np.bincount(nearest, minlength=len(centroids))
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return np.unique(centroids, axis=0)


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances."""
    squares = (x**2).sum(1)[:, None] - 2 * x @ centroids.T + (centroids**2).sum(1)[None, :]
    return np.maximum(squares, 0)


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x[:, : x.shape[1] // 2], x[:, x.shape[1] // 2 :]


def bounds(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each row, and the least squared distance from the row to any point of every centroid's cell.

    A point of another cell lies behind the plane midway between the two centroids.
    """
    squares = distances(x, centroids)
    nearest = squares.argmin(1)
    apart = np.sqrt(distances(centroids, centroids))[nearest]
    apart[apart < 1e-6] = 0  # rounding makes the plane between two such centroids uncertain
    margin = (squares - squares.min(1, keepdims=True)) / (2 * np.where(apart > 0, apart, 1))
    return nearest, np.where(apart > 0, margin, 0) ** 2


def nearest_cells(first: np.ndarray, second: np.ndarray, reach: float) -> Iterator[tuple[int, int]]:
    """Multi-sequence traversal: cells of the product grid in the order of the sum of their halves' distances, up to
    ``reach``."""
    rows, columns = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    near, far = first[rows], second[columns]
    queue, seen = [(near[0] + far[0], 0, 0)], {(0, 0)}
    while queue and queue[0][0] <= reach:
        _, i, j = heapq.heappop(queue)
        yield int(rows[i]), int(columns[j])
        for step in ((i + 1, j), (i, j + 1)):
            if step[0] < len(near) and step[1] < len(far) and step not in seen:
                seen.add(step)
                heapq.heappush(queue, (near[step[0]] + far[step[1]], *step))


def spread(x: np.ndarray, count: int, rng: np.random.Generator, rounds: int = 5) -> np.ndarray:
    """Orthonormal columns near the directions in which the rows of ``x`` are longest, by subspace iteration."""
    axes = np.linalg.qr(rng.normal(size=(x.shape[1], min(count, x.shape[1]))))[0]
    for _ in range(rounds):
        axes = np.linalg.qr(x.T @ (x @ axes))[0]
    return axes


def fit(vectors: DataFrame, kind: str, how: Search) -> Index | None:
    """Codebooks and directions from a sample, None without vectors.

    The radius is the exact one: two vectors at the threshold are no further apart, so one visits the cell of the other.
    """
    groups = vectors.groupBy("label", "size").agg(F.count(F.lit(1)).alias("rows"))
    total = groups.agg(F.sum("rows").alias("rows"), F.max("rows").alias("most"), F.max("size").alias("size")).first()
    if not total["rows"]:
        return None
    order = seeded_order(F.col("vec_id"), how.seed)
    # Twice the share, so that the first ones in this order are among them, and only a few more than these are sent.
    share = min(1.0, 2 * (how.sample + 100) / total["rows"])
    few = vectors if share == 1 else vectors.where(order < int(-(1 << 63) + share * (1 << 64)))
    rows = few.orderBy(order, "vec_id").limit(how.sample).select("vector").collect()
    x = np.zeros((len(rows), total["size"]))
    for to, row in zip(x, rows, strict=True):
        values = np.frombuffer(row["vector"], kind)
        to[: len(values)] = directions(values[None])[1][0]
    rng = np.random.default_rng(how.seed)
    k = int(np.clip(np.sqrt(total["most"] / how.cell_rows), 4, 1024))
    codebooks = tuple(k_means(half, k, rng) for half in halves(x))
    return Index(codebooks, 2 - 2 * how.threshold + 1e-9, total["size"], spread(x, how.axes, rng))


# --- classes and blocks ----------------------------------------------------------------------------------------------


_KEYS = ["label", "size", "high", "low"]
_ROW = "vec_id bigint, label bigint, size bigint, high bigint, low bigint"


def _digests(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows with a direction, their length, and 128 bits that stand for their values."""
    able, out = np.zeros(len(column), bool), np.zeros((len(column), 2), np.int64)
    flat, starts, sizes = _lists(column)
    for at, values in by_size(flat, starts, sizes):
        x, _, able[at] = directions(values)
        digests = b"".join(xxhash.xxh3_128_digest(row) for row in x)
        out[at] = np.frombuffer(digests, np.int64).reshape(len(at), 2)
    return able, sizes.astype(np.int64), out


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        able, sizes, digests = _digests(batch.column(2))
        found = [pa.array(c, pa.int64(), mask=~able) for c in (sizes, digests[:, 0], digests[:, 1])]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *found], ["vec_id", *_KEYS])


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a direction, the components as bytes."""
    for batch in batches:
        able, sizes, digests = _digests(batch.column(2))
        at = np.flatnonzero(able)
        flat = batch.column(2).take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        offsets = np.zeros(len(at) + 1, np.int32)
        np.cumsum(sizes[at] * flat.itemsize, out=offsets[1:])
        vectors = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
        found = [pa.array(c[at]) for c in (sizes, digests[:, 0], digests[:, 1])]
        ids = [batch.column(i).take(pa.array(at)) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([*ids, *found, vectors], ["vec_id", *_KEYS, "vector"])


def _place(index: Index, kind: str):
    """Each row's cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(index.codebooks[1])
        for batch in batches:
            home = np.zeros(batch.num_rows, np.int64)
            for at, values in by_size(*_binaries(batch.column("vector"), kind)):
                one, two = (distances(h, c).argmin(1) for h, c in zip(_unit_halves(values, index), index.codebooks))
                home[at] = one * width + two
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home)], [*batch.schema.names, "home"])

    return run


def _unit_halves(values: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    x = np.zeros((len(values), index.size))
    x[:, : values.shape[1]] = directions(values)[1]
    return halves(x)


_BLOCK = (
    "label bigint, size bigint, part int, number bigint, rows bigint, ids binary, weights binary, homes binary, vectors binary"
)


def in_blocks(placed: DataFrame, kind: str, how: Search) -> DataFrame:
    """Rows of one label and length in the order of their cells, a fixed number to a block."""
    width = np.dtype(kind).itemsize
    names = [field.split()[0] for field in _BLOCK.split(", ")]
    kinds = [*[pa.int64()] * 2, pa.int32(), *[pa.int64()] * 2, *[pa.binary()] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, number = None, 0

        def cut(rows: pa.Table, start: int, end: int) -> tuple:
            held = rows.slice(start, end - start)
            first, *numbers = (held[c].to_numpy() for c in ("part", "vec_id", "n", "home"))
            column = held["vector"].chunk(0)
            offsets = _offsets(column)
            vectors = column.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes()
            key = held["label"][0].as_py(), held["size"][0].as_py()
            return *key, int(first[0]), number, end - start, *(x.tobytes() for x in numbers), vectors

        def blocks(rows: pa.Table, starts: list[int]) -> Iterator[tuple]:
            nonlocal number
            for start, end in zip(starts, starts[1:]):
                yield cut(rows, start, end)
                number += 1

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*found), kinds)], names)

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = (rows if waiting is None else pa.concat_tables([waiting, rows])).combine_chunks()
            keys = np.stack([rows["label"].to_numpy(), rows["size"].to_numpy()], 1)
            runs = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            starts = [0]
            for start, end in zip(runs, runs[1:]):
                step = max(1, min(how.block, BLOB // (width * int(keys[start, 1] if len(keys) else 1))))
                starts += range(start + step, end, step)
                starts += [end] if end < len(keys) else []
            if found := list(blocks(rows, starts)):
                yield batch_of(found)
            waiting = rows.slice(starts[-1])  # its block may go on
        if waiting is not None and waiting.num_rows:
            yield batch_of(list(blocks(waiting.combine_chunks(), [0, waiting.num_rows])))

    spark = placed.sparkSession
    size = placed.agg(F.sum(F.col("size") * width + 24)).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / how.held))
    order = ["label", "size", "home", "vec_id"]
    ordered = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    columns = [F.spark_partition_id().alias("part"), "label", "size", "vec_id", "n", "home", "vector"]
    return ordered.select(*columns).mapInArrow(run, _BLOCK)


# --- links -----------------------------------------------------------------------------------------------------------


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the groups of ``a[i]`` and ``b[i]``; ``root`` holds the first member of everyone's group."""
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root[:] = root[root]


class _Rows(NamedTuple):
    """Rows of some blocks."""

    ids: np.ndarray
    weights: np.ndarray
    homes: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of(cls, blocks: list[tuple], size: int, kind: str) -> _Rows:
        *numbers, vectors = ([np.frombuffer(x, t) for x in c] for c, t in zip(zip(*blocks), (*[np.int64] * 3, kind)))
        return cls(*map(np.concatenate, numbers), np.concatenate(vectors).reshape(-1, size))

    def slice(self, start: int, end: int) -> _Rows:
        return _Rows(*(x[start:end] for x in self))


class _Meeting:
    """Links between the rows of two spans, or within one: each pair is looked at once and counts for both."""

    def __init__(self, held: _Rows, index: Index, threshold: float):
        self.held, self.index, self.threshold = held, index, threshold
        self.reach = np.float32(index.reach + ROUNDING)
        cells, starts = np.unique(held.homes, return_index=True)
        ends = [*starts[1:].tolist(), len(held.homes)]
        self.cells = dict(zip(cells.tolist(), zip(starts.tolist(), ends)))
        width = len(index.codebooks[1])
        self.firsts, self.seconds = np.unique(cells // width), np.unique(cells % width)
        self.ids, self.weights = held.ids, held.weights
        self.links, self.root = np.zeros(len(held.ids), np.int64), np.arange(len(held.ids))
        self.right = self._along(held, lambda x, squares: [x, np.ones_like(squares), squares]).T.copy()

    def _along(self, rows: _Rows, columns) -> np.ndarray:
        """Rows of two such tables have the product that is their squared distance along the index's axes."""
        out = np.empty((len(rows.ids), self.index.axes.shape[1] + 2), np.float32)
        step = max(1, SLICE // max(1, rows.vectors.shape[1]))
        for i in range(0, len(out), step):
            x = directions(rows.vectors[i : i + step])[1]
            x = x @ self.index.axes[: x.shape[1]]
            out[i : i + step] = np.concatenate(columns(x, (x**2).sum(1, keepdims=True)), 1)
        return out

    def _margins(self, left: _Rows) -> tuple[np.ndarray, np.ndarray]:
        """Least squared distance of each row, in either half, from the held rows' cells: a line per centroid."""
        wanted = self.firsts, self.seconds
        out = tuple(np.empty((len(w), len(left.ids)), np.float32) for w in wanted)
        step = max(1, SLICE // max(self.index.size, *map(len, self.index.codebooks)))
        for i in range(0, len(left.ids), step):
            both = _unit_halves(left.vectors[i : i + step], self.index)
            for to, half, codebook, w in zip(out, both, self.index.codebooks, wanted):
                to[:, i : i + step] = bounds(half, codebook)[1][:, w].T
        return out

    def _visits(self, left: _Rows) -> Iterator[tuple[np.ndarray, int, int]]:
        """Left rows, and the first and the last held row that they visit, cell by cell."""
        if len(left.ids) * len(self.held.ids) <= SLICE // 4:  # few pairs are sooner compared than their cells found
            yield np.arange(len(left.ids)), 0, len(self.held.ids)
            return
        first, second = self._margins(left)
        width = len(self.index.codebooks[1])
        firsts, seconds = self.firsts.tolist(), self.seconds.tolist()
        visited: dict[int, list[int]] = {}
        for i, j in nearest_cells(first.min(1), second.min(1), self.reach):
            if firsts[i] * width + seconds[j] in self.cells:
                visited.setdefault(i, []).append(j)
        for i, found in visited.items():  # rows are looked for among those that come near the first half of the cell
            able = np.flatnonzero(first[i] <= self.reach)
            sums = second[:, able] + first[i, able]
            for j in found:
                yield able[np.flatnonzero(sums[j] <= self.reach)], *self.cells[firsts[i] * width + seconds[j]]

    def within(self, step: int) -> None:
        for i in range(0, len(self.held.ids), step):
            self._search(self.held.slice(i, i + step), i, True)

    def meet(self, left: _Rows) -> None:
        base = len(self.ids)
        self.ids, self.weights = np.concatenate([self.ids, left.ids]), np.concatenate([self.weights, left.weights])
        self.links = np.concatenate([self.links, np.zeros(len(left.ids), np.int64)])
        self.root = np.concatenate([self.root, np.arange(base, len(self.ids))])
        self._search(left, base, False)

    def _search(self, left: _Rows, base: int, same: bool) -> None:
        """``base``: the place of the first left row among all rows; ``same``: they are held, too."""
        along = self._along(left, lambda x, squares: [-2 * x, squares, np.ones_like(squares)])
        likely: list[tuple[np.ndarray, np.ndarray]] = []
        count = 0
        for visitors, start, last in self._visits(left):
            own = along[visitors]
            for at in range(max(start, base + 1) if same else start, last, SIDE):
                end = min(at + SIDE, last)
                step = SLICE // (end - at)
                for k in range(0, len(visitors), step):
                    near = own[k : k + step] @ self.right[:, at:end] <= self.reach
                    found = np.count_nonzero(near)
                    if 8 * found > near.size:
                        self._all(left, base, visitors[k : k + step], at, end, same)
                    elif found:
                        i, j = np.divmod(np.flatnonzero(near), end - at)
                        likely.append((visitors[k + i], j + at))
                        count += found
                    if count >= SLICE:
                        self._some(left, base, likely, same)
                        likely, count = [], 0
        if likely:
            self._some(left, base, likely, same)

    def _some(self, left: _Rows, base: int, likely: list[tuple[np.ndarray, np.ndarray]], same: bool) -> None:
        """Cosines of some pairs."""
        i, j = (np.concatenate(x) for x in zip(*likely))
        able = self.ids[i + base] != self.ids[j]
        able &= (i + base < j) if same else True
        i, j = i[able], j[able]
        step = max(1, SLICE // left.vectors.shape[1])
        linked = np.zeros(len(i), bool)
        for k in range(0, len(i), step):
            x, y = directions(left.vectors[i[k : k + step]])[1], directions(self.held.vectors[j[k : k + step]])[1]
            linked[k : k + step] = np.einsum("ij,ij->i", x, y) >= self.threshold
        i, j = i[linked] + base, j[linked]
        for a, b in ((i, j), (j, i)):
            self.links += np.bincount(a, self.weights[b], len(self.ids)).astype(np.int64)
        unite(self.root, i, j)

    def _all(self, left: _Rows, base: int, visitors: np.ndarray, start: int, end: int, same: bool) -> None:
        """Cosines of all pairs of some rows."""
        x, y = directions(left.vectors[visitors])[1], directions(self.held.vectors[start:end])[1]
        i, j = visitors + base, np.arange(start, end)
        linked = (x @ y.T >= self.threshold) & (self.ids[i][:, None] != self.ids[j][None, :])
        if same:
            linked &= i[:, None] < j[None, :]
        self.links[i] += (linked @ self.weights[j].astype(float)).astype(np.int64)
        self.links[j] += (self.weights[i].astype(float) @ linked).astype(np.int64)
        a, b = np.nonzero(linked & (self.root[i][:, None] != self.root[j][None, :]))
        unite(self.root, i[a], j[b])

    def found(self) -> Iterator[pa.RecordBatch]:
        """Rows with links, their number, and the smallest id of those that hang together here."""
        smallest = np.full(len(self.ids), np.iinfo(np.int64).max)
        np.minimum.at(smallest, self.root, self.ids)
        hit = self.links > 0
        if hit.any():
            columns = [self.ids[hit], self.links[hit], smallest[self.root[hit]]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["vec_id", "links", "root"])


def _meet(index: Index, kind: str, how: Search):
    """Pairs of spans, each with the blocks to be held before those that pass by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, left, meeting = None, [], [], None

        def pass_by() -> None:
            nonlocal meeting, held, left
            if held:
                meeting, held = _Meeting(_Rows.of(held, key[1], kind), index, how.threshold), []
            if meeting is not None and left:
                meeting.meet(_Rows.of(left, key[1], kind))
            left = []

        def end() -> Iterator[pa.RecordBatch]:
            nonlocal held, meeting
            if key is not None:
                within = key[2] == key[3]
                if left or within:
                    pass_by()
                if meeting is not None:
                    if within:
                        meeting.within(LEFT_BLOCKS * how.block)
                    yield from meeting.found()
            held, meeting = [], None

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("label", "size", "i", "j"))))
            passing = batch.column("passing").to_pylist()
            for row, own in enumerate(keys):
                if own != key:
                    yield from end()
                    key = own
                block = tuple(batch.column(c)[row].as_buffer() for c in ("ids", "weights", "homes", "vectors"))
                (left if passing[row] else held).append(block)
                if len(left) == LEFT_BLOCKS:
                    pass_by()
        yield from end()

    return run


def spans(blocks: DataFrame, kind: str, how: Search) -> tuple[DataFrame, int, int]:
    """``label, size, part, span, spans``: which span the blocks of a part belong to, for labels that lie in several
    parts; the bytes of all blocks, and those shuffled when every span meets every other of its label and itself."""
    width = np.dtype(kind).itemsize
    bytes_ = F.sum(F.col("rows") * (F.col("size") * width + 24)).alias("bytes")
    parts = stored(blocks.groupBy("label", "size", "part").agg(bytes_))
    several = parts.groupBy("label", "size").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1").drop("parts")
    of_group: dict[tuple, list] = {}  # no more of these than parts begin within a label or end in one
    for row in parts.join(several, ["label", "size"]).collect():
        of_group.setdefault((row["label"], row["size"]), []).append((row["part"], row["bytes"]))
    total = parts.agg(F.sum("bytes")).first()[0] or 0
    rows, shuffled = [], total
    for (label, size), found in of_group.items():
        before = np.cumsum([0, *(n for _, n in sorted(found))])
        number = (before[:-1] // how.held).tolist()
        number = np.unique(number, return_inverse=True)[1].tolist()
        rows += [(label, size, part, span, number[-1] + 1) for (part, _), span in zip(sorted(found), number)]
        shuffled += number[-1] * int(before[-1])
    schema = "label bigint, size bigint, part int, span int, spans int"
    return blocks.sparkSession.createDataFrame(rows, schema), total, shuffled


def links(blocks: DataFrame, index: Index, kind: str, how: Search) -> DataFrame:
    """``vec_id, links, root`` per row of a pair of spans that has links there.

    The pairs of spans are dealt to rounds, so that only a bounded part of them lies on disk at a time.
    """
    spark = blocks.sparkSession
    numbers, total, shuffled = spans(blocks, kind, how)
    rounds = max(1, math.ceil(shuffled / max(how.shipped * total, LEAST_SHIPPED)))
    tasks = max(4 * spark.sparkContext.defaultParallelism, math.ceil(4 * shuffled / rounds / how.held))  # about 8 a pair, so that few meet
    numbered = blocks.join(F.broadcast(numbers), ["label", "size", "part"], "left").na.fill({"span": 0, "spans": 1})
    schema, paths = "vec_id bigint, links bigint, root bigint", []

    def turn(other):
        return F.pmod(F.xxhash64("label", "size", F.least("span", other), F.greatest("span", other)), F.lit(rounds))

    for own in range(rounds):
        others = F.filter(F.sequence(F.lit(0), F.col("spans") - 1), lambda other: turn(other) == own)
        dealt = numbered.withColumn("other", F.explode(others)).withColumns(
            {"i": F.least("span", "other"), "j": F.greatest("span", "other"), "passing": F.col("span") > F.col("other")}
        )
        keys = ["label", "size", "i", "j"]
        dealt = dealt.select(*keys, "passing", "part", "number", "ids", "weights", "homes", "vectors")
        met = dealt.repartition(tasks, *keys).sortWithinPartitions(*keys, "passing", "part", "number")
        paths.append(fresh_folder(spark, "links"))
        met.mapInArrow(_meet(index, kind, how), schema).write.parquet(paths[-1])
    return spark.read.schema(schema).parquet(*paths)


# Files of a shuffle go when its stage is stored; blocks are read and sent to Python a few at a time.
_STAGES = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    "spark.sql.parquet.columnarReaderBatchSize": "256",
}


def _found(values: DataFrame, classes: DataFrame, kind: str, how: Search) -> DataFrame:
    """``first_id, links, component`` of classes; what is stored on the way is removed once the next stage stands."""
    spark = values.sparkSession
    places = [fresh_folder(spark, name) for name in ("placed", "blocks")]
    with scratch(spark):
        firsts = classes.select(F.col("first_id").alias("vec_id"), *_KEYS, "n")
        of_first = values.mapInArrow(_vectors, f"{_ROW}, vector binary").join(firsts, ["vec_id", *_KEYS])
        columns = ["vec_id", "label", "size", "n", "vector"]
        reps = stored(of_first.dropDuplicates(["vec_id", *_KEYS]).select(*columns))
        index = fit(reps, kind, how)
        if index is None:
            return classes.select("first_id", F.lit(0).cast("bigint").alias("links"), F.col("first_id").alias("component"))
        schema = "vec_id bigint, label bigint, size bigint, n bigint, vector binary, home bigint"
        reps.mapInArrow(_place(index, kind), schema).write.parquet(places[0])
    in_blocks(spark.read.schema(schema).parquet(places[0]), kind, how).write.parquet(places[1])
    remove_folder(spark, places[0])
    hits = links(spark.read.schema(_BLOCK).parquet(places[1]), index, kind, how)
    remove_folder(spark, places[1])
    sums = hits.groupBy("vec_id").agg(F.sum("links").alias("links"))
    edges = hits.where("root != vec_id").select(F.col("vec_id").alias("a"), F.col("root").alias("b"))
    return sums.join(components(edges).withColumnRenamed("id", "vec_id"), "vec_id", "left").select(
        F.col("vec_id").alias("first_id"), "links", "component"
    )


def near_duplicates(vectors: DataFrame, how: Search = Search()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vectors(vec_id, embedding, label)``.

    Vectors of one label and length are linked if their cosine, in double precision, is ``threshold`` or more.

    - Equal vectors form a class; its smallest id stands for it, and links count all its vectors.
    - Every class lies in one cell of the product grid of two codebooks. Rows are stored once, in blocks in the order of their
      cells; consecutive blocks of a label form spans of bounded size.
    - Every pair of spans of a label meets in one task, some pairs at a time: rows of one visit the cells of the other in order
      of a bound on the distance, up to the radius, and rows that are near along a few axes are compared in full. What leaves
      is a row per vector, not per pair.

    Vectors that are NULL, empty, zero or hold NULL or values that are not finite, and vectors without label or id, are
    linked with nothing; ``component_id`` of a vector without id is NULL, and it is kept. Rows that repeat id, label and
    vector count as one vector, and each is returned.
    """
    if "label" not in vectors.columns:
        raise ValueError("vectors need a label")
    embedding = vectors.schema["embedding"].dataType
    kind, cast = ("f4", "array<float>") if embedding == ArrayType(FloatType(), embedding.containsNull) else ("f8", "array<double>")
    values = vectors.select(
        F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), F.col("embedding").cast(cast)
    )
    with settings(vectors.sparkSession, _STAGES):
        rows = stored(values.mapInArrow(_classes, _ROW))
        able = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND size IS NOT NULL").distinct()
        classes = stored(able.groupBy(*_KEYS).agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("n")))
        found = stored(_found(values, classes, kind, how))
    result = rows.join(classes, _KEYS, "left")
    labelled = result.join(found, "first_id", "left")
    component = F.coalesce("component", "first_id", "vec_id")
    return labelled.select(
        "vec_id",
        F.when(F.col("vec_id").isNull(), 0)
        .otherwise(F.coalesce(F.col("n") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)))
        .cast("bigint")
        .alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), component).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
