"""Hard negatives from blocks of vectors in Hilbert order, chosen by interval bounds on the inner product."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.llm.common import seeded_order
from daymark.session import stored


class Mining(NamedTuple):
    """``positives`` and ``negatives``: how many of each; a negative's score lies between ``low_per_cent`` of its positive's and
    the whole of it.

    ``sample``: vectors that the axes and levels of the Hilbert curve are fitted to, which decide where a row lies and nothing
    else; ``axes`` of ``1 << bits`` levels each; ``block``: rows of a candidate block; ``group``: anchors that read
    together; ``seeds``: blocks an anchor reads first, which tells it how high its other blocks must reach; ``zones`` and
    ``slots``: zone maps and groups of anchors that meet in one task at a time."""

    positives: int = 5
    negatives: int = 5
    low_per_cent: int = 80
    sample: int = 10_000
    axes: int = 6
    bits: int = 6
    block: int = 128
    group: int = 64
    seeds: int = 2
    zones: int = 512
    slots: int = 16
    seed: int = 5


def quantised(embedding: str, scale: int = 256) -> Column:
    """Components times ``scale``, rounded down; NULL for a vector that is NULL or holds NULL or values that are not finite."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(finite, F.transform(embedding, lambda x: F.floor(scale * x.cast("double"))))


# --- whole numbers ---------------------------------------------------------------------------------------------------

_LONG = np.iinfo(np.int64)


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and of ``b``; one beyond 64 bits becomes the nearest number that fits."""
    most = a.shape[1]
    for x in (a, b):
        most *= max(int(x.max(initial=0)), -int(x.min(initial=0)))
    if most < 1 << 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    products = a.astype(object) @ b.T.astype(object)
    return np.clip(products, int(_LONG.min), int(_LONG.max)).astype(np.int64)


def packed(x: np.ndarray) -> bytes:
    """A table of numbers, in 32 bits each if they fit."""
    small = np.iinfo(np.int32)
    fits = small.min <= x.min(initial=0) and x.max(initial=0) <= small.max
    return x.astype(np.int32 if fits else np.int64).tobytes()


def unpacked(data: bytes, rows: int, width: int) -> np.ndarray:
    kind = np.int64 if len(data) == 8 * rows * width else np.int32
    return np.frombuffer(data, kind).reshape(rows, width).astype(np.int64)


# --- the curve and the blocks ----------------------------------------------------------------------------------------


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of coordinates below ``1 << bits`` on the Hilbert curve (Skilling's transformation)."""
    x = [column.astype(np.int64) for column in points.T]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(len(x)):
            flip = (x[i] >> bit & 1).astype(bool)
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0]) ^ swap
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0)
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for column in x:
            place = place << 1 | ((column ^ turn) >> bit & 1)
    return place


class Curve(NamedTuple):
    """Directions in which the vectors of one length differ most, and the borders of the levels along each."""

    axes: np.ndarray
    borders: np.ndarray

    def places(self, x: np.ndarray, bits: int) -> np.ndarray:
        along = x @ self.axes
        levels = [np.searchsorted(border, column) for border, column in zip(self.borders, along.T)]
        return hilbert(np.stack(levels, 1), bits)


def fit(rows: DataFrame, how: Mining) -> dict[int, Curve]:
    """A curve per length of vector, from a bounded sample."""
    sample = rows.orderBy(seeded_order(F.col("vec_id"), how.seed), "vec_id").limit(how.sample).select("vector").collect()
    by_size: dict[int, list] = {}
    for row in sample:
        by_size.setdefault(len(row["vector"]), []).append(row["vector"])
    curves = {}
    for size, vectors in by_size.items():
        if size and len(vectors) > 1:
            x = np.array(vectors, float)
            _, directions = np.linalg.eigh(np.cov(x / max(np.abs(x).max(), 1), rowvar=False).reshape(size, size))
            axes = directions[:, ::-1][:, : how.axes]
            shares = np.arange(1, 1 << how.bits) / (1 << how.bits)
            curves[size] = Curve(axes, np.quantile(x @ axes, shares, axis=0).T)
    return curves


def placed(rows: DataFrame, how: Mining) -> DataFrame:
    """``rows(vec_id, label, anchor, vector)`` with ``size`` and ``place``, their place on the curve."""
    curves = fit(rows, how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(3)
            sizes = np.diff(vectors.offsets.to_numpy())
            flat, starts = vectors.values.to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()
            places = np.zeros(batch.num_rows, np.int64)
            for size in np.unique(sizes):
                if int(size) in curves:
                    at = np.flatnonzero(sizes == size)
                    x = flat[starts[at][:, None] + np.arange(size)].astype(float)
                    places[at] = curves[int(size)].places(x, how.bits)
            columns = [*batch.columns, pa.array(sizes, pa.int32()), pa.array(places)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "anchor", "vector", "size", "place"])

    return rows.mapInArrow(run, "vec_id bigint, label bigint, anchor boolean, vector array<bigint>, size int, place bigint")


_BLOCK = "id bigint, size int, n int, ids binary, labels binary, vectors binary, low binary, high binary, names array<bigint>"


def in_blocks(rows: DataFrame, per_block: int) -> DataFrame:
    """Rows in the order of the curve, a fixed number to a block, with the block's zone map: the lowest and highest value of each
    component, and the labels in it."""

    def block(number: int, size: int, held: list[tuple]) -> pa.RecordBatch:
        ids, labels, vectors = zip(*held)
        x, names = np.array(vectors, np.int64).reshape(len(held), size), np.array(labels, np.int64)
        values = [
            [number], [size], [len(held)], [np.array(ids, np.int64).tobytes()], [names.tobytes()], [packed(x)],
            [packed(x.min(0)[None])], [packed(x.max(0)[None])], [np.unique(names).tolist()],
        ]
        kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 5, pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays(
            [pa.array(v, kind) for v, kind in zip(values, kinds)], [f.split()[0] for f in _BLOCK.split(", ")]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], None, None
        for batch in batches:
            for part, *row, of_size in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if held and (of_size != size or len(held) == per_block):
                    yield block(number, size, held)
                    held, number = [], number + 1
                size, number = of_size, part << 32 if number is None else number
                held.append(tuple(row))
        if held:
            yield block(number, size, held)

    ordered = rows.repartitionByRange("size", "place", "vec_id").sortWithinPartitions("size", "place", "vec_id")
    columns = [F.spark_partition_id().cast("bigint").alias("part"), "vec_id", "label", "vector", "size"]
    return stored(ordered.select(*columns).mapInArrow(run, _BLOCK))


# --- choosing blocks -------------------------------------------------------------------------------------------------


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest inner product that each anchor can have with a vector between ``low`` and ``high``."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    signs = np.concatenate([up, down], 1)
    return dot(signs, np.concatenate([low, high], 1)), dot(signs, np.concatenate([high, low], 1))


def _over_zones(choose: Callable, names: list[str], kinds: list[pa.DataType]) -> Callable:
    """Groups of anchors with zone maps of the same length: ``choose`` gets a group's row, labels, the blocks' ids, whether a
    block holds the label and any other, and the bounds."""

    def run(groups: pa.Table, zones: pa.Table) -> pa.Table:
        maps: dict[int, list[dict]] = {}
        for zone in zones.select(["block", "size", "low", "high", "names"]).to_pylist():
            maps.setdefault(zone["size"], []).append(zone)
        out: list[tuple] = []
        for group in groups.to_pylist():
            of_size = maps.get(group["size"])
            if not of_size:
                continue
            size = group["size"]
            low, high = (np.concatenate([unpacked(z[side], 1, size) for z in of_size]) for side in ("low", "high"))
            blocks = np.array([z["block"] for z in of_size])
            labels = np.frombuffer(group["labels"], np.int64)
            same = np.array([[label in z["names"] for z in of_size] for label in labels.tolist()])
            other = np.array([[len(z["names"]) > 1] for z in of_size]).T | ~same
            least, most = bounds(unpacked(group["vectors"], group["n"], size), low, high)
            out += choose(group, blocks, same, other, least, most)
        columns = list(zip(*out)) if out else [()] * len(names)
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds)], names)

    return run


def _seeds(count: int) -> Callable:
    """The blocks with the highest bounds for each anchor, of those with its label and of all others."""

    def choose(group, blocks, same, other, least, most):
        for i in range(group["n"]):
            for kind, able in enumerate((same[i], other[i])):
                at = np.flatnonzero(able)
                for b in at[np.lexsort((blocks[at], -most[i, at]))[:count]].tolist():
                    yield group["group"], i, kind, int(blocks[b]), int(most[i, b])

    return choose


def _needed(group, blocks, same, other, least, most):
    """Blocks that can hold a score within one of the anchors' windows, and the anchors concerned."""
    wanted = np.zeros(most.shape, bool)
    for window in group["windows"] or []:
        i = window["i"]
        able = same[i] if window["same"] else other[i]
        wanted[i] |= able & (most[i] >= window["low"]) & (least[i] <= window["high"])
    for b in np.flatnonzero(wanted.any(0)).tolist():
        yield group["group"], int(blocks[b]), np.flatnonzero(wanted[:, b]).tolist()


def _numbers(count: Column) -> Column:
    """Array of the numbers below ``count``, which is 1 or more."""
    return F.sequence(F.lit(0).cast("bigint"), count.cast("bigint") - 1)


class Index(NamedTuple):
    """Candidate blocks, their zone maps dealt to chunks, and groups of anchors; all stored."""

    blocks: DataFrame
    zones: DataFrame
    groups: DataFrame
    chunks: int
    slots: int

    @classmethod
    def of(cls, rows: DataFrame, how: Mining) -> Index:
        on_curve = stored(placed(rows, how))
        blocks = in_blocks(on_curve, how.block).withColumnRenamed("id", "block")
        anchors = in_blocks(on_curve.where("anchor"), how.group).withColumnRenamed("id", "group")
        chunks, slots = -(-blocks.count() // how.zones) or 1, -(-anchors.count() // how.slots) or 1
        chunk = F.pmod(F.xxhash64("block"), F.lit(chunks)).alias("chunk")
        zones = blocks.select("block", "size", "low", "high", "names", chunk)
        slot = F.pmod(F.xxhash64("group"), F.lit(slots)).alias("slot")
        groups = anchors.select("group", "size", "n", "ids", "labels", "vectors", slot)
        return cls(blocks.select("block", "n", "ids", "labels", "vectors"), zones, groups, chunks, slots)

    def met(self, groups: DataFrame, choose: Callable, fields: list[tuple[str, pa.DataType]], schema: str) -> DataFrame:
        """Every group with every zone map, in tasks of bounded size."""
        left = groups.withColumn("chunk", F.explode(_numbers(F.lit(self.chunks))))
        right = self.zones.withColumn("slot", F.explode(_numbers(F.lit(self.slots))))
        names, kinds = [f[0] for f in fields], [f[1] for f in fields]
        sides = left.groupBy("chunk", "slot").cogroup(right.groupBy("chunk", "slot"))
        return sides.applyInArrow(_over_zones(choose, names, kinds), schema)

    def seeds(self, how: Mining) -> DataFrame:
        """``group, block, members``: what each anchor reads first."""
        fields = [(name, pa.int64()) for name in ("group", "i", "kind", "block", "most")]
        found = self.met(self.groups, _seeds(how.seeds), fields, ", ".join(f"{name} bigint" for name, _ in fields))
        best = Window.partitionBy("group", "i", "kind").orderBy(F.desc("most"), "block")
        first = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= how.seeds)
        return stored(first.groupBy("group", "block").agg(F.array_sort(F.collect_set("i")).alias("members")))

    def with_windows(self, windows: DataFrame) -> DataFrame:
        """Groups with the windows ``group, i, positive_id, same, low, high`` of their anchors."""
        each = F.struct("i", "positive_id", "same", "low", "high")
        return self.groups.join(windows.groupBy("group").agg(F.collect_list(each).alias("windows")), "group")

    def needed(self, groups: DataFrame) -> DataFrame:
        fields = [("group", pa.int64()), ("block", pa.int64()), ("members", pa.list_(pa.int64()))]
        return self.met(groups, _needed, fields, "group bigint, block bigint, members array<bigint>")

    def read(self, needs: DataFrame, groups: DataFrame, best: int) -> DataFrame:
        """The best scores within each window: ``group, i, anchor_id, positive_id, positive_score, rank, vec_id, score``."""
        asked = needs.join(groups.drop("slot").withColumnsRenamed({c: f"own_{c}" for c in ("n", "ids", "labels", "vectors")}), "group")
        found = asked.join(self.blocks, "block").mapInArrow(
            _scores(best),
            "group bigint, i bigint, anchor_id bigint, positive_id bigint, positive_score bigint, vec_id bigint, score bigint",
        )
        order = Window.partitionBy("group", "i", "positive_id").orderBy(F.desc("score"), "vec_id")
        return stored(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best))


def _scores(best: int) -> Callable:
    """The rows of a block within the windows of the anchors that asked for it, the best of them for each window."""
    names = ["group", "i", "anchor_id", "positive_id", "positive_score", "vec_id", "score"]

    def rows(row: dict) -> Iterator[tuple]:
        size, members = row["size"], row["members"]
        own = unpacked(row["own_vectors"], row["own_n"], size)[members]
        ids, labels = (np.frombuffer(row[name], np.int64) for name in ("ids", "labels"))
        own_ids, own_labels = (np.frombuffer(row[f"own_{name}"], np.int64) for name in ("ids", "labels"))
        scores = dot(own, unpacked(row["vectors"], row["n"], size))
        at = {i: k for k, i in enumerate(members)}
        for window in row["windows"] or []:
            i = window["i"]
            if i not in at:
                continue
            score = scores[at[i]]
            able = (labels == own_labels[i]) & (ids != own_ids[i]) if window["same"] else labels != own_labels[i]
            able &= (score >= window["low"]) & (score <= window["high"])
            found = np.flatnonzero(able)
            for b in found[np.lexsort((ids[found], -score[found]))[:best]].tolist():
                yield (
                    row["group"], i, int(own_ids[i]), window["positive_id"], window["high"], int(ids[b]), int(score[b])
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 16):
                out = [found for row in batch.slice(start, 16).to_pylist() for found in rows(row)]
                columns = list(zip(*out)) if out else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return run


def _raised(windows: DataFrame, found: DataFrame, best: int) -> DataFrame:
    """Windows whose lower end is the last of the ``best`` scores already found in them, if there are as many."""
    last = found.where(F.col("rank") == best).select("group", "i", "positive_id", F.col("score").alias("last"))
    # An anchor's first windows have no positive; 0 stands for it.
    joined = windows.join(last, ["group", "i", "positive_id"], "left")
    return joined.withColumn("low", F.greatest("low", "last")).drop("last")


def mined(vectors: DataFrame, how: Mining = Mining()) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of ``vectors(vec_id, label, vector, anchor)``.

    ``vector`` is an array of whole numbers, ``anchor`` says which rows are searched for. A row's score is its inner product with
    the anchor, higher ones first, ties by smaller id. An anchor's positives are its first ``positives`` other rows of
    its label; for each, the first ``negatives`` rows of other labels with ``low_per_cent`` to 100 per cent of its score.

    1. Rows are sorted along a Hilbert curve and cut into blocks, which are stored with zone maps.
    2. Interval arithmetic on the zone maps bounds the scores that an anchor can meet in a block. Each anchor first reads the few
       blocks with the highest bounds; the scores found there are a floor for the rest of its window.
    3. It then reads every block whose bounds reach into its windows; no other can hold a row of the result.

    Anchors that lie near each other on the curve read together. Zone maps and groups of anchors meet in tasks of bounded size.

    Rows without id, label or vector, or with a NULL component, take no part. Rows that repeat an id are one row, the first
    by label, then vector. Vectors of different lengths have no score. Scores beyond 64 bits count as the nearest
    number that fits.
    """
    whole = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.forall("vector", lambda x: x.isNotNull())
    rows = vectors.where(whole).select(
        F.col("vec_id").cast("bigint"),
        F.struct(F.col("label").cast("bigint").alias("label"), F.col("vector").cast("array<bigint>").alias("vector"), "anchor").alias("row"),
    )
    rows = stored(rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.anchor", "row.vector"))
    index = Index.of(rows, how)
    seeds = index.seeds(how)

    lowest, highest = F.lit(int(_LONG.min)), F.lit(int(_LONG.max))
    open_windows = index.groups.select("group", F.explode(_numbers(F.col("n"))).alias("i")).select(
        "group", "i", F.lit(0).cast("bigint").alias("positive_id"), F.lit(True).alias("same"), lowest.alias("low"), highest.alias("high")
    )
    positives = _searched(index, open_windows, seeds, how.positives).select(
        "group", "i", "anchor_id", F.col("vec_id").alias("positive_id"), "score"
    )
    windows = positives.select(
        "group", "i", "positive_id", F.lit(False).alias("same"),
        F.ceil(F.col("score").cast("decimal(20,0)") * how.low_per_cent / 100).cast("bigint").alias("low"),
        F.col("score").alias("high"),
    ).where(F.col("low") <= F.col("high"))
    found = _searched(index, stored(windows), seeds, how.negatives)
    return found.select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _searched(index: Index, windows: DataFrame, seeds: DataFrame, best: int) -> DataFrame:
    """The best scores in each window, over all blocks that can hold one."""
    first = index.read(seeds, index.with_windows(windows), best)
    groups = stored(index.with_windows(_raised(windows, first, best)))
    return index.read(index.needed(groups), groups, best)
