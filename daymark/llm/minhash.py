"""Near-duplicate documents by min-max hashing."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import _odd_constants, gram_hashes, map_batches, mix, signed, utf8, word_hashes
from daymark.llm.components import components
from daymark.session import stored


class MinMax(NamedTuple):
    """Parameters. A pair of documents with similarity s is compared with probability 1 - (1 - s^rows)^bands.

    Each permutation of the hash values gives two signature values, its minimum and its maximum, so that
    ``bands * rows`` values take half as many permutations. At 0.85 a pair is missed once in two million.

    Members of a bucket that its smallest id does not link are compared by a longer signature first, ``sketch`` values of
    one bit; pairs more than ``margin`` standard deviations below the threshold (one in three million at it) are left
    out. ``block``: members of a bucket that meet in one task at a time.
    """

    shingle_words: int = 5
    per_cent: int = 85
    bands: int = 25
    rows: int = 5
    sketch: int = 1024
    margin: float = 5.0
    block: int = 1024
    seed: int = 1

    @property
    def least_equal(self) -> int:
        """Bits of two sketches that must be equal; half of the bits of unequal values are."""
        wanted = (1 + self.per_cent / 100) / 2
        return int(self.sketch * wanted - self.margin * (self.sketch * wanted * (1 - wanted)) ** 0.5)


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words, A-Z in lower case; of all words if they are fewer.

    64-bit hashes stand for the shingles. Comparing two documents of a million words, some two different shingles share
    one with a probability of about 1e-7.
    """
    if not text:
        return np.empty(0, np.uint64)
    hashes = word_hashes(text.lower().split())  # bytes.lower() changes A-Z only
    if not len(hashes):
        return hashes
    return np.unique(gram_hashes(hashes, min(size, len(hashes))))


def extremes(shingles: np.ndarray, count: int, seed: int) -> np.ndarray:
    """The minima and maxima of the set under ``count / 2`` permutations of the 64-bit integers, in turn."""
    size = -(-count // 2)
    factors, shifts = _odd_constants(size, seed), _odd_constants(size, seed + 1)
    low, high = np.full(size, np.iinfo(np.uint64).max), np.zeros(size, np.uint64)
    step = max(1, (1 << 18) // size)
    for start in range(0, len(shingles), step):
        values = shingles[start : start + step, None] * factors + shifts
        low, high = np.minimum(low, values.min(0)), np.maximum(high, values.max(0))
    return np.stack([low, high], 1).ravel()[:count]


def signature(shingles: np.ndarray, how: MinMax) -> np.ndarray:
    """One hash per band."""
    values = extremes(shingles, how.bands * how.rows, how.seed).reshape(how.bands, how.rows)
    places = _odd_constants(how.rows, how.seed + 2)
    return mix((values * places).sum(1, dtype=np.uint64) + np.arange(how.bands, dtype=np.uint64))


def _sign(how: MinMax):
    def rows(batch: pa.RecordBatch):
        out: dict = {"doc_id": batch.column(0), "n_shingles": [], "set_high": [], "set_low": [], "bands": []}
        for text in utf8(batch.column(1)):
            shingles = shingle_set(text, how.shingle_words)
            out["n_shingles"].append(len(shingles))
            digest = xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None
            high, low = np.frombuffer(digest, np.int64) if digest else (None, None)
            out["set_high"].append(high)
            out["set_low"].append(low)
            out["bands"].append(signed(signature(shingles, how)) if len(shingles) else None)
        yield out

    return rows


def _overlap(how: MinMax):
    """Size of the intersection of two documents' sets, and whether that links them."""

    def rows(batch: pa.RecordBatch):
        out: dict = {"a": batch.column(0), "b": batch.column(1), "linked": []}
        seen, known = None, None
        for one, other in zip(utf8(batch.column(2)), utf8(batch.column(3)), strict=True):
            if known is None or one != seen:
                seen, known = one, shingle_set(one, how.shingle_words)
            shingles = shingle_set(other, how.shingle_words)
            shared = len(np.intersect1d(known, shingles, assume_unique=True))
            union = len(known) + len(shingles) - shared
            out["linked"].append(bool(union) and 100 * shared >= how.per_cent * union)
        yield out

    return rows


def compare(pairs: DataFrame, texts: DataFrame, how: MinMax) -> DataFrame:
    """``pairs(a, b)`` with the verdict ``linked`` on the full sets of both texts."""
    seconds = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    firsts = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    both = pairs.join(seconds, "b").join(firsts, "a").select("a", "b", "text_a", "text_b")
    return stored(map_batches(both, _overlap(how), "a bigint, b bigint, linked boolean"))


def near_duplicates(docs: DataFrame, how: MinMax = MinMax()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs(doc_id, text)``; other columns are not read.

    Documents are linked if their shingle sets overlap by ``per_cent`` of their union or more. ``component_id`` is the
    smallest id that can be reached by links, and that document is the one kept.

    - Equal sets form a class before anything else; one document stands for it from then on.
    - Documents that share a band are a bucket. All members are compared with the bucket's smallest id.
    - Only where that leaves a bucket in several components, members of different components whose longer signatures
      agree enough are compared as well, the most similar ones first. A group of near copies therefore costs a few
      comparisons per member, and links between components are found.
    - Every comparison is of the full sets.

    Texts without words (also NULL) have no shingles and are linked with nothing. Documents without an id are linked
    with nothing and kept, their ``component_id`` is NULL. Rows that repeat an id are one document; each row is
    returned.
    """
    docs = docs.select("doc_id", "text")
    signed_docs = stored(
        map_batches(
            docs,
            _sign(how),
            "doc_id bigint, n_shingles bigint, set_high bigint, set_low bigint, bands array<bigint>",
        )
    )
    with_set = signed_docs.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stored(with_set.groupBy("set_high", "set_low").agg(F.min("doc_id").alias("first_id")))
    firsts = with_set.join(classes, ["set_high", "set_low"]).where("doc_id = first_id")
    members = firsts.select("doc_id", "n_shingles", F.explode("bands").alias("band"))
    # One row per bucket with more than one document.
    hubs = members.groupBy("band").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last"))
    hubs = stored(hubs.where("hub < last").select("band", "hub"))
    buckets = stored(members.join(hubs, "band").distinct())
    sizes = buckets.where("doc_id = hub").select(F.col("doc_id").alias("hub"), F.col("n_shingles").alias("n_hub"))
    spokes = buckets.where("doc_id > hub").select("hub", "doc_id", "n_shingles").distinct()
    stars = stored(spokes.join(sizes.distinct(), "hub").where(_may_link("n_hub", how)).select("hub", "doc_id"))
    stars = stars.toDF("a", "b")

    ids = stored(buckets.select("doc_id").distinct())
    texts = stored(docs.join(ids.hint("shuffle_hash"), "doc_id").select("doc_id", "text"))
    links = compare(stars, texts, how)
    found = stored(components(links.where("linked")))

    # What the smallest id of a bucket leaves apart: the most similar members first, then all that could be linked.
    sketches = stored(map_batches(_apart(buckets, found, texts), _sketch(how), "doc_id bigint, sketch binary, bands binary"))
    for top in (2, None):
        rest = stored(_between_components(buckets, found, links, sketches, how, top))
        links = stored(links.union(compare(rest, texts, how)))
        found = stored(components(links.where("linked")))

    class_of = classes.join(found.withColumnRenamed("id", "first_id"), "first_id", "left").select(
        "set_high", "set_low", F.coalesce("component", "first_id").alias("component")
    )
    labelled = signed_docs.drop("bands").join(stored(class_of), ["set_high", "set_low"], "left")
    return labelled.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _may_link(other: str, how: MinMax):
    """Whether sets of these sizes can overlap enough."""
    return 100 * F.least("n_shingles", other) >= how.per_cent * F.greatest("n_shingles", other)


def _apart(buckets: DataFrame, found: DataFrame, texts: DataFrame) -> DataFrame:
    """Texts of the members of buckets with several components."""
    rows = buckets.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    rows = stored(rows.withColumn("component", F.coalesce("component", "doc_id")))
    several = rows.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    ids = rows.join(stored(several.where("low < high").select("band")), "band").select("doc_id").distinct()
    return texts.join(stored(ids), "doc_id").select("doc_id", "text").dropDuplicates(["doc_id"])


def _sketch(how: MinMax):
    def rows(batch: pa.RecordBatch):
        sets = [shingle_set(text, how.shingle_words) for text in utf8(batch.column(1))]
        bits = [np.packbits((mix(extremes(x, how.sketch, how.seed + 3)) & np.uint64(1)).astype(bool)) for x in sets]
        bands = [signature(x, how).astype(np.uint32).tobytes() for x in sets]
        yield {"doc_id": batch.column(0), "sketch": [b.tobytes() for b in bits], "bands": bands}

    return rows


def _likely_pairs(how: MinMax, top: int | None):
    """Pairs of a left and a right row of a block, in different components, whose sketches agree enough.

    Rows come block by block, the left ones first. A pair that shares several bands is given by the first of them alone
    (all buckets with both are split between their components, so that one is here too), and two left rows by the
    smaller id. Bands are told apart by 32 of their bits: two that a pair does not share look shared once in four
    billion. ``top``: for each left row only that many, the most alike ones.
    """

    def pairs(block: pa.Table) -> pa.RecordBatch:
        ids, sizes, parts = (block[c].to_numpy() for c in ("doc_id", "n_shingles", "component"))
        sketches = np.frombuffer(b"".join(block["sketch"].to_pylist()), np.uint8).reshape(len(ids), -1)
        bands = np.frombuffer(b"".join(block["bands"].to_pylist()), np.uint32).reshape(len(ids), how.bands)
        this_band, minor = block["band"][0].as_py() & 0xFFFFFFFF, block["minor"].to_numpy()
        right = block["side"].to_numpy() == 1
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i in np.flatnonzero(~right):
            able = right & (parts != parts[i]) & (~minor | (ids > ids[i]))
            able &= 100 * np.minimum(sizes, sizes[i]) >= how.per_cent * np.maximum(sizes, sizes[i])
            others = np.flatnonzero(able)
            equal = how.sketch - np.bitwise_count(sketches[others] ^ sketches[i]).sum(1, dtype=np.int64)
            others, equal = others[equal >= how.least_equal], equal[equal >= how.least_equal]
            first_shared = bands[i][(bands[others] == bands[i]).argmax(1)]
            others, equal = others[first_shared == this_band], equal[first_shared == this_band]
            if top is not None and len(others) > top:
                others = others[np.lexsort((ids[others], -equal))[:top]]
            a.append(np.minimum(ids[i], ids[others]))
            b.append(np.maximum(ids[i], ids[others]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    def run(batches):
        waiting = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if waiting is None else pa.concat_tables([waiting, rows]).combine_chunks()
            keys = np.stack([rows[c].to_numpy() for c in ("band", "i", "j")], 1)
            starts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist()] if len(keys) else [0]
            for start, end in zip(starts, starts[1:]):
                yield pairs(rows.slice(start, end - start))
            waiting = rows.slice(starts[-1])  # its block may go on
        if waiting is not None and waiting.num_rows:
            yield pairs(waiting)

    return run


def _between_components(
    buckets: DataFrame, found: DataFrame, known: DataFrame, sketches: DataFrame, how: MinMax, top: int | None
) -> DataFrame:
    """Pairs not yet compared that share a bucket but no component and have similar sketches.

    In a bucket with several components, the members of all but the largest (left) meet all members (right), in blocks
    of bounded size. Only the pairs that pass become rows.
    """
    rows = buckets.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    rows = stored(rows.withColumn("component", F.coalesce("component", "doc_id")).drop("hub"))
    parts = rows.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.groupBy("band").agg(
        F.max_by("component", "n").alias("largest"), F.max("n").alias("most"), F.sum("n").alias("members")
    )
    parts = stored(
        parts.where("most < members").select(
            "band",
            "largest",
            F.ceil((F.col("members") - F.col("most")) / how.block).alias("lefts"),
            F.ceil(F.col("members") / how.block).alias("rights"),
        )
    )
    rows = rows.join(parts, "band").withColumn("minor", F.col("component") != F.col("largest"))
    rows = rows.join(sketches, "doc_id")

    def dealt(side: int, own: str, other: str, blocks: str, others: str) -> DataFrame:
        return rows.withColumns(
            {
                own: F.pmod(F.xxhash64("doc_id"), F.col(blocks)),
                other: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(others) - 1)),
                "side": F.lit(side),
            }
        ).select("band", "i", "j", "side", "doc_id", "n_shingles", "component", "minor", "sketch", "bands")

    left = dealt(0, "i", "j", "lefts", "rights").where("minor")
    met = left.union(dealt(1, "j", "i", "rights", "lefts"))
    met = met.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "side")
    likely = met.mapInArrow(_likely_pairs(how, top), "a bigint, b bigint").distinct()
    return likely.join(known.select("a", "b"), ["a", "b"], "left_anti")


def one_of_each_group(docs: DataFrame, how: MinMax = MinMax(per_cent=80, bands=37)) -> DataFrame:
    """``docs`` without the documents that are near copies of a kept one; all columns, every id once.

    Near copies are those that overlap by 0.8 or more; 37 bands miss a pair at 0.8 as rarely as 25 do one at 0.85. Rows without an id stay. Of rows that repeat an id one stays.
    """
    verdicts = stored(near_duplicates(docs, how))
    dropped = verdicts.where("NOT kept").select("doc_id").distinct()
    repeated = verdicts.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    repeated = stored(repeated.select("doc_id"))
    rest = docs.join(stored(dropped).union(repeated).hint("shuffle_hash"), "doc_id", "left_anti")
    if repeated.isEmpty():
        return rest
    return rest.union(docs.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
