"""Mixing sources to target weights by systematic sampling. DataFrame operations only."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import WORD
from daymark.llm.prefix import prefix_sums
from daymark.session import stored

_BITS = 24  # expected copies are counted in units of 2^-24, so that sums are exact and do not depend on their order
_UNIT = 1 << _BITS


class Mix(NamedTuple):
    """``weights`` go round the sources in code point order, NULL last; the mix has ``share`` times all words, but no
    source more than ``most`` times its own."""

    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    share: float = 1.5
    most: int = 2
    seed: int = 17


def _sized(docs: DataFrame) -> DataFrame:
    """Number of words and a source that is never NULL and sorts where it should."""
    return docs.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("0"), "source"), F.lit("1")).alias("_source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.xxhash64("text").alias("_text"),
    )


def source_targets(sized: DataFrame, how: Mix) -> DataFrame:
    """``_source, source_size, target`` in words.

    Every source gets its weight times one common level, or its limit if that is less. Raising the level reshares what
    the limited sources leave over, until no further source is above its limit.
    """
    sizes = sized.groupBy("_source").agg(F.sum("size").alias("source_size")).withColumn("_one", F.lit(1))
    ranked = prefix_sums(stored(sizes), [], ["_source"], "_one", "_rank")
    weights = F.array(*[F.lit(float(weight)) for weight in how.weights])
    weight = F.get(weights, (F.col("_rank") % len(how.weights)).cast("int"))
    sources = stored(ranked.select("_source", "source_size", weight.alias("_weight")))
    limit = F.col("source_size") * float(how.most)
    total = sources.agg(F.sum("source_size").alias("size"), F.sum("_weight").alias("weight")).first()
    wanted = how.share * (total["size"] or 0)
    level, limited = wanted / (total["weight"] or 1.0), 0
    while True:
        above = F.col("_weight") * level > limit
        now = sources.agg(
            F.count_if(above).alias("limited"),
            F.sum(F.when(above, limit)).alias("given"),
            F.sum(F.when(~above, F.col("_weight"))).alias("weight"),
        ).first()
        if now["limited"] == limited or not now["weight"]:
            break
        level, limited = (wanted - now["given"]) / now["weight"], now["limited"]
    return sources.select("_source", "source_size", F.least(limit, F.col("_weight") * level).alias("target"))


def copies(docs: DataFrame, how: Mix = Mix()) -> DataFrame:
    """``doc_id, size, source_size, target, copies`` (and ``_text``, a hash) per row of ``docs(doc_id, text, source)``.

    A document's expected number of copies is its source's target / size. These are summed up within the source, shortest
    document first, and a random offset is added; a document is taken once per whole number its interval crosses. As the
    order is by size, what a source gives differs from its target by no more than about its longest document, and no
    document is taken more than ``most`` times. The offset depends on the source and the seed only: reruns agree.

    NULL, empty and blank texts have size 0 and take part like others. NULL sources are one source. A source without
    words has target 0 and gives nothing. Equal rows are copies of a document, each with its own interval.
    """
    sized = stored(_sized(docs))
    targets = stored(source_targets(sized, how))
    expected = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * _UNIT)).otherwise(0)
    rows = sized.join(targets, "_source").withColumn("_expected", expected.cast("bigint"))
    summed = prefix_sums(rows, ["_source"], ["size", "doc_id", "_text"], "_expected", "_before")
    offset = F.conv(F.left(F.md5(F.concat("_source", F.lit(f"/{how.seed}"))), F.lit(_BITS // 4)), 16, 10)
    start = F.col("_before") + offset.cast("bigint")
    crossed = F.shiftright(start + F.col("_expected"), _BITS) - F.shiftright(start, _BITS)
    return summed.select("doc_id", "size", "source_size", "target", crossed.alias("copies"), "_text")


def mixed(docs: DataFrame, how: Mix = Mix()) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; all columns.

    Rows that share id and text count as copies of one document, whose columns are those of one of them.
    """
    taken = copies(docs, how).groupBy("doc_id", "_text").agg(
        F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows")
    )
    taken = stored(taken.where("_copies > 0").withColumnsRenamed({"doc_id": "_doc_id", "_text": "_hash"}))
    # Columns of the input go by their place on the way, so that none of them can clash with what is added.
    places = [f"c{i}" for i in range(len(docs.columns))]
    keys = [docs["doc_id"].alias("_id"), F.xxhash64(docs["text"]).alias("_text")]
    rows = docs.select(*[docs[c].alias(place) for c, place in zip(docs.columns, places)], *keys)
    same = rows["_id"].eqNullSafe(taken["_doc_id"]) & (rows["_text"] == taken["_hash"])
    joined = rows.join(taken.hint("shuffle_hash"), same)
    again = F.expr("explode(array_repeat(0, cast(_copies as int)))").alias("_again")
    out = joined.where("_rows = 1").select(*places, again).drop("_again").toDF(*docs.columns)
    if taken.where("_rows > 1").isEmpty():
        return out
    several = joined.where("_rows > 1").dropDuplicates(["_doc_id", "_hash"])
    return out.union(several.select(*places, again).drop("_again"))


def mix_report(docs: DataFrame, how: Mix = Mix()) -> DataFrame:
    """``doc_id, size, source_size, target, taken``: words the mix takes of each row, repeats counted."""
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return copies(docs, how).select("doc_id", "size", "source_size", "target", taken)
