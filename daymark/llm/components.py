"""Connected components of a graph given as a frame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.session import fresh_folder, remove_folder, scratch, stored


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every id in ``edges(a, b)``; the component is its smallest id.

    Alternating large-star and small-star steps: every node is linked to the smallest neighbour instead of to each
    other, until the edges are stars around the smallest ids. Both steps are a minimum per key, which combines before
    the shuffle, and a join with one row per key, so that a node with very many edges is no single task's work. The
    number of rounds grows with the logarithm of a component's diameter. Each round is written to the shared folder, and
    what it was made of is removed then.
    """
    spark = edges.sparkSession
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    path = fresh_folder(spark, "stars")
    edges.write.parquet(path)
    stars = spark.read.schema(edges.schema).parquet(path)
    state = _state(stars)
    while state[0]:
        before, last = path, state
        path = fresh_folder(spark, "stars")
        with scratch(spark):
            _small_star(stored(_large_star(stars))).write.parquet(path)
        stars = spark.read.schema(stars.schema).parquet(path)
        remove_folder(spark, before)
        state = _state(stars)
        if state == last:
            break
    centres = stars.select(F.col("a").alias("id"), F.col("a").alias("component"))
    return centres.union(stars.select(F.col("b").alias("id"), F.col("a").alias("component"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to the smallest of its neighbours and itself."""
    ways = edges.union(edges.select("b", "a")).toDF("u", "v")
    smallest = ways.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return ways.where("v > u").join(stored(smallest), "u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, are linked to the smallest of them."""
    smallest = stored(edges.groupBy("b").agg(F.min("a").alias("m")))
    moved = edges.join(smallest, "b").select(F.col("m").alias("a"), F.col("a").alias("b")).where("a < b")
    return moved.union(smallest.select(F.col("m").alias("a"), "b")).distinct()
