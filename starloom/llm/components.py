"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import dropped, written


#: Edges for each file of a round's result.
FILE_EDGES = 1 << 16


def _to_fold(edges: DataFrame) -> int:
    """Number of edges; 0 if every node hangs on one other at most, and on none that hangs itself."""
    roles = edges.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    nodes = roles.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    found = nodes.agg(F.max(F.expr("hangs > 1 OR (hangs = 1 AND holds = 1)")).alias("chained"), F.sum("hangs").alias("edges")).first()
    return found["edges"] if found["chained"] else 0


def components(edges: DataFrame) -> DataFrame:
    """(node, label): label is the smallest node reachable.  ``edges`` has (a, b) of one orderable type.

    Large-star / small-star: every node hangs its neighbours onto the smallest
    one, first the larger neighbours, then the smaller ones, until the edges are
    stars.  A round is two grouped minima and two joins with them, so a node with
    very many edges is folded before the shuffle and its join can be split.
    A round's result has as many files as its edges and the cluster's cores need:
    each file costs its own processes, so one for every shuffle partition would
    cost more than the round.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    while count := _to_fold(edges):
        files = max(edges.sparkSession.sparkContext.defaultParallelism, -(-count // FILE_EDGES))
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(joined.select("a", F.col("m").alias("b")))
        new = written(small.where("a <> b").distinct().coalesce(files))
        dropped(edges)
        edges = new
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
