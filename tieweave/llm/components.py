"""Connected components of a large graph by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieweave.session import RoundTables


def _toward_least(arcs: DataFrame) -> DataFrame:
    """Each arc (u, v) with the least of u and all its v as ``m``.

    The least ones are aggregated per u first; the join back has one row per u on
    that side, so adaptive execution can split the arcs of a hub.
    """
    least = arcs.groupBy("u").agg(F.min("v").alias("m"))
    return arcs.join(least, "u").withColumn("m", F.least("u", "m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); the root is the least node.

    A round connects the larger neighbours of every node to its least neighbour,
    then the smaller ones likewise, until nothing changes. Rounds are written, so
    a lost executor costs one round. Nulls are no nodes; self edges give a node
    that is its own root only if it has another edge.
    """
    rounds = RoundTables(edges.sparkSession, "components")
    marks = {"mark": F.bit_xor(F.xxhash64("u", "v"))}
    oriented = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now, before = rounds.write(oriented.filter("u > v").distinct(), **marks)
    while True:
        both = now.union(now.select(F.col("v"), F.col("u")))
        large = _toward_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = _toward_least(large.distinct())
        small = down.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
        small = small.union(down.select("u", F.col("m").alias("v")).filter("u > v"))
        after, measures = rounds.write(small.distinct(), **marks)
        rounds.drop(now)
        now = after
        if measures == before:
            roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
        before = measures
