"""Weighted PageRank with a fixed number of rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieweave.graph.social import SocialGraph
from tieweave.session import RoundTables, sent_whole

# Damping and rounds of the ranking, and the score of a loner.
DAMPING, ROUNDS = 0.85, 20
BASE_SCORE = 0.15


def pagerank(
    graph: SocialGraph, rounds: int = ROUNDS, damping: float = DAMPING, cut_every: int = 4
) -> DataFrame:
    """``id`` and ``score`` of every vertex; scores are not scaled to sum to 1.

    A round sends each score along the edges in proportion to their weight and
    adds it up at the far end, with the sums combined before the shuffle.
    """
    base = 1.0 - damping
    tables = RoundTables(graph.vertices.sparkSession, "pagerank")
    strength = graph.vertices.filter("degree > 0").select("id", "strength")
    rows = graph.vertex_count
    ranks = strength.withColumn("score", F.lit(base))
    kept = None
    for number in range(1, rounds + 1):
        per_weight = ranks.select("id", (F.col("score") / F.col("strength")).alias("per_weight"))
        received = (
            graph.along_edges(
                per_weight, "to", F.expr("per_weight * weight").alias("part_score"), rows=rows
            )
            .groupBy(F.col("to").alias("id"))
            .agg(F.sum("part_score").alias("total"))
        )
        ranks = received.join(sent_whole(strength, rows), "id").select(
            "id", "strength", (F.lit(base) + F.lit(damping) * F.col("total")).alias("score")
        )
        if number % cut_every == 0 and number < rounds:
            ranks, _ = tables.write(ranks)
            tables.drop(kept)
            kept = ranks
    loners = graph.vertices.filter("degree = 0").select("id", F.lit(base).alias("score"))
    scores, _ = tables.write(ranks.select("id", "score").unionByName(loners))
    tables.drop(kept)
    return scores
