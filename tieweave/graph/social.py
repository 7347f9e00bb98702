"""The undirected weighted graph that every graph job starts from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieweave.operators.pairs import BLOCK_ROWS, both_directions
from tieweave.session import BROADCAST_ROWS, cut_lineage, partitions_for

@dataclass
class SocialGraph:
    """Vertices with degree and strength, and edges in both directions.

    Edges are kept partitioned and sorted by their start, so a round of a graph
    job never shuffles them. A start with more than ``block_rows`` edges is a hub:
    its edges are spread over several parts, and rows that travel along them are
    copied once per part. ``hubs`` is None when the graph has none.
    """

    vertices: DataFrame
    edges: DataFrame
    hubs: DataFrame | None
    vertex_count: int
    edge_count: int

    def along_edges(
        self, state: DataFrame, *columns: str | Column, rows: int | None = None
    ) -> DataFrame:
        """``columns`` of each state row (keyed ``id``) at the far end ``to`` of its edges.

        A state known to have few ``rows`` is broadcast and met from the far end:
        edges run both ways, so the result stays partitioned by ``to`` and can be
        added up there without a shuffle. A larger state is shuffled to the edges.
        """
        if rows is not None and rows <= BROADCAST_ROWS:
            near = F.broadcast(state.withColumnRenamed("id", "dst"))
            met = self.edges.join(near, "dst").withColumnRenamed("dst", "id")
            return met.withColumnRenamed("src", "to").select(*columns)
        if self.hubs is None:
            met = state.join(self.edges, F.col("id") == F.col("src"))
        else:
            parts = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
            copied = state.join(self.hubs, "id", "left").withColumn("copy", parts)
            met = copied.join(
                self.edges, (F.col("id") == F.col("src")) & (F.col("copy") == F.col("part"))
            )
        return met.withColumnRenamed("dst", "to").select(*columns)

    def hash_seed(self) -> int:
        """A seed under which ``xxhash64(id, seed)`` differs for all vertices.

        Jobs with many rounds use that number in place of the id text.
        """
        for seed in range(16):
            key = F.xxhash64("id", F.lit(seed))
            if self.vertices.agg(F.countDistinct(key)).first()[0] == self.vertex_count:
                return seed
        raise ValueError("vertex ids are not unique")

    def hub_blocks(self) -> DataFrame | None:
        """Blocks per hub, keyed like the start of an edge."""
        return None if self.hubs is None else self.hubs.withColumnRenamed("id", "src")

    def release(self) -> None:
        for table in (self.edges, self.vertices, self.hubs):
            if table is not None:
                table.unpersist()


def project_graph(
    users: DataFrame,
    ties: DataFrame,
    weight: str = "tie_strength",
    block_rows: int = BLOCK_ROWS,
) -> SocialGraph:
    """Projects users and ties; the ties are written once, then kept in memory."""
    ties = cut_lineage(ties.select("user_1", "user_2", F.col(weight).alias("weight")), "ties")
    directed = both_directions(ties, "weight")
    reach = directed.groupBy(F.col("src").alias("id")).agg(
        F.count(F.lit(1)).alias("degree"), F.sum("weight").alias("strength")
    )
    vertices = (
        users.select("id")
        .join(reach, "id", "left")
        .select(
            "id",
            F.coalesce("degree", F.lit(0)).alias("degree"),
            F.coalesce("strength", F.lit(0.0)).alias("strength"),
        )
        .persist()
    )
    count, ends, most = vertices.agg(F.count("id"), F.sum("degree"), F.max("degree")).first()
    # A state too large to send is shuffled to the edges, which then must lie in as many
    # partitions as a shuffle makes, and must be there already, or they would be
    # shuffled too.
    large = count > BROADCAST_ROWS
    parts = partitions_for(users.sparkSession, ends or 0)
    if large:
        parts = int(users.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if (most or 0) <= block_rows:
        edges = directed.repartition(parts, "src").sortWithinPartitions("src").persist()
        if large:
            edges.count()
        return SocialGraph(vertices, edges, None, count, ends or 0)
    hubs = vertices.filter(F.col("degree") > block_rows).select(
        "id", F.ceil(F.col("degree") / block_rows).cast("int").alias("blocks")
    )
    part = F.pmod(F.xxhash64("dst"), F.coalesce("blocks", F.lit(1))).cast("int")
    edges = (
        directed.join(hubs.withColumnRenamed("id", "src"), "src", "left")
        .select("src", part.alias("part"), "dst", "weight")
        .repartition(parts, "src", "part")
        .sortWithinPartitions("src", "part")
        .persist()
    )
    if large:
        edges.count()
    return SocialGraph(vertices, edges, hubs.persist(), count, ends)
