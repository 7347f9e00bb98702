"""Betweenness of every vertex, from all sources, as joins.

The state of one source is a row per vertex: cost and number of the cheapest
paths. Sources are walked together in batches. A round joins only the vertices
that it settles with their edges, so the work of all rounds together is sources
times edges. A graph of moderate size (checked by count) is sent to the tasks as arrays,
and each walks from its sources alone; a larger one is joined by shuffle. Costs are whole thousandths, hence equal costs are exactly
equal, and vertices go by a checked 64-bit hash of their id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieweave.graph.packed import may_be_packed, pack, shared_dependencies
from tieweave.graph.social import SocialGraph
from tieweave.session import RoundTables, path_exists, remove_path, scratch_path, sent_whole


class _Walk:
    """Edges with whole-number costs between hashed vertices."""

    def __init__(self, graph: SocialGraph, weighted: bool, tables: RoundTables) -> None:
        self.tables = tables
        cost = F.round(F.col("weight") * 1000) if weighted else F.lit(1)
        seed = F.lit(graph.hash_seed())
        connected = graph.vertices.filter("degree > 0")
        self.names, named = tables.write(connected.select("id", F.xxhash64("id", seed).alias("node")))
        inexact = F.abs(F.col("weight") * 1000 - cost) > 1e-6 if weighted else F.lit(False)
        steps = graph.edges.select(
            F.xxhash64("src", seed).alias("node"), F.xxhash64("dst", seed).alias("to"),
            cost.cast("long").alias("step"), inexact.alias("inexact"),
        )
        self.kept, taken = tables.write(steps, least=F.min("step"), inexact=F.count_if("inexact"))
        self.edges = self.kept.drop("inexact")
        self.rows, self.least, self.inexact = taken["rows"], taken["least"], taken["inexact"]
        self.count = named["rows"]

    def along(self, frontier: DataFrame) -> DataFrame:
        """The rows of some vertices at all of their edges."""
        return frontier.join(sent_whole(self.edges, self.rows), "node")

    def forward(self, sources: DataFrame) -> tuple[DataFrame, list[int]]:
        """Final costs and path counts, and the cost bounds of the rounds.

        A round settles every vertex that costs less than the cheapest open one
        plus the cheapest edge: nothing still open can improve or equal it. Only
        those vertices travel along their edges; what arrives is added to the state,
        in which the least cost of each vertex stays.
        """
        state, _ = self.tables.write(
            sources.select(
                F.col("node").alias("source"), "node", F.lit(0).cast("long").alias("cost"),
                F.lit(1.0).alias("paths"),
            )
        )
        low, bounds = 0, [0]
        while low is not None:
            high = low + self.least
            settled = state.filter((F.col("cost") >= bounds[-1]) & (F.col("cost") < high))
            arrived = self.along(settled).select(
                "source", F.col("to").alias("node"), (F.col("cost") + F.col("step")).alias("cost"), "paths"
            )
            merged = (
                arrived.unionByName(state)
                .groupBy("source", "node", "cost")
                .agg(F.sum("paths").alias("paths"))
                .groupBy("source", "node")
                .agg(F.min(F.struct("cost", "paths")).alias("best"))
                .select("source", "node", "best.cost", "best.paths")
            )
            previous = state
            state, taken = self.tables.write(merged, next=F.min(F.when(F.col("cost") >= high, F.col("cost"))))
            self.tables.drop(previous)
            bounds.append(high)
            low = taken["next"]
        return state, bounds

    def backward(self, state: DataFrame, bounds: list[int]) -> DataFrame:
        """Dependency of each source on each vertex, from the far rounds inwards.

        A settled vertex offers its share to every neighbour at the cost a
        cheapest path would have there; only a neighbour that really has that
        cost takes it. Offers lie by the round that reads them, and each is read once.
        """
        spark = state.sparkSession
        offers = scratch_path(spark, "offers")
        edges = F.array(*[F.lit(bound) for bound in bounds]).cast("array<long>")
        round_of = F.size(F.filter(edges, lambda bound: bound <= F.col("cost"))) - 1
        schema = "source long, node long, cost long, share double"
        taken_in = None
        for number in reversed(range(len(bounds) - 1)):
            low, high = bounds[number : number + 2]
            own = state.filter((F.col("cost") >= low) & (F.col("cost") < high))
            mine = f"{offers}/round={number}"
            if path_exists(spark, mine):
                share = spark.read.schema(schema).parquet(mine).groupBy("source", "node", "cost").agg(
                    F.sum("share").alias("share")
                )
                own = own.join(share, ["source", "node", "cost"], "left")
            else:
                own = own.withColumn("share", F.lit(None).cast("double"))
            gained = own.withColumn("dependency", F.col("paths") * F.coalesce("share", F.lit(0.0)))
            gained, _ = self.tables.write(gained.drop("share"))
            taken_in = gained if taken_in is None else taken_in.unionByName(gained)
            if number:
                (
                    self.along(gained)
                    .filter(F.col("cost") >= F.col("step"))
                    .select(
                        "source", F.col("to").alias("node"),
                        (F.col("cost") - F.col("step")).alias("cost"),
                        ((1.0 + F.col("dependency")) / F.col("paths")).alias("share"),
                    )
                    .groupBy("source", "node", "cost")
                    .agg(F.sum("share").alias("share"))
                    .withColumn("round", round_of)
                    .write.mode("append").partitionBy("round").parquet(offers)
                )
            remove_path(spark, mine)
        remove_path(spark, offers)
        return taken_in


def betweenness(
    graph: SocialGraph, weighted: bool = True, batch_rows: int = 20_000_000
) -> DataFrame:
    """``id`` and ``score``: how many cheapest paths between others pass by.

    With ``weighted`` the tie strength is the cost of an edge, so a strong tie is
    a long way; otherwise every edge costs the same. All vertices are sources.
    Weights must be whole thousandths, as those of derived ties are.
    ``batch_rows`` bounds the rows (sources times vertices) walked at a time.
    """
    tables = RoundTables(graph.vertices.sparkSession, "betweenness")
    if not graph.edge_count:
        return graph.vertices.select("id", F.lit(0.0).alias("score"))
    if may_be_packed(graph):
        scored = _by_arrays(graph, weighted, tables)
    else:
        scored = _by_joins(graph, weighted, batch_rows, tables)
    return (
        graph.vertices.select("id")
        .join(scored, "id", "left")
        .select("id", (F.coalesce("dependency", F.lit(0.0)) / 2).alias("score"))
    )


def _checked(least: int, inexact: int) -> None:
    if least <= 0 or inexact:
        raise ValueError("edge costs must be positive whole thousandths")


def _by_arrays(graph: SocialGraph, weighted: bool, tables: RoundTables) -> DataFrame:
    """``id`` and ``dependency``, with the whole graph in every task."""
    graph.hash_seed()  # ids must be unique
    cost = F.round(F.col("weight") * 1000) if weighted else F.lit(1)
    inexact = F.abs(F.col("weight") * 1000 - cost) > 1e-6 if weighted else F.lit(False)
    least, wrong = graph.edges.agg(F.min(cost.cast("long")), F.count_if(inexact)).first()
    _checked(least, wrong)
    packed, numbers = pack(graph, cost)
    sources = graph.vertices.filter("degree > 0").select("id").join(numbers, "id")
    total, _ = tables.write(shared_dependencies(packed, sources, packed.count, least))
    return numbers.join(total, "n").select("id", "dependency")


def _by_joins(graph: SocialGraph, weighted: bool, batch_rows: int, tables: RoundTables) -> DataFrame:
    """``id`` and ``dependency``, in batches of sources."""
    walk = _Walk(graph, weighted, tables)
    _checked(walk.least, walk.inexact)
    total, batches = None, max(1, -(-walk.count * walk.count // batch_rows))
    for batch in range(batches):
        sources = walk.names.filter(F.pmod("node", F.lit(batches)) == batch)
        state, bounds = walk.forward(sources)
        passed = (
            walk.backward(state, bounds)
            .filter("source <> node")
            .groupBy("node")
            .agg(F.sum("dependency").alias("dependency"))
        )
        if total is not None:
            passed = total.unionByName(passed).groupBy("node").agg(
                F.sum("dependency").alias("dependency")
            )
        total, _ = tables.write(passed)
        tables.finish(total, walk.kept, walk.names)
    return walk.names.join(total, "node", "left").select("id", "dependency")
