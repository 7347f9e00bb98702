"""The whole graph as arrays in every task, for walks from all of its vertices.

Walks from all sources meet every edge once per source, so their rows cannot be shuffled.
A graph of moderate size (by its counted edges) is sent to all executors as arrays
instead; tasks share the sources, and what leaves a task is sums. Edges are read in slices,
so what a task holds beside the graph is bounded.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tieweave import session
from tieweave.graph.social import SocialGraph
from tieweave.session import numbered, sent_whole

# Tasks get this code with their work, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Ends of edges for each row of a table that may be sent: two or three numbers an end.
ENDS_PER_ROW = 10
# Edges that a walk looks at in one go.
SLICE = 1 << 18
# Tasks for each core, as sources differ in their work.
TASKS_PER_CORE = 4


def may_be_packed(graph: SocialGraph) -> bool:
    return 0 < graph.edge_count <= ENDS_PER_ROW * session.BROADCAST_ROWS


@dataclass
class Packed:
    """Edges in the order of their start: those of vertex ``v`` lie from ``first[v]`` to
    ``first[v + 1]``, and no vertex is without. ``steps`` are whole costs, if asked for."""

    first: np.ndarray
    to: np.ndarray
    steps: np.ndarray | None

    @property
    def count(self) -> int:
        return len(self.first) - 1

    def slices(self, vertices: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The places of all edges of some vertices, and of their start in ``vertices``."""
        sizes = self.first[vertices + 1] - self.first[vertices]
        ends = np.cumsum(sizes)
        begin = 0
        while begin < len(vertices):
            before = ends[begin] - sizes[begin]
            end = max(begin + 1, int(np.searchsorted(ends, before + SLICE, "right")))
            mine = sizes[begin:end]
            shift = self.first[vertices[begin:end]] - (ends[begin:end] - mine - before)
            places = np.arange(ends[end - 1] - before, dtype=np.int32) + np.repeat(shift.astype(np.int32), mine)
            yield places, np.repeat(np.arange(begin, end, dtype=np.int32), mine)
            begin = end

    def dependencies(self, source: int, least: int, total: np.ndarray) -> None:
        """Adds what each vertex carries of the cheapest paths from ``source``.

        A round settles every vertex that costs less than the cheapest open one plus the
        cheapest edge: nothing still open can improve or equal it.
        """
        unknown = np.iinfo(np.int64).max
        cost, paths, is_open = np.full(self.count, unknown), np.zeros(self.count), np.ones(self.count, bool)
        cost[source], paths[source] = 0, 1.0
        rounds, reached = [], np.array([source], np.int32)
        while len(reached):
            settled, offers = reached[cost[reached] < cost[reached].min() + least], []
            is_open[settled] = False
            for edges, start in self.slices(settled):
                to = self.to[edges]
                kept = np.flatnonzero(is_open[to])
                start, to = settled[start[kept]], to[kept]
                there, known = cost[start] + self.steps[edges[kept]], cost[to]
                np.minimum.at(cost, to, there)
                paths[to[known > cost[to]]] = 0.0
                same = np.flatnonzero(there == cost[to])
                start, to = start[same], to[same]
                np.add.at(paths, to, paths[start])
                offers.append((start, to, there[same]))
            rounds.append(offers)
            reached = np.flatnonzero(is_open & (cost < unknown)).astype(np.int32)
        gained = np.zeros(self.count)
        for offers in reversed(rounds):
            # Those that a later one undercut are no cheapest paths.
            for start, to, there in offers:
                kept = there == cost[to]
                start, to = start[kept], to[kept]
                np.add.at(gained, start, paths[start] / paths[to] * (1.0 + gained[to]))
        gained[source] = 0.0
        total += gained

    def reached(self, seeds: np.ndarray, hops: int) -> list[np.ndarray]:
        """How many vertices each of at most 64 seeds first reaches at each hop."""
        bits = np.uint64(1) << np.arange(len(seeds), dtype=np.uint64)
        level, counts = np.zeros(self.count, np.uint64), []
        np.bitwise_or.at(level, seeds, bits)
        known = level.copy()
        cuts = np.unique(np.searchsorted(self.first, np.arange(0, self.first[-1] + SLICE, SLICE)))
        cuts = [*cuts[cuts < self.count].tolist(), self.count]
        for _ in range(hops):
            met = [
                np.bitwise_or.reduceat(level[self.to[self.first[a]:self.first[b]]], self.first[a:b] - self.first[a])
                for a, b in zip(cuts, cuts[1:])
            ]
            level = np.concatenate(met) & ~known
            known |= level
            counts.append(np.array([np.count_nonzero(level & bit) for bit in bits]))
        return counts


def pack(graph: SocialGraph, step: Column | None = None) -> tuple[Packed, DataFrame]:
    """The edges as arrays, and the numbers ``n`` of the ``id`` they go by. Only for graphs that ``may_be_packed``."""
    numbers, rows = numbered(graph.edges.select(F.col("src").alias("id")), "id")
    edges = graph.edges.select("src", "dst", *([] if step is None else [step.cast("long").alias("step")]))
    for end in ("src", "dst"):
        named = sent_whole(numbers, rows).select(F.col("id").alias(end), F.col("n").alias(f"{end}_n"))
        edges = edges.join(named, end).drop(end)
    read = edges.toArrow()
    start = read["src_n"].to_numpy()
    order = np.argsort(start, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(start, minlength=rows))])
    steps = None if step is None else read["step"].to_numpy()[order]
    return Packed(first, read["dst_n"].to_numpy()[order], steps), numbers


def _shared(
    spark: SparkSession, packed: Packed, sources: DataFrame, rows: int, schema: str,
    work: Callable[[Packed, np.ndarray], pa.RecordBatch],
) -> DataFrame:
    """``work`` on the numbers ``n`` of all sources, dealt to tasks."""
    sent = spark.sparkContext.broadcast((packed.first, packed.to, packed.steps))

    def run(batches):
        mine = [batch.column(0).to_numpy() for batch in batches if batch.num_rows]
        if mine:
            yield from work(Packed(*sent.value), np.concatenate(mine)).to_batches(max_chunksize=10_000)

    parts = max(1, min(rows, TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
    return sources.select("n").repartition(parts, "n").mapInArrow(run, schema)


def shared_dependencies(packed: Packed, sources: DataFrame, rows: int, least: int) -> DataFrame:
    """``n`` and ``dependency``: what the walks from all sources leave at each vertex."""

    def work(graph: Packed, mine: np.ndarray) -> pa.Table:
        total = np.zeros(graph.count)
        for source in mine:
            graph.dependencies(source, least, total)
        there = np.flatnonzero(total)
        return pa.table({"n": there, "dependency": total[there]})

    made = _shared(sources.sparkSession, packed, sources, rows, "n long, dependency double", work)
    return made.groupBy("n").agg(F.sum("dependency").alias("dependency"))


def shared_reach(packed: Packed, sources: DataFrame, rows: int, hops: int) -> DataFrame:
    """``n`` and ``hop1`` to ``hop<hops>`` of every source."""
    names = [f"hop{hop}" for hop in range(1, hops + 1)]

    def work(graph: Packed, mine: np.ndarray) -> pa.Table:
        mine = np.unique(mine)
        counts = [graph.reached(mine[at:at + 64], hops) for at in range(0, len(mine), 64)]
        found = {name: np.concatenate([count[hop] for count in counts]) for hop, name in enumerate(names)}
        return pa.table({"n": mine.astype(np.int64)} | found)

    return _shared(sources.sparkSession, packed, sources, rows, ", ".join(f"{n} long" for n in ("n", *names)), work)
