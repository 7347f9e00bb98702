"""Communities by modularity (Louvain), as rounds of joins.

Vertices move in parallel. Two neighbours that swap places at once would undo each
other, so a round moves half of the vertices, told apart by one bit of their label, and
a loner joins another loner only under the smaller label. Only vertices that may have
something to gain are looked at: those that wished to move and could not, those that
moved, and the neighbours of those. All gains are whole numbers, so the outcome is the
same on every run, however the rows lie.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieweave import session
from tieweave.graph.social import SocialGraph
from tieweave.session import RoundTables, partitions_for, sent_whole

# Whole numbers whose products still fit a decimal.
WHOLE = "decimal(19,0)"
# With at most so many ends of edges, no difference of two products is too large for a long.
LONG_LINKS = 2_000_000_000
# Bits of a label, and the hexadecimal digits they come from.
BITS, DIGITS = 60, 15
# A level is folded once two rounds in a row moved at most one vertex in so many.
FOLD = 50
# Rounds of halves in a level, after which moves are matched.
PATIENCE = 200


@dataclass
class _Level:
    """The graph of one level: its edges, its weighted vertices and their number; and,
    as it goes, the sums per community and whether all vertices are looked at."""

    edges: DataFrame
    nodes: DataFrame
    rows: int
    totals: DataFrame | None = None
    communities: int = 0
    whole: bool = True

    @property
    def small(self) -> bool:
        """A state of so few rows is sent to the edges."""
        return self.rows <= session.BROADCAST_ROWS


def _label(name: str, salt: str) -> Column:
    digits = F.substring(F.md5(F.concat(F.col(name), F.lit(salt)).cast("binary")), 1, DIGITS)
    return F.conv(digits, 16, 10).cast("long")


def _salt(vertices: DataFrame, count: int) -> str:
    """What makes the labels of all vertices different: mostly nothing."""
    for salt in ("", *map(str, range(16))):
        if vertices.agg(F.count_distinct(_label("id", salt))).first()[0] == count:
            return salt
    raise ValueError("vertex ids are not unique")


def _totals(placed: DataFrame) -> DataFrame:
    """Weight and number of the vertices of every community."""
    return placed.groupBy("community").agg(F.sum("k").alias("total"), F.count(F.lit(1)).alias("size"))


def _looking(level: _Level, state: DataFrame) -> DataFrame:
    """The vertices of a large state that are looked at next, with their place."""
    if level.whole:
        return state
    moved = state.filter("moved").select(F.col("id").alias("src"))
    near = moved.join(level.edges, "src").select(F.col("dst").alias("id"))
    found = near.distinct().withColumn("near", F.lit(True))
    return state.join(found, "id", "left").filter("wish OR near").drop("near")


def _options(level: _Level, state: DataFrame) -> DataFrame:
    """Every community near a vertex (``target``), with the links into it, the sums of
    both communities and whether the vertex is looked at (``looks``; true of all rows of a
    vertex or of some).

    Edges stay where they are. A small state is sent to them with its sums, and one pass
    over them gives links and lookers alike; otherwise communities travel from the near
    ends, by which edges lie, and are added up at the far ends.
    """
    links = F.sum("weight").alias("links")
    if level.small:
        placed = state.join(F.broadcast(_totals(state)), "community")
        far = placed.selectExpr(
            "id AS dst", "community AS target", "total AS target_total", "size AS target_size", "moved AS near"
        )
        own = placed.select("id", "k", "community", "total", "size", "wish")
        met = level.edges.join(F.broadcast(far), "dst").groupBy(
            F.col("src").alias("id"), "target", "target_total", "target_size"
        ).agg(links, F.max("near").alias("near"))
        looks = F.lit(True) if level.whole else F.col("wish") | F.col("near")
        return met.join(F.broadcast(own), "id").withColumn("looks", looks).drop("wish", "near")
    sums = sent_whole(level.totals, level.communities)
    near = _looking(level, state).select("id", "k", "community").join(sums, "community")
    sent = state.selectExpr("id AS src", "community AS target").join(level.edges, "src")
    met = sent.groupBy(F.col("dst").alias("id"), "target").agg(links).join(near, "id")
    return met.join(sums.toDF("target", "target_total", "target_size"), "target").withColumn("looks", F.lit(True))


def _wishes(level: _Level, state: DataFrame, two_m: int) -> DataFrame:
    """The looking vertices that gain by moving alone, with their best community.

    A gain is ``links * two_m - k * total``, in whole numbers; a vertex without a link
    into its own community has a gain there too. Of equals the least label counts.
    """
    number = "long" if two_m <= LONG_LINKS else WHOLE
    whole = lambda name: f"CAST({name} AS {number})"
    gain = f"{whole('links')} * {whole(two_m)} - {whole('k')} * {whole('target_total - IF(own, k, 0)')}"
    options = _options(level, state).selectExpr("*", "target = community AS own").selectExpr(
        "id", "community", "target", "k", f"{gain} AS gain", "own",
        f"-{whole('k')} * {whole('total - k')} AS alone",
        "own OR target_size > 1 OR size > 1 OR target < community AS allowed", "looks",
    )
    return (
        options.groupBy("id", "community", "k")
        .agg(
            F.expr("min(IF(allowed, struct(-gain AS loss, target), null)) AS best"),
            F.expr("coalesce(max(IF(own, gain, null)), first(alone)) AS stay"),
            F.max("looks").alias("looks"),
        )
        .filter("looks AND -best.loss > stay")
        .selectExpr("id", "community", "k", "best.target AS target", "-best.loss - stay AS more")
    )


def _in_half(turn: int) -> Column:
    """The vertices whose turn it is: two rounds take one bit, first ones, then zeros."""
    return F.shiftright("id", (turn // 2) % BITS).bitwiseAND(F.lit(1)) == turn % 2


def _matched(wishes: DataFrame) -> DataFrame:
    """``goes``: whether a move gains most among all that touch either of its two
    communities. Such moves share no community, so their gains add up exactly."""
    rank = F.struct("more", "id").alias("rank")
    ends = wishes.select("community", rank).unionByName(wishes.select(F.col("target").alias("community"), rank))
    top = ends.groupBy("community").agg(F.max("rank").alias("top"))
    first = top.toDF("community", "first")
    second = top.toDF("target", "second")
    goes = (F.col("first.id") == F.col("id")) & (F.col("second.id") == F.col("id"))
    return wishes.join(first, "community").join(second, "target").withColumn("goes", goes).drop("first", "second")


def _changed(totals: DataFrame, moved: DataFrame) -> DataFrame:
    """The sums of the communities after some moves: only those are added."""
    one = F.lit(1).cast("long")
    left = moved.select(F.col("was").alias("community"), (-F.col("k")).alias("total"), (-one).alias("size"))
    come = moved.select("community", F.col("k").alias("total"), one.alias("size"))
    return (
        totals.unionByName(left).unionByName(come).groupBy("community")
        .agg(F.sum("total").alias("total"), F.sum("size").alias("size")).filter("size > 0")
    )


def _move_vertices(level: _Level, two_m: int, tables: RoundTables, patience: int) -> DataFrame | None:
    """Moves until a look at all vertices finds none that gains, or until hardly any
    move; None when none moved at all.

    Moves of one half may together lose. After ``patience`` rounds they are matched
    instead, so each round gains a whole number or ends the level. A round is one written
    table: the place of every vertex, whether it moved, and whether it wished to.
    """
    state = level.nodes.select(
        "id", "k", F.col("id").alias("community"), F.col("id").alias("was"), F.lit(True).alias("wish"),
        F.lit(False).alias("moved"),
    )
    if not level.small:
        level.totals, counted = tables.write(_totals(state))
        level.communities = counted["rows"]
    kept, turn, calm, moved = None, 0, False, False
    while True:
        turn += 1
        wishes, cut = _wishes(level, state, two_m), None
        if turn <= patience:
            wishes = wishes.withColumn("goes", _in_half(turn))
        else:
            cut, _ = tables.write(wishes)
            wishes = _matched(cut)
        wishes = wishes.select("id", "target", "goes")
        here = F.when(F.col("goes"), F.col("target")).otherwise(F.col("community"))
        after, taken = tables.write(
            state.select("id", "k", "community").join(F.broadcast(wishes) if level.small else wishes, "id", "left")
            .select(
                "id", "k", here.alias("community"), F.col("community").alias("was"),
                F.col("goes").isNotNull().alias("wish"), F.coalesce("goes", F.lit(False)).alias("moved"),
            ),
            wishes=F.count_if("wish"), moves=F.count_if("moved"),
        )
        tables.drop(kept)
        tables.drop(cut)
        kept = after
        # A state of few rows is read as one partition, which needs no shuffle.
        state = after.coalesce(partitions_for(tables.spark, level.rows)) if level.small else after
        moved, few = moved or taken["moves"] > 0, taken["moves"] * FOLD <= level.rows
        if (level.whole and not taken["wishes"]) or (calm and few and moved):
            tables.drop(level.totals)
            return state.select("id", "k", "community") if moved else None
        if taken["moves"] and not level.small:
            before = level.totals
            level.totals, counted = tables.write(_changed(before, state.filter("moved")))
            level.communities = counted["rows"]
            tables.drop(before)
        level.whole, calm = not taken["wishes"], few


def _placed(edges: DataFrame, rows: int, graph: SocialGraph) -> DataFrame:
    """Edges kept by their start; with hubs around, spread evenly instead."""
    parts = partitions_for(edges.sparkSession, rows)
    if graph.hubs is None:
        return edges.repartition(parts, "src").sortWithinPartitions("src").persist()
    return edges.repartition(parts, "src", "dst").persist()


def louvain(graph: SocialGraph, patience: int = PATIENCE) -> DataFrame:
    """``id`` and ``community`` of every vertex, unweighted.

    A level moves vertices, then folds each community into one vertex; levels go on
    until a look at all vertices finds none that gains by moving. There is no cap on
    rounds or levels. A community is named by its smallest member.
    """
    tables = RoundTables(graph.vertices.sparkSession, "louvain")
    connected = graph.vertices.filter("degree > 0")
    salt = _salt(graph.vertices, graph.vertex_count)
    nodes, joined = tables.write(connected.select(_label("id", salt).alias("id"), F.col("degree").cast("long").alias("k")))
    members = connected.select("id", _label("id", salt).alias("community"))
    two_m = int(nodes.agg(F.sum("k")).first()[0] or 0)
    edges = _placed(
        graph.edges.select(
            _label("src", salt).alias("src"), _label("dst", salt).alias("dst"), F.lit(1).cast("long").alias("weight")
        ),
        graph.edge_count, graph,
    )
    level = _Level(edges, nodes, joined["rows"])
    while two_m:
        state = _move_vertices(level, two_m, tables, patience)
        if state is None:
            break
        state = sent_whole(state, level.rows)
        target = lambda end, name: state.select(
            F.col("id").alias(end), F.col("community").alias(name)
        )
        folded, between = tables.write(
            level.edges.join(target("src", "from"), "src")
            .groupBy(F.col("from"), "dst").agg(F.sum("weight").alias("weight"))
            .join(target("dst", "to"), "dst")
            .filter(F.col("from") != F.col("to"))
            .groupBy(F.col("from").alias("src"), F.col("to").alias("dst"))
            .agg(F.sum("weight").alias("weight"))
        )
        sums, spread = tables.write(
            state.groupBy(F.col("community").alias("id")).agg(F.sum("k").alias("k"))
        )
        members, _ = tables.write(
            members.join(target("community", "next"), "community").select(
                "id", F.col("next").alias("community")
            )
        )
        level.edges.unpersist()
        tables.finish(folded, sums, members)
        level = _Level(_placed(folded, between["rows"], graph), sums, spread["rows"])
        if not between["rows"]:
            break
    level.edges.unpersist()
    names = members.groupBy("community").agg(F.min("id").alias("name"))
    named = members.join(names, "community").select("id", F.col("name").alias("community"))
    loners = graph.vertices.filter("degree = 0").select("id", F.col("id").alias("community"))
    assigned, _ = tables.write(named.unionByName(loners))
    tables.finish(assigned)
    return assigned


def modularity(graph: SocialGraph, communities: DataFrame) -> float:
    """Unweighted modularity of an assignment of all vertices."""
    end = lambda key, name: communities.select(
        F.col("id").alias(key), F.col("community").alias(name)
    )
    inside, two_m = (
        graph.edges.join(end("src", "a"), "src").join(end("dst", "b"), "dst")
        .agg(F.sum((F.col("a") == F.col("b")).cast("double")), F.count(F.lit(1))).first()
    )
    totals = graph.vertices.join(communities, "id").groupBy("community").agg(F.sum("degree").alias("k"))
    squares = totals.agg(F.sum(F.pow(F.col("k").cast("double"), 2))).first()[0]
    return inside / two_m - squares / two_m**2 if two_m else 0.0
