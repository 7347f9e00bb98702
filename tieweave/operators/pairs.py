"""Pairs of members that share a group, safe for very large groups.

The ties of this model are the pairs of people at one event, so the pairs are
the result and none may be left out. What must not happen is that one task
builds all pairs of a big event. A group larger than ``block_rows`` is cut into
blocks of about that size, and every (block, block) cell becomes a join key of
its own, so no cell holds more than ``block_rows`` squared pairs and cells spread
over the cluster. Few pairs meet twice, so sums over a pair are not combined before
their shuffle, which is dealt by the counted pairs too.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tieweave.session import RoundTables, partitions_for, sent_whole

BLOCK_ROWS = 2000
# Pairs that one task should make; it keeps sums for that many.
TASK_PAIRS = 500_000


@dataclass
class Groups:
    """Members by group, and the groups that need blocks (keys and ``blocks``).

    ``large`` is None when every group is small enough to be met at once. ``parts`` is
    how many tasks shall make the pairs: few members make many pairs, so the bytes of
    the members, by which Spark would choose, say too little. None leaves members as
    they lie.
    """

    members: DataFrame
    keys: list[str]
    member: str
    large: DataFrame | None
    parts: int | None = None

    def placed(self) -> DataFrame:
        """Members with the ``blocks`` of their group and their own ``block``."""
        if self.large is None:
            return self.members.withColumns({"blocks": F.lit(1), "block": F.lit(0)})
        blocks = F.coalesce("blocks", F.lit(1))
        return (
            self.members.join(self.large, self.keys, "left")
            .withColumn("blocks", blocks)
            .withColumn("block", F.pmod(F.xxhash64(self.member), F.col("blocks")).cast("int"))
        )

    def joined(self, left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
        """Joins two sides by ``keys``, dealt to ``parts`` tasks."""
        if self.parts is not None:
            left, right = (side.repartition(self.parts, *keys) for side in (left, right))
        return left.join(right, keys)

    def dealt(self, pairs: DataFrame, *ends: str) -> DataFrame:
        """The pairs by their ``ends``, dealt to as many tasks as made them: sums over a
        pair are then kept for a bounded number of pairs in each."""
        return pairs if self.parts is None else pairs.repartition(self.parts, *ends)

    def meet(self, left: DataFrame, right: DataFrame) -> DataFrame:
        """Joins two sides of ``placed`` rows so that all members of a group meet."""
        if self.large is None:
            unplaced = [side.drop("blocks", "block") for side in (left, right)]
            return self.joined(*unplaced, self.keys)
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        rows = left.withColumn("column_block", other).withColumnRenamed("block", "row_block")
        columns = right.withColumn("row_block", other).withColumnRenamed("block", "column_block")
        cell = [*self.keys, "row_block", "column_block"]
        return self.joined(rows.drop("blocks"), columns.drop("blocks"), cell).drop("row_block", "column_block")


def _meet_each_other(groups: Groups, left: DataFrame, right: DataFrame, payload: tuple[str, ...]) -> DataFrame:
    """Each unordered pair once. Of a large group's cells only those with a row block
    up to the column block are built; there the pair is put in order afterwards."""
    if groups.large is None:
        return groups.meet(left, right).filter("user_1 < user_2")
    rows = left.withColumn("column_block", F.explode(F.sequence("block", F.col("blocks") - 1)))
    columns = right.withColumn("row_block", F.explode(F.sequence(F.lit(0), "block")))
    cell = [*groups.keys, "row_block", "column_block"]
    met = groups.joined(
        rows.withColumnRenamed("block", "row_block").drop("blocks"),
        columns.withColumnRenamed("block", "column_block").drop("blocks"), cell,
    )
    met = met.filter("row_block < column_block AND user_1 <> user_2 OR user_1 < user_2")
    turned = F.col("user_1") > F.col("user_2")
    swapped = [
        F.when(turned, F.col(f"{name}_{3 - end}")).otherwise(F.col(f"{name}_{end}")).alias(f"{name}_{end}")
        for name in ("user", *payload) for end in (1, 2)
    ]
    return met.select(*groups.keys, *swapped)


def gather_groups(
    members: DataFrame, keys: list[str], member: str, block_rows: int = BLOCK_ROWS,
    kinds: tuple[Column, ...] = (),
) -> Groups:
    """Writes the members once, so that counting and pairing do not derive them
    again, counts their pairs, and finds the large groups. Null keys meet nobody and
    are left out. ``kinds`` count the members of a group that meet each other in several
    ways, where not all do in one.

    There are at most rows / block_rows large groups; they are broadcast when
    their count allows it.
    """
    tables = RoundTables(members.sparkSession, "groups")
    written, _ = tables.write(members.dropna(subset=[*keys, member]))
    counted, ways = Observation(), [f"n_{way}" for way in range(len(kinds))]
    sizes = written.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[kind.alias(way) for kind, way in zip(kinds, ways)]
    )
    pairs = sum((F.col(n).cast("double") * (F.col(n) - 1) / 2 for n in ways or ["n"]), F.lit(0.0))
    sizes = sizes.observe(counted, F.sum(pairs).alias("pairs")).filter(F.col("n") > block_rows)
    large, taken = tables.write(
        sizes.select(*keys, F.ceil(F.col("n") / block_rows).cast("int").alias("blocks"))
    )
    parts = partitions_for(members.sparkSession, int(counted.get["pairs"] or 0), TASK_PAIRS)
    if not taken["rows"]:
        return Groups(written, keys, member, None, parts)
    return Groups(written, keys, member, sent_whole(large, taken["rows"]), parts)


def pairs_of(groups: Groups, payload: tuple[str, ...] = ()) -> DataFrame:
    """Each unordered pair of members of each group once.

    Gives the keys, ``user_1 < user_2`` and both payloads as ``<name>_1`` and
    ``<name>_2``.
    """
    placed = groups.placed()
    side = lambda end: placed.select(
        *groups.keys, "blocks", "block", F.col(groups.member).alias("user" + end),
        *[F.col(name).alias(name + end) for name in payload],
    )
    return _meet_each_other(groups, side("_1"), side("_2"), payload)


def pairs_in_group(
    members: DataFrame,
    keys: list[str],
    member: str,
    payload: tuple[str, ...] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    return pairs_of(gather_groups(members, keys, member, block_rows), payload)


def both_directions(pairs: DataFrame, *columns: str) -> DataFrame:
    """Every unordered pair as two directed rows ``src``, ``dst``."""
    ends = F.explode(
        F.array(
            F.struct(F.col("user_1").alias("src"), F.col("user_2").alias("dst")),
            F.struct(F.col("user_2").alias("src"), F.col("user_1").alias("dst")),
        )
    )
    return pairs.select(ends.alias("ends"), *columns).select("ends.src", "ends.dst", *columns)
