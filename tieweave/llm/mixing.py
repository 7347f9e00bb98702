"""Mixing sources to target weights by entropy balancing.

The rates of the documents are those nearest to one, by relative entropy, under which
the words of each source add up to its target. Their form is known: a document of a
source has the rate ``min(cap, exp(tilt * size))``, and the tilts solve a convex dual
problem with one unknown per source. As rates depend on source and size alone, Newton's
method runs over counts of documents per source and size, however many documents a
source has. Rates become whole copies at the end, without leaving the targets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tieweave.llm.tables import table
from tieweave.session import RoundTables

#: What the contract calls a word.
WORD = r"[^\x20\x09-\x0D]+"
#: The weights that sources get in turn, and copies of a document at most.
WEIGHTS, CAP = (5, 2, 1), 3
#: Documents of one source and size that are ranked together.
CLASS_ROWS = 50_000
#: A table of at most so many bytes is sent to every executor.
SENT_BYTES = 32 << 20
#: Words a source may be off its target before rounding, and as a part of it.
NEAR, NEAR_PART = 0.5, 1e-9
EXACT = "decimal(38,4)"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    """A source that is not null, for joins; those that are null are one source."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _sent(df: DataFrame, size: int) -> DataFrame:
    return F.broadcast(df) if size <= SENT_BYTES else df


def _tables(spark: SparkSession) -> RoundTables:
    return RoundTables(spark, "mixing")


def in_turn(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """(source, weight): the sources by code point, null last, weigh ``weights`` in turn.

    Sources are numbered range by range, so no task holds all of them.
    """
    order = [F.col("source").isNull(), F.col("source")]
    sources = docs.select(F.col("source").cast("string")).distinct()
    ranges = sources.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    placed, _ = _tables(docs.sparkSession).write(ranges)
    counts = placed.groupBy("range").agg(F.count("*").alias("n"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    turn = F.pmod(F.col("first") + F.col("within"), F.lit(len(weights))).cast("int")
    listed = F.array(*[F.lit(float(w)) for w in weights])
    return placed.withColumn("within", within).join(F.broadcast(first), "range").select(
        "source", F.get(listed, turn).alias("weight")
    )


def targets(totals: DataFrame, weights: DataFrame, cap: int = CAP) -> tuple[DataFrame, int]:
    """(key, total, target) per source, and the bytes of that table.

    The words of all sources are shared by weight. A source stops at ``cap`` times its
    own words, and what it leaves is shared again, until none is above. A source
    without a weight weighs nothing.
    """
    rounds = _tables(totals.sparkSession)
    weighed = weights.select(_key(F.col("source")).alias("key"), F.col("weight").cast("double"))
    weighed = totals.join(weighed.groupBy("key").agg(F.max("weight").alias("weight")), "key", "left")
    weighed = weighed.select(
        "key", "total", "least", F.coalesce("weight", F.lit(0.0)).alias("weight"), F.lit(False).alias("stopped")
    )
    state, taken = rounds.write(weighed, bytes=F.sum(F.octet_length("key") + 64), words=F.sum("total"))
    ceiling = F.col("total") * F.lit(float(cap))
    while True:
        open_weight, ceilings = state.agg(
            F.sum(F.when(~F.col("stopped"), F.col("weight"))), F.sum(F.when(F.col("stopped"), ceiling))
        ).first()
        left = (taken["words"] or 0) - (ceilings or 0.0)
        share = left / open_weight if open_weight else 0.0
        above = ~F.col("stopped") & (F.col("weight") * F.lit(share) > ceiling)
        if state.filter(above).isEmpty():
            break
        before = state
        state, _ = rounds.write(state.withColumn("stopped", F.col("stopped") | above))
        rounds.drop(before)
    target = F.when(F.col("stopped"), ceiling).otherwise(F.col("weight") * F.lit(share))
    return state.select("key", "total", "least", target.alias("target")), taken["bytes"] or 0


def _rate(cap: int) -> Column:
    free = F.least(F.lit(float(cap)), F.exp(F.col("tilt") * F.col("size")))
    return F.when((F.col("target") <= 0) & (F.col("size") > 0), 0.0).otherwise(free)


def tilts(classes: DataFrame, wanted: DataFrame, size: int, cap: int = CAP) -> DataFrame:
    """``wanted`` (key, total, least, target) with the ``tilt`` of each source.

    Every round adds up, over the classes (key, size, n), the words that the present
    tilts take and how fast they change, and takes Newton's step for the dual. The root
    is kept between bounds; a step that leaves them, or after which a source is not at
    least twice as near, is replaced by halving. Sums are decimal, so that no order of
    rows changes them.
    """
    rounds = _tables(classes.sparkSession)
    at_cap = F.col("target") >= F.col("total") * (cap * (1 - 1e-12))
    top = F.lit(math.log(cap)) / F.col("least")
    state = wanted.select(
        "*",
        F.when(F.col("target") < F.col("total"), F.log(F.col("target") / F.col("total")) / F.col("least"))
        .otherwise(0.0).alias("low"),
        F.when(F.col("target") > F.col("total"), top).otherwise(0.0).alias("high"),
        F.when(at_cap, top).otherwise(0.0).alias("tilt"),
        F.lit(float("inf")).alias("off"),
        ((F.col("target") <= 0) | (F.col("total") <= 0) | at_cap).alias("done"),
    )
    state, left = rounds.write(state, open=F.count_if(~F.col("done")))
    rate, weight = _rate(cap), F.col("n") * F.col("size")
    slope = F.when(rate < cap, weight * F.col("size") * rate).otherwise(0.0)
    fixed = ["key", "total", "least", "target", "low", "high", "tilt", "off"]
    while left["open"]:
        summed = (
            classes.filter("size > 0").join(_sent(state.filter("NOT done"), size), "key")
            .groupBy(*fixed)
            .agg(F.sum((weight * rate).cast(EXACT)).alias("words"), F.sum(slope.cast(EXACT)).alias("slope"))
            .withColumn("words", F.col("words").cast("double"))
            .withColumn("miss", F.col("words") - F.col("target"))
            .withColumn("low", F.when(F.col("miss") < 0, F.col("tilt")).otherwise(F.col("low")))
            .withColumn("high", F.when(F.col("miss") > 0, F.col("tilt")).otherwise(F.col("high")))
            .withColumn("step", F.col("tilt") - F.try_divide("miss", F.col("slope").cast("double")))
            .withColumn("middle", (F.col("low") + F.col("high")) / 2)
        )
        fits = (F.col("step") > F.col("low")) & (F.col("step") < F.col("high"))
        fits = F.coalesce(fits, F.lit(False)) & (F.abs("miss") * 2 <= F.col("off"))
        moved = F.when(fits, F.col("step")).otherwise(F.col("middle"))
        near = F.abs("miss") <= F.greatest(F.lit(NEAR), F.col("target") * NEAR_PART)
        # Bounds without a number between them cannot come nearer.
        near = near | (F.col("middle") <= F.col("low")) | (F.col("middle") >= F.col("high"))
        after = summed.select(
            "key", "total", "least", "target", "low", "high",
            F.when(near, F.col("tilt")).otherwise(moved).alias("tilt"), F.abs("miss").alias("off"), near.alias("done"),
        )
        before = state
        state, left = rounds.write(
            after.unionByName(state.filter("done")), open=F.count_if(~F.col("done"))
        )
        rounds.drop(before)
    return state.select("key", "total", "target", "tilt")


def settled(planned: DataFrame, size: int, cap: int, rounds: RoundTables) -> DataFrame:
    """``planned`` with the words of each source as near to the target as single steps
    bring them: one document of the class whose size comes nearest to what a source is
    off gets a copy more or less, until no such step brings the source nearer."""
    copies = F.col("base") * F.col("n") + F.col("more")
    while True:
        off = F.sum(copies * F.col("size")) - F.first("target")
        apart = planned.groupBy("key").agg(off.alias("off"))
        room = F.when(F.col("off") > 0, copies > 0).otherwise(copies < F.col("n") * cap)
        left = F.abs(F.abs("off") - F.col("size"))
        best, found = rounds.write(
            planned.join(_sent(apart, size), "key").filter((F.col("size") > 0) & room & (left < F.abs("off")))
            .groupBy("key")
            .agg(F.min(F.struct(left.alias("left"), "size", "part")).alias("best"), F.max(-F.signum("off")).alias("step"))
            .select("key", "best.size", "best.part", F.col("step").cast("long").alias("step"))
        )
        if not found["rows"]:
            return planned
        more = F.col("more") + F.coalesce("step", F.lit(0))
        before = planned
        planned, _ = rounds.write(
            planned.join(_sent(best, size), ["key", "size", "part"], "left")
            .withColumn("base", F.col("base") + F.when(more < 0, -1).when(more > F.col("n"), 1).otherwise(0))
            .withColumn("more", more + F.when(more < 0, F.col("n")).when(more > F.col("n"), -F.col("n")).otherwise(0))
            .select(*before.columns)
        )
        rounds.drop(before)


def mix(
    docs: DataFrame, weights: DataFrame, cap: int = CAP, class_rows: int = CLASS_ROWS
) -> DataFrame:
    """Adds ``source_size``, ``target``, ``rate`` and ``copies`` to every row of ``docs``,
    which has ``source`` and a whole number ``size``; other columns stay as they are.

    ``weights`` are (source, weight). Rates are rounded up or down. Along the classes
    of a source, the largest first, the rounded copies follow the sum of the rates, so
    the words of a source miss the target by half of its largest document with a
    broken rate at most; single copies then bring them nearer. Which documents of a class are rounded up goes by the hash of
    the row, so a rerun agrees; rows alike are interchangeable. A class with more
    than ``class_rows`` rows is ranked in parts.

    A null or negative size counts as 0; a document of size 0 has the rate one. Null
    sources are one source. An empty table gives no rows. Columns of ``docs`` that are
    named like the four are replaced.
    """
    if cap < 1 or cap != int(cap):
        raise ValueError("the copies of a document are a whole number, at least 1")
    rounds = _tables(docs.sparkSession)
    plain = [name for name in docs.columns if "map<" not in docs.schema[name].dataType.simpleString()]
    rows = docs.select(
        F.struct("*").alias("row"), _key(F.col("source")).alias("key"),
        F.greatest(F.coalesce(F.col("size").cast("long"), F.lit(0)), F.lit(0)).alias("size"),
        F.xxhash64(*[F.col(f"`{name}`") for name in plain]).alias("order"),
    )
    classes, counted = rounds.write(
        rows.groupBy("key", "size").agg(F.count("*").alias("n")), most=F.max("n"),
        bytes=F.sum(F.octet_length("key") + 64),
    )
    totals = classes.groupBy("key").agg(
        F.sum(F.col("n") * F.col("size")).alias("total"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least")
    )
    wanted, size = targets(totals, weights, cap)
    tilted = tilts(classes, wanted, size, cap)

    part, parts = F.lit(0), classes
    if (counted["most"] or 0) > class_rows:
        # The parts of a large class, by the same hash that ranks within them.
        cut = F.ceil(F.col("n") / class_rows)
        large = classes.select("key", "size", cut.alias("cut")).filter("cut > 1")
        rows = rows.join(_sent(large, counted["bytes"] or 0), ["key", "size"], "left")
        part = F.pmod(F.xxhash64("order"), F.coalesce("cut", F.lit(1)))
        parts = rows.groupBy("key", "size", part.alias("part")).agg(F.count("*").alias("n"))
    rows = rows.withColumn("part", part.cast("long"))
    parts = parts if "part" in parts.columns else parts.withColumn("part", F.lit(0))
    along = Window.partitionBy("key").orderBy(F.desc("size"), "part")
    planned, listed = rounds.write(
        parts.select("key", "size", F.col("part").cast("long").alias("part"), "n")
        .join(_sent(tilted, size), "key")
        .withColumn("rate", _rate(cap))
        .withColumn("base", F.floor("rate"))
        .withColumn("extra", (F.col("n") * (F.col("rate") - F.col("base"))).cast("decimal(38,9)"))
        .withColumn("sum", F.sum("extra").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("more", F.round("sum") - F.round(F.col("sum") - F.col("extra")))
        .select("key", "size", "part", "n", F.col("total").alias("source_size"), "target", "rate", "base",
                F.col("more").cast("long").alias("more")),
        bytes=F.sum(F.octet_length("key") + 96),
    )
    planned = settled(planned, size, cap, rounds)
    # Only classes of which some are rounded up are ranked; others are spread evenly.
    apart = F.when((F.col("more") <= 0) | (F.col("more") >= F.col("n")), F.col("order")).otherwise(0)
    place = F.row_number().over(Window.partitionBy("key", "size", "part", apart).orderBy("order"))
    more = F.when(F.col("more") <= 0, 0).when(F.col("more") >= F.col("n"), 1)
    made = rows.join(_sent(planned, listed["bytes"] or 0), ["key", "size", "part"]).withColumn("place", place)
    copies = F.col("base") + more.otherwise((F.col("place") <= F.col("more")).cast("int"))
    kept = [F.col(f"row.`{name}`") for name in docs.columns if name not in ("source_size", "target", "rate", "copies")]
    return made.select(*kept, "source_size", "target", "rate", copies.cast("long").alias("copies"))


def repeated(mixed: DataFrame) -> DataFrame:
    """The rows of a mix, each as often as its ``copies`` say."""
    times = F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies").cast("int")))
    return mixed.withColumn("copies", F.explode(times)).drop("copies")


def op11_source_mixing(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents")
    sized, _ = _tables(spark).write(
        docs.select("doc_id", F.col("source").cast("string"), n_words(F.col("text")).alias("size"))
    )
    return mix(sized, in_turn(sized)).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )
