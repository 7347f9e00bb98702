"""The inferred "knows" edge in its two variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieweave.operators.pairs import BLOCK_ROWS, Groups, both_directions, gather_groups, pairs_of
from tieweave.session import cut_lineage, kept_apart, numbered, sent_whole

# What each kind of shared behaviour adds to the tie strength.
SHARED_EVENT, SHARED_VIP_EVENT, SHARED_RESERVATION = 1.0, 0.5, 0.75
TIE_ATTENDANCE, TIE_RESERVATION, TIE_PURCHASE = 1.0, 0.75, 0.25


def tie_members(
    attendance: DataFrame, events: DataFrame, reservations: DataFrame | None = None
) -> DataFrame:
    """One row per user and event, the input of the pairing.

    ``kind`` is 0 for a user who only reserved, 1 for one who attended and 2 for a VIP.
    Duplicates are folded before pairing. Several reservations of one user for one event
    keep their number (``times``), since every pair of reservations counts, and so do
    several events of one id (``copies``).
    """
    days = events.groupBy(F.col("id").alias("event_id")).agg(
        F.count(F.lit(1)).alias("copies"), F.min("event_date").alias("first"), F.max("event_date").alias("last")
    )
    members = (
        attendance.dropna(subset=["user_id", "event_id"])
        .groupBy("event_id", "user_id")
        .agg(F.coalesce(F.max(F.col("ticket_tier") == "vip"), F.lit(False)).alias("vip"))
    )
    if reservations is None:
        members = members.withColumn("times", F.lit(0).cast("long"))
    else:
        booked = (
            reservations.dropna(subset=["user_id", "event_id"])
            .groupBy("event_id", "user_id")
            .agg(F.count(F.lit(1)).alias("times"))
        )
        members = members.join(booked, ["event_id", "user_id"], "full")
    kind = F.when(F.col("copies").isNull() | F.col("vip").isNull(), 0).when(F.col("vip"), 2).otherwise(1)
    return (
        members.join(days, "event_id", "left")
        .select(
            "event_id", "user_id", kind.cast("tinyint").alias("kind"),
            F.coalesce("times", F.lit(0).cast("long")).alias("times"), "copies", "first", "last",
        )
        .filter("kind > 0 OR times > 0")
    )


def _fold_pairs(members: DataFrame, block_rows: int) -> DataFrame:
    """Sums per pair with a ``touched`` member; without that column all are.

    Each touched member gets a list of those it met at an event, so what travels per pair is
    the number of the other one. Of two touched ones that with the less number gets the
    other. Lists are dealt by their receiver, to as many tasks as there are pairs for.
    """
    if "touched" not in members.columns:
        members = members.withColumn("touched", F.lit(True))
    groups = gather_groups(
        members, ["event_id"], "user_id", block_rows, (F.count_if(F.col("kind") > 0), F.count_if(F.col("times") > 0))
    )
    numbers, rows = numbered(groups.members.select("user_id"), "user_id")
    small = sent_whole(numbers, rows)
    dealt_by = groups.keys if groups.large is None else [*groups.keys, "block"]
    chunks = (
        groups.placed().join(small, "user_id").repartition(groups.parts, *dealt_by)
        .groupBy(*groups.keys, "blocks", "block")
        .agg(
            F.collect_list(F.struct("n", "kind", "times", "touched")).alias("people"),
            F.max("copies").alias("copies"), F.min("first").alias("first"), F.max("last").alias("last"),
        )
    )
    receivers = F.filter("people", lambda p: p["touched"]).alias("receivers")
    if groups.large is None:
        met = chunks.select("*", receivers)
    else:
        met = groups.meet(chunks.select(*groups.keys, "blocks", "block", receivers), chunks)
    one, event = F.col("one"), ("copies", "first", "last")
    others = F.filter("people", lambda p: (
        (p["n"] != one["n"]) & (~p["touched"] | (p["n"] > one["n"]))
        & (((p["kind"] > 0) & (one["kind"] > 0)) | ((p["times"] > 0) & (one["times"] > 0)))
    ))
    lists = (
        met.select(F.explode("receivers").alias("one"), "people", *event)
        .select("one", others.alias("others"), *event).filter(F.size("others") > 0)
        .select(
            F.col("one.n").alias("user_1"), F.col("one.kind").alias("kind_1"), F.col("one.times").alias("times_1"),
            *event, *[F.col(f"others.{name}").alias(name) for name in ("n", "kind", "times")],
        )
    )
    lists = groups.dealt(lists, "user_1")
    pairs = lists.select(
        "user_1", "kind_1", "times_1", *event, F.inline(F.arrays_zip("n", "kind", "times")).alias("user_2", "kind", "times")
    )
    kind, both = F.least("kind", "kind_1"), F.col("copies") * F.col("copies")
    total = lambda value: F.coalesce(F.sum(value), F.lit(0))
    folded = (
        pairs.groupBy("user_1", "user_2")
        .agg(
            total(F.when(kind > 0, both)).alias("shared_events"), total(F.when(kind > 1, both)).alias("shared_vip_events"),
            total(F.col("times") * F.col("times_1")).alias("shared_reservations"),
            F.min(F.when(kind > 0, F.col("first"))).alias("first_shared_event"),
            F.max(F.when(kind > 0, F.col("last"))).alias("last_shared_event"),
        )
        .filter("shared_events >= 1")
    )
    for end in ("user_1", "user_2"):
        named = small.select(F.col("n").alias(end), F.col("user_id").alias(f"{end}_id"))
        folded = folded.join(named, end).drop(end)
    strength = (
        F.col("shared_events") * F.lit(SHARED_EVENT)
        + F.col("shared_vip_events") * F.lit(SHARED_VIP_EVENT)
        + F.col("shared_reservations") * F.lit(SHARED_RESERVATION)
    )
    return folded.select(
        F.least("user_1_id", "user_2_id").alias("user_1"), F.greatest("user_1_id", "user_2_id").alias("user_2"),
        "shared_events", "shared_vip_events", "shared_reservations", "first_shared_event", "last_shared_event",
        F.round(strength, 3).alias("tie_strength"),
    )


def conoce_a(
    attendance: DataFrame,
    events: DataFrame,
    reservations: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One tie per pair that shared an event, with what else the pair shared."""
    return _fold_pairs(tie_members(attendance, events, reservations), block_rows)


def _flagged(members: DataFrame, keys: list[str], touched: DataFrame) -> DataFrame:
    """The members of the groups that a touched user is in, and whether they are ``touched``."""
    touched = touched.select("user_id").distinct()
    flagged = members.join(kept_apart(touched.withColumn("touched", F.lit(True))), "user_id", "left")
    flagged = cut_lineage(flagged.withColumn("touched", F.coalesce("touched", F.lit(False))), "flagged")
    live_groups = flagged.filter("touched").select(*keys).distinct()
    return flagged.join(kept_apart(live_groups), keys, "left_semi")


def _touched_pairs(
    members: DataFrame, keys: list[str], touched: DataFrame, payload: tuple[str, ...], block_rows: int
) -> tuple[Groups, DataFrame]:
    """Each pair with a touched user once per group, and the groups: touched members against all."""
    live = _flagged(members, keys, touched)
    groups = gather_groups(live, keys, "user_id", block_rows)
    placed = groups.placed()
    side = lambda rows, end, *more: rows.select(
        *keys, "blocks", "block", *more,
        *[F.col(name).alias(name + end) for name in ("user_id", *payload)],
    )
    once = ~F.col("touched") | (F.col("user_id_1") < F.col("user_id_2"))
    return groups, (
        groups.meet(side(placed.filter("touched"), "_1"), side(placed, "_2", "touched"))
        .filter((F.col("user_id_1") != F.col("user_id_2")) & once)
        .withColumn("user_1", F.least("user_id_1", "user_id_2"))
        .withColumn("user_2", F.greatest("user_id_1", "user_id_2"))
    )


def touched_ties(
    touched: DataFrame,
    attendance: DataFrame,
    events: DataFrame,
    reservations: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ties of every pair with a touched user; ``touched`` holds the ``user_id`` of
    every user whose bookings changed."""
    members = tie_members(attendance, events, reservations)
    return _fold_pairs(_flagged(members, ["event_id"], touched), block_rows)


def conoce_a_incremental(
    ties: DataFrame,
    touched: DataFrame,
    attendance: DataFrame,
    events: DataFrame,
    reservations: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Ties after a change, recomputing only pairs with a touched user.

    The second end is looked up first: ties that already lie by it stay where they are.
    """
    touched = touched.select("user_id").distinct()
    end = lambda name: kept_apart(touched.select(F.col("user_id").alias(name)))
    untouched = ties.join(end("user_2"), "user_2", "left_anti").join(
        end("user_1"), "user_1", "left_anti"
    )
    made = touched_ties(touched, attendance, events, reservations, block_rows)
    return untouched.unionByName(made.select(*untouched.columns))


def pair_counts(edges: DataFrame, event_dates: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Distinct shared events of each pair, with the first and last date."""
    members = edges.select("event_id", "user_id").dropna().distinct()
    dated = members.join(event_dates.select("event_id", "event_date"), "event_id", "left")
    groups = gather_groups(dated, ["event_id"], "user_id", block_rows)
    return (
        groups.dealt(pairs_of(groups, ("event_date",)), "user_1", "user_2")
        .groupBy(F.col("user_1").alias("user_1_id"), F.col("user_2").alias("user_2_id"))
        .agg(
            F.count(F.lit(1)).alias("shared_count"),
            F.min("event_date_1").alias("first_shared_event"),
            F.max("event_date_1").alias("last_shared_event"),
        )
    )


def channel_members(
    purchases: DataFrame, attendances: DataFrame, reservations: DataFrame, event_dates: DataFrame
) -> DataFrame:
    """One row per channel, event and user, with the date of the event."""
    channel = lambda df, name: df.select(F.lit(name).alias("channel"), "event_id", "user_id")
    return (
        channel(attendances, "attendance")
        .unionByName(channel(purchases, "purchase"))
        .unionByName(channel(reservations, "reservation"))
        .dropna()
        .distinct()
        .join(event_dates.select("event_id", "event_date"), "event_id", "left")
    )


def _fold_channels(groups: Groups, pairs: DataFrame) -> DataFrame:
    shared = lambda name: F.coalesce(
        F.sum(F.when(F.col("channel") == name, 1)), F.lit(0)
    ).cast("long")
    strength: Column = (
        F.col("shared_attendances") * F.lit(TIE_ATTENDANCE)
        + F.col("shared_reservations") * F.lit(TIE_RESERVATION)
        + F.col("shared_purchases") * F.lit(TIE_PURCHASE)
    )
    adds = pairs.select("user_1", "user_2", "channel", "event_date_1")
    return (
        groups.dealt(adds, "user_1", "user_2")
        .groupBy(F.col("user_1").alias("user_1_id"), F.col("user_2").alias("user_2_id"))
        .agg(
            shared("attendance").alias("shared_attendances"),
            shared("purchase").alias("shared_purchases"),
            shared("reservation").alias("shared_reservations"),
            F.min("event_date_1").alias("first_shared_event"),
            F.max("event_date_1").alias("last_shared_event"),
        )
        .withColumn("tie_strength", F.round(strength, 3))
        .filter("tie_strength > 0")
    )


CHANNEL_KEYS = ["channel", "event_id"]


def social_ties(
    purchases: DataFrame,
    attendances: DataFrame,
    reservations: DataFrame,
    event_dates: DataFrame,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Ties over three channels, paired in one pass and folded in one shuffle."""
    members = channel_members(purchases, attendances, reservations, event_dates)
    groups = gather_groups(members, CHANNEL_KEYS, "user_id", block_rows)
    return _fold_channels(groups, pairs_of(groups, ("event_date",)))


def touched_social_ties(members: DataFrame, touched: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Of the ties among ``channel_members`` those with a touched user."""
    return _fold_channels(*_touched_pairs(members, CHANNEL_KEYS, touched, ("event_date",), block_rows))


def tied_endpoints(ties: DataFrame) -> DataFrame:
    """Users that have at least one tie, as ``id``."""
    return both_directions(ties).select(F.col("src").alias("id")).distinct()
