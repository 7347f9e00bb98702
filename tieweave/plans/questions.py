"""The catalogue of business questions, each a function from tables to a table.

Ranked answers break ties by key. A limit is part of the question (a top list);
everything else is computed over all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieweave.graph.social import SocialGraph
from tieweave.graph.walks import bfs_levels, reach_of_all
from tieweave.operators.pairs import (
    BLOCK_ROWS, TASK_PAIRS, Groups, both_directions, gather_groups, pairs_in_group, pairs_of,
)
from tieweave.session import RoundTables, partitions_for, sent_whole

TOP = 20
#: Circles that one long holds as bits.
MASK_BITS = 63


def _share(part: Column | str, whole: Column | str, digits: int) -> Column:
    part, whole = (F.col(c) if isinstance(c, str) else c for c in (part, whole))
    return F.round(part / whole, digits)


def _top(df: DataFrame, limit: int | None, *order: Column | str) -> DataFrame:
    ordered = df.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)


def ranked(top: DataFrame, *order: Column | str) -> DataFrame:
    """Adds ``rank`` to a list that a limit has already made short."""
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def _rows(df: DataFrame) -> Column:
    """Number of rows, as a scalar subquery."""
    return df.agg(F.count(F.lit(1))).scalar()


# Counts and listings


def graph_counts(users: DataFrame, events: DataFrame, tables: DataFrame, ties: DataFrame) -> DataFrame:
    """Totals; ``edges_two_way`` counts every tie from both of its ends."""
    return (
        ties.agg(F.count(F.lit(1)).alias("edges"))
        .withColumn("edges_two_way", F.col("edges") * 2)
        .withColumn("users", _rows(users))
        .withColumn("events", _rows(events))
        .withColumn("tables", _rows(tables))
    )


def node_counts_by_label(**tables: DataFrame) -> DataFrame:
    """Number of nodes per label, largest first, with the total on each row."""
    labelled = None
    for label, df in tables.items():
        rows = df.select(F.lit(label).alias("label"))
        labelled = rows if labelled is None else labelled.unionByName(rows)
    counts = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("nodes"))
    total = counts.agg(F.sum("nodes")).scalar()
    return counts.withColumn("total_nodes", total).orderBy(F.desc("nodes"), "label")


def edge_count(edges: DataFrame) -> DataFrame:
    return edges.agg(F.count(F.lit(1)).alias("edges"))


def density(users: DataFrame, ties: DataFrame) -> DataFrame:
    """True density, and the figure that counts every tie from both ends."""
    n, m = F.col("users"), F.col("ties")
    possible = n * (n - 1)
    return (
        users.agg(F.count(F.lit(1)).alias("users"))
        .withColumn("ties", _rows(ties))
        .select(
            "users", "ties",
            F.when(possible > 0, _share(2 * m, possible, 4)).alias("density"),
            F.when(possible > 0, _share(4 * m, possible, 4)).alias("density_reference"),
        )
    )


def list_users(users: DataFrame, limit: int = 500) -> DataFrame:
    if not 1 <= limit <= 2000:
        raise ValueError("limit must be between 1 and 2000")
    return users.select("id", "username").orderBy("id").limit(limit)


def search_users(users: DataFrame, text: str) -> DataFrame:
    """Users whose id or name contains ``text``, in any case."""
    needle = F.lit(text.strip().lower())
    found = F.lower("id").contains(needle) | F.coalesce(
        F.lower("username").contains(needle), F.lit(False)
    )
    return users.filter(found).select("id", "username")


def recent_users(users: DataFrame, name_prefix: str, limit: int = 5) -> DataFrame:
    """Latest users whose name starts with the prefix, newest id first."""
    return (
        users.filter(F.col("username").startswith(name_prefix))
        .select("user_id", "username", "telegram_id")
        .orderBy(F.desc("user_id"))
        .limit(limit)
    )


# Ties


def top_ties(ties: DataFrame, limit: int = TOP) -> DataFrame:
    columns = [
        "user_1", "user_2", "shared_events", "shared_vip_events", "shared_reservations",
        "tie_strength",
    ]
    return _top(ties.select(*columns), limit, F.desc("tie_strength"), "user_1", "user_2")


def degree(graph: SocialGraph, limit: int | None = 10) -> DataFrame:
    tied = graph.vertices.filter("degree > 0").select(F.col("id").alias("user_id"), "degree")
    return _top(tied, limit, F.desc("degree"), "user_id")


def isolated_users(users: DataFrame, ties: DataFrame) -> DataFrame:
    ends = both_directions(ties).select(F.col("src").alias("id"))
    return (
        users.select("id").join(ends, "id", "left_anti").withColumnRenamed("id", "user_id")
        .orderBy("user_id")
    )


def dependency_on_user(ties: DataFrame, user_id: str, limit: int = TOP) -> DataFrame:
    """Whom the absence of a user would affect, strongest tie first."""
    is_first = F.col("user_1") == user_id
    return _top(
        ties.filter(is_first | (F.col("user_2") == user_id)).select(
            F.when(is_first, F.col("user_2")).otherwise(F.col("user_1")).alias("impacted_user"),
            "tie_strength", "shared_events", "shared_reservations",
        ),
        limit, F.desc("tie_strength"), "impacted_user",
    )


# Companions


def _dated(attendance: DataFrame, events: DataFrame) -> DataFrame:
    return (
        attendance.select("user_id", "event_id").dropna().distinct()
        .join(events.select(F.col("id").alias("event_id"), "event_date"), "event_id")
    )


def _per_event_summary(
    per_event: DataFrame, attendance: DataFrame, found: str, events_with: str, limit: int | None
) -> DataFrame:
    """Average ``found`` per event that has any, and the share of such events."""
    totals = (
        attendance.select("user_id", "event_id").dropna().distinct()
        .groupBy("user_id").agg(F.count(F.lit(1)).alias("total_events"))
    )
    summary = (
        per_event.groupBy("user_id")
        .agg(F.count(F.lit(1)).alias(events_with), F.sum(found).alias("found"))
        .join(totals, "user_id")
        .select(
            "user_id", "total_events", events_with,
            _share("found", events_with, 2).alias(f"avg_{found}"),
            _share(events_with, "total_events", 3).alias(f"share_{events_with}"),
        )
    )
    return _top(
        summary, limit, F.desc(f"avg_{found}"), F.desc(f"share_{events_with}"), "user_id"
    )


def new_companions_by_order(
    attendance: DataFrame, events: DataFrame, limit: int | None = TOP, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """People met for the first time, counted at the pair's first shared event.

    The first event is the earliest by (date, id), one per pair.
    """
    dated = _dated(attendance, events).withColumn(
        "place", F.struct(F.col("event_date").isNull().alias("undated"), "event_date", "event_id")
    )
    first = (
        pairs_in_group(dated, ["event_id"], "user_id", ("place",), block_rows)
        .groupBy("user_1", "user_2")
        .agg(F.min("place_1").alias("place"))
        .select("user_1", "user_2", F.col("place.event_id").alias("event_id"))
    )
    return _first_meetings(first, attendance, limit)


def new_companions_by_date(
    attendance: DataFrame, events: DataFrame, limit: int | None = TOP, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The same, but every shared event on the pair's first date counts."""
    pairs = pairs_in_group(
        _dated(attendance, events).dropna(subset=["event_date"]),
        ["event_id"], "user_id", ("event_date",), block_rows,
    )
    order = Window.partitionBy("user_1", "user_2").orderBy("event_date_1")
    first = pairs.withColumn("place", F.rank().over(order)).filter("place = 1")
    return _first_meetings(first.select("user_1", "user_2", "event_id"), attendance, limit)


def _first_meetings(first: DataFrame, attendance: DataFrame, limit: int | None) -> DataFrame:
    per_event = (
        both_directions(first, "event_id")
        .groupBy(F.col("src").alias("user_id"), "event_id")
        .agg(F.count(F.lit(1)).alias("new_companions"))
    )
    return _per_event_summary(
        per_event, attendance, "new_companions", "events_with_new_companions", limit
    )


def debutants(attendance: DataFrame, events: DataFrame, limit: int | None = TOP) -> DataFrame:
    """Companions on their first date at the venue, without pairing anybody.

    At an event everybody meets the same debutants except themselves, so one
    count per event is enough.
    """
    dated = _dated(attendance, events)
    first = dated.groupBy("user_id").agg(F.min("event_date").alias("first_date"))
    flagged = dated.join(first, "user_id").select(
        "user_id", "event_id",
        F.coalesce(F.col("event_date") == F.col("first_date"), F.lit(False)).cast("long")
        .alias("is_debut"),
    )
    per_event = flagged.groupBy("event_id").agg(F.sum("is_debut").alias("debuts"))
    met = (
        flagged.join(per_event, "event_id")
        .select("user_id", "event_id", (F.col("debuts") - F.col("is_debut")).alias("debutants"))
        .filter("debutants > 0")
    )
    return _per_event_summary(met, attendance, "debutants", "events_with_debutants", limit)


def large_groups(attendance: DataFrame, limit: int | None = TOP) -> DataFrame:
    """Companions per event from the size of each event, again without pairs."""
    went = attendance.select("user_id", "event_id").dropna().distinct()
    sizes = (
        went.groupBy("event_id").agg((F.count(F.lit(1)) - 1).alias("companions"))
        .filter("companions > 0")
    )
    groups = (
        went.join(sizes, "event_id")
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.sum("companions").alias("total"),
            F.max("companions").alias("max_companions"),
        )
        .select(
            "user_id", "events",
            _share("total", "events", 6).alias("avg_companions"), "max_companions",
        )
    )
    return _top(groups, limit, F.desc("avg_companions"), F.desc("max_companions"), "user_id")


# Tables booked together


def _tied_matches(
    ties: DataFrame, booked: DataFrame, keys: list[str], payload: tuple[str, ...], kinds: list[Column], block_rows: int
) -> DataFrame:
    """Tied pairs among ``booked`` by ``kinds``, with their ``matches``.

    Pairs and ties are dealt by their ends to as many tasks, at least one for each
    ``TASK_PAIRS``, so the sum and the join need no further shuffle.
    """
    groups = gather_groups(booked, keys, "user_id", block_rows)
    matches = pairs_of(groups, (*payload, "times")).select(
        "user_1", "user_2", *kinds, (F.col("times_1") * F.col("times_2")).alias("matches")
    )
    usual = int(ties.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [groups.parts] if groups.parts > usual else []
    dealt = lambda rows: rows.repartition(*by, "user_1", "user_2")
    return (
        dealt(matches).groupBy(*[name for name in matches.columns if name != "matches"])
        .agg(F.sum("matches").alias("matches"))
        .join(dealt(ties.select("user_1", "user_2")), ["user_1", "user_2"], "left_semi")
    )


def same_table_type(
    ties: DataFrame, reservations: DataFrame, tables: DataFrame,
    limit: int | None = TOP, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Tied pairs that booked the same type of table for one event."""
    booked = (
        reservations.join(tables.select(F.col("id").alias("table_id"), "table_type"), "table_id")
        .groupBy("event_id", "table_type", "user_id")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    tied = _tied_matches(ties, booked, ["event_id", "table_type"], (), [F.col("table_type")], block_rows)
    return _top(tied, limit, F.desc("matches"), "user_1", "user_2", "table_type")


def same_vip_table(
    ties: DataFrame, reservations: DataFrame, tables: DataFrame,
    limit: int | None = TOP, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Tied pairs with equal VIP rank of table, per capacity of the first's table."""
    booked = (
        reservations.join(tables.select(F.col("id").alias("table_id"), "is_vip", "capacity"), "table_id")
        .groupBy("event_id", "is_vip", "user_id", "capacity")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    kinds = [F.col("is_vip"), F.col("capacity_1").alias("capacity")]
    tied = _tied_matches(ties, booked, ["event_id", "is_vip"], ("capacity",), kinds, block_rows)
    return _top(
        tied, limit, F.desc("matches"), "user_1", "user_2", "is_vip", F.asc_nulls_last("capacity")
    )


# Recommendations


def _recommended(seen: DataFrame, went: DataFrame, events: DataFrame) -> DataFrame:
    """Adds up what friends attended (``seen``) and drops what the user attended."""
    return (
        seen.groupBy("user_id", "event_id")
        .agg(F.sum("weight").alias("score"), F.count(F.lit(1)).alias("friends_attended"))
        .join(went, ["user_id", "event_id"], "left_anti")
        .join(events.select(F.col("id").alias("event_id"), F.col("name").alias("event_name")), "event_id")
        .select("user_id", "event_id", "event_name", "score", "friends_attended")
    )


RECOMMENDATION_ORDER = (F.desc, "score"), (F.desc, "friends_attended"), (F.asc, "event_id")


def event_recommendation(
    graph: SocialGraph, attendance: DataFrame, events: DataFrame, user_id: str, limit: int = 10
) -> DataFrame:
    """Events that one user's neighbours attended and the user did not, ranked.

    ``score`` sums the tie strengths of the friends that went.
    """
    order = [way(name) for way, name in RECOMMENDATION_ORDER]
    went = attendance.select("user_id", "event_id").dropna().distinct()
    friends = graph.edges.filter(F.col("src") == user_id).select("dst", "weight")
    seen = friends.join(went.withColumnRenamed("user_id", "dst"), "dst").withColumn(
        "user_id", F.lit(user_id)
    )
    own = went.filter(F.col("user_id") == user_id)
    best = _top(_recommended(seen, own, events), limit, *order)
    return relative_score(ranked(best, *order))


def event_recommendation_all(
    graph: SocialGraph, attendance: DataFrame, events: DataFrame, limit: int = 10
) -> DataFrame:
    """The top events of every user at once.

    Attendances travel along the edges, which stay in place even around hubs. What arrives
    is counted beforehand and dealt to tasks by that number, together with what a user
    attended, so an event is dropped where its score adds up. Names join the best only.
    """
    order = [way(name) for way, name in RECOMMENDATION_ORDER]
    place = F.row_number().over(Window.partitionBy("user_id").orderBy(*order))
    best = lambda rows: rows.withColumn("rank", place).filter(F.col("rank") <= limit)
    named = events.select(F.col("id").alias("event_id"), F.col("name").alias("event_name"))
    went = attendance.select("user_id", "event_id").dropna().distinct()
    went = went.join(named.select("event_id"), "event_id", "left_semi").select("user_id", "event_id")
    went, _ = RoundTables(events.sparkSession, "went").write(went)
    sent = went.groupBy(F.col("user_id").alias("id")).count().join(graph.vertices.select("id", "degree"), "id")
    arriving = sent.agg(F.sum(F.col("count") * F.col("degree"))).first()[0]
    seen = graph.along_edges(
        went.withColumnRenamed("user_id", "id"), F.col("to").alias("user_id"), "event_id", "weight",
        F.lit(None).cast("boolean").alias("own"),
    )
    # Without hubs nobody has more than a task can rank, so users are not shuffled again.
    dealt_by = ["user_id"] if graph.hubs is None else ["user_id", "event_id"]
    own = went.withColumns({"weight": F.lit(None).cast("double"), "own": F.lit(True)})
    scored = (
        seen.unionByName(own)
        .repartition(partitions_for(events.sparkSession, arriving or 0, TASK_PAIRS), *dealt_by)
        .groupBy("user_id", "event_id")
        .agg(F.sum("weight").alias("score"), F.count(F.lit(1)).alias("friends_attended"), F.max("own").alias("own"))
        .filter("own IS NULL")
    )
    return best(best(scored).drop("rank").join(named, "event_id")).select(
        "user_id", "event_id", "event_name", "score", "friends_attended", "rank"
    )


def relative_score(top: DataFrame) -> DataFrame:
    """Score as a part of the best score of a short ranked list, 0 if that is 0."""
    best = F.first("score").over(Window.orderBy(F.desc("score")))
    part = F.when(best == 0, 0.0).otherwise(F.col("score") / best)
    return top.withColumn("relative_score", F.round(part, 4))


def strangers_same_circle(
    graph: SocialGraph, ties: DataFrame, attendance: DataFrame | None = None,
    limit: int | None = TOP,
) -> DataFrame:
    """Pairs with mutual neighbours that have no tie and never shared an event.

    Leave out ``attendance`` when the ties were derived from it: then a shared
    event is a tie and the second test is the first.

    A top list does not pair the neighbours of the largest hubs. Their circles are bits
    of a mask per user, which count fully for every pair that also meets elsewhere; a
    pair that meets only within ``h`` such circles has at most ``h`` mutuals. So the
    list is exact if its last place has more than ``h``; otherwise that place, a lower
    bound of the right one, says how many hubs can stay out, and a second pass ends it.
    """
    known = ties.select("user_1", "user_2")
    if attendance is not None:
        went = attendance.select("user_id", "event_id").dropna().distinct()
        met = pairs_in_group(went, ["event_id"], "user_id")
        known = known.unionByName(met.select("user_1", "user_2"))
    order = [F.desc("mutuals"), "user_1", "user_2"]
    tables = RoundTables(graph.vertices.sparkSession, "strangers")
    numbered = _numbered(graph, tables)

    def found(left_out: int) -> DataFrame:
        top = _top(_mutuals(graph, left_out, known, numbered), limit, *order)
        for end in ("user_1", "user_2"):
            named = numbered[0].select("id", F.col("n").alias(end))
            top = (F.broadcast(top) if limit else top).join(named, end).drop(end).withColumnRenamed("id", end)
        return _top(top.select("user_1", "user_2", "mutuals"), limit, *order)

    if not limit or graph.hubs is None:
        return found(0)
    left_out = min(MASK_BITS, graph.hubs.count())
    top, best = tables.write(found(left_out), least=F.min("mutuals"))
    least = best["least"] if best["rows"] == limit else 0
    return _top(top, limit, *order) if least > left_out else found(max(0, least - 1))


def _numbered(graph: SocialGraph, tables: RoundTables) -> tuple[DataFrame, dict]:
    """Every ``id`` with a tie and its number ``n``, which has the order of the ids; and how
    many ``rows`` there are and ``pairs`` in their circles."""
    sizes = graph.edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).cast("double").alias("size"))
    ordered = sizes.orderBy("id").select("id", F.monotonically_increasing_id().alias("n"), "size")
    numbers, taken = tables.write(ordered, pairs=F.sum(F.col("size") * (F.col("size") - 1) / 2))
    return numbers.select("id", "n"), taken


def _mutuals(
    graph: SocialGraph, left_out: int, known: DataFrame | None = None,
    numbered: tuple[DataFrame, dict] | None = None,
) -> DataFrame:
    """``mutuals`` of all pairs, by their numbers, that are not ``known`` and have a common
    neighbour outside the ``left_out`` largest circles, those within included.

    Few pairs meet twice, so they are not counted before their shuffle. It deals them and
    the known ones to as many tasks as there are pairs for, and there a pair with its
    mutuals meets the known one.
    """
    spark = graph.vertices.sparkSession
    numbers, taken = numbered or _numbered(graph, RoundTables(spark, "strangers"))
    rows, parts = taken["rows"], partitions_for(spark, int(taken["pairs"] or 0))
    small = sent_whole(numbers, rows)
    blocks = graph.hub_blocks()
    if blocks is not None:
        blocks = blocks.join(small.withColumnRenamed("id", "src"), "src").select(F.col("n").alias("src"), "blocks")
    state, payload, within = numbers, (), F.lit(0)
    if left_out:
        largest = graph.vertices.orderBy(F.desc("degree"), "id").limit(left_out)
        largest = [row["id"] for row in largest.select("id").collect()]  # at most MASK_BITS
        bit = F.array_position(F.lit(largest), F.col("src")) - 1
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), bit.cast("int"))
        masks = graph.edges.filter(F.col("src").isin(largest)).groupBy(F.col("dst").alias("id")).agg(F.bit_or(mask).alias("mask"))
        state = state.join(masks, "id", "left").select(
            "id", "n", F.coalesce("mask", F.lit(0).cast("long")).alias("mask")
        )
        payload, within = ("mask",), F.bit_count(F.col("mask_1").bitwiseAND(F.col("mask_2")))
    sent = graph.along_edges(state, "to", F.col("n").alias("dst"), *payload, rows=rows)
    if left_out:
        sent = sent.filter(~F.col("to").isin(largest))
    circles = sent.join(small.select(F.col("id").alias("to"), F.col("n").alias("src")), "to").drop("to")
    groups = Groups(circles, ["src"], "dst", blocks, parts)
    met = pairs_of(groups, payload).select("user_1", "user_2", within.cast("int").alias("within"))
    if known is not None:
        for end in ("user_1", "user_2"):
            known = known.join(small.withColumnRenamed("id", end), end).drop(end).withColumnRenamed("n", end)
        met = met.unionByName(known.select("user_1", "user_2", F.lit(None).cast("int").alias("within")))
    return (
        groups.dealt(met, "user_1", "user_2").groupBy("user_1", "user_2")
        .agg(
            F.count(F.lit(1)).alias("rows"), F.count("within").alias("met"), F.max("within").alias("within")
        )
        .filter("met > 0 AND rows = met")
        .select("user_1", "user_2", (F.col("met") + F.col("within")).alias("mutuals"))
    )


# Reach


def promo_reach(graph: SocialGraph, users: DataFrame, seeds: DataFrame, hops: int = 3) -> DataFrame:
    """New users per hop from each seed, and their share of all users."""
    levels = bfs_levels(graph, seeds, hops)
    at_hop = lambda hop: F.count(F.when(F.col("level") == hop, 1)).alias(f"hop{hop}")
    counts = levels.groupBy(F.col("seed").alias("user_id")).agg(
        *[at_hop(hop) for hop in range(1, hops + 1)]
    )
    return _reach_shares(counts, users, hops)


def promo_reach_all(graph: SocialGraph, users: DataFrame, hops: int = 3) -> DataFrame:
    """``promo_reach`` of every user."""
    return _reach_shares(reach_of_all(graph, hops).withColumnRenamed("id", "user_id"), users, hops)


def _reach_shares(counts: DataFrame, users: DataFrame, hops: int) -> DataFrame:
    reach = sum(F.col(f"hop{hop}") for hop in range(1, hops + 1))
    names = users.select(F.col("id").alias("user_id"), "username")
    return (
        counts.join(names, "user_id")
        .withColumn("total_users", _rows(users))
        .withColumn("total_reach", reach)
        .withColumn("reach_percentage", _share(F.col("total_reach") * 100, "total_users", 2))
    )


def indirect_reach(graph: SocialGraph, user_id: str, hops: int = 3, shown: int = 50) -> DataFrame:
    """How many users a promotion reaches, with the smallest of their ids."""
    spark = graph.vertices.sparkSession
    seed = spark.createDataFrame([(user_id,)], "seed string")
    reached = bfs_levels(graph, seed, hops).filter("level > 0")
    first = reached.orderBy("id").limit(shown).agg(
        F.array_sort(F.collect_list("id")).alias("reached_users")
    )
    return reached.agg(F.count(F.lit(1)).alias("total_reach")).withColumn(
        "reached_users", first.scalar()
    )


# Scores


def ranking(
    scores: DataFrame, users: DataFrame, limit: int, name: str = "score", digits: int = 4
) -> DataFrame:
    """Top list of a score with user names and the best score on every row."""
    order = [F.desc(name), F.asc("id")]
    top = _top(scores.select("id", F.round("score", digits).alias(name)), limit, *order)
    named = ranked(top.join(users.select("id", "username"), "id"), *order)
    best = F.first(name).over(Window.orderBy("rank"))
    return named.withColumn("max_score", best).withColumnRenamed("id", "user_id")


def influencers(scores: DataFrame, users: DataFrame, limit: int = 10) -> DataFrame:
    return ranking(scores, users, limit)


def brokers(scores: DataFrame, users: DataFrame, limit: int = 10) -> DataFrame:
    return ranking(scores, users, limit, "betweenness_score").drop("max_score")


# Communities


def community_sizes(communities: DataFrame) -> DataFrame:
    return communities.groupBy("community").agg(F.count(F.lit(1)).alias("size"))


def communities_with_size(communities: DataFrame) -> DataFrame:
    """Every member with its community and the community's size.

    A row per member instead of one list per community: a community may hold a
    third of all users, which no single row can carry.
    """
    sizes = community_sizes(communities)
    return communities.join(sizes, "community").withColumnRenamed("id", "user_id")


def community_totals(communities: DataFrame, min_size: int = 2) -> DataFrame:
    """Number of communities, and number and members of those below ``min_size``."""
    niche = F.col("size") < min_size
    return community_sizes(communities).agg(
        F.count(F.lit(1)).alias("total_communities"),
        F.count(F.when(niche, 1)).alias("niches_count"),
        F.coalesce(F.sum(F.when(niche, F.col("size"))), F.lit(0)).alias("niches_total_members"),
    )


def community_summary(communities: DataFrame, min_size: int = 2, sample: int = 10) -> DataFrame:
    """Communities of at least ``min_size`` with a few members, and the totals.

    The sample is cut before its shuffle, so no task sees a whole community.
    """
    totals = community_totals(communities, min_size).select(F.struct("*")).scalar()
    place = F.row_number().over(Window.partitionBy("community").orderBy("id"))
    shown = (
        communities.withColumn("place", place).filter(F.col("place") <= sample)
        .groupBy("community").agg(F.array_sort(F.collect_list("id")).alias("sample_users"))
    )
    return (
        community_sizes(communities).filter(F.col("size") >= min_size)
        .join(shown, "community")
        .withColumn("totals", totals)
        .select("community", "size", "sample_users", "totals.*")
        .orderBy(F.desc("size"), "community")
    )


def community_tiles(communities: DataFrame, min_size: int = 2, tiles: int = 3) -> DataFrame:
    """The largest communities and one tile for all niches together."""
    sizes = community_sizes(communities)
    order = [F.desc("size"), F.asc("community")]
    large = ranked(_top(sizes.filter(F.col("size") >= min_size), tiles, *order), *order).select(
        F.concat(F.lit("Grupo "), F.col("community")).alias("label"), "size",
        F.lit(False).alias("is_niche"), "rank",
    )
    niches = (
        sizes.filter(F.col("size") < min_size)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
        .filter("n > 0")
        .select(
            F.concat(F.lit("+"), F.col("n").cast("string"), F.lit(" nichos")).alias("label"), "size",
            F.lit(True).alias("is_niche"), F.lit(tiles + 1).alias("rank"),
        )
    )
    return large.unionByName(niches).orderBy("rank")


def vip_shares(attendance: DataFrame, least: float = 0.8) -> DataFrame:
    """Users who mostly attend as VIP, with their share of VIP attendances."""
    vip = F.coalesce((F.col("ticket_tier") == "vip").cast("double"), F.lit(0.0))
    return (
        attendance.groupBy("user_id")
        .agg(F.avg(vip).alias("vip_ratio"), F.count(F.lit(1)).alias("total_attendances"))
        .filter(F.col("vip_ratio") >= least)
    )


def vip_subgroup_members(attendance: DataFrame, communities: DataFrame, least: float = 0.8) -> DataFrame:
    return vip_shares(attendance, least).join(
        communities.withColumnRenamed("id", "user_id"), "user_id"
    )


def vip_subgroups(attendance: DataFrame, communities: DataFrame, least: float = 0.8) -> DataFrame:
    """Per community: VIP users, and the mean of their VIP shares."""
    return (
        vip_subgroup_members(attendance, communities, least)
        .groupBy("community")
        .agg(F.round(F.avg("vip_ratio"), 3).alias("avg_vip_ratio"), F.count(F.lit(1)).alias("size"))
        .orderBy(F.desc("size"), F.desc("avg_vip_ratio"), "community")
    )


def multi_community_users(
    graph: SocialGraph, communities: DataFrame, limit: int | None = TOP
) -> DataFrame:
    """Communities among a user's neighbours, in total and other than the own.

    Communities travel along the edges, which stay where they are.
    """
    sent = graph.along_edges(
        communities.select("id", "community"), "to", F.col("community").alias("touched"), rows=graph.vertex_count
    )
    touched = (
        sent.groupBy(F.col("to").alias("id"), "touched").count()
        .join(communities, "id")
        .groupBy("id", "community")
        .agg(
            F.count(F.lit(1)).alias("total_communities_touched"),
            F.count(F.when(F.col("touched") != F.col("community"), 1)).alias(
                "external_communities_touched"
            ),
        )
        .withColumnRenamed("id", "user_id")
    )
    return _top(
        touched, limit, F.desc("external_communities_touched"),
        F.desc("total_communities_touched"), "user_id",
    )
