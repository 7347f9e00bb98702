"""Pairing and ties, with and without blocks."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tieweave.operators.pairs import gather_groups, pairs_in_group
from tieweave.operators.ties import conoce_a, conoce_a_incremental, social_ties
from tieweave.plans import catalog, registry  # noqa: F401


def bookings(spark, seed=1, people=40, hot=True):
    rng = random.Random(seed)
    events = [f"e{i}" for i in range(8)]
    went = {
        (f"u{p:02d}", e, rng.choice(["vip", "general", None]))
        for p in range(people) for e in events if rng.random() < (0.9 if hot and e == "e0" else 0.2)
    }
    booked = [
        (f"u{rng.randrange(people):02d}", f"t{rng.randrange(4)}", rng.choice(events)) for _ in range(60)
    ]
    dates = [(e, f"2024-01-{i + 1:02d}") for i, e in enumerate(events)]
    return (
        spark.createDataFrame(sorted(went, key=str), "user_id string, event_id string, ticket_tier string"),
        spark.createDataFrame(dates, "id string, event_date string").withColumn(
            "event_date", F.col("event_date").cast("date")
        ),
        spark.createDataFrame(booked, "user_id string, table_id string, event_id string"),
    )


@pytest.mark.parametrize("block_rows", [2000, 7, 1])
def test_each_pair_once_whatever_the_block_size(spark, block_rows):
    members = [("hot", f"u{i:02d}", i) for i in range(25)] + [("cold", "a", 1), ("cold", "b", 2)]
    members += [(None, "x", 0), (None, "y", 0)]
    df = spark.createDataFrame(members, "grp string, who string, n int")
    found = pairs_in_group(df, ["grp"], "who", ("n",), block_rows).collect()
    expected = {
        (g1, a, b, n, m) for (g1, a, n), (g2, b, m) in itertools.product(members, members)
        if g1 is not None and g1 == g2 and a < b
    }
    rows = [(r["grp"], r["user_1"], r["user_2"], r["n_1"], r["n_2"]) for r in found]
    assert len(rows) == len(set(rows)) and set(rows) == expected


def test_large_group_is_spread_over_cells(spark):
    df = spark.range(1000).select(F.lit("hot").alias("grp"), F.col("id").cast("string").alias("who"))
    groups = gather_groups(df, ["grp"], "who", 100)
    sizes = groups.placed().groupBy("block").count().collect()
    assert len(sizes) == 10 and max(row["count"] for row in sizes) < 200
    assert gather_groups(df, ["grp"], "who", 1000).large is None


@pytest.mark.parametrize("block_rows", [2000, 5])
def test_conoce_a_counts(spark, block_rows):
    attendance, events, reservations = bookings(spark)
    dates = {row["id"]: row["event_date"] for row in events.collect()}
    went, booked = {}, {}
    for row in attendance.collect():
        went.setdefault(row["user_id"], {}).setdefault(row["event_id"], set()).add(row["ticket_tier"])
    for row in reservations.collect():
        booked.setdefault(row["user_id"], []).append(row["event_id"])
    expected = {}
    for a, b in itertools.combinations(sorted(went), 2):
        both = went[a].keys() & went[b].keys()
        if both:
            vip = sum("vip" in went[a][e] and "vip" in went[b][e] for e in both)
            res = sum(x == y for x in booked.get(a, []) for y in booked.get(b, []))
            days = [dates[e] for e in both]
            expected[a, b] = (len(both), vip, res, min(days), max(days), len(both) + vip / 2 + res * 0.75)
    columns = [
        "shared_events", "shared_vip_events", "shared_reservations", "first_shared_event",
        "last_shared_event", "tie_strength",
    ]
    found = {
        (r["user_1"], r["user_2"]): tuple(r[c] for c in columns)
        for r in conoce_a(attendance, events, reservations, block_rows).collect()
    }
    assert found == expected


def test_no_attendance_gives_no_ties(spark):
    attendance, events, reservations = bookings(spark)
    assert conoce_a(attendance.limit(0), events, reservations).count() == 0
    assert conoce_a(attendance, events, None).filter("shared_reservations > 0").count() == 0


@pytest.mark.parametrize("block_rows", [2000, 5])
def test_incremental_equals_full(spark, block_rows):
    attendance, events, reservations = bookings(spark)
    before = attendance.filter("NOT (user_id = 'u03' AND event_id = 'e0') AND user_id <> 'u11'")
    old = conoce_a(before, events, reservations)
    touched = spark.createDataFrame([("u03",), ("u11",), ("u11",)], "user_id string")
    updated = conoce_a_incremental(old, touched, attendance, events, reservations, block_rows)
    full = conoce_a(attendance, events, reservations)
    assert sorted(map(tuple, updated.collect())) == sorted(map(tuple, full.select(*updated.columns).collect()))


def test_touched_users_are_found_once_and_joined_by_merging(spark):
    made = registry.run("conoce_a_incremental", spark, SMALL)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    physical = made._jdf.queryExecution().executedPlan().toString()
    assert "touched-" in physical and "o_orderstatus" not in plan
    # The ties and the touched, once each; then the ties stay there.
    assert physical.count("Exchange hashpartitioning(user_2") == 2, physical
    joins = [line for line in plan.splitlines() if "Join Left" in line and "user_" in line]
    assert len(joins) >= 4 and all("strategy=merge" in line for line in joins), plan
    assert sorted(map(tuple, made.collect())) == sorted(
        map(tuple, registry.run("conoce_a", spark, SMALL).select(*made.columns).collect())
    )


def test_social_tie_weights(spark):
    edge = lambda rows: spark.createDataFrame(rows, "event_id long, user_id long")
    days = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-02-02")], "event_id long, event_date string")
    both = edge([(1, 10), (1, 9), (1, 9)])
    ties = social_ties(edge([(2, 9), (2, 10), (None, 9)]), both, both, days).collect()
    assert len(ties) == 1
    row = ties[0]
    assert (row["user_1_id"], row["user_2_id"]) == (9, 10)
    assert (row["shared_attendances"], row["shared_purchases"], row["shared_reservations"]) == (1, 1, 1)
    assert row["tie_strength"] == 2.0
    assert (row["first_shared_event"], row["last_shared_event"]) == ("2024-01-01", "2024-02-02")


@pytest.mark.parametrize("block_rows", [2000, 400])
def test_pairs_are_dealt_by_their_number_not_by_the_bytes_of_members(spark, block_rows):
    rows = spark.range(3000).select(
        (F.col("id") % 3).cast("string").alias("grp"), F.concat(F.lit("u"), F.col("id").cast("string")).alias("who")
    )
    groups = gather_groups(rows, ["grp"], "who", block_rows)
    assert groups.parts == 4  # of the session's cores; 1.5 million pairs
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = pairs_in_group(rows, ["grp"], "who", (), block_rows)
        tasks = found.select(F.spark_partition_id().alias("task")).distinct().count()
        assert found.count() == 3 * 1000 * 999 // 2
        assert tasks >= (3 if block_rows == 400 else 2)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_pair_count_beyond_the_cores_gets_more_tasks(spark, monkeypatch):
    from tieweave.operators import pairs

    monkeypatch.setattr(pairs, "TASK_PAIRS", 1000)
    rows = spark.range(300).select(F.lit("a").alias("grp"), F.col("id").cast("string").alias("who"))
    groups = gather_groups(rows.unionByName(rows.withColumn("grp", F.lit("b"))), ["grp"], "who", 50)
    assert groups.parts == 90  # 2 * 300 * 299 / 2 pairs, 1000 to a task


@pytest.mark.parametrize("block_rows", [2000, 5])
def test_sums_over_pairs_are_dealt_by_the_counted_pairs(spark, monkeypatch, block_rows):
    from tieweave.operators import pairs

    monkeypatch.setattr(pairs, "TASK_PAIRS", 100)
    attendance, events, reservations = bookings(spark)
    ties = conoce_a(attendance, events, reservations, block_rows)
    plan = ties._jdf.queryExecution().optimizedPlan().toString()
    members = [row["n"] for frame in (attendance, reservations) for row in frame.dropna(subset=["user_id", "event_id"])
               .select("event_id", "user_id").distinct().groupBy("event_id").agg(F.count("*").alias("n")).collect()]
    parts = max(1, -(-sum(n * (n - 1) // 2 for n in members) // 100))
    assert parts > 2 and f"RepartitionByExpression [user_1" in plan and f", {parts}" in plan
    assert ties.count() == conoce_a(attendance, events, reservations).count()


@pytest.mark.parametrize("block_rows", [2000, 3])
def test_ties_travel_as_lists_and_repeated_events_count(spark, block_rows):
    went = [("a", "e"), ("b", "e"), ("b", "e"), ("c", "e"), ("d", "f"), ("e", "f"), ("a", "gone"), (None, "e"), ("a", None)]
    booked = [("a", "e"), ("a", "e"), ("b", "e"), ("d", "e"), ("a", "gone"), ("c", "gone"), ("d", "f")]
    days = [("e", "2024-01-01"), ("e", "2024-01-03"), ("f", None), (None, "2024-01-09")]
    attendance = spark.createDataFrame([(*row, "vip") for row in went], "user_id string, event_id string, ticket_tier string")
    events = spark.createDataFrame(days, "id string, event_date string").select("id", F.col("event_date").cast("date"))
    ties = conoce_a(attendance, events, spark.createDataFrame(booked, "user_id string, event_id string"), block_rows)
    dates = lambda r: [str(r[c])[:10] for c in ("first_shared_event", "last_shared_event")]
    assert {(r["user_1"], r["user_2"]): (
        r["shared_events"], r["shared_vip_events"], r["shared_reservations"], r["tie_strength"], *dates(r)
    ) for r in ties.collect()} == {
        # Two events of one id are met in four ways.
        ("a", "b"): (4, 4, 2, 7.5, "2024-01-01", "2024-01-03"), ("a", "c"): (4, 4, 1, 6.75, "2024-01-01", "2024-01-03"),
        ("b", "c"): (4, 4, 0, 6.0, "2024-01-01", "2024-01-03"), ("d", "e"): (1, 1, 0, 1.5, "None", "None"),
    }
    # A pair is made after the shuffle, from the list of its first end.
    plan = ties._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate inline") < plan.index("RepartitionByExpression [user_1") and "user_id" not in (
        plan[plan.index("RepartitionByExpression [user_1"):].splitlines()[0]
    )
