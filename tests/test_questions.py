"""Questions on small tables with known answers."""

import itertools
from collections import Counter

import pytest

from tieweave.graph.social import project_graph
from tieweave.operators import pairs as operator_pairs
from tieweave.plans import questions as ask


def people(spark, names):
    return spark.createDataFrame([(n, f"name {n}") for n in names], "id string, username string")


def ties_of(spark, *pairs):
    rows = [(a, b, 1, 0, 0, 1.0) for a, b in pairs]
    return spark.createDataFrame(
        rows, "user_1 string, user_2 string, shared_events long, shared_vip_events long, "
        "shared_reservations long, tie_strength double",
    )


def test_reach_per_hop(spark):
    """132, 178 and 29 new users on three hops, of 360 in all."""
    near = [f"a{i:03d}" for i in range(132)]
    mid = [f"b{i:03d}" for i in range(178)]
    far = [f"c{i:03d}" for i in range(29)]
    rest = [f"d{i:03d}" for i in range(19)] + ["e"]
    pairs = [("X", a) for a in near] + list(zip(itertools.cycle(near), mid)) + list(zip(mid, far)) + [(far[0], "e")]
    users = people(spark, ["X", *near, *mid, *far, *rest])
    graph = project_graph(users, ties_of(spark, *pairs), block_rows=50)
    row = ask.promo_reach(graph, users, spark.createDataFrame([("X",)], "seed string")).first()
    assert [row["hop1"], row["hop2"], row["hop3"]] == [132, 178, 29]
    assert (row["total_users"], row["total_reach"], row["reach_percentage"]) == (360, 339, 94.17)
    shown = ask.indirect_reach(graph, "X").first()
    assert shown["total_reach"] == 339 and shown["reached_users"] == sorted(near)[:50]
    nobody = ask.indirect_reach(graph, "unknown").first()
    assert (nobody["total_reach"], nobody["reached_users"]) == (0, [])


def test_communities_in_summary(spark):
    rows = [(f"u{i:03d}", "big") for i in range(98)] + [("x", "x"), ("y", "y")]
    given = spark.createDataFrame(rows, "id string, community string")
    totals = ask.community_totals(given).first()
    assert tuple(totals) == (3, 2, 2)
    summary = ask.community_summary(given).collect()
    assert len(summary) == 1 and summary[0]["size"] == 98 and summary[0]["total_communities"] == 3
    assert summary[0]["sample_users"] == [f"u{i:03d}" for i in range(10)]
    tiles = [tuple(r) for r in ask.community_tiles(given).select("label", "size", "is_niche").collect()]
    assert tiles == [("Grupo big", 98, False), ("+2 nichos", 2, True)]
    everyone = ask.communities_with_size(given)
    assert everyone.count() == 100 and everyone.filter("size = 98").count() == 98


def test_ranked_scores(spark):
    scores = spark.createDataFrame([("a", 2.36), ("b", 2.38), ("c", 0.15)], "id string, score double")
    top = ask.influencers(scores, people(spark, "abc"), 2).orderBy("rank").collect()
    assert [(r["rank"], r["user_id"], r["score"], r["max_score"]) for r in top] == [
        (1, "b", 2.38, 2.38), (2, "a", 2.36, 2.38)
    ]


def test_counts_without_ties(spark):
    users, none = people(spark, "ab"), ties_of(spark)
    assert tuple(ask.density(users, none).first()) == (2, 0, 0.0, 0.0)
    assert ask.density(people(spark, "a"), none).first()["density"] is None
    assert [r["user_id"] for r in ask.isolated_users(users, none).collect()] == ["a", "b"]
    counts = ask.graph_counts(users, users, users, ties_of(spark, ("a", "b"))).first()
    assert (counts["users"], counts["edges"], counts["edges_two_way"]) == (2, 1, 2)


def test_recommendation_and_relative_score(spark):
    users = people(spark, "abc")
    graph = project_graph(users, ties_of(spark, ("a", "b"), ("a", "c")))
    went = spark.createDataFrame(
        [("a", "e1"), ("b", "e1"), ("b", "e2"), ("c", "e2"), ("c", "e3"), ("c", "e3")],
        "user_id string, event_id string",
    )
    events = spark.createDataFrame([("e1", "one"), ("e2", "two"), ("e3", "three")], "id string, name string")
    best = ask.event_recommendation(graph, went, events, "a").orderBy("rank").collect()
    assert [(r["event_id"], r["score"], r["friends_attended"], r["relative_score"]) for r in best] == [
        ("e2", 2.0, 2, 1.0), ("e3", 1.0, 1, 0.5)
    ]
    assert ask.event_recommendation(graph, went, events, "unknown").count() == 0
    everyone = ask.event_recommendation_all(graph, went, events).collect()
    assert {(r["user_id"], r["event_id"], r["rank"]) for r in everyone} == {
        ("a", "e2", 1), ("a", "e3", 2), ("c", "e1", 1)
    }


def test_null_table_types_never_match(spark):
    ties = ties_of(spark, ("a", "b"))
    booked = spark.createDataFrame(
        [("a", "t1", "e"), ("b", "t2", "e"), ("a", "t3", "e"), ("b", "t3", "e")],
        "user_id string, table_id string, event_id string",
    )
    tables = spark.createDataFrame(
        [("t1", None, None, 4), ("t2", None, None, 4), ("t3", "vip", True, None)],
        "id string, table_type string, is_vip boolean, capacity int",
    )
    assert [tuple(r) for r in ask.same_table_type(ties, booked, tables).collect()] == [("a", "b", "vip", 1)]
    assert [tuple(r) for r in ask.same_vip_table(ties, booked, tables).collect()] == [("a", "b", True, None, 1)]


@pytest.mark.parametrize("most", [1, 500_000])
def test_pairs_at_tables_and_ties_are_shuffled_once(spark, monkeypatch, most):
    monkeypatch.setattr(operator_pairs, "TASK_PAIRS", most)
    names = [f"u{k:02d}" for k in range(12)]
    ties = ties_of(spark, *[pair for k, pair in enumerate(itertools.combinations(names, 2)) if k % 3])
    booked = spark.createDataFrame(
        [(u, f"t{(i + k) % 3}", f"e{k}") for i, u in enumerate(names) for k in range(2)],
        "user_id string, table_id string, event_id string",
    )
    tables = spark.createDataFrame(
        [("t0", "vip", True, 4), ("t1", "regular", False, 4), ("t2", "vip", True, 6)],
        "id string, table_type string, is_vip boolean, capacity int",
    )
    kinds = {t["id"]: t for t in tables.collect()}
    at = [(r["user_id"], r["event_id"], kinds[r["table_id"]]) for r in booked.collect()]
    tied = {(r["user_1"], r["user_2"]) for r in ties.collect()}
    met = [(u, v, a, b) for u, e, a in at for v, f, b in at if e == f and (u, v) in tied]
    vip = Counter((u, v, a["is_vip"], a["capacity"]) for u, v, a, b in met if a["is_vip"] == b["is_vip"])
    kind = Counter((u, v, a["table_type"]) for u, v, a, b in met if a["table_type"] == b["table_type"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for question, wanted in ((ask.same_vip_table, vip), (ask.same_table_type, kind)):
            found = question(ties, booked, tables, None)
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning(user_1") == 2, plan
            assert sorted(map(tuple, found.collect())) == sorted((*pair, n) for pair, n in wanted.items())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_first_meetings_on_one_date(spark):
    """Two shared events on the first date: by order one counts, by date both."""
    went = spark.createDataFrame(
        [(u, e) for u in "ab" for e in ("e1", "e2", "e3")], "user_id string, event_id string"
    )
    events = spark.createDataFrame(
        [("e2", "2024-01-01"), ("e1", "2024-01-01"), ("e3", "2024-01-02")], "id string, event_date string"
    )
    order = ask.new_companions_by_order(went, events).collect()
    assert [tuple(r) for r in order] == [(u, 3, 1, 1.0, 0.333) for u in "ab"]
    date = ask.new_companions_by_date(went, events).collect()
    assert [tuple(r) for r in date] == [(u, 3, 2, 1.0, 0.667) for u in "ab"]


def test_user_lists(spark):
    users = people(spark, ["b2", "a1"])
    assert [r["id"] for r in ask.list_users(users, 1).collect()] == ["a1"]
    assert [r["id"] for r in ask.search_users(users, " NAME A").collect()] == ["a1"]
    assert ask.search_users(users, "2").count() == 1
