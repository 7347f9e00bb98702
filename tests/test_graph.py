"""Graph jobs against plain Python on small graphs."""

import heapq
import itertools
import random
import re
from collections import defaultdict

import pytest

from tieweave.graph.betweenness import betweenness
from tieweave.graph.communities import louvain, modularity
from tieweave.graph.pagerank import pagerank
from tieweave.graph.social import project_graph
from tieweave.graph.walks import bfs_levels, reach_of_all, shortest_path
from tieweave.plans import questions


def random_ties(people, chance, seed, weights=(1.0, 1.25, 1.5, 2.0, 2.75)):
    rng = random.Random(seed)
    names = [f"u{i:02d}" for i in range(people)]
    ties = [
        (a, b, rng.choice(weights))
        for a, b in itertools.combinations(names, 2) if rng.random() < chance
    ]
    return names, ties


def make_graph(spark, names, ties, block_rows=2000):
    users = spark.createDataFrame([(name, name.upper()) for name in names], "id string, username string")
    edges = spark.createDataFrame(ties, "user_1 string, user_2 string, tie_strength double")
    return project_graph(users, edges, block_rows=block_rows), users, edges


def adjacency(ties):
    near = defaultdict(dict)
    for a, b, w in ties:
        near[a][b] = near[b][a] = w
    return near


def brute_betweenness(names, near, weighted):
    """All cheapest paths between all pairs, listed one by one."""
    score = dict.fromkeys(names, 0.0)
    for source in names:
        cost, order, heap = {}, [], [(0, source)]
        paths, before = defaultdict(float), defaultdict(list)
        best = {source: 0}
        paths[source] = 1.0
        while heap:
            at, v = heapq.heappop(heap)
            if v in cost:
                continue
            cost[v] = at
            order.append(v)
            for u, w in near[v].items():
                there = at + (w if weighted else 1)
                if there < best.get(u, float("inf")):
                    best[u], paths[u], before[u] = there, 0.0, []
                    heapq.heappush(heap, (there, u))
                if there == best[u] and u not in cost:
                    paths[u] += paths[v]
                    before[u].append(v)
        share = defaultdict(float)
        for v in reversed(order):
            for u in before[v]:
                share[u] += paths[u] / paths[v] * (1 + share[v])
            if v != source:
                score[v] += share[v]
    return {name: value / 2 for name, value in score.items()}


@pytest.mark.parametrize(
    "weighted, block_rows, rows", [(True, 2000, 1000), (True, 3, 0), (False, 2000, 1000)]
)
def test_betweenness_matches_brute_force(spark, monkeypatch, weighted, block_rows, rows):
    monkeypatch.setattr("tieweave.session.BROADCAST_ROWS", rows)
    names, ties = random_ties(18, 0.22, seed=5)
    graph, _, _ = make_graph(spark, names, ties, block_rows)
    expected = brute_betweenness(names, adjacency(ties), weighted)
    found = {row["id"]: row["score"] for row in betweenness(graph, weighted, batch_rows=200).collect()}
    assert found == pytest.approx(expected, abs=1e-9)


def test_betweenness_of_a_path_and_of_nothing(spark):
    names = ["a", "b", "c", "d"]
    graph, users, _ = make_graph(spark, names, [("a", "b", 1.0), ("b", "c", 1.0)])
    assert {r["id"]: r["score"] for r in betweenness(graph).collect()} == {
        "a": 0.0, "b": 1.0, "c": 0.0, "d": 0.0
    }
    top = questions.brokers(betweenness(graph), users, 2).orderBy("rank").collect()
    assert [(r["rank"], r["user_id"], r["betweenness_score"]) for r in top] == [(1, "b", 1.0), (2, "a", 0.0)]
    empty, _, _ = make_graph(spark, names, [])
    assert [r["score"] for r in betweenness(empty).collect()] == [0.0] * 4


@pytest.mark.parametrize("block_rows", [2000, 2])
def test_pagerank_matches_plain_loop(spark, block_rows):
    names, ties = random_ties(20, 0.15, seed=3)
    near = adjacency(ties)
    graph, _, _ = make_graph(spark, names, ties, block_rows)
    score = {name: 0.15 for name in names}
    for _ in range(20):
        score = {
            v: 0.15 + 0.85 * sum(score[u] * w / sum(near[u].values()) for u, w in near[v].items())
            for v in names
        }
    found = {row["id"]: row["score"] for row in pagerank(graph).collect()}
    assert found == pytest.approx(score, abs=1e-9)


def test_pagerank_without_broadcast(spark, monkeypatch):
    names, ties = random_ties(20, 0.2, seed=9)
    graph, _, _ = make_graph(spark, names, ties, 2)
    small = {row["id"]: row["score"] for row in pagerank(graph).collect()}
    for module in ("tieweave.graph.social", "tieweave.session"):
        monkeypatch.setattr(f"{module}.BROADCAST_ROWS", 0)
    large = {row["id"]: row["score"] for row in pagerank(graph).collect()}
    assert large == pytest.approx(small, abs=1e-9)


def test_a_large_state_leaves_the_edges_where_they_are(spark, monkeypatch):
    for module in ("tieweave.graph.social", "tieweave.session"):
        monkeypatch.setattr(f"{module}.BROADCAST_ROWS", 0)
    names, ties = random_ties(20, 0.2, seed=9)
    graph, users, _ = make_graph(spark, names, ties, 2000)
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = graph.along_edges(users.select("id"), "id", "to", rows=10**9)
        plan = moved._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    joined = plan.split("InMemoryRelation")[0]
    assert "SortMergeJoin" in joined and joined.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("rows", [1_000_000, 0])
@pytest.mark.parametrize("block_rows", [2000, 2])
def test_walks_match_plain_search(spark, monkeypatch, rows, block_rows):
    for module in ("tieweave.graph.social", "tieweave.session"):
        monkeypatch.setattr(f"{module}.BROADCAST_ROWS", rows)
    names, ties = random_ties(24, 0.09, seed=11)
    near = adjacency(ties)
    graph, users, _ = make_graph(spark, names, ties, block_rows)
    seeds = spark.createDataFrame([("u00",), ("u07",), ("nobody",)], "seed string")
    expected = set()
    for seed in ("u00", "u07"):
        level, seen = [seed], {seed: 0}
        for depth in range(1, 4):
            level = sorted({u for v in level for u in near[v]} - set(seen))
            seen.update(dict.fromkeys(level, depth))
        expected |= {(seed, v, d) for v, d in seen.items()}
    assert {tuple(row) for row in bfs_levels(graph, seeds, 3).collect()} == expected
    reach = {r["user_id"]: r for r in questions.promo_reach(graph, users, seeds).collect()}
    hops = [sum(1 for s, _, d in expected if s == "u00" and d == hop) for hop in (1, 2, 3)]
    assert [reach["u00"][f"hop{hop}"] for hop in (1, 2, 3)] == hops
    assert reach["u00"]["reach_percentage"] == round(sum(hops) / 24 * 100, 2)
    assert "nobody" not in reach
    whole = {r["user_id"]: r for r in questions.promo_reach_all(graph, users).collect()}
    assert len(whole) == 24 and whole["u00"] == reach["u00"] and whole["u07"] == reach["u07"]


@pytest.mark.parametrize("rows", [0, 1_000_000])
def test_reach_of_everybody_and_paths_against_plain_walks(spark, monkeypatch, rows):
    for module in ("tieweave.graph.social", "tieweave.session"):
        monkeypatch.setattr(f"{module}.BROADCAST_ROWS", rows)
    names, ties = random_ties(150, 0.013, seed=5)
    near = adjacency(ties)
    graph, users, _ = make_graph(spark, names, ties, 10_000)
    made = {r["id"]: r for r in reach_of_all(graph, 4).collect()}
    paths = {}
    for name in names:
        level, seen = {name: [name]}, {name}
        counts = []
        while level and len(counts) < 30:
            if name == names[3]:
                paths |= level
            step = {}
            for v, path in level.items():
                for u in near[v]:
                    if u not in seen:
                        step[u] = min(step.get(u, [*path, u]), [*path, u])
            seen |= set(step)
            counts.append(len(step))
            level = step
        counts += [0] * 4
        assert [made[name][f"hop{hop}"] for hop in (1, 2, 3, 4)] == counts[:4]
    assert len(made) == len(names)
    for target in [*names[::31], max(paths, key=lambda v: len(paths[v]))]:
        row = shortest_path(graph, names[3], target).first()
        assert (row["path"] if row else None) == paths.get(target)


def test_reach_without_ties_and_without_users(spark):
    graph, users, _ = make_graph(spark, ["a", "b"], [])
    made = questions.promo_reach_all(graph, users).collect()
    assert [(r["hop1"], r["hop3"], r["total_users"], r["reach_percentage"]) for r in made] == [(0, 0, 2, 0.0)] * 2


def test_shortest_path_is_the_smallest_of_the_shortest(spark):
    ties = [("a", "c", 1.0), ("a", "b", 1.0), ("b", "z", 1.0), ("c", "z", 1.0), ("z", "y", 1.0)]
    graph, _, _ = make_graph(spark, ["a", "b", "c", "y", "z", "x"], ties)
    row = shortest_path(graph, "a", "y").first()
    assert (row["path"], row["distance"]) == (["a", "b", "z", "y"], 3)
    assert shortest_path(graph, "a", "a").first()["distance"] == 0
    assert shortest_path(graph, "a", "x").first() is None
    assert shortest_path(graph, "a", "unknown").first() is None


def circles(count, size):
    """Dense circles, each tied to the next by one tie."""
    names = [f"{c}{i}" for c in "abcdefgh"[:count] for i in range(size)]
    ties = [
        (a, b, 1.0) for c in "abcdefgh"[:count]
        for a, b in itertools.combinations([f"{c}{i}" for i in range(size)], 2)
    ]
    links = [(f"{x}0", f"{y}1", 1.0) for x, y in itertools.pairwise("abcdefgh"[:count])]
    return names, ties + links


def plain_modularity(ties, label):
    degree, inside = defaultdict(int), 0
    for a, b, _ in ties:
        degree[a] += 1
        degree[b] += 1
        inside += label[a] == label[b]
    totals = defaultdict(int)
    for v, k in degree.items():
        totals[label[v]] += k
    m = len(ties)
    return inside / m - sum((k / (2 * m)) ** 2 for k in totals.values())


@pytest.mark.parametrize("patience", [200, 0])
@pytest.mark.parametrize("rows, block_rows", [(1_000_000, 2000), (0, 2)])
def test_louvain_finds_circles(spark, monkeypatch, rows, block_rows, patience):
    monkeypatch.setattr("tieweave.session.BROADCAST_ROWS", rows)
    names, ties = circles(4, 6)
    graph, _, _ = make_graph(spark, [*names, "loner"], ties, block_rows)
    found = {row["id"]: row["community"] for row in louvain(graph, patience).collect()}
    assert found["loner"] == "loner"
    assert {name: found[name] for name in names} == {name: name[0] + "0" for name in names}


@pytest.mark.parametrize("patience", [200, 0])
def test_louvain_ends_where_no_community_gains_by_joining(spark, monkeypatch, patience):
    names, ties = random_ties(40, 0.15, seed=6)
    label = None
    for rows in (1_000_000, 0):
        monkeypatch.setattr("tieweave.session.BROADCAST_ROWS", rows)
        graph, _, _ = make_graph(spark, names, ties)
        found = {row["id"]: row["community"] for row in louvain(graph, patience).collect()}
        assert label in (None, found)
        label = found
    reached = plain_modularity(ties, label)
    for a, b in itertools.combinations(sorted(set(label.values())), 2):
        joined = {v: a if c == b else c for v, c in label.items()}
        assert plain_modularity(ties, joined) <= reached + 1e-12


def label_propagation(names, near, rounds=10):
    label = {name: name for name in names}
    for _ in range(rounds):
        nxt = {}
        for v in names:
            votes = defaultdict(int)
            for u in near[v]:
                votes[label[u]] += 1
            nxt[v] = min(votes, key=lambda c: (-votes[c], c)) if votes else label[v]
        label = nxt
    return label


def test_a_round_of_a_small_state_reads_the_edges_once(spark):
    from tieweave.graph import communities as made

    edges = spark.createDataFrame([(1, 2, 1), (2, 1, 1)], "src long, dst long, weight long").persist()
    state = spark.createDataFrame(
        [(1, 1, 1, 1, False, True), (2, 1, 2, 2, False, False)],
        "id long, k long, community long, was long, wish boolean, moved boolean",
    )
    wishes = made._wishes(made._Level(edges, state, 2, whole=False), state, 2)
    assert wishes._jdf.queryExecution().withCachedData().toString().count("InMemoryRelation") == 1
    assert [(r["id"], r["target"]) for r in wishes.collect()] == [(2, 1)]
    edges.unpersist()


def test_louvain_properties_on_shared_data(spark, small):
    found = louvain(small.graph)
    label = {row["id"]: row["community"] for row in found.collect()}
    ties = [(r["user_1"], r["user_2"], 1.0) for r in small.ties.collect()]
    everyone = {row["id"] for row in small.usuario.collect()}
    assert set(label) == everyone
    reached = modularity(small.graph, found)
    assert reached == pytest.approx(plain_modularity(ties, label), abs=1e-9)
    assert reached > plain_modularity(ties, {v: v for v in everyone})
    simple = label_propagation(sorted(everyone), adjacency(ties))
    assert reached >= plain_modularity(ties, simple)
    for name in set(label.values()):
        assert name == min(v for v, c in label.items() if c == name)
    again = {row["id"]: row["community"] for row in louvain(small.graph).collect()}
    assert again == label


def test_strangers_with_hubs_and_later_attendance(spark):
    names, ties = random_ties(16, 0.25, seed=2)
    near = adjacency(ties)
    went = spark.createDataFrame(
        [("u00", "e"), ("u01", "e"), ("u02", "f")], "user_id string, event_id string"
    )
    expected = sorted(
        (a, b, len(near[a].keys() & near[b].keys()))
        for a, b in itertools.combinations(names, 2)
        if b not in near[a] and near[a].keys() & near[b].keys() and (a, b) != ("u00", "u01")
    )
    for block_rows in (2000, 2):
        graph, _, edges = make_graph(spark, names, ties, block_rows)
        found = questions.strangers_same_circle(graph, edges, went, limit=None).collect()
        assert sorted(tuple(row) for row in found) == expected


def test_top_strangers_without_pairing_the_largest_circles(spark):
    names, ties = random_ties(24, 0.2, seed=5)
    star = names[0]
    tied = {frozenset(t[:2]) for t in ties}
    ties = ties + [(star, n, 1.0) for n in names[1:] if frozenset((star, n)) not in tied]
    near = adjacency(ties)
    expected = sorted(
        (
            (a, b, len(near[a].keys() & near[b].keys()))
            for a, b in itertools.combinations(names, 2)
            if b not in near[a] and near[a].keys() & near[b].keys()
        ),
        key=lambda row: (-row[2], row[0], row[1]),
    )
    assert expected[0][2] > 3 and expected[-1][2] == 1
    for block_rows in (10, 4):
        graph, _, edges = make_graph(spark, names, ties, block_rows)
        assert graph.hubs is not None
        for limit in (1, 5, len(expected) - 3, 500):
            found = questions.strangers_same_circle(graph, edges, limit=limit).collect()
            assert [tuple(row) for row in found] == expected[:limit]
    # The star ties everybody to everybody; without it far fewer pairs are made.
    assert questions._mutuals(graph, 0).count() == len(names) * (len(names) - 1) // 2
    assert questions._mutuals(graph, 1).count() < questions._mutuals(graph, 0).count()


def test_reach_of_everybody_in_turns_keeps_few_levels(spark, monkeypatch):
    from tieweave.graph import walks

    names, ties = random_ties(150, 0.013, seed=5)
    graph, _, _ = make_graph(spark, names, ties, 10_000)
    whole = sorted(reach_of_all(graph, 4).collect())
    kept, write = [], walks.RoundTables.write

    def watched(self, df, **measures):
        made = write(self, df, **measures)
        kept.append(sum("mask" in table.columns for table, _ in self.tables))
        return made

    monkeypatch.setattr(walks.RoundTables, "write", watched)
    # 150 vertices in 3 batches of seeds: a batch at a time.
    assert sorted(reach_of_all(graph, 4, batch_rows=150).collect()) == whole
    assert max(kept) <= 3


def test_strangers_are_dealt_by_their_number_and_known_ones_left_out_there(spark, monkeypatch):
    names, ties = random_ties(30, 0.2, seed=3)
    graph, _, edges = make_graph(spark, names, ties)
    near = adjacency(ties)
    pairs = sum(len(n) * (len(n) - 1) // 2 for n in near.values())
    monkeypatch.setattr(questions, "partitions_for", lambda spark, rows, *most: rows // 50)
    dealt = questions._mutuals(graph, 0, edges.select("user_1", "user_2"))
    counted = sum(len(near[a].keys() & near[b].keys()) for a, b in itertools.combinations(names, 2) if b not in near[a])
    assert sum(row["mutuals"] for row in dealt.collect()) == counted < pairs
    # One shuffle deals the pairs; the known ones meet them there, not in a join.
    plan = dealt._jdf.queryExecution().sparkPlan().toString().lower()
    assert "leftanti" not in plan
    assert f"hashpartitioning(user_1, user_2, {pairs // 50})" in re.sub(r"#\d+l?", "", plan)


def test_recommendations_count_arrivals_and_keep_events_listed_twice(spark, monkeypatch):
    names, ties = random_ties(12, 0.4, seed=4)
    graph, _, _ = make_graph(spark, names, ties)
    near = adjacency(ties)
    went = [(name, f"e{i % 5}") for i, name in enumerate(names)] + [(names[0], "e9")]
    events = [(f"e{i}", f"n{i}") for i in range(5)] + [("e1", "n1")]
    asked = []
    monkeypatch.setattr(questions, "partitions_for", lambda spark, rows, *most: asked.append(rows) or 3)
    tables = (
        spark.createDataFrame(went, "user_id string, event_id string"),
        spark.createDataFrame(events, "id string, name string"),
    )
    found = questions.event_recommendation_all(graph, *tables, limit=2).collect()
    expected = []
    for name in names:
        score = defaultdict(lambda: [0.0, 0])
        for friend, event in went:
            if friend in near[name] and event != "e9" and (name, event) not in went:
                score[event][0] += near[name][friend]
                score[event][1] += 1
        best = sorted(((-s, -n, e) for e, (s, n) in score.items() for _ in range(2 if e == "e1" else 1)))[:2]
        expected += [(name, e, "n" + e[1], -s, -n, i + 1) for i, (s, n, e) in enumerate(best)]
    assert sorted(map(tuple, found)) == sorted(expected)
    assert asked == [sum(len(near[name]) for name, event in went if event != "e9")]
    hubs, _, _ = make_graph(spark, names, ties, 2)
    assert hubs.hubs is not None
    assert sorted(map(tuple, questions.event_recommendation_all(hubs, *tables, limit=2).collect())) == sorted(expected)


@pytest.mark.parametrize("cut", [3, 1 << 18])
def test_walks_from_everybody_are_made_within_tasks(spark, monkeypatch, cut):
    from tieweave.graph import packed
    from tieweave.session import RoundTables

    monkeypatch.setattr(packed, "SLICE", cut)
    names, ties = random_ties(40, 0.09, seed=8)
    far, more = random_ties(70, 0.09, seed=9)
    ties += [(f"x{a}", f"x{b}", w) for a, b, w in more] + [("hub", name, 4.25) for name in names[5:]]
    names += [f"x{name}" for name in far] + ["hub", "alone"]
    graph, _, _ = make_graph(spark, names, ties, 20)
    assert graph.hubs is not None
    written, write = [], RoundTables.write
    monkeypatch.setattr(RoundTables, "write", lambda self, df, **m: written.append(df.columns) or write(self, df, **m))
    found = {row["id"]: row["score"] for row in betweenness(graph).collect()}
    assert found == pytest.approx(brute_betweenness(names, adjacency(ties), True), abs=1e-9)
    reached = {row["id"]: [row["hop1"], row["hop2"], row["hop3"]] for row in reach_of_all(graph, 3).collect()}
    seeds = spark.createDataFrame([(name,) for name in names], "seed string")
    walked = {name: [0, 0, 0] for name in names}
    for row in bfs_levels(graph, seeds, 3).filter("level > 0").groupBy("seed", "level").count().collect():
        walked[row["seed"]][row["level"] - 1] = row["count"]
    assert reached == walked
    # No table holds a row for each source and vertex, nor for each round.
    assert not any({"source", "batch"} & set(columns) for columns in written)
    assert not packed.may_be_packed(make_graph(spark, ["a", "b"], [])[0])
