"""Registered graph and booking queries.

Every query reads whole tables and has SQL that gives the same rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieweave.graph.walks import shortest_path
from tieweave.operators import prepare, ties
from tieweave.operators.edges import belongs_edges, segment_nodes
from tieweave.plans import questions as ask
from tieweave.plans.bundle import PROJECTED_KEYS, projection_bundle, projection_counts
from tieweave.plans.registry import query
from tieweave.plans.star_sql import SOCIAL_SQL, rounded
from tieweave.plans.workspace import Workspace
from tieweave.session import cut_lineage, kept_apart

# The user, and the pair of users, that single-user questions are asked about.
SOMEBODY, SOMEBODY_ELSE = "csv:1", "csv:100"


# Ties and edge derivation


@query("SELECT * FROM fx_conoce_a")
def conoce_a(w: Workspace) -> DataFrame:
    return w.derive_ties()


@query("SELECT * FROM fx_conoce_a")
def conoce_a_incremental(w: Workspace) -> DataFrame:
    """Users with an open order are the touched ones; their ties start out wrong."""
    touched = w.orders.filter("status = 'pending'").select(
        F.concat(F.lit("csv:"), F.col("user_id").cast("string")).alias("user_id")
    )
    touched = cut_lineage(touched.distinct(), "touched")
    stale = w.ties
    for end in ("user_1", "user_2"):
        hit = kept_apart(touched.select(F.col("user_id").alias(end), F.lit(1).alias("hit")))
        stale = stale.join(hit, end, "left").withColumn(
            "tie_strength", F.when(F.col("hit") == 1, 0.0).otherwise(F.col("tie_strength"))
        ).drop("hit")
    return ties.conoce_a_incremental(stale, touched, w.asistio_a, w.evento, w.reservo)


@query("""SELECT user_id, event_id, ticket_id, type_ticket_id, ticket_tier, order_id, approved_at,
       round(price_paid, 4) AS price_paid, ticket_state_id FROM fx_purchases""")
def ticket_purchase_edges(w: Workspace) -> DataFrame:
    return w.purchases().withColumn("price_paid", F.round("price_paid", 4))


@query("SELECT * FROM fx_attendances")
def attendance_edges(w: Workspace) -> DataFrame:
    return w.attendances()


@query("SELECT * FROM fx_live_reservations")
def reservation_edges(w: Workspace) -> DataFrame:
    return w.live_reservations()


@query("SELECT DISTINCT c_mktsegment AS name FROM customer WHERE c_mktsegment IS NOT NULL")
def segments(w: Workspace) -> DataFrame:
    return segment_nodes(prepare.prepare_users(w.source_tables["core.users"]))


@query("SELECT c_custkey AS user_id, c_mktsegment AS segment_name FROM customer WHERE c_mktsegment IS NOT NULL")
def segment_members(w: Workspace) -> DataFrame:
    return belongs_edges(prepare.prepare_users(w.source_tables["core.users"]))


@query("""
WITH m AS (SELECT DISTINCT a.event_id, a.user_id, d.event_date
           FROM fx_attendances a LEFT JOIN fx_day d ON d.event_id = a.event_id)
SELECT a.user_id AS user_1_id, b.user_id AS user_2_id, count(*) AS shared_count,
       min(a.event_date) AS first_shared_event, max(a.event_date) AS last_shared_event
FROM m a JOIN m b ON a.event_id = b.event_id AND a.user_id < b.user_id
GROUP BY a.user_id, b.user_id""")
def pair_counts(w: Workspace) -> DataFrame:
    return ties.pair_counts(w.attendances(), w.event_dates())


@query(SOCIAL_SQL)
def social_ties(w: Workspace) -> DataFrame:
    return ties.social_ties(w.purchases(), w.attendances(), w.live_reservations(), w.event_dates())


@query("""
WITH c AS (""" + SOCIAL_SQL + """)
SELECT 'users' AS part, count(*) AS rows FROM customer
UNION ALL SELECT 'events', count(*) FROM part
UNION ALL SELECT 'tables', count(*) FROM supplier
UNION ALL SELECT 'purchases', count(*) FROM fx_purchases
UNION ALL SELECT 'attendances', count(*) FROM fx_attendances
UNION ALL SELECT 'reservations', count(*) FROM fx_live_reservations
UNION ALL SELECT 'social_ties', count(*) FROM c""", name="projection_counts")
def _projection_counts(w: Workspace) -> DataFrame:
    return projection_counts(projection_bundle(w.spark, w.source_tables))


@query("""
WITH c AS (""" + SOCIAL_SQL + """)
SELECT 'users' AS part, CAST(c_custkey AS STRING) AS key FROM customer
UNION ALL SELECT 'events', CAST(p_partkey AS STRING) FROM part
UNION ALL SELECT 'tables', CAST(s_suppkey AS STRING) FROM supplier
UNION ALL SELECT 'purchases', CAST(ticket_id AS STRING) FROM fx_purchases
UNION ALL SELECT 'attendances', CAST(ticket_id AS STRING) FROM fx_attendances
UNION ALL SELECT 'reservations', CAST(reservation_id AS STRING) FROM fx_live_reservations
UNION ALL SELECT 'social_ties', CAST(user_1_id AS STRING) || '-' || CAST(user_2_id AS STRING) FROM c
UNION ALL SELECT DISTINCT 'segments', c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL
UNION ALL SELECT 'belongs', CAST(c_custkey AS STRING) || '-' || c_mktsegment FROM customer
WHERE c_mktsegment IS NOT NULL""", name="projection_bundle")
def _projection(w: Workspace) -> DataFrame:
    """The key of every node and edge of the projection."""
    parts = projection_bundle(w.spark, w.source_tables).named()
    key = lambda name: F.concat_ws("-", *PROJECTED_KEYS[name])
    keyed = [df.select(F.lit(name).alias("part"), key(name).alias("key")) for name, df in parts.items()]
    return reduce(DataFrame.unionByName, keyed)


# Counts, listings and ties


@query("""SELECT (SELECT count(*) FROM customer) AS users, (SELECT count(*) FROM part) AS events,
       (SELECT count(*) FROM supplier) AS tables, count(*) AS edges, 2 * count(*) AS edges_two_way
FROM fx_conoce_a""")
def graph_counts(w: Workspace) -> DataFrame:
    return ask.graph_counts(w.usuario, w.evento, w.mesa, w.ties)


@query("""
WITH n AS (SELECT 'Usuario' AS label, count(*) AS nodes FROM customer
           UNION ALL SELECT 'Evento', count(*) FROM part
           UNION ALL SELECT 'Mesa', count(*) FROM supplier
           UNION ALL SELECT 'Segmento', count(DISTINCT c_mktsegment) FROM customer)
SELECT label, nodes, CAST((SELECT sum(nodes) FROM n) AS BIGINT) AS total_nodes FROM n""")
def node_counts_by_label(w: Workspace) -> DataFrame:
    return ask.node_counts_by_label(
        Usuario=w.usuario, Evento=w.evento, Mesa=w.mesa,
        Segmento=segment_nodes(prepare.prepare_users(w.source_tables["core.users"])),
    )


@query("SELECT count(*) AS edges FROM fx_asistio_a")
def edge_count(w: Workspace) -> DataFrame:
    return ask.edge_count(w.asistio_a)


@query("""SELECT src, dst, weight FROM fx_edges""")
def project_graph(w: Workspace) -> DataFrame:
    return w.graph.edges.select("src", "dst", "weight")


@query(f"""
SELECT n AS users, m AS ties, {rounded('2 * m', 'n * (n - 1)', 4)} AS density,
       {rounded('4 * m', 'n * (n - 1)', 4)} AS density_reference
FROM (SELECT (SELECT count(*) FROM customer) AS n, (SELECT count(*) FROM fx_conoce_a) AS m) t""")
def density(w: Workspace) -> DataFrame:
    return ask.density(w.usuario, w.ties)


@query("""SELECT user_1, user_2, shared_events, shared_vip_events, shared_reservations, tie_strength
FROM fx_conoce_a ORDER BY tie_strength DESC, user_1, user_2 LIMIT 20""")
def top_ties(w: Workspace) -> DataFrame:
    return ask.top_ties(w.ties)


@query("""SELECT src AS user_id, count(*) AS degree FROM fx_edges GROUP BY src
ORDER BY degree DESC, user_id LIMIT 10""")
def degree(w: Workspace) -> DataFrame:
    return ask.degree(w.graph)


@query("SELECT id AS user_id FROM fx_usuario WHERE id NOT IN (SELECT src FROM fx_edges)")
def isolated_users(w: Workspace) -> DataFrame:
    return ask.isolated_users(w.usuario, w.ties)


@query(f"""SELECT CASE WHEN user_1 = '{SOMEBODY}' THEN user_2 ELSE user_1 END AS impacted_user,
       tie_strength, shared_events, shared_reservations
FROM fx_conoce_a WHERE '{SOMEBODY}' IN (user_1, user_2)
ORDER BY tie_strength DESC, impacted_user LIMIT 20""")
def dependency_on_user(w: Workspace) -> DataFrame:
    return ask.dependency_on_user(w.ties, SOMEBODY)


@query("SELECT id, username FROM fx_usuario ORDER BY id LIMIT 500")
def list_users(w: Workspace) -> DataFrame:
    return ask.list_users(w.usuario)


@query("""SELECT id, username FROM fx_usuario
WHERE contains(lower(id), '00012') OR contains(lower(username), '00012')""")
def search_users(w: Workspace) -> DataFrame:
    return ask.search_users(w.usuario, " 00012")


@query("""SELECT c_custkey AS user_id, c_name AS username, CAST(NULL AS BIGINT) AS telegram_id
FROM customer WHERE starts_with(c_name, 'Customer#0000001') ORDER BY c_custkey DESC LIMIT 5""")
def recent_smoke_users(w: Workspace) -> DataFrame:
    users = prepare.prepare_users(w.source_tables["core.users"])
    return ask.recent_users(users, "Customer#0000001")


# Companions


def _summary_sql(per_event: str, found: str, events: str) -> str:
    return f"""
SELECT t.user_id, t.total_events, s.n AS {events}, {rounded('s.found', 's.n', 2)} AS avg_{found},
       {rounded('s.n', 't.total_events', 3)} AS share_{events}
FROM (SELECT user_id, count(*) AS n, CAST(sum(found) AS BIGINT) AS found FROM ({per_event}) e GROUP BY user_id) s
JOIN (SELECT user_id, count(*) AS total_events FROM fx_asistio_a GROUP BY user_id) t ON t.user_id = s.user_id
ORDER BY avg_{found} DESC, share_{events} DESC, t.user_id LIMIT 20"""


MET_SQL = """
WITH p AS (SELECT a.user_id, b.user_id AS v, a.event_id, e.event_date
           FROM fx_asistio_a a JOIN fx_asistio_a b ON a.event_id = b.event_id AND a.user_id <> b.user_id
                JOIN fx_evento e ON e.id = a.event_id)"""


@query(MET_SQL + _summary_sql(
    """SELECT user_id, event_id, count(*) AS found
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id, v ORDER BY event_date, event_id) AS rn FROM p) x
       WHERE rn = 1 GROUP BY user_id, event_id""",
    "new_companions", "events_with_new_companions"))
def new_companions_by_order(w: Workspace) -> DataFrame:
    return ask.new_companions_by_order(w.asistio_a, w.evento)


@query(MET_SQL + _summary_sql(
    """SELECT user_id, event_id, count(DISTINCT v) AS found
       FROM (SELECT *, min(event_date) OVER (PARTITION BY user_id, v) AS first_date FROM p) x
       WHERE event_date = first_date GROUP BY user_id, event_id""",
    "new_companions", "events_with_new_companions"))
def new_companions_by_date(w: Workspace) -> DataFrame:
    return ask.new_companions_by_date(w.asistio_a, w.evento)


@query(MET_SQL + _summary_sql(
    """SELECT p.user_id, p.event_id, count(DISTINCT p.v) AS found
       FROM p JOIN (SELECT a.user_id AS v, min(e.event_date) AS first_date
                    FROM fx_asistio_a a JOIN fx_evento e ON e.id = a.event_id GROUP BY a.user_id) f ON f.v = p.v
       WHERE p.event_date = f.first_date GROUP BY p.user_id, p.event_id""",
    "debutants", "events_with_debutants"))
def debutants(w: Workspace) -> DataFrame:
    return ask.debutants(w.asistio_a, w.evento)


@query(f"""
WITH c AS (SELECT a.user_id, a.event_id, count(DISTINCT b.user_id) AS companions
           FROM fx_asistio_a a JOIN fx_asistio_a b ON a.event_id = b.event_id AND a.user_id <> b.user_id
           GROUP BY a.user_id, a.event_id)
SELECT user_id, count(*) AS events,
       {rounded('CAST(sum(companions) AS BIGINT)', 'count(*)', 6)} AS avg_companions,
       max(companions) AS max_companions
FROM c GROUP BY user_id ORDER BY avg_companions DESC, max_companions DESC, user_id LIMIT 20""")
def large_groups(w: Workspace) -> DataFrame:
    return ask.large_groups(w.asistio_a)


@query("""
SELECT t.user_1, t.user_2, m1.table_type, count(*) AS matches
FROM fx_conoce_a t JOIN fx_reservo r1 ON r1.user_id = t.user_1 JOIN fx_mesa m1 ON m1.id = r1.table_id
     JOIN fx_reservo r2 ON r2.user_id = t.user_2 AND r2.event_id = r1.event_id
     JOIN fx_mesa m2 ON m2.id = r2.table_id AND m2.table_type = m1.table_type
GROUP BY t.user_1, t.user_2, m1.table_type
ORDER BY matches DESC, t.user_1, t.user_2, m1.table_type LIMIT 20""")
def same_table_type(w: Workspace) -> DataFrame:
    return ask.same_table_type(w.ties, w.reservo, w.mesa)


@query("""
SELECT t.user_1, t.user_2, m1.is_vip, m1.capacity, count(*) AS matches
FROM fx_conoce_a t JOIN fx_reservo r1 ON r1.user_id = t.user_1 JOIN fx_mesa m1 ON m1.id = r1.table_id
     JOIN fx_reservo r2 ON r2.user_id = t.user_2 AND r2.event_id = r1.event_id
     JOIN fx_mesa m2 ON m2.id = r2.table_id AND m2.is_vip = m1.is_vip
GROUP BY t.user_1, t.user_2, m1.is_vip, m1.capacity
ORDER BY matches DESC, t.user_1, t.user_2, m1.is_vip, m1.capacity LIMIT 20""")
def same_vip_table(w: Workspace) -> DataFrame:
    return ask.same_vip_table(w.ties, w.reservo, w.mesa)


# Recommendations


RECOMMENDED_SQL = """
WITH c AS (
  SELECT g.src AS user_id, a.event_id, sum(g.weight) AS score, count(DISTINCT g.dst) AS friends_attended
  FROM fx_edges g JOIN fx_asistio_a a ON a.user_id = g.dst
  WHERE NOT EXISTS (SELECT 1 FROM fx_asistio_a o WHERE o.user_id = g.src AND o.event_id = a.event_id)
  GROUP BY g.src, a.event_id),
r AS (SELECT c.*, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, friends_attended DESC, event_id) AS rank FROM c)
SELECT r.user_id, r.event_id, e.name AS event_name, r.score, r.friends_attended, CAST(r.rank AS INT) AS rank"""


@query(RECOMMENDED_SQL + f""",
       round(r.score / (SELECT max(score) FROM r WHERE user_id = '{SOMEBODY}'), 4) AS relative_score
FROM r JOIN fx_evento e ON e.id = r.event_id WHERE r.user_id = '{SOMEBODY}' AND r.rank <= 10""")
def event_recommendation(w: Workspace) -> DataFrame:
    return ask.event_recommendation(w.graph, w.asistio_a, w.evento, SOMEBODY)


@query(RECOMMENDED_SQL + " FROM r JOIN fx_evento e ON e.id = r.event_id WHERE r.rank <= 10")
def event_recommendation_all(w: Workspace) -> DataFrame:
    return ask.event_recommendation_all(w.graph, w.asistio_a, w.evento)


@query(f"""
WITH t AS (SELECT user_1, user_2, tie_strength AS score FROM fx_conoce_a
           ORDER BY tie_strength DESC, user_1, user_2 LIMIT 20)
SELECT user_1, user_2, score, round(score / (SELECT max(score) FROM t), 4) AS relative_score FROM t""")
def relative_score(w: Workspace) -> DataFrame:
    top = ask.top_ties(w.ties).select("user_1", "user_2", F.col("tie_strength").alias("score"))
    return ask.relative_score(top)


@query("""
WITH h AS (SELECT a.dst AS user_1, b.dst AS user_2, count(*) AS mutuals
           FROM fx_edges a JOIN fx_edges b ON a.src = b.src AND a.dst < b.dst
           GROUP BY a.dst, b.dst)
SELECT h.* FROM h ANTI JOIN fx_conoce_a t ON t.user_1 = h.user_1 AND t.user_2 = h.user_2
ORDER BY mutuals DESC, h.user_1, h.user_2 LIMIT 20""")
def strangers_same_circle(w: Workspace) -> DataFrame:
    return ask.strangers_same_circle(w.graph, w.ties)


# Walks


WALK_SQL = f"""
WITH RECURSIVE walk(id, hop) AS (
  SELECT CAST('{SOMEBODY}' AS VARCHAR), 0
  UNION ALL
  SELECT DISTINCT g.dst, walk.hop + 1 FROM walk JOIN fx_edges g ON g.src = walk.id WHERE walk.hop < 3),
near AS (SELECT id, min(hop) AS hop FROM walk GROUP BY id)"""


@query(WALK_SQL + f"""
SELECT '{SOMEBODY}' AS user_id, (SELECT username FROM fx_usuario WHERE id = '{SOMEBODY}') AS username,
       count(*) FILTER (WHERE hop = 1) AS hop1, count(*) FILTER (WHERE hop = 2) AS hop2,
       count(*) FILTER (WHERE hop = 3) AS hop3, (SELECT count(*) FROM customer) AS total_users,
       count(*) FILTER (WHERE hop > 0) AS total_reach,
       {rounded('100 * count(*) FILTER (WHERE hop > 0)', '(SELECT count(*) FROM customer)', 2)} AS reach_percentage
FROM near""")
def promo_reach(w: Workspace) -> DataFrame:
    seeds = w.spark.createDataFrame([(SOMEBODY,)], "seed string")
    return ask.promo_reach(w.graph, w.usuario, seeds)


@query(f"""
WITH hop1 AS (SELECT DISTINCT src, dst FROM fx_edges),
hop2 AS (
  SELECT DISTINCT a.src, g.dst FROM hop1 a JOIN fx_edges g ON g.src = a.dst
  ANTI JOIN hop1 b ON b.src = a.src AND b.dst = g.dst WHERE g.dst <> a.src),
hop3 AS (
  SELECT DISTINCT a.src, g.dst FROM hop2 a JOIN fx_edges g ON g.src = a.dst
  ANTI JOIN hop1 b ON b.src = a.src AND b.dst = g.dst
  ANTI JOIN hop2 c ON c.src = a.src AND c.dst = g.dst),
counts AS (
  SELECT src, count(*) FILTER (WHERE hop = 1) AS hop1, count(*) FILTER (WHERE hop = 2) AS hop2,
         count(*) FILTER (WHERE hop = 3) AS hop3
  FROM (SELECT src, 1 AS hop FROM hop1 UNION ALL SELECT src, 2 FROM hop2 UNION ALL SELECT src, 3 FROM hop3)
  GROUP BY src),
whole AS (
  SELECT u.id AS user_id, username, coalesce(hop1, 0) AS hop1, coalesce(hop2, 0) AS hop2,
         coalesce(hop3, 0) AS hop3, (SELECT count(*) FROM customer) AS total_users
  FROM fx_usuario u LEFT JOIN counts ON counts.src = u.id)
SELECT *, hop1 + hop2 + hop3 AS total_reach,
       {rounded('100 * (hop1 + hop2 + hop3)', 'total_users', 2)} AS reach_percentage FROM whole""")
def promo_reach_all(w: Workspace) -> DataFrame:
    return ask.promo_reach_all(w.graph, w.usuario)


@query(WALK_SQL + """
SELECT (SELECT count(*) FROM near WHERE hop > 0) AS total_reach, string_agg(id, ',' ORDER BY id) AS reached_users
FROM (SELECT id FROM near WHERE hop > 0 ORDER BY id LIMIT 50) t""")
def indirect_reach(w: Workspace) -> DataFrame:
    return ask.indirect_reach(w.graph, SOMEBODY).withColumn(
        "reached_users", F.array_join("reached_users", ",")
    )


@query(f"""
WITH RECURSIVE walk(id, path, hop) AS (
  SELECT CAST('{SOMEBODY}' AS VARCHAR), ['{SOMEBODY}'], 0
  UNION ALL
  SELECT g.dst, min(list_append(walk.path, g.dst)), min(walk.hop) + 1
  FROM walk JOIN fx_edges g ON g.src = walk.id WHERE walk.hop < 6 GROUP BY g.dst)
SELECT array_to_string(path, '>') AS path, CAST(hop AS INT) AS distance FROM walk
WHERE id = '{SOMEBODY_ELSE}' ORDER BY hop LIMIT 1""", name="shortest_path")
def _shortest_path(w: Workspace) -> DataFrame:
    found = shortest_path(w.graph, SOMEBODY, SOMEBODY_ELSE)
    return found.withColumn("path", F.array_join("path", ">"))


# Scores and communities


RANK_SQL = """
WITH RECURSIVE w AS (SELECT src, dst, weight / sum(weight) OVER (PARTITION BY src) AS part FROM fx_edges),
walk(id, score, round) AS (
  SELECT DISTINCT src, 0.15E0, 0 FROM w
  UNION ALL
  SELECT w.dst, 0.15E0 + 0.85E0 * sum(walk.score * w.part), walk.round + 1
  FROM walk JOIN w ON w.src = walk.id WHERE walk.round < 20 GROUP BY w.dst, walk.round),
ranks AS (SELECT id, round(score, 4) AS score FROM walk WHERE round = 20
          UNION ALL SELECT id, 0.15E0 FROM fx_usuario WHERE id NOT IN (SELECT src FROM w))"""


@query(RANK_SQL + " SELECT id, score FROM ranks")
def pagerank(w: Workspace) -> DataFrame:
    return w.scores.select("id", F.round("score", 4).alias("score"))


@query(RANK_SQL + """,
top AS (SELECT id, score FROM ranks ORDER BY score DESC, id LIMIT 10)
SELECT top.id AS user_id, u.username, top.score,
       CAST(row_number() OVER (ORDER BY top.score DESC, top.id) AS INT) AS rank,
       (SELECT max(score) FROM top) AS max_score
FROM top JOIN fx_usuario u ON u.id = top.id""")
def influencers(w: Workspace) -> DataFrame:
    return ask.influencers(w.scores, w.usuario)


def _halves_up(scores: DataFrame) -> DataFrame:
    """Scores a little higher, so that halves of the last digit round up in spite of
    binary errors, which differ with the order of a sum."""
    return scores.withColumn("score", F.col("score") + 1e-9)


@query("SELECT id, round(score + 1E-9, 4) AS score FROM fx_between")
def betweenness(w: Workspace) -> DataFrame:
    return _halves_up(w.between).select("id", F.round("score", 4).alias("score"))


@query("""
WITH b AS (SELECT id, round(score + 1E-9, 4) AS betweenness_score FROM fx_between),
top AS (SELECT * FROM b ORDER BY betweenness_score DESC, id LIMIT 10)
SELECT top.id AS user_id, u.username, top.betweenness_score,
       CAST(row_number() OVER (ORDER BY top.betweenness_score DESC, top.id) AS INT) AS rank
FROM top JOIN fx_usuario u ON u.id = top.id""")
def brokers(w: Workspace) -> DataFrame:
    return ask.brokers(_halves_up(w.between), w.usuario)


@query("SELECT id AS user_id, community, count(*) OVER (PARTITION BY community) AS size FROM fx_community")
def communities(w: Workspace) -> DataFrame:
    return ask.communities_with_size(w.communities)


@query("""
WITH z AS (SELECT community, count(*) AS size FROM fx_community GROUP BY community),
s AS (SELECT community, string_agg(id, ',' ORDER BY id) AS sample_users
      FROM (SELECT *, row_number() OVER (PARTITION BY community ORDER BY id) AS rn FROM fx_community) t
      WHERE rn <= 10 GROUP BY community)
SELECT z.community, z.size, s.sample_users, (SELECT count(*) FROM z) AS total_communities,
       (SELECT count(*) FROM z WHERE size < 2) AS niches_count,
       (SELECT CAST(coalesce(sum(size), 0) AS BIGINT) FROM z WHERE size < 2) AS niches_total_members
FROM z JOIN s ON s.community = z.community WHERE z.size >= 2""")
def community_summary(w: Workspace) -> DataFrame:
    made = ask.community_summary(w.communities)
    return made.withColumn("sample_users", F.array_join("sample_users", ","))


@query("""
WITH z AS (SELECT community, count(*) AS size FROM fx_community GROUP BY community),
top AS (SELECT 'Grupo ' || community AS label, size, false AS is_niche,
               CAST(row_number() OVER (ORDER BY size DESC, community) AS INT) AS rank
        FROM z WHERE size >= 2 ORDER BY size DESC, community LIMIT 3)
SELECT * FROM top
UNION ALL SELECT '+' || count(*) || ' nichos', CAST(sum(size) AS BIGINT), true, 4
FROM z WHERE size < 2 HAVING count(*) > 0""")
def community_tiles(w: Workspace) -> DataFrame:
    return ask.community_tiles(w.communities)


@query("""
WITH v AS (SELECT user_id, count(*) FILTER (WHERE ticket_tier = 'vip') AS vip, count(*) AS n FROM fx_asistio_a GROUP BY user_id)
SELECT c.community, round(avg(CAST(v.vip AS DOUBLE) / v.n), 3) AS avg_vip_ratio, count(*) AS size
FROM v JOIN fx_community c ON c.id = v.user_id WHERE 10 * v.vip >= 8 * v.n GROUP BY c.community""")
def vip_subgroups(w: Workspace) -> DataFrame:
    return ask.vip_subgroups(w.asistio_a, w.communities)


@query("""
SELECT user_id, avg(CASE WHEN ticket_tier = 'vip' THEN 1.0E0 ELSE 0.0E0 END) AS vip_ratio,
       count(*) AS total_attendances
FROM fx_asistio_a GROUP BY user_id HAVING avg(CASE WHEN ticket_tier = 'vip' THEN 1.0E0 ELSE 0.0E0 END) >= 0.8""")
def vip_users(w: Workspace) -> DataFrame:
    return ask.vip_shares(w.asistio_a)


@query("""
SELECT a.id AS user_id, a.community, count(DISTINCT b.community) AS total_communities_touched,
       count(DISTINCT b.community) FILTER (WHERE b.community <> a.community) AS external_communities_touched
FROM fx_edges g JOIN fx_community a ON a.id = g.src JOIN fx_community b ON b.id = g.dst
GROUP BY a.id, a.community
ORDER BY external_communities_touched DESC, total_communities_touched DESC, user_id LIMIT 20""")
def multi_community_users(w: Workspace) -> DataFrame:
    return ask.multi_community_users(w.graph, w.communities)


# The same community questions on a given grouping, which SQL can follow


SEGMENT_SQL = "SELECT id, rfm_seed_segment AS community FROM fx_usuario"


def _segments(w: Workspace) -> DataFrame:
    return w.usuario.select("id", F.col("rfm_seed_segment").alias("community"))


@query(f"""
WITH c AS ({SEGMENT_SQL}), z AS (SELECT community, count(*) AS size FROM c GROUP BY community),
s AS (SELECT community, string_agg(id, ',' ORDER BY id) AS sample_users
      FROM (SELECT *, row_number() OVER (PARTITION BY community ORDER BY id) AS rn FROM c) t
      WHERE rn <= 10 GROUP BY community)
SELECT z.community, z.size, s.sample_users, (SELECT count(*) FROM z) AS total_communities,
       CAST(0 AS BIGINT) AS niches_count, CAST(0 AS BIGINT) AS niches_total_members
FROM z JOIN s ON s.community = z.community""")
def community_summary_by_segment(w: Workspace) -> DataFrame:
    return ask.community_summary(_segments(w)).withColumn(
        "sample_users", F.array_join("sample_users", ",")
    )


@query(f"""
WITH z AS (SELECT community, count(*) AS size FROM ({SEGMENT_SQL}) c GROUP BY community)
SELECT 'Grupo ' || community AS label, size, false AS is_niche,
       CAST(row_number() OVER (ORDER BY size DESC, community) AS INT) AS rank
FROM z ORDER BY size DESC, community LIMIT 3""")
def community_tiles_by_segment(w: Workspace) -> DataFrame:
    return ask.community_tiles(_segments(w))


@query(f"""
WITH c AS ({SEGMENT_SQL}),
v AS (SELECT user_id, count(*) FILTER (WHERE ticket_tier = 'vip') AS vip, count(*) AS n FROM fx_asistio_a GROUP BY user_id)
SELECT c.community, round(avg(CAST(v.vip AS DOUBLE) / v.n), 3) AS avg_vip_ratio, count(*) AS size
FROM v JOIN c ON c.id = v.user_id WHERE 10 * v.vip >= 8 * v.n GROUP BY c.community""")
def vip_subgroups_by_segment(w: Workspace) -> DataFrame:
    return ask.vip_subgroups(w.asistio_a, _segments(w))


@query(f"""
WITH c AS ({SEGMENT_SQL})
SELECT a.id AS user_id, a.community, count(DISTINCT b.community) AS total_communities_touched,
       count(DISTINCT b.community) FILTER (WHERE b.community <> a.community) AS external_communities_touched
FROM fx_edges g JOIN c a ON a.id = g.src JOIN c b ON b.id = g.dst
GROUP BY a.id, a.community
ORDER BY external_communities_touched DESC, total_communities_touched DESC, user_id LIMIT 20""")
def multi_community_users_by_segment(w: Workspace) -> DataFrame:
    return ask.multi_community_users(w.graph, _segments(w))
