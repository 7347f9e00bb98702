"""The views of ``star_views`` as SQL, for the oracle side."""

from __future__ import annotations

VIEWS = {
    "fx_usuario": """
SELECT 'csv:' || CAST(c_custkey AS STRING) AS id, c_name AS username,
       c_mktsegment AS rfm_seed_segment, c_acctbal AS vip_affinity, 'csv' AS source
FROM customer""",
    "fx_evento": """
SELECT 'csv:' || CAST(p_partkey AS STRING) AS id, p_name AS name, p_type AS event_type,
       p_retailprice AS vip_pull, DATE '2024-01-01' + CAST(p_partkey % 365 AS INT) AS event_date,
       'csv' AS source
FROM part""",
    "fx_mesa": """
SELECT 'csv:' || CAST(s_suppkey AS STRING) AS id, CAST(s_suppkey AS INT) AS table_number,
       CAST(4 + s_suppkey % 9 AS INT) AS capacity, s_acctbal > 5000 AS is_vip,
       CASE s_suppkey % 3 WHEN 0 THEN 'vip' WHEN 1 THEN 'regular' ELSE 'private' END AS table_type,
       'csv' AS source
FROM supplier""",
    "fx_asistio_a": """
SELECT 'csv:' || CAST(o_custkey AS STRING) AS user_id, 'csv:' || CAST(l_partkey AS STRING) AS event_id,
       CASE WHEN max(l_quantity) >= 30 THEN 'vip' ELSE 'general' END AS ticket_tier, 'csv' AS source
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_returnflag = 'R' AND l_linestatus = 'F'
GROUP BY o_custkey, l_partkey""",
    "fx_reservo": """
SELECT DISTINCT 'csv:' || CAST(o_custkey AS STRING) AS user_id, 'csv:' || CAST(l_suppkey AS STRING) AS table_id,
       'csv:' || CAST(l_partkey AS STRING) AS event_id, 'csv' AS source
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_returnflag = 'A'""",
    "fx_conoce_a": """
SELECT p.user_1, p.user_2, p.shared_events, p.shared_vip_events,
       coalesce(r.shared_reservations, 0) AS shared_reservations,
       p.first_shared_event, p.last_shared_event,
       round(p.shared_events + p.shared_vip_events * 0.5E0 + coalesce(r.shared_reservations, 0) * 0.75E0, 3) AS tie_strength
FROM (SELECT a.user_id AS user_1, b.user_id AS user_2, count(*) AS shared_events,
             CAST(sum(CASE WHEN a.ticket_tier = 'vip' AND b.ticket_tier = 'vip' THEN 1 ELSE 0 END) AS BIGINT) AS shared_vip_events,
             min(e.event_date) AS first_shared_event, max(e.event_date) AS last_shared_event
      FROM fx_asistio_a a JOIN fx_asistio_a b ON a.event_id = b.event_id AND a.user_id < b.user_id
           JOIN fx_evento e ON e.id = a.event_id
      GROUP BY a.user_id, b.user_id) p
LEFT JOIN (SELECT a.user_id AS user_1, b.user_id AS user_2, count(*) AS shared_reservations
           FROM fx_reservo a JOIN fx_reservo b ON a.event_id = b.event_id AND a.user_id < b.user_id
           GROUP BY a.user_id, b.user_id) r
  ON p.user_1 = r.user_1 AND p.user_2 = r.user_2""",
    "fx_edges": """
SELECT user_1 AS src, user_2 AS dst, tie_strength AS weight FROM fx_conoce_a
UNION ALL SELECT user_2, user_1, tie_strength FROM fx_conoce_a""",
    "fx_community": """
WITH RECURSIVE
l AS MATERIALIZED (SELECT id, CAST('0x' || substr(md5(id), 1, 15) AS BIGINT) AS u FROM fx_usuario
                   WHERE id IN (SELECT src FROM fx_edges)),
e AS MATERIALIZED (SELECT a.u AS src, b.u AS dst FROM fx_edges g JOIN l a ON a.id = g.src JOIN l b ON b.id = g.dst),
d AS MATERIALIZED (SELECT src AS u, count(*) AS k FROM e GROUP BY src),
run(step, u, x, c, look, turn, whole, calm, moved) AS (
  SELECT 0, u, u, u, true, 1, true, false, false FROM l
  UNION ALL
  SELECT n.* FROM (
    WITH v AS (SELECT x, any_value(c) AS c, CAST(sum(k) AS BIGINT) AS k, any_value(turn) AS turn
               FROM run JOIN d ON d.u = run.u GROUP BY x),
    t AS (SELECT c, CAST(sum(k) AS BIGINT) AS total, count(*) AS size FROM v GROUP BY c),
    p AS (SELECT a.x, b.c AS target, count(*) AS links
          FROM e JOIN run a ON a.u = e.src JOIN run b ON b.u = e.dst WHERE a.look AND a.x <> b.x GROUP BY a.x, b.c),
    o AS (SELECT v.x, p.target, p.target = v.c AS own, -v.k * (o.total - v.k) AS alone, v.turn,
                 p.links * (SELECT count(*) FROM e) - v.k * (f.total - CASE WHEN p.target = v.c THEN v.k ELSE 0 END) AS gain,
                 p.target = v.c OR f.size > 1 OR o.size > 1 OR p.target < v.c AS allowed
          FROM p JOIN v ON v.x = p.x JOIN t f ON f.c = p.target JOIN t o ON o.c = v.c),
    w AS (SELECT x, first(target ORDER BY gain DESC, target) FILTER (WHERE allowed) AS target,
                 ((x >> CAST((any_value(turn) // 2) % 60 AS BIGINT)) & 1) = any_value(turn) % 2 AS goes
          FROM o GROUP BY x
          HAVING max(gain) FILTER (WHERE allowed) > coalesce(max(gain) FILTER (WHERE own), any_value(alone))),
    g AS (SELECT (SELECT count(*) FROM w) AS wishes, (SELECT count(*) FROM w WHERE goes) AS moves, (SELECT count(*) FROM v) AS n),
    near AS (SELECT DISTINCT a.x FROM e JOIN run a ON a.u = e.src JOIN run b ON b.u = e.dst JOIN w ON w.x = b.x AND w.goes),
    s AS (SELECT r.*, CASE WHEN w.goes THEN w.target ELSE r.c END AS c2, w.x IS NOT NULL OR near.x IS NOT NULL AS look2,
                 r.moved OR g.moves > 0 AS moved2, g.moves * 50 <= g.n AS calm2, g.wishes = 0 AND r.whole AS settled
          FROM run r CROSS JOIN g LEFT JOIN w ON w.x = r.x LEFT JOIN near ON near.x = r.x),
    z AS (SELECT *, settled OR (calm AND calm2 AND moved2) AS over, bool_or(look2) OVER () AS any_look FROM s)
    SELECT step + 1 AS step, u, CASE WHEN over THEN c2 ELSE x END AS x, c2 AS c, over OR look2 OR NOT any_look AS look,
           CASE WHEN over THEN 1 ELSE turn + 1 END AS turn, over OR NOT any_look AS whole, NOT over AND calm2 AS calm,
           NOT over AND moved2 AS moved
    FROM z WHERE NOT over OR moved2) n)
SELECT l.id, min(l.id) OVER (PARTITION BY run.c) AS community
FROM run JOIN l ON l.u = run.u WHERE step = (SELECT max(step) FROM run)
UNION ALL SELECT id, id FROM fx_usuario WHERE id NOT IN (SELECT id FROM l)""",
    "fx_between": """
WITH RECURSIVE
n AS MATERIALIZED (SELECT src AS id, CAST(row_number() OVER (ORDER BY src) AS INT) AS v FROM (SELECT DISTINCT src FROM fx_edges)),
e AS MATERIALIZED (SELECT a.v AS src, b.v AS dst, CAST(round(weight * 1000) AS INT) AS step
                   FROM fx_edges g JOIN n a ON a.id = g.src JOIN n b ON b.id = g.dst),
far(turn, s, v, cost, paths, low) AS (
  SELECT 0, v, v, 0, 1E0, 0 FROM n
  UNION ALL
  SELECT g.* FROM (
    WITH least AS (SELECT min(step) AS step FROM e),
    met AS (SELECT f.s, e.dst AS v, f.cost + e.step AS cost, f.paths
            FROM far f JOIN e ON e.src = f.v WHERE f.cost >= f.low AND f.cost < f.low + (SELECT step FROM least)
            UNION ALL SELECT s, v, cost, paths FROM far),
    summed AS (SELECT s, v, cost, sum(paths) AS paths FROM met GROUP BY s, v, cost),
    best AS (SELECT s, v, min(cost) AS cost, arg_min(paths, cost) AS paths FROM summed GROUP BY s, v),
    next AS (SELECT min(cost) AS low FROM best WHERE cost >= (SELECT any_value(low) FROM far) + (SELECT step FROM least))
    SELECT (SELECT any_value(turn) FROM far) + 1, s, v, cost, paths, coalesce(next.low, -1)
    FROM best CROSS JOIN next WHERE (SELECT any_value(low) FROM far) >= 0) g),
state AS MATERIALIZED (SELECT s, v, cost, paths FROM far WHERE turn = (SELECT max(turn) FROM far)),
dag AS MATERIALIZED (SELECT a.s, a.v AS u, b.v, a.paths / b.paths AS share
                     FROM state a JOIN e ON e.src = a.v JOIN state b ON b.s = a.s AND b.v = e.dst AND b.cost = a.cost + e.step),
back(turn, s, v, x) AS (
  SELECT 0, s, v, 1E0 FROM state
  UNION ALL
  SELECT any_value(b.turn) + 1, d.s, d.u, sum(d.share * b.x) FROM back b JOIN dag d ON d.s = b.s AND d.v = b.v GROUP BY d.s, d.u),
score AS (SELECT v, sum(x) / 2 AS score FROM back WHERE turn > 0 AND s <> v GROUP BY v)
SELECT u.id, coalesce(score, 0) AS score FROM fx_usuario u LEFT JOIN n ON n.id = u.id LEFT JOIN score ON score.v = n.v""",
    "fx_changelog": """
SELECT event_id AS uuid, 'core.users' AS table_name, user_id AS pk_id,
       CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'u' END AS op,
       ts AS source_ts, value, props AS payload_json
FROM events""",
    "fx_current": """
SELECT pk_id AS id, CAST(json_extract_string(payload_json, '$.k') AS BIGINT) AS k, uuid,
       op = 'D' AS source_deleted,
       CASE op WHEN 'I' THEN 'INSERT' WHEN 'D' THEN 'DELETE' ELSE 'UPDATE' END AS op_name, source_ts
FROM (SELECT *, row_number() OVER (PARTITION BY pk_id ORDER BY source_ts DESC) AS rn FROM fx_changelog) t
WHERE rn = 1""",
    "fx_tickets": """
SELECT ticket_id, user_id, order_id, type_ticket_id, ticket_state_id, unit_price, discount, updated_at
FROM (SELECT l_orderkey * 10 + l_linenumber AS ticket_id, o_custkey AS user_id, l_orderkey AS order_id,
             l_partkey AS type_ticket_id,
             CASE l_returnflag WHEN 'R' THEN 2 WHEN 'A' THEN 3 ELSE 1 END AS ticket_state_id,
             l_extendedprice AS unit_price, l_discount AS discount, l_shipdate AS updated_at,
             row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                                         l_returnflag, l_linestatus, l_shipdate) AS rn
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey) t
WHERE rn = 1""",
    "fx_orders": """
SELECT o_orderkey AS order_id, o_custkey AS user_id,
       CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'P' THEN 'pending' ELSE 'rejected' END AS status,
       o_orderdate AS updated_at, o_totalprice AS total
FROM orders""",
    "fx_payments": """
SELECT o_orderkey AS payment_id, o_orderkey AS order_id,
       CASE WHEN o_orderkey % 4 = 0 THEN 'pending' ELSE 'Verified' END AS status, o_orderdate AS created_at
FROM orders""",
    "fx_type_tickets": """
SELECT p_partkey AS type_ticket_id, p_partkey AS event_id,
       CASE WHEN p_size >= 25 THEN 'VIP' ELSE 'General' END AS ticket_tier, p_retailprice AS price
FROM part""",
    "fx_ticket_states": """
SELECT 1 AS id, 'active' AS name UNION ALL SELECT 2, 'Used' UNION ALL SELECT 3, 'cancelled'""",
    "fx_table_prices": """
SELECT l_suppkey AS table_id, l_partkey AS event_id, min(CASE WHEN l_partkey % 2 = 0 THEN l_extendedprice END) AS price
FROM lineitem
GROUP BY l_suppkey, l_partkey""",
    "fx_reservations": """
SELECT reservation_id, reservation_state_id, user_id, table_id, event_id, reserved_at
FROM (SELECT l_orderkey * 10 + l_linenumber AS reservation_id,
             CASE l_returnflag WHEN 'N' THEN 1 WHEN 'R' THEN 2 ELSE 4 END AS reservation_state_id,
             o_custkey AS user_id, l_suppkey AS table_id, l_partkey AS event_id, l_shipdate AS reserved_at,
             row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                                         l_returnflag, l_linestatus, l_shipdate) AS rn
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      WHERE l_linestatus = 'O' AND o_orderstatus = 'P') t
WHERE rn = 1""",
    "fx_reservation_states": """
SELECT 1 AS id, 'Pending' AS name UNION ALL SELECT 2, 'confirmed' UNION ALL SELECT 3, 'completed' UNION ALL SELECT 4, 'cancelled'""",
    "fx_purchases": """
SELECT t.user_id, k.event_id, t.ticket_id, t.type_ticket_id, lower(k.ticket_tier) AS ticket_tier, t.order_id,
       o.updated_at AS approved_at, coalesce(t.unit_price, k.price) - coalesce(t.discount, 0) AS price_paid,
       CAST(t.ticket_state_id AS BIGINT) AS ticket_state_id
FROM fx_tickets t JOIN fx_type_tickets k ON t.type_ticket_id = k.type_ticket_id
     JOIN fx_orders o ON t.order_id = o.order_id
     LEFT JOIN fx_ticket_states s ON s.id = t.ticket_state_id
WHERE lower(o.status) = 'approved'
  AND EXISTS (SELECT 1 FROM fx_payments p WHERE p.order_id = t.order_id AND lower(p.status) = 'verified')
  AND coalesce(lower(s.name), CAST(t.ticket_state_id AS STRING)) <> 'cancelled'""",
    "fx_attendances": """
SELECT t.user_id, k.event_id, t.ticket_id, t.type_ticket_id, t.updated_at AS used_at
FROM fx_tickets t JOIN fx_type_tickets k ON t.type_ticket_id = k.type_ticket_id
     LEFT JOIN fx_ticket_states s ON s.id = t.ticket_state_id
WHERE coalesce(lower(s.name), CAST(t.ticket_state_id AS STRING)) = 'used'""",
    "fx_live_reservations": """
SELECT r.user_id, r.table_id, r.reservation_id, r.event_id, p.price AS table_price,
       CAST(r.reservation_state_id AS BIGINT) AS reservation_state_id,
       r.reserved_at, CAST(NULL AS TIMESTAMP) AS expires_at
FROM fx_reservations r JOIN supplier ON s_suppkey = r.table_id
     LEFT JOIN fx_table_prices p ON p.table_id = r.table_id AND p.event_id = r.event_id
     LEFT JOIN fx_reservation_states s ON s.id = r.reservation_state_id
WHERE coalesce(lower(s.name), CAST(r.reservation_state_id AS STRING)) IN ('pending', 'confirmed', 'completed')""",
    "fx_day": """
SELECT p_partkey AS event_id, CAST(DATE '2024-01-01' + CAST(p_partkey % 365 AS INT) AS TIMESTAMP) AS event_date
FROM part""",
    "fx_channel_members": """
SELECT DISTINCT 'attendance' AS channel, event_id, user_id FROM fx_attendances
UNION SELECT DISTINCT 'purchase', event_id, user_id FROM fx_purchases
UNION SELECT DISTINCT 'reservation', event_id, user_id FROM fx_live_reservations""",
}


SOCIAL_SQL = """
WITH s AS (
  SELECT a.user_id AS user_1_id, b.user_id AS user_2_id,
         CAST(sum(CASE WHEN a.channel = 'attendance' THEN 1 ELSE 0 END) AS BIGINT) AS shared_attendances,
         CAST(sum(CASE WHEN a.channel = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS shared_purchases,
         CAST(sum(CASE WHEN a.channel = 'reservation' THEN 1 ELSE 0 END) AS BIGINT) AS shared_reservations,
         min(d.event_date) AS first_shared_event, max(d.event_date) AS last_shared_event
  FROM fx_channel_members a
       JOIN fx_channel_members b ON a.channel = b.channel AND a.event_id = b.event_id AND a.user_id < b.user_id
       LEFT JOIN fx_day d ON d.event_id = a.event_id
  GROUP BY a.user_id, b.user_id)
SELECT s.*, round(shared_attendances * 1.0E0 + shared_reservations * 0.75E0 + shared_purchases * 0.25E0, 3) AS tie_strength
FROM s"""


def with_views(*names_then_body: str) -> str:
    """SQL with the named views, and those they use, in front of the body."""
    *names, body = names_then_body
    needed: list[str] = []

    def add(name: str) -> None:
        for other in VIEWS:
            if other != name and other in VIEWS[name] and _uses(VIEWS[name], other):
                add(other)
        if name not in needed:
            needed.append(name)

    for name in names or [view for view in VIEWS if _uses(body, view)]:
        add(name)
    if not needed:
        return body.strip()
    views = ",\n".join(f"{name} AS MATERIALIZED ({VIEWS[name].strip()})" for name in needed)
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {views},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"


def _uses(text: str, view: str) -> bool:
    words = "".join(c if c.isalnum() or c == "_" else " " for c in text).split()
    return view in words


def rounded(part: str, whole: str, digits: int) -> str:
    """Quotient of two whole numbers, halves rounded up, without binary error."""
    scale = 10**digits
    return f"CAST((2 * {scale} * ({part}) + ({whole})) // (2 * ({whole})) AS DOUBLE) / {scale}"
