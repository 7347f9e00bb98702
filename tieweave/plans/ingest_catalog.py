"""Registered ingest queries: sources, normalizers, changes, sinks and streams.

Their inputs are derived from the star tables by Spark and, where a file or a
table on disk is the point, written to the shared scratch folder first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieweave.functions.columns import log_position, normalize_op
from tieweave.operators import changes, export, merge, normalize_cdc, normalize_seed, prepare
from tieweave.operators.edges import state_lookup
from tieweave.plans import batch_job
from tieweave.plans.bundle import PROJECTED_KEYS
from tieweave.plans.registry import query
from tieweave.plans.star_sql import SOCIAL_SQL
from tieweave.plans.workspace import Workspace
from tieweave.schemas import SOURCE_KEYS
from tieweave.session import cut_lineage, scratch_path
from tieweave.sinks import keyed
from tieweave.sinks.ledger import FileLedger
from tieweave.sources import files
from tieweave.streaming import changes as stream


def _text(column: str) -> Column:
    return F.col(column).cast("string")


# Seed tables as text, as they come from files


def raw_users(w: Workspace) -> DataFrame:
    return w.table("customer").select(
        _text("c_custkey").alias("id"), F.col("c_name").alias("username"),
        F.col("c_mktsegment").alias("rfm_seed_segment"),
        F.round(F.col("c_acctbal") * 100).cast("bigint").cast("string").alias("vip_affinity"),
        F.lit("no number").alias("invite_power"),
    )


def raw_events(w: Workspace) -> DataFrame:
    key = F.col("p_partkey")
    return w.table("part").select(
        _text("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.col("p_type").alias("event_type"), _text("p_size").alias("vip_pull"),
        F.date_add(F.lit("2024-01-01").cast("date"), (key % 365).cast("int")).cast("string")
        .alias("event_date"),
        F.when(key % 7 != 0, (key % 24).cast("string")).alias("start_hour_bucket"),
        F.when(key % 3 == 0, "unknown").otherwise((key % 3).cast("string")).alias("event_state"),
    )


def raw_tables(w: Workspace) -> DataFrame:
    key = F.col("s_suppkey")
    return w.table("supplier").select(
        _text("s_suppkey").alias("id"), _text("s_suppkey").alias("number"),
        (4 + key % 9).cast("string").alias("capacity"),
        F.when(key % 10 != 0, F.concat(F.lit("0."), (key % 10).cast("string"))).alias("vip_suitability"),
    )


def raw_tickets(w: Workspace) -> DataFrame:
    """Every line as a ticket; a third of the types is not in the catalogue."""
    return w.booked_lines.select(
        _text("o_custkey").alias("user_id"), _text("l_partkey").alias("type_ticket_id")
    )


def raw_type_tickets(w: Workspace) -> DataFrame:
    return w.table("part").filter("p_size > 16").select(
        _text("p_partkey").alias("id"), _text("p_partkey").alias("event_id"),
        F.when(F.col("p_size") >= 25, "vip").otherwise("general").alias("ticket_tier"),
    )


def raw_reservations(w: Workspace) -> DataFrame:
    return w.booked_lines.select(
        _text("o_custkey").alias("user_id"), _text("l_suppkey").alias("table_id"),
        _text("l_partkey").alias("event_id"),
    )


USUARIO_SQL = """
SELECT '{p}:' || CAST(c_custkey AS STRING) AS id, CAST(NULL AS STRING) AS telegram_id, c_name AS username,
       CAST(NULL AS STRING) AS social_role, CAST(NULL AS STRING) AS social_group_id,
       CAST(NULL AS STRING) AS secondary_group_id, CAST(NULL AS STRING) AS attendance_level,
       {affinity} AS vip_affinity, CAST(NULL AS DOUBLE) AS invite_power,
       CAST(NULL AS STRING) AS table_preference, {segment} AS rfm_seed_segment,
       CAST(NULL AS DOUBLE) AS newcomer_affinity, CAST(NULL AS DOUBLE) AS mixing_score, '{p}' AS source
FROM customer"""


@query(USUARIO_SQL.format(
    p="csv", affinity="CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS DOUBLE)", segment="c_mktsegment"))
def norm_csv_usuarios(w: Workspace) -> DataFrame:
    return normalize_seed.norm_csv_usuarios(raw_users(w))


EVENTO_SQL = """
SELECT 'csv:' || CAST(p_partkey AS STRING) AS id, p_name AS name, p_type AS event_type,
       CAST(NULL AS STRING) AS expected_demand_level, CAST(p_size AS DOUBLE) AS vip_pull,
       DATE '2024-01-01' + CAST(p_partkey % 365 AS INT) AS event_date,
       CASE WHEN p_partkey % 7 <> 0
            THEN CAST(DATE '2024-01-01' + CAST(p_partkey % 365 AS INT) AS TIMESTAMP) + to_hours(CAST(p_partkey % 24 AS INT))
       END AS start_time,
       CAST(NULL AS TIMESTAMP) AS end_time,
       CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_partkey % 3 AS INT) END AS event_state_id, 'csv' AS source
FROM part"""


def _local_times(events: DataFrame) -> DataFrame:
    """Moments without a zone, as the SQL side has them."""
    return events.withColumns(
        {name: F.col(name).cast("timestamp_ntz") for name in ("start_time", "end_time")}
    )


@query(EVENTO_SQL)
def norm_csv_eventos(w: Workspace) -> DataFrame:
    return _local_times(normalize_seed.norm_csv_eventos(raw_events(w)))


MESA_SQL = """
SELECT 'csv:' || CAST(s_suppkey AS STRING) AS id, CAST(s_suppkey AS INT) AS table_number,
       CAST(4 + s_suppkey % 9 AS INT) AS capacity, {vip} AS is_vip, CAST(NULL AS STRING) AS event_id, 'csv' AS source
FROM supplier"""


@query(MESA_SQL.format(vip="CASE WHEN s_suppkey % 10 <> 0 THEN s_suppkey % 10 > 5 END"))
def norm_csv_mesas(w: Workspace) -> DataFrame:
    return normalize_seed.norm_csv_mesas(raw_tables(w))


@query("""
SELECT 'csv:' || CAST(o_custkey AS STRING) AS user_id, 'csv:' || CAST(l_partkey AS STRING) AS event_id,
       CASE WHEN p_size >= 25 THEN 'vip' ELSE 'general' END AS ticket_tier, 'csv' AS source
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
WHERE p_size > 16""")
def norm_csv_asistio_a(w: Workspace) -> DataFrame:
    return normalize_seed.norm_csv_asistio_a(raw_tickets(w), raw_type_tickets(w))


RESERVO_SQL = """
SELECT '{p}:' || CAST(o_custkey AS STRING) AS user_id, '{p}:' || CAST(l_suppkey AS STRING) AS table_id,
       '{p}:' || CAST(l_partkey AS STRING) AS event_id, '{p}' AS source
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


@query(RESERVO_SQL.format(p="csv"))
def norm_csv_reservo(w: Workspace) -> DataFrame:
    return normalize_seed.norm_csv_reservo(raw_reservations(w))


@query("""SELECT DISTINCT c_mktsegment AS name, 'customers in ' || c_mktsegment AS description, 'csv' AS source
FROM customer WHERE c_mktsegment IS NOT NULL""")
def norm_csv_segmentos(w: Workspace) -> DataFrame:
    segments = w.table("customer").select(
        F.col("c_mktsegment").alias("segment_name"),
        F.concat(F.lit("customers in "), "c_mktsegment").alias("description"),
    )
    return normalize_seed.norm_csv_segmentos(segments.distinct())


@query("""SELECT 'csv:' || CAST(c_custkey AS STRING) AS user_id, c_mktsegment AS segment_name, 'csv' AS source
FROM customer WHERE c_mktsegment IS NOT NULL""")
def norm_csv_pertenece_a(w: Workspace) -> DataFrame:
    members = raw_users(w).select(
        F.col("id").alias("user_id"), F.col("rfm_seed_segment").alias("segment_name")
    )
    return normalize_seed.norm_csv_pertenece_a(members)


# The forgiving rules, on padded and partly empty text


def _untidy(df: DataFrame) -> DataFrame:
    """Blanks around every text, and blanks instead of missing values."""
    return df.select(
        *[F.concat(F.lit("  "), F.coalesce(F.col(name), F.lit("")), F.lit(" ")).alias(name) for name in df.columns]
    )


def _lenient(w: Workspace) -> dict[str, DataFrame]:
    attended = w.booked_lines.select(
        F.when(F.col("l_linenumber") > 1, _text("o_custkey")).alias("user_id"),
        _text("l_partkey").alias("event_id"),
        F.when(F.col("l_quantity") >= 30, "vip").alias("ticket_tier"),
    )
    raw = {
        "users": raw_users(w), "events": raw_events(w), "dico_tables": raw_tables(w),
        "attendance_seed": attended, "reservations": raw_reservations(w),
    }
    return normalize_seed.lenient_normalize({name: _untidy(df) for name, df in raw.items()})


@query("""
SELECT 'csv:' || CAST(o_custkey AS STRING) AS user_id, 'csv:' || CAST(l_partkey AS STRING) AS event_id,
       CASE WHEN l_quantity >= 30 THEN 'vip' END AS ticket_tier, 'csv' AS source
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber > 1""", name="lenient_normalize")
def _lenient_attendance(w: Workspace) -> DataFrame:
    return _lenient(w)["asistio_a"]


@query(EVENTO_SQL, name="lenient_normalize_eventos")
def _lenient_events(w: Workspace) -> DataFrame:
    return _local_times(_lenient(w)["eventos"])


@query(MESA_SQL.format(vip="s_suppkey % 10 > 5"), name="lenient_normalize_mesas")
def _lenient_tables(w: Workspace) -> DataFrame:
    return _lenient(w)["mesas"]


# The change feed


@query(USUARIO_SQL.format(p="v2", affinity="CAST(NULL AS DOUBLE)", segment="CAST(NULL AS STRING)"))
def norm_v2_usuarios(w: Workspace) -> DataFrame:
    return normalize_cdc.norm_v2_usuarios(raw_users(w))


@query("""
SELECT 'v2:' || CAST(p_partkey AS STRING) AS id, p_name AS name, p_type AS event_type,
       CAST(NULL AS STRING) AS expected_demand_level, CAST(NULL AS DOUBLE) AS vip_pull,
       CAST(NULL AS DATE) AS event_date, CAST(NULL AS TIMESTAMP) AS start_time,
       CAST(NULL AS TIMESTAMP) AS end_time, CAST(p_size AS INT) AS event_state_id, 'v2' AS source
FROM part""")
def norm_v2_eventos(w: Workspace) -> DataFrame:
    fed = w.table("part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("event_name"),
        F.col("p_type").alias("event_type"), _text("p_size").alias("event_state_id"),
    )
    return _local_times(normalize_cdc.norm_v2_eventos(fed))


@query("""
SELECT 'v2:' || CAST(s_suppkey AS STRING) AS id, CAST(s_suppkey AS INT) AS table_number,
       CAST(NULL AS INT) AS capacity, s_acctbal > 5000 AS is_vip,
       'v2:' || CAST(s_nationkey AS STRING) AS event_id, 'v2' AS source
FROM supplier""")
def norm_v2_mesas(w: Workspace) -> DataFrame:
    fed = w.table("supplier").select(
        F.col("s_suppkey").alias("id"), _text("s_suppkey").alias("numero_mesa"),
        (F.col("s_acctbal") > 5000).alias("is_vip"), F.col("s_nationkey").alias("event_id"),
    )
    return normalize_cdc.norm_v2_mesas(fed)


@query("""
SELECT 'v2:' || CAST(o_custkey AS STRING) AS user_id, 'v2:' || CAST(l_partkey AS STRING) AS event_id,
       l_returnflag AS ticket_tier, 'v2' AS source
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def norm_v2_asistio_a(w: Workspace) -> DataFrame:
    fed = w.booked_lines.select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("event_id"),
        F.col("l_returnflag").alias("tier"),
    )
    return normalize_cdc.norm_v2_asistio_a(fed)


@query(RESERVO_SQL.format(p="v2"))
def norm_v2_reservo(w: Workspace) -> DataFrame:
    return normalize_cdc.norm_v2_reservo(raw_reservations(w))


@query("""
SELECT 'csv:' || CAST(c_custkey AS STRING) AS id,
       CASE WHEN o.o_custkey IS NULL THEN 'seed' ELSE 'feed' END AS origin,
       CASE WHEN o.o_custkey IS NULL THEN c_name ELSE 'buyer ' || CAST(c_custkey AS STRING) END AS username
FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) o ON o.o_custkey = c_custkey""")
def merge_canonical(w: Workspace) -> DataFrame:
    """Buyers of the feed take the place of the seed users with the same key."""
    seed = w.usuario.select("id", "username", F.lit("seed").alias("origin"), F.lit("csv").alias("source"))
    buyers = w.table("orders").select(
        F.concat(F.lit("csv:"), _text("o_custkey")).alias("id"),
        F.concat(F.lit("buyer "), _text("o_custkey")).alias("username"),
        F.lit("feed").alias("origin"), F.lit("v2").alias("source"),
    )
    known = buyers.join(seed.select("id"), "id", "left_semi")
    merged = merge.merge_canonical({"usuarios": known}, {"usuarios": seed})
    return merged["usuarios"].select("id", "origin", "username")


@query("""SELECT 'csv:' || CAST(l_orderkey AS STRING) AS id, count(*) AS rows
FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1""")
def unique_key_check(w: Workspace) -> DataFrame:
    lines = w.table("lineitem").select(F.concat(F.lit("csv:"), _text("l_orderkey")).alias("id"))
    return merge.unique_key_check(lines, ["id"])


# Prepared tables


@query("""SELECT c_custkey AS user_id, c_name AS username, CAST(NULL AS DOUBLE) AS vip_affinity,
       false AS source_deleted FROM customer""")
def prepare_users(w: Workspace) -> DataFrame:
    made = prepare.prepare_users(w.source_tables["core.users"])
    return made.select("user_id", "username", "vip_affinity", "source_deleted")


@query("""SELECT p_partkey AS event_id, p_name AS name,
       CAST(DATE '2024-01-01' + CAST(p_partkey % 365 AS INT) AS TIMESTAMP) AS event_date,
       CASE WHEN p_partkey % 3 <> 0 THEN p_partkey % 3 END AS event_state_id FROM part""")
def prepare_events(w: Workspace) -> DataFrame:
    made = prepare.prepare_events(raw_events(w))
    return made.select("event_id", "name", "event_date", "event_state_id")


@query("""SELECT s_suppkey AS table_id, s_suppkey AS number, 4 + s_suppkey % 9 AS capacity,
       CASE WHEN s_suppkey % 10 <> 0 THEN CAST(s_suppkey % 10 AS DOUBLE) / 10 END AS vip_suitability,
       CAST(NULL AS STRING) AS table_type FROM supplier""")
def prepare_tables(w: Workspace) -> DataFrame:
    made = prepare.prepare_tables(raw_tables(w))
    return made.select("table_id", "number", "capacity", "vip_suitability", "table_type")


@query("""SELECT p_partkey AS type_ticket_id, p_partkey AS event_id,
       CASE WHEN p_size >= 25 THEN 'vip' ELSE 'general' END AS ticket_tier, p_retailprice AS price FROM part""")
def prepare_type_tickets(w: Workspace) -> DataFrame:
    made = prepare.prepare_type_tickets(w.source_tables["core.type_tickets"])
    return made.select("type_ticket_id", "event_id", "ticket_tier", "price")


@query("SELECT table_id, event_id, price, false AS source_deleted FROM fx_table_prices")
def prepare_table_prices(w: Workspace) -> DataFrame:
    return prepare.prepare_table_prices(w.source_tables["core.table_prices"])


@query("SELECT order_id, user_id, status, updated_at, total, false AS source_deleted FROM fx_orders")
def prepare_orders(w: Workspace) -> DataFrame:
    return prepare.prepare_orders(w.source_tables["transactions.orders"])


@query("""SELECT ticket_id AS order_detail_id, order_id, ticket_id, 1.0E0 AS quantity, unit_price, discount
FROM fx_tickets""")
def prepare_order_details(w: Workspace) -> DataFrame:
    made = prepare.prepare_order_details(w.source_tables["transactions.order_details"])
    return made.select("order_detail_id", "order_id", "ticket_id", "quantity", "unit_price", "discount")


@query("""SELECT ticket_id, user_id, type_ticket_id, CAST(ticket_state_id AS BIGINT) AS ticket_state_id,
       updated_at, CAST(NULL AS TIMESTAMP) AS created_at FROM fx_tickets""")
def prepare_tickets(w: Workspace) -> DataFrame:
    made = prepare.prepare_tickets(w.source_tables["transactions.tickets"])
    return made.select(
        "ticket_id", "user_id", "type_ticket_id", "ticket_state_id", "updated_at", "created_at"
    )


@query("""SELECT reservation_id, user_id, table_id, event_id, reserved_at,
       CAST(NULL AS TIMESTAMP) AS expires_at FROM fx_reservations""")
def prepare_reservations(w: Workspace) -> DataFrame:
    made = prepare.prepare_reservations(w.source_tables["transactions.reservations"])
    return made.select("reservation_id", "user_id", "table_id", "event_id", "reserved_at", "expires_at")


@query("SELECT payment_id, order_id, status, created_at, false AS source_deleted FROM fx_payments")
def prepare_payments(w: Workspace) -> DataFrame:
    return prepare.prepare_payments(w.source_tables["transactions.payments"])


@query("""SELECT ticket_id, CASE ticket_state_id WHEN 1 THEN 'active' WHEN 2 THEN 'used' ELSE '3' END AS state
FROM fx_tickets""", name="state_lookup")
def _state_lookup(w: Workspace) -> DataFrame:
    """With a catalogue that lacks one state."""
    states = w.ticket_states.filter("name <> 'cancelled'")
    return state_lookup(w.tickets, states, "ticket_state_id").select("ticket_id", "state")


@query("""SELECT l_orderkey, l_linenumber, min(l_extendedprice) AS price
FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_orderkey, l_linenumber""")
def active_only(w: Workspace) -> DataFrame:
    lines = w.table("lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"),
        (F.col("l_returnflag") == "N").alias("source_deleted"),
    )
    kept = prepare.active_only(lines, ["l_orderkey", "l_linenumber"])
    return kept.select("l_orderkey", "l_linenumber", "price")


# Export


@query("""SELECT '{"id":"' || id || '","table_number":' || CAST(table_number AS STRING) || ',"capacity":'
       || CASE WHEN is_vip THEN CAST(capacity AS STRING) ELSE 'null' END || ',"share":null,"type":"' || table_type || '"}' AS record
FROM fx_mesa""")
def export_records(w: Workspace) -> DataFrame:
    return export.export_records(
        w.mesa.select(
            "id", "table_number", F.when(F.col("is_vip"), F.col("capacity")).alias("capacity"),
            F.lit(float("nan")).alias("share"), F.col("table_type").alias("type"),
        )
    )


@query("""SELECT p_partkey AS event_id, CAST(p_size AS DOUBLE) AS vip_pull,
       DATE '2024-01-01' + CAST(p_partkey % 365 AS INT) AS event_date,
       CASE WHEN p_partkey % 3 <> 0 THEN p_partkey % 3 END AS event_state_id, false AS source_deleted
FROM part""")
def typed_property_cast(w: Workspace) -> DataFrame:
    text = raw_events(w).select(
        F.col("id").alias("event_id"), "vip_pull", "event_date",
        F.col("event_state").alias("event_state_id"), F.lit(None).cast("string").alias("source_deleted"),
    )
    kinds = {name: kind for name, kind in export.EVENT_PROPERTIES.items() if name in text.columns}
    return export.typed_property_cast(text, kinds)


# Changes


def changelog(w: Workspace) -> DataFrame:
    """The change log with keys and images as JSON text."""
    deleted = F.col("op") == "D"
    return w.changelog.select(
        F.col("uuid").cast("string").alias("uuid"), "op", "source_ts",
        F.to_json(F.struct(F.col("pk_id").alias("id"))).alias("pk"),
        F.when(~deleted, F.col("payload_json")).alias("after"),
        F.when(deleted, F.col("payload_json")).alias("before"),
    )


@query("""SELECT id, k, source_deleted, op_name AS _op, source_ts AS _source_ts FROM fx_current""")
def reduce_cdc_to_current(w: Workspace) -> DataFrame:
    current = changes.reduce_cdc_to_current(changelog(w), "core.users")
    return changes.unpack_image(current, {"id": "bigint", "k": "bigint"})


@query("""SELECT problem, count(*) AS changes FROM (
    SELECT CASE WHEN uuid % 3 = 0 THEN 'unreadable image' ELSE 'no key value' END AS problem
    FROM fx_changelog WHERE uuid % 3 < 2) p GROUP BY problem
UNION ALL SELECT 'none' AS problem, count(DISTINCT pk_id) AS changes FROM fx_changelog WHERE uuid % 3 = 2""")
def reduce_cdc_to_current_rejected(w: Workspace) -> DataFrame:
    """Of the change log, a third is made unreadable and a third loses its key."""
    kind = F.col("uuid").cast("bigint") % 3
    spoiled = (
        changelog(w)
        .withColumn("after", F.when(kind == 0, "[1]").when(kind == 1, "{}").otherwise(F.col("after")))
        .withColumn("before", F.when(kind == 1, F.lit("{}")).otherwise(F.col("before")))
        .withColumn("pk", F.when(kind == 1, F.lit("{}")).otherwise(F.col("pk")))
    )
    current, rejected = changes.reduce_cdc_with_rejected(spoiled, "core.users")
    sound = current.agg(F.lit("none").alias("problem"), F.count(F.lit(1)).alias("changes"))
    return rejected.groupBy("problem").agg(F.count(F.lit(1)).alias("changes")).unionByName(sound)


@query("""SELECT 'core.users' AS table_name, id, k FROM fx_current
UNION ALL SELECT 'core.events', id, k FROM fx_current WHERE NOT source_deleted""")
def reduce_streams_to_current(w: Workspace) -> DataFrame:
    reduced = changes.reduce_streams_to_current({"users": changelog(w), "events": changelog(w)})
    fields = {"id": "bigint", "k": "bigint"}
    flat = lambda table: changes.unpack_image(reduced[table], fields).withColumn(
        "table_name", F.lit(table)
    )
    live = flat("core.events").filter("NOT source_deleted")
    return flat("core.users").unionByName(live).select("table_name", "id", "k")


@query("""SELECT uuid, CAST(json_extract_string(payload_json, '$.k') AS BIGINT) AS k,
       CASE op WHEN 'I' THEN 'INSERT' WHEN 'D' THEN 'DELETE' ELSE 'UPDATE' END AS op FROM fx_changelog""")
def parse_image(w: Workspace) -> DataFrame:
    image = changes.parse_image(w.changelog, "payload_json")
    return w.changelog.select(
        "uuid", F.try_element_at(image, F.lit("k")).try_cast("bigint").alias("k"),
        normalize_op(F.concat(F.lit(" "), "op")).alias("op"),
    )


@query("""SELECT pk_id AS id, uuid, op = 'D' AS source_deleted
FROM (SELECT *, row_number() OVER (PARTITION BY pk_id ORDER BY source_ts DESC) AS rn FROM fx_changelog) t
WHERE rn = 1""")
def latest_by_commit_ts(w: Workspace) -> DataFrame:
    batch = w.changelog.select(
        F.col("pk_id").alias("id"), "uuid", F.col("op").alias("Op"),
        F.col("source_ts").alias("_dms_timestamp"),
    )
    return changes.latest_by_commit_ts(batch, ["id"]).select("id", "uuid", "source_deleted")


def envelopes(w: Workspace) -> DataFrame:
    """The change log as envelopes; every second table name comes with its key."""
    key = F.col("pk_id").cast("string")
    position = F.concat(F.lit("0/"), F.hex("uuid"))
    return w.changelog.select(
        _text("uuid").alias("uuid"),
        F.col("source_ts").cast("timestamp").alias("source_timestamp"),
        F.col("source_ts").cast("timestamp").alias("read_timestamp"),
        F.struct(
            F.lit("core").alias("schema"), F.lit("users").alias("table"),
            F.when(F.col("uuid") % 2 == 0, F.array(F.lit("id"))).alias("primary_keys"),
            (F.col("op") == "D").alias("is_deleted"), F.col("op").alias("change_type"),
            position.alias("lsn"),
        ).alias("source_metadata"),
        F.create_map(
            F.lit("id"), key, F.lit("k"), F.get_json_object("payload_json", "$.k")
        ).alias("payload"),
    )


CURRENT_SQL = """
SELECT pk_id AS id, CAST(json_extract_string(payload_json, '$.k') AS BIGINT) AS k, op = 'D' AS source_deleted
FROM (SELECT *, row_number() OVER (PARTITION BY pk_id ORDER BY epoch_ms(source_ts) DESC, uuid DESC) AS rn
      FROM fx_changelog) t
WHERE rn = 1"""


def _unpacked(current: DataFrame) -> DataFrame:
    value = lambda name: F.try_element_at("payload", F.lit(name)).try_cast("bigint").alias(name)
    return current.select(value("id"), value("k"), "source_deleted")


@query(CURRENT_SQL)
def envelope_ingest(w: Workspace) -> DataFrame:
    """Every envelope is delivered twice."""
    once = envelopes(w)
    return _unpacked(changes.envelope_ingest(once.unionByName(once)))


@query("SELECT CAST(uuid AS STRING) AS uuid, pk_id AS id FROM fx_changelog")
def dedupe_uuid(w: Workspace) -> DataFrame:
    once = envelopes(w)
    kept = changes.dedupe_uuid(once.unionByName(once))
    return kept.select("uuid", F.try_element_at("payload", F.lit("id")).cast("bigint").alias("id"))


@query("""SELECT CAST(uuid AS STRING) AS uuid, 'core.users' AS "table", 'id' AS keys, CAST(uuid AS BIGINT) AS position
FROM fx_changelog""")
def primary_key_resolution(w: Workspace) -> DataFrame:
    return changes.primary_key_resolution(envelopes(w)).select(
        "uuid", "table", F.array_join("keys", ",").alias("keys"),
        log_position(F.col("source_metadata.lsn")).cast("bigint").alias("position"),
    )


# Files


@query("""SELECT 'users' AS part, CAST(c_custkey AS STRING) AS id, c_name AS name FROM customer
UNION ALL SELECT 'events', CAST(p_partkey AS STRING), p_name FROM part
UNION ALL SELECT 'dico_tables', CAST(s_suppkey AS STRING), CAST(s_suppkey AS STRING) FROM supplier""")
def scan_seed_csv(w: Workspace) -> DataFrame:
    folder = scratch_path(w.spark, "seed")
    raw_users(w).write.csv(f"{folder}/users.csv", header=True)
    raw_events(w).write.csv(f"{folder}/events.csv", header=True)
    raw_tables(w).write.csv(f"{folder}/dico_tables.csv", header=True)
    found = files.scan_seed_csv(w.spark, folder)
    names = {"users": "username", "events": "name", "dico_tables": "number"}
    made = [
        found[part].select(F.lit(part).alias("part"), "id", F.col(name).alias("name"))
        for part, name in names.items()
    ]
    return made[0].unionByName(made[1]).unionByName(made[2])


@query("""SELECT CAST(c_custkey % 3 AS INT) AS part, c_custkey AS id, c_name AS username FROM customer""")
def source_file_column(w: Workspace) -> DataFrame:
    """Three change files of one table; each row tells which one it came from."""
    folder = scratch_path(w.spark, "feed")
    rows = w.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("username"))
    paths = [f"{folder}/{part}/data/core/users" for part in range(3)]
    for part, path in enumerate(paths):
        rows.filter(F.col("id") % 3 == part).write.parquet(path)
    manifest = w.spark.createDataFrame([(path,) for path in paths], "uri string")
    found = files.scan_cdc_parquet(w.spark, manifest)["core.users"]
    part = F.regexp_extract("source_file", "/([0-2])/data/core/users/", 1).cast("int")
    return found.select(part.alias("part"), "id", "username")


def notifications(w: Workspace) -> DataFrame:
    """One message per order: JSON, bare address, status file, empty or unknown."""
    path = F.concat(F.lit("data/transactions/orders/"), _text("o_custkey"), F.lit(".parquet"))
    kind = F.col("o_orderpriority")
    return w.table("orders").select(
        F.when(kind == "1-URGENT", F.to_json(F.struct(F.lit("feed").alias("bucket"), path.alias("key"))))
        .when(kind == "2-HIGH", F.concat(F.lit("s3://feed/"), path))
        .when(kind == "3-MEDIUM", F.lit("s3://feed/data/public/awsdms_status/1.parquet"))
        .when(kind == "5-LOW", F.lit(""))
        .otherwise(F.concat(F.lit("order "), _text("o_orderkey")))
        .alias("message")
    )


MANIFEST_SQL = """
SELECT DISTINCT 's3://feed/data/transactions/orders/' || CAST(o_custkey AS STRING) || '.parquet' AS uri
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')"""


@query(f"SELECT uri, 'transactions.orders' AS table_name FROM ({MANIFEST_SQL}) m")
def cdc_manifest(w: Workspace) -> DataFrame:
    manifest = files.cdc_manifest(notifications(w))
    return manifest.withColumn("table_name", files.table_key(files.hadoop_uri("uri")))


@query("""SELECT 'core.users' AS table_name, c_custkey AS id FROM customer
UNION ALL SELECT 'transactions.orders', o_orderkey FROM orders""")
def scan_cdc_parquet(w: Workspace) -> DataFrame:
    folder = scratch_path(w.spark, "feed")
    parts = {"core/users": ("customer", "c_custkey"), "transactions/orders": ("orders", "o_orderkey")}
    for path, (table, key) in parts.items():
        w.table(table).select(F.col(key).alias("id")).write.parquet(f"{folder}/data/{path}")
    manifest = w.spark.createDataFrame([(f"{folder}/data/{path}",) for path in parts], "uri string")
    tables = files.scan_cdc_parquet(w.spark, manifest)
    named = [df.select(F.lit(name).alias("table_name"), "id") for name, df in tables.items()]
    return named[0].unionByName(named[1])


def _ledger_with_json_files(w: Workspace) -> tuple[FileLedger, DataFrame]:
    """A ledger in which the files announced as JSON are marked, and all files."""
    ledger = FileLedger(w.spark, scratch_path(w.spark, "ledger"))
    messages = notifications(w)
    ledger.mark_processed(files.cdc_manifest(messages.filter("message LIKE '{%'")))
    return ledger, files.cdc_manifest(messages)


DONE_SQL = """
SELECT DISTINCT 's3://feed/data/transactions/orders/' || CAST(o_custkey AS STRING) || '.parquet' AS uri
FROM orders WHERE o_orderpriority = '1-URGENT'"""


@query(f"SELECT uri, true AS dated FROM ({DONE_SQL}) d")
def mark_processed(w: Workspace) -> DataFrame:
    ledger, _ = _ledger_with_json_files(w)
    return ledger.entries().select("uri", F.col("processed_at").isNotNull().alias("dated"))


@query(f"""SELECT uri, CASE WHEN uri IN (SELECT uri FROM ({DONE_SQL}) d) THEN 'done' ELSE 'open' END AS status
FROM ({MANIFEST_SQL}) m""")
def already_processed(w: Workspace) -> DataFrame:
    ledger, manifest = _ledger_with_json_files(w)
    done = ledger.already_processed(manifest).withColumn("status", F.lit("done"))
    left = files.pending_files(manifest, ledger).withColumn("status", F.lit("open"))
    return done.unionByName(left)


@query(DONE_SQL)
def ledger_retention(w: Workspace) -> DataFrame:
    """All other files are in the ledger too, but for longer than entries are kept."""
    ledger, manifest = _ledger_with_json_files(w)
    old = F.current_timestamp() - F.make_dt_interval(F.lit(31))
    ledger.mark_processed(ledger.not_processed(manifest), old)
    ledger.retain(30)
    return ledger.entries().select("uri")


# Sinks


def _table(w: Workspace, label: str, *keys: str) -> keyed.KeyedTable:
    return keyed.KeyedTable(w.spark, scratch_path(w.spark, label), keys)


def _buyers(w: Workspace) -> DataFrame:
    return w.table("orders").select(F.concat(F.lit("csv:"), _text("o_custkey")).alias("id")).distinct()


@query("""SELECT u.id, CASE WHEN b.id IS NULL THEN u.username ELSE 'buyer' END AS username
FROM fx_usuario u LEFT JOIN (SELECT DISTINCT 'csv:' || CAST(o_custkey AS STRING) AS id FROM orders) b ON b.id = u.id""")
def upsert_nodes(w: Workspace) -> DataFrame:
    table = _table(w, "nodes", "id")
    keyed.upsert_nodes(table, w.usuario.select("id", "username"))
    return keyed.upsert_nodes(table, _buyers(w).withColumn("username", F.lit("buyer")))


@query("""SELECT a.user_id, a.event_id, a.ticket_tier FROM fx_asistio_a a
JOIN fx_evento e ON e.id = a.event_id JOIN fx_usuario u ON u.id = a.user_id
WHERE e.vip_pull > 950""")
def upsert_edges(w: Workspace) -> DataFrame:
    table = _table(w, "edges", "user_id", "event_id")
    edges = w.asistio_a.select("user_id", "event_id", "ticket_tier")
    known = w.evento.filter("vip_pull > 950")
    ends = ("user_id", w.usuario, "id"), ("event_id", known, "id")
    keyed.upsert_edges(table, edges.withColumn("ticket_tier", F.lit("old")), *ends)
    return keyed.upsert_edges(table, edges, *ends)


@query("SELECT user_id, event_id, ticket_id FROM fx_attendances")
def upsert_keyed_edges(w: Workspace) -> DataFrame:
    table = _table(w, "keyed", "user_id", "event_id", "ticket_id")
    edges = w.attendances().select("user_id", "event_id", "ticket_id")
    keyed.upsert_edges(table, edges)
    return keyed.upsert_edges(table, edges.unionByName(edges))


@query("SELECT user_1, user_2, tie_strength FROM fx_conoce_a")
def upsert_undirected_edge(w: Workspace) -> DataFrame:
    table = _table(w, "undirected", "user_1", "user_2")
    edges = w.ties.select("user_1", "user_2", "tie_strength")
    turned = edges.select(F.col("user_2").alias("user_1"), F.col("user_1").alias("user_2"), "tie_strength")
    keyed.upsert_undirected_edge(table, edges.withColumn("tie_strength", F.lit(0.0)), w.usuario)
    return keyed.upsert_undirected_edge(table, turned, w.usuario)


@query("""SELECT 'removed' AS change, id FROM fx_usuario
WHERE id NOT IN (SELECT 'csv:' || CAST(o_custkey AS STRING) FROM orders)
UNION ALL SELECT DISTINCT 'kept', 'csv:' || CAST(o_custkey AS STRING) FROM orders""")
def sync_full_snapshot(w: Workspace) -> DataFrame:
    table = _table(w, "snapshot", "id")
    table.replace(w.usuario.select("id", F.lit(1).alias("run")))
    gone = keyed.sync_full_snapshot(table, _buyers(w).withColumn("run", F.lit(2)))
    named = lambda df, change: df.select(F.lit(change).alias("change"), "id")
    return named(gone, "removed").unionByName(named(table.current(), "kept"))


@query("""SELECT u.id, CASE WHEN b.id IS NULL THEN 1 ELSE 2 END AS run
FROM fx_usuario u LEFT JOIN (SELECT DISTINCT 'csv:' || CAST(o_custkey AS STRING) AS id FROM orders) b ON b.id = u.id""")
def sync_incremental(w: Workspace) -> DataFrame:
    table = _table(w, "incremental", "id")
    table.replace(w.usuario.select("id", F.lit(1).alias("run")))
    keyed.sync_incremental(table, _buyers(w).withColumn("run", F.lit(2)))
    table.compact()
    return table.current()


# Streams


def _envelope_files(w: Workspace) -> str:
    folder = scratch_path(w.spark, "envelopes")
    envelopes(w).repartition(4, "uuid").write.json(folder)
    return folder


@query(CURRENT_SQL)
def stream_job(w: Workspace) -> DataFrame:
    """The change log as files, one per micro-batch, into the current table."""
    state = stream.ChangeState(w.spark, scratch_path(w.spark, "state"))
    source = stream.scan_envelope_stream(w.spark, _envelope_files(w), max_files=1)
    stream.stream_job(
        source, state, scratch_path(w.spark, "checkpoint"), scratch_path(w.spark, "log"), None
    ).awaitTermination()
    return state.unpacked("core.users", {"id": "bigint", "k": "bigint"})


@query(CURRENT_SQL)
def stream_job_two_checkpoints(w: Workspace) -> DataFrame:
    """The change log dealt to two streams with a checkpoint each, on one state."""
    state = stream.ChangeState(w.spark, scratch_path(w.spark, "state"))
    half = F.xxhash64("uuid") % 2 == 0
    for chosen in (half, ~half):
        folder = scratch_path(w.spark, "envelopes")
        envelopes(w).filter(chosen).repartition(3, "uuid").write.json(folder)
        stream.stream_job(
            stream.scan_envelope_stream(w.spark, folder, max_files=1), state,
            scratch_path(w.spark, "checkpoint"), scratch_path(w.spark, "log"), None,
        ).awaitTermination()
    return state.unpacked("core.users", {"id": "bigint", "k": "bigint"})


@query(CURRENT_SQL)
def late_change(w: Workspace) -> DataFrame:
    """The newer half of the change log is merged before the older half."""
    state = stream.ChangeState(w.spark, scratch_path(w.spark, "state"))
    middle = w.changelog.agg(F.max("uuid") / 2).scalar()
    whole = envelopes(w).withColumn("late", F.col("uuid").cast("bigint") < middle)
    for batch, late in enumerate((False, True)):
        state.merge(whole.filter(F.col("late") == late).drop("late"), batch)
    return state.unpacked("core.users", {"id": "bigint", "k": "bigint"})


PROJECTED_SQL = """
WITH dated AS (SELECT p_partkey AS event_id,
  CAST(DATE '2024-01-01' + CAST(p_partkey % 365 AS INT) + CASE WHEN p_size > 40 THEN 1 ELSE 0 END AS TIMESTAMP) AS event_date FROM part),
paid AS (SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal >= 0 AND c_mktsegment IS NOT NULL),
c AS (""" + SOCIAL_SQL.replace("fx_day", "dated") + """)
SELECT 'users' AS part, CAST(c_custkey AS STRING) || '-' || CASE WHEN c_acctbal < 0 THEN 'gone' ELSE 'here' END AS key, 0E0 AS value FROM customer
UNION ALL SELECT 'events', CAST(event_id AS STRING) || '-' || substr(CAST(event_date AS STRING), 1, 10), 0E0 FROM dated
UNION ALL SELECT 'tables', CAST(s_suppkey AS STRING), 0E0 FROM supplier
UNION ALL SELECT 'purchases', CAST(ticket_id AS STRING) || '-' || CAST(event_id AS STRING), CAST(price_paid AS DOUBLE) FROM fx_purchases
UNION ALL SELECT 'attendances', CAST(ticket_id AS STRING) || '-' || CAST(event_id AS STRING), 0E0 FROM fx_attendances
UNION ALL SELECT 'reservations', CAST(reservation_id AS STRING) || '-' || CAST(event_id AS STRING), CAST(table_price AS DOUBLE) FROM fx_live_reservations
UNION ALL SELECT 'social_ties', CAST(user_1_id AS STRING) || '-' || CAST(user_2_id AS STRING) || '-'
  || substr(CAST(first_shared_event AS STRING), 1, 10) || '-' || substr(CAST(last_shared_event AS STRING), 1, 10), tie_strength FROM c
UNION ALL SELECT DISTINCT 'segments', c_mktsegment, 0E0 FROM paid
UNION ALL SELECT 'belongs', CAST(c_custkey AS STRING) || '-' || c_mktsegment, 0E0 FROM paid"""


def _delivered(name: str, df: DataFrame, time: str, deleted: bool = False) -> DataFrame:
    """A source table as envelopes with one time; payload values are text."""
    schema, table = name.split(".")
    keys = SOURCE_KEYS[name]
    at = F.lit(time).cast("timestamp")
    values = [part for column in df.columns for part in (F.lit(column), F.col(column).cast("string"))]
    return df.select(
        F.concat_ws("-", F.lit(name), *[F.col(key).cast("string") for key in keys], F.lit(time)).alias("uuid"),
        at.alias("source_timestamp"), at.alias("read_timestamp"),
        F.struct(
            F.lit(schema).alias("schema"), F.lit(table).alias("table"),
            F.array(*[F.lit(key) for key in keys]).alias("primary_keys"), F.lit(deleted).alias("is_deleted"),
            F.lit("UPDATE").alias("change_type"), F.lit("0/1").alias("lsn"),
        ).alias("source_metadata"),
        F.create_map(*values).alias("payload"),
    )


def _deliveries(w: Workspace) -> list[DataFrame]:
    """All source tables in three batches: first every ticket as a used one, then the tickets
    as they are, then users in debt deleted, long events a day later and, late, older
    dates of all events."""
    raw = w.source_tables
    both = lambda frames: reduce(DataFrame.unionByName, frames)
    tickets, events = raw["transactions.tickets"], raw["core.events"]
    date = F.col("event_date").cast("date")
    moved = w.table("part").filter("p_size > 40").select(F.col("p_partkey").alias("id")).join(events, "id")
    first = [_delivered(n, df, "2024-01-01") for n, df in raw.items() if n != "transactions.tickets"]
    return [
        both([*first, _delivered("transactions.tickets", tickets.withColumn("ticket_state_id", F.lit(2)), "2024-01-01")]),
        _delivered("transactions.tickets", tickets, "2024-02-01"),
        both([
            _delivered("core.users", raw["core.users"].join(
                w.table("customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("id")), "id", "left_semi"
            ), "2024-03-01", True),
            _delivered("core.events", moved.withColumn("event_date", F.date_add(date, 1)), "2024-03-01"),
            _delivered("core.events", events.withColumn("event_date", F.date_add(date, -9)), "2023-01-01"),
        ]),
    ]


@query(PROJECTED_SQL)
def project_after_batch(w: Workspace) -> DataFrame:
    """Every part of the projection after three batches of changes, the last one delivered
    twice."""
    state = stream.ChangeState(w.spark, scratch_path(w.spark, "state"))
    sink = scratch_path(w.spark, "projection")
    handle = stream.batch_handler(state, scratch_path(w.spark, "log"), stream.project_after_batch(state, sink))
    batches = [cut_lineage(batch, "delivery") for batch in _deliveries(w)]
    for number, batch in [*enumerate(batches), (len(batches) - 1, batches[-1])]:
        handle(batch, number)
    day = lambda name: F.substring(F.col(name).cast("string"), 1, 10)
    more = {
        "users": F.when(F.col("source_deleted"), "gone").otherwise("here"), "events": day("event_date"),
        "purchases": F.col("event_id"), "attendances": F.col("event_id"), "reservations": F.col("event_id"),
        "social_ties": F.concat_ws("-", day("first_shared_event"), day("last_shared_event")),
    }
    value = {"purchases": "price_paid", "reservations": "table_price", "social_ties": "tie_strength"}
    made = []
    for name, keys in PROJECTED_KEYS.items():
        key = [F.col(k).cast("string") for k in keys] + ([more[name].cast("string")] if name in more else [])
        amount = F.col(value[name]) if name in value else F.lit(0.0)
        made.append(stream.projected(w.spark, sink, name).select(
            F.lit(name).alias("part"), F.concat_ws("-", *key).alias("key"), amount.cast("double").alias("value")
        ))
    return reduce(DataFrame.unionByName, made)


@query("SELECT CAST(uuid AS STRING) AS uuid FROM fx_changelog WHERE uuid % 2 = 0")
def path_filter(w: Workspace) -> DataFrame:
    """The change log in two folders, of which the stream takes one."""
    folder, target = scratch_path(w.spark, "inbox"), scratch_path(w.spark, "taken")
    even = F.col("uuid").cast("bigint") % 2 == 0
    for name, chosen in (("keep", even), ("skip", ~even)):
        envelopes(w).filter(chosen).write.json(f"{folder}/{name}")
    source = stream.scan_envelope_stream(w.spark, folder, prefix="/keep/")
    (
        source.select("uuid").writeStream.format("parquet").option("path", target)
        .option("checkpointLocation", scratch_path(w.spark, "checkpoint"))
        .trigger(availableNow=True).start().awaitTermination()
    )
    return w.spark.read.parquet(target)


@query("""SELECT CAST(0 AS BIGINT) AS batch_id, 'empty' AS status, CAST(0 AS BIGINT) AS rows, CAST(0 AS BIGINT) AS changed_keys
UNION ALL SELECT 1, 'done', count(*), count(DISTINCT pk_id) FROM fx_changelog""")
def empty_batch_guard(w: Workspace) -> DataFrame:
    """An empty batch before the change log: it is logged and changes nothing."""
    state = stream.ChangeState(w.spark, scratch_path(w.spark, "state"))
    log = scratch_path(w.spark, "log")
    handle = stream.batch_handler(state, log)
    handle(envelopes(w).filter(F.lit(False)), 0)
    handle(envelopes(w), 1)
    return stream.batch_log(w.spark, log).select("batch_id", "status", "rows", "changed_keys")


@query("SELECT 'done' AS status, count(DISTINCT pk_id) AS changed_keys, count(*) AS rows FROM fx_changelog")
def batch_log(w: Workspace) -> DataFrame:
    state = stream.ChangeState(w.spark, scratch_path(w.spark, "state"))
    log = scratch_path(w.spark, "log")
    source = stream.scan_envelope_stream(w.spark, _envelope_files(w))
    stream.stream_job(source, state, scratch_path(w.spark, "checkpoint"), log, None).awaitTermination()
    return stream.batch_log(w.spark, log).groupBy("status").agg(
        F.sum("changed_keys").alias("changed_keys"), F.sum("rows").alias("rows")
    )


@query("""SELECT CAST(uuid AS STRING) AS uuid, pk_id AS id FROM fx_changelog WHERE uuid % 5 <> 0
UNION ALL SELECT CASE WHEN uuid % 2 = 0 THEN '' END, pk_id FROM fx_changelog WHERE uuid % 5 = 0
UNION ALL SELECT CASE WHEN uuid % 2 = 0 THEN '' END, pk_id FROM fx_changelog WHERE uuid % 5 = 0""")
def uuid_dedupe_bounded(w: Workspace) -> DataFrame:
    """Two deliveries of every envelope in one stream of several batches, whose events
    span months: once each, but for the fifth without an id, which all pass."""
    folder, target = scratch_path(w.spark, "envelopes"), scratch_path(w.spark, "deduped")
    number = F.col("uuid").cast("bigint")
    none = F.when(number % 2 == 0, F.lit(""))
    envelopes(w).withColumn("uuid", F.when(number % 5 == 0, none).otherwise(F.col("uuid"))).repartition(3).write.json(folder)
    source = stream.scan_envelope_stream(w.spark, folder, max_files=1)
    twice = source.unionByName(stream.scan_envelope_stream(w.spark, folder, max_files=2))
    flat = stream.uuid_dedupe_bounded(twice).select(
        "uuid", F.try_element_at("payload", F.lit("id")).cast("bigint").alias("id")
    )
    (
        flat.writeStream.format("parquet").option("path", target)
        .option("checkpointLocation", scratch_path(w.spark, "checkpoint"))
        .trigger(availableNow=True).start().awaitTermination()
    )
    return w.spark.read.parquet(target)


@query(CURRENT_SQL)
def state_merge_continuous(w: Workspace) -> DataFrame:
    """Improvements of each key as they come, the last one being current."""
    target = scratch_path(w.spark, "improved")
    source = stream.scan_envelope_stream(w.spark, _envelope_files(w), max_files=2)
    (
        stream.state_merge_continuous(source).writeStream.outputMode("update")
        .foreachBatch(lambda df, batch: df.write.mode("overwrite").parquet(f"{target}/{batch:09d}"))
        .option("checkpointLocation", scratch_path(w.spark, "checkpoint"))
        .trigger(availableNow=True).start().awaitTermination()
    )
    improved = w.spark.read.option("recursiveFileLookup", True).parquet(target)
    last = improved.groupBy("table", "pk").agg(
        F.max_by(F.struct("payload", "source_deleted"), "order").alias("row")
    )
    return _unpacked(last.select("row.*"))


# The batch job


SEED_ROWS_SQL = """
WITH u AS (SELECT 'csv:' || CAST(c_custkey AS STRING) AS id FROM customer),
e AS (SELECT 'csv:' || CAST(p_partkey AS STRING) AS id, p_size >= 25 AS vip, p_size > 16 AS sold,
             DATE '2024-01-01' + CAST(p_partkey % 365 AS INT) AS event_date FROM part),
a AS (SELECT DISTINCT 'csv:' || CAST(o_custkey AS STRING) AS user_id, e.id AS event_id, e.vip, e.event_date
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN e ON e.id = 'csv:' || CAST(l_partkey AS STRING) AND e.sold),
r AS (SELECT DISTINCT 'csv:' || CAST(o_custkey AS STRING) AS user_id, 'csv:' || CAST(l_suppkey AS STRING) AS table_id,
             'csv:' || CAST(l_partkey AS STRING) AS event_id
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
rp AS (SELECT x.user_id AS user_1, y.user_id AS user_2, count(*) AS n
       FROM r x JOIN r y ON x.event_id = y.event_id AND x.user_id < y.user_id GROUP BY 1, 2),
ap AS (SELECT x.user_id AS user_1, y.user_id AS user_2, count(*) AS n,
              sum(CASE WHEN x.vip THEN 1 ELSE 0 END) AS v
       FROM a x JOIN a y ON x.event_id = y.event_id AND x.user_id < y.user_id GROUP BY 1, 2)
SELECT 'usuarios' AS part, id AS key, 0E0 AS strength FROM u
UNION ALL SELECT 'eventos', id, 0E0 FROM e
UNION ALL SELECT 'mesas', 'csv:' || CAST(s_suppkey AS STRING), 0E0 FROM supplier
UNION ALL SELECT 'asistio_a', user_id || '|' || event_id, 0E0 FROM a
UNION ALL SELECT 'reservo', user_id || '|' || table_id || '|' || event_id, 0E0 FROM r
UNION ALL SELECT 'conoce_a', ap.user_1 || '|' || ap.user_2,
       round(ap.n + ap.v * 0.5E0 + coalesce(rp.n, 0) * 0.75E0, 3)
FROM ap LEFT JOIN rp ON rp.user_1 = ap.user_1 AND rp.user_2 = ap.user_2"""


def _stored(store: batch_job.GraphStore, names: tuple[str, ...]) -> DataFrame:
    """(part, key, strength) of every row of some tables."""
    made = None
    for name in names:
        table = store.table(name)
        strength = F.col("tie_strength") if name == batch_job.TIES else F.lit(0.0)
        rows = store.current(name).select(
            F.lit(name).alias("part"), F.concat_ws("|", *table.keys).alias("key"), strength.alias("strength")
        )
        made = rows if made is None else made.unionByName(rows)
    return made


@query(SEED_ROWS_SQL)
def etl_job_seed(w: Workspace) -> DataFrame:
    """All seed files through the batch job, twice; the second run finds nothing new."""
    folder = scratch_path(w.spark, "seed")
    raw = {
        "users": raw_users(w), "events": raw_events(w), "dico_tables": raw_tables(w),
        "tickets": raw_tickets(w), "type_tickets": raw_type_tickets(w), "reservations": raw_reservations(w),
    }
    for name, df in raw.items():
        df.write.csv(f"{folder}/{name}.csv", header=True)
    store = batch_job.GraphStore(w.spark, scratch_path(w.spark, "graph"))
    for _ in range(2):
        batch_job.etl_job_seed(store, folder)
    return _stored(store, ("usuarios", "eventos", "mesas", "asistio_a", "reservo", "conoce_a"))


FEED_ROWS_SQL = """
WITH u AS (SELECT 'v2:' || CAST(c_custkey AS STRING) AS id, c_name AS name FROM customer WHERE c_acctbal >= 0),
e AS (SELECT 'v2:' || CAST(p_partkey AS STRING) AS id,
             DATE '2024-01-01' + CAST(p_partkey % 365 AS INT) + CASE WHEN p_size > 40 THEN 1 ELSE 0 END AS event_date FROM part),
a AS (SELECT u.id AS user_id, e.id AS event_id, bool_or(t.unit_price >= 50000) AS vip, any_value(e.event_date) AS event_date
      FROM fx_tickets t JOIN u ON u.id = 'v2:' || CAST(t.user_id AS STRING)
           JOIN e ON e.id = 'v2:' || CAST(t.type_ticket_id AS STRING)
      WHERE t.ticket_state_id <> 3 GROUP BY u.id, e.id),
r AS (SELECT DISTINCT u.id AS user_id, 'v2:' || CAST(table_id AS STRING) AS table_id, 'v2:' || CAST(event_id AS STRING) AS event_id
      FROM fx_reservations b JOIN u ON u.id = 'v2:' || CAST(b.user_id AS STRING)),
rp AS (SELECT x.user_id AS user_1, y.user_id AS user_2, count(*) AS n
       FROM r x JOIN r y ON x.event_id = y.event_id AND x.user_id < y.user_id GROUP BY 1, 2),
ap AS (SELECT x.user_id AS user_1, y.user_id AS user_2, count(*) AS n, min(x.event_date) AS first,
              sum(CASE WHEN x.vip AND y.vip THEN 1 ELSE 0 END) AS v
       FROM a x JOIN a y ON x.event_id = y.event_id AND x.user_id < y.user_id GROUP BY 1, 2)
SELECT 'usuarios' AS part, id || '|' || name AS key, 0E0 AS strength FROM u
UNION ALL SELECT 'eventos', id || '|' || CAST(event_date AS STRING), 0E0 FROM e
UNION ALL SELECT 'asistio_a', user_id || '|' || event_id || '|' || CASE WHEN vip THEN 'vip' ELSE 'general' END, 0E0 FROM a
UNION ALL SELECT 'reservo', user_id || '|' || table_id || '|' || event_id, 0E0 FROM r
UNION ALL SELECT 'conoce_a', ap.user_1 || '|' || ap.user_2 || '|' || CAST(first AS STRING),
       round(ap.n + ap.v * 0.5E0 + coalesce(rp.n, 0) * 0.75E0, 3)
FROM ap LEFT JOIN rp ON rp.user_1 = ap.user_1 AND rp.user_2 = ap.user_2"""


def _feeds(w: Workspace) -> list[dict[str, DataFrame]]:
    """All tables as change files, then a second delivery: late old versions of all users,
    those in debt and cancelled tickets deleted, long events moved by a day."""
    at = lambda text: F.lit(text).cast("timestamp").alias("_dms_timestamp")
    kind = lambda name: F.lit(name).alias("Op")
    customer, part = w.table("customer"), w.table("part")
    user = lambda name, op, time: customer.select(
        kind(op), F.col("c_custkey").alias("id"), name.alias("username"), at(time)
    )
    date = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p_partkey") % 365).cast("int"))
    event = lambda moved, op, time: part.select(
        kind(op), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.date_add(date, moved).alias("event_date"), at(time), "p_size",
    )
    ticket = w.tickets.select(
        kind("I"), F.col("ticket_id").alias("id"), "user_id", F.col("type_ticket_id").alias("event_id"),
        F.when(F.col("unit_price") >= 50000, "vip").otherwise("general").alias("tier"), at("2024-01-01"), "ticket_state_id",
    )
    cancelled = ticket.filter("ticket_state_id = 3").select(
        kind("D"), "id", *[F.lit(None).cast(ticket.schema[name].dataType).alias(name) for name in ("user_id", "event_id", "tier")],
        at("2024-02-01"),
    )
    first = {
        "core.users": user(F.lit("before"), "I", "2024-01-01").unionByName(user(F.col("c_name"), "U", "2024-01-02")),
        "core.events": event(0, "I", "2024-01-01").drop("p_size"),
        "core.dico_tables": w.table("supplier").select(kind("I"), F.col("s_suppkey").alias("id"), at("2024-01-01")),
        "transactions.tickets": ticket.drop("ticket_state_id"),
        "transactions.reservations": w.reservations.select(
            kind("I"), F.col("reservation_id").alias("id"), "user_id", "table_id", "event_id", at("2024-01-01")
        ),
    }
    left = customer.filter("c_acctbal < 0").select(
        kind("D"), F.col("c_custkey").alias("id"), F.lit(None).cast("string").alias("username"), at("2024-03-01")
    )
    second = {
        "core.users": user(F.lit("late"), "U", "2023-01-01").unionByName(left),
        "core.events": event(1, "U", "2024-02-01").filter("p_size > 40").drop("p_size"),
        "transactions.tickets": cancelled,
    }
    return [first, second]


@query(FEED_ROWS_SQL)
def etl_job_feed(w: Workspace) -> DataFrame:
    """Two deliveries of change files through the batch job, the second announced with
    the first again."""
    store = batch_job.GraphStore(w.spark, scratch_path(w.spark, "graph"))
    announced: list[tuple[str]] = []
    for tables in _feeds(w):
        folder = scratch_path(w.spark, "feed")
        for name, df in tables.items():
            path = f"{folder}/data/{name.replace('.', '/')}/changes.parquet"
            df.write.parquet(path)
            announced.append((path,))
        batch_job.etl_job_feed(store, w.spark.createDataFrame(announced, "uri string"))
    made = _stored(store, ("reservo",))
    more = {"usuarios": "username", "eventos": "event_date", "asistio_a": "ticket_tier", "conoce_a": "first_shared_event"}
    for name, column in more.items():
        strength = F.col("tie_strength") if name == batch_job.TIES else F.lit(0.0)
        key = F.concat_ws("|", *store.table(name).keys, F.col(column).cast("string"))
        made = made.unionByName(
            store.current(name).select(F.lit(name).alias("part"), key.alias("key"), strength.alias("strength"))
        )
    return made
