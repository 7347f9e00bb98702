"""Normalizers, merge, change reduction and the projection: known answers."""

import json

import pytest
from pyspark.sql import functions as F

from tieweave import schemas
from tieweave.functions.columns import epoch_millis, log_position, namespaced, normalize_op
from tieweave.operators import changes, edges, export, merge, prepare
from tieweave.operators.normalize_cdc import normalize_v2
from tieweave.operators.normalize_seed import lenient_normalize, normalize_csv, table_types
from tieweave.plans.bundle import projection_bundle, projection_counts
from tieweave.sources import files
from tieweave.streaming.changes import ENVELOPE


@pytest.fixture
def seed(spark):
    make = spark.createDataFrame
    return {
        "users": make(
            [("41", "m41", "marisol", "0.35", "strong"), ("42", None, "teodoro", "", "0.8"),
             (None, "g0", "ghost", "0.2", "0.3")],
            "id string, telegram_id string, username string, vip_affinity string, invite_power string",
        ),
        "events": make(
            [("701", "Terraza", "2025-11-08", "20", "3"), ("702", "Brunch", "2025-11-09", "7", "open"),
             ("703", "Undated", "8 of November", "20", None), ("704", "Unclocked", "2025-11-10", None, "1")],
            "id string, name string, event_date string, start_hour_bucket string, event_state string",
        ),
        "tickets": make(
            [("41", "9001"), ("42", "9002"), ("42", "9001"), ("41", "9777")], "user_id string, type_ticket_id string"
        ),
        "type_tickets": make(
            [("9001", "701", "palco"), ("9002", "702", "pista")], "id string, event_id string, ticket_tier string"
        ),
        "dico_tables": make(
            [("61", "12", "8", "0.51", "palco"), ("62", "13", "many", "0.4", "barra"), ("63", "14", "3", "?", None)],
            "id string, number string, capacity string, vip_suitability string, table_type_name string",
        ),
        "reservations": make(
            [("42", "61", "702"), ("41", "63", "701")], "user_id string, table_id string, event_id string"
        ),
        "segments": make([("Fieles", "come back")], "segment_name string, description string"),
        "user_segments": make([("41", "Fieles"), ("42", "Fieles")], "user_id string, segment_name string"),
    }


def test_seed_tables(seed):
    made = normalize_csv(seed)
    assert set(made) == set(schemas.CANONICAL)
    for name, df in made.items():
        fields = schemas.parse_fields(schemas.CANONICAL[name])
        assert [(f[0], f[1]) for f in fields] == df.dtypes
        assert all(row["source"] == "csv" for row in df.collect())
    users = {row["id"]: (row["vip_affinity"], row["invite_power"]) for row in made["usuarios"].collect()}
    assert users == {"csv:41": (0.35, None), "csv:42": (None, 0.8)}
    events = {row["id"]: row for row in made["eventos"].collect()}
    starts = {key: row["start_time"] and str(row["start_time"]) for key, row in events.items()}
    assert starts == {
        "csv:701": "2025-11-08 20:00:00", "csv:702": "2025-11-09 07:00:00", "csv:703": None, "csv:704": None,
    }
    assert [events[f"csv:{n}"]["event_state_id"] for n in (701, 702, 703, 704)] == [3, None, None, 1]
    assert events["csv:703"]["event_date"] is None
    mesas = {row["id"]: (row["capacity"], row["is_vip"]) for row in made["mesas"].collect()}
    assert mesas == {"csv:61": (8, True), "csv:62": (None, False), "csv:63": (3, None)}
    kinds = {row["id"]: row["table_type"] for row in table_types(seed["dico_tables"]).collect()}
    assert kinds == {"csv:61": "palco", "csv:62": "barra", "csv:63": None}
    attended = sorted((r["user_id"], r["event_id"], r["ticket_tier"]) for r in made["asistio_a"].collect())
    assert attended == [
        ("csv:41", "csv:701", "palco"), ("csv:42", "csv:701", "palco"), ("csv:42", "csv:702", "pista"),
    ]
    booked = sorted((r["user_id"], r["table_id"], r["event_id"]) for r in made["reservo"].collect())
    assert booked == [("csv:41", "csv:63", "csv:701"), ("csv:42", "csv:61", "csv:702")]


def test_seed_without_optional_tables(seed):
    made = normalize_csv({name: seed[name] for name in ("users", "events", "tickets")})
    assert set(made) == {"usuarios", "eventos"}


def test_rejected_rows_are_reported(seed):
    shaped = seed["users"].select(namespaced("id", "csv").alias("id"), F.lit("csv").alias("source"))
    assert [row["missing"] for row in schemas.rejected(shaped, "usuarios").collect()] == [["id"]]


def test_lenient_rules(spark):
    make = spark.createDataFrame
    made = lenient_normalize({
        "users": make([(" 1 ", "  ")], "id string, username string"),
        "events": make([("1", " 2026-01-15", " 7 ")], "id string, event_date string, start_hour_bucket string"),
        "dico_tables": make([("1", "")], "id string, vip_suitability string"),
        "attendance_seed": make(
            [("1", "2", "vip "), ("", "2", "vip"), ("1", " ", None)],
            "user_id string, event_id string, ticket_tier string",
        ),
        "tickets": make([("9", "9")], "user_id string, event_id string"),
        "reservations": make(
            [("1", "3", ""), ("1", "", "4")], "user_id string, table_id string, event_id string"
        ),
    })
    assert made["usuarios"].first()["username"] is None
    assert str(made["eventos"].first()["start_time"]) == "2026-01-15 07:00:00"
    assert made["mesas"].first()["is_vip"] is False
    assert [tuple(r) for r in made["asistio_a"].collect()] == [("csv:1", "csv:2", "vip", "csv")]
    assert [tuple(r) for r in made["reservo"].collect()] == [("csv:1", "csv:3", None, "csv")]


def test_change_feed_tables(spark):
    make = spark.createDataFrame
    raw = {
        "core.users": make([(100, "bob", "1.0")], "id long, username string, vip_affinity string"),
        "core.events": make(
            [("200", "Electro", "2026-02-10T23:00:00")], "id string, event_name string, start_time string"
        ),
        "core.dico_tables": make([("7", "12", None)], "id string, number string, event_id string"),
        "transactions.tickets": make([("100", "200", "general")], "user_id string, event_id string, tier string"),
        "transactions.reservations": make([("100", "7")], "user_id string, table_id string"),
    }
    made = normalize_v2(raw)
    user = made["usuarios"].first()
    assert (user["id"], user["username"], user["telegram_id"], user["vip_affinity"]) == ("v2:100", "bob", None, None)
    event = made["eventos"].first()
    assert (event["name"], str(event["start_time"]), event["event_date"]) == ("Electro", "2026-02-10 23:00:00", None)
    assert made["mesas"].first()["table_number"] == 12 and made["mesas"].first()["event_id"] is None
    assert made["asistio_a"].first()["ticket_tier"] == "general"
    assert made["reservo"].first()["event_id"] is None
    without = normalize_v2({"transactions.tickets": make([("1", "2")], "user_id string, type_ticket_id string")})
    assert without == {}


def test_merge_keeps_one_row_by_priority(spark):
    make = lambda rows: spark.createDataFrame(rows, "id string, username string, source string")
    first, second = make([("1", "a", "csv")]), make([("1", "b", "v2"), ("2", "c", "v2")])
    one_way = merge.merge_canonical({"usuarios": first}, {"usuarios": second, "mesas": first})
    assert sorted(tuple(r) for r in one_way["usuarios"].collect()) == [("1", "a", "csv"), ("2", "c", "v2")]
    assert one_way["mesas"].count() == 1
    other = merge.merge_canonical({"usuarios": second}, {"usuarios": first})
    assert {r["id"]: r["username"] for r in other["usuarios"].collect()} == {"1": "b", "2": "c"}


def test_reservation_key_option(spark):
    rows = [("u", "t", "e1", "csv"), ("u", "t", "e2", "csv")]
    df = spark.createDataFrame(rows, "user_id string, table_id string, event_id string, source string")
    both = {"reservo": df}
    assert merge.merge_canonical(both, both)["reservo"].count() == 2
    pair = {"reservo": merge.PAIR_ONLY_KEY}
    assert merge.merge_canonical(both, both, pair)["reservo"].count() == 1


def test_unique_keys(spark):
    df = spark.createDataFrame([("1",), ("1",), ("2",)], "id string")
    assert [tuple(r) for r in merge.unique_key_check(df, ["id"]).collect()] == [("1", 2)]
    with pytest.raises(ValueError):
        merge.require_unique(df, ["id"])


def one(spark, value, column, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(column(df).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "given, expected",
    [(" c ", "INSERT"), ("I", "INSERT"), ("r", "INSERT"), ("insert", "INSERT"), ("u", "UPDATE"),
     ("Update", "UPDATE"), ("d", "DELETE"), ("DELETE", "DELETE"), ("truncate", "TRUNCATE"), (None, "")],
)
def test_normalize_op(spark, given, expected):
    assert one(spark, given, lambda df: normalize_op("x")) == expected


@pytest.mark.parametrize(
    "given, expected",
    [("0/10", 16), ("1/0", 2**32), (" A/FF ", 10 * 2**32 + 255), ("FFFFFFFF/FFFFFFFF", 2**64 - 1),
     ("abc", -1), ("", -1), (None, -1), ("x/y", -1), ("1/", -1)],
)
def test_log_position(spark, given, expected):
    assert int(one(spark, given, lambda df: log_position("x"))) == expected


@pytest.mark.parametrize(
    "given, kind, expected",
    [("1700000000000", "string", 1700000000000), ("1970-01-01T00:00:01", "string", 1000),
     ("1970-01-01T00:00:01Z", "string", 1000), ("1970-01-01T02:00:01+02:00", "string", 1000),
     ("1970-01-02", "string", 86400000), ("junk", "string", -1), ("", "string", -1),
     (None, "string", -1), (12, "long", 12), (None, "timestamp", -1)],
)
def test_epoch_millis(spark, given, kind, expected):
    assert one(spark, given, lambda df: epoch_millis(df, "x"), kind) == expected


LOG = "op string, source_ts string, pk string, after string, before string, lsn string, uuid string"


def test_insert_then_delete_leaves_a_tombstone(spark):
    rows = [
        ("INSERT", "2026-05-05T00:00:00", '{"id": 1}', '{"id": 1, "username": "A"}', None, None, "a"),
        ("DELETE", "2026-05-05T01:00:00", '{"id": 1}', None, '{"id": 1, "username": "A"}', None, "b"),
    ]
    for order in (rows, rows[::-1]):
        current = changes.reduce_cdc_to_current(spark.createDataFrame(order, LOG), "users")
        flat = changes.unpack_image(current, {"id": "bigint", "username": "string"}).collect()
        assert [(r["id"], r["username"], r["source_deleted"]) for r in flat] == [(1, "A", True)]


def test_ties_are_broken_by_position_then_event_and_null_time_loses(spark):
    rows = [
        ("u", None, "", '{"id": 1, "v": "none"}', None, "F/F", "z"),
        ("u", "2026-01-01", None, '{"id": 1, "v": "old"}', None, "0/1", "z"),
        ("u", "2026-01-01", None, '{"id": 1, "v": "new"}', None, "0/2", "a"),
        ("u", "2026-01-01", '{"id": 2}', '{"id": 9, "v": "x"}', None, None, "a"),
        ("u", "2026-01-01", '{"id": 2}', '{"id": 9, "v": "y"}', None, None, "b"),
    ]
    current = changes.reduce_cdc_to_current(spark.createDataFrame(rows, LOG), "core.users")
    flat = changes.unpack_image(current, {"id": "bigint", "v": "string"}).orderBy("id").collect()
    assert [(r["id"], r["v"]) for r in flat] == [(1, "new"), (2, "y")]


def test_composite_key_map_images_and_bad_images(spark):
    schema = "op string, source_ts string, after map<string,string>"
    log = spark.createDataFrame(
        [("i", "2026-01-01", {"table_id": "1", "event_id": "2", "price": "3"}),
         ("u", "2026-01-02", {"table_id": "1", "event_id": "2", "price": "4"})], schema,
    )
    current = changes.reduce_streams_to_current({"table_prices": log})["core.table_prices"].collect()
    assert [(r["table_id"], r["event_id"], r["image"]["price"]) for r in current] == [("1", "2", "4")]
    broken = spark.createDataFrame([("u", "2026-01-01", "{}", "[1]", None, None, "a")], LOG)
    with pytest.raises(Exception, match="unreadable image"):
        changes.reduce_cdc_to_current(broken, "users").collect()
    with pytest.raises(ValueError):
        changes.reduce_cdc_to_current(log, "unknown.table")


def test_unsound_changes_are_set_aside_or_stop_the_job(spark):
    rows = [
        ("i", "2026-01-01", None, '{"id": 1, "v": "a"}', None, None, "a"),
        ("u", "2026-01-02", None, "[1]", None, None, "b"),
        ("u", "2026-01-03", None, '{"v": "c"}', None, None, "c"),
        ("u", "2026-01-04", None, '{"v": "d"}', None, None, "d"),
    ]
    log = spark.createDataFrame(rows, LOG)
    current, rejected = changes.reduce_cdc_with_rejected(log, "users")
    assert [r["id"] for r in current.collect()] == ["1"]
    assert sorted((r["uuid"], r["problem"]) for r in rejected.collect()) == [
        ("b", "unreadable image"), ("c", "no key value"), ("d", "no key value")
    ]
    assert rejected.columns == [*log.columns, "problem"]
    with pytest.raises(Exception, match="change with"):
        changes.reduce_cdc_to_current(log, "users").collect()


def envelope(spark, *rows):
    import datetime as dt

    made = [
        (uuid, dt.datetime(2026, 1, day) if day else None, dt.datetime(2026, 2, 1), meta, payload)
        for uuid, day, meta, payload in rows
    ]
    return spark.createDataFrame(made, ENVELOPE)


def meta(table="users", keys=None, deleted=False, lsn="0/1", schema="core"):
    return (schema, table, keys, deleted, "UPDATE", lsn)


def test_envelopes(spark):
    df = envelope(
        spark,
        ("a", 2, meta(), {"id": "1", "name": "late"}),
        ("a", 2, meta(), {"id": "1", "name": "late"}),
        ("b", 1, meta(), {"id": "1", "name": "early"}),
        ("c", None, meta(lsn="F/F"), {"id": "1", "name": "undated"}),
        ("", 3, meta("people", ["code"], True), {"code": "x"}),
        ("", 3, meta("people", ["code"]), {"code": "x"}),
        ("d", 3, meta(None), {"id": "7"}),
    )
    assert changes.dedupe_uuid(df).count() == 6
    current = {(r["table"], r["pk"]): r for r in changes.envelope_ingest(df).collect()}
    assert set(current) == {("core.users", '["1"]'), ("core.people", '["x"]')}
    assert current["core.users", '["1"]']["payload"]["name"] == "late"
    bad = envelope(spark, ("e", 1, meta(), {"name": "no key"}), ("f", 1, meta("unknown"), {"id": "1"}))
    assert changes.unkeyed_envelopes(bad).count() == 2
    with pytest.raises(Exception, match="without key"):
        changes.envelope_ingest(bad).collect()


def test_latest_by_commit(spark):
    rows = [("1", "a", "I", "2026-01-01"), ("1", "b", "U", "2026-01-03"), ("2", "c", "D", "2026-01-02"), ("2", "c", "I", "2026-01-01")]
    df = spark.createDataFrame(rows, "id string, v string, Op string, _dms_timestamp string")
    found = changes.latest_by_commit_ts(df, ["id"]).collect()
    assert sorted((r["id"], r["v"], r["source_deleted"]) for r in found) == [("1", "b", False), ("2", "c", True)]


@pytest.fixture
def snapshot(spark):
    """Three people, two nights: the first night all three are there, two of them by a
    purchase that counts, and two hold tables; the second night only two are there."""
    make = spark.createDataFrame

    def rows(columns, *items):
        made = make([(*item, False) for item in items], f"{columns}, source_deleted boolean")
        return made

    return {
        "core.users": rows(
            "id long, username string, telegram_id long, rfm_seed_segment string",
            (7, "iria", 8807, "leales"), (8, "breixo", 8808, "nuevos"), (9, "uxia", None, None),
        ),
        "core.events": rows(
            "id long, name string, event_date string, event_state_id long",
            (51, "Magosto", "2025-11-11", 4), (52, "Entroido", "2026-02-17", 4),
        ),
        "core.dico_tables": rows(
            "id long, number long, table_type_name string, capacity long", (3, 30, "palco", 10), (4, 40, "barra", 2)
        ),
        "core.type_tickets": rows(
            "id long, event_id long, ticket_tier string, price double", (81, 51, "Pista", 18.5), (82, 52, "Palco", 45.0)
        ),
        "core.table_prices": rows("table_id long, event_id long, price double", (3, 51, 260.0), (4, 52, 75.5)),
        "transactions.orders": rows(
            "id long, status string, updated_at string", (601, "APPROVED", "2025-11-01T09:30:00"),
            (602, "approved", "2025-11-02T18:00:00"), (603, "rejected", "2025-11-03T08:15:00"),
            (604, "approved", "2026-02-01T12:00:00"),
        ),
        "transactions.order_details": rows(
            "id long, order_id long, ticket_id long, unit_price double, discount double",
            (1, 601, 910, 20.0, 2.5), (2, 602, 911, None, None), (3, 603, 912, 18.5, 0.0), (4, 604, 913, 40.0, None),
            (5, 604, 914, 40.0, 5.0),
        ),
        "transactions.tickets": rows(
            "id long, user_id long, type_ticket_id long, ticket_state_id long, updated_at string",
            (910, 7, 81, 1, "2025-11-11T22:05:00"), (911, 8, 81, 1, "2025-11-11T22:40:00"),
            (912, 9, 81, 1, "2025-11-11T23:00:00"), (913, 7, 82, 1, "2026-02-17T23:30:00"),
            (914, 8, 82, 5, "2026-02-10T10:00:00"), (915, 9, 82, 1, "2026-02-18T00:10:00"),
        ),
        "transactions.reservations": rows(
            "id long, reservation_state_id long, user_id long, table_id long, event_id long",
            (71, 1, 7, 3, 51), (72, 2, 9, 3, 51), (73, 6, 8, 3, 51), (74, 1, 8, 4, 51),
        ),
        "transactions.payments": rows(
            "id long, order_id long, status string", (31, 601, "Verified"), (32, 602, "verified"),
            (33, 603, "verified"), (34, 604, "pending"),
        ),
        "catalog.ticket_states": make([(1, "USED"), (5, "Cancelled")], "id long, name string"),
        "catalog.reservation_states": make(
            [(1, "Pending"), (2, "completed"), (6, "expired")], "id long, name string"
        ),
    }


def test_projection(spark, snapshot):
    bundle = projection_bundle(spark, snapshot)
    # 910: 20 less 2.5; 911: the type's price. 603 was rejected, 604 is not paid yet.
    paid = {r["ticket_id"]: r["price_paid"] for r in bundle.purchases.collect()}
    assert paid == {910: 17.5, 911: 18.5}
    assert sorted(r["ticket_id"] for r in bundle.attendances.collect()) == [910, 911, 912, 913, 915]
    booked = {r["reservation_id"]: r["table_price"] for r in bundle.reservations.collect()}
    assert booked == {71: 260.0, 72: 260.0, 74: None}
    ties = {
        (r["user_1_id"], r["user_2_id"]): (
            r["shared_attendances"], r["shared_purchases"], r["shared_reservations"], r["tie_strength"],
        )
        for r in bundle.social_ties.collect()
    }
    # A shared attendance counts 1, a reservation 0.75, a purchase 0.25.
    assert ties == {(7, 8): (1, 1, 1, 2.0), (7, 9): (2, 0, 1, 2.75), (8, 9): (1, 0, 1, 1.75)}
    assert [r["name"] for r in bundle.segments.collect()] == ["leales", "nuevos"]
    assert sorted(r["user_id"] for r in bundle.belongs.collect()) == [7, 8]
    counts = {r["part"]: r["rows"] for r in projection_counts(bundle).collect()}
    assert counts == {"users": 3, "events": 2, "tables": 2, "purchases": 2, "attendances": 5,
                      "reservations": 3, "social_ties": 3}


def test_projection_of_partial_input(spark, snapshot):
    part = {name: snapshot[name].drop("telegram_id") for name in ("core.users", "core.events", "core.dico_tables")}
    bundle = projection_bundle(spark, part)
    assert "vip_affinity" in bundle.users.columns and "vip_suitability" in bundle.tables.columns
    assert bundle.purchases.count() == 0 and bundle.social_ties.count() == 0
    without = projection_bundle(spark, {k: v for k, v in snapshot.items() if k not in ("core.table_prices", "transactions.payments")})
    assert without.purchases.count() == 0
    assert {r["table_price"] for r in without.reservations.collect()} == {None}


def test_tombstones(spark, snapshot):
    gone = snapshot["transactions.tickets"].withColumn("source_deleted", F.col("id").isin(911, 913))
    users = snapshot["core.users"].withColumn("source_deleted", F.col("id") == 8)
    bundle = projection_bundle(spark, {**snapshot, "transactions.tickets": gone, "core.users": users})
    assert sorted(r["ticket_id"] for r in bundle.attendances.collect()) == [910, 912, 915]
    assert [r["user_id"] for r in bundle.belongs.collect()] == [7]
    ties = {(r["user_1_id"], r["user_2_id"]): r["tie_strength"] for r in bundle.social_ties.collect()}
    assert ties == {(7, 8): 0.75, (7, 9): 1.75, (8, 9): 0.75}


def test_tier_falls_back_to_name_only_when_no_tier_is_known(spark):
    rows = [(1, None, "General"), (2, None, "VIP")]
    df = spark.createDataFrame(rows, "id long, ticket_tier string, name string")
    assert [r["ticket_tier"] for r in prepare.prepare_type_tickets(df).orderBy("type_ticket_id").collect()] == ["general", "vip"]
    known = spark.createDataFrame([*rows, (3, "Gold", "x")], "id long, ticket_tier string, name string")
    assert [r["ticket_tier"] for r in prepare.prepare_type_tickets(known).orderBy("type_ticket_id").collect()] == [None, None, "gold"]


def test_unknown_state_falls_back_to_its_id(spark, snapshot):
    tickets = spark.createDataFrame([(10, 5), (11, 88), (12, None)], "ticket_id long, ticket_state_id long")
    found = edges.state_lookup(tickets, snapshot["catalog.ticket_states"], "ticket_state_id")
    assert {r["ticket_id"]: r["state"] for r in found.collect()} == {10: "cancelled", 11: "88", 12: None}


def test_export_has_null_for_missing_and_plain_values(spark, snapshot):
    users = prepare.prepare_users(snapshot["core.users"].drop("rfm_seed_segment"))
    record = json.loads(export.export_records(users).first()["record"])
    assert record["vip_affinity"] is None and record["mixing_score"] is None
    df = spark.sql("SELECT double('NaN') AS a, 1.50BD AS b, date'2026-01-02' AS c, timestamp_ntz'2026-01-02 03:04:05' AS d")
    assert json.loads(export.export_records(df).first()["record"]) == {
        "a": None, "b": 1.5, "c": "2026-01-02", "d": "2026-01-02T03:04:05"
    }
    deep = spark.sql("""SELECT timestamp_ntz'2026-01-02 01:02:03.456789' AS t, array(1.5D, double('NaN')) AS a,
        named_struct('d', date'2026-01-02', 'n', array(named_struct('x', float('NaN'), 'y', 2.50BD))) AS s,
        map('k', timestamp_ntz'2026-01-02 00:00:00.5') AS m, cast(null AS struct<q: double>) AS z""")
    assert json.loads(export.export_records(deep).first()["record"]) == {
        "t": "2026-01-02T01:02:03.456789", "a": [1.5, None],
        "s": {"d": "2026-01-02", "n": [{"x": None, "y": 2.5}]}, "m": {"k": "2026-01-02T00:00:00.500000"}, "z": None,
    }
    flags = spark.createDataFrame([("x", None)], "number string, source_deleted string")
    assert tuple(export.typed_property_cast(flags, {"number": "bigint", "source_deleted": "boolean"}).first()) == (None, False)


def test_manifest(spark):
    messages = [
        json.dumps({"bucket": "b", "key": "data/core/users/1.parquet"}), "s3://b/data/core/users/1.parquet",
        "", None, "hello", "s3://b/data/public/awsdms_status/1.parquet", json.dumps({"bucket": "b"}), "{broken",
        "s3://b/elsewhere.parquet",
    ]
    df = spark.createDataFrame([(m,) for m in messages], "message string")
    found = files.cdc_manifest(df).select("uri", files.table_key(files.hadoop_uri("uri")).alias("t"))
    assert {r["uri"]: r["t"] for r in found.collect()} == {
        "s3://b/data/core/users/1.parquet": "core.users",
        "s3://b/elsewhere.parquet": "s3a://b/elsewhere.parquet",
    }
