"""Purchase, attendance, reservation and segment edges from prepared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieweave.operators.merge import one_per_key
from tieweave.operators.prepare import active_only
from tieweave.session import sent_whole

# Names of states as the rules use them, in lower case.
VERIFIED, APPROVED, CANCELLED, USED = "verified", "approved", "cancelled", "used"
LIVE_RESERVATIONS = ("pending", "confirmed", "completed")


def state_lookup(df: DataFrame, states: DataFrame, state_id: str, name: str = "state") -> DataFrame:
    """Adds the lower-case name of a state; an unknown state gives its id as text.

    The catalogue is sent to all executors when its counted rows allow it: a join by
    shuffle would put all rows onto as many keys as there are states.
    """
    names = (
        one_per_key(states.select("id", "name").dropna(), ["id"])
        .select(F.col("id").cast("bigint").alias(state_id), F.lower("name").alias(name))
    )
    fallback = F.lower(F.col(state_id).cast("string"))
    return df.join(sent_whole(names, names.count()), state_id, "left").withColumn(name, F.coalesce(name, fallback))


def _live(df: DataFrame, keys: list[str], *columns: str) -> DataFrame:
    """The live row of each key, with only the columns that are read afterwards."""
    deleted = ["source_deleted"] if "source_deleted" in df.columns else []
    return active_only(df.select(*keys, *columns, *deleted), keys).select(*keys, *columns)


def ticket_purchase_edges(
    tickets: DataFrame, type_tickets: DataFrame, order_details: DataFrame, orders: DataFrame,
    payments: DataFrame, ticket_states: DataFrame,
) -> DataFrame:
    """One row per ticket of an approved order with a verified payment."""
    verified = _live(payments, ["payment_id"], "order_id", "status").filter(F.lower("status") == VERIFIED)
    approved = (
        _live(orders, ["order_id"], "status", "updated_at")
        .filter(F.lower("status") == APPROVED)
        .select("order_id", F.col("updated_at").alias("approved_at"))
        .join(verified.select("order_id"), "order_id", "left_semi")
    )
    details = _live(order_details, ["order_detail_id"], "ticket_id", "order_id", "unit_price", "discount")
    catalogue = _live(type_tickets, ["type_ticket_id"], "event_id", "ticket_tier", "price")
    bought = (
        _live(tickets, ["ticket_id"], "user_id", "type_ticket_id", "ticket_state_id")
        .join(details.drop("order_detail_id"), "ticket_id")
        .join(approved, "order_id")
        .join(catalogue, "type_ticket_id")
    )
    paid = F.coalesce("unit_price", "price") - F.coalesce("discount", F.lit(0.0))
    kept = (
        state_lookup(bought, ticket_states, "ticket_state_id")
        .filter(F.coalesce("state", F.lit("")) != CANCELLED)
        .select(
            "user_id", "event_id", "ticket_id", "type_ticket_id", "ticket_tier", "order_id",
            "approved_at", paid.alias("price_paid"), "ticket_state_id",
        )
    )
    return one_per_key(kept, ["ticket_id"])


def attendance_edges(
    tickets: DataFrame, type_tickets: DataFrame, ticket_states: DataFrame
) -> DataFrame:
    """Used tickets of known types, with the time of use."""
    catalogue = _live(type_tickets, ["type_ticket_id"], "event_id")
    live = _live(
        tickets, ["ticket_id"], "user_id", "type_ticket_id", "ticket_state_id", "updated_at", "created_at"
    )
    return (
        state_lookup(live, ticket_states, "ticket_state_id")
        .filter(F.col("state") == USED)
        .join(catalogue, "type_ticket_id")
        .select(
            "user_id", "event_id", "ticket_id", "type_ticket_id",
            F.coalesce("updated_at", "created_at").alias("used_at"),
        )
    )


def reservation_edges(
    reservations: DataFrame, tables: DataFrame, table_prices: DataFrame,
    reservation_states: DataFrame,
) -> DataFrame:
    """Live reservations of known tables, with the table's price for the event."""
    prices = _live(table_prices, ["table_id", "event_id"], "price").withColumnRenamed("price", "table_price")
    known = _live(tables, ["table_id"])
    live = _live(
        reservations, ["reservation_id"], "user_id", "table_id", "event_id", "reservation_state_id",
        "reserved_at", "expires_at",
    )
    return (
        state_lookup(live, reservation_states, "reservation_state_id")
        .filter(F.col("state").isin(*LIVE_RESERVATIONS))
        .join(known, "table_id", "left_semi")
        .join(prices, ["table_id", "event_id"], "left")
        .select(
            "user_id", "table_id", "reservation_id", "event_id", "table_price",
            "reservation_state_id", "reserved_at", "expires_at",
        )
    )


def _segmented(users: DataFrame) -> DataFrame:
    return users.filter(~F.coalesce("source_deleted", F.lit(False))).dropna(
        subset=["rfm_seed_segment"]
    )


def segment_nodes(users: DataFrame) -> DataFrame:
    return _segmented(users).select(F.col("rfm_seed_segment").alias("name")).distinct().orderBy("name")


def belongs_edges(users: DataFrame) -> DataFrame:
    return _segmented(users).select("user_id", F.col("rfm_seed_segment").alias("segment_name"))
