"""The whole projection: every node and edge table from the current tables."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tieweave.operators import edges, prepare
from tieweave.operators.ties import social_ties
from tieweave.schemas import resolve_table_name
from tieweave.session import cut_lineage


@dataclass
class ProjectionBundle:
    """The parts of a projection; those that were not asked for are None."""

    users: DataFrame | None = None
    events: DataFrame | None = None
    tables: DataFrame | None = None
    purchases: DataFrame | None = None
    attendances: DataFrame | None = None
    reservations: DataFrame | None = None
    social_ties: DataFrame | None = None
    segments: DataFrame | None = None
    belongs: DataFrame | None = None

    def named(self) -> dict[str, DataFrame]:
        parts = {part.name: getattr(self, part.name) for part in fields(self)}
        return {name: df for name, df in parts.items() if df is not None}


# Keys of the projected tables.
PROJECTED_KEYS = {
    "users": ("user_id",), "events": ("event_id",), "tables": ("table_id",),
    "purchases": ("ticket_id",), "attendances": ("ticket_id",), "reservations": ("reservation_id",),
    "social_ties": ("user_1_id", "user_2_id"), "segments": ("name",),
    "belongs": ("user_id", "segment_name"),
}

# The columns an absent source table is taken to have.
ABSENT = {
    "core.users": "id bigint",
    "core.events": "id bigint",
    "core.dico_tables": "id bigint",
    "core.type_tickets": "id bigint",
    "core.table_prices": "table_id bigint, event_id bigint, price double",
    "transactions.orders": "id bigint",
    "transactions.order_details": "id bigint",
    "transactions.tickets": "id bigint",
    "transactions.reservations": "id bigint",
    "transactions.payments": "id bigint",
    "catalog.ticket_states": "id bigint, name string",
    "catalog.reservation_states": "id bigint, name string",
}


# The source tables that each part is made of; ties come from other parts.
PART_SOURCES = {
    "users": {"core.users"}, "events": {"core.events"}, "tables": {"core.dico_tables"},
    "purchases": {
        "transactions.tickets", "core.type_tickets", "transactions.order_details", "transactions.orders",
        "transactions.payments", "catalog.ticket_states",
    },
    "attendances": {"transactions.tickets", "core.type_tickets", "catalog.ticket_states"},
    "reservations": {
        "transactions.reservations", "core.dico_tables", "core.table_prices", "catalog.reservation_states",
    },
    "segments": {"core.users"}, "belongs": {"core.users"},
}
#: The parts that ties are made of.
TIED_PARTS = ("purchases", "attendances", "reservations", "events")


def projection_bundle(
    spark: SparkSession, current: dict[str, DataFrame], wanted: set[str] | None = None
) -> ProjectionBundle:
    """Nodes and edges; tables that are missing count as empty ones. ``wanted`` names the
    parts to make, all by default; ties need ``TIED_PARTS`` beside them.

    The three booking edges are written once, as the ties are built from them.
    Deleted events keep their date and deleted users their edges, as in the
    pairing rules.
    """
    named = {resolve_table_name(name): df for name, df in current.items()}
    table = lambda name: named[name] if name in named else spark.createDataFrame([], ABSENT[name])
    asked = lambda *parts: wanted is None or not wanted.isdisjoint(parts)
    made = ProjectionBundle()
    if asked("users", "segments", "belongs"):
        users = prepare.prepare_users(table("core.users"))
        made.users = users if asked("users") else None
        made.segments = edges.segment_nodes(users) if asked("segments") else None
        made.belongs = edges.belongs_edges(users) if asked("belongs") else None
    if asked("events"):
        made.events = prepare.prepare_events(table("core.events"))
    if asked("tables", "reservations"):
        tables = prepare.prepare_tables(table("core.dico_tables"))
        made.tables = tables if asked("tables") else None
    if asked("purchases", "attendances"):
        type_tickets = prepare.prepare_type_tickets(table("core.type_tickets"))
        tickets = prepare.prepare_tickets(table("transactions.tickets"))
        ticket_states = table("catalog.ticket_states")
    if asked("purchases"):
        made.purchases = cut_lineage(edges.ticket_purchase_edges(
            tickets, type_tickets,
            prepare.prepare_order_details(table("transactions.order_details")),
            prepare.prepare_orders(table("transactions.orders")),
            prepare.prepare_payments(table("transactions.payments")),
            ticket_states,
        ), "purchases")
    if asked("attendances"):
        made.attendances = cut_lineage(
            edges.attendance_edges(tickets, type_tickets, ticket_states), "attendances"
        )
    if asked("reservations"):
        made.reservations = cut_lineage(edges.reservation_edges(
            prepare.prepare_reservations(table("transactions.reservations")), tables,
            prepare.prepare_table_prices(table("core.table_prices")),
            table("catalog.reservation_states"),
        ), "reservations")
    if asked("social_ties"):
        made.social_ties = social_ties(made.purchases, made.attendances, made.reservations, made.events)
    return made


def projection_counts(bundle: ProjectionBundle) -> DataFrame:
    """Rows of each projected table, as one job."""
    counts = None
    for name, df in bundle.named().items():
        if name not in ("segments", "belongs"):
            rows = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("part"), "rows")
            counts = rows if counts is None else counts.unionByName(rows)
    return counts
