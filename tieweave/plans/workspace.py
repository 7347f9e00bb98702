"""Tables that several questions on one data directory share.

The graph is projected once and kept, as the questions are asked one after the
other. Everything here is built on first use.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tieweave.graph.betweenness import betweenness
from tieweave.graph.communities import louvain
from tieweave.graph.pagerank import pagerank
from tieweave.graph.social import SocialGraph, project_graph
from tieweave.operators import edges, prepare
from tieweave.operators.ties import conoce_a
from tieweave.plans.star_views import StarViews
from tieweave.session import cut_lineage


class Workspace(StarViews):
    """The edge tables are written once as well: questions read them, not the
    bookings they come from."""

    @cached_property
    def asistio_a(self) -> DataFrame:
        return cut_lineage(StarViews.asistio_a.func(self), "asistio_a")

    @cached_property
    def reservo(self) -> DataFrame:
        return cut_lineage(StarViews.reservo.func(self), "reservo")

    @cached_property
    def tickets(self) -> DataFrame:
        return cut_lineage(StarViews.tickets.func(self), "tickets")

    def derive_ties(self) -> DataFrame:
        return conoce_a(self.asistio_a, self.evento, self.reservo)

    @cached_property
    def ties(self) -> DataFrame:
        """The ties, written once to the shared scratch folder."""
        return cut_lineage(self.derive_ties(), "ties")

    @cached_property
    def graph(self) -> SocialGraph:
        return project_graph(self.usuario, self.ties)

    @cached_property
    def communities(self) -> DataFrame:
        return louvain(self.graph)

    @cached_property
    def scores(self) -> DataFrame:
        return pagerank(self.graph)

    @cached_property
    def between(self) -> DataFrame:
        return cut_lineage(betweenness(self.graph), "between")

    @cached_property
    def source_tables(self) -> dict[str, DataFrame]:
        """The booking tables under the names the projection expects."""
        as_id = lambda df, name: df.withColumnRenamed(name, "id")
        details = self.tickets.select(
            F.col("ticket_id").alias("id"), "order_id", "ticket_id", "unit_price", "discount"
        )
        users = self.table("customer").select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("username"),
            F.col("c_mktsegment").alias("rfm_seed_segment"),
        )
        events = self.evento.select(
            F.split_part("id", F.lit(":"), F.lit(2)).cast("bigint").alias("id"), "name", "event_date"
        )
        tables = self.table("supplier").select(
            F.col("s_suppkey").alias("id"), F.col("s_suppkey").alias("number")
        )
        return {
            "core.users": users,
            "core.events": events,
            "core.dico_tables": tables,
            "core.type_tickets": as_id(self.type_tickets, "type_ticket_id"),
            "core.table_prices": self.table_prices,
            "transactions.orders": as_id(self.orders, "order_id"),
            "transactions.order_details": details,
            "transactions.tickets": as_id(self.tickets, "ticket_id"),
            "transactions.reservations": as_id(self.reservations, "reservation_id"),
            "transactions.payments": as_id(self.payments, "payment_id"),
            "catalog.ticket_states": self.ticket_states,
            "catalog.reservation_states": self.reservation_states,
        }

    def purchases(self) -> DataFrame:
        raw = self.source_tables
        return edges.ticket_purchase_edges(
            prepare.prepare_tickets(raw["transactions.tickets"]),
            prepare.prepare_type_tickets(raw["core.type_tickets"]),
            prepare.prepare_order_details(raw["transactions.order_details"]),
            prepare.prepare_orders(raw["transactions.orders"]),
            prepare.prepare_payments(raw["transactions.payments"]),
            raw["catalog.ticket_states"],
        )

    def attendances(self) -> DataFrame:
        raw = self.source_tables
        return edges.attendance_edges(
            prepare.prepare_tickets(raw["transactions.tickets"]),
            prepare.prepare_type_tickets(raw["core.type_tickets"]),
            raw["catalog.ticket_states"],
        )

    def live_reservations(self) -> DataFrame:
        raw = self.source_tables
        return edges.reservation_edges(
            prepare.prepare_reservations(raw["transactions.reservations"]),
            prepare.prepare_tables(raw["core.dico_tables"]),
            prepare.prepare_table_prices(raw["core.table_prices"]),
            raw["catalog.reservation_states"],
        )

    def event_dates(self) -> DataFrame:
        return prepare.prepare_events(self.source_tables["core.events"])


_OPEN: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, directory: str) -> Workspace:
    """The workspace of a directory, kept for the life of the application."""
    key = (spark.sparkContext.applicationId, directory.rstrip("/"))
    if key not in _OPEN:
        _OPEN[key] = Workspace(spark, directory)
    return _OPEN[key]
