"""The booking tables as seen through the star-schema test tables.

Each view is written once with the DataFrame API here and once as SQL in
``star_sql``; the SQL side feeds the oracles.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _csv(column: str) -> Column:
    return F.concat(F.lit("csv:"), F.col(column).cast("string"))


class StarViews:
    """Views over the tables of one data directory, built when asked for."""

    def __init__(self, spark: SparkSession, directory: str) -> None:
        self.spark = spark
        self.directory = directory.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    @cached_property
    def booked_lines(self) -> DataFrame:
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
        return self.table("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    @cached_property
    def usuario(self) -> DataFrame:
        return self.table("customer").select(
            _csv("c_custkey").alias("id"),
            F.col("c_name").alias("username"),
            F.col("c_mktsegment").alias("rfm_seed_segment"),
            F.col("c_acctbal").alias("vip_affinity"),
            F.lit("csv").alias("source"),
        )

    @cached_property
    def evento(self) -> DataFrame:
        day = (F.col("p_partkey") % 365).cast("int")
        return self.table("part").select(
            _csv("p_partkey").alias("id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("event_type"),
            F.col("p_retailprice").alias("vip_pull"),
            F.date_add(F.lit("2024-01-01").cast("date"), day).alias("event_date"),
            F.lit("csv").alias("source"),
        )

    @cached_property
    def mesa(self) -> DataFrame:
        third = F.col("s_suppkey") % 3
        return self.table("supplier").select(
            _csv("s_suppkey").alias("id"),
            F.col("s_suppkey").cast("int").alias("table_number"),
            (4 + F.col("s_suppkey") % 9).cast("int").alias("capacity"),
            (F.col("s_acctbal") > 5000).alias("is_vip"),
            F.when(third == 0, "vip").when(third == 1, "regular").otherwise("private").alias(
                "table_type"
            ),
            F.lit("csv").alias("source"),
        )

    @cached_property
    def asistio_a(self) -> DataFrame:
        tier = F.when(F.max("l_quantity") >= 30, "vip").otherwise("general")
        return (
            self.booked_lines.filter("l_returnflag = 'R' AND l_linestatus = 'F'")
            .groupBy(_csv("o_custkey").alias("user_id"), _csv("l_partkey").alias("event_id"))
            .agg(tier.alias("ticket_tier"))
            .withColumn("source", F.lit("csv"))
        )

    @cached_property
    def reservo(self) -> DataFrame:
        return (
            self.booked_lines.filter("l_returnflag = 'A'")
            .select(
                _csv("o_custkey").alias("user_id"),
                _csv("l_suppkey").alias("table_id"),
                _csv("l_partkey").alias("event_id"),
            )
            .distinct()
            .withColumn("source", F.lit("csv"))
        )

    @cached_property
    def changelog(self) -> DataFrame:
        kind = F.col("event_type")
        return self.table("events").select(
            F.col("event_id").alias("uuid"),
            F.lit("core.users").alias("table_name"),
            F.col("user_id").alias("pk_id"),
            F.when(kind == "signup", "I").when(kind == "error", "D").otherwise("u").alias("op"),
            F.col("ts").alias("source_ts"),
            "value",
            F.col("props").alias("payload_json"),
        )

    @cached_property
    def first_lines(self) -> DataFrame:
        """One line per order and line number, the smallest by all columns."""
        order = [
            "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate",
        ]
        return self._first_line(self.booked_lines, order)

    @staticmethod
    def _first_line(lines: DataFrame, order: list[str]) -> DataFrame:
        place = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*order)
        return lines.withColumn("rn", F.row_number().over(place)).filter("rn = 1").drop("rn")

    @cached_property
    def tickets(self) -> DataFrame:
        flag = F.col("l_returnflag")
        return self.first_lines.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ticket_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("type_ticket_id"),
            F.when(flag == "R", 2).when(flag == "A", 3).otherwise(1).alias("ticket_state_id"),
            F.col("l_extendedprice").alias("unit_price"),
            F.col("l_discount").alias("discount"),
            F.col("l_shipdate").alias("updated_at"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        state = F.col("o_orderstatus")
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            F.when(state == "F", "Approved").when(state == "P", "pending").otherwise("rejected")
            .alias("status"),
            F.col("o_orderdate").alias("updated_at"),
            F.col("o_totalprice").alias("total"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("payment_id"),
            F.col("o_orderkey").alias("order_id"),
            F.when(F.col("o_orderkey") % 4 == 0, "pending").otherwise("Verified").alias("status"),
            F.col("o_orderdate").alias("created_at"),
        )

    @cached_property
    def type_tickets(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("type_ticket_id"),
            F.col("p_partkey").alias("event_id"),
            F.when(F.col("p_size") >= 25, "VIP").otherwise("General").alias("ticket_tier"),
            F.col("p_retailprice").alias("price"),
        )

    @cached_property
    def table_prices(self) -> DataFrame:
        """A row per pair of supplier and part; odd parts are listed without a price."""
        least = F.min(F.when(F.col("l_partkey") % 2 == 0, F.col("l_extendedprice")))
        return (
            self.table("lineitem")
            .groupBy(F.col("l_suppkey").alias("table_id"), F.col("l_partkey").alias("event_id"))
            .agg(least.alias("price"))
        )

    @cached_property
    def reservations(self) -> DataFrame:
        flag = F.col("l_returnflag")
        lines = self.booked_lines.filter("l_linestatus = 'O' AND o_orderstatus = 'P'")
        order = [
            "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate",
        ]
        return self._first_line(lines, order).select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("reservation_id"),
            F.when(flag == "N", 1).when(flag == "R", 2).otherwise(4).alias("reservation_state_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("l_suppkey").alias("table_id"),
            F.col("l_partkey").alias("event_id"),
            F.col("l_shipdate").alias("reserved_at"),
        )

    @cached_property
    def ticket_states(self) -> DataFrame:
        return self.spark.createDataFrame(
            [(1, "active"), (2, "Used"), (3, "cancelled")], "id int, name string"
        )

    @cached_property
    def reservation_states(self) -> DataFrame:
        return self.spark.createDataFrame(
            [(1, "Pending"), (2, "confirmed"), (3, "completed"), (4, "cancelled")],
            "id int, name string",
        )
