"""Canonical tables, their keys, and the registry of source tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns, types and keys of the canonical tables.
CANONICAL = {
    "usuarios": """id STRING NOT NULL, telegram_id STRING, username STRING, social_role STRING,
        social_group_id STRING, secondary_group_id STRING, attendance_level STRING,
        vip_affinity DOUBLE, invite_power DOUBLE, table_preference STRING,
        rfm_seed_segment STRING, newcomer_affinity DOUBLE, mixing_score DOUBLE,
        source STRING NOT NULL""",
    "eventos": """id STRING NOT NULL, name STRING, event_type STRING,
        expected_demand_level STRING, vip_pull DOUBLE, event_date DATE, start_time TIMESTAMP,
        end_time TIMESTAMP, event_state_id INT, source STRING NOT NULL""",
    "mesas": """id STRING NOT NULL, table_number INT, capacity INT, is_vip BOOLEAN,
        event_id STRING, source STRING NOT NULL""",
    "segmentos": "name STRING NOT NULL, description STRING, source STRING NOT NULL",
    "asistio_a": """user_id STRING NOT NULL, event_id STRING NOT NULL, ticket_tier STRING,
        source STRING NOT NULL""",
    "reservo": """user_id STRING NOT NULL, table_id STRING NOT NULL, event_id STRING,
        source STRING NOT NULL""",
    "pertenece_a": """user_id STRING NOT NULL, segment_name STRING NOT NULL,
        source STRING NOT NULL""",
}
CANONICAL_KEYS = {
    "usuarios": ("id",),
    "eventos": ("id",),
    "mesas": ("id",),
    "segmentos": ("name",),
    "asistio_a": ("user_id", "event_id"),
    "reservo": ("user_id", "table_id", "event_id"),
    "pertenece_a": ("user_id", "segment_name"),
}

# Source tables with their primary keys, and their short names.
SOURCE_KEYS = {
    "core.users": ("id",),
    "core.events": ("id",),
    "core.dico_tables": ("id",),
    "core.type_tickets": ("id",),
    "core.table_prices": ("table_id", "event_id"),
    "transactions.orders": ("id",),
    "transactions.order_details": ("id",),
    "transactions.tickets": ("id",),
    "transactions.reservations": ("id",),
    "transactions.payments": ("id",),
    "catalog.ticket_states": ("id",),
    "catalog.reservation_states": ("id",),
    "catalog.event_states": ("id",),
    "catalog.table_types": ("id",),
    "catalog.payment_methods": ("id",),
}
SHORT_NAMES = {name.split(".")[1]: name for name in SOURCE_KEYS} | {"tables": "core.dico_tables"}


def resolve_table_name(name: str) -> str:
    return SHORT_NAMES.get(name, name)


def parse_fields(ddl: str) -> list[tuple[str, str, bool]]:
    """(name, type, required) of each field of a table declared above."""
    fields = []
    for part in ddl.split(","):
        name, kind, *rest = part.split()
        fields.append((name, kind.lower(), rest == ["NOT", "NULL"]))
    return fields


_reports: list[dict[str, DataFrame]] = []


@contextmanager
def rejections() -> Iterator[dict[str, DataFrame]]:
    """Collects, per table, the rows that ``conform`` leaves out meanwhile."""
    report: dict[str, DataFrame] = {}
    _reports.append(report)
    try:
        yield report
    finally:
        _reports.remove(report)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Applies the declared columns and types and leaves out rows without a required
    value, which go to the open ``rejections``."""
    fields = parse_fields(CANONICAL[table])
    shaped = df.select(*[F.col(name).try_cast(kind).alias(name) for name, kind, _ in fields])
    for report in _reports:
        left_out = rejected(shaped, table)
        report[table] = report[table].unionByName(left_out) if table in report else left_out
    return shaped.dropna(subset=[name for name, _, required in fields if required])


def rejected(df: DataFrame, table: str) -> DataFrame:
    """The rows that ``conform`` leaves out because a required value is null."""
    required = [name for name, _, needed in parse_fields(CANONICAL[table]) if needed]
    missing = F.array_compact(
        F.array(*[F.when(F.col(name).isNull(), F.lit(name)) for name in required])
    )
    return df.withColumn("missing", missing).filter(F.size("missing") > 0)
