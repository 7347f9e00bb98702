"""Source tables with agreed names, defaults and types for the projection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieweave.operators.merge import one_per_key


def rename_first(df: DataFrame, aliases: dict[str, tuple[str, ...]]) -> DataFrame:
    """Renames, per target name that is missing, its first alias that exists."""
    for target, names in aliases.items():
        found = next((name for name in names if name in df.columns), None)
        if target not in df.columns and found:
            df = df.withColumnRenamed(found, target)
    return df


def ensure_columns(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    missing = {
        name: F.lit(default) if default is not None else F.lit(None).cast("string")
        for name, default in defaults.items()
        if name not in df.columns
    }
    return df.withColumns(missing) if missing else df


def coerce(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Casts the columns that exist; bad values become null."""
    casts = {
        name: F.col(name).try_cast(kind) for name, kind in kinds.items() if name in df.columns
    }
    return df.withColumns(casts) if casts else df


def coerce_numeric(df: DataFrame, names: list[str], kind: str = "double") -> DataFrame:
    return coerce(df, {name: kind for name in names})


def coerce_datetime(df: DataFrame, names: list[str]) -> DataFrame:
    return coerce(df, {name: "timestamp_ntz" for name in names})


def active_only(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that are not deleted, one per key."""
    if "source_deleted" in df.columns:
        df = df.filter(~F.coalesce("source_deleted", F.lit(False)))
    return one_per_key(df, keys)


@dataclass(frozen=True)
class Preparation:
    """Names, defaults and types that one source table gets."""

    aliases: dict[str, tuple[str, ...]] = field(default_factory=dict)
    optional: tuple[str, ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)
    keys: tuple[str, ...] = ()
    amounts: tuple[str, ...] = ()
    moments: tuple[str, ...] = ()

    def apply(self, df: DataFrame) -> DataFrame:
        df = rename_first(df, self.aliases)
        df = ensure_columns(df, dict.fromkeys(self.optional))
        df = ensure_columns(df, self.defaults | {"source_deleted": False})
        df = coerce_numeric(df, list(self.keys), "bigint")
        df = coerce_numeric(df, list(self.amounts))
        return coerce_datetime(df, list(self.moments))


# Names, defaults and types of the prepared tables.
USERS = Preparation(
    aliases={"user_id": ("id",)},
    optional=(
        "telegram_id", "username", "social_role", "social_group_id", "secondary_group_id",
        "attendance_level", "vip_affinity", "invite_power", "table_preference",
        "rfm_seed_segment", "newcomer_affinity", "mixing_score",
    ),
    keys=("user_id", "telegram_id"),
    amounts=("vip_affinity", "invite_power", "newcomer_affinity", "mixing_score"),
)
EVENTS = Preparation(
    aliases={"event_id": ("id",), "event_state_id": ("event_state",)},
    optional=(
        "name", "event_type", "expected_demand_level", "vip_pull", "event_date", "start_time",
        "end_time", "event_state_id",
    ),
    keys=("event_id", "event_state_id"),
    amounts=("vip_pull",),
    moments=("event_date", "start_time", "end_time"),
)
TABLES = Preparation(
    aliases={"table_id": ("id",), "table_type": ("table_type_name",)},
    optional=("number", "table_type", "capacity", "vip_suitability"),
    keys=("table_id", "number", "capacity"),
    amounts=("vip_suitability",),
)
TYPE_TICKETS = Preparation(
    aliases={"type_ticket_id": ("id",)},
    optional=("event_id", "ticket_tier", "name", "price"),
    keys=("type_ticket_id", "event_id"),
    amounts=("price",),
)
TABLE_PRICES = Preparation(
    optional=("table_id", "event_id", "price"), keys=("table_id", "event_id"), amounts=("price",)
)
ORDERS = Preparation(
    aliases={"order_id": ("id",)},
    optional=("user_id", "status", "updated_at"),
    keys=("order_id", "user_id"),
    amounts=("total",),
    moments=("updated_at", "created_at", "ordered_at"),
)
ORDER_DETAILS = Preparation(
    aliases={"order_detail_id": ("id",)},
    optional=("order_id", "ticket_id", "reservation_id", "type_ticket_id", "table_id", "unit_price"),
    defaults={"quantity": 1, "discount": 0},
    keys=("order_detail_id", "order_id", "ticket_id", "reservation_id", "type_ticket_id", "table_id"),
    amounts=("quantity", "unit_price", "discount"),
)
TICKETS = Preparation(
    aliases={"ticket_id": ("id",)},
    optional=("user_id", "type_ticket_id", "ticket_state_id", "created_at", "updated_at"),
    keys=("ticket_id", "user_id", "type_ticket_id", "ticket_state_id"),
    moments=("created_at", "updated_at"),
)
RESERVATIONS = Preparation(
    aliases={"reservation_id": ("id",)},
    optional=(
        "reservation_state_id", "user_id", "table_id", "event_id", "reserved_at", "expires_at",
    ),
    keys=("reservation_id", "reservation_state_id", "user_id", "table_id", "event_id"),
    moments=("reserved_at", "expires_at", "updated_at", "created_at"),
)
PAYMENTS = Preparation(
    aliases={"payment_id": ("id",)},
    optional=("order_id", "status", "created_at"),
    keys=("payment_id", "order_id", "payment_method_id"),
    amounts=("amount",),
    moments=("created_at",),
)


def prepare_users(df: DataFrame) -> DataFrame:
    return USERS.apply(df)


def prepare_events(df: DataFrame) -> DataFrame:
    return EVENTS.apply(df)


def prepare_tables(df: DataFrame) -> DataFrame:
    return TABLES.apply(df)


def prepare_type_tickets(df: DataFrame) -> DataFrame:
    """Tiers in lower case; a catalogue that has no tier at all uses the names."""
    df = TYPE_TICKETS.apply(df)
    any_tier = df.agg(F.max(F.col("ticket_tier").isNotNull())).scalar()
    tier = F.when(F.coalesce(any_tier, F.lit(False)), F.col("ticket_tier")).otherwise(F.col("name"))
    return df.withColumn("ticket_tier", F.lower(tier))


def prepare_table_prices(df: DataFrame) -> DataFrame:
    return TABLE_PRICES.apply(df)


def prepare_orders(df: DataFrame) -> DataFrame:
    return ORDERS.apply(df)


def prepare_order_details(df: DataFrame) -> DataFrame:
    return ORDER_DETAILS.apply(df)


def prepare_tickets(df: DataFrame) -> DataFrame:
    return TICKETS.apply(df)


def prepare_reservations(df: DataFrame) -> DataFrame:
    return RESERVATIONS.apply(df)


def prepare_payments(df: DataFrame) -> DataFrame:
    return PAYMENTS.apply(df)
