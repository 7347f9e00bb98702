"""Typed and JSON forms of a table for whoever loads it elsewhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _plain(value: Column, kind: T.DataType) -> Column:
    """Not-a-number as null, decimals as doubles, dates and times as ISO text with
    their microseconds if there are any; the same within structs, arrays and maps."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    if isinstance(kind, T.DecimalType):
        return value.cast("double")
    if isinstance(kind, T.DateType):
        return F.date_format(value, "yyyy-MM-dd")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
        parts = F.date_format(value, "SSSSSS")
        return F.when(parts == "000000", whole).otherwise(F.concat_ws(".", whole, parts))
    if isinstance(kind, T.StructType):
        fields = [_plain(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: _plain(item, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, item: _plain(item, kind.valueType))
    return value


def export_records(df: DataFrame) -> DataFrame:
    """One JSON text per row, missing values written as null."""
    plain = F.struct(*[
        _plain(F.col(f"`{field.name}`"), field.dataType).alias(field.name) for field in df.schema.fields
    ])
    return df.select(F.to_json(plain, {"ignoreNullFields": "false"}).alias("record"))


def typed_property_cast(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Casts properties by name; bad values become null, missing flags false."""
    casts = {}
    for name, kind in kinds.items():
        value = F.col(name).try_cast(kind)
        casts[name] = F.coalesce(value, F.lit(False)) if kind == "boolean" else value
    return df.withColumns(casts)


# Property types of the three node kinds when written.
USER_PROPERTIES = {
    "user_id": "bigint", "telegram_id": "bigint", "vip_affinity": "double",
    "invite_power": "double", "newcomer_affinity": "double", "mixing_score": "double",
    "source_deleted": "boolean",
}
EVENT_PROPERTIES = {
    "event_id": "bigint", "vip_pull": "double", "event_date": "date",
    "start_time": "timestamp_ntz", "end_time": "timestamp_ntz", "event_state_id": "bigint",
    "source_deleted": "boolean",
}
TABLE_PROPERTIES = {
    "table_id": "bigint", "number": "bigint", "capacity": "bigint", "vip_suitability": "double",
    "source_deleted": "boolean",
}
