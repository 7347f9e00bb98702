"""Column expressions for ids, lenient casts and change metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings of a change operation and what each stands for.
OPERATION_NAMES = {
    "C": "INSERT",
    "I": "INSERT",
    "INSERT": "INSERT",
    "R": "INSERT",
    "U": "UPDATE",
    "UPDATE": "UPDATE",
    "D": "DELETE",
    "DELETE": "DELETE",
}


def namespaced(key: Column | str, prefix: str) -> Column:
    """``prefix:key``; null stays null so that the key check can see it."""
    key = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit(prefix + ":"), key.cast("string"))


def blank_to_null(text: Column | str) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def first_present(df: DataFrame, *names: str, kind: str = "string") -> Column:
    """The first of ``names`` that ``df`` has, cast to ``kind``, else null."""
    for name in names:
        if name in df.columns:
            return F.col(name).try_cast(kind)
    return F.lit(None).cast(kind)


def normalize_op(op: Column | str) -> Column:
    """Insert, update or delete; unknown spellings pass in upper case."""
    spelled = F.upper(F.trim(F.coalesce(op, F.lit(""))))
    names = F.create_map(*[F.lit(part) for pair in OPERATION_NAMES.items() for part in pair])
    return F.coalesce(F.try_element_at(names, spelled), spelled)


def log_position(lsn: Column | str) -> Column:
    """Position in the write-ahead log, ``high/low`` in hex, -1 when unreadable."""
    text = F.trim(lsn)
    readable = text.rlike("^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$")
    high, low = (
        F.conv(F.split_part(text, F.lit("/"), F.lit(part)), 16, 10).cast("decimal(10,0)")
        for part in (1, 2)
    )
    value = (high * F.lit(4294967296).cast("decimal(10,0)") + low).cast("decimal(20,0)")
    return F.coalesce(F.when(readable, value), F.lit(-1).cast("decimal(20,0)"))


def _millis_of_local(moment: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MILLISECOND", epoch, moment)


def epoch_millis(df: DataFrame, name: str) -> Column:
    """Milliseconds since 1970 of any time-like column; without a zone it is
    UTC, and unreadable values give -1."""
    if name not in df.columns:
        return F.lit(-1).cast("long")
    kind, value = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.TimestampType):
        millis = F.unix_millis(value)
    elif isinstance(kind, (T.TimestampNTZType, T.DateType)):
        millis = _millis_of_local(value.cast("timestamp_ntz"))
    elif isinstance(kind, T.NumericType):
        millis = value.cast("long")
    else:
        text = F.trim(value)
        zoned = text.rlike("(Z|[+-][0-9]{2}:?[0-9]{2})$") & text.rlike(":[0-9]{2}")
        millis = F.coalesce(
            text.try_cast("long"),
            F.when(zoned, F.unix_millis(text.try_cast("timestamp"))).otherwise(
                _millis_of_local(text.try_cast("timestamp_ntz"))
            ),
        )
    return F.coalesce(millis, F.lit(-1)).cast("long")


def latest_by(order: Column, columns: list[str]) -> Column:
    """The row with the greatest order, as one struct."""
    return F.max_by(F.struct(*columns), order).alias("row")
