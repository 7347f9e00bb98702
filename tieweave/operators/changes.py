"""Change logs reduced to the current row of every key.

The newest change wins: the greatest source time, then log position, read time
and event id. A missing time loses. A delete stays as a tombstone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tieweave.functions.columns import (
    blank_to_null, epoch_millis, latest_by, log_position, normalize_op,
)
from tieweave.schemas import SOURCE_KEYS, resolve_table_name

IMAGE = T.MapType(T.StringType(), T.StringType())


def parse_image(df: DataFrame, name: str) -> Column:
    """A row image as a map; absent or empty means an empty map.

    JSON text that is no object gives null, see ``read_changes``.
    """
    empty = F.from_json(F.lit("{}"), IMAGE)
    if name not in df.columns:
        return empty
    if isinstance(df.schema[name].dataType, T.StringType):
        text = blank_to_null(F.col(name))
        parsed = F.when(text.startswith("{"), F.from_json(text, IMAGE))
        return F.when(text.isNull(), empty).otherwise(parsed)
    if isinstance(df.schema[name].dataType, T.StructType):
        parsed = F.from_json(F.to_json(F.col(name)), IMAGE)
    else:
        parsed = F.col(name).cast(IMAGE)
    return F.coalesce(parsed, empty)


def _primary_key(table_name: str | None, primary_key: list[str] | None) -> list[str]:
    if primary_key:
        return list(primary_key)
    table = resolve_table_name(table_name) if table_name else None
    if table not in SOURCE_KEYS:
        raise ValueError("needs a primary key or the name of a known table")
    return list(SOURCE_KEYS[table])


def read_changes(changelog: DataFrame, keys: list[str]) -> DataFrame:
    """Every change with its key columns, image and order, and the ``problem`` that
    keeps it from counting: an image that cannot be read, or no key value at all."""
    op = normalize_op(F.col("op") if "op" in changelog.columns else F.lit(None).cast("string"))
    prepared = changelog.select(
        op.alias("_op"),
        F.col("source_ts").alias("_source_ts"),
        parse_image(changelog, "pk").alias("pk"),
        parse_image(changelog, "after").alias("after"),
        parse_image(changelog, "before").alias("before"),
        F.struct(
            epoch_micros(changelog, "source_ts").alias("at"),
            log_position(_column(changelog, "lsn")).alias("position"),
            epoch_millis(changelog, "read_timestamp").alias("read"),
            F.coalesce(_column(changelog, "uuid"), F.lit("")).alias("event"),
        ).alias("order"),
        F.struct("*").alias("change"),
    )
    image = F.when(F.col("_op") == "DELETE", F.col("before")).otherwise(F.col("after"))
    own = lambda key: F.try_element_at("pk", F.lit(key))
    read = lambda key: F.when(
        F.size("pk") > 0, own(key)
    ).otherwise(F.try_element_at("image", F.lit(key)))
    unreadable = F.col("pk").isNull() | F.col("after").isNull() | F.col("before").isNull()
    rows = prepared.withColumn("unreadable", unreadable).withColumn("image", image).select(
        *[read(key).alias(key) for key in keys],
        F.map_concat(
            F.map_filter("image", lambda name, _: ~F.map_contains_key("pk", name)), "pk"
        ).alias("image"),
        (F.col("_op") == "DELETE").alias("source_deleted"),
        "_op", "_source_ts", "order", "unreadable", "change",
    )
    keyless = F.coalesce(*keys).isNull()
    problem = F.when(F.col("unreadable"), "unreadable image").when(keyless, "no key value")
    return rows.withColumn("problem", problem).drop("unreadable")


CURRENT = ["image", "source_deleted", "_op", "_source_ts"]


def _newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(latest_by(F.col("order"), CURRENT)).select(*keys, "row.*")


def reduce_cdc_to_current(
    changelog: DataFrame, table_name: str | None = None, primary_key: list[str] | None = None
) -> DataFrame:
    """One row per key: the key columns, ``image``, ``source_deleted``, ``_op``
    and ``_source_ts``. Use ``unpack_image`` to turn the image into columns.

    Fails on a change with an unreadable image or without any key value, because
    leaving it out would lose data; ``reduce_cdc_with_rejected`` sets those aside.
    """
    keys = _primary_key(table_name, primary_key)
    stop = F.raise_error(F.concat(F.lit("change with "), F.col("problem")))
    checked = read_changes(changelog, keys).withColumn(
        keys[0], F.when(F.col("problem").isNotNull(), stop.cast("string")).otherwise(F.col(keys[0]))
    )
    return _newest(checked, keys)


def reduce_cdc_with_rejected(
    changelog: DataFrame, table_name: str | None = None, primary_key: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The current rows of all sound changes, and the other changes as they came,
    with their ``problem``."""
    keys = _primary_key(table_name, primary_key)
    rows = read_changes(changelog, keys)
    current = _newest(rows.filter(F.col("problem").isNull()), keys)
    return current, rows.filter(F.col("problem").isNotNull()).select("change.*", "problem")


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 where the type carries them, for a finer order."""
    if name in df.columns and isinstance(df.schema[name].dataType, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.coalesce(F.timestamp_diff("MICROSECOND", epoch, F.col(name)), F.lit(-1))
    if name in df.columns and isinstance(df.schema[name].dataType, T.TimestampType):
        return F.coalesce(F.unix_micros(name), F.lit(-1))
    return epoch_millis(df, name) * 1000


def _column(df: DataFrame, name: str) -> Column:
    return (F.col(name) if name in df.columns else F.lit(None)).cast("string")


def unpack_image(current: DataFrame, fields: dict[str, str]) -> DataFrame:
    """The image's fields as typed columns; bad values become null."""
    taken = [
        F.try_element_at("image", F.lit(name)).try_cast(kind).alias(name)
        for name, kind in fields.items()
    ]
    return current.select(*taken, "source_deleted", "_op", "_source_ts")


def reduce_streams_to_current(streams: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every table of a set of change logs, under its full name."""
    return {
        resolve_table_name(name): reduce_cdc_to_current(df, name) for name, df in streams.items()
    }


def latest_by_commit_ts(
    batch: DataFrame, keys: list[str], commit: str = "_dms_timestamp", op: str = "Op"
) -> DataFrame:
    """Newest version of each key in a batch of change files, deletes marked."""
    columns = [name for name in batch.columns if name not in (*keys, op)]
    marked = batch.withColumn("source_deleted", normalize_op(_column(batch, op)) == "DELETE")
    order = F.struct(
        epoch_micros(batch, commit).alias("at"), F.struct(*columns, "source_deleted").alias("rest")
    )
    latest = marked.groupBy(*keys).agg(F.max(order).alias("row"))
    return latest.select(*keys, "row.rest.*")


# Change envelopes


def dedupe_uuid(envelopes: DataFrame) -> DataFrame:
    """Each event id once, by the earliest read; rows without an id all stay."""
    rest = [name for name in envelopes.columns if name != "uuid"]
    order = F.struct(
        epoch_millis(envelopes, "read_timestamp").alias("read"),
        F.xxhash64(F.to_json(F.struct(*rest))).alias("hash"),
    )
    named = envelopes.filter(F.coalesce("uuid", F.lit("")) != "")
    once = named.groupBy("uuid").agg(F.min_by(F.struct(*rest), order).alias("row"))
    unnamed = envelopes.filter(F.coalesce("uuid", F.lit("")) == "")
    return once.select("uuid", "row.*").unionByName(unnamed)


def primary_key_resolution(envelopes: DataFrame) -> DataFrame:
    """Adds ``table`` and ``keys``: those named in the row, else the registered.

    Rows without a schema or table are skipped, as they describe no change.
    """
    known = F.create_map(
        *[
            part for name, keys in SOURCE_KEYS.items()
            for part in (F.lit(name), F.array(*[F.lit(key) for key in keys]))
        ]
    )
    meta = F.col("source_metadata")
    own = F.when(F.size(meta["primary_keys"]) > 0, meta["primary_keys"])
    given = lambda name: F.coalesce(meta[name], F.lit("")) != ""
    return (
        envelopes.filter(given("schema") & given("table"))
        .withColumn("table", F.concat_ws(".", meta["schema"], meta["table"]))
        .withColumn("keys", F.coalesce(own, F.try_element_at(known, F.col("table"))))
    )


def keyed_envelopes(envelopes: DataFrame) -> DataFrame:
    """Envelopes with table, ``pk`` (the key values) and ``order``.

    ``pk`` is null when the keys are unknown or a key value is missing; such rows
    go to ``unkeyed_envelopes``.
    """
    resolved = primary_key_resolution(envelopes)
    payload = parse_image(resolved, "payload")
    values = F.transform("keys", lambda key: F.try_element_at("payload", key))
    meta = F.col("source_metadata")
    complete = ~F.exists("values", lambda value: value.isNull())
    return (
        resolved.withColumn("payload", payload)
        .withColumn("values", values)
        .select(
            "table", "uuid",
            F.when(F.col("keys").isNotNull() & complete, F.to_json("values")).alias("pk"),
            "payload",
            F.coalesce(meta["is_deleted"], F.lit(False)).alias("source_deleted"),
            meta["change_type"].alias("_op"),
            F.col("source_timestamp").alias("_source_ts"),
            F.struct(
                epoch_millis(resolved, "source_timestamp").alias("at"),
                log_position(meta["lsn"]).alias("position"),
                epoch_millis(resolved, "read_timestamp").alias("read"),
                F.coalesce("uuid", F.lit("")).alias("event"),
            ).alias("order"),
        )
    )


def unkeyed_envelopes(envelopes: DataFrame) -> DataFrame:
    return keyed_envelopes(envelopes).filter(F.col("pk").isNull())


ENVELOPE_STATE = ["uuid", "payload", "source_deleted", "_op", "_source_ts", "order"]


def newest_per_key(keyed: DataFrame) -> DataFrame:
    latest = keyed.groupBy("table", "pk").agg(latest_by(F.col("order"), ENVELOPE_STATE))
    return latest.select("table", "pk", "row.*")


def envelope_ingest(envelopes: DataFrame) -> DataFrame:
    """Current row per table and key of a batch of envelopes; as the newest row of a
    key wins, an envelope that came twice needs no step of its own.

    Fails on a change without key values, because dropping it would lose data.
    """
    keyed = keyed_envelopes(envelopes)
    problem = F.concat(F.lit("change without key values in table "), F.col("table"))
    checked = keyed.withColumn(
        "pk", F.when(F.col("pk").isNull(), F.raise_error(problem)).otherwise(F.col("pk"))
    )
    return newest_per_key(checked)
