"""Union of canonical table sets, one row per key, and key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieweave.operators.normalize_seed import Tables
from tieweave.schemas import CANONICAL_KEYS

PAIR_ONLY_KEY = ("user_id", "table_id")


def one_per_key(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """The first row of each key by ``order``, then by all other columns.

    An aggregate, so a key with very many rows is reduced before the shuffle.
    """
    columns = df.columns
    rest = [name for name in columns if name not in keys]
    if not rest:
        return df.distinct()
    # Every value travels once: the row is read from what ranks it.
    ranked = [name for name in dict.fromkeys([*order, *rest]) if name not in keys]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("row"))
    return kept.select(*[F.col(name if name in keys else f"row.{name}").alias(name) for name in columns])


def merge_canonical(
    first: Tables, second: Tables, keys: dict[str, tuple[str, ...]] | None = None
) -> Tables:
    """Both sets by table name; of rows with one key, that of ``first`` stays.

    ``keys`` overrides the key of a table, for instance to hold one reservation
    per user and table with ``{"reservo": PAIR_ONLY_KEY}``.
    """
    keys = CANONICAL_KEYS | (keys or {})
    merged = {}
    for name in sorted(set(first) | set(second)):
        if name in first and name in second:
            both = first[name].withColumn("priority", F.lit(1)).unionByName(
                second[name].withColumn("priority", F.lit(2)), allowMissingColumns=True
            )
            merged[name] = one_per_key(
                both, list(keys.get(name, ("id",))), "priority", "source"
            ).drop("priority")
        else:
            merged[name] = first.get(name, second.get(name))
    return merged


def unique_key_check(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, and how often; empty when all is well."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    example = unique_key_check(df, keys).first()
    if example is not None:
        raise ValueError(f"key {keys} is not unique, for instance {example.asDict()}")
    return df
