"""Bounded samples of labelled texts, for fitting small models on the driver."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, longest: int, usable: Column | None = None
) -> pd.DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled documents of at most
    ``longest`` bytes, the first by the hash of their id: a sample of bounded size that
    a longer table does not make larger and that is the same on every run.

    Labels that are null, and ids that bear different labels, are not used. Of an id with
    several texts the one with the least MD5 is taken.
    """
    marks = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    if usable is not None:
        marks = marks.filter(usable)
    marks = marks.groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("other"))
    marks = marks.filter("label = other").select("doc_id", F.col("label").cast("double"))
    short = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.octet_length("text").alias("size"))
    short = short.filter(F.coalesce("size", F.lit(0)) <= longest)
    # Ids first, so that texts are only fetched for the rows of the sample.
    order = F.xxhash64("doc_id")
    ids = short.select("doc_id").join(marks, "doc_id").distinct().orderBy(order, "doc_id").limit(rows)
    chosen = short.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "label")
    least = F.min_by(F.struct("text", "label"), F.md5("text")).alias("least")
    found = chosen.groupBy("doc_id").agg(least).select("doc_id", "least.*").toPandas()
    return found.sort_values("doc_id", ignore_index=True)
