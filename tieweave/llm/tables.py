"""Reading tables and the Arrow plumbing that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def documents(docs: DataFrame) -> DataFrame:
    """The two columns that operators read; a null text counts as an empty one."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def spare_name(docs: DataFrame, wanted: str = "mark") -> str:
    """``wanted``, made longer until no column of ``docs`` has that name in any case."""
    taken = {name.lower() for name in docs.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def schema_of(docs: DataFrame, **columns: T.DataType) -> T.StructType:
    """``doc_id`` in the type it has in ``docs``, and further columns."""
    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType)]
    return T.StructType(fields + [T.StructField(n, kind) for n, kind in columns.items()])


def per_batch(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: T.StructType
) -> DataFrame:
    """Maps Arrow batches; ``make`` runs once per task and may load what it needs."""
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                made = work(batch)
                yield pa.RecordBatch.from_arrays(
                    [as_arrow(made[field.name], field.type) for field in arrow], schema=arrow
                )

    return df.mapInArrow(run, schema)


def as_arrow(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, type=kind)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of the texts of a batch, null as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]
