"""Best-fit packing of documents into sequences, planned over a histogram of lengths.

The plan is made from counts alone: a token length never exceeds the sequence
length, so the histogram has at most that many entries whatever the corpus. Each
document then takes the slot that the plan holds for its rank within its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tieweave.llm.tables import arrow_schema, documents, per_batch, schema_of, table
from tieweave.llm.tokens import byte_bpe
from tieweave.session import RoundTables

LONG = T.LongType()


class Slots(NamedTuple):
    """Slots for ``count`` pieces of one length, from rank ``first_rank`` on:
    ``per_sequence`` in each sequence from ``first_sequence`` on, after ``offset``."""

    length: int
    first_rank: int
    per_sequence: int
    first_sequence: int
    offset: int


def plan_best_fit(histogram: dict[int, int], capacity: int) -> tuple[list[Slots], int]:
    """Best-fit decreasing over counts; also the number of sequences.

    The longest lengths go first, each into the open sequences with the least
    room that still holds it. After a piece is placed the same sequence has even
    less room, so best fit stays with it until the length no longer fits; whole
    ranges of alike sequences are therefore filled in one step.
    """
    slots: list[Slots] = []
    room: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    opened = 0

    def put_back(left: int, first: int, n: int) -> None:
        if left and n:
            if left not in room:
                room[left] = []
                insort(rooms, left)
            room[left].append((first, n))

    for length in sorted(histogram, reverse=True):
        todo, rank = histogram[length], 0
        while todo:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                left = rooms[at]
                first, n = room[left].pop()
                if not room[left]:
                    del room[left], rooms[at]
            else:
                left, first, n = capacity, opened, -(-todo // (capacity // length))
                opened += n
            each = left // length
            full = min(n, todo // each)
            some = todo - full * each if full < n else 0
            slots.append(Slots(length, rank, each, first, capacity - left))
            put_back(left - each * length, first, full)
            if some:
                put_back(left - some * length, first + full, 1)
            used = full + bool(some)
            put_back(left, first + used, n - used)
            rank += full * each + some
            todo -= full * each + some
    return slots, opened


def cut(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter."""
    first = (n_tokens - 1) % capacity + 1
    starts = [0, *range(first, n_tokens, capacity)]
    return list(zip(starts, np.diff([*starts, n_tokens]).tolist(), strict=True))


def pieces(docs: DataFrame, capacity: int = 2048, terminator: int = 0) -> DataFrame:
    """A row per piece, with the task that made it and its place in that task among
    the pieces of its length."""
    docs = documents(docs)
    schema = schema_of(
        docs, piece=T.IntegerType(), start=LONG, length=LONG, ids_crc32=LONG, task=LONG, place=LONG
    )

    def make():
        encode = byte_bpe()
        task = TaskContext.get().partitionId()
        seen: dict[int, int] = {}

        def work(batch: pa.RecordBatch) -> dict:
            out = {field.name: [] for field in schema}
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = np.array([*encode(text.as_py()), terminator], "<u4")
                for number, (start, length) in enumerate(cut(len(ids), capacity)):
                    place = seen.get(length, 0)
                    seen[length] = place + 1
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    row = (doc_id, number, start, length, crc, task, place)
                    for values, value in zip(out.values(), row, strict=True):
                        values.append(value)
            return out

        return work

    return per_batch(docs, make, schema)


def ranked(made: DataFrame) -> DataFrame:
    """``rank`` within the length: the place in the task after all earlier tasks.

    Only counts per task and length go through the window, so a length that a
    third of all pieces have is never sorted in one place.
    """
    counts = made.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("b"))
    return made.join(firsts, ["length", "task"]).withColumn("rank", F.col("place") + F.col("b"))


def pack(docs: DataFrame, capacity: int = 2048, terminator: int = 0) -> DataFrame:
    """Packs every document; a row per piece with its sequence and place there.

    A null or empty text is the terminator alone. Repeated rows are packed once
    each. A null ``doc_id`` is kept as null. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rounds = RoundTables(spark, "packing")
    made, _ = rounds.write(pieces(docs, capacity, terminator))
    histogram = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots, _ = plan_best_fit(histogram, capacity)
    planned = spark.sparkContext.broadcast(np.array(sorted(slots), np.int64).reshape(-1, 5))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = ranked(made).select(*kept, "rank")
    schema = T.StructType([rows.schema[n] for n in kept]).add("sequence_id", LONG).add("offset", LONG)
    arrow = arrow_schema(schema)

    def seat(batches):
        plan = planned.value
        keys = (plan[:, 0] << 48) + plan[:, 1]
        for batch in batches:
            length, rank = (batch[n].to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            at = np.searchsorted(keys, (length << 48) + rank, "right") - 1
            _, first_rank, each, first, offset = plan[at].T
            turn = rank - first_rank
            columns = [batch[n] for n in kept]
            columns += [pa.array(first + turn // each), pa.array(offset + turn % each * length)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return rows.mapInArrow(seat, schema)


def op3_best_fit_packing(spark: SparkSession, directory: str) -> DataFrame:
    return pack(table(spark, directory, "documents"))
