"""Token counts by scanning flat token files for end-of-document identifiers.

A flat file is nothing but little-endian 16-bit ids; each document is followed by one
separator and nothing says where documents begin. Files are cut into blocks, each
block is searched with vector comparisons, and a prefix scan over the blocks of a file
gives every block what the earlier ones left open.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tieweave.llm.tables import arrow_schema, documents, schema_of, table
from tieweave.session import RoundTables, scratch_path

#: Id of ``</s>`` in the vocabulary ``piece_bpe_32k``, which no text encodes to.
SEPARATOR = 2
#: Ids searched at once.
BLOCK_IDS = 1 << 20
LONG = T.LongType()


def write_flat(docs: DataFrame, path: str, model: str = "piece_bpe_32k.model") -> DataFrame:
    """Writes the ids of every whole text to flat files and returns (part, ordinal,
    doc_id): which file, by the number of the task that wrote it, and which place.

    Each row of the written text table is the ids of one document, and the separator
    is the end of line. The places come from a second read of ``docs``. Both passes take
    a checksum over the place, id and text of every row; if ``docs`` gave its rows in
    another order, or other rows, the checksums differ and the job stops.
    """
    docs = documents(docs)
    marked = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("seen"))
    place = [T.StructField("part", LONG), T.StructField("ordinal", LONG), T.StructField("seen", LONG)]

    def encode(batches):
        import public_tokenizers
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
        part, ordinal = TaskContext.get().partitionId(), 0
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                piece = batch.slice(first, 256)
                n = piece.num_rows
                ids = pieces.encode(piece["text"].to_pylist(), num_threads=1)
                made = pa.array([np.array(i, "<u2").tobytes() for i in ids], pa.binary())
                at = [pa.array(np.full(n, part)), pa.array(np.arange(ordinal, ordinal + n)), piece["seen"]]
                yield pa.RecordBatch.from_arrays([made, *at], names=["ids", "part", "ordinal", "seen"])
                ordinal += n

    lines = marked.select("text", "seen").mapInArrow(encode, T.StructType([T.StructField("ids", T.BinaryType()), *place]))
    end = SEPARATOR.to_bytes(2, "little").decode("ascii")
    check = F.bit_xor(F.xxhash64("part", "ordinal", "seen")).alias("check")
    written = Observation()
    lines = lines.observe(written, F.count(F.lit(1)).alias("rows"), check).select(F.col("ids").cast("string"))
    lines.write.option("lineSep", end).text(path)

    schema = T.StructType([*place, schema_of(docs)[0]])
    arrow = arrow_schema(schema)

    def number(batches):
        part, ordinal = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            at = [pa.array(np.full(n, part)), pa.array(np.arange(ordinal, ordinal + n))]
            yield pa.RecordBatch.from_arrays([*at, batch["seen"], batch["doc_id"]], schema=arrow)
            ordinal += n

    places = marked.select("doc_id", "seen").mapInArrow(number, schema)
    kept, numbered = RoundTables(docs.sparkSession, "places").write(places, check=F.bit_xor(F.xxhash64("part", "ordinal", "seen")))
    if (numbered["rows"], numbered["check"]) != (written.get["rows"], written.get["check"]):
        raise ValueError("two reads of the documents gave different rows or another order")
    return kept.drop("seen")


def blocks(files: DataFrame, separator: int = SEPARATOR, size: int = BLOCK_IDS) -> DataFrame:
    """A row per block of the files (path, content): its ids, those before its first
    separator, those after its last, and the counts of the documents between them.

    ``inner`` is null in a block without separators, all of which is then ``head``. A
    last odd byte of a file is no id and is left out.
    """
    schema = T.StructType([
        T.StructField("path", T.StringType()), T.StructField("block", LONG), T.StructField("n_ids", LONG),
        T.StructField("head", LONG), T.StructField("tail", LONG), T.StructField("inner", T.ArrayType(LONG)),
    ])
    arrow = arrow_schema(schema)

    def search(batches):
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                ids = np.frombuffer(content.as_buffer(), "<u2", len(content.as_buffer()) // 2)
                rows = []
                for number, at in enumerate(range(0, len(ids), size)):
                    part = ids[at : at + size]
                    ends = np.flatnonzero(part == separator)
                    if len(ends):
                        head, tail, inner = ends[0], len(part) - ends[-1] - 1, np.diff(ends) - 1
                    else:
                        head, tail, inner = len(part), 0, None
                    rows.append((path.as_py(), number, len(part), int(head), int(tail), inner))
                if rows:
                    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return files.select("path", "content").mapInArrow(search, schema)


def counts(files: DataFrame, separator: int = SEPARATOR, size: int = BLOCK_IDS) -> DataFrame:
    """(path, ordinal, start, n_tokens, ended) of every document of flat files.

    A document ends at its separator, in whichever block that is. What a file has
    after its last separator is a document that is not ``ended``, if there is any.
    """
    rows = blocks(files, separator, size)
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    found = F.col("inner").isNotNull()
    ids_before = F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("ids_before")
    docs_before = F.coalesce(
        F.sum(F.when(found, F.size("inner") + 1).otherwise(0)).over(before), F.lit(0)
    ).alias("docs_before")
    scanned = rows.select("*", ids_before, docs_before)
    # Where the open document began: after the last separator of any earlier block.
    began = F.when(found, F.col("ids_before") + F.col("n_ids") - F.col("tail"))
    scanned = scanned.withColumn("began", F.coalesce(F.max(began).over(before), F.lit(0)))
    # A last block gives its open rest; all others pass theirs on.
    last = F.col("block") == F.max("block").over(Window.partitionBy("path"))
    scanned = scanned.withColumn("last", last)
    first = F.array(F.col("ids_before") + F.col("head") - F.col("began"))
    ended = scanned.filter(found).select(
        "path", "docs_before", F.posexplode(F.concat(first, F.col("inner"))).alias("k", "n_tokens")
    )
    by_file = Window.partitionBy("path").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    done = ended.select("path", (F.col("docs_before") + F.col("k")).alias("ordinal"), "n_tokens", F.lit(True).alias("ended"))
    open_at = F.when(found, F.col("ids_before") + F.col("n_ids") - F.col("tail")).otherwise(F.col("began"))
    rest = scanned.filter("last").select(
        "path", (F.col("docs_before") + F.when(found, F.size("inner") + 1).otherwise(0)).alias("ordinal"),
        (F.col("ids_before") + F.col("n_ids") - open_at).alias("n_tokens"), F.lit(False).alias("ended"),
    ).filter("n_tokens > 0")
    begin = F.coalesce(F.sum(F.col("n_tokens") + 1).over(by_file), F.lit(0)).alias("start")
    return done.union(rest).select("path", "ordinal", begin, "n_tokens", "ended")


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, part, ordinal, start, n_tokens) of every row: its flat file, its place
    there, the ids before it and its own ids without the separator.

    Null and empty texts have no tokens and still their separator; repeated rows are
    written and counted once each. An empty table gives no rows.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "flat-tokens")
    places = write_flat(docs, path)
    files = spark.read.format("binaryFile").load(path)
    found = counts(files).withColumn("part", F.regexp_extract("path", r"part-(\d+)-[^/]*$", 1).cast("long"))
    both = places.alias("p").join(found.alias("f"), ["part", "ordinal"], "left")
    missing = F.raise_error(F.lit("a document has no place in the flat files"))
    n_tokens = F.when(F.col("n_tokens").isNull() | ~F.col("ended"), missing.cast("long")).otherwise(F.col("n_tokens"))
    return both.select("doc_id", "part", "ordinal", "start", n_tokens.alias("n_tokens"))


def op9_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    return report(table(spark, directory, "documents"))
