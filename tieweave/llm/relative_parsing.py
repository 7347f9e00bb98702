"""Substring dedup by relative Lempel-Ziv parsing of documents against earlier ones.

The reference is cut into blocks: a block holds the stretches of one key (see
``stretches``) in the order of their documents, and an index of all their windows. A
stretch is factored greedily against the block as far as earlier documents fill it:
the longest continuation of the first match is a factor, and after a factor the
windows across its end are looked up one by one before the next factor begins. Factors
of a window's length or more are repeats.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tieweave.llm.stretches import (
    Repeat, content, numbered, removed, repeated_spans, running, with_spans,
)
from tieweave.llm.suffix_repeats import SYMBOLS
from tieweave.llm.tables import documents, per_batch, schema_of, table, text_bytes

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
WINDOW, GRAM = 50, 6
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_symbols(text: bytes) -> np.ndarray:
    """A 64-bit hash of every word."""
    raw = np.frombuffer(text, np.uint8)
    inside = np.concatenate([[False], ~_SPACE[raw], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return content(running(SYMBOLS[raw]), edges[::2], edges[1::2])


def word_cut(text: bytes):
    words = WORD.findall(text)
    return lambda first, last: b" ".join(words[first:last])


def word_rule(window: int = WINDOW, gram: int = GRAM) -> Repeat:
    return Repeat(window, gram, False, word_symbols, word_cut)


def factors(words: list[bytes], index: dict, block: list[list[bytes]], window: int) -> Iterator[tuple[int, int]]:
    """Places of the factors of at least ``window`` words of one stretch."""
    at, last = 0, len(words) - window
    while at <= last:
        found = index.get(tuple(words[at : at + window]))
        if found is None:
            at += 1
            continue
        reference, place = block[found[0]], found[1]
        end, there = at + window, place + window
        while end < len(words) and there < len(reference) and words[end] == reference[there]:
            end, there = end + 1, there + 1
        yield at, end
        # The next window is the first that goes across the end of this factor.
        at = end - window + 1


def spans_of(rows: list[tuple[int, int, int, bytes]], window: int) -> Iterator[tuple[int, int, int]]:
    """Spans of the factors of all stretches of some keys, sorted by key and doc."""
    for _, of_key in groupby(rows, key=lambda row: row[0]):
        block: list[list[bytes]] = []
        index: dict[tuple, tuple[int, int]] = {}
        for doc, of_doc in groupby(of_key, key=lambda row: row[1]):
            mine = [(start, piece.split(b" ")) for _, _, start, piece in of_doc]
            for start, words in mine:
                for first, end in factors(words, index, block, window):
                    yield doc, start + first, start + end
            for _, words in mine:
                block.append(words)
                for at in range(len(words) - window + 1):
                    index.setdefault(tuple(words[at : at + window]), (len(block) - 1, at))


def report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """A row per document: n_words, n_removed, kept_sha256, and the removed ``spans`` of
    words and the ``kept`` text.

    A null text has no words. Rows alike in id and text are one document and get equal
    figures each; rows of one id with different texts follow each other by MD5, and
    null ids come last. An empty table gives no rows.
    """
    docs = documents(docs)
    rows, numbers = numbered(docs)
    rule = word_rule(window, min(GRAM, max(1, window // 4)))
    spans = repeated_spans(rows, rule, partial(spans_of, window=window))
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = schema_of(
        docs, n_words=T.LongType(), n_removed=T.LongType(), kept_sha256=T.StringType(),
        spans=T.ArrayType(span), kept=T.BinaryType(),
    )

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            out = {field.name: [] for field in schema}
            out["doc_id"] = batch["doc_id"]
            for text, wanted in zip(text_bytes(batch["text"]), batch["spans"].to_pylist(), strict=True):
                words, gone = WORD.findall(text), removed(wanted)
                edges = [0, *[x for pair in gone for x in pair], len(words)]
                left = [w for a, b in zip(edges[::2], edges[1::2], strict=True) for w in words[a:b]]
                kept = b" ".join(left)
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(left))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["spans"].append([{"start": a, "end": b} for a, b in gone])
                out["kept"].append(kept)
            return out

        return work

    return per_batch(with_spans(docs, spans, numbers), make, schema)


def op10_substring_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return report(table(spark, directory, "documents")).drop("spans", "kept")


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, pos, md5(array_to_string(list_slice(w, pos, pos + 49), ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS pos FROM d WHERE len(w) >= 50)),
firsts AS (SELECT k, min(doc_id) AS first_doc FROM windows GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS word
  FROM windows JOIN firsts USING (k) WHERE first_doc < doc_id),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS word, unnest(w) AS t FROM d),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(t, ' ' ORDER BY word) AS t
  FROM words ANTI JOIN gone USING (doc_id, word) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words,
  CAST(len(d.w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
