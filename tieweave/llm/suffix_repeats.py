"""Suffix-array deduplication: maximal repeats from an interval tree of common prefixes.

Stretches that share a key but not their content (see ``stretches``) are searched with
an enhanced suffix array: their suffixes in order, each with the length of the prefix
it has in common with the one before. One pass with a stack walks the tree of common-
prefix intervals; an interval whose occurrences differ in the byte to their left, or
of which one begins its stretch, cannot be extended and is a repeat group. All of its
occurrences but the earliest are repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tieweave.llm.stretches import (
    PIECES, Repeat, content, merged, mixed, numbered, removed, repeated_spans,
    running, with_spans,
)
from tieweave.llm.tables import documents, per_batch, schema_of, table, text_bytes

LENGTH, GRAM = 100, 24
#: Bytes as 64-bit symbols.
SYMBOLS = mixed(np.arange(1, 257, dtype=np.uint64))
#: What stands for the byte before a stretch's first, and for different bytes.
EDGE = -1


def byte_symbols(text: bytes) -> np.ndarray:
    return SYMBOLS[np.frombuffer(text, np.uint8)]


def byte_cut(text: bytes):
    return lambda first, last: text[first:last]


def byte_rule(length: int = LENGTH, gram: int = GRAM) -> Repeat:
    # A suffix array takes as many stretches of one key as a task hands over at once
    # anyway, so a key with many needs no more memory than many keys with few.
    return Repeat(length, gram, True, byte_symbols, byte_cut, most=PIECES, wide=1)


class SuffixArray:
    """Suffixes of some stretches, of those that share their first ``length`` bytes with
    another suffix of their key: in order, with common prefixes."""

    def __init__(self, rows: list[tuple[int, int, int, bytes]], length: int) -> None:
        keys, docs, starts, texts = zip(*rows, strict=True)
        sizes = np.array([len(text) for text in texts])
        ends = np.cumsum(sizes)
        self.text = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
        counts = np.maximum(sizes - length + 1, 0)
        piece = np.repeat(np.arange(len(rows)), counts)
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = within + (ends - sizes)[piece]
        sums = running(SYMBOLS[self.text])
        same, key = content(sums, at, at + length), np.array(keys)[piece]
        order = np.lexsort((same, key))
        new = np.concatenate([[True], (key[order][1:] != key[order][:-1]) | (same[order][1:] != same[order][:-1])])[: len(order)]
        group = np.cumsum(new) - 1
        shared = np.bincount(group)[group] > 1 if len(group) else new
        order, group = order[shared], group[shared]
        self.at, self.end = at[order], ends[piece[order]]
        self.doc = np.array(docs)[piece[order]]
        self.start = np.array(starts)[piece[order]] + within[order]
        self.left = np.where(within[order] > 0, self.text[self.at - 1].astype(np.int64), EDGE)
        self.prefix = np.zeros(len(order), np.int64)
        self._refine(group, length)

    def _refine(self, group: np.ndarray, depth: int) -> None:
        """Sorts each group by the bytes from ``depth`` on, eight at a time, and notes
        the common prefix of neighbours as they part."""
        n = len(group)
        place = np.arange(n)  # of the suffix that stands there
        live = np.arange(n)
        while len(live):
            who = place[live]
            room = np.clip(self.end[who] - self.at[who] - depth, 0, 8)
            from_ = np.minimum(self.at[who] + depth, len(self.text) - 8)
            word = np.zeros(len(live), np.uint64)
            for k in range(8):
                byte = np.where(k < room, self.text[from_ + k], 0).astype(np.uint64)
                word = (word << np.uint64(8)) | byte
            order = np.lexsort((room, word, group[live]))
            place[live] = who[order]
            word, room, here = word[order], room[order], group[live]
            apart = here[1:] == here[:-1]
            differ = word[1:] ^ word[:-1]
            zeros = 8 - (np.frexp(differ.astype(np.float64))[1] + 7) // 8
            common = np.where(differ == 0, 8, np.maximum(zeros, 0))
            # Conversion to a float may round up to the next byte; look at it again.
            top = np.minimum(common, 7).astype(np.uint64) * np.uint64(8)
            byte_differs = ((differ >> (np.uint64(56) - top)) & np.uint64(255)) > 0
            common = np.where((differ != 0) & ~byte_differs, common + 1, common)
            common = np.minimum(common, np.minimum(room[1:], room[:-1]))
            parts = apart & (common < 8)
            self.prefix[live[1:][parts]] = depth + common[parts]
            new = np.concatenate([[True], ~apart | parts])
            ids = np.cumsum(new) - 1
            group[live] = live[np.flatnonzero(new)][ids]
            live = live[np.bincount(ids)[ids] > 1]
            depth += 8
        for name in ("at", "end", "doc", "start", "left"):
            setattr(self, name, getattr(self, name)[place])


def maximal_repeats(found: SuffixArray, length: int) -> Iterator[tuple[int, int, int, list[int]]]:
    """(length, occurrences, earliest, others) of each maximal repeat, as indices.

    ``others`` are the occurrences that are not the earliest here but were so in all
    intervals within, so that each place comes up once, under its longest repeat; with
    the earliest ones of the intervals within, they are all occurrences of the group.
    """
    order = np.lexsort((found.start, found.doc))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    ranks, lefts = rank.tolist(), found.left.tolist()
    # Open intervals: length, earliest, byte to the left, occurrences, others.
    stack: list[list] = []

    def join(top: list, node: list) -> None:
        if ranks[node[1]] < ranks[top[1]]:
            top[4].append(top[1])
            top[1] = node[1]
        else:
            top[4].append(node[1])
        if node[2] != top[2]:
            top[2] = EDGE
        top[3] += node[3]

    prefixes = [*found.prefix.tolist()[1:], 0]
    for index, (common, left) in enumerate(zip(prefixes, lefts, strict=False)):
        node = [0, index, left, 1, None]
        while stack and stack[-1][0] > common:
            top = stack.pop()
            join(top, node)
            if top[2] == EDGE:
                yield top[0], top[3], top[1], top[4]
            node = top
        if common >= length:
            if stack and stack[-1][0] == common:
                join(stack[-1], node)
            else:
                stack.append([common, node[1], node[2], node[3], []])


def spans_of(rows: list[tuple[int, int, int, bytes]], length: int) -> Iterator[tuple[int, int, int]]:
    """Spans of all repeats but the earliest, of the stretches of some keys."""
    if not rows:
        return
    found = SuffixArray(rows, length)
    places: list[int] = []
    sizes: list[int] = []
    for size, _, _, others in maximal_repeats(found, length):
        places += others
        sizes += [size] * len(others)
    start = found.start[places]
    spans = merged(found.doc[places], start, start + np.array(sizes, np.int64)) if places else ((), (), ())
    yield from zip(*(np.asarray(x).tolist() for x in spans), strict=True)


def removable(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame | None]:
    """Spans (doc, start, end) of bytes covered by a string of ``length`` bytes that
    starts earlier, and the table of document numbers if there is one."""
    rows, numbers = numbered(docs)
    gram = min(GRAM, max(1, length // 4))
    return repeated_spans(rows, byte_rule(length, gram), partial(spans_of, length=length)), numbers


def report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """A row per document: n_bytes, n_removed, n_spans, kept_sha256, and the removed
    ``spans`` and ``kept`` bytes themselves.

    A null text has no bytes. Rows alike in id and text are one document and get equal
    figures each; rows of one id with different texts follow each other by MD5, and
    null ids come last. An empty table gives no rows.
    """
    docs = documents(docs)
    spans, numbers = removable(docs, length)
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = schema_of(
        docs, n_bytes=T.LongType(), n_removed=T.LongType(), n_spans=T.LongType(),
        kept_sha256=T.StringType(), spans=T.ArrayType(span), kept=T.BinaryType(),
    )

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            out = {field.name: [] for field in schema}
            out["doc_id"] = batch["doc_id"]
            for text, wanted in zip(text_bytes(batch["text"]), batch["spans"].to_pylist(), strict=True):
                gone = removed(wanted)
                edges = [0, *[x for pair in gone for x in pair], len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out["n_bytes"].append(len(text))
                out["n_removed"].append(len(text) - len(kept))
                out["n_spans"].append(len(gone))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["spans"].append([{"start": a, "end": b} for a, b in gone])
                out["kept"].append(kept)
            return out

        return work

    return per_batch(with_spans(docs, spans, numbers), make, schema)


def op1_suffix_array_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return report(table(spark, directory, "documents")).drop("spans", "kept")


OP1_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT doc_id, pos, md5(substr(h, 2 * pos + 1, 200)) AS k
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS pos FROM d WHERE len(h) >= 200)),
gone AS (
  SELECT doc_id, pos FROM windows
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, pos) > 1),
marked AS (
  SELECT doc_id, pos, CASE WHEN pos <= lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 100
    THEN 0 ELSE 1 END AS fresh FROM gone),
spans AS (
  SELECT doc_id, min(pos) AS a, max(pos) + 100 AS b
  FROM (SELECT doc_id, pos, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM marked)
  GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS a, a AS b FROM spans
  UNION ALL SELECT doc_id, max(b), NULL FROM spans GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(CASE WHEN gaps.b IS NULL THEN substr(h, 2 * gaps.a + 1)
    ELSE substr(h, 2 * gaps.a + 1, 2 * (gaps.b - gaps.a)) END, '' ORDER BY gaps.a) AS h
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
sums AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes,
  CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""
