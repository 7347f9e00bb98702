"""Alignment of the tokens of two tokenizers by the bytes they cover.

The tokens of both are intervals of bytes. Sorted by start, with a running maximum of
the ends, they fall into groups: one breaks off where a start reaches the maximum so
far. Within the groups every pair of tokens that share bytes is a link. Links are
counted over the corpus, by documents, to tell which token of B usually answers to a
token of A.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tieweave.llm.tables import arrow_schema, documents, schema_of, table
from tieweave.llm.tokens import rank_file
from tieweave.session import RoundTables

#: Bytes of text that are aligned at once.
CHUNK = 1 << 20
#: Pairs whose counts are sent to every executor, the most frequent first: three
#: numbers each. The counts of the others are joined.
SENT_PAIRS = 1_000_000
LONG, INT = T.LongType(), T.IntegerType()


@dataclass(frozen=True)
class Vocabulary:
    """An encoder of many texts, and the bytes of every id."""

    encode: object
    pieces: list[bytes]

    @property
    def lengths(self) -> np.ndarray:
        return np.array([len(piece) for piece in self.pieces], np.int64)


def byte_level(ranks_name: str = "byte_bpe_50k.tiktoken") -> Vocabulary:
    """The byte-level vocabulary; texts are encoded after a space, and written forms of
    special tokens are plain text."""
    encoding, pieces = rank_file(ranks_name)
    return Vocabulary(lambda texts: [encoding.encode_ordinary(" " + text) for text in texts], pieces)


def by_pieces(model: str = "piece_bpe_32k.model") -> Vocabulary:
    """The vocabulary of pieces, whose model puts a space before the text itself."""
    import public_tokenizers
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
    written = pieces.id_to_piece(list(range(pieces.get_piece_size())))
    made = [
        bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()
        for i, p in enumerate(written)
    ]
    return Vocabulary(lambda texts: pieces.encode(texts, num_threads=1), made)


@cache
def vocabularies() -> tuple[Vocabulary, Vocabulary]:
    return byte_level(), by_pieces()


def coalesced(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The number of the group of each interval: groups share no bytes, and are as
    small as that allows."""
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.zeros(len(order), np.int64)
    breaks[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks)
    return group


def overlaps(a_start, a_end, b_start, b_end) -> tuple[np.ndarray, np.ndarray]:
    """Places (in A, in B) of all pairs that share bytes; both sides are sorted and
    do not overlap themselves, so those of one A token are neighbours in B."""
    first = np.searchsorted(b_end, a_start, "right")
    count = np.searchsorted(b_start, a_end, "left") - first
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(np.arange(len(a_start)), count), within + np.repeat(first, count)


class Aligned:
    """The tokens of some texts in both vocabularies, in groups and linked.

    ``ids``, ``doc`` and ``group`` hold a pair of arrays each, for A and B; ``links`` are
    places in both. Texts whose tokens do not cover just their bytes after a space have none.
    """

    def __init__(self, texts: list[str], a: Vocabulary, b: Vocabulary) -> None:
        self.n = len(texts)
        kept, raw, ids = [], [], ([], [])
        full = [k for k, text in enumerate(texts) if text]
        chosen = [texts[k] for k in full]
        for k, text, in_a, in_b in zip(full, chosen, a.encode(chosen), b.encode(chosen), strict=True):
            wanted = b" " + text.encode()
            if all(b"".join([v.pieces[i] for i in own]) == wanted for v, own in ((a, in_a), (b, in_b))):
                kept.append(k)
                raw.append(len(wanted))
                ids[0].append(np.array(in_a, np.int64))
                ids[1].append(np.array(in_b, np.int64))
        none = [np.zeros(0, np.int64)]
        base = np.cumsum([0, *raw])
        self.ids = tuple(np.concatenate(side or none) for side in ids)
        places = [np.repeat(np.arange(len(kept)), [len(own) for own in side]) for side in ids]
        self.doc = tuple(np.array(kept, np.int64)[place] if kept else place for place in places)
        # Texts lie one after the other, so tokens of different texts never meet.
        length = [v.lengths[own] for v, own in zip((a, b), self.ids, strict=True)]
        end = [np.cumsum(own) for own in length]
        start = [e - own for e, own in zip(end, length, strict=True)]
        assert all(not len(e) or e[-1] == base[-1] for e in end)
        group = coalesced(np.concatenate(start), np.concatenate(end))
        self.group = group[: len(start[0])], group[len(start[0]) :]
        self.links = overlaps(start[0], end[0], start[1], end[1])

    def per_text(self, which: np.ndarray) -> np.ndarray:
        return np.bincount(which, minlength=self.n)

    def n_groups(self) -> np.ndarray:
        first = np.flatnonzero(np.diff(self.group[0], prepend=-1))
        return self.per_text(self.doc[0][first])

    def written(self) -> list[bytes]:
        """The groups of every text: ``a1,a2|b1;a3|b2,b3``."""
        doc = np.concatenate(self.doc)
        side = np.repeat([0, 1], [len(own) for own in self.ids])
        group = np.concatenate(self.group)
        order = np.lexsort((side, group))
        ids, side, group, doc = np.concatenate(self.ids)[order], side[order], group[order], doc[order]
        digits = np.array([b"%d" % i for i in range(int(ids.max(initial=0)) + 1)])
        width = digits.dtype.itemsize
        signs = np.zeros((len(ids), width + 1), np.uint8)
        signs[:, :width] = digits.view(np.uint8).reshape(-1, width)[ids]
        # What follows an id: the next of its side, the other side, the next group.
        next_side = np.append(side[1:], 0) != side
        next_group = np.append(group[1:], -1) != group
        after = np.where(next_group, ord(";"), np.where(next_side, ord("|"), ord(","))).astype(np.uint8)
        signs[:, width] = after
        sizes = (signs != 0).sum(1)
        whole = signs[signs != 0].tobytes()
        ends = np.cumsum(np.bincount(doc, weights=sizes, minlength=self.n)).astype(np.int64)
        return [whole[x : max(x, y - 1)] for x, y in zip(np.append(0, ends[:-1]), ends, strict=True)]

    def pairs(self, b_size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, times): the different linked id pairs of every text, a pair being
        the A id times ``b_size`` plus the B id."""
        at_a, at_b = self.links
        pair = self.ids[0][at_a] * b_size + self.ids[1][at_b]
        span = int(pair.max(initial=0)) + 1
        both, times = np.unique(self.doc[0][at_a] * span + pair, return_counts=True)
        return both // span, both % span, times


def chunks(texts: pa.Array, size: int = CHUNK):
    """(first, texts) of runs of about ``size`` bytes, one text at least."""
    sizes = np.cumsum([len(value or b"") for value in texts.cast(pa.binary()).to_pylist()])
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(sizes, (sizes[first - 1] if first else 0) + size, "right"))
        last = max(last, first + 1)
        yield first, texts.slice(first, last - first).to_pylist()
        first = last


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, groups): the groups of every document, ``a1,a2|b1;a3|b2,b3`` with the ids
    of A and B in order; empty for a text without tokens."""
    schema = schema_of(docs, groups=T.StringType())
    arrow = arrow_schema(schema)

    def run(batches):
        a, b = vocabularies()
        for batch in batches:
            for first, texts in chunks(batch["text"]):
                made = pa.array([w.decode() for w in Aligned(texts, a, b).written()], pa.string())
                ids = batch["doc_id"].slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([ids, made], schema=arrow)

    return documents(docs).mapInArrow(run, schema)


def linked(docs: DataFrame) -> DataFrame:
    """A row per document: ``row`` (a number of its own), doc_id, n_a, n_b, n_groups,
    n_links, groups_sha256, and its linked pairs with how often each occurs in it."""
    schema = T.StructType([T.StructField("row", LONG), *schema_of(docs, n_a=LONG, n_b=LONG, n_groups=LONG, n_links=LONG)])
    schema.add("groups_sha256", T.StringType())
    schema.add("pairs", T.ArrayType(LONG)).add("times", T.ArrayType(INT))
    arrow = arrow_schema(schema)

    def run(batches):
        a, b = vocabularies()
        seen = TaskContext.get().partitionId() << 33
        for batch in batches:
            for first, texts in chunks(batch["text"]):
                made = Aligned(texts, a, b)
                text, pair, times = made.pairs(len(b.pieces))
                at = pa.array(np.searchsorted(text, np.arange(made.n + 1)), pa.int32())
                columns = [
                    pa.array(np.arange(seen, seen + made.n)), batch["doc_id"].slice(first, made.n),
                    *[pa.array(made.per_text(d)) for d in made.doc], pa.array(made.n_groups()),
                    pa.array(made.per_text(made.doc[0][made.links[0]])),
                    pa.array([hashlib.sha256(w).hexdigest() if w else "" for w in made.written()], pa.string()),
                    pa.ListArray.from_arrays(at, pa.array(pair)),
                    pa.ListArray.from_arrays(at, pa.array(times.astype(np.int32))),
                ]
                columns = [c.cast(f.type) for c, f in zip(columns, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
                seen += made.n

    return documents(docs).mapInArrow(run, schema)


def translations(made: DataFrame) -> DataFrame:
    """(pair, count, best) over rows of ``linked``: in how many documents a pair is
    linked, and whether no other pair of its A id is in more."""
    a = (F.col("pair") / F.lit(len(vocabularies()[1].pieces))).cast("long").alias("a")
    counts = made.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("count"))
    counts, _ = RoundTables(made.sparkSession, "pairs").write(counts.select("pair", "count", a))
    top = counts.groupBy("a").agg(F.max("count").alias("top"))
    return counts.join(top, "a").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def scored(made: DataFrame, counts: DataFrame, sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """(row, n_best, count_sum) of every row of ``linked`` that has pairs.

    The counts of the most frequent pairs, as many powers of two as fit into
    ``sent_pairs`` rows, are sent to all executors. They answer for almost all links
    and for every pair that many documents have; the links of rarer pairs are joined.
    """
    level = F.floor(F.log2("count"))
    sizes = counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect()
    least, sent = None, 0
    for size in sizes:
        sent += size["n"]
        if sent > sent_pairs:
            break
        least = size["level"]
    sums = [
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("long").alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    ]
    links = made.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times")
    )
    often = F.lit(False) if least is None else level >= least
    near = links.join(F.broadcast(counts.filter(often)), "pair", "left") if least is not None else links
    if least is not None and sent <= sent_pairs:
        return near.groupBy("row").agg(*sums)
    rare = near.filter("count IS NULL").select(*links.columns) if least is not None else links
    parts = rare.join(counts.filter(~often), "pair").groupBy("row").agg(*sums)
    if least is not None:
        parts = parts.unionByName(near.filter("count IS NOT NULL").groupBy("row").agg(*sums))
    return parts.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def aligned(docs: DataFrame, sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """A row per document with counts of its tokens, groups and links, the hash of its
    groups, and how usual its links are in ``docs``.

    A null or empty text, and one whose tokens do not give back its bytes after a
    space, has no tokens and zeros. Repeated rows have a row each and count as documents each. A
    null ``doc_id`` stays null. An empty table gives no rows.
    """
    rounds = RoundTables(docs.sparkSession, "alignment")
    made, _ = rounds.write(linked(docs))
    counts, _ = rounds.write(translations(made))
    sums = scored(made, counts, sent_pairs)
    nothing = F.lit(0).cast("long")
    return made.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", nothing).alias("n_best"),
        F.coalesce("count_sum", nothing).alias("count_sum"), "groups_sha256",
    )


def op12_token_alignment(spark: SparkSession, directory: str) -> DataFrame:
    return aligned(table(spark, directory, "documents"))
