"""SimHash near duplicates by a self-join of binary tries.

Fingerprints that differ in at most three bits agree on at least two of five bit
blocks. Every distinct fingerprint therefore goes into ten buckets, one for each
pair of blocks, and each bucket is a binary trie that is joined with itself: pairs
of nodes descend together, add up the bits in which they part and are dropped
beyond the budget. A bucket gives a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tieweave.llm.components import components
from tieweave.llm.tables import documents, per_batch, schema_of, spare_name, table, text_bytes
from tieweave.session import RoundTables

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Shingles hashed at once, so that a very long text needs no more memory.
SHINGLES = 200_000
#: A bucket with more fingerprints is joined as many pairs of subtries.
TRIE_ROWS = 1 << 14
#: Levels above which such a bucket is divided.
SPLIT_BITS = 6
#: Node pairs that descend at once, and bucket rows gathered per call.
PAIRS, ROWS = 1 << 19, 1 << 18


def fingerprint(text: bytes, width: int, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles of ``text``, each repeat with its own vote."""
    import xxhash

    words = WORD.findall(text.lower())
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(width, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), SHINGLES):
        spans = zip(starts[at : at + SHINGLES], ends[at : at + SHINGLES], strict=True)
        hashes = np.array([digest(line[a:b], seed) for a, b in spans], ">u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    bits = np.packbits(votes * 2 > len(starts))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, mark, simhash) of whole texts; only A-Z are lower-cased, null is empty.
    ``mark`` tells rows of one id with different texts apart."""

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            made = [fingerprint(text, width) for text in text_bytes(batch["text"])]
            return {"doc_id": batch["doc_id"], "mark": batch["mark"], "simhash": np.array(made, np.int64)}

        return work

    marked = documents(docs).withColumn("mark", F.md5("text"))
    return per_batch(marked, make, schema_of(docs, mark=T.StringType(), simhash=T.LongType()))


def block_masks(distance: int) -> list[int]:
    """Masks of the bits two fingerprints must share for at least one of them to
    hold: all pairs of ``distance + 2`` near-equal blocks."""
    edges = [round(64 * k / (distance + 2)) for k in range(distance + 3)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [x | y for x, y in combinations(blocks, 2)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


class Forest:
    """Components of indices under links, as arrays."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.root[i], self.root[j]
            if not (apart := a != b).any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up


def trie_links(values: np.ndarray, lo, hi, lo2, hi2, distance: int, forest: Forest) -> None:
    """Joins tries with tries: ``values`` is sorted within the ranges [lo, hi) and
    [lo2, hi2), which are equal for a trie that meets itself; links go to ``forest``."""
    zeros = {}

    def split(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
        if level not in zeros:
            bit = (values >> np.uint64(63 - level)) & np.uint64(1)
            zeros[level] = np.concatenate([[0], np.cumsum(bit == 0)])
        return a + zeros[level][b] - zeros[level][a]

    stack = [(0, lo, hi, lo2, hi2, np.zeros(len(lo), np.int8))]
    while stack:
        level, a, b, c, d, bits = stack.pop()
        if len(a) > PAIRS:
            half = len(a) // 2
            stack += [
                (level, *(x[part] for x in (a, b, c, d, bits)))
                for part in (slice(None, half), slice(half, None))
            ]
            continue
        leaf = (b - a == 1) & (d - c == 1)
        near = np.bitwise_count(values[a[leaf]] ^ values[c[leaf]]) <= distance
        forest.link(a[leaf][near], c[leaf][near])
        a, b, c, d, bits = (x[~leaf] for x in (a, b, c, d, bits))
        if not len(a):
            continue
        if level == 64:  # equal values under different places
            forest.link(a, c)
            continue
        m, n = split(a, b, level), split(c, d, level)
        own = a == c
        made = [
            (a, m, c, n, bits, np.ones_like(own)),
            (m, b, n, d, bits, np.ones_like(own)),
            (a, m, n, d, bits + 1, np.ones_like(own)),
            (m, b, c, n, bits + 1, ~own),
        ]
        parts = []
        for a1, b1, c1, d1, e1, keep in made:
            keep = keep & (b1 > a1) & (d1 > c1) & (e1 <= distance) & ~((a1 == c1) & (b1 - a1 == 1))
            parts.append([x[keep] for x in (a1, b1, c1, d1, e1)])
        stack.append((level + 1, *(np.concatenate(x) for x in zip(*parts, strict=True))))


def _bucket_forest(keys: np.ndarray, sides: np.ndarray, values: np.ndarray, distance: int):
    """Forest edges of whole buckets; rows of side 0 and 1 of a bucket are two tries
    that meet each other, side 2 one that meets itself."""
    order = np.lexsort((values, sides, keys))
    keys, sides, values = keys[order], sides[order], values[order]
    new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (sides[1:] != sides[:-1])])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(keys)]])
    forest = Forest(len(keys))
    own = sides[first] == 2
    pair = np.flatnonzero((sides[first[:-1]] == 0) & (sides[first[1:]] == 1) & (keys[first[:-1]] == keys[first[1:]]))
    lo, hi = np.concatenate([first[own], first[pair]]), np.concatenate([last[own], last[pair]])
    lo2, hi2 = np.concatenate([first[own], first[pair + 1]]), np.concatenate([last[own], last[pair + 1]])
    trie_links(values, lo, hi, lo2, hi2, distance, forest)
    child = np.flatnonzero(forest.root != np.arange(len(keys)))
    return values[child].astype(np.int64), values[forest.root[child]].astype(np.int64)


def links(prints: DataFrame, distance: int = 3) -> DataFrame:
    """Edges (u, v) between distinct fingerprints ``simhash`` that span every group
    of fingerprints linked at ``distance`` or fewer bits."""
    spark = prints.sparkSession
    masks = [_signed(mask) for mask in block_masks(distance)]
    shared = F.array(*[
        F.struct(F.lit(k).alias("table"), F.col("simhash").bitwiseAND(F.lit(mask)).alias("shared"))
        for k, mask in enumerate(masks)
    ])
    buckets = prints.select("simhash").distinct().select("simhash", F.inline(shared))
    sizes = buckets.groupBy("table", "shared").agg(F.count("*").alias("n")).filter("n > 1")
    buckets = buckets.join(sizes, ["table", "shared"])
    whole = buckets.filter(F.col("n") <= TRIE_ROWS).select(
        F.xxhash64("table", "shared").alias("bucket"), F.lit(2).alias("side"), "simhash"
    )
    # A large bucket is divided by a few bits spread over the fingerprint, as if they
    # were the first levels of its trie: subtries that differ in no more of them than
    # allowed meet each other, in a bucket of their own.
    subtrie = F.lit(0).cast("long")
    for k in range(SPLIT_BITS):
        at = 64 * k // SPLIT_BITS + 3
        bit = F.shiftrightunsigned("simhash", at).bitwiseAND(F.lit(1))
        subtrie = subtrie.bitwiseOR(F.shiftleft(bit, k))
    flips = [f for f in range(1 << SPLIT_BITS) if f.bit_count() <= distance]
    meets = F.explode(F.array(*[F.lit(f).cast("long") for f in flips]))
    divided = (
        buckets.filter(F.col("n") > TRIE_ROWS)
        .select("table", "shared", "simhash", subtrie.alias("own"), meets.alias("flip"))
        .withColumn("other", F.col("own").bitwiseXOR(F.col("flip")))
        .select(
            F.xxhash64("table", "shared", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"),
            F.when(F.col("flip") == 0, 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
            "simhash",
        )
    )
    schema = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])
    names = ["u", "v"]

    def join(batches):
        held: list[tuple] = []
        rows = 0
        for batch in batches:
            held.append(tuple(batch[n].to_numpy(zero_copy_only=False) for n in ("bucket", "side", "simhash")))
            rows += batch.num_rows
            if rows < ROWS:
                continue
            keys, sides, values = (np.concatenate(x) for x in zip(*held, strict=True))
            done = np.searchsorted(keys, keys[-1])  # the last bucket may go on
            if done:
                u, v = _bucket_forest(keys[:done], sides[:done], values[:done].view(np.uint64), distance)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=names)
            held, rows = [(keys[done:], sides[done:], values[done:])], len(keys) - done
        if rows:
            keys, sides, values = (np.concatenate(x) for x in zip(*held, strict=True))
            u, v = _bucket_forest(keys, sides, values.view(np.uint64), distance)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=names)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = whole.union(divided).repartition(parts, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(join, schema).distinct()


def grouped(docs: DataFrame, width: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """The written fingerprints, and (simhash, root): the group of each of them."""
    prints, _ = RoundTables(docs.sparkSession, "simhash").write(fingerprints(docs, width))
    roots = components(links(prints, distance))
    all_prints = prints.select("simhash").distinct()
    groups = all_prints.join(roots, F.col("simhash") == F.col("node"), "left")
    return prints, groups.select("simhash", F.coalesce("root", "simhash").alias("root"))


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Rows of one fingerprint are one node, so copies form no pairs. Texts without
    words share fingerprint zero. Repeated rows come out once each. A null doc_id
    has its row, but the component's id is the least id that is not null (null if
    there is none). An empty table gives no rows.
    """
    prints, groups = grouped(docs, width, distance)
    heads = prints.groupBy("simhash").agg(F.min("doc_id").alias("head")).join(groups, "simhash")
    least = heads.groupBy("root").agg(F.min("head").alias("component_id"))
    named = groups.join(least, "root").select("simhash", "component_id")
    return prints.join(named, "simhash").select(
        "doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, width: int = 3, distance: int = 3) -> DataFrame:
    """The row with the least id of every group of near duplicates, all columns kept;
    a null id stays only if the group has no other, and of rows of one id the one
    with the least MD5 of its text."""
    prints, groups = grouped(docs, width, distance)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("first")
    heads = prints.groupBy("simhash").agg(first).join(groups, "simhash")
    chosen = heads.groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", "first.mark")
    mark = spare_name(docs)
    marked = docs.withColumn(mark, F.md5(F.coalesce(docs["text"], F.lit(""))))
    same = marked["doc_id"].eqNullSafe(chosen["doc_id"]) & (marked[mark] == chosen["mark"])
    kept = marked.join(chosen, same, "left_semi")
    return kept.dropDuplicates(["doc_id", mark]).select(*docs.columns)


def op5_simhash_near_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return near_duplicates(table(spark, directory, "documents"), width=3, distance=3)
