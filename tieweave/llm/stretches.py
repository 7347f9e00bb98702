"""Long repeats across documents: which windows of a fixed length occur twice.

A *window* is so many consecutive symbols (bytes or words) of one document. The least
hash of the short grams inside a window is its key, so equal windows have equal keys
wherever they are. Neighbouring windows mostly share their key; such a run is a
*stretch*, and stretches of one key meet in one task.

1. Stretches of equal content are settled by their hashes (64 bits of key and 64 of
   content): one is the first, all others are repeats as a whole. Each batch settles
   its own before anything is shuffled, so a passage that a third of all documents
   share sends one row per batch.
2. Where stretches of one key differ in content, as at the edges of copies, the texts
   of the first ones are fetched and given to the method of the operator, which finds
   the repeats within them exactly.
3. A key with too many different stretches for one task goes to no method: each of its
   windows is a stretch of its own, under a key made of its content, and 1. settles it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tieweave.session import RoundTables, sent_whole

#: Symbols that are hashed at once.
SLICE = 1 << 19
#: A key with more different stretches has its windows settled one by one, unless the
#: operator hands more to its method.
HOT_PIECES = 1_000
#: Rows that a task resolves, and pieces whose keys it hands to the method, at once.
ROWS, PIECES = 1 << 18, 1 << 14
_BASE = 0x9E3779B97F4A7C15
_SEEDS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)


@dataclass(frozen=True)
class Repeat:
    """What counts as a repeat: ``window`` symbols, grams of ``gram`` symbols for the
    keys, and whether an earlier place in the same document counts as earlier."""

    window: int
    gram: int
    same_document: bool
    #: Text to symbols, as 64-bit numbers; equal symbols have equal numbers.
    symbols: Callable[[bytes], np.ndarray]
    #: Text, first and last symbol to the bytes that a method needs.
    cut: Callable[[bytes], Callable[[int, int], bytes]]
    #: Stretches of one key that the method takes, each with ``wide`` times ``window``
    #: windows on the average.
    most: int = HOT_PIECES
    wide: int = 4


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spreads 64-bit numbers over all bits."""
    x = values ^ np.uint64(seed)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, from 0 to ``n``."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n, SLICE * 2) + 1
        inverse = pow(_BASE, -1, 1 << 64)
        _powers[:] = [
            np.cumprod(np.append(np.uint64(1), np.full(size, b, np.uint64)), dtype=np.uint64)
            for b in (_BASE, inverse)
        ]
    return _powers[0], _powers[1]


def running(symbols: np.ndarray) -> np.ndarray:
    up, _ = powers(len(symbols))
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(symbols * up[: len(symbols)], dtype=np.uint64)])


def content(sums: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of the symbols from ``first`` to before ``last``."""
    _, down = powers(len(sums))
    return mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64) * np.uint64(_SEEDS[1]))


def least_grams(symbols: np.ndarray, window: int, gram: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Least gram hash of the window that begins at each place, and whether the window
    has that gram more than once."""
    sums = running(symbols)
    starts = np.arange(len(symbols) - gram + 1)
    least = mixed(content(sums, starts, starts + gram), seed)
    twice = np.zeros(len(least), bool)
    grams = window - gram + 1
    whole = None
    width = 1
    # Windows are put together of neighbouring parts of 1, 2, 4 ... grams.
    while True:
        if grams & width:
            whole = (least, twice, width) if whole is None else (*_beside(*whole, least, twice), whole[2] + width)
        if width * 2 > grams:
            n = len(symbols) - window + 1
            return whole[0][:n], whole[1][:n]
        least, twice = _beside(least, twice, width, least, twice)
        width *= 2


def _beside(first: np.ndarray, twice: np.ndarray, width: int, second: np.ndarray, again: np.ndarray):
    """Least and repeats of each part of ``width`` grams and the part right after it."""
    after, again = second[width:], again[width:]
    n = min(len(first), len(after))
    first, twice, after, again = first[:n], twice[:n], after[:n], again[:n]
    return np.minimum(first, after), (twice & (first <= after)) | (again & (after <= first)) | (first == after)


def _runs(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and lengths of runs; ``new`` tells where one begins."""
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(new)))


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Union of the spans of each document."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    first_of_doc = np.concatenate([[True], doc[1:] != doc[:-1]])
    # The furthest end so far within the document, by one running maximum.
    rank = np.cumsum(first_of_doc)
    lift = rank * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift) - lift
    new = first_of_doc.copy()
    new[1:] |= start[1:] > reach[:-1]
    first, _ = _runs(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], reach[last]


def stretches_of(parts: list[tuple[int, int, np.ndarray]], rule: Repeat):
    """Stretches of some slices (document, place, symbols): arrays key, content, doc,
    start and number of windows, and spans (doc, start, end) already known to repeat."""
    sizes = np.array([len(s) for _, _, s in parts])
    ends = np.cumsum(sizes)
    symbols = np.concatenate([s for _, _, s in parts])
    counts = np.maximum(sizes - rule.window + 1, 0)
    if not counts.any():
        none = np.zeros(0, np.int64)
        return [none.astype(np.uint64)] * 2 + [none] * 3, [none] * 3
    least, twice = least_grams(symbols, rule.window, rule.gram, _SEEDS[0])
    part = np.repeat(np.arange(len(parts)), counts)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = within + (ends - sizes)[part]
    key = least[at]
    docs = np.array([d for d, _, _ in parts])
    shift = np.array([place for _, place, _ in parts]) - (ends - sizes)
    sums = running(symbols)

    def breaks() -> np.ndarray:
        return np.concatenate([[True], (key[1:] != key[:-1]) | (at[1:] != at[:-1] + 1) | (part[1:] != part[:-1])])

    spans = [np.zeros(0, np.int64)] * 3
    first, n = _runs(breaks())
    # Equal windows lie in one stretch only if some window has its gram twice, or if
    # the stretch outlives its gram.
    lively = (n > rule.window - rule.gram + 1) | (np.add.reduceat(twice[at].astype(np.int64), first) > 0)
    if rule.same_document and lively.any():
        # Text that repeats itself at once: all but the first of its equal windows are
        # repeats.
        long = np.repeat(lively, n)
        chosen = np.flatnonzero(long)
        same = content(sums, at[chosen], at[chosen] + rule.window)
        order = np.lexsort((at[chosen], same, docs[part[chosen]]))
        a, b = chosen[order[1:]], chosen[order[:-1]]
        again = (same[order[1:]] == same[order[:-1]]) & (docs[part[a]] == docs[part[b]])
        gone = np.zeros(len(at), bool)
        gone[a[again]] = True
        begin = at[gone] + shift[part[gone]]
        spans = list(merged(docs[part[gone]], begin, begin + rule.window))
        part, at, key = part[~gone], at[~gone], key[~gone]
        first, n = _runs(breaks())
    else:
        # Otherwise long stretches are cut; they meet under their key all the same.
        most = 4 * rule.window
        if (n > most).any():
            first = np.concatenate([np.arange(a, a + size, most) for a, size in zip(first, n, strict=True)])
            n = np.diff(np.append(first, len(at)))
    place = at[first]
    hashes = content(sums, place, place + n + rule.window - 1)
    owner = part[first]
    return [key[first], hashes, docs[owner], place + shift[owner], n], spans


def settle(key, same, doc, start, n, rule: Repeat):
    """Of equal stretches keeps those that may be first; the rest become spans."""
    order = np.lexsort((start, doc, same, key))
    key, same, doc, start, n = (x[order] for x in (key, same, doc, start, n))
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (same[1:] != same[:-1])]) if len(key) else np.zeros(0, bool)
    first, sizes = _runs(new)
    stays = new if rule.same_document else doc == np.repeat(doc[first], sizes)
    spans = merged(doc[~stays], start[~stays], start[~stays] + n[~stays] + rule.window - 1)
    return (key[stays], same[stays], doc[stays], start[stays], n[stays]), spans


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64))


STRETCH = T.StructType([T.StructField(n, T.LongType()) for n in ("key", "content", "doc", "start", "size")])
STRETCH.add("span", T.BooleanType())


def all_stretches(docs: DataFrame, rule: Repeat) -> DataFrame:
    """Stretches of ``docs`` (doc, text), settled per batch, and the spans that go with
    them: rows with ``span``, whose size is in symbols and not in windows."""

    def run(batches):
        for batch in batches:
            found, spans, parts, held = [], [], [], 0

            def flush():
                rows, known = stretches_of(parts, rule)
                found.append(rows)
                spans.append(known)

            for doc, text in zip(batch["doc"].to_pylist(), batch["text"], strict=True):
                symbols = rule.symbols(text.as_buffer().to_pybytes() if text.is_valid else b"")
                for at in range(0, max(1, len(symbols) - rule.window + 1), SLICE):
                    part = symbols[at : at + SLICE + rule.window - 1]
                    if held and held + len(part) > SLICE:
                        flush()
                        parts, held = [], 0
                    parts.append((doc, at, part))
                    held += len(part)
            if parts:
                flush()
            if not found:
                continue
            rows, known = settle(*(np.concatenate(x) for x in zip(*found, strict=True)), rule)
            spans.append(known)
            doc, start, end = merged(*(np.concatenate(x) for x in zip(*spans, strict=True)))
            zero = np.zeros(len(doc), np.int64)
            columns = [
                np.concatenate([rows[0].view(np.int64), mixed(doc.view(np.uint64)).view(np.int64)]),
                np.concatenate([rows[1].view(np.int64), zero]), np.concatenate([rows[2], doc]),
                np.concatenate([rows[3], start]), np.concatenate([rows[4], end - start]),
            ]
            flags = pa.array(np.arange(len(columns[0])) >= len(rows[0]))
            yield pa.RecordBatch.from_arrays([*map(_signed, columns), flags], names=STRETCH.names)

    return docs.select("doc", F.col("text").cast("binary").alias("text")).mapInArrow(run, STRETCH)


RESOLVED = T.StructType([T.StructField(n, T.LongType()) for n in ("key", "doc", "start", "size")])
RESOLVED.add("span", T.BooleanType())


def resolved(rows: DataFrame, rule: Repeat) -> DataFrame:
    """Goes once through sorted stretches: all but the first of equal ones become
    spans, and first ones that share their key with different ones are asked for.

    Whatever a key has, only the last row is carried from batch to batch.
    """

    def run(batches):
        last = None  # key, content, first doc, and the open first row with its mark
        for batch in batches:
            span = batch["span"].to_numpy(zero_copy_only=False)
            key, same, doc, start, size = (
                batch[n].to_numpy(zero_copy_only=False) for n in ("key", "content", "doc", "start", "size")
            )
            out = [(key[span], doc[span], start[span], size[span], np.ones(span.sum(), bool))]
            key, same, doc, start, size = (x[~span] for x in (key, same, doc, start, size))
            if len(key):
                new = np.concatenate([[True], (key[1:] != key[:-1]) | (same[1:] != same[:-1])])
                if last is not None:
                    new[0] = key[0] != last["key"] or same[0] != last["content"]
                firsts = np.flatnonzero(new)
                run_of = np.cumsum(new) - 1
                head = np.append(doc[firsts], 0)[run_of]
                if last is not None:
                    head = np.where(run_of < 0, last["doc"], head)
                later = ~new if rule.same_document else doc != head
                out.append((key[later], doc[later], start[later], size[later] + rule.window - 1, np.ones(later.sum(), bool)))
                # Of the rows that stay, those of one key with more than one content.
                stays = np.flatnonzero(~later)
                k, c = key[stays], same[stays]
                if last is not None and last["open"]:
                    o = last["open"]
                    k, c = np.append(o["key"], k), np.append(o["content"], c)
                    d, s, n = (np.append(o[f], x[stays]) for f, x in (("doc", doc), ("start", start), ("size", size)))
                    wanted = np.append(o["wanted"], np.zeros(len(stays), bool))
                else:
                    d, s, n, wanted = doc[stays], start[stays], size[stays], np.zeros(len(stays), bool)
                if len(k):
                    if last is not None and not last["open"]:
                        wanted |= (k == last["key"]) & last["many"]
                    group, sizes = _runs(np.concatenate([[True], k[1:] != k[:-1]]))
                    many = np.repeat(np.minimum.reduceat(c, group) != np.maximum.reduceat(c, group), sizes)
                    marked = np.repeat(np.maximum.reduceat(wanted.astype(np.int8), group) > 0, sizes)
                    wanted = wanted | many | marked
                    # The rows of the last key that are not wanted yet stay open; there
                    # is one content among them, and in one document.
                    keep = (k == k[-1]) & ~wanted
                    rows = wanted
                    out.append((k[rows], d[rows], s[rows], n[rows], np.zeros(rows.sum(), bool)))
                    opened = {"key": k[keep], "content": c[keep], "doc": d[keep], "start": s[keep], "size": n[keep], "wanted": wanted[keep]}
                    many_now = bool(wanted[-1])
                else:
                    opened, many_now = None, last["many"]
                last = {
                    "key": key[-1], "content": same[-1], "doc": head[-1], "many": many_now,
                    "open": opened if opened and len(opened["key"]) else None,
                }
            columns = [np.concatenate(x) for x in zip(*out, strict=True)]
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays([*map(_signed, columns[:4]), pa.array(columns[4])], names=RESOLVED.names)

    return rows.mapInArrow(run, RESOLVED)


PIECE = T.StructType([T.StructField(n, T.LongType()) for n in ("key", "doc", "start")]).add("piece", T.BinaryType())


def asked_of(docs: DataFrame, wanted: DataFrame, rule: Repeat, hot_pieces: int) -> tuple[DataFrame, bool]:
    """(doc, text, wanted) for the documents of the wanted stretches, each with whether
    its key is hot, and whether any is: it has more stretches than ``hot_pieces``, or as
    many windows as so many wide ones."""
    sizes = wanted.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("windows"))
    sizes = sizes.filter((F.col("n") > hot_pieces) | (F.col("windows") > hot_pieces * rule.wide * rule.window))
    sizes = sizes.select("key", F.lit(True).alias("hot"))
    hot = sizes.count()
    marked = wanted.join(sent_whole(sizes, hot), "key", "left")
    by_doc = marked.groupBy("doc").agg(F.collect_list(F.struct("key", "start", "size", "hot")).alias("wanted"))
    both = docs.join(by_doc, "doc").select("doc", F.col("text").cast("binary").alias("text"), "wanted")
    return both, hot > 0


def pieces(asked: DataFrame, rule: Repeat) -> DataFrame:
    """The texts (key, doc, start, piece) of the stretches whose key is not hot."""

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for doc, text, wants in zip(batch["doc"].to_pylist(), batch["text"], batch["wanted"].to_pylist(), strict=True):
                cut = None
                for want in wants:
                    if not want["hot"]:
                        cut = cut or rule.cut(text.as_buffer().to_pybytes())
                        first, n = want["start"], want["size"]
                        out.append((want["key"], doc, first, cut(first, first + n + rule.window - 1)))
                if len(out) > PIECES:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=PIECE.names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=PIECE.names)

    return asked.mapInArrow(run, PIECE)


def hot_windows(asked: DataFrame, rule: Repeat) -> DataFrame:
    """Every window of the stretches with hot keys as a stretch, settled some at a time.

    The key is the old key with one hash of the window, the content another: equal
    windows meet, and no key has others.
    """

    def run(batches):
        held: list[list[np.ndarray]] = []
        n = 0

        def made():
            rows, (doc, start, end) = settle(*(np.concatenate(x) for x in zip(*held, strict=True)), rule)
            zero = np.zeros(len(doc), np.int64)
            columns = [
                np.concatenate([rows[0].view(np.int64), mixed(doc.view(np.uint64)).view(np.int64)]),
                np.concatenate([rows[1].view(np.int64), zero]), np.concatenate([rows[2], doc]),
                np.concatenate([rows[3], start]), np.concatenate([rows[4], end - start]),
            ]
            flags = pa.array(np.arange(len(columns[0])) >= len(rows[0]))
            return pa.RecordBatch.from_arrays([*map(_signed, columns), flags], names=STRETCH.names)

        for batch in batches:
            for doc, text, wants in zip(batch["doc"].to_pylist(), batch["text"], batch["wanted"].to_pylist(), strict=True):
                symbols = None
                for want in wants:
                    if not want["hot"]:
                        continue
                    symbols = rule.symbols(text.as_buffer().to_pybytes()) if symbols is None else symbols
                    part = symbols[want["start"] : want["start"] + want["size"] + rule.window - 1]
                    at = np.arange(want["size"])
                    old = np.full(len(at), want["key"]).astype(np.int64).view(np.uint64)
                    key = mixed(old * np.uint64(_BASE) + content(running(part), at, at + rule.window))
                    same = content(running(mixed(part, _SEEDS[2])), at, at + rule.window)
                    held.append([key, same, np.full(len(at), doc), want["start"] + at, np.ones(len(at), np.int64)])
                    n += len(at)
                    if n >= ROWS:
                        yield made()
                        held, n = [], 0
        if held:
            yield made()

    return asked.mapInArrow(run, STRETCH)


Method = Callable[[list[tuple[int, int, int, bytes]]], Iterator[tuple[int, int, int]]]


def by_key(rows: DataFrame, method: Method, schema: str | T.StructType = "doc long, start long, end long") -> DataFrame:
    """Hands whole keys, sorted by key, doc and start, to ``method``, many keys at once."""
    names = T.StructType.fromDDL(schema).names if isinstance(schema, str) else schema.names

    def run(batches):
        held: list[tuple] = []

        def made(part):
            rows = list(method(part))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=names)

        for batch in batches:
            held += zip(*(batch[n].to_pylist() for n in PIECE.names), strict=True)
            if len(held) >= PIECES and held[0][0] != held[-1][0]:
                at = len(held) - 1
                while held[at - 1][0] == held[-1][0]:
                    at -= 1
                yield from made(held[:at])
                held = held[at:]
        yield from made(held)

    return rows.mapInArrow(run, schema)


def numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(doc, text) with a number per row that orders documents, and the table (doc_id,
    mark, doc) that leads from rows to numbers if the number is not the id itself.

    Ids that are whole numbers, not null and there once are used as they are. Otherwise
    rows alike in id and text are one document, and documents are numbered by id, nulls
    last, then by the MD5 of the text.
    """
    whole = isinstance(docs.schema["doc_id"].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    if whole:
        odd = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 OR doc_id IS NULL")
        if odd.isEmpty():
            return docs.select(F.col("doc_id").cast("long").alias("doc"), "text"), None
    marked = docs.select("doc_id", "text", F.md5("text").alias("mark"))
    order = marked.select("doc_id", "mark").distinct().orderBy(F.col("doc_id").asc_nulls_last(), "mark")
    numbers, _ = RoundTables(docs.sparkSession, "numbers").write(
        order.withColumn("doc", F.monotonically_increasing_id())
    )
    same = marked["doc_id"].eqNullSafe(numbers["doc_id"]) & (marked["mark"] == numbers["mark"])
    one = marked.join(numbers, same).select("doc", "text").dropDuplicates(["doc"])
    return one, numbers


def repeated_spans(docs: DataFrame, rule: Repeat, method: Method, hot_pieces: int | None = None) -> DataFrame:
    """(doc, start, end): spans, in symbols, of all windows of ``docs`` (doc, text) that
    occur earlier; spans of one document may overlap. ``hot_pieces`` stands in for
    ``rule.most``."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def met(rows: DataFrame) -> DataFrame:
        dealt = rows.repartition(parts, "key").sortWithinPartitions("key", "content", "doc", "start")
        return resolved(dealt, rule)

    def spans(rows: DataFrame) -> DataFrame:
        return rows.filter("span").select("doc", "start", (F.col("start") + F.col("size")).alias("end"))

    found, _ = RoundTables(spark, "stretches").write(met(all_stretches(docs, rule)))
    asked, hot = asked_of(docs, found.filter("NOT span").drop("span"), rule, hot_pieces or rule.most)
    texts = pieces(asked, rule).repartition(parts, "key").sortWithinPartitions("key", "doc", "start")
    all_spans = spans(found).union(by_key(texts, method))
    return all_spans.union(spans(met(hot_windows(asked, rule)))) if hot else all_spans


def with_spans(docs: DataFrame, spans: DataFrame, numbers: DataFrame | None) -> DataFrame:
    """(doc_id, text, spans) for every row of ``docs`` (doc_id, text)."""
    listed = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    if numbers is None:
        return docs.join(listed, docs["doc_id"] == listed["doc"], "left").select("doc_id", "text", "spans")
    marked = docs.withColumn("mark", F.md5("text"))
    same = marked["doc_id"].eqNullSafe(numbers["doc_id"]) & (marked["mark"] == numbers["mark"])
    both = marked.join(numbers, same, "left").select(marked["doc_id"], "text", "doc")
    return both.join(listed, "doc", "left").select("doc_id", "text", "spans")


def removed(wanted: list[dict] | None) -> list[tuple[int, int]]:
    """Sorted union of the spans of one document."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in wanted or []):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out
