"""Benchmark decontamination: document windows against a hash set of benchmark windows."""

from __future__ import annotations

from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tieweave.llm.tables import documents, spare_name, table
from tieweave.session import RoundTables

#: A set of benchmark windows of at most this many measured bytes is sent to all executors.
BROADCAST_BYTES = 64 << 20
#: Digits, letters a-z and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ROW = ["doc_id", "mark"]


def words_of(text: Column) -> Column:
    lowered = F.translate(text, ascii_uppercase, ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def window_key(words: Column, at: Column, n: int) -> Column:
    """Hash of ``n`` words from place ``at`` on; missing words are left out."""
    return F.xxhash64(F.lit(n), *[F.get(words, at + k) for k in range(n)])


def benchmark_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """(item_id, n, window, key): all windows of ``size`` words of each item; the one
    window of a shorter item is its whole text. Items without words have none."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).filter("size(words) > 0")
    items = items.withColumn("n", F.least(F.size("words"), F.lit(size)))
    windows = items.select(
        F.col("item_id").cast("string").alias("item_id"), "n", "words",
        F.explode(F.sequence(F.lit(0), F.size("words") - F.col("n"))).alias("at"),
    )
    key = reduce(
        lambda rest, n: F.when(F.col("n") == n, window_key(F.col("words"), F.col("at"), n)).otherwise(rest),
        range(1, size + 1), F.lit(None).cast("long"),
    )
    return windows.select(
        "item_id", "n", F.expr("slice(words, at + 1, n)").alias("window"), key.alias("key")
    ).distinct()


def item_lists(windows: DataFrame) -> tuple[DataFrame, int]:
    """(n, key, window, items): each window once, with a digest of the set of items that
    have it, and about how many bytes all of them take. The sets are not gathered: the
    digest is of exclusive-or sums of two hashes per item and their number."""
    hashed = [F.bit_xor(F.xxhash64("item_id", F.lit(seed))) for seed in (1, 2)]
    items = F.md5(F.concat_ws(",", *hashed, F.count(F.lit(1))))
    classes = windows.groupBy("n", "key", "window").agg(items.alias("items"))
    # Words, their places in an array, and the other columns of a row.
    weight = F.sum(F.octet_length(F.concat_ws(" ", "window")) + 16 * F.col("n") + 96)
    kept, measured = RoundTables(windows.sparkSession, "benchmark").write(classes, bytes=weight)
    return kept, measured["bytes"] or 0


def members(windows: DataFrame, classes: DataFrame) -> DataFrame:
    """(items, item_id): the items behind each digest."""
    return windows.join(classes, ["n", "key", "window"]).select("items", "item_id").distinct()


def hits(docs: DataFrame, classes: DataFrame, weight: int) -> DataFrame:
    """(doc_id, mark, at, n, items): the occurrences of benchmark windows, once each
    however many items have them. ``mark`` tells rows of one id with different texts
    apart; rows alike in both give one hit.

    The key of every document window is looked up in the set of benchmark windows, which
    is sent to all executors if its measured bytes allow it; found windows are then
    compared word by word. A larger set is first asked for the keys alone, so that words
    travel only for documents with a key in it.
    """
    lengths = [r["n"] for r in classes.select("n").distinct().collect()]  # at most the window's size
    tokens = docs.select("doc_id", F.md5("text").alias("mark"), words_of(F.col("text")).alias("words"))
    # The outer form keeps Spark from running the pattern a second time in a filter.
    places = tokens.select(*ROW, "words", F.posexplode_outer("words").alias("at", "word"))
    keys = [
        F.struct(F.lit(n).alias("n"), window_key(F.col("words"), F.col("at"), n).alias("key"))
        for n in lengths
    ]
    if not keys:
        keys = [F.struct(F.lit(0).alias("n"), F.lit(None).cast("long").alias("key"))]
    if len(keys) == 1:
        places = places.withColumn("k", keys[0]).select(*ROW, "words", "at", "k.n", "k.key")
    else:
        places = places.select(*ROW, "words", "at", F.inline(F.array(*keys)))
    here = F.expr("slice(words, at + 1, n)")
    if weight <= BROADCAST_BYTES:
        found = places.join(F.broadcast(classes), ["n", "key"]).filter(here == F.col("window"))
    else:
        asked = places.filter("at + n <= size(words)").select(*ROW, "at", "n", "key")
        known = asked.join(classes.select("n", "key").distinct(), ["n", "key"], "left_semi")
        by_doc = known.groupBy(F.col("doc_id").alias("of"), F.col("mark").alias("its")).agg(
            F.collect_set(F.struct("at", "n", "key")).alias("known")
        )
        same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("its"))
        both = tokens.join(by_doc, same).select(*ROW, "words", F.inline("known"))
        narrow = both.select(*ROW, "at", "n", "key", here.alias("here"))
        found = narrow.join(classes, ["n", "key"]).filter("here = window")
    return found.select(*ROW, "at", "n", "items").distinct()


def report(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """A row per document: n_words, n_hit, n_items, items_sha256, contaminated.

    A null or empty text has no words and no hits. Rows alike in id and text are
    reported once each, with equal figures. A null item_id is found and counted
    in n_hit, but not listed.

    Items are looked up once per different set of windows' item lists, not per hit, so
    a line that many documents and many items share does not multiply them.
    """
    docs = documents(docs)
    windows = benchmark_windows(benchmark, size)
    classes, weight = item_lists(windows)
    end = F.col("at") + F.col("n")
    before = Window.partitionBy(*ROW).orderBy("at", "n").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max(end).over(before), F.lit(0))
    found = (
        hits(docs, classes, weight)
        .withColumn("fresh", F.greatest(F.lit(0), end - F.greatest(F.col("at"), reached)))
        .groupBy(*ROW)
        .agg(F.sum("fresh").alias("n_hit"), F.sort_array(F.collect_set("items")).alias("lists"))
        .withColumn("set", F.md5(F.concat_ws(",", "lists")))
    )
    found, _ = RoundTables(docs.sparkSession, "hits").write(found)
    sets = found.select("set", "lists").distinct().select("set", F.explode("lists").alias("items"))
    listed = (
        sets.join(members(windows, classes), "items")
        .groupBy("set")
        .agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
        .select("set", F.size("ids").alias("n_ids"), F.sha2(F.array_join("ids", ","), 256).alias("digest"))
    )
    rows = docs.select(
        "doc_id", F.md5("text").alias("mark"), F.size(words_of(F.col("text"))).cast("long").alias("n_words")
    )
    known = found.join(listed, "set", "left").drop("lists")
    same = rows.doc_id.eqNullSafe(known.doc_id) & (rows.mark == known.mark)
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.join(known, same, "left").select(
        rows.doc_id, rows.mark, "n_words", n_hit.alias("n_hit"),
        F.coalesce("n_ids", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, all columns kept."""
    classes, weight = item_lists(benchmark_windows(benchmark, size))
    found = hits(documents(docs), classes, weight).select(*ROW).distinct()
    mark = spare_name(docs)
    marked = docs.withColumn(mark, F.md5(F.coalesce(docs["text"], F.lit(""))))
    same = marked["doc_id"].eqNullSafe(found["doc_id"]) & (marked[mark] == found["mark"])
    return marked.join(found, same, "left_anti").select(*[marked[c] for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """(doc_id, text): the texts as the words left after removing hit words, joined by
    spaces; texts without a hit stay as they are, null as empty."""
    docs = documents(docs)
    found = hits(docs, *item_lists(benchmark_windows(benchmark, size)))
    covered = found.select(*ROW, F.explode(F.expr("sequence(at, at + n - 1)")).alias("at"))
    gone = covered.groupBy(*ROW).agg(F.collect_set("at").alias("gone"))
    rows = docs.withColumn("mark", F.md5("text"))
    same = rows.doc_id.eqNullSafe(gone.doc_id) & (rows.mark == gone.mark)
    left = F.expr("filter(words, (w, i) -> NOT array_contains(gone, i))")
    both = rows.join(gone, same, "left").select(rows.doc_id, "text", "gone", words_of(F.col("text")).alias("words"))
    return both.select("doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(left, " ")).alias("text"))


def op7_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    docs, benchmark = (table(spark, directory, name) for name in ("documents", "benchmark"))
    return report(docs, benchmark, size=10).drop("mark")


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, text,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
items AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, list_slice(w, pos, pos + n - 1) AS win
  FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS pos FROM items)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, pos, list_slice(w, pos, pos + n - 1) AS win
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS pos FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, pos, n, item_id FROM places JOIN windows USING (n, win)),
covered AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS word FROM hits) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words,
  CAST(coalesce(covered.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(listed.n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(listed.items, '')) AS items_sha256,
  coalesce(covered.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""
