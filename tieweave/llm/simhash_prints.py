"""SimHash document fingerprints by signed votes, and a Hamming search by block tables."""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tieweave.llm.tables import documents, table
from tieweave.session import RoundTables

#: Separators of words, for terms.
SPACE = r"[\x20\x09-\x0D]+"
#: Bits of a fingerprint: two hashes of 64 bits.
BITS = 128
#: Votes are counted four to a long, each in 16 bits, of which the uppermost counter
#: has the sign; a row may bring so many words, 3 votes each, before its counters could
#: run over, longer texts are counted in several rows.
LANES = 0x0001000100010001
CHUNK_BITS = 13
#: Shares of a document's weight: a pair of neighbouring words and a word of more
#: than three letters vote; pairs tell texts of one language apart, words soften
#: the effect of small edits.
PAIR_WEIGHT, WORD_WEIGHT = 2, 1
#: Radius of the query, from the pairs within 32 bits on sf0.01 and sf0.1: all 281 of
#: different texts with a Jaccard of 0.8 or more over 5 words lie 5 to 18 bits apart,
#: and the first one below 0.2 lies 21 apart.
RADIUS = 20
#: Most bits of a part that a lookup turns; see ``part_tables``.
MOST_FLIPS = 5
#: Ranges of documents that are handled together, and rows that are drawn per range to
#: place its bounds; see ``in_blocks``.
BLOCKS_PER_PARTITION, DRAWN = 4, 20


def term_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A row per word of ``text`` with its chunk and the two hashes of its pair with
    the next word and of itself; the pair of the last word is the word alone. A text
    without words has one row without hashes.
    """
    words = F.split(F.trim(F.regexp_replace("text", SPACE, " ")), " ")
    # The outer form keeps Spark from splitting a second time in a filter.
    placed = rows.select(*keys, words.alias("words")).select(
        *keys, "words", F.posexplode_outer("words").alias("at", "word")
    )
    some = F.col("word") != ""
    pair = F.when(some, F.xxhash64(F.lit(2), F.col("word"), F.get("words", F.col("at") + 1)))
    single = F.when(F.length("word") > 3, F.xxhash64(F.lit(1), F.col("word")))
    chunk = F.shiftright("at", CHUNK_BITS).alias("chunk")
    terms = placed.select(*keys, chunk, pair.alias("pair_0"), single.alias("single_0"))
    return terms.select(
        "*", F.when(some_hash("pair_0"), F.xxhash64("pair_0")).alias("pair_1"),
        F.when(some_hash("single_0"), F.xxhash64("single_0")).alias("single_1"),
    )


def some_hash(name: str) -> Column:
    return F.col(name).isNotNull()


def _lanes(name: str, shift: int, weight: int) -> Column:
    lanes = F.shiftrightunsigned(name, shift).bitwiseAND(F.lit(LANES)) * weight
    return F.when(some_hash(name), lanes).otherwise(F.lit(0).cast("long"))


def fingerprints(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``high``, ``low``: 128 bits for the ``text`` of each row of ``rows``,
    which ``keys`` must tell apart. A text without words has all bits zero.

    A lane holds the counters of four bits, 16 apart, so 32 sums in place of 128 run
    over the words; they are summed in the task that has the text.
    """
    terms = term_rows(rows, keys)
    sums = [
        F.sum(_lanes(f"pair_{half}", shift, PAIR_WEIGHT) + _lanes(f"single_{half}", shift, WORD_WEIGHT)).alias(
            f"s{half}_{shift}"
        )
        for half in range(2) for shift in range(16)
    ]
    weight = F.sum(
        F.when(some_hash("pair_0"), PAIR_WEIGHT).otherwise(0)
        + F.when(some_hash("single_0"), WORD_WEIGHT).otherwise(0)
    )
    chunks = terms.groupBy(*keys, "chunk").agg(weight.alias("weight"), *sums)
    counts = [
        F.sum(F.shiftrightunsigned(f"s{half}_{bit % 16}", bit // 16 * 16).bitwiseAND(F.lit(0xFFFF))).alias(
            f"v{half}_{bit}"
        )
        for half in range(2) for bit in range(64)
    ]
    whole = chunks.groupBy(*keys).agg(F.sum("weight").alias("weight"), *counts)

    def packed(half: int) -> Column:
        made = F.lit(0).cast("long")
        for bit in range(64):
            over = (F.col(f"v{half}_{bit}") * 2 > F.col("weight")).cast("long")
            made = made.bitwiseOR(F.shiftleft(over, bit))
        return made

    return whole.select(*keys, packed(0).alias("high"), packed(1).alias("low"))


def likeness(high: Column, low: Column, other_high: Column, other_low: Column) -> Column:
    apart = F.bit_count(high.bitwiseXOR(other_high)) + F.bit_count(low.bitwiseXOR(other_low))
    return F.lit(1.0) - apart / F.lit(float(BITS))


def bounds_of(rows: DataFrame, parts: int) -> list:
    """At most ``parts - 1`` rows (doc_id, mark) that cut the others into ranges of about
    equal size: every ``DRAWN``-th of the rows with the least hashes, so ids of any type
    do, and a null or repeated id is cut by the marks of its texts."""
    drawn = rows.select("doc_id", "mark").orderBy(F.xxhash64("doc_id", "mark")).limit(DRAWN * parts)
    return drawn.orderBy("doc_id", "mark").collect()[DRAWN::DRAWN]


def in_blocks(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) dealt into ranges, highest first, with the first row of
    the range below as a guest at the end of each range; the last range has the very
    first row as its guest.

    Order: doc_id descending, nulls last, then the text's MD5. Only ``DRAWN`` rows (id
    and MD5) per range go through the driver.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions")) * BLOCKS_PER_PARTITION
    rows = docs.select("doc_id", "text", F.md5("text").alias("mark"))
    kind = docs.schema["doc_id"].dataType
    edges = [
        F.struct(F.lit(b["doc_id"]).cast(kind).alias("doc_id"), F.lit(b["mark"]).alias("mark"))
        for b in bounds_of(rows, parts)
    ]
    here = F.struct("doc_id", "mark")
    block = F.size(F.filter(F.array(*edges), lambda b: b < here)) if edges else F.lit(0)
    rows = rows.withColumn("block", block)
    heads = rows.groupBy("block").agg(F.max(here).alias("head"))
    heads = sorted(heads.collect(), key=lambda r: -r["block"])
    hosts = [heads[k - 1]["block"] for k in range(len(heads))]
    guests = [(*r["head"], host) for r, host in zip(heads, hosts, strict=True)]
    sent = F.broadcast(spark.createDataFrame(guests, f"id {kind.simpleString()}, first string, host int"))
    same = rows.doc_id.eqNullSafe(sent["id"]) & (rows.mark == sent["first"])
    visits = rows.join(sent, same).select(
        "doc_id", "text", "mark", F.col("host").alias("block"), F.lit(True).alias("guest")
    )
    return rows.withColumn("guest", F.lit(False)).unionByName(visits)


def with_next(docs: DataFrame) -> DataFrame:
    """Each row with its block, its place there, and the text of the row after it."""
    order = Window.partitionBy("block").orderBy(
        "guest", F.col("doc_id").desc_nulls_last(), F.col("mark").desc()
    )
    return in_blocks(docs).select(
        "block", F.row_number().over(order).alias("place"), "guest", "doc_id", "text",
        F.lead("text").over(order).alias("next"),
    )


def prints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they are, with
    ``high`` and ``low``; written once.

    The edited form has the last half of a text replaced by the beginning of the next
    document's, as long as that half or all of it; a lone document is its own next. Ids
    may be of any type that has an order. Null texts are empty; a text without words has the fingerprint zero. Rows of one
    id follow each other by the MD5 of their texts; null ids come last. Repeated rows
    come out once each.
    """
    pairs = with_next(documents(docs))
    size = F.length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"), F.substring(F.col("next"), F.lit(1), half))
    rows = pairs.withColumn("edited", F.coalesce(edited, F.lit(""))).select(
        "block", "place", "guest", "doc_id", size.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.explode_outer(F.array(
            F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")),
            F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")),
        )).alias("t"),
    ).select("block", "place", "guest", "doc_id", "n_chars", "edited_sha256", "t.kind", "t.text")
    keys = ["block", "place", "guest", "doc_id", "n_chars", "edited_sha256"]
    prints = fingerprints(rows.filter("kind = 0 OR NOT guest"), [*keys, "kind"])
    picked = [
        F.max(F.when(F.col("kind") == kind, F.col(part))).alias(f"{part}_{kind}")
        for kind in range(2) for part in ("high", "low")
    ]
    order = Window.partitionBy("block").orderBy("place")
    whole = prints.groupBy(*keys).agg(*picked)
    whole = whole.select(
        "*", F.lead("high_0").over(order).alias("high_2"), F.lead("low_0").over(order).alias("low_2")
    ).filter("NOT guest")

    def shown(kind: int) -> Column:
        return shown_class(f"high_{kind}", f"low_{kind}")

    def near(kind: int) -> Column:
        return likeness(*[F.col(f"{part}_{k}") for k in (0, kind) for part in ("high", "low")])

    made, _ = RoundTables(docs.sparkSession, "prints").write(whole.select(
        "doc_id", "n_chars", "edited_sha256", shown(0).alias("fingerprint"),
        shown(1).alias("edited_fingerprint"), near(1).alias("near_edited"), near(2).alias("near_next"),
        F.col("high_0").alias("high"), F.col("low_0").alias("low"),
    ))
    return made


def shown_class(high: str, low: str) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def is_asked(every: int) -> Column:
    """Whether an id is a number divisible by ``every``; other ids are not asked for."""
    return F.coalesce(F.col("doc_id").try_cast("long") % every == 0, F.lit(False))


def near_classes(made: DataFrame, radius: int, every: int) -> DataFrame:
    """(high, low, near_high, near_low, bits, n_docs): for each fingerprint of a document
    whose id is divisible by ``every``, all fingerprints within ``radius`` bits, itself
    among them, and how many documents have them; written once."""
    found = search(made.filter(is_asked(every)), made, radius)
    sizes = made.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n_docs"))
    found = found.join(sizes, ["high", "low"]).select(
        F.col("query_high").alias("high"), F.col("query_low").alias("low"),
        F.col("high").alias("near_high"), F.col("low").alias("near_low"), "bits", "n_docs",
    )
    return RoundTables(made.sparkSession, "near").write(found)[0]


def with_found(made: DataFrame, found: DataFrame, every: int) -> DataFrame:
    """``made`` with the columns of ``found`` (one row per fingerprint asked for), null for
    documents not asked for. Only those asked for meet ``found``."""
    asked = made.filter(is_asked(every)).join(found, ["high", "low"], "left")
    others = made.filter(~is_asked(every))
    return asked.unionByName(others, allowMissingColumns=True)


def report(docs: DataFrame, radius: int = RADIUS, every: int = 20) -> DataFrame:
    """``prints`` with what the search finds for the documents whose id is divisible by
    ``every``, null for others, a row per row of ``docs``.

    ``n_near`` is the number of other fingerprints within ``radius`` bits, ``n_near_docs``
    that of other documents that have these or the same fingerprint, and ``near_classes``
    lists the fingerprints as ``fingerprint:bits:documents``, nearest first, joined by
    commas: the members of a class are the documents with that ``fingerprint``. The own
    class, 0 bits away, is listed if another document is in it. ``neighbours`` gives the
    same as rows, for classes with very many neighbours.
    """
    made = prints(docs)
    near = near_classes(made, radius, every)
    item = F.struct("bits", shown_class("near_high", "near_low").alias("neighbour"), "n_docs")
    listed = F.sort_array(F.collect_list(F.when((F.col("bits") > 0) | (F.col("n_docs") > 1), item)))
    shown = F.transform(listed, lambda c: F.concat_ws(":", c["neighbour"], c["bits"], c["n_docs"]))
    found = near.groupBy("high", "low").agg(
        F.sum((F.col("bits") > 0).cast("long")).alias("n_near"), (F.sum("n_docs") - 1).alias("n_near_docs"),
        F.array_join(shown, ",").alias("near_classes"),
    )
    return with_found(made, found, every).drop("high", "low")


def neighbours(docs: DataFrame, radius: int = RADIUS, every: int = 20) -> DataFrame:
    """(fingerprint, neighbour, bits, neighbour_docs): a row per fingerprint of a document
    whose id is divisible by ``every`` and fingerprint within ``radius`` bits that another
    document has; ``neighbour_docs`` documents have it. The members of a class are the
    documents that ``prints`` gives that ``fingerprint``.
    """
    near = near_classes(prints(docs), radius, every)
    return near.filter("bits > 0 OR n_docs > 1").select(
        shown_class("high", "low").alias("fingerprint"), shown_class("near_high", "near_low").alias("neighbour"),
        "bits", F.col("n_docs").alias("neighbour_docs"),
    )


def part_tables(radius: int, rows: int) -> tuple[list[int], int]:
    """Bit masks of parts, and a number of flips: two fingerprints within ``radius`` bits
    differ in at most so many bits of at least one part.

    More flips allow fewer and wider parts, which cost more lookups but meet fewer of the
    ``rows`` fingerprints by chance; the choice with the least of both together is taken,
    so parts grow wider as the index grows.
    """
    def parts_of(flips: int) -> int:
        return max(2, -(-(radius + 1) // (flips + 1)))

    def work(flips: int) -> float:
        parts = parts_of(flips)
        lookups = parts * sum(comb(-(-BITS // parts), n) for n in range(flips + 1))
        return lookups * (1 + rows / 2.0 ** (BITS / parts))

    flips = min(range(min(radius, MOST_FLIPS) + 1), key=work)
    parts = parts_of(flips)
    edges = [round(BITS * k / parts) for k in range(parts + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)], flips


def _halves(mask: int) -> tuple[int, int]:
    return tuple(m - (1 << 64) if m >> 63 else m for m in (mask >> 64, mask & (1 << 64) - 1))


def _part(high: str, low: str, mask: int) -> Column:
    """The bits of a part in one long; the two ends of one that lies across both halves
    do not overlap."""
    over, under = _halves(mask)
    return F.col(high).bitwiseAND(F.lit(over).cast("long")).bitwiseOR(F.col(low).bitwiseAND(F.lit(under).cast("long")))


def search(queries: DataFrame, index: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(query_high, query_low, high, low, bits): all distinct fingerprints of ``index``
    within ``radius`` bits of each distinct one of ``queries``; exact.

    Fingerprints are listed once per part; a query looks up each of its parts as it is
    and with every choice of up to ``flips`` bits turned. A pair comes from the first
    part that brings it together, so it comes once.
    """
    spark = queries.sparkSession
    masks, flips = part_tables(radius, index.count())

    def looked_up(rows: DataFrame, high: str, low: str) -> DataFrame:
        listed = [F.struct(F.lit(k).alias("table"), _part(high, low, m).alias("block")) for k, m in enumerate(masks)]
        return rows.select("*", F.inline(F.array(*listed)))

    turned = []
    for k, mask in enumerate(masks):
        places = [b for b in range(BITS) if mask >> b & 1]
        for n in range(flips + 1):
            for chosen in combinations(places, n):
                over, under = _halves(sum(1 << b for b in chosen))
                turned.append((k, over | under))
    sent = F.broadcast(spark.createDataFrame(turned, "table int, turn long"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Each query becomes many rows, so queries are not gathered into few tasks.
    asked = queries.select(F.col("high").alias("query_high"), F.col("low").alias("query_low"))
    asked = looked_up(asked.repartition(parts, "query_high", "query_low").distinct(), "query_high", "query_low")
    asked = asked.join(sent, "table").select(
        "query_high", "query_low", "table", F.col("block").bitwiseXOR(F.col("turn")).alias("block")
    )
    there = looked_up(index.select("high", "low").distinct(), "high", "low")

    def apart(one: Column, two: Column) -> Column:
        return F.bit_count(one) + F.bit_count(two)

    over = F.col("high").bitwiseXOR(F.col("query_high"))
    under = F.col("low").bitwiseXOR(F.col("query_low"))
    bits = apart(over, under)
    first = F.lit(None).cast("int")
    for k, mask in reversed(list(enumerate(masks))):
        a, b = (F.lit(m).cast("long") for m in _halves(mask))
        first = F.when(apart(over.bitwiseAND(a), under.bitwiseAND(b)) <= flips, k).otherwise(first)
    same = (asked["table"] == there["table"]) & (asked["block"] == there["block"])
    near = asked.join(there, same & (bits <= radius) & (asked["table"] == first))
    return near.select("query_high", "query_low", "high", "low", bits.alias("bits"))


def op2_document_fingerprints(spark: SparkSession, directory: str) -> DataFrame:
    return report(table(spark, directory, "documents"))
