"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tieweave.llm.tables import documents, spare_name, table

ROW = ["doc_id", "mark"]
KINDS = ("assign", "access", "hex", "entropy")
#: Fixed patterns. A run of one class is found whole, so least lengths can stand in
#: those patterns; an assignment is found first and judged by its value afterwards.
PATTERNS = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "entropy": r"[A-Za-z0-9+/_=-]{20,}",
}
LEAST_VALUE = 6
#: Entropy is taken over this many characters at a time.
WINDOW = 20
#: Least bits per character for strings of hex digits and of any other candidates.
#: 20 random hex digits have about 3.4 bits, 20 random base64 characters about 4.1;
#: prose stays near 3.2 and has no digits.
HEX_BITS, OTHER_BITS = 3.0, 3.8
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: What looks random but is no secret: whole strings without a digit or without a letter,
#: and UUIDs; and, within a string, placeholders, runs of one character and key-board rows.
ALLOWED = (
    r"^[^0-9]*$",
    r"^[^A-Za-z]*$",
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
)
ALLOWED_WITHIN = (
    r"(?i:example|sample|placeholder|dummy|changeme|your[_-]|xxxx)|(.)\1{5,}"
    r"|(?i:abcdefgh|01234567|12345678|qwerty)"
)
#: c * log2(c) in millionths for c from 0 to the window's length: whole numbers, so
#: that adding and taking away leave no rounding behind.
TERMS = f"transform(sequence(0, {WINDOW}), c -> IF(c = 0, 0L, CAST(round(c * log2(c) * 1e6) AS BIGINT)))"


def hot_ranges(places: Column, bits: Column) -> Column:
    """array of struct(first, last) after one pass over a candidate, given as the places of
    its characters in the alphabet, 0 for those that the allow-list covers: the runs of
    overlapping or touching windows with at least ``bits`` of entropy a character. No
    window reaches over an allowed character.

    The pass keeps a count per character and the sum of c * log2(c) over them; a
    character that enters or leaves changes one count and one term of the sum. An allowed
    one empties the window.
    """
    limit = (F.log2(F.lit(float(WINDOW))) - bits) * WINDOW * 1e6
    zero = F.lit(0).cast("long")
    empty = F.array_repeat(F.lit(0), len(ALPHABET))
    found = F.array().cast("array<struct<first:int,last:int>>")
    state = F.struct(
        empty.alias("counts"), zero.alias("total"), F.lit(0).alias("size"),
        F.lit(None).cast("struct<first:int,last:int>").alias("open"), found.alias("found"),
    )
    terms = F.expr(TERMS)

    def step(acc: Column, at: Column) -> Column:
        counts, enters, full = acc["counts"], at["enters"], acc["size"] >= WINDOW
        leaves = F.when(full, at["leaves"])
        held, gone = F.get(counts, enters - 1), F.get(counts, leaves - 1)
        added = F.get(terms, held + 1) - F.get(terms, held)
        taken = F.get(terms, gone) - F.get(terms, gone - 1)
        change = F.when(leaves.isNull(), added).when(leaves == enters, zero).otherwise(added - taken)
        after = F.transform(
            counts,
            lambda n, k: n + (k == enters - 1).cast("int") - (k.eqNullSafe(leaves - 1)).cast("int"),
        )
        allowed = enters == 0
        size = F.when(allowed, F.lit(0)).otherwise(acc["size"] + 1)
        total = F.when(allowed, zero).otherwise(acc["total"] + change)
        hot = (size >= WINDOW) & (total <= limit)
        first, last = at["end"] - WINDOW, at["end"]
        apart = acc["open"].isNotNull() & (first > acc["open"]["last"])
        begun = acc["open"].isNull() | apart
        return F.struct(
            F.when(allowed, empty).otherwise(after).alias("counts"), total.alias("total"), size.alias("size"),
            F.when(hot, F.struct(F.when(begun, first).otherwise(acc["open"]["first"]).alias("first"), last.alias("last")))
            .otherwise(acc["open"]).alias("open"),
            F.when(hot & apart, F.concat(acc["found"], F.array(acc["open"]))).otherwise(acc["found"]).alias("found"),
        )

    moves = F.transform(
        places,
        lambda enters, k: F.struct(
            (k + 1).alias("end"), enters.alias("enters"), F.get(places, k - WINDOW).alias("leaves")
        ),
    )
    return F.aggregate(
        moves, state, step,
        lambda acc: F.when(acc["open"].isNull(), acc["found"]).otherwise(F.concat(acc["found"], F.array(acc["open"]))),
    )


def _places(match: Column) -> Column:
    """The place of each character in the alphabet, 0 where the allow-list covers it."""
    allowed = F.regexp_extract_all(match, F.lit(ALLOWED_WITHIN), F.lit(0))
    blank = lambda part, name: F.concat(part, F.repeat(F.lit(" "), F.coalesce(F.length(name), F.lit(0))))
    kept = F.array_join(F.zip_with(F.split(match, ALLOWED_WITHIN, -1), allowed, blank), "")
    return F.transform(F.split(kept, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def matched(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, kind, match, value, start, end): every match of every pattern, in
    code points, end exclusive. ``mark`` tells rows of one id with different texts
    apart; rows alike in both give one row. ``value`` is that of an assignment.

    A pattern gives the matches of a text, and splitting by it gives what lies
    between them; their running lengths place each match.
    """
    text = F.col("text")
    kinds = F.array(*[
        F.struct(
            F.lit(number).alias("kind"),
            F.regexp_extract_all(text, F.lit(PATTERNS[name]), F.lit(0)).alias("matches"),
        )
        for number, name in enumerate(KINDS)
    ])
    found = docs.select("doc_id", "text", F.explode_outer(kinds).alias("k")).filter("size(k.matches) > 0")
    kind = F.col("k.kind")
    gaps = F.split(text, PATTERNS[KINDS[0]], -1)
    for number, name in enumerate(KINDS[1:], 1):
        gaps = F.when(kind == number, F.split(text, PATTERNS[name], -1)).otherwise(gaps)
    value = F.when(kind == 0, F.regexp_extract_all(text, F.lit(PATTERNS["assign"]), F.lit(2)))
    rows = found.select(
        "doc_id", F.md5("text").alias("mark"), kind.alias("kind"), F.col("k.matches").alias("matches"),
        F.transform(gaps, F.length).alias("gaps"), value.alias("value_of"),
    )
    rows = rows.select(*ROW, "kind", "gaps", "value_of", F.posexplode_outer("matches").alias("place", "match"))
    rows = rows.select(
        *ROW, "kind", "place", "match", F.get("gaps", F.col("place")).alias("gap"),
        F.get("value_of", F.col("place")).alias("value"),
    ).dropDuplicates([*ROW, "kind", "place"])
    # Few rows that take long to judge: they are dealt to as many tasks as there may be.
    rows = rows.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), *ROW)
    until = Window.partitionBy(*ROW, "kind").orderBy("place")
    end = F.sum(F.col("gap") + F.length("match")).over(until).cast("int")
    return rows.select(
        *ROW, "kind", "match", "value", (end - F.length("match")).alias("start"), end.alias("end")
    )


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, kind, start, end) of all secrets; kinds by their number."""
    plain = F.col("kind").isin(1, 2) | ((F.col("kind") == 0) & (F.length("value") >= LEAST_VALUE))
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | F.col("match").rlike(pattern)
    candidate = (F.col("kind") == 3) & ~allowed
    bits = F.when(F.col("match").rlike("^([0-9a-f]+|[0-9A-F]+)$"), F.lit(HEX_BITS)).otherwise(F.lit(OTHER_BITS))
    entropy = F.col("kind") == 3
    judged = (
        matched(docs).filter(plain | candidate)
        .select(
            *ROW, "kind", "start", "end", F.when(entropy, bits).alias("bits"),
            F.when(entropy, _places(F.col("match"))).alias("places"),
        )
    )
    whole = F.array(F.struct(F.lit(0).alias("first"), (F.col("end") - F.col("start")).alias("last")))
    found = F.when(entropy, hot_ranges(F.col("places"), F.col("bits"))).otherwise(whole)
    return judged.select(*ROW, "kind", "start", F.explode(found).alias("span")).select(
        *ROW, "kind", (F.col("start") + F.col("span.first")).alias("start"),
        (F.col("start") + F.col("span.last")).alias("end"),
    )


def per_row(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, found): the sorted spans of each text that has any."""
    one = F.struct("start", "kind", "end")
    return spans(docs).groupBy(*ROW).agg(F.sort_array(F.collect_list(one)).alias("found"))


def joined(found: Column) -> Column:
    names = F.array(*[F.lit(name) for name in KINDS])
    texts = F.transform(
        found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(texts, ",")


def report(docs: DataFrame) -> DataFrame:
    """A row per document: n_assign, n_access, n_hex, base_sha256, spans.

    A null or empty text has no spans. Rows alike in id and text are reported once
    each, with equal figures. ``spans`` also holds those found by entropy.
    """
    docs = documents(docs)
    rows = docs.select("doc_id", F.md5("text").alias("mark"))
    found = per_row(docs)
    same = rows.doc_id.eqNullSafe(found.doc_id) & (rows.mark == found.mark)
    both = rows.join(found, same, "left").select(rows.doc_id, "found")
    both = both.withColumn("found", F.coalesce("found", F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)")))
    base = F.filter("found", lambda s: s["kind"] < 3)

    def counted(kind: int) -> Column:
        of_kind = F.filter("found", lambda s: s["kind"] == kind)
        return F.size(of_kind).cast("long").alias(f"n_{KINDS[kind]}")

    counts = [counted(kind) for kind in range(3)]
    return both.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs`` with every found span replaced by ``mask``, all columns
    kept; overlapping and touching spans become one. Null texts stay null."""
    found = per_row(documents(docs))
    mark = spare_name(docs)
    marked = docs.withColumn(mark, F.md5(F.coalesce(docs["text"], F.lit(""))))
    same = marked["doc_id"].eqNullSafe(found["doc_id"]) & (marked[mark] == found["mark"])
    zero = F.struct(F.lit("").alias("made"), F.lit(0).alias("at"))

    def step(acc: Column, span: Column) -> Column:
        clear = span["start"] > acc["at"]
        kept = F.substring(marked["text"], acc["at"] + 1, span["start"] - acc["at"])
        first = (span["start"] == 0) & (acc["at"] == 0)
        made = F.when(clear, F.concat(acc["made"], kept, F.lit(mask))).when(
            first & (acc["made"] == ""), F.lit(mask)
        ).otherwise(acc["made"])
        return F.struct(made.alias("made"), F.greatest(acc["at"], span["end"]).alias("at"))

    end = F.aggregate(found["found"], zero, step)
    rest = F.substring(marked["text"], end["at"] + 1, F.length(marked["text"]))
    text = F.when(found["found"].isNull(), marked["text"]).otherwise(F.concat(end["made"], rest))
    columns = [text.alias("text") if c == "text" else marked[c] for c in docs.columns]
    return marked.join(found, same, "left").select(*columns)


def op8_secret_scans(spark: SparkSession, directory: str) -> DataFrame:
    return report(table(spark, directory, "documents"))
