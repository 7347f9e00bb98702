"""Grouping of spelling variants: words one edit apart, found over a reduced alphabet.

Letters are hashed to a few symbols, which turns words into reduced words. One edit of a
word is at most one edit of its reduced word, so near words have reduced words within
one edit. All strings within one edit of a reduced word are few, as there are few
symbols; they are generated and looked up among the reduced words, and the pairs
of words behind them are verified letter by letter.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tieweave.llm.tables import documents, table
from tieweave.session import RoundTables

#: The letters of words, and the capitals that are lowered.
LETTERS = "A-Za-zÀ-ÿ"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Length and occurrences of a word at least, how many times as frequent
#: a form is, and one occurrence in how many is deleted from.
LEAST_LENGTH, LEAST_COUNT, RATIO, ODD = 6, 5, 5, 199
#: Symbols of the reduced alphabet.
SYMBOLS = 8
#: Words of one reduced word; those of fuller ones are compared over whole letters.
FULL = 128


def merged(df: DataFrame) -> DataFrame:
    """``df`` for a join that never sends it whole. Written words are small as files and
    many times larger as the hash tables that a broadcast makes of them on the driver,
    and every join here has as many rows as the vocabulary."""
    return df.hint("merge")


def runs(docs: DataFrame) -> DataFrame:
    """(doc_id, run): every maximal run of letters with a word's length at least, A-Z
    lowered; shorter runs cannot become words."""
    pattern = F.lit(f"[{LETTERS}]{{{LEAST_LENGTH},}}")
    found = docs.select("doc_id", F.explode(F.regexp_extract_all("text", pattern, F.lit(0))).alias("run"))
    return found.select("doc_id", F.translate("run", CAPITALS, CAPITALS.lower()).alias("run"))


def misspelt(doc_id: Column, run: Column, odd: int = ODD) -> Column:
    """The run, or the run without one of its letters where the CRC-32 of id and run is
    divisible by ``odd``; a null id counts as an empty one."""
    crc = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    size = F.length(run)
    at = F.pmod(crc, size).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, size))
    return F.when(crc % odd == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, odd: int = ODD, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all words of the corpus; occurrences are added up in each task first."""
    words = runs(documents(docs)).select(misspelt(F.col("doc_id"), F.col("run"), odd).alias("word"))
    words = words.filter(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def alphabet(symbols: int | None) -> tuple[str, str]:
    """All letters of words, and the symbol of each; None keeps them apart."""
    letters = "".join(map(chr, [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]))
    if symbols is None:
        return letters, letters
    return letters, "".join(chr(ord("a") + zlib.crc32(x.encode()) % symbols) for x in letters)


def neighbourhood(reduced: Column, symbols: list[str]) -> Column:
    """Hashes of all strings within one edit of ``reduced``, itself among them. Unequal
    strings may have equal hashes; their words fail the comparison."""
    listed = F.array(*[F.lit(s) for s in symbols])
    size = F.length(reduced)
    head = lambda i: F.substring(reduced, F.lit(1), i)
    tail = lambda i: F.substring(reduced, i + 1, size)
    put = lambda i, rest: F.transform(listed, lambda s: F.xxhash64(F.concat(head(i), s, rest)))
    places = F.sequence(F.lit(0), size - 1)
    deleted = F.transform(places, lambda i: F.xxhash64(F.concat(head(i), tail(i + 1))))
    replaced = F.flatten(F.transform(places, lambda i: put(i, tail(i + 1))))
    inserted = F.flatten(F.transform(F.sequence(F.lit(0), size), lambda i: put(i, tail(i))))
    return F.array_distinct(F.concat(deleted, replaced, inserted))


def _reduced(words: DataFrame, symbols: int | None) -> tuple[DataFrame, Column]:
    """The reduced words (code, reduced, size) of ``words``, and the code of a word."""
    reduced = F.translate("word", *alphabet(symbols))
    sizes = words.groupBy(reduced.alias("reduced")).agg(F.count("*").alias("size"))
    return sizes.withColumn("code", F.xxhash64("reduced")), F.xxhash64(reduced)


def near_pairs(words: DataFrame, symbols: int = SYMBOLS, full: int = FULL) -> DataFrame:
    """(word, n, other, m): all pairs of ``words`` (word, n) that one inserted, deleted
    or replaced letter leads from one to the other, each in both directions.

    Every reduced word is looked up from the lesser side of a pair only. Reduced words
    with more than ``full`` words, where the lookup would approach all pairs, are left
    to a second pass in which each of their words is reduced to itself: every letter
    is a symbol, and a string found is a near word. So no word meets more than
    ``full`` words per neighbouring string, in whatever vocabulary.
    """
    rounds = RoundTables(words.sparkSession, "spelling")
    made, code = _reduced(words, symbols)
    reduced, counted = rounds.write(made, fullest=F.max("size"))
    listed = sorted(set(alphabet(symbols)[1]))
    small = reduced.filter(F.col("size") <= full)
    around = small.select("code", F.explode(neighbourhood(F.col("reduced"), listed)).alias("to"))
    codes = small.select(F.col("code").alias("to")).distinct()
    met = around.filter("to >= code").join(merged(codes), "to").select("code", "to").distinct()
    coded = words.select("word", "n", code.alias("code"))
    other = words.select(F.col("word").alias("other"), F.col("n").alias("m"), code.alias("to"))
    ordered = (F.col("to") > F.col("code")) | (F.col("other") > F.col("word"))
    half = coded.join(merged(met), "code").join(merged(other), "to").filter(ordered)
    pairs = half.filter(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "m")
    if (counted["fullest"] or 0) > full:
        crowded = reduced.filter(F.col("size") > full).select("code").distinct()
        marked, _ = rounds.write(
            coded.join(merged(crowded.withColumn("crowded", F.lit(True))), "code", "left")
            .select("word", "n", F.coalesce("crowded", F.lit(False)).alias("crowded"))
        )
        letters = list(alphabet(None)[0])
        itself = marked.select(
            F.col("word").alias("other"), F.col("n").alias("m"), F.col("crowded").alias("both"),
            F.xxhash64("word").alias("to"),
        )
        found = marked.filter("crowded").select("word", "n", F.explode(neighbourhood(F.col("word"), letters)).alias("to"))
        # A pair of two crowded words is found from both of them.
        once = ~F.col("both") | (F.col("other") > F.col("word"))
        found = found.join(merged(itself), "to").filter(once & (F.levenshtein("word", "other", 1) == 1))
        pairs = pairs.unionByName(found.select("word", "n", "other", "m"))
    kept, _ = rounds.write(pairs)
    turned = kept.select(
        F.col("other").alias("word"), F.col("m").alias("n"), F.col("word").alias("other"), F.col("n").alias("m")
    )
    return kept.unionByName(turned)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last form reached from each word that has a form. Every round
    doubles the steps; a form is several times as frequent, so there are few."""
    rounds = RoundTables(forms.sparkSession, "roots")
    now, _ = rounds.write(forms.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after, taken = rounds.write(
            now.join(merged(further), "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"),
            moved=F.count_if(F.col("next").isNotNull()),
        )
        rounds.drop(now)
        now = after.select("word", "root")
        if not taken["moved"]:
            return now


def variants(words: DataFrame, ratio: int = RATIO, symbols: int = SYMBOLS, full: int = FULL) -> DataFrame:
    """``words`` (word, n) with n_near, form, form_n and root.

    The form is the most frequent near word, the first in code-point order among equals,
    if it is at least ``ratio`` times as frequent as the word, else null. The root is
    the word itself without a form. Words are letters of ``LETTERS`` with A-Z lowered
    and stand in the table once. An empty table gives no rows.
    """
    rounds = RoundTables(words.sparkSession, "variants")
    words, _ = rounds.write(words.select("word", "n"))
    best = F.min(F.struct((-F.col("m")).alias("m"), F.col("other").alias("form"))).alias("best")
    near = near_pairs(words, symbols, full).groupBy("word").agg(F.count("*").alias("n_near"), best)
    fits = -F.col("best.m") >= F.col("n") * ratio
    made, _ = rounds.write(
        words.join(merged(near), "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, F.col("best.form")).alias("form"), F.when(fits, -F.col("best.m")).alias("form_n"),
        )
    )
    last = roots(made.filter("form IS NOT NULL"))
    return made.join(merged(last), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )


def spelt_as(docs: DataFrame, grouped: DataFrame) -> DataFrame:
    """(doc_id, run, root, times): the words of each document that have another root."""
    other = grouped.filter("word <> root").select(F.col("word").alias("run"), "root")
    times = runs(documents(docs)).groupBy("doc_id", "run").agg(F.count("*").alias("times"))
    return times.join(merged(other), "run").select("doc_id", "run", "root", "times")


def op13_spelling_variants(spark: SparkSession, directory: str) -> DataFrame:
    return variants(vocabulary(table(spark, directory, "documents")))
