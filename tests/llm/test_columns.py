"""Columns of the input that bear names the operators might use themselves."""

from tieweave.llm.decontaminate import clean_documents
from tieweave.llm.secrets import redact
from tieweave.llm.simhash_trie import one_of_each
from tieweave.llm.tables import spare_name

NAMES = ("__mark", "mark", "Mark_", "found", "first")


def test_columns_of_any_name_come_back_as_they_were(spark):
    rows = [(k, f"some words of text number {k} without much in common {k * 7919}") for k in range(5)]
    rows += [(5, None), (6, "token = abcdef123456 here")]
    rows = [(*row, *[f"{name} {row[0]}" for name in NAMES]) for row in rows]
    columns = ", ".join(f"`{name}` string" for name in NAMES)
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {columns}")
    benchmark = spark.createDataFrame([("b", "words that no document has at all")], "item_id string, text string")
    assert sorted(map(tuple, clean_documents(docs, benchmark).collect())) == sorted(rows, key=lambda r: r[0])
    kept = one_of_each(docs, 3, 0)
    assert sorted(map(tuple, kept.collect())) == sorted(rows, key=lambda r: r[0]) and kept.columns == docs.columns
    for row, masked in zip(rows, sorted(redact(docs).collect()), strict=True):
        assert tuple(masked)[2:] == row[2:]
        assert masked["text"] == ("[SECRET] here" if row[0] == 6 else row[1])


def test_spare_names_differ_in_any_case(spark):
    docs = spark.createDataFrame([(1, 2)], "MARK int, mark_ int")
    assert spare_name(docs) == "mark__"
