"""Benchmark windows in documents, against word lists by hand."""

import hashlib
import re

import pytest

from tests.llm.cases import frame, odd_rows, prose
from tieweave.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_hand(docs, items, size=10):
    out = []
    for doc_id, text in docs:
        mine, hit, found = words(text), set(), set()
        for item, wanted in items:
            wanted = words(wanted)
            n = min(size, len(wanted))
            windows = {tuple(wanted[k : k + n]) for k in range(len(wanted) - n + 1)} if n else set()
            for k in range(len(mine) - n + 1 if n else 0):
                if tuple(mine[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(mine), len(hit), len(found), digest, bool(hit)))
    return sorted(map(str, out))


def tables(spark):
    items = [(0, prose(50, 30)), (1, prose(51, 10)), (2, "Ñu mini"), (3, None), (4, " ,. "), (11, prose(50, 30)), (12, prose(52, 12))]
    docs = odd_rows()
    docs += [
        (30, prose(60, 20) + " " + prose(50, 30).upper() + ", " + prose(61, 5)),
        (31, " ".join(prose(50, 30).split()[4:14]) + " x " + " ".join(prose(50, 30).split()[8:25])),
        (32, " ".join(prose(50, 30).split()[:9])),
        (33, "ñu-mini ñu mini, Ñu"),
        (33, "ñu-mini ñu mini"),
        (34, (prose(52, 12) + ". ") * 3),
        (34, (prose(52, 12) + ". ") * 3),
    ]
    return docs, items


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_report_matches_by_hand(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
    docs, items = tables(spark)
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, at int")
    made = decontaminate.report(frame(spark, docs), benchmark).drop("mark").collect()
    assert sorted(str(tuple(r)) for r in made) == by_hand(docs, items)


def test_removing_documents_and_spans(spark):
    docs, items = tables(spark)
    benchmark = spark.createDataFrame(items[:2], "item_id long, text string")
    clean = decontaminate.clean_documents(frame(spark, docs), benchmark)
    assert clean.columns == frame(spark, docs).columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(i) for i, _ in docs if i not in (30, 31))
    texts = {r.doc_id: r.text for r in decontaminate.remove_spans(frame(spark, docs[-7:]), benchmark).collect()}
    assert texts[30] == prose(60, 20) + " " + prose(61, 5)
    assert texts[31] == "x"
    assert texts[32] == docs[-5][1]


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_a_line_of_all_items_does_not_multiply(spark, monkeypatch, limit):
    """One line in all items and all documents: a hit per document and window, and items
    of the line alone are told from those with a text of their own."""
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
    line = prose(70, 12)
    items = [(k, line + " " + prose(100 + k, 10)) for k in range(60)] + [(None, line)]
    docs = [(k, prose(300 + k, 15) + " " + line) for k in range(20)]
    docs += [(90, items[7][1]), (None, line), (None, line), (91, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    table = frame(spark, docs)
    classes, weight = decontaminate.item_lists(decontaminate.benchmark_windows(benchmark, 10))
    found = decontaminate.hits(decontaminate.documents(table), classes, weight)
    assert found.groupBy("doc_id").count().filter("doc_id < 90").agg({"count": "max"}).first()[0] == 3
    assert found.filter("doc_id < 20").select("items").distinct().count() == 1
    made = decontaminate.report(table, benchmark).drop("mark").collect()
    listed = [(k, text) for k, text in items if k is not None]
    assert sorted(str(tuple(r)) for r in made) == by_hand(docs, listed)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = frame(spark, odd_rows())
    assert not any(r.contaminated for r in decontaminate.report(docs, none).collect())
    assert decontaminate.clean_documents(docs, none).count() == docs.count()
    assert decontaminate.report(frame(spark, []), none).collect() == []
