"""Spelling variants, against all pairs of words by hand."""

import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm.cases import frame, odd_rows, prose
from tieweave.llm import spelling

RUN = re.compile("[A-Za-z\u00c0-\u00ff]+")


def near(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(p != q for p, q in zip(x, y, strict=True)) == 1
    return len(y) == len(x) + 1 and any(y[:k] + y[k + 1 :] == x for k in range(len(y)))


def words_by_hand(rows, odd=199, least=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % odd == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 6
    return {word: n for word, n in counts.items() if n >= least}


def by_hand(counts):
    made = {}
    for word, n in counts.items():
        others = [o for o in counts if near(word, o)]
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form = best if best and counts[best] >= 5 * n else None
        made[word] = (n, len(others), form)
    out = []
    for word, (n, n_near, form) in made.items():
        root = word
        while made[root][2]:
            root = made[root][2]
        out.append((word, n, n_near, form, counts.get(form), root))
    return sorted(map(str, out))


def corpus():
    draw = random.Random(5)
    stems = [prose(700 + k, 1) + "kala" for k in range(30)] + ["\u00e9l\u00e8ves", "\u00c9l\u00e8ves", "\u00f7\u00d7\u00f7\u00d7\u00f7\u00d7", "stra\u00dfen"]
    letters = "abz\u00e9\u00ff"
    rows = []
    for doc in range(250):
        words = []
        for _ in range(40):
            word = draw.choice(stems[: 1 + draw.randrange(len(stems))])
            if draw.random() < 0.2:
                k, kind = draw.randrange(len(word)), draw.randrange(3)
                word = word[:k] + ("" if kind == 0 else draw.choice(letters)) + word[k + (kind < 2) :]
            words.append(draw.choice([word, word.upper() if word.isascii() else word, word.title()]))
        rows.append((doc, ", ".join(words)))
    return rows + odd_rows() + [(9000, "\u6771kalalo\u6771kalalo_kalalo9kalalo-kalalo \u0100kalalo")]


def test_vocabulary_matches_by_hand(spark):
    for odd in (199, 3):
        made = spelling.vocabulary(frame(spark, corpus()), odd).collect()
        assert {r.word: r.n for r in made} == words_by_hand(corpus(), odd)
        assert len(made) == len({r.word for r in made})


@pytest.mark.parametrize(("symbols", "full"), [(8, 128), (2, 1000), (8, 1), (3, 4), (1, 0)])
def test_variants_match_all_pairs(spark, symbols, full):
    counts = words_by_hand(corpus(), 3)
    assert len(counts) > 100
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    made = spelling.variants(words, symbols=symbols, full=full)
    assert made.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    got = made.collect()
    assert sorted(str(tuple(r)) for r in got) == by_hand(counts)
    assert any(r.root not in (r.word, r.form) for r in got) or symbols


def test_forms_are_followed_to_the_last(spark):
    words = [("kalalo" + "a" * k, 5 * 6**k) for k in range(7)] + [("mimimi", 5), ("mimimo", 25), ("mimima", 25)]
    made = spelling.variants(spark.createDataFrame(words, "word string, n long")).collect()
    assert sorted(str(tuple(r)) for r in made) == by_hand(dict(words))
    roots = {r.word: r.root for r in made}
    assert roots["kalalo"] == "kalaloaaaaaa" and roots["mimimi"] == "mimima"


def test_the_query_words_in_documents_and_empty_tables(spark, tmp_path):
    rows = corpus()
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    made = spelling.op13_spelling_variants(spark, tmp_path.as_uri())
    assert sorted(str(tuple(r)) for r in made.collect()) == by_hand(words_by_hand(rows))
    places = spelling.spelt_as(frame(spark, rows), made).collect()
    roots = {r.word: r.root for r in made.collect()}
    assert places and all(roots[r.run] == r.root != r.run for r in places)
    frame(spark, [(1, None), (2, "")]).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert spelling.op13_spelling_variants(spark, f"{tmp_path.as_uri()}/none").collect() == []


def test_no_vocabulary_is_sent_whole(spark, monkeypatch):
    """A written vocabulary is small as a file; it is joined by shuffles all the same."""
    plans, write = [], spelling.RoundTables.write

    def seen(self, df, **measures):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, df, **measures)

    monkeypatch.setattr(spelling.RoundTables, "write", seen)
    words = spark.createDataFrame(list(words_by_hand(corpus(), 3).items()), "word string, n long")
    made = spelling.variants(words, full=4)
    plans.append(made._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in plan for plan in plans) > 3
    assert not [plan for plan in plans if "Broadcast" in plan]
