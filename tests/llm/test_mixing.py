"""Mixing to target weights, against tilts found by halving in plain Python."""

import math
import re
from collections import defaultdict

import pytest

from tests.llm.cases import frame, odd_rows, prose
from tieweave.llm import mixing

WORD = re.compile("[^\\x20\\x09-\\x0d]+")


def targets_by_hand(totals, weights, cap=3):
    open_, made, left = set(totals), {}, sum(totals.values())
    while True:
        weight = sum(weights[s] for s in open_)
        above = {s for s in open_ if weight and left * weights[s] / weight > cap * totals[s]}
        if not above:
            return made | {s: left * weights[s] / weight if weight else 0.0 for s in open_}
        made |= {s: float(cap * totals[s]) for s in above}
        left -= sum(made[s] for s in above)
        open_ -= above


def tilt_by_hand(sizes, target, cap=3):
    low, high = -60.0, 60.0
    for _ in range(300):
        tilt = (low + high) / 2
        words = sum(x * min(cap, math.exp(min(tilt * x, 50))) for x in sizes)
        low, high = (tilt, high) if words < target else (low, tilt)
    return (low + high) / 2


def rows():
    made = []
    for source, count, length in ((None, 60, 40), ("a", 80, 25), ("b", 300, 60), ("é", 50, 30), ("東", 40, 90), ("z", 1, 7)):
        made += [(f"{source}-{k}", source, prose(len(made) + k, 1 + (k * k) % length)) for k in range(count)]
    return made + [("null", "a", None), ("empty", "b", " \n"), (None, "b", "x y"), (None, "b", "x y")]


def table(spark, made):
    listed = [(i, s, t, 1, "r") for i, s, t in made]
    return spark.createDataFrame(listed, "doc_id string, source string, text string, key int, rate string")


def mixed(spark, made, **options):
    docs = table(spark, made).withColumn("size", mixing.n_words(mixing.F.col("text")))
    return mixing.mix(docs, mixing.in_turn(docs), **options)


@pytest.mark.parametrize("class_rows", [mixing.CLASS_ROWS, 4])
@pytest.mark.parametrize("sent", [mixing.SENT_BYTES, 0])
def test_rates_solve_the_balance_and_copies_keep_the_targets(spark, monkeypatch, class_rows, sent):
    monkeypatch.setattr(mixing, "SENT_BYTES", sent)
    made = rows()
    sizes = defaultdict(list)
    for _, source, text in made:
        sizes[source].append(len(WORD.findall(text or "")))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    wanted = targets_by_hand({s: sum(x) for s, x in sizes.items()}, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)})
    got = mixed(spark, made, class_rows=class_rows)
    assert got.columns == ["doc_id", "source", "text", "key", "size", "source_size", "target", "rate", "copies"]
    got = got.collect()
    assert sorted(str((r.doc_id, r.source, r.size)) for r in got) == sorted(
        str((i, s, len(WORD.findall(t or "")))) for i, s, t in made
    )
    taken = defaultdict(int)
    for row in got:
        assert row.source_size == sum(sizes[row.source]) and 0 <= row.copies <= 3
        assert row.target == pytest.approx(wanted[row.source])
        taken[row.source] += row.copies * row.size
    for source in order:
        tilt = tilt_by_hand([x for x in sizes[source] if x], wanted[source])
        rates = {r.size: r.rate for r in got if r.source == source}
        for size, rate in rates.items():
            if size:
                assert rate == pytest.approx(min(3, math.exp(min(tilt * size, 50))), rel=0.02)
        assert abs(taken[source] - wanted[source]) <= 8


def test_a_rerun_over_other_partitions_agrees(spark):
    made = rows()
    wide = lambda df: sorted(str(r) for r in df.collect())
    assert wide(mixed(spark, made)) == wide(mixed(spark, made[::-1]))


def test_a_mix_repeats_rows(spark):
    got = mixed(spark, rows())
    copies = got.agg(mixing.F.sum("copies")).first()[0]
    assert mixing.repeated(got).count() == copies


def test_the_query_and_odd_tables(spark, tmp_path):
    frame(spark, odd_rows()).write.parquet(f"{tmp_path}/documents.parquet")
    got = mixing.op11_source_mixing(spark, tmp_path.as_uri()).collect()
    assert len(got) == len(odd_rows())
    total = sum(len(WORD.findall(t or "")) for _, t in odd_rows())
    assert {(r.source_size, r.target) for r in got} == {(total, float(total))}
    assert all(r.taken == r.size for r in got)
    frame(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert mixing.op11_source_mixing(spark, f"{tmp_path.as_uri()}/none").collect() == []
    nothing = [("a", "x", ""), ("b", "y", None)]
    assert [r.copies * r.size for r in mixed(spark, nothing).collect()] == [0, 0]
    with pytest.raises(ValueError):
        mixed(spark, nothing, cap=0)
