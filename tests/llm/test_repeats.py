"""Long repeats against every window by hand, for bytes and for words."""

import hashlib
import random
import re

import numpy as np
import pytest

from tests.llm.cases import frame, odd_rows, prose
from tieweave.llm import relative_parsing, stretches, suffix_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ordered(rows):
    """Distinct rows in the order of documents."""
    texts = {(i, t or "") for i, t in rows}
    return sorted(texts, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest()))


def bytes_by_hand(rows, length):
    seen, out = set(), {}
    for doc_id, text in ordered(rows):
        raw = text.encode()
        gone = np.zeros(len(raw) + 1, bool)
        for at in range(len(raw) - length + 1):
            window = raw[at : at + length]
            if window in seen:
                gone[at : at + length] = True
            seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out[doc_id, text] = (doc_id, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return sorted(str(out[i, t or ""]) for i, t in rows)


def words_by_hand(rows, window):
    seen, out = set(), {}
    for doc_id, text in ordered(rows):
        words = WORD.findall(text)
        mine, gone = set(), set()
        for at in range(len(words) - window + 1):
            piece = tuple(words[at : at + window])
            mine.add(piece)
            if piece in seen:
                gone |= set(range(at, at + window))
        seen |= mine
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out[doc_id, text] = (doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return sorted(str(out[i, t or ""]) for i, t in rows)


def copies(seed, n=30):
    """Copies with edits, shared passages, and text that repeats itself."""
    draw = random.Random(seed)
    bases = [prose(seed * 100 + k, draw.randint(20, 200)) for k in range(4)]
    rows = []
    for k in range(n):
        words = []
        for _ in range(draw.randint(1, 3)):
            part = draw.choice(bases).split()
            a = draw.randrange(len(part))
            part = part[a : a + draw.randint(1, 150)]
            if part and draw.random() < 0.5:
                part[draw.randrange(len(part))] = draw.choice(["otro", "más", "🙂"])
            words += part
        if draw.random() < 0.3:
            words += [draw.choice(["la", "ab cd", "x"])] * draw.randint(1, 300)
        for _ in range(draw.randint(0, 3)):
            words += [prose(draw.randint(0, 9**9), 1)] * draw.randint(2, 40) + prose(draw.randint(0, 9**9), 9).split()
        rows.append((500 + draw.randrange(n), draw.choice([" ", "  ", "\n"]).join(words)))
    return rows


@pytest.mark.parametrize("seed,length,hot", [(1, 100, 20_000), (2, 100, 2), (3, 17, 20_000), (4, 33, 1), (5, 100, 0)])
def test_bytes_match_every_window_by_hand(spark, monkeypatch, seed, length, hot):
    monkeypatch.setattr(stretches, "HOT_PIECES", hot)
    monkeypatch.setattr(suffix_repeats, "repeated_spans", lambda d, r, m: stretches.repeated_spans(d, r, m, hot))
    rows = copies(seed) + (odd_rows() if seed < 3 else [])
    made = suffix_repeats.report(frame(spark, rows), length).drop("spans", "kept").collect()
    assert sorted(str(tuple(r)) for r in made) == bytes_by_hand(rows, length)


@pytest.mark.parametrize("seed,window,hot", [(1, 50, 20_000), (2, 50, 1), (3, 8, 20_000), (4, 20, 0)])
def test_words_match_every_window_by_hand(spark, monkeypatch, seed, window, hot):
    monkeypatch.setattr(relative_parsing, "repeated_spans", lambda d, r, m: stretches.repeated_spans(d, r, m, hot))
    rows = copies(seed) + (odd_rows() if seed < 3 else [])
    made = relative_parsing.report(frame(spark, rows), window).drop("spans", "kept").collect()
    assert sorted(str(tuple(r)) for r in made) == words_by_hand(rows, window)


def test_unique_ids_need_no_numbers(spark):
    rows = [(k, t) for k, (_, t) in enumerate(copies(6))]
    _, numbers = stretches.numbered(frame(spark, rows).select("doc_id", "text"))
    assert numbers is None
    made = suffix_repeats.report(frame(spark, rows)).drop("spans", "kept").collect()
    assert sorted(str(tuple(r)) for r in made) == bytes_by_hand(rows, 100)
    made = relative_parsing.report(frame(spark, rows)).drop("spans", "kept").collect()
    assert sorted(str(tuple(r)) for r in made) == words_by_hand(rows, 50)


@pytest.mark.parametrize("seed", range(8))
def test_suffixes_are_in_order_with_their_common_prefixes(seed):
    draw = random.Random(seed)
    texts = [bytes(draw.choice(b"ab") for _ in range(draw.randint(3, 60))) for _ in range(12)]
    rows = [(k // 6, k, 0, text) for k, text in enumerate(texts)]
    found = suffix_repeats.SuffixArray(rows, 5)
    suffixes = [found.text[a:b].tobytes() for a, b in zip(found.at, found.end, strict=True)]
    for k in range(1, len(suffixes)):
        if found.prefix[k]:
            a, b = suffixes[k - 1 : k + 1]
            common = next((n for n, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert a <= b and common == found.prefix[k] >= 5
    for size, n, earliest, others in suffix_repeats.maximal_repeats(found, 5):
        word = suffixes[earliest][:size]
        key = int(found.doc[earliest]) // 6
        wanted = sum(t[k : k + size] == word for t in texts[key * 6 : key * 6 + 6] for k in range(len(t)))
        assert n == wanted and all(suffixes[o][:size] == word for o in others)


@pytest.mark.parametrize("window,gram", [(100, 24), (10, 3), (5, 5), (9, 2)])
def test_least_grams_and_their_repeats(window, gram):
    draw = np.random.default_rng(window)
    symbols = suffix_repeats.SYMBOLS[draw.integers(0, 3, 400)]
    least, twice = stretches.least_grams(symbols, window, gram, 5)
    sums = stretches.running(symbols)
    at = np.arange(len(symbols) - gram + 1)
    grams = stretches.mixed(stretches.content(sums, at, at + gram), 5)
    assert len(least) == len(twice) == len(symbols) - window + 1
    for k in range(len(least)):
        mine = grams[k : k + window - gram + 1]
        assert least[k] == mine.min() and twice[k] == ((mine == mine.min()).sum() > 1)


def test_stretches_without_a_shared_window_have_no_spans():
    rows = [(1, 1, 0, prose(1, 40).encode()), (1, 2, 0, prose(2, 40).encode()), (2, 3, 5, b"short")]
    for some in (rows, rows[:1], rows[2:], []):
        assert list(suffix_repeats.spans_of(some, 100)) == []
        assert list(relative_parsing.spans_of(some, 50)) == []


def test_slices_of_a_long_text_change_nothing(monkeypatch):
    monkeypatch.setattr(stretches, "SLICE", 150)
    rule = suffix_repeats.byte_rule()
    text = prose(9, 300).encode()
    symbols = rule.symbols(text)
    least, _ = stretches.least_grams(symbols, rule.window, rule.gram, stretches._SEEDS[0])
    rows, _ = stretches.stretches_of([(1, 0, symbols)], rule)
    covered = np.concatenate([np.full(n, k) for k, n in zip(rows[0], rows[4], strict=True)])
    assert np.array_equal(covered, least)


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert suffix_repeats.report(empty).collect() == relative_parsing.report(empty).collect() == []


@pytest.mark.parametrize("module,limit", [(suffix_repeats, 100), (relative_parsing, 50)])
def test_a_passage_below_the_window_in_all_documents_stays_out_of_one_task(spark, monkeypatch, module, limit):
    """Stretches that differ around a shared passage must not meet in one call."""
    near = prose(41, 45)
    common = near.encode()[:95].decode() if module is suffix_repeats else near
    rows = [(k, f"{prose(1000 + k, 30)} {common} {prose(2000 + k, 30)}") for k in range(60)]
    rows += [(100 + k, rows[k][1]) for k in range(0, 60, 7)]
    log = spark.sparkContext.accumulator(0)
    method = module.spans_of

    def watched(pieces, *args, **named):
        counts = {}
        for key, *_ in pieces:
            counts[key] = counts.get(key, 0) + 1
        log.add(sum(n > 10 for n in counts.values()))
        return method(pieces, *args, **named)

    monkeypatch.setattr(module, "spans_of", watched)
    monkeypatch.setattr(module, "repeated_spans", lambda d, r, m: stretches.repeated_spans(d, r, m, 10))
    made = module.report(frame(spark, rows), limit).drop("spans", "kept").collect()
    by_hand = bytes_by_hand if module is suffix_repeats else words_by_hand
    assert sorted(str(tuple(r)) for r in made) == by_hand(rows, limit)
    assert log.value == 0
