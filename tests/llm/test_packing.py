"""Best-fit packing: gapless places, whole documents, and a plan like best fit by hand."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.cases import frame, odd_rows, prose
from tieweave.llm.packing import cut, pack, plan_best_fit
from tieweave.llm.tokens import byte_bpe


def best_fit_by_hand(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [k for k, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits, key=lambda k: rooms[k])] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_plan_opens_as_many_sequences_as_best_fit(seed):
    draw = np.random.default_rng(seed)
    lengths = draw.integers(1, 65, draw.integers(1, 400)).tolist()
    histogram = {n: lengths.count(n) for n in set(lengths)}
    slots, opened = plan_best_fit(histogram, 64)
    assert opened == best_fit_by_hand(lengths, 64)
    assert sum(histogram.values()) > 0 and all(s.per_sequence >= 1 for s in slots)


def test_cut_leaves_only_the_first_piece_short():
    assert cut(5, 8) == [(0, 5)]
    assert cut(8, 8) == [(0, 8)]
    assert cut(17, 8) == [(0, 1), (1, 8), (9, 8)]


def test_pack_places_every_document_whole(spark):
    rows = odd_rows() + [(100 + k, prose(k, 5 + k)) for k in range(60)]
    made = pack(frame(spark, rows), capacity=64).collect()
    places = defaultdict(list)
    for row in made:
        places[row.sequence_id].append((row.offset, row.length))
    for sequence in places.values():
        at = 0
        for offset, length in sorted(sequence):
            assert offset == at
            at += length
        assert at <= 64
    encode = byte_bpe()
    wanted = []
    for doc_id, text in rows:
        ids = np.array([*encode(text or ""), 0], "<u4")
        for piece, (start, length) in enumerate(cut(len(ids), 64)):
            wanted.append((doc_id, piece, start, length, zlib.crc32(ids[start : start + length].tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in made]
    assert sorted(map(str, got)) == sorted(map(str, wanted))
    assert len(places) == best_fit_by_hand([w[3] for w in wanted], 64)


def test_ids_equal_those_of_the_tokenizer_file():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = byte_bpe()
    texts = [t or "" for _, t in odd_rows()]
    texts += ["a<|endoftext|>b", "  x\n\n y\t", "don't 123 %%%", "  z", "é"]
    for text in texts:
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_an_empty_table_packs_to_nothing(spark):
    assert pack(frame(spark, [])).collect() == []
