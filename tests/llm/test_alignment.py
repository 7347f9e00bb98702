"""Groups and links of two tokenizations, against loops over single bytes."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.cases import frame, odd_rows, prose
from tieweave.llm import alignment


def tokens_by_hand(text):
    """(id, bytes) of both sides by the tokenizer file and the model, or nothing."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    byte_of = {}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    for number, value in enumerate(plain + [v for v in range(256) if v not in plain]):
        byte_of[chr(value if number < len(plain) else 256 + number - len(plain))] = value
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def tokens(text):
        if not text:
            return [], []
        in_a = a.encode(" " + text, add_special_tokens=False).ids
        made_a = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in in_a]
        made_b = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            raw = bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("\u2581", " ").encode()
            made_b.append((i, raw))
        wanted = (" " + text).encode()
        if any(b"".join(raw for _, raw in made) != wanted for made in (made_a, made_b)):
            return [], []
        return made_a, made_b

    return tokens(text)


def spans(made):
    ends = np.cumsum([len(raw) for _, raw in made]).tolist()
    return [(i, e - len(raw), e) for (i, raw), e in zip(made, ends, strict=True)]


def by_hand(rows):
    docs, held = [], Counter()
    for doc_id, text in rows:
        a, b = map(spans, tokens_by_hand(text))
        both = {e for _, _, e in a} & {e for _, _, e in b}
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e] if len(a) < 3000 else None
        groups, low = [], 0
        for cut in sorted(both):
            inside = [",".join(str(i) for i, s, e in side if low <= s and e <= cut) for side in (a, b)]
            groups.append("|".join(inside))
            low = cut
        docs.append((doc_id, len(a), len(b), len(groups), links, ";".join(groups)))
        held.update(set(links))
    best = defaultdict(int)
    for (i, _), n in held.items():
        best[i] = max(best[i], n)
    out = []
    for doc_id, n_a, n_b, n_groups, links, groups in docs:
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        n_best = sum(held[link] == best[link[0]] for link in links)
        out.append((doc_id, n_a, n_b, n_groups, len(links), n_best, sum(held[k] for k in links), digest))
    return sorted(map(str, out)), {(i, t[5]) for (i, _), t in zip(rows, docs, strict=True)}


def rows():
    made = [(i, t if not t or len(t) < 4000 else t[:4000]) for i, t in odd_rows()]
    made += [
        (40, "a<|endoftext|>b </s> <s> <unk> <0x41>"), (41, "x\u2581y"), (42, "  two  spaces "), (43, "\u2581"),
        (44, "\ufb01ne \u00bd \u2460 e\u0301"), (45, "\U0001f642\u200d\u6771\u4eac\n\ttab"), (46, " "),
        (47, "don't 1234567 %%% ___"), (48, "nul\x00 \x01\x7f"), (49, "\r\n\r\n"),
    ]
    return made + [(50 + k, prose(90 + k, 30)) for k in range(8)]


@pytest.mark.parametrize("sent", [alignment.SENT_PAIRS, 40, 0])
def test_documents_match_by_hand(spark, sent):
    made = alignment.aligned(frame(spark, rows()), sent)
    assert made.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    wanted, _ = by_hand(rows())
    assert sorted(str(tuple(r)) for r in made.collect()) == wanted


def test_groups_are_written_out(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK", 100)
    _, wanted = by_hand(rows())
    made = alignment.groups(frame(spark, rows())).collect()
    assert {(r.doc_id, r.groups) for r in made} == wanted and len(made) == len(rows())


def test_intervals_with_gaps_and_overlaps_fall_into_groups():
    start, end = np.array([0, 5, 2, 9, 9, 4]), np.array([3, 6, 4, 10, 12, 5])
    assert alignment.coalesced(start, end).tolist() == [0, 2, 0, 3, 3, 1]


def test_empty_tables_and_tables_without_tokens(spark):
    assert alignment.aligned(frame(spark, [])).collect() == []
    made = alignment.aligned(frame(spark, [(1, None), (None, "")])).collect()
    assert sorted(str(tuple(r)) for r in made) == sorted(str((i, 0, 0, 0, 0, 0, 0, "")) for i in (1, None))
