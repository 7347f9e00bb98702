"""Edited texts, likeness and the block tables, against plain Python."""

import hashlib
import random
import re
import struct

import pytest
import xxhash

from tests.llm.cases import frame, odd_rows, prose
from tieweave.llm.simhash_prints import RADIUS, neighbours, part_tables, report, search


def edited_by_hand(rows):
    rows = [(i, t or "") for i, t in rows]
    marked = sorted(
        rows,
        key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest()),
        reverse=True,
    )
    out = []
    for k, (doc_id, text) in enumerate(marked):
        after = marked[(k + 1) % len(marked)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(map(str, out))


def test_edited_texts_and_equal_fingerprints(spark):
    rows = odd_rows() + [(300 + k, prose(300 + k, 150)) for k in range(40)]
    made = report(frame(spark, rows)).collect()
    assert sorted(str((r.doc_id, r.n_chars, r.edited_sha256)) for r in made) == edited_by_hand(rows)
    by_id = {r.doc_id: r for r in made}
    assert by_id[1].fingerprint == by_id[2].fingerprint
    assert by_id[3].fingerprint == by_id[4].fingerprint == by_id[5].fingerprint == "0" * 32
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in made)
    fresh = [r for r in made if (r.doc_id or 0) >= 301]
    assert sum(r.near_edited > r.near_next for r in fresh) > 0.9 * len(fresh)
    shown = {r.doc_id: int(r.fingerprint, 16) for r in made}
    for k in range(301, 340):
        bits = (shown[k] ^ shown[k - 1]).bit_count()
        assert by_id[k].near_next == pytest.approx(1 - bits / 128)


def test_near_fingerprints_of_every_twentieth_document(spark):
    base = prose(8, 600).split()
    rows = [(k, " ".join([*base[:k], "swap", *base[k + 1 :]])) for k in range(1, 61)] + [(80, prose(9, 50)), (None, "x")]
    made = report(frame(spark, rows), radius=3).collect()
    values = {int(r.fingerprint, 16) for r in made}
    for r in made:
        mine = int(r.fingerprint, 16)
        wanted = sum(0 < (mine ^ v).bit_count() <= 3 for v in values)
        assert r.n_near == (wanted if r.doc_id is not None and r.doc_id % 20 == 0 else None)
    assert any(r.n_near for r in made)


def test_search_finds_all_within_the_radius(spark):
    draw = random.Random(2)
    values = [draw.getrandbits(128) for _ in range(40)]
    for value in list(values):
        for flips in (1, 2, 3, 4):
            values.append(value ^ sum(1 << b for b in draw.sample(range(128), flips)))

    def signed(part):
        return part - (1 << 64) if part >> 63 else part

    def rows(chosen):
        pairs = [(signed(v >> 64), signed(v & (1 << 64) - 1)) for v in chosen]
        return spark.createDataFrame(pairs, "high long, low long")

    asked = values[::7]
    wanted = {(q, v, (q ^ v).bit_count()) for q in asked for v in values if (q ^ v).bit_count() <= 3}
    found = {
        ((r.query_high % 2**64) << 64 | r.query_low % 2**64, (r.high % 2**64) << 64 | r.low % 2**64, r.bits)
        for r in search(rows(asked), rows(values), 3).collect()
    }
    assert found == wanted


def test_one_document_and_none(spark):
    lone = report(frame(spark, [(7, "ab cd")])).collect()[0]
    assert lone.edited_sha256 == hashlib.sha256(b"ab ab").hexdigest()
    assert lone.near_next == 1
    assert report(frame(spark, [])).collect() == []


def listed(made, doc_id):
    """Neighbour classes of a document: fingerprint to bits and documents."""
    parts = [p.split(":") for r in made if r.doc_id == doc_id for p in r.near_classes.split(",") if p]
    return {f: (int(bits), int(docs)) for f, bits, docs in parts}


def test_copies_and_edited_texts_are_neighbours(spark):
    words = prose(21, 120).split()
    edited = [*words[:40], "other", *words[41:80], "swap", *words[81:]]
    far = prose(22, 120)
    rows = [(20, " ".join(words)), (21, " ".join(words)), (22, " ".join(edited)), (23, " ".join(words[:112])), (40, far), (41, prose(23, 80))]
    made = report(frame(spark, rows)).collect()
    assert len(made) == len(rows)
    shown = {r.doc_id: r.fingerprint for r in made}
    members = {f: sorted(k for k, v in shown.items() if v == f) for f in shown.values()}
    values = {f: int(f, 16) for f in members}
    for doc_id in (20, 40):
        own = shown[doc_id]
        wanted = {}
        for f, value in values.items():
            bits = (value ^ values[own]).bit_count()
            if bits <= RADIUS and (bits or len(members[f]) > 1):
                wanted[f] = (bits, len(members[f]))
        assert listed(made, doc_id) == wanted
    found = {d for f in listed(made, 20) for d in members[f]}
    assert {20, 21, 22} <= found and 40 not in found
    assert (shown[20] != shown[22]) and max(bits for bits, _ in listed(made, 20).values()) > 3
    pairs = {(r.fingerprint, r.neighbour, r.bits, r.neighbour_docs) for r in neighbours(frame(spark, rows)).collect()}
    assert pairs == {(shown[d], f, *v) for d in (20, 40) for f, v in listed(made, d).items()}
    by_id = {r.doc_id: r for r in made}
    assert by_id[20].n_near_docs == len(found) - 1 and by_id[40].n_near_docs == 0
    assert by_id[21].near_classes is None and by_id[21].n_near is None
    assert by_id[40].near_classes == ""


def test_search_finds_all_within_wider_radii(spark):
    draw = random.Random(5)
    values = [draw.getrandbits(128) for _ in range(12)]
    for value in list(values):
        for flips in (6, 7, 8, 10, 11, 17, 19, 20, 21):
            values.append(value ^ sum(1 << b for b in draw.sample(range(128), flips)))
        values.append(value ^ (1 << 20) - 1)

    def rows(chosen):
        pairs = [tuple(p - (1 << 64) if p >> 63 else p for p in (v >> 64, v & (1 << 64) - 1)) for v in chosen]
        return spark.createDataFrame(pairs, "high long, low long")

    for radius in (7, 10, RADIUS):
        wanted = sorted((q, v, (q ^ v).bit_count()) for q in values[::3] for v in values if (q ^ v).bit_count() <= radius)
        found = sorted(
            ((r.query_high % 2**64) << 64 | r.query_low % 2**64, (r.high % 2**64) << 64 | r.low % 2**64, r.bits)
            for r in search(rows(values[::3]), rows(values), radius).collect()
        )
        assert found == wanted


def fingerprint_by_hand(text):
    """128 signed votes of words and pairs, with XXH64 chained from seed 42."""
    def chained(kind, *words):
        value = xxhash.xxh64_intdigest(struct.pack("<i", kind), seed=42)
        for word in words:
            value = xxhash.xxh64_intdigest(word.encode(), seed=value)
        return value

    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    votes, weight = [0] * 128, 0
    for k, word in enumerate(words):
        terms = [(chained(2, *words[k : k + 2]), 2)] + [(chained(1, word), 1)] * (len(word) > 3)
        for first, worth in terms:
            second = xxhash.xxh64_intdigest(struct.pack("<Q", first), seed=42)
            weight += worth
            for bit in range(64):
                votes[64 + bit] += worth * (first >> bit & 1)
                votes[bit] += worth * (second >> bit & 1)
    return f"{sum(1 << b for b in range(128) if votes[b] * 2 > weight):032x}"


def test_votes_against_plain_python(spark):
    long = " ".join(f"w{k % 977} and" for k in range(20_000))
    rows = odd_rows() + [(300 + k, prose(300 + k, 20 + 30 * k)) for k in range(8)] + [(400, "Å\u00a0b \t ce\x0bdéfgh"), (401, long)]
    texts = dict(rows)
    for r in report(frame(spark, [row for row in rows if row[0] is not None])).collect():
        options = {fingerprint_by_hand(t or "") for i, t in rows if i == r.doc_id}
        assert r.fingerprint in options, texts[r.doc_id][:60]


def test_ids_of_any_type_and_one_id_in_many_rows(spark):
    texts = [(None if k % 3 else "a", prose(500 + k, 30)) for k in range(90)] + [("40", "forty"), ("b20", "x y")]
    docs = spark.createDataFrame(texts, "doc_id string, text string")
    made = report(docs).collect()
    marked = sorted(
        texts, key=lambda r: (r[0] is not None, r[0] or "", hashlib.md5(r[1].encode()).hexdigest()), reverse=True
    )
    wanted = []
    for k, (doc_id, text) in enumerate(marked):
        after, half = marked[(k + 1) % len(marked)][1], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        wanted.append(str((doc_id, hashlib.sha256(edited.encode()).hexdigest())))
    assert sorted(str((r.doc_id, r.edited_sha256)) for r in made) == sorted(wanted)
    assert {r.doc_id for r in made if r.n_near is not None} == {"40"}


def test_parts_grow_with_the_index(spark):
    for radius in (0, 3, 7, RADIUS):
        widths = []
        for rows in (0, 10**3, 10**5, 10**7, 10**9, 10**11):
            masks, flips = part_tables(radius, rows)
            assert sum(masks) == (1 << 128) - 1 and len(masks) * (flips + 1) > radius
            widths.append(128 // len(masks))
        assert widths == sorted(widths)
    assert widths[0] < 18 and widths[-1] == 32


def test_one_word_over_and_over_in_a_long_text(spark):
    """Every vote falls on the same bits, so the uppermost counters run highest."""
    word = next(w for w in map("longword{}".format, range(999)) if xxhash.xxh64(w.encode(), 1).intdigest())
    rows = [(1, f"{word} " * 40_000), (2, f"{word} " * 20), (3, "ka lo")]
    made = {r.doc_id: r for r in report(frame(spark, rows), radius=3).collect()}
    assert made[1].n_chars == 40_000 * (len(word) + 1)
    assert bin(int(made[1].fingerprint, 16) ^ int(made[2].fingerprint, 16)).count("1") < 40
