"""SimHash near duplicates against all pairs by hand."""

import random
import re

import numpy as np
import xxhash

from tests.llm.cases import frame, odd_rows, prose
from tieweave.llm import simhash_trie
from tieweave.llm.components import components
from tieweave.llm.simhash_trie import block_masks, links, near_duplicates


def print_by_hand(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    width = min(3, len(words))
    shingles = [" ".join(words[k : k + width]) for k in range(len(words) - width + 1)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_by_hand(values, linked):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if linked(a, b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


def by_hand(rows):
    prints = [print_by_hand(text) for _, text in rows]
    roots = roots_by_hand(sorted(set(prints)), lambda a, b: (a ^ b).bit_count() <= 3)
    out = []
    for (doc_id, _), value in zip(rows, prints, strict=True):
        ids = [i for (i, _), p in zip(rows, prints, strict=True) if roots[p] == roots[value] and i is not None]
        out.append((doc_id, f"{value:016x}", min(ids, default=None)))
    return sorted(map(str, out))


def test_matches_all_pairs_by_hand(spark):
    rows = odd_rows()
    base = prose(5, 300).split()
    draw = random.Random(3)
    for k in range(60):
        words = list(base)
        for _ in range(draw.randint(0, 4)):
            words[draw.randrange(len(words))] = "swap"
        rows.append((200 + k, " ".join(words)))
    made = [tuple(r) for r in near_duplicates(frame(spark, rows)).collect()]
    assert sorted(map(str, made)) == by_hand(rows)


def test_two_blocks_of_five_survive_three_flips():
    masks = block_masks(3)
    draw = random.Random(1)
    for _ in range(500):
        flips = sum(1 << b for b in draw.sample(range(64), 3))
        assert any(mask & flips == 0 for mask in masks)


def test_links_span_the_groups_whole_and_divided(spark, monkeypatch):
    draw = random.Random(7)
    values = set()
    for _ in range(25):
        value = draw.getrandbits(64)
        values.add(value)
        for _ in range(20):
            value ^= 1 << draw.randrange(64)
            value ^= 1 << draw.randrange(64)
            values.add(value)
    signed = {int(np.uint64(v).astype(np.int64)): v for v in values}
    want = roots_by_hand(sorted(signed), lambda a, b: (signed[a] ^ signed[b]).bit_count() <= 3)
    prints = spark.createDataFrame([(v,) for v in signed], "simhash long")
    for rows, pairs in ((1 << 14, 1 << 19), (3, 1 << 19), (1 << 14, 4)):
        monkeypatch.setattr(simhash_trie, "TRIE_ROWS", rows)
        monkeypatch.setattr(simhash_trie, "PAIRS", pairs)
        found = {r.node: r.root for r in components(links(prints)).collect()}
        assert {v: found.get(v, v) for v in signed} == want


def test_components_of_chains_and_hubs(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 200)]
    frame = spark.createDataFrame(edges, "u long, v long")
    found = {r.node: r.root for r in components(frame).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}


def test_an_empty_table_has_no_rows(spark):
    assert near_duplicates(frame(spark, [])).collect() == []
