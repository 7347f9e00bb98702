"""The pipeline stage by stage against plain Python on a small corpus."""

import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from tests.llm import test_decontaminate, test_secrets, test_simhash_trie
from tests.llm.cases import frame, odd_rows, prose
from tests.llm.test_classifiers import toxic_table
from tieweave.llm import toxicity
from tieweave.llm.packing import cut
from tieweave.llm.tokens import byte_bpe


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    texts, bad = toxic_table()
    rows = list(enumerate(texts + bad, 1000)) + test_secrets.rows() + odd_rows()
    rows += [(2000 + k, f"{prose(70 + k, 20)} {prose(50, 30)} {prose(80 + k, 9)}") for k in range(3)]
    items = [(0, prose(50, 30)), (1, prose(51, 12)), (2, None)]
    labels = [(k, 0) for k in range(1000, 1100)] + [(k, 1) for k in range(1120, 1145)]
    folder = tmp_path_factory.mktemp("corpus").as_uri()
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows, items, dict(labels)


def by_hand(rows, items, labels):
    sample = sorted((i, t or "") for i, t in rows if i in labels)
    model = toxicity.fit([t for _, t in sample], np.array([float(labels[i]) for i, _ in sample]))
    stages = [[(i, t) for i, t in rows if model.total(t or "") < model.cut]]
    groups = {}
    roots = test_simhash_trie.roots_by_hand(
        sorted({test_simhash_trie.print_by_hand(t) for _, t in stages[-1]}), lambda a, b: (a ^ b).bit_count() <= 3
    )
    for i, t in stages[-1]:
        groups.setdefault(roots[test_simhash_trie.print_by_hand(t)], []).append((i, t))
    stages.append([min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()])
    stages.append([
        row for row in stages[-1] if re.search("False\\)$", test_decontaminate.by_hand([row], items)[0])
    ])
    masked = []
    for i, t in stages[-1]:
        spans = test_secrets.base_by_hand(t or "") + test_secrets.entropy_by_hand(t or "")
        gone = {k for a, _, b in spans for k in range(a, b)}
        masked.append((i, t and "".join(
            ("" if k - 1 in gone else "[SECRET]") if k in gone else c for k, c in enumerate(t)
        )))
    return [*stages, masked]


def test_every_stage_and_the_whole(spark, corpus):
    folder, rows, items, labels = corpus
    wanted = by_hand(rows, items, labels)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for (name, stage), kept in zip(corpus_pipeline.STAGES[:-1], wanted, strict=True):
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        made = docs.collect()
        assert sorted(str((r.doc_id, r.text)) for r in made) == sorted(map(str, kept)), name
        docs = spark.createDataFrame(made, docs.schema)
    assert len(rows) > len(wanted[0]) > len(wanted[1]) > len(wanted[2])
    encode = byte_bpe()
    pieces = []
    for doc_id, text in wanted[-1]:
        ids = np.array([*encode(text or ""), 0], "<u4")
        for piece, (start, length) in enumerate(cut(len(ids), 2048)):
            pieces.append((doc_id, piece, start, length, zlib.crc32(ids[start : start + length].tobytes())))
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in whole) == sorted(map(str, pieces))


def test_an_empty_corpus(spark, corpus, tmp_path):
    folder = corpus[0]
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path.as_uri()}/{name}.parquet")
    assert corpus_pipeline.run(spark, tmp_path.as_uri()).collect() == []
