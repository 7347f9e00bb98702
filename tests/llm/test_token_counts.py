"""Counts from flat files against the encoder, and blocks that cut documents."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import frame, odd_rows
from tieweave.llm import token_counts


def test_counts_equal_those_of_the_encoder(spark):
    import public_tokenizers
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = odd_rows() + [(70, "a</s>b <unk>"), (71, "\x02\x00 \x02")]
    made = token_counts.report(frame(spark, rows)).collect()
    wanted = [(i, len(pieces.encode(t or ""))) for i, t in rows]
    assert sorted(str((r.doc_id, r.n_tokens)) for r in made) == sorted(map(str, wanted))
    assert all(token_counts.SEPARATOR not in pieces.encode(t or "") for _, t in rows)
    by_part = {}
    for r in sorted(made, key=lambda r: (r.part, r.ordinal)):
        assert r.start == by_part.get(r.part, 0)
        by_part[r.part] = r.start + r.n_tokens + 1


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1 << 20])
def test_blocks_are_stitched(spark, size):
    draw = np.random.default_rng(size)
    files, wanted = [], set()
    for number in range(4):
        ids = draw.choice([2, 5, 6, 7, 600], draw.integers(0, 60)).astype("<u2")
        files.append((f"f{number}", ids.tobytes() + b"x" * (number == 2)))
        start = ordinal = 0
        for k, value in enumerate(ids):
            if value == 2:
                wanted.add((f"f{number}", ordinal, start, k - start, True))
                start, ordinal = k + 1, ordinal + 1
        if start < len(ids):
            wanted.add((f"f{number}", ordinal, start, len(ids) - start, False))
    table = spark.createDataFrame(files, "path string, content binary")
    assert {tuple(r) for r in token_counts.counts(table, 2, size).collect()} == wanted


def test_an_empty_table_has_no_rows(spark):
    assert token_counts.report(frame(spark, [])).collect() == []


def test_another_order_of_rows_stops_the_job(spark):
    """Rows dealt anew on every read: places of one read do not fit the other."""
    rows = [(k % 5, f"text number {k}") for k in range(200)]
    docs = frame(spark, rows)
    assert token_counts.report(docs.orderBy(F.rand(1))).count() == len(rows)

    def dealt(batches):
        for batch in batches:
            yield batch.take(pa.array(np.random.default_rng().permutation(batch.num_rows)))

    with pytest.raises(ValueError, match="another order"):
        token_counts.report(docs.coalesce(1).mapInArrow(dealt, docs.schema))
