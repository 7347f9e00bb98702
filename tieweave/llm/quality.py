"""Quality scores by a byte-level convolutional network in numpy.

A text is cut into blocks of 8 bytes; a chunk is two neighbouring blocks, so chunks
overlap and cover the whole text. A chunk's input is a learned vector per byte, and
per block the number of bytes that equal the byte 2 to 28 places before, by which
filters can see repetition. Filters are learned over chunks, the largest answer of
each over the whole text is kept, and these are combined into one probability.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tieweave.llm.samples import labelled_sample
from tieweave.llm.tables import documents, per_batch, schema_of, table, text_bytes

BLOCK, VECTOR, FILTERS = 8, 6, 24
LAGS = range(2, 29)
PAD = 32
INPUT = BLOCK * VECTOR + len(LAGS)
#: Bytes of text that go through the network at once.
BATCH_BYTES = 1 << 20
#: The fitted sample: so many labelled rows at most, of so many bytes each at most.
SAMPLE_ROWS, SAMPLE_BYTES = 3000, 1 << 15
EPOCHS, BATCH_TEXTS, RATE = 12, 48, 0.01
HELD_OUT = 2


class Network:
    def __init__(self, seed: int = 7) -> None:
        draw = np.random.default_rng(seed)
        self.vectors = draw.normal(0, 0.3, (256, VECTOR)).astype(np.float32)
        self.filters = draw.normal(0, 0.1, (2, INPUT, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = draw.normal(0, 0.3, FILTERS).astype(np.float32)
        self.shift = np.zeros(1, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.vectors, self.filters, self.bias, self.out, self.shift]

    def blocks(self, parts: list[bytes], befores: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes and inputs of the blocks of some texts, and the first block of each.

        Each text stands after ``PAD`` bytes, its own ``before`` or zeros, and is
        filled up with zeros to whole blocks and one block more.
        """
        room = [-(-max(1, len(part)) // BLOCK) * BLOCK + BLOCK for part in parts]
        starts = np.cumsum([0, *[PAD + r for r in room]])
        raw = bytearray(int(starts[-1]))
        for at, part, before in zip(starts, parts, befores, strict=False):
            raw[at + PAD - len(before) : at + PAD] = before
            raw[at + PAD : at + PAD + len(part)] = part
        text = np.frombuffer(raw, np.uint8)
        made = np.empty((len(text) // BLOCK, INPUT), np.float32)
        made[:, : BLOCK * VECTOR] = self.vectors[text].reshape(-1, BLOCK * VECTOR)
        same = np.zeros(len(text), np.uint8)
        for k, lag in enumerate(LAGS):
            same[lag:] = text[lag:] == text[:-lag]
            made[:, BLOCK * VECTOR + k] = np.bitwise_count(same.view(np.uint64))
        made[:, BLOCK * VECTOR :] /= BLOCK
        return text, made, (starts[:-1] + PAD) // BLOCK

    def answers(self, made: np.ndarray) -> np.ndarray:
        """Answer of every filter to the chunk that begins at each block but the last."""
        both = made @ np.concatenate([self.filters[0], self.filters[1]], axis=1)
        return both[:-1, :FILTERS] + both[1:, FILTERS:] + self.bias

    def pooled(self, parts: list[bytes], befores: list[bytes], chunks: list[int]) -> np.ndarray:
        """Largest answers of each filter over the first ``chunks`` of each part."""
        _, made, first = self.blocks(parts, befores)
        answers = self.answers(made)
        last = first + np.array(chunks)
        # Chunks of the padding between two texts belong to neither.
        bounds = np.stack([first, np.minimum(last, len(answers))], 1).ravel()
        if bounds[-1] == len(answers):
            bounds = bounds[:-1]
        return np.maximum.reduceat(answers, bounds)[::2]

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1; texts of any length, in bounded memory."""
        best = np.full((len(texts), FILTERS), -np.inf, np.float32)
        held: list[tuple[int, bytes, bytes, int]] = []
        size = 0
        for k, text in enumerate(texts):
            for at in range(0, max(1, len(text)), BATCH_BYTES):
                # A slice goes one block beyond its end, so that no chunk is cut.
                part = text[at : at + BATCH_BYTES + BLOCK]
                chunks = -(-max(1, min(len(text) - at, BATCH_BYTES)) // BLOCK)
                held.append((k, part, text[max(0, at - PAD) : at], chunks))
                size += len(part) + PAD
                if size >= BATCH_BYTES:
                    self._keep(best, held)
                    held, size = [], 0
        if held:
            self._keep(best, held)
        logits = np.maximum(best, 0) @ self.out + self.shift
        return 1 / (1 + np.exp(-logits.astype(np.float64)))

    def _keep(self, best: np.ndarray, held: list[tuple[int, bytes, bytes, int]]) -> None:
        places, parts, befores, chunks = (list(x) for x in zip(*held, strict=True))
        np.maximum.at(best, places, self.pooled(parts, befores, chunks))

    def gradients(self, texts: list[bytes], wanted: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
        raw, made, first = self.blocks(texts, [b""] * len(texts))
        answers = self.answers(made)
        ends = first + [-(-max(1, len(text)) // BLOCK) for text in texts]
        at = np.stack([a + answers[a:b].argmax(0) for a, b in zip(first, ends, strict=True)])
        best = np.take_along_axis(answers, at.reshape(-1, FILTERS), 0)
        live = np.maximum(best, 0)
        miss = 1 / (1 + np.exp(-(live @ self.out + self.shift))) - wanted
        miss = (miss * weights / len(texts)).astype(np.float32)
        back = np.where(best > 0, miss[:, None] * self.out, 0).astype(np.float32)
        filters, vectors = np.zeros_like(self.filters), np.zeros_like(self.vectors)
        column = np.broadcast_to(np.arange(FILTERS), at.shape)
        for side in range(2):
            seen = made[at + side]  # texts x filters x inputs
            filters[side] = np.einsum("tfi,tf->if", seen, back)
            down = back[..., None] * self.filters[side][: BLOCK * VECTOR].T[column]
            bytes_ = raw.reshape(-1, BLOCK)[at + side]
            np.add.at(vectors, bytes_.ravel(), down.reshape(-1, VECTOR))
        return [vectors, filters, back.sum(0), live.T @ miss, miss.sum(keepdims=True)]


def fit(texts: list[bytes], wanted: np.ndarray, seed: int = 7) -> Network:
    """Fits by Adam; the rarer label gets more weight, but less than in full, and the
    shift is set afterwards so that the mean score is the share of label 1."""
    network = Network(seed)
    if not len(texts) or wanted.min() == wanted.max():
        share = (wanted.sum() + 1) / (len(wanted) + 2)
        network.out[:] = 0
        network.shift[:] = np.log(share / (1 - share))
        return network
    share = wanted.mean()
    weights = np.where(wanted == 1, 0.5 / share, 0.5 / (1 - share)) ** 0.5
    draw = np.random.default_rng(seed)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in network.parameters()]
    steps = 0
    order_size = np.array([len(text) for text in texts])
    for epoch in range(EPOCHS):
        # Texts of like size together keep batches small; batches come in any order.
        order = np.argsort(order_size * draw.uniform(0.7, 1.3, len(texts)))
        batches = [order[k : k + BATCH_TEXTS] for k in range(0, len(order), BATCH_TEXTS)]
        draw.shuffle(batches)
        for chosen in batches:
            steps += 1
            made = network.gradients([texts[k] for k in chosen], wanted[chosen], weights[chosen])
            rate = RATE * (1 - epoch / EPOCHS)
            for value, gradient, (mean, square) in zip(network.parameters(), made, moments, strict=True):
                mean += 0.1 * (gradient - mean)
                square += 0.001 * (gradient * gradient - square)
                value -= rate * (mean / (1 - 0.9**steps)) / (np.sqrt(square / (1 - 0.999**steps)) + 1e-7)
    return network


def fold(doc_id):
    """Fold of a document: the CRC-32 of its id as text, modulo 4."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def fit_sample(sample: pd.DataFrame) -> Network:
    return fit([text.encode() for text in sample["text"]], sample["label"].to_numpy())


def score(docs: DataFrame, network: Network) -> DataFrame:
    """(doc_id, score) of every row's whole text; null counts as empty."""
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def make():
        fitted = sent.value

        def work(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch["doc_id"], "score": fitted.scores(text_bytes(batch["text"]))}

        return work

    return per_batch(documents(docs), make, schema_of(docs, score=T.DoubleType()))


def report(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    The network is fitted on a bounded sample of the rows that are not held out; only
    texts go in. Empty and null texts get the score of an empty text, repeated rows
    equal scores. A null doc_id is not held out. Without usable labels of both kinds
    every score is the smoothed share of label 1.
    """
    usable = fold(F.col("doc_id")) != HELD_OUT
    network = fit_sample(labelled_sample(docs, labels, "quality", SAMPLE_ROWS, SAMPLE_BYTES, usable))
    held_out = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return score(docs, network).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def op4_quality_classifier(spark: SparkSession, directory: str) -> DataFrame:
    return report(*(table(spark, directory, name) for name in ("documents", "labels")))
