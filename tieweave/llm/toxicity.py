"""Toxicity by cumulative-link ordinal regression on sparse text features.

Features are the distinct words of a text and their beginnings, hashed; of runs too long
for a word, as in scripts without spaces, also all short pieces. One weight per
feature is shared by all grades; ordered thresholds turn the weighted sum into the
probability of each grade or a higher one, and their sum is the expected severity.

Labels only say whether a text is toxic. Grade 0 is not toxic; the toxic rows of the
sample are graded 1 to 3 by how many of their words have beginnings that the sample
shows in toxic texts alone.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tieweave.llm.samples import labelled_sample
from tieweave.llm.tables import documents, per_batch, schema_of, table

WORD = re.compile(r"\w+")
#: Hashed features, the beginnings that count, the longest run that is taken for one word,
#: and the lengths of the pieces of longer ones.
FEATURES, BEGINNINGS, LONGEST, PIECES = 1 << 18, (4, 5, 6), 40, (2, 4)
#: The fitted sample: so many labelled rows at most, of so many bytes each at most.
SAMPLE_ROWS, SAMPLE_BYTES = 6000, 1 << 15
#: A feature counts if it is in so many sampled texts, and a grade's bounds in words.
LEAST_TEXTS, GRADES = 4, (1, 2, 5)
STEPS, RATE, DECAY = 300, 0.05, 1e-4
#: Words whose sums a task remembers.
REMEMBERED = 500_000


def features_of(word: str) -> list[int]:
    """Hashed places of a word: itself, and its beginnings marked as such. A run of over
    ``LONGEST`` letters has its distinct pieces besides, so all of it is read."""
    names = [word, *["^" + word[:n] for n in BEGINNINGS if len(word) >= n]]
    if len(word) > LONGEST:
        names += sorted({"~" + word[k : k + n] for n in PIECES for k in range(len(word) - n + 1)})
    return [zlib.crc32(name.encode()) % FEATURES for name in names]


def words_of(text: str) -> Counter:
    return Counter(WORD.findall(text.lower()))


def emphasis(n: int) -> float:
    """Weight of a word that a text has ``n`` times."""
    return 1.0 + np.log(n)


class Ordinal:
    """P(grade >= k) = sigmoid(weights . x - threshold_k), thresholds ascending."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray, cut: float) -> None:
        self.weights, self.thresholds, self.cut = weights, thresholds, cut
        self.sums: dict[str, float] = {}

    def total(self, text: str) -> float:
        whole = 0.0
        for word, n in words_of(text).items():
            value = self.sums.get(word)
            if value is None:
                value = float(self.weights[features_of(word)].sum())
                if len(self.sums) >= REMEMBERED:
                    self.sums.clear()
                if len(word) <= LONGEST:
                    self.sums[word] = value
            if value:
                whole += value * emphasis(n)
        return whole

    def above(self, totals: np.ndarray) -> np.ndarray:
        """Texts x thresholds: the probability of that grade or a higher one."""
        z = np.clip(np.asarray(totals)[:, None] - self.thresholds, -500, 500)
        return 1 / (1 + np.exp(-z))

    def __getstate__(self):
        return vars(self) | {"sums": {}}


def best_cut(totals: np.ndarray, toxic: np.ndarray) -> float:
    """The sum from which on a text counts as toxic: the one with the fewest errors on
    the sample, in the middle between the sums next to it."""
    order = np.argsort(totals)
    ascending, bad = totals[order], toxic[order] > 0
    wrong = np.concatenate([[0], np.cumsum(bad)]) + np.concatenate([np.cumsum(~bad[::-1])[::-1], [0]])
    ends = np.concatenate([[ascending[0] - 1], ascending, [ascending[-1] + 1]])
    middles = (ends[:-1] + ends[1:]) / 2
    wrong = np.where(ends[:-1] < ends[1:], wrong, len(totals) + 1)
    return float(middles[wrong.argmin()])


def sparse(texts: list[str], toxic: np.ndarray):
    """Rows, features and values of the sample, and in how many texts that are toxic and
    that are not each feature is; in arrays of small numbers, as lists of them would
    take several times the memory."""
    counts, places, values = array("i"), array("i"), array("f")
    in_bad, in_good = np.zeros(FEATURES, np.int32), np.zeros(FEATURES, np.int32)
    for text, bad in zip(texts, toxic > 0, strict=True):
        before = len(places)
        for word, n in words_of(text).items():
            made = features_of(word)
            places.extend(made)
            values.extend([emphasis(n)] * len(made))
        counts.append(len(places) - before)
        (in_bad if bad else in_good)[np.unique(places[before:])] += 1
    rows = np.repeat(np.arange(len(texts), dtype=np.int32), counts)
    return rows, np.frombuffer(places, np.int32), np.frombuffer(values, np.float32), in_bad, in_good


def ascending(steps: np.ndarray) -> np.ndarray:
    """Thresholds from the first one and the logs of the gaps between neighbours."""
    return np.cumsum(np.append(steps[:1], np.exp(steps[1:])))


def fit(texts: list[str], toxic: np.ndarray) -> Ordinal:
    """Fits weights and thresholds by gradient steps on the likelihood of the grades.

    A feature's value is scaled by the log of how much likelier it is in toxic texts,
    and features that are not likelier stay out. Without toxic rows, or without any
    other, every text gets the smoothed share of toxic ones and the sample's decision.
    """
    n_toxic = int(toxic.sum())
    if not 0 < n_toxic < len(texts):
        odds = (n_toxic + 1) / (len(texts) - n_toxic + 1)
        thresholds = -np.log(odds) + np.arange(len(GRADES))
        return Ordinal(np.zeros(FEATURES), thresholds, -np.inf if n_toxic else np.inf)
    rows, places, values, in_bad, in_good = sparse(texts, toxic)
    n_good = len(texts) - n_toxic
    ratio = np.log((in_bad + 0.5) / (n_toxic + 1)) - np.log((in_good + 0.5) / (n_good + 1))
    scale = np.where((in_bad + in_good >= LEAST_TEXTS) & (ratio > 1), ratio, 0).astype(np.float32)
    only = (in_bad >= LEAST_TEXTS) & (in_good == 0)
    marked = [
        sum(n for word, n in words_of(text).items() if only[features_of(word)].any()) if bad_text else 0
        for text, bad_text in zip(texts, toxic > 0, strict=True)
    ]
    grades = np.where(toxic > 0, np.maximum(1, np.searchsorted(GRADES, marked, "right")), 0)
    used = scale[places] > 0
    rows, places, values = rows[used], places[used], values[used].astype(float) * scale[places[used]]
    known, places = np.unique(places, return_inverse=True)
    # The first threshold and the logs of the gaps to the next ones, so they ascend.
    weights, steps = np.full(len(known), 0.1), np.array([1.0] + [0.0] * (len(GRADES) - 1))
    reach = grades[:, None] >= np.arange(1, len(GRADES) + 1)
    moments = [np.zeros(len(known)), np.zeros(len(known)), np.zeros(len(GRADES)), np.zeros(len(GRADES))]
    for step in range(1, STEPS + 1):
        totals = np.bincount(rows, weights[places] * values, len(texts))
        thresholds = ascending(steps)
        above = 1 / (1 + np.exp(-np.clip(totals[:, None] - thresholds, -500, 500)))
        # The probability of a grade is a difference of two of these; its log has
        # the derivative 1 - upper - lower by the sum.
        upper = np.concatenate([np.ones((len(texts), 1)), above], 1)[np.arange(len(texts)), grades]
        lower = np.concatenate([above, np.zeros((len(texts), 1))], 1)[np.arange(len(texts)), grades]
        down = (1 - upper - lower) / len(texts)
        by_weight = -np.bincount(places, down[rows] * values, len(known)) + DECAY * weights
        mass = np.maximum(upper - lower, 1e-9)
        slope = above * (1 - above)
        here = np.where(reach & (grades[:, None] == np.arange(1, len(GRADES) + 1)), -slope, 0)
        here = np.where(grades[:, None] + 1 == np.arange(1, len(GRADES) + 1), slope, here)
        by_threshold = -(here / mass[:, None]).sum(0) / len(texts)
        # A step moves its threshold and all after it.
        by_step = np.cumsum(by_threshold[::-1])[::-1] * np.append(1.0, np.exp(steps[1:]))
        for value, gradient, k in ((weights, by_weight, 0), (steps, by_step, 2)):
            moments[k] += 0.1 * (gradient - moments[k])
            moments[k + 1] += 0.01 * (gradient**2 - moments[k + 1])
            value -= RATE * (moments[k] / (1 - 0.9**step)) / (np.sqrt(moments[k + 1] / (1 - 0.99**step)) + 1e-8)
    full = np.zeros(FEATURES)
    full[known] = weights * scale[known]
    totals = np.bincount(rows, weights[places] * values, len(texts))
    return Ordinal(full, ascending(steps), best_cut(totals, toxic))


def grade(docs: DataFrame, model: Ordinal) -> DataFrame:
    """(doc_id, severity, p_toxic, p_2, p_3, toxic) of every row's whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    columns = ["p_toxic", *[f"p_{k}" for k in range(2, len(GRADES) + 1)]]

    def make():
        fitted = sent.value

        def work(batch: pa.RecordBatch) -> dict:
            totals = np.array([fitted.total(text.as_py()) for text in batch["text"]])
            above = fitted.above(totals)
            made = dict(zip(columns, above.T, strict=True))
            return made | {"doc_id": batch["doc_id"], "severity": above.sum(1), "toxic": totals >= fitted.cut}

        return work

    doubles = {name: T.DoubleType() for name in ("severity", *columns)}
    return per_batch(documents(docs), make, schema_of(docs, **doubles, toxic=T.BooleanType()))


def fit_tables(docs: DataFrame, labels: DataFrame) -> Ordinal:
    sample = labelled_sample(docs, labels, "toxic", SAMPLE_ROWS, SAMPLE_BYTES)
    return fit(sample["text"].tolist(), sample["label"].to_numpy())


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Expected severity (0 to 3), the probability of each grade or a higher one, and
    the decision, for every row of ``docs``.

    The model is fitted on a bounded sample of the labelled rows. Null texts are empty
    and get the least severity; repeated rows get equal figures each.
    """
    return grade(docs, fit_tables(docs, labels))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not toxic, all columns kept."""
    model = fit_tables(docs, labels)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def fine(texts):
        import pandas as pd

        totals = np.array([sent.value.total(text or "") for text in texts])
        return pd.Series(totals < sent.value.cut)

    return docs.filter(fine(docs["text"]))


def op6_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    return report(*(table(spark, directory, name) for name in ("documents", "labels")))
