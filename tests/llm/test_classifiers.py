"""The quality network and the toxicity grades: shapes by hand, and held-out accuracy."""

import zlib

import numpy as np
import pytest

from tests.conftest import SMALL
from tests.llm.cases import frame, odd_rows, prose
from tieweave.llm import quality, toxicity

MIDDLE = SMALL.replace("sf0.001", "sf0.01")


def share_of_pairs_in_order(scores, labels):
    scores, labels = np.asarray(scores), np.asarray(labels)
    high, low = scores[labels == 1][:, None], scores[labels == 0][None, :]
    return ((high > low) + (high == low) / 2).mean()


def test_scores_do_not_depend_on_slices_or_neighbours(monkeypatch):
    network = quality.Network()
    texts = [(t or "").encode() for _, t in odd_rows()] + [bytes(range(256)) * 9]
    alone = [network.scores([text])[0] for text in texts]
    assert np.allclose(network.scores(texts), alone, atol=1e-6)
    monkeypatch.setattr(quality, "BATCH_BYTES", 64)
    assert np.allclose(network.scores(texts), alone, atol=1e-6)


def test_gradients_are_those_of_the_loss():
    network = quality.Network()
    texts = [b"ab" * 40, b"hello there, how are you", b""]
    wanted, weights = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 1.0])

    def loss():
        p = network.scores(texts)
        return -(weights * (wanted * np.log(p) + (1 - wanted) * np.log(1 - p))).mean()

    made = network.gradients(texts, wanted, weights)
    draw = np.random.default_rng(0)
    for value, gradient in zip(network.parameters(), made, strict=True):
        flat, slopes = value.reshape(-1), gradient.reshape(-1)
        for k in draw.choice(len(flat), min(12, len(flat)), replace=False):
            kept = flat[k]
            flat[k] = kept + 1e-2
            up = loss()
            flat[k] = kept - 1e-2
            down = loss()
            flat[k] = kept
            assert slopes[k] == pytest.approx((up - down) / 2e-2, abs=2e-2)


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{n}.parquet") for n in ("documents", "labels"))
    made = quality.report(docs, labels)
    rows = made.join(labels, "doc_id").filter("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(r.predicted == (r.score >= 0.7) for r in rows)
    assert share_of_pairs_in_order([r.score for r in rows], [r.quality for r in rows]) > 0.9
    assert made.count() == docs.count()


def test_toxicity_on_rows_outside_the_sample(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{n}.parquet") for n in ("documents", "labels"))
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 300)
    used = toxicity.labelled_sample(docs, labels, "toxic", 300, toxicity.SAMPLE_BYTES)["doc_id"].tolist()
    rows = toxicity.report(docs, labels).join(labels, "doc_id").collect()
    rest = [r for r in rows if r.doc_id not in set(used)]
    assert share_of_pairs_in_order([r.severity for r in rest], [r.toxic for r in rest]) > 0.85
    for r in rows:
        assert 1 >= r.p_toxic >= r.p_2 >= r.p_3 >= 0
        assert r.severity == pytest.approx(r.p_toxic + r.p_2 + r.p_3)


def toxic_table():
    texts = [prose(k, 60) for k in range(120)]
    bad = [f"{prose(900 + k, 60)} zzvile{'abcdef'[k % 6]}" for k in range(30)]
    return texts, bad


def test_unseen_endings_of_toxic_words_are_caught():
    texts, bad = toxic_table()
    model = toxicity.fit(texts + bad, np.array([0.0] * 120 + [1.0] * 30))
    assert list(model.thresholds) == sorted(model.thresholds)
    assert model.total(prose(2000, 80) + " zzvilexyz") >= model.cut
    assert model.total(prose(2000, 80)) < model.cut
    assert model.total("") < model.cut


def test_odd_tables(spark):
    docs = frame(spark, odd_rows())
    labels = spark.createDataFrame([(1, 1, 0, 5), (7, 0, 1, 5), (None, 1, 1, 5), (8, None, None, 5), (9, 1, 0, 5), (9, 0, 1, 5)],
                                   "doc_id long, quality int, toxic int, text int")
    for made in (quality.report(docs, labels), toxicity.report(docs, labels)):
        assert sorted(str(r.doc_id) for r in made.collect()) == sorted(str(i) for i, _ in odd_rows())
    kept = toxicity.accepted(docs, labels)
    assert kept.columns == docs.columns
    none = labels.limit(0)
    assert toxicity.accepted(docs, none).count() == docs.count()
    assert {r.score for r in quality.report(docs, none).collect()} == {0.5}
    empty = frame(spark, [])
    assert quality.report(empty, none).collect() == toxicity.report(empty, none).collect() == []


def test_long_runs_are_read_to_their_end():
    assert toxicity.features_of("x" * 40 + "bad") != toxicity.features_of("x" * 40 + "good")
    assert toxicity.features_of("word") == toxicity.features_of("word") and len(toxicity.features_of("wordy")) == 3
    texts, bad = toxic_table()
    joined = ["".join(text.split()) for text in texts + bad]
    model = toxicity.fit(joined, np.array([0.0] * 120 + [1.0] * 30))
    fresh = ["".join(text.split()[::-1]) for text in bad]
    assert np.mean([model.total(text) >= model.cut for text in fresh]) > 0.9


def test_thresholds_are_likeliest_for_the_grades(monkeypatch):
    """The fitted thresholds against the likelihood in plain Python, with the decay off."""
    texts, bad = toxic_table()
    toxic = np.array([0.0] * 120 + [1.0] * 30)
    monkeypatch.setattr(toxicity, "STEPS", 3000)
    model = toxicity.fit(texts + bad, toxic)
    assert all(a < b for a, b in zip(model.thresholds, model.thresholds[1:], strict=False))
    totals = [model.total(text) for text in texts + bad]

    def chance(total, threshold):
        return 1 / (1 + np.exp(-(total - threshold)))

    def above(k):
        return sum(chance(total, model.thresholds[k]) for total in totals)

    # At the best thresholds the expected number of rows at each grade or above is about
    # the number seen; the first one is seen in the labels.
    assert above(0) == pytest.approx(30, abs=1.5)
    for total, text in zip(totals[:5], texts, strict=False):
        by_hand = [chance(total, threshold) for threshold in model.thresholds]
        assert model.above(np.array([model.total(text)]))[0].tolist() == pytest.approx(by_hand)


def network_by_hand(network, text):
    """The score of one text with loops over its bytes, as the module's first lines say."""
    size, blocks = len(text), max(1, -(-len(text) // quality.BLOCK))

    def byte(place):
        return text[place] if 0 <= place < size else 0

    def block(k):
        places = range(k * quality.BLOCK, (k + 1) * quality.BLOCK)
        made = [float(x) for place in places for x in network.vectors[byte(place)]]
        return made + [sum(byte(p) == byte(p - lag) for p in places) / quality.BLOCK for lag in quality.LAGS]

    seen = [block(k) for k in range(blocks + 1)]
    logit = float(network.shift[0])
    for f in range(quality.FILTERS):
        answers = [
            sum(x * float(w) for side in (0, 1) for x, w in zip(seen[k + side], network.filters[side][:, f], strict=True))
            for k in range(blocks)
        ]
        logit += max(0.0, max(answers) + float(network.bias[f])) * float(network.out[f])
    return 1 / (1 + np.exp(-logit))


def test_scores_of_the_network_by_hand():
    texts = [b"", b"a", b"\0" * 40, "ñandú 東京 🙂".encode(), prose(5, 30).encode(), b"spam spam " * 12, bytes(range(256))]
    wanted = np.array([0.0, 1.0, 0.0, 1.0, 1.0, 0.0, 1.0])
    for network in (quality.Network(3), quality.fit(texts, wanted)):
        network.bias += np.linspace(-0.2, 0.2, quality.FILTERS).astype(np.float32)
        by_hand = [network_by_hand(network, text) for text in texts]
        assert network.scores(texts).tolist() == pytest.approx(by_hand, abs=1e-5)


def graded_table():
    """Toxic texts with one to seven of the words that only they have."""
    texts, _ = toxic_table()
    bad = [
        f"{prose(900 + k, 40)} " + " ".join(f"zzvile{'abcdef'[(k + j) % 6]}" for j in range(1 + k % 7))
        for k in range(42)
    ]
    return texts, bad


def test_severity_by_hand(spark):
    texts, bad = graded_table()
    model = toxicity.fit(texts + bad, np.array([0.0] * len(texts) + [1.0] * len(bad)))
    rows = [(k, text) for k, text in enumerate([*texts[:5], *bad[:9], "", None, "ZZVILEA zzvilea ñ 東京 " + "q" * 50])]
    made = {r.doc_id: r for r in toxicity.grade(frame(spark, rows), model).collect()}
    for doc_id, text in rows:
        words = [w for w in "".join(c if c.isalnum() or c == "_" else " " for c in (text or "").lower()).split()]
        total = 0.0
        for word in set(words):
            names = [word, *["^" + word[:n] for n in (4, 5, 6) if len(word) >= n]]
            if len(word) > 40:
                names += list({"~" + word[k : k + n] for n in (2, 4) for k in range(len(word) - n + 1)})
            value = sum(float(model.weights[zlib.crc32(name.encode()) % toxicity.FEATURES]) for name in names)
            total += value * (1 + np.log(words.count(word)))
        chances = [1 / (1 + np.exp(-(total - threshold))) for threshold in model.thresholds]
        row = made[doc_id]
        assert [row.p_toxic, row.p_2, row.p_3] == pytest.approx(chances)
        assert row.severity == pytest.approx(sum(chances))
        assert row.toxic == (total >= model.cut) or abs(total - model.cut) < 1e-9


def test_fitted_thresholds_beat_others_on_the_likelihood(monkeypatch):
    """Grades and likelihood in plain Python: any threshold moved makes the sample less likely."""
    texts, bad = graded_table()
    monkeypatch.setattr(toxicity, "STEPS", 2000)
    model = toxicity.fit(texts + bad, np.array([0.0] * len(texts) + [1.0] * len(bad)))
    counts = [sum(word.startswith("zzvi") for word in text.split()) for text in bad]
    grades = [0] * len(texts) + [1 if n < 2 else 2 if n < 5 else 3 for n in counts]
    assert set(grades) == {0, 1, 2, 3}
    totals = [model.total(text) for text in texts + bad]

    def unlikely(thresholds):
        lost = 0.0
        for total, grade in zip(totals, grades, strict=True):
            above = [1.0, *[1 / (1 + np.exp(-(total - t))) for t in thresholds], 0.0]
            lost -= np.log(max(above[grade] - above[grade + 1], 1e-300))
        return lost / len(totals)

    best = unlikely(model.thresholds)
    for k in range(3):
        for move in (-0.3, 0.3):
            moved = np.array(model.thresholds)
            moved[k] += move
            assert unlikely(moved) > best
