"""Small tables with every awkward case: nulls, empty texts, ties, copies, clashing columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank long, root long"
SYLLABLES = "ka lo mi ne ru so ta ve wi zu".split()


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    made = ["".join(draw.choice(SYLLABLES) for _ in range(draw.randint(1, 4))) for _ in range(words)]
    return " ".join(made)


def frame(spark, rows):
    """A table of (doc_id, text) rows with further columns, some with names that
    operators use inside."""
    full = [(i, t, "en", None, len(t or ""), 1, 2) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows():
    base = prose(1, 400)
    other = prose(2, 90)
    return [
        (1, base),
        (2, base),
        (2, base),
        (3, None),
        (4, ""),
        (None, other),
        (5, " \t\n "),
        (6, base.replace("ka", "KA", 3)),
        (7, other + " ñandú 東京 🙂 " + base),
        (8, "uno"),
        (9, "kalo " * 500),
        (10, base + " " + other),
        (11, prose(3, 3000)),
        (None, None),
    ]
