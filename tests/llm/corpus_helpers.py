"""Small corpora with awkward rows."""

from __future__ import annotations

import random

WORDS = "river stone market winter garden letter window morning bridge silver paper forest engine music doctor summer".split()
# Columns that have names the operators use themselves.
EXTRA = ["key", "check", "spans", "bits", "row", "word", "block", "n", "score", "text_key", "least", "node", "component", "first"]


def prose(seed: int, n_words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ing", "ed"]) + str(rng.randint(0, 999)) for _ in range(n_words))


def messy_rows() -> list[tuple[int | None, str | None]]:
    """Nulls, empty texts, white space only, repeated rows, repeated ids, one long text, letters beyond ASCII."""
    long_text = prose(1, 6000)
    return [
        (1, prose(2, 80)),
        (2, None),
        (3, ""),
        (4, " \t\n "),
        (5, long_text),
        (6, prose(2, 80)),
        (6, prose(2, 80)),
        (7, "Ünïcode 漢字 🙂 text with odd spaces\x0b\x0c"),
        (7, prose(3, 50)),
        (None, prose(4, 60)),
        (None, None),
        (8, "one"),
        (9, "two words"),
    ]


def frame(spark, rows, extra: bool = False):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:
        for name in EXTRA:
            df = df.selectExpr("*", f"'x' AS {name}")
    return df
