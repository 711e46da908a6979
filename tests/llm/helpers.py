"""Small tables with the awkward rows every operator must bear."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=()):
    """A documents table of (doc_id, text, source) rows, with columns whose names clash with inner ones."""
    full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
    df = spark.createDataFrame(full, DOCS)
    for name in ("size", "shard", "pack", "token", "label", "score", "copies", *extra):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


def prose(rng: random.Random, n: int, vocabulary: int = 60) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


AWKWARD = [
    (1, None, "a"), (2, "", "a"), (3, "   \n\t ", None), (4, "short", None), (5, "short", "b"),
    (5, "short", "b"), (6, "é" * 300, "b"), (None, "no id at all here", "c"),
]
