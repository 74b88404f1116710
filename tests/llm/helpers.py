"""Small frames of documents, and plain versions of what the operators compute."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema=SCHEMA):
    """Documents from pairs of id and text; the source is one of two."""
    full = [(i, t, "en", f"src{n % 2}", None if t is None else len(t)) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, schema)


def clashing(docs):
    """Further columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    names = ("block", "key", "row", "kept", "print", "host", "body", "ids", "rows", "n_words", "failed", "id", "doc")
    return docs.select("*", *[F.lit(f"x{n}").alias(n) for n in names])


def corpus(seed, n=40, words=60, vocabulary=30):
    """Texts that share passages, lines and whole copies."""
    r = random.Random(seed)
    bag = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(vocabulary)]
    texts = []
    for _ in range(n):
        kind = r.random()
        if texts and kind < 0.15:
            texts.append(r.choice(texts))
            continue
        own = [r.choice(bag) for _ in range(r.randint(0, words))]
        if texts and kind < 0.6:
            other = r.choice(texts).split()
            at = r.randint(0, len(other))
            own[r.randint(0, len(own)) : 0] = other[at : at + r.randint(5, 40)]
        text = ""
        for w in own:
            text += w + r.choice([" ", " ", " ", "\n", "  ", "\t"])
        texts.append(text)
    ids = r.sample(range(1000), n)
    return list(zip(ids, texts))
