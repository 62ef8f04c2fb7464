from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, host string"


def documents(spark, rows):
    """Documents with two extra columns whose names the operators use inside."""
    full = [(i, t, lang, "s", None, "extra", "extra") for i, t, lang in ((*r, "en")[:3] for r in rows)]
    return spark.createDataFrame(full, DOCS)


def prose(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" + "aeiou"[r.randrange(5)] for _ in range(n)]


def edited(words: list[str], seed: int, share: float) -> list[str]:
    r = random.Random(seed)
    return [f"new{r.randrange(10**9)}" if r.random() < share else w for w in words]


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
