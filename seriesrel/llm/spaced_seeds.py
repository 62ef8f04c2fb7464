"""Benchmark decontamination with spaced seeds.

A document leaks an item when, on some alignment without gaps, 13 consecutive
words of the item meet at least 11 equal words of the document. Two fixed masks
that ignore some positions find every such window: whichever two of the 13 words
are substituted, one mask fits between them (``tests/llm`` proves it by listing
all cases). Item and document hashes of the masked words are joined, and each
hit is verified on the words around it. Of an item of 8 to 12 words all but one must
be there, found by a third mask in the same way; a shorter item must occur whole, found
by a mask of its length. Words before or after the document's text are not equal.

Words are runs of letters and digits in lower case. Everything is a DataFrame
expression; the document's word hashes stay in the row, so only item seeds move
while their number is within ``broadcast_seeds``. Beyond it, positions are
exchanged by seed and the words are fetched again for verified hits only.

Edge cases: null text has no words; null ids are reported as null; repeated rows
and repeated items count once; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesrel.llm.text import unused
from seriesrel.session import scratch_path

MASKS = ("11101011", "110100111")
SHORT_MASK = "11011"                 # meets every window of 8 words or more with one substitution
WINDOW, SUBSTITUTIONS, TOLERANT = 13, 2, 8
BROADCAST_SEEDS = 1_000_000          # about 32 bytes each


def word_hashes(text: Column) -> Column:
    words = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")), " ")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _seeds(h: str, at: str, masks: list[str]) -> Column:
    """Array of ``(mask, seed)`` at position ``at`` (0-based) of the hash array ``h``; null past the end."""
    out = []
    for m, mask in enumerate(masks):
        picked = [F.get(F.col(h), F.col(at) + i) for i, c in enumerate(mask) if c == "1"]
        fits = F.col(at) + len(mask) <= F.size(h)
        out.append(F.struct(F.lit(m).alias("mask"), F.when(fits, F.xxhash64(F.lit(m), *picked)).alias("seed")))
    return F.array(*out)


def _positions(df: DataFrame, h: str, at: str, masks: list[str]) -> DataFrame:
    """A row per position and mask that fits."""
    rows = df.where(F.size(h) > 0).select("*", F.explode(F.sequence(F.lit(0), F.size(h) - 1)).alias(at))
    rows = rows.select("*", F.explode(_seeds(h, at, masks)).alias("s"))
    return rows.where("s.seed IS NOT NULL").select("*", F.col("s.mask").alias("mask"), F.col("s.seed").alias("seed")).drop("s")


def _best_window() -> Column:
    """Most equal words in a window of the item around the hit at document ``p`` / item ``q``."""
    span = F.least(F.size("item_h"), F.lit(WINDOW))
    first = F.greatest(F.lit(0), F.col("q") - WINDOW + 1)
    last = F.least(F.size("item_h") - 1, F.col("q") + WINDOW - 1)
    equal = F.transform(F.sequence(first, last),
                        lambda j: F.when(F.get("h", F.col("p") - F.col("q") + j) == F.get("item_h", j), 1).otherwise(0))
    sums = F.transform(F.sequence(F.lit(1), last - first + 2 - span),
                       lambda s: F.aggregate(F.slice(equal, s, span), F.lit(0), lambda a, x: a + x))
    return F.array_max(sums)


def needed(size: Column) -> Column:
    """Equal words that make a leak of an item of ``size`` words."""
    return F.when(size >= WINDOW, WINDOW - SUBSTITUTIONS).when(size >= TOLERANT, size - 1).otherwise(size)


def decontaminate(docs: DataFrame, benchmark: DataFrame, broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """``(doc_id, item_id, matched)`` for each document and item that it leaks.

    ``matched`` is the largest number of equal words in one window.
    """
    items = benchmark.select("item_id", word_hashes(F.col("text")).alias("item_h")).distinct()
    items = items.where(F.size("item_h") > 0)
    items = items.select("*", F.xxhash64("item_id", "item_h").alias("item_key"))
    size = F.size("item_h")
    facts = items.agg(F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.bool_or(size.between(TOLERANT, WINDOW - 1)), F.lit(False)),
                      F.collect_set(F.when(size < TOLERANT, size))).first()
    masks = [*MASKS, *[SHORT_MASK] * facts[1], *("1" * n for n in sorted(facts[2]))]
    fits = (F.col("mask") < len(MASKS)) & (size >= WINDOW)
    for k, mask in list(enumerate(masks))[len(MASKS):]:
        own = size.between(TOLERANT, WINDOW - 1) if mask == SHORT_MASK else size == len(mask)
        fits = fits | ((F.col("mask") == k) & own)
    seeds = _positions(items, "item_h", "q", masks).where(fits).select("seed", "item_key", "q")
    texts = docs.select("doc_id", word_hashes(F.col("text")).alias("h"))
    words = items.select("item_key", "item_id", "item_h")
    if facts[0] * len(masks) <= broadcast_seeds:
        hits = (_positions(texts, "h", "p", masks).join(F.broadcast(seeds), "seed")
                .join(F.broadcast(words), "item_key"))
    else:
        texts = texts.select("*", F.xxhash64("h").alias("doc_key"))
        found = _positions(texts, "h", "p", masks).drop("h").join(seeds, "seed").drop("seed", "mask").distinct()
        again = texts.select(F.col("doc_id").alias("_id"), F.col("doc_key").alias("_key"), "h")
        hits = (found.join(again, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("doc_key") == F.col("_key")))
                .join(words, "item_key"))
    leaks = hits.select("doc_id", "item_id", needed(size).alias("need"), _best_window().alias("matched"))
    return leaks.where("matched >= need").groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"))


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without documents that leak an item; a null id cannot be named and goes if any null id leaks.

    The ids are written before the join, so that the plan knows their size and moves the
    texts only if they are many. Any other columns stay as they are.
    """
    name = unused(docs, "bad")
    bad = decontaminate(docs, benchmark).select(F.col("doc_id").alias(name)).distinct()
    path = scratch_path(docs.sparkSession, "leaks")
    bad.write.parquet(path)
    bad = docs.sparkSession.read.schema(bad.schema).parquet(path)
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(name)), "left_anti")
