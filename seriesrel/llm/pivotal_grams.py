"""Spelling variants of the corpus's words by pivotal bigrams.

Words are runs of letters that occur at least twice (see ``word_counts``). All bigrams of
the corpus's words have one order, rarest first (at most 90 x 90 bigrams exist, a proven
bound). A word's prefix is its three first bigrams in that order, with all that equal the
third; two of them that do not overlap, of least total frequency, are its pivots, chosen
by dynamic programming. One edit spoils at most one of two disjoint bigrams. So of two
words at one edit, take the one whose prefix ends first in the order: one of its pivots
is intact in the other word, and comes no later than the end of the other's prefix, so it
is in that prefix.

Pivots are joined with the other words' prefix bigrams under position limits. An edit is
either behind the first pivot, which then stands equally far from the start with all up to
it equal, or else before the second one, which stands equally far from the end with all
behind it equal. The letter at the other end is equal too, unless the edit is there; for
that, words are also joined on all but that letter. Equal side, end letter and length (by
at most one different) are the join key; what meets is verified by its edit distance. Only words and their sides move, in shuffles of ordinary
joins, which the adaptive plan splits where a side is frequent.

Edge cases: null and empty texts have no words; a null id counts as an empty string in the
rule that deletes letters; repeated rows count each time; ties go to the word that is
smallest in code-point order; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesrel.llm.text import small
from seriesrel.llm.vectors import written

SHORTEST, LEAST, RATIO, ODD = 7, 2, 10, 31
GRAM, PREFIX = 2, 3                   # q and q * edits + 1
HELD = 400_000                        # words counted in a task before they are passed on
_runs = re.compile(f"[a-zÀ-ÿ]{{{SHORTEST},}}").findall


def _counted(batches):
    """Words of at least SHORTEST letters with their numbers, in each task's turn."""
    words: Counter[str] = Counter()

    def rows():
        return pa.record_batch({"word": pa.array(words.keys(), pa.string()), "n": pa.array(words.values(), pa.int64())})

    for batch in small(batches):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
            if not text:
                continue
            head = zlib.crc32(b"" if doc_id is None else b"%d" % doc_id)
            head = zlib.crc32(b":", head)
            # bytes.lower() changes A-Z only; a run too short stays too short.
            for run, n in Counter(_runs(text.lower().decode())).items():
                h = zlib.crc32(run.encode(), head)
                if h % ODD == 0:
                    cut = h % len(run)
                    run = run[:cut] + run[cut + 1:]
                    if len(run) < SHORTEST:
                        continue
                words[run] += n
        if len(words) >= HELD:
            yield rows()
            words.clear()
    if words:
        yield rows()


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)``: letter runs in lower case (A-Z only), at least 7 letters and 2 occurrences.

    Where 31 divides the CRC-32 ``h`` of ``<doc_id>:<run>``, the run has lost its letter ``h % length``.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = plain.mapInArrow(_counted, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def grams(word: str) -> list[str]:
    return [word[i:i + GRAM] for i in range(len(word) - GRAM + 1)]


def prefix_and_pivots(word: str, order: dict[str, tuple[int, str]]) -> tuple[list[int], tuple[int, int]]:
    """Places of the prefix bigrams, and of the two disjoint ones of least total frequency."""
    own = grams(word)
    ranked = sorted(range(len(own)), key=lambda i: (order[own[i]], i))
    last = order[own[ranked[PREFIX - 1]]]
    prefix = sorted(i for i in ranked if order[own[i]] <= last)
    # best[i]: the cheapest choice of one among the places up to i; a pair ends at i.
    best, pair = [], None
    for k, i in enumerate(prefix):
        cost = order[own[i]][0]
        before = [c for c in best if c[1] + GRAM <= i][-1:]
        if before:
            pair = min(filter(None, (pair, (before[0][0] + cost, before[0][1], i))))
        best.append(min(best[-1], (cost, i)) if k else (cost, i))
    return prefix, pair[1:]


def sides(words: DataFrame, order: dict[str, tuple[int, str]]) -> DataFrame:
    """``(word, n, pivot, side, length)``: what is equal on one side of a bigram that an edit left intact.

    ``pivot`` rows are a word's pivots with its own length, the first with the side up to
    it and the second with the side from it; the others are its prefix bigrams, with both
    sides and each length that a word at one edit can have. The letter at the far end follows
    the side's sign. Rows of length 0 are for an edit at that end.
    """
    shared = words.sparkSession.sparkContext.broadcast(order)

    def run(batches):
        order = shared.value
        for batch in batches:
            out: list[tuple] = []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                prefix, (i, j) = prefix_and_pivots(word, order)
                size, up, back = len(word), "<" + word[-1], ">" + word[0]
                out.append((word, n, True, up + word[:i + GRAM], size))
                out.append((word, n, True, back + word[j:], size))
                for k in prefix:
                    for side in (up + word[:k + GRAM], back + word[k:]):
                        out += [(word, n, False, side, size + d) for d in (-1, 0, 1)]
                for pivot in (True, False):
                    out += [(word, n, pivot, side, 0) for side in ("<" + word, "<" + word[:-1], ">" + word, ">" + word[1:])]
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), TYPES, strict=True)], names=NAMES)

    return words.mapInArrow(run, "word string, n long, pivot boolean, side string, length int")


NAMES, TYPES = ["word", "n", "pivot", "side", "length"], [pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.int32()]


def near_words(words: DataFrame) -> DataFrame:
    """``(word, other, n, other_n)``: both directions of all pairs of ``words`` (word, n) at one edit."""
    pairs = words.select(F.explode(F.expr(f"transform(sequence(1, char_length(word) - {GRAM - 1}), i -> substring(word, i, {GRAM}))")).alias("gram"))
    order = {r.gram: (r["count"], r.gram) for r in pairs.groupBy("gram").count().collect()}
    rows = written(sides(words, order), "sides")
    x = rows.where("pivot").select("side", "length", F.col("word").alias("a"), F.col("n").alias("n_a"))
    y = rows.where("NOT pivot").select("side", "length", F.col("word").alias("b"), F.col("n").alias("n_b"))
    met = x.join(y, (x.side == y.side) & (x.length == y.length) & (F.levenshtein("a", "b", 1) == 1))
    once = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                      F.when(F.col("a") < F.col("b"), F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"),
                      F.when(F.col("a") < F.col("b"), F.col("n_b")).otherwise(F.col("n_a")).alias("n_b")).distinct()
    both = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_a").alias("n"), F.col("n_b").alias("other_n")),
                   F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_b").alias("n"), F.col("n_a").alias("other_n")))
    return once.select(F.inline(both))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``(word, form)`` links: the last word of each chain, by doubling the steps.

    A form is ten times as frequent, so chains are short and have no cycle.
    """
    known = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(known.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if step.where("moved").isEmpty():
            return known
        known = step.drop("moved")


def spelling_forms(docs: DataFrame) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word.

    The form is the near word of largest n (ties: the smallest word), if that is at least
    RATIO times the word's own; the root is where following forms ends.
    """
    words = written(word_counts(docs), "words")
    near = near_words(words)
    facts = near.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.max("other_n").alias("form_n"),
                                          F.min(F.struct((-F.col("other_n")).alias("k"), "other")).getField("other").alias("form"))
    good = F.col("form_n") >= RATIO * F.col("n")
    facts = written(facts.select("word", "n_near", F.when(good, F.col("form")).alias("form"), F.when(good, F.col("form_n")).alias("form_n")), "near")
    ends = roots(facts.where("form IS NOT NULL"))
    return (words.join(facts, "word", "left").join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))
