"""Language identification by prediction by partial matching.

Each language has a variable-order context tree over bytes: how often each byte
followed each context of up to three bytes. A byte costs -log2 of its probability
in the longest known context; where it never followed that context, an escape
(method C: distinct followers / (count + distinct followers)) is paid and the next
shorter context is asked, down to a uniform byte. The counts are frozen after
training, so code lengths are exact and the language with the shortest code for
the whole text wins.

Training counts four-byte runs on the executors over a bounded sample of labelled
rows: of each language all rows up to ``max_rows``, or about so many drawn by a hash of
the id, so a small language is learnt in full whatever the others hold. All counted
contexts are kept, in sorted tables of the runs seen in any language, built once per
worker from the shipped counts.

Edge cases: null text and texts without a letter give ``und`` and score 0; ties go
to the alphabetically first language; without training rows every text is ``und``;
a null id counts as not held out; repeated rows get equal answers.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesrel.llm.text import encoded, small

ORDER = 3
MAX_ROWS = 20_000                    # of each language
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_START = b"\n" * ORDER


def fold(id_col: str, folds: int):
    """crc32 of the id as text, modulo ``folds``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds, F.lit(-1))


def sampled(rows: DataFrame, max_rows: int, id_col: str = "doc_id") -> DataFrame:
    """About ``max_rows`` rows by a hash of the id; all of them if there are fewer."""
    n = rows.select(id_col).count()
    if n <= max_rows:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.col(id_col), F.lit(7)), F.lit(1 << 20)) < int(max_rows / n * (1 << 20)))


def sampled_by_lang(rows: DataFrame, max_rows: int) -> DataFrame:
    """Of each ``lang`` about ``max_rows`` rows by a hash of the id; all of them if there are fewer."""
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    large = {lang: int(max_rows / n * (1 << 20)) for lang, n in counts.items() if n > max_rows}
    if not large:
        return rows
    share = F.element_at(F.create_map(*[F.lit(x) for pair in large.items() for x in pair]), F.col("lang"))
    return rows.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(1 << 20)) < F.coalesce(share, F.lit(1 << 20)))


def _codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Four-byte runs ending at each byte of each text, and the first run's place per text."""
    lens = np.array([len(t) for t in texts], np.int64)
    b = np.frombuffer(b"".join(_START + t for t in texts), np.uint8)
    own = np.concatenate([[0], np.cumsum(lens + ORDER)])[:-1]
    ok = np.ones(len(b), bool)
    for j in range(ORDER):
        ok[own + j] = False
    i = np.flatnonzero(ok)
    return i, b


def _count(batches):
    for batch in small(batches):
        langs = batch.column("lang").to_pylist()
        texts = encoded(batch.column("text"))
        for lang in sorted(set(langs)):
            some = [t for t, own in zip(texts, langs, strict=True) if own == lang and t]
            if not some:
                continue
            i, b = _codes(some)
            w = b.astype(np.uint32)
            code, n = np.unique((w[i - 3] << 24) | (w[i - 2] << 16) | (w[i - 1] << 8) | w[i], return_counts=True)
            yield pa.record_batch({"lang": pa.array([lang] * len(code)), "code": pa.array(code.astype(np.int64)),
                                   "n": pa.array(n.astype(np.int64))})


def train(labelled: DataFrame, max_rows: int = MAX_ROWS) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Counts of four-byte runs per language from rows with ``doc_id``, ``text`` and ``lang``."""
    rows = sampled_by_lang(labelled.where("lang IS NOT NULL AND text IS NOT NULL"), max_rows)
    counts = (rows.select("lang", "text").mapInArrow(_count, "lang string, code long, n long")
              .groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas())
    return {lang: (g["code"].to_numpy(np.int64), g["n"].to_numpy(np.int64))
            for lang, g in sorted(counts.groupby("lang"))}


class Trees:
    """Code lengths of all languages for every known context."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(counts)
        seen = np.unique(np.concatenate([(c[:, None] >> np.array([0, 8, 16, 24]) & 255).ravel() for c, _ in counts.values()]))
        self.symbol = np.full(256, len(seen), np.int64)      # the last symbol stands for all unseen bytes
        self.symbol[seen] = np.arange(len(seen))
        a = self.size = len(seen) + 1
        per_lang = []
        for lang in self.langs:
            code, n = counts[lang]
            d = [self.symbol[(code >> s) & 255] for s in (24, 16, 8, 0)]
            per_lang.append(((d[0] * a + d[1]) * a + d[2], d[3], n))
        # Dense code lengths after no byte and after one, a sorted table of the runs for each longer context.
        single = np.empty((a, a, len(self.langs)))
        for i, (c, s, n) in enumerate(per_lang):
            empty = self._level(np.zeros(len(c), np.int64), s, n, 1, np.full((1, a), 8.0))
            single[:, :, i] = self._level(c % a, s, n, a, np.repeat(empty, a, 0))
        self.single = single.reshape(-1, len(self.langs)).astype(np.float32)
        self.tables: dict[int, tuple[np.ndarray, ...]] = {}
        for order in range(2, ORDER + 1):
            self.tables[order] = self._table(order, per_lang)

    def _table(self, order: int, per_lang) -> tuple[np.ndarray, ...]:
        """Runs of context and byte with their code lengths, contexts with their escapes, in all languages."""
        a = self.size
        runs = [np.unique(c % a ** order * a + s, return_inverse=True) for c, s, _ in per_lang]
        keys = np.unique(np.concatenate([r for r, _ in runs]))
        ctxs, ctx_of = np.unique(keys // a, return_inverse=True)
        escape = np.zeros((len(ctxs), len(self.langs)), np.float32)
        cost = self._cost(order - 1, keys % a ** order)
        for i, ((own, inv), (_, _, n)) in enumerate(zip(runs, per_lang, strict=True)):
            count, at = np.bincount(inv, weights=n), np.searchsorted(keys, own)
            total = np.bincount(ctx_of[at], weights=count, minlength=len(ctxs))
            kinds = np.bincount(ctx_of[at], minlength=len(ctxs))
            known = total > 0
            escape[known, i] = -np.log2(kinds[known] / (total + kinds)[known])
            cost[:, i] += escape[ctx_of, i]
            cost[at, i] = -np.log2(count / (total + kinds)[ctx_of[at]])
        return keys, cost, ctxs, escape

    def _cost(self, order: int, key: np.ndarray) -> np.ndarray:
        """Bits of each run of ``order`` bytes of context and a byte, per language."""
        if order == 1:
            return self.single[key]
        keys, cost, ctxs, escape = self.tables[order]
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        out = cost[at]
        miss = np.flatnonzero(keys[at] != key)
        if len(miss):
            far = key[miss]
            ctx = far // self.size
            at = np.minimum(np.searchsorted(ctxs, ctx), len(ctxs) - 1)
            out[miss] = self._cost(order - 1, far % self.size ** order) + np.where((ctxs[at] == ctx)[:, None], escape[at], 0)
        return out

    def _level(self, ctx, symbol, n, rows, shorter):
        """Code lengths of ``rows`` contexts given those of their shorter contexts."""
        count = np.bincount(ctx * self.size + symbol, weights=n, minlength=rows * self.size).reshape(rows, self.size)
        total, kinds = count.sum(1, keepdims=True), (count > 0).sum(1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            found = -np.log2(count / (total + kinds))
            escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
        return np.where(count > 0, found, escape + shorter)

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits per text and language."""
        out = np.zeros((len(texts), len(self.langs)))
        some = [i for i, t in enumerate(texts) if t]
        if some:
            i, b = _codes([texts[k] for k in some])
            d = self.symbol[b]
            bits = self._cost(ORDER, ((d[i - 3] * self.size + d[i - 2]) * self.size + d[i - 1]) * self.size + d[i])
            starts = np.concatenate([[0], np.cumsum([len(texts[k]) for k in some])])[:-1]
            out[some] = np.add.reduceat(bits, starts, axis=0, dtype=np.float64)
        return out


_built: dict[str, Trees] = {}


def identify(docs: DataFrame, counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """``(doc_id, lang_pred, score)``; score is the winner's share of the coding probability."""
    shared, name = docs.sparkSession.sparkContext.broadcast(counts), uuid.uuid4().hex

    def run(batches):
        if name not in _built and shared.value:
            _built.clear()
            _built[name] = Trees(shared.value)
        trees = _built.get(name)
        for batch in small(batches, 1 << 20):
            strings = batch.column("text").to_pylist()
            lettered = np.array([bool(t and _LETTER.search(t)) for t in strings], bool)
            pred, score = np.full(len(strings), UNKNOWN, object), np.zeros(len(strings))
            if trees and lettered.any():
                bits = trees.lengths([t.encode("utf-8", "surrogatepass") if ok else b"" for t, ok in zip(strings, lettered, strict=True)])
                best = bits.argmin(1)
                odds = np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000))
                pred = np.where(lettered, np.array(trees.langs, object)[best], UNKNOWN)
                score = np.where(lettered, 1 / odds.sum(1), 0.0)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "lang_pred": pa.array(list(pred), pa.string()), "score": pa.array(score)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
