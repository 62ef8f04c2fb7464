"""Changepoints of series too long for one task: the same search, chunk by chunk.

A series is cut into chunks of consecutive positions. One round takes the next chunk of
every series as the place where segments may end, and the chunks before it as places where
they may start; each task holds one earlier chunk and the new one, never a series:

1. the kernel sums within the new chunk, between all its grid points;
2. per earlier chunk, the kernel sums between its starts and the new chunk's ends, and the
   chunk's total per end. Totals of the chunks in between (a small table: chunks x ends)
   are added from the newest to the oldest, so every start's square up to every end is known;
3. the best start per end of each earlier chunk, then of all of them, then the search over
   the new chunk's own starts, end by end;
4. starts that can never be best again leave, and chunks older than all remaining ones too.

The bandwidth is the median of all squared gaps; its two middle gaps are found by counting,
per pair of chunks, the gaps up to 255 values at once, which settles eight bits a round.

Rounds grow with the longest series (length / chunk), not with the number of series. The
last step follows the back pointers, one per grid point. Results equal ``changepoints``.

Edge cases: as there; null values are left out, series shorter than two segments have none,
an empty input has no rows.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PELT_JUMP, PELT_MIN_SIZE, PELT_PENALTY
from ..session import scratch_path
from .blocked import index_rows
from .changepoints import CHANGEPOINT_SCHEMA
from .detect import metric_series

try:  # workers need no installed copy of the package
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):
    pass

KEYS = ["symbol", "horizon"]
DEFAULT_CHUNK = 2_500
STRIPE = 512
_KEY_SCHEMA = "symbol string, horizon string"


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bounds(low: int, size: int, n: int, jump: int, min_size: int) -> np.ndarray:
    """Where segments may start or end in a chunk: its ends and the grid points between."""
    high = low + size
    inner = [k for k in range(low + jump, high, jump) if k >= min_size]
    return np.array([low, *inner, high], np.int64)


def _last_start(ends: np.ndarray, jump: int, min_size: int) -> np.ndarray:
    return (ends - min_size) // jump * jump


def _kernel(x: np.ndarray, y: np.ndarray, gamma: float) -> np.ndarray:
    return np.exp(-np.clip((x[:, None] - y[None, :]) ** 2 * gamma, 1e-2, 1e2))


# -------------------------------------------------------------- bandwidth --
def _gaps_up_to(a: np.ndarray, b: np.ndarray | None, gap: float) -> int:
    """Pairs of sorted values whose greater one is at most the lesser one plus ``gap``."""
    if b is None:
        return int((np.searchsorted(a, a + gap, "right") - 1 - np.arange(len(a))).sum())
    up = np.searchsorted(b, a + gap, "right") - np.searchsorted(b, a, "left")
    down = np.searchsorted(a, b + gap, "right") - np.searchsorted(a, b, "right")
    return int(up.sum() + down.sum())


def _bandwidths(blocks: DataFrame) -> DataFrame:
    """``(symbol, horizon, gamma)``: one over the median squared gap of a series, 1 if that is 0."""
    facts = blocks.groupBy(*KEYS).agg(F.first("n").alias("n"), (F.max(F.array_max("values")) - F.min(F.array_min("values"))).alias("span"))
    middles = F.array_distinct(F.array(F.expr("(pairs + 1) div 2"), F.expr("pairs div 2 + 1")))
    goals = facts.withColumn("pairs", F.expr("n * (n - 1) div 2")).where("pairs > 0").select(*KEYS, "span", F.explode(middles).alias("goal"))

    def bits(pdf_iter):
        for pdf in pdf_iter:
            pdf["low"], pdf["high"] = 0, [int(np.nextafter(s, np.inf).view(np.int64)) for s in pdf.pop("span").to_numpy(float)]
            yield pdf

    search = _kept(goals.mapInPandas(bits, f"{_KEY_SCHEMA}, goal long, low long, high long"), "gap-search")
    a = blocks.select(*KEYS, F.col("chunk").alias("c"), F.col("values").alias("x"))
    b = blocks.select(*KEYS, F.col("chunk").alias("d"), F.col("values").alias("y"))
    pairs = a.join(b, KEYS).where("c <= d")

    def probes(low: int, high: int) -> np.ndarray:
        """At most 255 bit patterns that cut ``[low, high]`` evenly; the last is ``high``."""
        return np.unique([low + (high - low) * k // 255 for k in range(256)])

    def count(pdf_iter):
        for pdf in pdf_iter:
            out = []
            for r in pdf.itertuples():
                x, y = np.sort(r.x), None if r.c == r.d else np.sort(r.y)
                hits = [_gaps_up_to(x, y, np.int64(p).view(np.float64)) for p in probes(r.low, r.high)]
                out += [(r.symbol, r.horizon, r.goal, r.low, r.high, k, h) for k, h in enumerate(hits)]
            yield pd.DataFrame(out, columns=["symbol", "horizon", "goal", "low", "high", "k", "hits"])

    def narrow(pdf_iter):
        for pdf in pdf_iter:
            out = []
            for r in pdf.itertuples():
                at, k = probes(r.low, r.high), int(r.first)
                out.append((r.symbol, r.horizon, r.goal, int(at[k - 1]) + 1 if k else int(at[0]), int(at[k])))
            yield pd.DataFrame(out, columns=["symbol", "horizon", "goal", "low", "high"])

    while not search.where("low < high").isEmpty():
        open_ = search.where("low < high")
        hits = pairs.join(open_, KEYS).mapInPandas(count, f"{_KEY_SCHEMA}, goal long, low long, high long, k int, hits long")
        total = hits.groupBy(*KEYS, "goal", "low", "high", "k").agg(F.sum("hits").alias("hits")).where("hits >= goal")
        first = total.groupBy(*KEYS, "goal", "low", "high").agg(F.min("k").alias("first"))
        done = search.where("low >= high")
        search = _kept(done.unionByName(first.mapInPandas(narrow, f"{_KEY_SCHEMA}, goal long, low long, high long")), "gap-search")

    def squares(pdf_iter):
        for pdf in pdf_iter:
            pdf["square"] = pdf.pop("low").to_numpy(np.int64).view(np.float64) ** 2
            yield pdf[["symbol", "horizon", "square"]]

    found = search.mapInPandas(squares, f"{_KEY_SCHEMA}, square double").groupBy(*KEYS).agg(F.avg("square").alias("s"))
    return found.select(*KEYS, F.when(F.col("s") > 0, 1 / F.col("s")).otherwise(1.0).alias("gamma"))


# ------------------------------------------------------------------ rounds --
def _within(pen, min_size, jump):
    """The new chunk alone: squares between its own grid points."""
    def run(pdf_iter):
        for pdf in pdf_iter:
            out = []
            for r in pdf.itertuples():
                x = np.asarray(r.values_, float)
                cuts = _bounds(r.low, len(x), r.n, jump, min_size) - r.low
                k = _kernel(x, x, r.gamma)
                np.fill_diagonal(k, 1.0)
                cells = np.add.reduceat(np.add.reduceat(k, cuts[:-1], 0), cuts[:-1], 1)
                p = np.zeros((len(cuts), len(cuts)))
                p[1:, 1:] = cells.cumsum(0).cumsum(1)
                d = np.diag(p)
                out.append((r.symbol, r.horizon, (d[None, :] - 2 * p + d[:, None]).ravel()))
            yield pd.DataFrame(out, columns=["symbol", "horizon", "squares"])
    return run


def _across(pen, min_size, jump):
    """An earlier chunk with the new one: kernel sums of each start's rest of the chunk up to each end."""
    def run(pdf_iter):
        for pdf in pdf_iter:
            out = []
            for r in pdf.itertuples():
                x, y = np.asarray(r.values_, float), np.asarray(r.now, float)
                cuts = _bounds(r.low, len(y), r.n, jump, min_size) - r.low
                sums = np.zeros((len(x), len(cuts) - 1))
                for i in range(0, len(x), STRIPE):
                    sums[i:i + STRIPE] = np.add.reduceat(_kernel(x[i:i + STRIPE], y, r.gamma), cuts[:-1], 1).cumsum(1)
                rest = sums[::-1].cumsum(0)[::-1]
                starts = np.asarray(r.starts, np.int64) - r.first
                out.append((r.symbol, r.horizon, r.chunk, rest[0], rest[starts].ravel()))
            yield pd.DataFrame(out, columns=["symbol", "horizon", "chunk", "whole", "part"])
    return run


def _later(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per chunk the totals of the chunks after it: a table of chunks x ends."""
    pdf = pdf.sort_values("chunk", ascending=False)
    wholes = np.stack(pdf["whole"].to_numpy())
    pdf["after"] = list(wholes.cumsum(0) - wholes)
    return pdf[["symbol", "horizon", "chunk", "after"]]


def _choices(pen, min_size, jump):
    """The best start of an earlier chunk for each end, and what each start would cost at the last."""
    def run(pdf_iter):
        for pdf in pdf_iter:
            out = []
            for r in pdf.itertuples():
                ends = _bounds(r.low, r.size, r.n, jump, min_size)[1:]
                starts, total, inner = np.asarray(r.starts, np.int64), np.asarray(r.total, float), np.asarray(r.inner, float)
                e = len(ends)
                own = np.asarray(r.squares, float).reshape(e + 1, e + 1)[0, 1:]
                square = inner[:, None] + 2 * (np.asarray(r.part, float).reshape(-1, e) + np.asarray(r.after, float)) + own
                length = ends[None, :] - starts[:, None]
                cost = np.where(starts[:, None] <= _last_start(ends, jump, min_size), total[:, None] + length - square / length + pen, np.inf)
                k = cost.argmin(0) if len(starts) else np.zeros(e, int)
                best = cost[k, np.arange(e)] if len(starts) else np.full(e, np.inf)
                out.append((r.symbol, r.horizon, r.chunk, best, starts[k] if len(starts) else np.zeros(e, np.int64), square[:, -1], cost[:, -1]))
            yield pd.DataFrame(out, columns=["symbol", "horizon", "chunk", "best", "arg", "inner", "reach"])
    return run


def _search(pen, min_size, jump):
    """End by end through the new chunk: the best of the earlier chunks against its own starts."""
    def run(pdf_iter):
        for pdf in pdf_iter:
            out = []
            for r in pdf.itertuples():
                cuts = _bounds(r.low, r.size, r.n, jump, min_size)
                starts, ends = cuts[:-1], cuts[1:]
                e = len(ends)
                square = np.asarray(r.squares, float).reshape(e + 1, e + 1)
                total, back = np.full(e + 1, np.inf), np.zeros(e, np.int64)
                total[0] = r.entry
                earlier = sorted(r.found, key=lambda f: f["chunk"]) if r.found is not None else []
                for j in range(e):
                    value, at = np.inf, -1
                    for f in earlier:                      # ties go to the earliest start
                        if f["best"][j] < value:
                            value, at = f["best"][j], int(f["arg"][j])
                    ok = starts[:j + 1] <= _last_start(ends[j], jump, min_size)
                    if ok.any():
                        length = ends[j] - starts[:j + 1][ok]
                        cost = total[:j + 1][ok] + length - square[:j + 1, j + 1][ok] / length + pen
                        k = int(cost.argmin())
                        if cost[k] < value:
                            value, at = cost[k], int(starts[:j + 1][ok][k])
                    total[j + 1], back[j] = value, at
                length = ends[-1] - starts
                reach = np.where(starts <= _last_start(ends[-1], jump, min_size), total[:-1] + length - square[:-1, -1] / length + pen, np.inf)
                out.append((r.symbol, r.horizon, ends, back, starts, total[:-1], square[:-1, -1], reach, total[-1]))
            yield pd.DataFrame(out, columns=["symbol", "horizon", "ends", "back", "starts", "total", "inner", "reach", "entry"])
    return run


STATE = f"{_KEY_SCHEMA}, chunk long, first long, values_ array<double>, starts array<long>, total array<double>, inner array<double>"


def _alive(pen):
    """Starts that may still be best: not dearer than the best by more than the penalty."""
    def run(pdf_iter):
        for pdf in pdf_iter:
            out = []
            for r in pdf.itertuples():
                reach = np.asarray(r.reach, float)
                keep = ~np.isfinite(reach) | (reach <= r.entry + pen)
                out.append((r.symbol, r.horizon, r.chunk, r.first, r.values_, *(np.asarray(a)[keep] for a in (r.starts, r.total, r.inner))))
            yield pd.DataFrame(out, columns=["symbol", "horizon", "chunk", "first", "values_", "starts", "total", "inner"])
    return run


def _followed(pdf: pd.DataFrame) -> pd.DataFrame:
    """Breakpoints of one series: the back pointers from its end."""
    back = dict(zip(pdf["end"], pdf["back"]))
    at, found = back[max(back)], []
    while at > 0:
        found.append(at)
        at = back[at]
    return pd.DataFrame({"symbol": pdf["symbol"].iat[0], "horizon": pdf["horizon"].iat[0], "bkp_index": np.array(found[::-1], "int64")})


def changepoints_blocked(long: DataFrame, *, metric: str = "spread_zscore", pen: float = PELT_PENALTY,
                         min_size: int = PELT_MIN_SIZE, jump: int = PELT_JUMP, chunk_rows: int = DEFAULT_CHUNK) -> DataFrame:
    """``changepoints`` with tasks of two chunks at most (same rows).

    ``chunk_rows`` is rounded up to a multiple of ``jump`` that holds two segments.
    """
    m = -(-max(chunk_rows, 2 * min_size, jump) // jump) * jump
    how = (pen, min_size, jump)
    indexed = index_rows(metric_series(long, metric).where(F.col("value").isNotNull()), tuple(KEYS), "date")
    spans = _kept(indexed.groupBy(*KEYS).agg(F.min("_idx").alias("_from"), F.count(F.lit(1)).alias("n")), "spans")
    placed = indexed.join(spans, KEYS).withColumn("pos", F.col("_idx") - F.col("_from"))
    cut = placed.where(F.col("n") >= 2 * min_size).withColumn("chunk", F.expr(f"pos div {m}"))
    blocks = _kept(cut.groupBy(*KEYS, "chunk", "n").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "value"))), lambda s: s["value"]).alias("values")), "blocks")
    blocks = blocks.join(_kept(_bandwidths(blocks), "bandwidths"), KEYS)
    rounds = blocks.agg(F.max("chunk")).first()[0]
    pointers, state, entry = None, None, None
    for k in range(0 if rounds is None else rounds + 1):
        now = blocks.where(F.col("chunk") == k).select(*KEYS, "n", "gamma", F.lit(k * m).alias("low"), F.col("values").alias("values_"), F.size("values").alias("size"))
        own = _kept(now.mapInPandas(_within(*how), f"{_KEY_SCHEMA}, squares array<double>"), "within")
        head = now.drop("values_").join(own, KEYS)
        if state is None:
            head = head.select("*", F.lit(0.0).alias("entry"), F.lit(None).cast("array<struct<chunk:long,best:array<double>,arg:array<long>>>").alias("found"))
        else:
            with_now = state.join(now.withColumnRenamed("values_", "now"), KEYS)
            across = _kept(with_now.mapInPandas(_across(*how), f"{_KEY_SCHEMA}, chunk long, whole array<double>, part array<double>"), "across")
            after = across.select(*KEYS, "chunk", "whole").groupBy(*KEYS).applyInPandas(_later, f"{_KEY_SCHEMA}, chunk long, after array<double>")
            rows = state.drop("values_").join(across.drop("whole"), [*KEYS, "chunk"]).join(after, [*KEYS, "chunk"]).join(head, KEYS)
            chosen = _kept(rows.mapInPandas(_choices(*how), f"{_KEY_SCHEMA}, chunk long, best array<double>, arg array<long>, inner array<double>, reach array<double>"), "choices")
            found = chosen.groupBy(*KEYS).agg(F.collect_list(F.struct("chunk", "best", "arg")).alias("found"))
            head = head.join(entry, KEYS).join(found, KEYS, "left")
        searched = _kept(head.mapInPandas(_search(*how), f"{_KEY_SCHEMA}, ends array<long>, back array<long>, starts array<long>, total array<double>, "
                                                        "inner array<double>, reach array<double>, entry double"), "searched")
        part = searched.select(*KEYS, F.inline(F.arrays_zip(F.col("ends").alias("end"), F.col("back").alias("back"))))
        pointers = part if pointers is None else pointers.unionByName(part)
        if k == rounds:
            break
        entry = searched.select(*KEYS, "entry")
        fresh = searched.join(now, KEYS).select(*KEYS, F.lit(k).cast("long").alias("chunk"), F.lit(k * m).cast("long").alias("first"), "values_", "starts", "total", "inner", "reach", "entry")
        if state is not None:
            seen = state.drop("inner").join(chosen.select(*KEYS, "chunk", "inner", "reach"), [*KEYS, "chunk"]).join(entry, KEYS)
            fresh = seen.select(*fresh.columns).unionByName(fresh)
        state = _kept(fresh.mapInPandas(_alive(pen), STATE), "starts")
        oldest = state.where(F.size("starts") > 0).groupBy(*KEYS).agg(F.min("chunk").alias("_oldest"))
        state = state.join(oldest, KEYS).where(F.col("chunk") >= F.col("_oldest")).drop("_oldest")
    if pointers is None:
        return long.sparkSession.createDataFrame([], CHANGEPOINT_SCHEMA)
    breaks = pointers.groupBy(*KEYS).applyInPandas(_followed, f"{_KEY_SCHEMA}, bkp_index long")
    dated = placed.select(*KEYS, F.col("pos").cast("long").alias("bkp_index"), "date")
    return breaks.join(dated, [*KEYS, "bkp_index"]).select("symbol", "horizon", "bkp_index", "date")
