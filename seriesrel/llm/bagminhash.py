"""Near-duplicates by BagMinHash signatures of word five-grams.

Similarity is the weighted Jaccard of the texts' multisets of five-word runs
(lower case, letters and digits; a shorter text is one run of all its words). For
an element of weight w, Poisson processes of hash-driven points run on the dyadic
weight cells [0,1), [1,2), [2,4), ...; a cell that w cuts keeps the points below w,
so equal weight ranges of two texts carry equal points. Each of the signature's
registers keeps the first point that falls on it, and two registers agree with
probability equal to the weighted Jaccard.

The job: (1) signatures in one pass; texts with equal multisets collapse to the
least id; (2) every band of registers makes buckets, whose members are verified
against the bucket's least member by exact multiset overlap; (3) buckets with a
member that is not linked to that pivot get a second pivot, and members that are
then still in different components are compared, once a pair, unless what they can have
in common (bounded by their overlaps with the pivots and by the runs that only one text
has) or their register agreement (six standard deviations below the expected one)
rules a link out; (4) links make components. No group is gathered into a task, and what moves is
ids, bands and the texts of candidate pairs.

Edge cases: null and empty texts, and texts without a letter or digit, have no
runs and are alone; null ids are treated like any id that equals itself; repeated
rows share a class; empty tables work; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesrel.llm.text import U, encoded, mix, shingles, small, unused
from seriesrel.session import scratch_path

WIDTH, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
#: A pair at the threshold agrees on 96 of 120 registers, with a deviation of 4.4.
LEAST_AGREEING = 70
SLICE = 60_000                      # elements drawn at once


def multisets(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(owner, element, weight)`` sorted by owner and element."""
    h, owner = shingles(texts, width)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    if not len(h):
        return owner, h, np.zeros(0, np.int64)
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])))
    at = np.flatnonzero(new)
    return owner[at], h[at], np.diff(np.append(at, len(h)))


def _cells(element: np.ndarray, weight: np.ndarray):
    """Dyadic cells that the weights reach: (row, seed, low, length)."""
    rows, seeds, lows, lengths = ([np.zeros(0, t)] for t in (np.int64, U, np.int64, np.int64))
    idx, level, low = np.arange(len(weight)), 0, 0
    while len(idx):
        length = 1 if level == 0 else 1 << (level - 1)
        rows.append(idx)
        seeds.append(mix(element[idx] + U(level * 0x632BE59BD9B4E019 & (1 << 64) - 1)))
        lows.append(np.full(len(idx), low, np.int64))
        lengths.append(np.full(len(idx), length, np.int64))
        low += length
        level += 1
        idx = idx[weight[idx] > low]
    return tuple(np.concatenate(x) for x in (rows, seeds, lows, lengths))


def _sketch(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Register minima, ``n`` x REGISTERS; rows without elements stay infinite."""
    reg = np.full(n * REGISTERS, np.inf)
    total = np.bincount(owner, weights=weight, minlength=n)
    # By this value every register is expected to be full but for a chance of e^-5 a text.
    limit = np.where(total > 0, REGISTERS / np.maximum(total, 1) * (np.log(REGISTERS) + 5), 0.0)
    row, seed, low, length = _cells(element, weight)
    own, need = owner[row], weight[row]
    x, step = np.zeros(len(row)), np.zeros(len(row), U)
    while len(row):
        live = np.arange(len(row))
        while len(live):
            step[live] += U(1)
            r = mix(seed[live] + step[live] * U(0x9E3779B97F4A7C15))
            u = ((r >> U(11)).astype(np.float64) + 0.5) * 2.0 ** -53
            x[live] -= np.log(u) / length[live]
            r = mix(r + U(0xD1B54A32D192ED03))
            place = low[live] + (((r >> U(32)) * length[live].astype(U)) >> U(32)).astype(np.int64)
            ok = place < need[live]
            hit = live[ok]
            slot = ((r[ok] & U(0xFFFFFFFF)) * U(REGISTERS) >> U(32)).astype(np.int64)
            np.minimum.at(reg, own[hit] * REGISTERS + slot, x[hit])
            live = live[x[live] <= limit[own[live]]]
        # Every cell has passed its limit, so a register at or below it is final.
        short = np.zeros(n, bool)
        worst = reg.reshape(n, REGISTERS).max(axis=1)
        short[(total > 0) & (worst > limit)] = True
        go = short[own]
        row, seed, low, length, own, need, x, step = (a[go] for a in (row, seed, low, length, own, need, x, step))
        limit = np.where(short, limit * 2, limit)
    return reg.reshape(n, REGISTERS)


def signatures(texts: list[bytes]):
    """Per text: total weight, two 64-bit sums that name the multiset, the register minima."""
    n = len(texts)
    owner, element, weight = multisets(texts)
    total = np.bincount(owner, weights=weight, minlength=n).astype(np.int64)
    names = []
    for salt in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
        v = mix(mix(element ^ U(salt)) + weight.astype(U))
        s = np.concatenate((np.zeros(1, U), np.cumsum(v)))
        ends = np.searchsorted(owner, np.arange(n + 1))
        names.append(s[ends[1:]] - s[ends[:-1]])
    reg = np.empty((n, REGISTERS))
    ends = np.searchsorted(owner, np.arange(n + 1))
    at = 0
    while at < n:                    # whole texts, about SLICE elements together
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE, "right")) - 1)
        lo, hi = ends[at], ends[to]
        reg[at:to] = _sketch(owner[lo:hi] - at, element[lo:hi], weight[lo:hi], to - at)
        at = to
    return total, names[0], names[1], reg


def _sign(batches):
    for batch in small(batches):
        total, n1, n2, reg = signatures(encoded(batch.column("text"), lower=True))
        bits = mix(reg.view(U))
        bands = np.zeros((len(total), BANDS), U)
        for j in range(ROWS):
            bands = mix(bands * U(31) + bits[:, j::ROWS])
        starts = np.arange(0, bands.size + 1, BANDS, dtype=np.int32)
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"), "total": pa.array(total),
            "n1": pa.array(n1.view(np.int64)), "n2": pa.array(n2.view(np.int64)),
            "bands": pa.ListArray.from_arrays(starts, bands.view(np.int64).ravel()),
            "marks": pa.array([r.tobytes() for r in bits.astype(np.uint8)], pa.binary())})


def jaccard(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Exact weighted Jaccard of the pairs' multisets."""
    n = len(a)
    oa, ea, wa = multisets(a)
    ob, eb, wb = multisets(b)
    owner, element = np.concatenate((oa, ob)), np.concatenate((ea, eb))
    weight = np.concatenate((wa, wb))
    order = np.lexsort((element, owner))
    owner, element, weight = owner[order], element[order], weight[order]
    same = (owner[1:] == owner[:-1]) & (element[1:] == element[:-1])
    common = np.bincount(owner[1:][same], weights=np.minimum(weight[1:], weight[:-1])[same], minlength=n)
    whole = np.bincount(owner, weights=weight, minlength=n) - common
    return np.where(whole > 0, common / np.maximum(whole, 1), 0.0)


def _verify(batches):
    for outer in small(batches, column="text_a"):
        for batch in small([outer], column="text_b"):
            sim = jaccard(encoded(batch.column("text_a"), lower=True), encoded(batch.column("text_b"), lower=True))
            yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b"), "sim": pa.array(sim)})


def _agree(batches):
    for b in batches:
        if b.num_rows:
            x = np.frombuffer(b"".join(b.column("marks").to_pylist()), np.uint8).reshape(-1, REGISTERS)
            y = np.frombuffer(b"".join(b.column("marks_b").to_pylist()), np.uint8).reshape(-1, REGISTERS)
            ok = pa.array((x == y).sum(axis=1) >= LEAST_AGREEING)
            b = b.filter(ok)
        yield b.select(["a", "b"])


def _written(df: DataFrame, name: str) -> DataFrame:
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def similarities(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """``(a, b, sim)`` of id pairs. An id with thousands of partners is split by the adaptive skew join."""
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    both = (pairs.join(texts.withColumnsRenamed({"id": "a", "text": "text_a"}), "a")
            .join(texts.withColumnsRenamed({"id": "b", "text": "text_b"}), "b"))
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a long, b long, sim double")


def components(links: DataFrame) -> DataFrame:
    """``(node, label)``: the least node of each component, by large-star and small-star rounds.

    ``links`` has ``(a, b)``. Each round is two grouped minima and two joins and is
    written, so neither lineage nor any task grows with a component.
    """
    edges = _written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                     .where("u <> v").distinct(), "edges")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v")))).where("u <> v").distinct()
        new = _written(small, "edges")
        # Done when all are stars: no leaf has two centres, no centre is a leaf.
        ends = new.select(F.col("u").alias("x"), F.lit(1).alias("leaf")).union(
            new.select(F.col("v").alias("x"), F.lit(0)).distinct())
        if ends.groupBy("x").agg(F.sum("leaf").alias("leaves"), F.count("*").alias("n")).where("leaves > 0 AND n > 1").isEmpty():
            return new.select(F.col("u").alias("node"), F.col("v").alias("label"))
        edges = new


def _elements(batches):
    for batch in small(batches):
        owner, element, weight = multisets(encoded(batch.column("text"), lower=True))
        ids = batch.column("doc_id").to_numpy()
        yield pa.record_batch({"element": pa.array(element.view(np.int64)), "doc_id": pa.array(ids[owner]),
                               "weight": pa.array(weight.astype(np.int64))})


def own_weights(texts: DataFrame) -> DataFrame:
    """``(doc_id, own)``: the weight of the runs that no other of these texts has."""
    rows = texts.mapInArrow(_elements, "element long, doc_id long, weight long")
    single = rows.groupBy("element").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("last"), F.max("weight").alias("w"))
    return single.where("doc_id = last").groupBy("doc_id").agg(F.sum("w").alias("own"))


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, class_id)`` for each row of ``docs``; ``class_id`` is the class's least id."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = _written(plain.mapInArrow(_sign, "doc_id long, total long, n1 long, n2 long, bands array<long>, marks binary"), "signed")
    some = signed.where("total > 0 AND doc_id IS NOT NULL")
    reps = _written(some.groupBy("n1", "n2", "total").agg(F.min("doc_id").alias("rep")), "reps")
    own = some.join(reps.select(F.col("rep").alias("doc_id"), "n1", "n2", "total"), ["doc_id", "n1", "n2", "total"], "left_semi")
    members = own.select("doc_id", "total", F.posexplode("bands").alias("band", "key")).distinct()
    firsts = members.groupBy("band", "key").agg(F.min_by("total", "doc_id").alias("pivot_total"), F.min("doc_id").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    # Written first: with a plain exchange on either side, the adaptive plan can split a key of many members.
    firsts = _written(firsts.drop("n"), "firsts")
    spots = _written(members.join(firsts, ["band", "key"]), "spots")
    texts = _written(plain.join(spots.select("doc_id").distinct(), "doc_id", "left_semi").distinct(), "texts")

    # Every member against its bucket's least one.
    stars = spots.where("doc_id <> pivot").select(F.col("doc_id").alias("a"), F.col("pivot").alias("b")).distinct()
    tested = _written(similarities(stars, texts), "tested")
    near = F.col("sim") >= threshold
    seen = spots.join(tested.select(F.col("a").alias("doc_id"), F.col("b").alias("pivot"), "sim"), ["doc_id", "pivot"], "left")
    seen = seen.select("band", "key", "doc_id", "total", "pivot_total",
                       F.when(F.col("doc_id") == F.col("pivot"), 1.0).otherwise(F.col("sim")).alias("sim"))
    apart = _written(seen.where(~near).select("band", "key").distinct(), "apart-keys")
    links = tested.where(near).select("a", "b")
    if not apart.isEmpty():
        links = links.unionByName(_links_of_open_buckets(seen, apart, texts, own, tested, threshold))
    labels = components(links)
    known = reps.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "n1", "n2", "total", F.coalesce("label", "rep").alias("class_id"))
    return (signed.select("doc_id", "n1", "n2", "total").join(known, ["n1", "n2", "total"], "left")
            .select("doc_id", F.when(F.col("doc_id").isNull(), F.col("doc_id"))
                    .otherwise(F.coalesce("class_id", "doc_id")).alias("class_id")))


def _links_of_open_buckets(seen, apart, texts, own, tested, threshold) -> DataFrame:
    """Links among members of buckets in which some member is not linked to the pivot.

    The weight of runs that a text alone has bounds every similarity it can reach. The
    member with the smallest such share is a second pivot: for many variants of one text
    it is the text itself. What is still in different components after that is compared
    pair by pair where no bound rules the link out.
    """
    near = F.col("sim") >= threshold
    names = seen.join(apart, ["band", "key"], "left_semi")
    open_ids = names.select("doc_id").distinct()
    alone = own_weights(texts.join(open_ids, "doc_id", "left_semi"))
    open_ = names.join(alone, "doc_id", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    # No partner can reach the threshold if its own runs outweigh the rest.
    open_ = _written(open_.where(F.col("total") - F.col("own") >= threshold * F.col("total")), "open")
    best = _written(open_.groupBy("band", "key").agg(F.min(F.struct((F.col("own") / F.col("total")).alias("share"), "doc_id", "total")).alias("best")), "best")
    members = open_.join(best.select("band", "key", F.col("best.doc_id").alias("pivot"), F.col("best.total").alias("second_total")), ["band", "key"])
    members = members.withColumns({"a": F.greatest("doc_id", "pivot"), "b": F.least("doc_id", "pivot")})
    stars = members.where("a <> b").select("a", "b").distinct()
    second = _written(similarities(stars.join(tested.select("a", "b"), ["a", "b"], "left_anti"), texts), "tested")
    done = tested.unionByName(second)
    labels = components(done.where(near).select("a", "b"))
    rows = (members.join(done.withColumnRenamed("sim", "second_sim"), ["a", "b"], "left")
            .join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left"))
    second_sim = F.when(F.col("a") == F.col("b"), 1.0).otherwise(F.col("second_sim"))
    common = lambda sim, total: sim / (1 + sim) * (F.col("total") + F.col(total))
    rows = rows.select("band", "key", "doc_id", "total", "own", F.coalesce("label", "doc_id").alias("label"),
                       common(F.col("sim"), "pivot_total").alias("in1"), common(second_sim, "second_total").alias("in2"))
    still = rows.groupBy("band", "key").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l <> h").select("band", "key")
    rows = rows.join(_written(still, "still"), ["band", "key"], "left_semi")
    bands = own.select("doc_id", "bands").distinct()
    rows = _written(rows.join(bands, "doc_id").where(F.get("bands", "band") == F.col("key")), "apart")
    x, y = rows.alias("x"), rows.alias("y")
    # What two texts can have in common: within a pivot what the poorer one shares with it,
    # beyond it what is not their own.
    caps = [F.least(f"x.in{k}", f"y.in{k}") + F.least(*(F.col(f"{t}.total") - F.col(f"{t}.in{k}") - F.col(f"{t}.own") for t in "xy")) for k in (1, 2)]
    cap = F.least(*caps, F.col("x.total") - F.col("x.own"), F.col("y.total") - F.col("y.own"))
    # A pair is made once, in the first band in which both agree. Two texts that share a
    # closed bucket have one label, so for the rest every band they agree in is open.
    first = F.array_position(F.zip_with("x.bands", "y.bands", lambda a, b: a == b), True) - 1
    possible = ((F.col("x.band") == F.col("y.band")) & (F.col("x.key") == F.col("y.key"))
                & (F.col("x.doc_id") > F.col("y.doc_id")) & (F.col("x.label") != F.col("y.label"))
                & (cap >= threshold * (F.col("x.total") + F.col("y.total") - cap) - 1e-6)
                & (first == F.col("x.band")))
    pairs = x.join(y, possible).select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct()
    marks = own.select("doc_id", "marks").dropDuplicates(["doc_id"])
    marked = (pairs.join(marks.withColumnRenamed("doc_id", "a"), "a")
              .join(marks.withColumnsRenamed({"doc_id": "b", "marks": "marks_b"}), "b"))
    likely = marked.select("a", "b", "marks", "marks_b").mapInArrow(_agree, "a long, b long")
    likely = _written(likely.join(done.select("a", "b"), ["a", "b"], "left_anti"), "likely")
    more = similarities(likely, texts).where(near).select("a", "b")
    return second.where(near).select("a", "b").unionByName(more)


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each class stays: the one with the least id.

    The ids that go are written before the join, so that the plan knows their size and
    moves the texts only if they are many. Any other columns stay as they are.
    """
    name = unused(docs, "gone")
    gone = near_classes(docs).where("doc_id <> class_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(_written(gone, "near-gone"), F.col("doc_id") == F.col(name), "left_anti")
