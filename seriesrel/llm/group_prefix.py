"""Exact Jaccard join of word three-grams by grouped prefixes.

Two documents link when their sets of three-word runs have a Jaccard similarity of 0.9
or more. All runs have one global order: first by how frequent they are (a class from a
fixed table of summed counts, ``BUCKETS`` long, over all documents), then by hash. Of n
runs the first n - ceil(0.9 n) + 1 are a document's prefix, and linked documents share a
prefix run. Any order is right; this one puts rare runs first, so few meet by chance.

The job: (1) documents with equal sets collapse to the least id; (2) those with the same
prefix and size form one group, and groups are joined on prefix runs within neighbouring
size classes; (3) first every group against one pivot of each bucket, the one with the
fewest rarer runs before the shared one, and every member against its group's first;
what passes the size and position filters, and then the two whole prefixes, is verified
on the whole texts; (4) that is
repeated with the next pivots for buckets whose groups are in different components, and
(5) what is then still apart is joined pair by pair, expanded to members and verified;
a bucket that has a group of several members stays open up to there, unless all are in one component.
Links make components. So a group of many variants costs a comparison each with a few
pivots, not one each with all others, and no link between components is lost.

Edge cases: null and empty texts, and texts of white space only, have no runs and link
with nothing; fewer than three words are one run; null ids cannot be named, so such rows
link with nothing; rows that share an id are one document in links; repeated rows
collapse; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesrel.llm.bagminhash import components
from seriesrel.llm.text import U, byte_classes, encoded, mix, shingles, small
from seriesrel.llm.vectors import SCHEMA, rows_of, tree_sum, written

WIDTH, PERCENT = 3, 90
BUCKETS = 1 << 18
PIVOTS = 2                            # rounds of pivots before pairs are made
BLANKS = byte_classes(True)
BLANKS[BLANKS > 0] = 1                # everything but white space belongs to words


def run_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(owner, hash)`` of the distinct three-word runs, sorted by owner and hash."""
    h, owner = shingles([t.lower() for t in texts], WIDTH, BLANKS)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    if len(h):
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])))
        h, owner = h[new], owner[new]
    return owner, h


def run_classes(docs: DataFrame) -> np.ndarray:
    """Frequency class of each bucket of runs: 0, or how many powers of two it stands out by."""
    def count(batches):
        sums = None
        for batch in small(batches):
            _, h = run_sets(encoded(batch.column("text")))
            sums = np.zeros(BUCKETS, np.int64) if sums is None else sums
            sums += np.bincount((h % U(BUCKETS)).astype(np.int64), minlength=BUCKETS)
        if sums is not None:
            yield rows_of(sums)

    counts = tree_sum(docs.select("text").mapInArrow(count, SCHEMA), BUCKETS)
    mean = counts.sum() / BUCKETS
    over = np.maximum(counts - mean, 0) / (8 * np.sqrt(mean) + 8)
    return np.where(over >= 1, 1 + np.floor(np.log2(np.maximum(over, 1))), 0).astype(np.uint8)


def size_class(n: np.ndarray) -> np.ndarray:
    """Sizes at a ratio of 0.9 or more are in the same class or in neighbouring ones."""
    return np.floor(np.log(np.maximum(n, 1)) / (np.log(100 / PERCENT) * 1.001)).astype(np.int32)


def prefixes(docs: DataFrame, classes: np.ndarray) -> DataFrame:
    """``(doc_id, n, s1, s2, g1, g2, size, prefix)``: the set's size and name, the prefix's name and runs."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def run(batches):
        classes = shared.value
        for batch in small(batches):
            rows = batch.num_rows
            owner, h = run_sets(encoded(batch.column("text")))
            ends = np.searchsorted(owner, np.arange(rows + 1))
            n = np.diff(ends)
            # The run's place in the global order: its class, then 56 bits of its hash.
            key = (classes[(h % U(BUCKETS)).astype(np.int64)].astype(U) << U(56)) | (h >> U(8))
            key = key[np.lexsort((key, owner))]
            take = np.where(n > 0, n - -(-PERCENT * n // 100) + 1, 0)
            rank = np.arange(len(key)) - ends[owner]
            kept = rank < take[owner]
            key, starts = key[kept], np.concatenate(([0], np.cumsum(take)))
            cols = []
            for values, cuts in ((h, ends), (key, starts)):
                for salt in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
                    s = np.concatenate((np.zeros(1, U), np.cumsum(mix(values ^ U(salt)))))
                    cols.append(pa.array((s[cuts[1:]] - s[cuts[:-1]]).view(np.int64)))
            lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(key.view(np.int64)))
            yield pa.record_batch([batch.column("doc_id"), pa.array(n.astype(np.int64)), *cols, pa.array(size_class(n)), lists],
                                  names=["doc_id", "n", "s1", "s2", "g1", "g2", "size", "prefix"])

    return docs.mapInArrow(run, "doc_id long, n long, s1 long, s2 long, g1 long, g2 long, size int, prefix array<long>")


def _verify(batches):
    for outer in small(batches, column="text_a"):
        for batch in small([outer], column="text_b"):
            (oa, ha), (ob, hb) = (run_sets(encoded(batch.column(c))) for c in ("text_a", "text_b"))
            owner, h = np.concatenate((oa, ob)), np.concatenate((ha, hb))
            order = np.lexsort((h, owner))
            owner, h = owner[order], h[order]
            same = (owner[1:] == owner[:-1]) & (h[1:] == h[:-1])
            common = np.bincount(owner[1:][same], minlength=batch.num_rows)
            union = np.bincount(owner, minlength=batch.num_rows) - common
            ok = (union > 0) & (100 * common >= PERCENT * union)
            yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b"), "ok": pa.array(ok)})


def _possible(batches):
    """Group pairs that their prefixes leave possible: up to the lesser of the two last prefix
    runs, what both have in common is known; beyond it, at most all the rest of one."""
    for whole in batches:
        for at in range(0, whole.num_rows, 1000):
            batch = whole.slice(at, 1000)
            owners, keys, lasts, sizes = [], [], [], []
            for t in "ab":
                lists = batch.column(f"prefix_{t}")
                count = np.diff(lists.offsets.to_numpy())
                key = lists.flatten().to_numpy(zero_copy_only=False).view(U)
                owners.append(np.repeat(np.arange(batch.num_rows), count))
                keys.append(key)
                lasts.append(key[np.cumsum(count) - 1])
                sizes.append(batch.column(f"n_{t}").to_numpy())
            last, left = np.minimum(*lasts), []
            for k in (0, 1):
                known = keys[k] <= last[owners[k]]
                owners[k], keys[k] = owners[k][known], keys[k][known]
                left.append(sizes[k] - np.bincount(owners[k], minlength=batch.num_rows))
            owner, key = np.concatenate(owners), np.concatenate(keys)
            order = np.lexsort((key, owner))
            owner, key = owner[order], key[order]
            same = (owner[1:] == owner[:-1]) & (key[1:] == key[:-1])
            most = np.bincount(owner[1:][same], minlength=batch.num_rows) + np.minimum(*left)
            ok = (100 + PERCENT) * most >= PERCENT * (sizes[0] + sizes[1])
            yield batch.select(["a", "b"]).filter(pa.array(ok))


def possible(pairs: DataFrame, heads: DataFrame) -> DataFrame:
    """The pairs whose prefixes do not rule a link out; ``heads`` has ``doc_id, n, prefix``."""
    both = (pairs.join(heads.withColumnsRenamed({"doc_id": "a", "n": "n_a", "prefix": "prefix_a"}), "a")
            .join(heads.withColumnsRenamed({"doc_id": "b", "n": "n_b", "prefix": "prefix_b"}), "b"))
    names = ["a", "b", "n_a", "n_b", "prefix_a", "prefix_b"]
    return both.select(*names).mapInArrow(_possible, "a long, b long").distinct()


def linked(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that are linked, by the whole texts of their documents."""
    ids = written(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "pair-ids")
    texts = written(docs.join(ids, "doc_id", "left_semi").distinct(), "pair-texts")
    both = (pairs.join(texts.withColumnsRenamed({"doc_id": "a", "text": "text_a"}), "a")
            .join(texts.withColumnsRenamed({"doc_id": "b", "text": "text_b"}), "b"))
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a long, b long, ok boolean").where("ok").select("a", "b")


def _fits(x: str, y: str):
    """Size and position filters of two groups at a shared run: the runs before it are not shared,
    if it is the first shared one; a linked pair passes there at least."""
    nx, ny = F.col(f"{x}n"), F.col(f"{y}n")
    rest = F.least(nx - F.col(f"{x}pos"), ny - F.col(f"{y}pos"))
    return (100 * F.least(nx, ny) >= PERCENT * F.greatest(nx, ny)) & ((100 + PERCENT) * rest >= PERCENT * (nx + ny))


def postings(groups: DataFrame) -> DataFrame:
    """``(run, low, gid, n, pos, size)``: each group under its prefix runs that another group
    of a neighbouring size has too, in the bucket of its size class and the one below."""
    rows = groups.select(F.posexplode("prefix").alias("pos", "run"), "gid", "n", "size")
    again = written(rows.groupBy("run").count().where("count > 1").select("run"), "runs")
    rows = rows.join(again, "run").select("run", F.explode(F.array(F.col("size"), F.col("size") - 1)).alias("low"), "gid", "n", "pos", "size")
    rows = written(rows, "postings")
    many = rows.groupBy("run", "low").agg(F.count("*").alias("m"), F.min("size").alias("least")).where("m > 1 AND least = low").select("run", "low")
    return rows.join(written(many, "buckets"), ["run", "low"])


def link_classes(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each row of ``docs``."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = written(prefixes(plain, run_classes(docs)), "signed")
    some = signed.where("n > 0 AND doc_id IS NOT NULL")
    sets = written(some.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"), F.first("g1").alias("g1"), F.first("g2").alias("g2")), "sets")
    groups = written(sets.groupBy("n", "g1", "g2").agg(F.min("rep").alias("gid"), F.count("*").alias("members")), "groups")
    members = sets.join(groups.where("members > 1"), ["n", "g1", "g2"]).select("gid", "rep")
    members = written(members, "members")
    first = some.join(groups.select("n", "g1", "g2", F.col("gid").alias("doc_id")), ["n", "g1", "g2", "doc_id"], "left_semi")
    posts = postings(first.withColumnRenamed("doc_id", "gid"))
    heads = some.select("doc_id", "n", "prefix")

    tested = written(members.where("rep <> gid").select(F.col("rep").alias("a"), F.col("gid").alias("b")), "pairs")
    links = tested if tested.isEmpty() else written(linked(tested, plain), "links")
    labels, pivots = components(links), None
    for done in range(PIVOTS):
        posts = opened(posts, labels, members, done)
        pivots = next_pivots(posts, labels, pivots)
        pairs = written(star_pairs(posts, pivots).join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = tested.unionByName(pairs)
        pairs = written(possible(pairs, heads), "possible")
        if not pairs.isEmpty():
            links = written(links.unionByName(linked(pairs, plain)), "links")
            labels = components(links)
    rest = rest_pairs(opened(posts, labels, members, PIVOTS), labels, members, heads).join(tested, ["a", "b"], "left_anti")
    rest = written(rest, "pairs")
    if not rest.isEmpty():
        labels = components(links.unionByName(linked(rest, plain)))
    known = sets.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("n", "s1", "s2", F.coalesce("label", "rep").alias("component"))
    out = signed.select("doc_id", "n", "s1", "s2").join(known, ["n", "s1", "s2"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


POSTING = ["run", "low", "gid", "n", "pos", "size"]


def opened(posts: DataFrame, labels: DataFrame, members: DataFrame, done: int) -> DataFrame:
    """The postings of buckets whose groups are in different components, with the least
    and greatest label that a group's members have (``lmin``, ``lmax``). A bucket of no more
    than one group beyond the ``done`` pivots it had has had all its pairs, if each of its groups
    is one set: pivots meet only the first sets of groups, and others of them may link where those do not."""
    named = labels.withColumnsRenamed({"node": "rep", "label": "l"})
    own = F.coalesce("l", "rep")
    inside = members.join(named, "rep", "left").groupBy("gid").agg(F.min(own).alias("i"), F.max(own).alias("j"))
    rows = (posts.select(*POSTING).join(named.withColumnRenamed("rep", "gid"), "gid", "left").join(written(inside, "inside"), "gid", "left")
            .select(*POSTING, F.coalesce("i", "l", "gid").alias("lmin"), F.coalesce("j", "l", "gid").alias("lmax"), F.col("i").isNotNull().alias("several")))
    still = rows.groupBy("run", "low").agg(F.min("lmin").alias("a"), F.max("lmax").alias("b"), F.count("*").alias("m"), F.bool_or("several").alias("several"))
    still = still.where((F.col("a") != F.col("b")) & ((F.col("m") > done + 1) | F.col("several"))).select("run", "low")
    return written(rows.drop("several").join(written(still, "still"), ["run", "low"]), "open")


def next_pivots(rows: DataFrame, labels: DataFrame, had: DataFrame | None) -> DataFrame:
    """``(run, low, p_gid, p_pos, p_n, p_l)``: per open bucket the group with the fewest rarer runs
    before the shared one, of those in no component that had a pivot there; earlier pivots stay listed."""
    if had is not None:
        past = had.join(labels.withColumnsRenamed({"node": "p_gid", "label": "l"}), "p_gid", "left")
        past = written(past.select("run", "low", F.coalesce("l", "p_gid").alias("lmin")).distinct(), "past")
        rows = rows.join(past, ["run", "low", "lmin"], "left_anti")
    best = F.min(F.struct(F.col("pos").alias("p_pos"), F.col("gid").alias("p_gid"), F.col("n").alias("p_n"), F.col("lmin").alias("p_l")))
    return written(rows.groupBy("run", "low").agg(best.alias("p")).select("run", "low", "p.*"), "pivots")


def star_pairs(rows: DataFrame, pivots: DataFrame) -> DataFrame:
    """``(a, b)``: each group with its bucket's pivot, unless they are in one component."""
    met = rows.join(pivots, ["run", "low"]).where(_fits("", "p_") & (F.col("gid") != F.col("p_gid")))
    met = met.where((F.col("lmin") != F.col("p_l")) | (F.col("lmax") != F.col("p_l")))
    return met.select(F.greatest("gid", "p_gid").alias("a"), F.least("gid", "p_gid").alias("b")).distinct()


def rest_pairs(rows: DataFrame, labels: DataFrame, members: DataFrame, heads: DataFrame) -> DataFrame:
    """``(a, b)``: members of different components, of all group pairs that pass the filters and
    the prefixes; a group's members have its size and prefix."""
    names = ["gid", "n", "pos", "size", "lmin", "lmax"]
    x, y = (rows.select("run", "low", *[F.col(c).alias(t + c) for c in names]) for t in ("x_", "y_"))
    one = (F.col("x_lmin") == F.col("x_lmax")) & (F.col("y_lmin") == F.col("y_lmax")) & (F.col("x_lmin") == F.col("y_lmin"))
    met = x.join(y, (x.run == y.run) & (x.low == y.low) & (F.col("x_gid") < F.col("y_gid")) & ~one
                 & (F.least("x_size", "y_size") == x.low) & _fits("x_", "y_"))
    pairs = written(met.select(F.col("x_gid").alias("a"), F.col("y_gid").alias("b")).distinct(), "group-pairs")
    groups = possible(pairs, heads).withColumnsRenamed({"a": "g", "b": "h"})
    groups = groups.unionByName(members.select(F.col("gid").alias("g"), F.col("gid").alias("h")).distinct())
    alone = rows.select("gid").union(members.select("gid")).distinct().select("gid", F.col("gid").alias("rep"))
    named = alone.union(members).distinct().join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    named = written(named.select("gid", "rep", F.coalesce("label", "rep").alias("label")), "named")
    left = named.select(F.col("gid").alias("g"), F.col("rep").alias("r"), F.col("label").alias("lr"))
    right = named.select(F.col("gid").alias("h"), F.col("rep").alias("s"), F.col("label").alias("ls"))
    both = groups.join(left, "g").join(right, "h").where("lr <> ls AND r <> s")
    return both.select(F.greatest("r", "s").alias("a"), F.least("r", "s").alias("b")).distinct()
