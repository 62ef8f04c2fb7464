"""Alignment of two tokenizers by byte offsets, with corpus-wide counts of linked id pairs.

A is the byte-level vocabulary on a blank and the text, B the piece model on the text
(it adds the blank). Where both have a token that ends at the same byte, the text is cut
into groups, and the two tokens that end there are linked.

The job: (1) each task aligns its texts, once, and writes every text's groups and the codes
of its links; (2) the distinct id pairs of the links get a minimal perfect hash; every
task's counts become a dense vector indexed by that hash, and a tree of sums adds the
vectors; (3) every written link's count is looked up, each key verified. Linked tokens end together, so the bytes of one are the end of the other's:
all pairs together are no more than the bytes of both vocabularies (``most_pairs``, 0.5
million here), and so the hash, the keys and the counts have a size that no corpus exceeds.

Texts are cut at single blanks between two characters that are no white space. Neither
tokenizer has a token across such a blank (checked on loading for the pieces; the other's
pre-tokens begin there), so the pieces between are aligned on their own, and the frequent
ones are remembered in two generations of a bounded dictionary. A mark that ends a piece
after a letter is aligned apart from it, if no entry of the pieces has that mark after a letter.

Edge cases: null and empty texts, and texts whose joined token bytes differ from the
blank and the text (the pieces' blank sign in a text, say), have no tokens: zeros and an
empty string. Special tokens' strings are plain text. Null and repeated ids are carried
through row by row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import gc
import json
import os
import re
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from seriesrel.llm.bpe import PRETOKEN, byte_characters
from seriesrel.llm.perfect_hash import PerfectHash
from seriesrel.llm.text import small
from seriesrel.llm.vectors import SCHEMA, rows_of, tree_sum, written

BLANK = "▁"
REMEMBERED, LONGEST = 120_000, 48     # pieces of text a generation, characters of one
STORED = {"compression": "zstd", "parquet.block.size": 1 << 24}    # small row groups: a task holds one in memory
MARKS = ",.;:!?"
CODE, SHIFT = np.dtype("<u4"), 16     # a link's code: A's id, then B's in the lower bits
_cut = re.compile(r"(?<=\S) (?=\S)").split


# Letters whose classes are the same in both libraries' patterns (tested one by one).
_quick = re.compile("[\x00-\x7f\u00C0-\u024F]*").fullmatch


class Aligned:
    """The alignment of one piece of text: ids, links and groups."""

    __slots__ = ("n_a", "n_b", "packed", "shown")

    def __init__(self, n_a: int, n_b: int, packed: bytes, shown: str):
        """``packed``: the links' codes; bytes of its own, as an array's slice would keep the whole batch alive."""
        self.n_a, self.n_b, self.packed, self.shown = n_a, n_b, packed, shown

    @property
    def codes(self) -> np.ndarray:
        return np.frombuffer(self.packed, CODE)

    def __add__(self, other: Aligned) -> Aligned:
        return Aligned(self.n_a + other.n_a, self.n_b + other.n_b, self.packed + other.packed, f"{self.shown};{other.shown}")


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {c: b for b, c in byte_characters().items()}
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec["added_tokens"]}
        entries = {i: s.encode() if s in special else bytes(byte_of[c] for c in s) for s, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [entries.get(i, b"") for i in range(max(entries) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        if any(spec["model"]["vocab"]["".join(m)] != 256 + k for k, m in enumerate(merges)):
            raise ValueError("ids do not follow the merges: they are no ranks")
        if any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError("a piece reaches over a blank: texts cannot be cut there")
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << SHIFT:
            raise ValueError(f"ids of more than {SHIFT} bits")
        self.ranks = tiktoken.Encoding("a", pat_str=PRETOKEN, special_tokens={},
                                       mergeable_ranks={x: i for i, x in enumerate(self.bytes_a) if i < len(self.bytes_a) - len(special)})
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        # Written ids: with a comma (2 i), and as the last of their kind in a group (2 i + 1).
        self.shown_a, self.shown_b = (np.array([f"{i}{c}" for i in range(len(t)) for c in ends], object)
                                      for t, ends in ((self.bytes_a, ",|"), (self.bytes_b, ",;")))
        self._young: dict[str, Aligned | None] = {}
        self._old: dict[str, Aligned | None] = {}
        joined = {m for p in pieces for m in MARKS if re.search(r"[A-Za-z]" + re.escape(m), p)}
        place = {p: i for i, p in enumerate(pieces)}
        self.marks = {m: self._mark(self.bytes_a.index(m.encode()), place[m]) for m in MARKS if m not in joined and m in place}

    @staticmethod
    def _mark(a: int, b: int) -> Aligned:
        return Aligned(1, 1, np.array([a << SHIFT | b], CODE).tobytes(), f"{a}|{b}")

    def cut(self, text: str | None) -> list[str]:
        """The pieces of a text that are aligned on their own."""
        return _cut(text) if text else []

    def most_pairs(self) -> int:
        """No more id pairs than this can be linked: one token's bytes are the end of the other's."""
        return sum(map(len, self.bytes_a)) + sum(map(len, self.bytes_b))

    def _ids_a(self, texts: list[str], length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of a blank and each text (``length`` bytes), one after the other, and each text's number of ids.

        Texts of usual letters that begin and end without white space go as one text through the
        ranks of the same file, which is quicker: pre-tokens begin at the blanks between them.
        """
        joint = [bool(t) and not t[0].isspace() and not t[-1].isspace() and _quick(t) is not None for t in texts]
        quick = [t for t, j in zip(texts, joint, strict=True) if j]
        counts, owner = np.zeros(len(texts), np.int64), np.array(joint, bool)
        at_once, rest = np.zeros(0, np.int64), []
        if quick:
            at_once = self.ranks.encode_to_numpy(" " + " ".join(quick), disallowed_special=()).astype(np.int64)
            ends, stops = (np.cumsum(x) for x in (self.size_a[at_once], length[owner]))
            last = np.searchsorted(ends, stops)
            if not (ends[np.minimum(last, len(ends) - 1)] == stops).all():
                raise AssertionError("a token reaches over a blank")
            counts[owner] = np.diff(last, prepend=-1)
        if len(quick) < len(texts):
            slow = [" " + t for t, j in zip(texts, joint, strict=True) if not j]
            rest = [e.ids for e in self.a.encode_batch_fast(slow, add_special_tokens=False)]
            counts[~owner] = [len(ids) for ids in rest]
        owner = np.repeat(owner, counts)
        flat = np.empty(len(owner), np.int64)
        flat[owner] = at_once
        flat[~owner] = np.fromiter(chain.from_iterable(rest), np.int64, len(owner) - len(at_once))
        return flat, counts

    def _ids_b(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """B's ids of all texts, one after the other, and each text's number of ids."""
        ids = self.b.encode(texts, num_threads=1)
        counts = np.fromiter(map(len, ids), np.int64, len(texts))
        return np.fromiter(chain.from_iterable(ids), np.int64, int(counts.sum())), counts

    def align(self, texts: list[str]) -> list[Aligned | None]:
        """Alignment of each whole string; None where the bytes differ. All strings go through the same arrays."""
        wholes = [b" " + t.encode() for t in texts]
        length = np.fromiter(map(len, wholes), np.int64, len(texts))
        good = np.array([bool(t) for t in texts], bool)
        sides = []
        for (ids, counts), size in ((self._ids_a(texts, length), self.size_a), (self._ids_b(texts), self.size_b)):
            made = np.concatenate(([0], np.cumsum(size[ids])))[np.concatenate(([0], np.cumsum(counts)))]
            good &= np.diff(made) == length
            sides.append((ids, counts))
        for (ids, counts), entries in zip(sides, (self.bytes_a, self.bytes_b), strict=True):
            kept = ids if good.all() else ids[np.repeat(good, counts)]
            joined = b"".join(map(entries.__getitem__, kept.tolist()))
            if joined != b"".join(wholes if good.all() else [w for w, g in zip(wholes, good.tolist(), strict=True) if g]):
                at = 0
                for k in np.flatnonzero(good).tolist():
                    good[k], at = joined[at:at + length[k]] == wholes[k], at + int(length[k])
        a, b = (ids if good.all() else ids[np.repeat(good, counts)] for ids, counts in sides)
        if not len(a):
            return [None] * len(texts)
        # Both tokenizers cover the same bytes, so running byte counts of all strings together compare.
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        closing = np.zeros(int(ends_a[-1]) + 1, bool)
        closing[ends_b] = True
        hit = closing[ends_a]
        closing[:] = False
        closing[ends_a] = True
        closes = closing[ends_b]
        codes = (a[hit] << SHIFT | b[closes]).astype(CODE)
        n_a, n_b = (counts[good] for _, counts in sides)
        cuts = (CODE.itemsize * np.concatenate(([0], np.cumsum(hit)))[np.concatenate(([0], np.cumsum(n_a)))]).tolist()
        packed = codes.tobytes()
        strings = self._shown(a, b, hit, closes, np.concatenate(([0], np.cumsum(n_a + n_b))).tolist())
        found = [Aligned(x, y, packed[i:j], shown)
                 for x, y, i, j, shown in zip(n_a.tolist(), n_b.tolist(), cuts, cuts[1:], strings)]
        if len(found) == len(texts):
            return found
        rest = iter(found)
        return [next(rest) if g else None for g in good.tolist()]

    def _shown(self, a, b, hit, closes, stops: list[int]) -> list[str]:
        """The written groups of each string; in them a group's B ids follow its A ids."""
        last_a, first_b = np.flatnonzero(hit), np.concatenate(([0], np.flatnonzero(closes)[:-1] + 1))
        out = np.empty(len(a) + len(b), object)
        out[np.arange(len(a)) + first_b[np.cumsum(hit) - hit]] = self.shown_a[2 * a + hit]
        out[np.arange(len(b)) + last_a[np.cumsum(closes) - closes] + 1] = self.shown_b[2 * b + closes]
        ids = out.tolist()
        return ["".join(ids[i:j])[:-1] for i, j in zip(stops, stops[1:])]

    def learn(self, pieces: set[str]) -> dict[str, Aligned | None]:
        """Alignments of the pieces."""
        out, new, marked, young, old = {}, [], [], self._young, self._old
        for p in pieces:
            # A mark at a piece's end stands for itself: the piece without it is what is remembered.
            mark = self.marks.get(p[-1]) if p else None
            if mark and p[-2:-1].isascii() and p[-2:-1].isalpha():
                marked.append((p, mark))
                p = p[:-1]
                if p in pieces:
                    continue
            if p in young:
                out[p] = young[p]
            elif p in old:
                out[p] = young[p] = old[p]
            else:
                new.append(p)
        if new:
            new = list(dict.fromkeys(new))
            found = self.align(new)
            out.update(zip(new, found, strict=True))
            young.update((p, x) for p, x in zip(new, found, strict=True) if len(p) <= LONGEST)
        for p, mark in marked:
            base = out[p[:-1]]
            out[p] = base + mark if base else None
        if len(young) >= REMEMBERED:
            self._old, self._young = young, {}
        return out


_loaded: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner per worker process and files."""
    if (path_a, path_b) not in _loaded:
        _loaded[path_a, path_b] = Aligner(path_a, path_b)
    return _loaded[path_a, path_b]


def forget() -> None:
    """Frees the worker's aligner: what follows the alignment needs its memory."""
    _loaded.clear()
    pa.default_memory_pool().release_unused()


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row: ``doc_id, n_a, n_b, codes, groups``; ``codes`` holds the text's links in order (``CODE``)."""
    def run(batches):
        one = aligner(path_a, path_b)
        gc.disable()                  # what is made here has no cycles to look for
        try:
            yield from map(partial(rows, one), small(batches))
        finally:
            gc.enable()

    def rows(one: Aligner, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [one.cut(t) for t in batch.column("text").to_pylist()]
        known = one.learn(set(chain.from_iterable(texts)))
        bad = {p for p, x in known.items() if x is None}
        texts = [t if bad.isdisjoint(t) else [] for t in texts] if bad else texts
        known = {p: x for p, x in known.items() if x is not None} if bad else known
        # Sums over a text's pieces from running sums over the batch's.
        number = dict(zip(known, range(len(known)), strict=True))
        ends = np.cumsum([0, *map(len, texts)])
        order = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.int64, int(ends[-1]))
        n_a, n_b = (pa.array(np.diff(np.concatenate(([0], np.cumsum(np.array(fact, np.int64)[order])))[ends]))
                    for fact in ([x.n_a for x in known.values()], [x.n_b for x in known.values()]))
        packed, shown = [x.packed for x in known.values()], [x.shown for x in known.values()]
        order, ends = order.tolist(), ends.tolist()
        of = [order[i:j] for i, j in zip(ends, ends[1:])]
        codes = pa.array([b"".join(map(packed.__getitem__, t)) for t in of], pa.binary())
        groups = pa.array([";".join(map(shown.__getitem__, t)) for t in of], pa.string())
        return pa.record_batch([batch.column("doc_id"), n_a, n_b, codes, groups], names=["doc_id", "n_a", "n_b", "codes", "groups"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ALIGNED)


def codes_of(column: pa.Array) -> np.ndarray:
    """The codes of all links of a column's rows, one after the other."""
    return np.frombuffer(b"".join(column.to_pylist()), CODE).astype(np.int64)


def pair_counts(table: DataFrame) -> DataFrame:
    """``(pair, n)``: how often each task's rows link an id pair; a pair comes once a task."""
    def run(batches):
        forget()
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in small(batches, column="codes"):
            new, each = np.unique(codes_of(batch.column("codes")), return_counts=True)
            pairs, at = np.unique(np.concatenate((pairs, new)), return_inverse=True)
            total = np.zeros(len(pairs), np.int64)
            np.add.at(total, at, np.concatenate((counts, each)))
            counts = total
        for i in range(0, len(pairs), 10_000):
            yield pa.record_batch({"pair": pa.array(pairs[i:i + 10_000]), "n": pa.array(counts[i:i + 10_000])})

    return table.select("codes").mapInArrow(run, "pair long, n long")


def corpus_counts(table: DataFrame, most: int) -> tuple[PerfectHash, np.ndarray]:
    """The hash of all linked id pairs (``most`` at most) and their corpus-wide counts, by the hash's index."""
    parts = written(pair_counts(table), "pair-counts")
    keys = np.array(parts.select("pair").distinct().toArrow().column("pair").to_numpy(), np.int64)
    if len(keys) > most:
        raise AssertionError(f"{len(keys)} linked pairs; the vocabularies allow {most}")
    places = PerfectHash(keys)
    shared = table.sparkSession.sparkContext.broadcast(places)

    def vectors(batches):
        places, sums = shared.value, None
        for batch in batches:
            sums = np.zeros(len(places), np.int64) if sums is None else sums
            np.add.at(sums, places.find(batch.column("pair").to_numpy()), batch.column("n").to_numpy())
        if sums is not None and len(sums):
            yield rows_of(sums)

    return places, tree_sum(parts.mapInArrow(vectors, SCHEMA), len(places))


def links(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``."""
    table = written(aligned(docs, path_a, path_b), "alignments", **STORED)
    places, counts = corpus_counts(table, aligner(path_a, path_b).most_pairs())
    b_ids = places.keys & (1 << SHIFT) - 1
    highest = np.zeros(int(b_ids.max()) + 1 if len(b_ids) else 1, np.int64)
    np.maximum.at(highest, b_ids, counts)
    shared = docs.sparkSession.sparkContext.broadcast((places, counts, counts == highest[b_ids]))

    @arrow_udf("n_best long, count_sum long")
    def looked_up(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        forget()
        places, counts, best = shared.value
        for column in columns:
            found = [np.zeros((0, 2), np.int64)]
            for part in small([pa.record_batch([column], names=["codes"])], column="codes"):
                at = places.find(codes_of(part.column("codes")))
                if (at < 0).any():
                    raise AssertionError("a linked pair was not counted")
                ends = np.cumsum([0, *pc.binary_length(part.column("codes")).to_pylist()]) // CODE.itemsize
                found.append(np.stack([np.diff(np.concatenate(([0], np.cumsum(v[at])))[ends]) for v in (best, counts)], 1))
            sums = np.concatenate(found)
            yield pa.StructArray.from_arrays([pa.array(sums[:, 0]), pa.array(sums[:, 1])], ["n_best", "count_sum"])

    n_links = (F.octet_length("codes") / CODE.itemsize).cast("long")
    return (table.withColumn("found", looked_up("codes")).withColumn("n_links", n_links).withColumn("n_groups", n_links)
            .select("*", "found.*").select(*NAMES))


ALIGNED = "doc_id long, n_a long, n_b long, codes binary, groups string"
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def digest(linked: DataFrame) -> DataFrame:
    """``links`` with the groups as a digest; '' stays ''."""
    sha = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return linked.select(*NAMES[:-1], sha.alias("groups_sha256"))
