"""Token ids in wavelet matrices: one compressed, queryable row set per shard.

A shard is a run of consecutive documents' ids. It is stored as bit-planes, the
most significant first: plane k holds bit k of every id in the order that the planes above
left them, and after each plane the ids with a 0 move stably before those with a
1. With a rank directory per plane the compressed planes answer ``access`` (the id at a place),
``count`` (how often an id occurs before a place) and ``find`` (the place of its
n-th occurrence) without unpacking the ids.

Files are Parquet written and read by Spark itself, so any shared store will do:
one row per shard with its documents' ids and ends, the counts of zeros, and the
planes (zstd). Documents are dealt out by ranges of ``doc_id`` and sorted, so the
shards follow each other in ascending id order; a shard is closed at
``SHARD_TOKENS`` so that memory stays flat.

Edge cases: null text is one end token; a null ``doc_id`` comes first; repeated
rows follow each other; an empty table makes no shard.
"""

from __future__ import annotations

import unicodedata
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesrel.llm.bpe import byte_characters
from seriesrel.llm.text import small

END = 1
SHARD_TOKENS = 1 << 20
REMEMBERED = 400_000
_CODEC = pa.Codec("zstd", 1)
BLOCK = 512                          # bits between two entries of a rank directory


class WaveletMatrix:
    """Rank and select over the planes of one shard."""

    def __init__(self, n: int, zeros: list[int], planes: list[bytes]):
        self.n, self.zeros = n, zeros
        self.bits = [np.frombuffer(_CODEC.decompress(p, (n + 7) // 8, asbytes=True), np.uint8) for p in planes]
        self.ranks = []
        for b in self.bits:
            per = np.bitwise_count(np.pad(b, (0, -len(b) % (BLOCK // 8)))).reshape(-1, BLOCK // 8).sum(1, dtype=np.int64)
            self.ranks.append(np.concatenate(([0], np.cumsum(per))))

    @staticmethod
    def build(ids: np.ndarray) -> tuple[list[int], list[bytes]]:
        width = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        x = ids.astype(np.uint16 if width <= 16 else np.uint32)
        zeros, planes = [], []
        one = x.dtype.type(1)
        for k in range(width - 1, -1, -1):
            bit = (x >> x.dtype.type(k) & one).astype(np.uint8).view(bool)
            planes.append(_CODEC.compress(np.packbits(bit).tobytes(), asbytes=True))
            x = np.concatenate((low := np.compress(~bit, x), np.compress(bit, x)))
            zeros.append(len(low))
        return zeros, planes

    def unpack(self) -> np.ndarray:
        """All ids in order."""
        x = np.zeros(self.n, np.uint32 if len(self.bits) > 16 else np.uint16)
        for k, (packed, z) in enumerate(zip(reversed(self.bits), reversed(self.zeros), strict=True)):
            bit = np.unpackbits(packed, count=self.n).view(bool)
            place = np.concatenate((np.flatnonzero(~bit), np.flatnonzero(bit)))
            x[z:] |= x.dtype.type(1 << k)
            y = np.empty_like(x)
            y[place] = x
            x = y
        return x

    def _rank(self, plane: int, at: int) -> int:
        """Ones before ``at``."""
        block = at // BLOCK
        b = self.bits[plane][block * (BLOCK // 8):at // 8]
        r = int(self.ranks[plane][block]) + int(np.bitwise_count(b).sum(dtype=np.int64))
        return r + (int(self.bits[plane][at // 8]) >> (8 - at % 8)).bit_count() if at % 8 else r

    def access(self, at: int) -> int:
        value = 0
        for k, z in enumerate(self.zeros):
            one = int(self.bits[k][at // 8]) >> (7 - at % 8) & 1
            ones = self._rank(k, at)
            value, at = value << 1 | one, z + ones if one else at - ones
        return value

    def count(self, token: int, upto: int | None = None) -> int:
        """Occurrences of ``token`` before ``upto``."""
        if token < 0 or token >> len(self.zeros):
            return 0
        lo, hi = 0, self.n if upto is None else upto
        for k, z in enumerate(self.zeros):
            a, b = self._rank(k, lo), self._rank(k, hi)
            lo, hi = (z + a, z + b) if token >> (len(self.zeros) - 1 - k) & 1 else (lo - a, hi - b)
        return hi - lo

    def find(self, token: int, nth: int) -> int:
        """Place of the ``nth`` (from 0) occurrence of ``token``; -1 if there are fewer."""
        if not 0 <= nth < self.count(token):
            return -1
        lo, hi = 0, self.n
        while hi - lo > 1:           # select by bisection on rank
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if self.count(token, mid) > nth else (mid, hi)
        return lo


# Fixed value: the tokenizer file's pattern of pieces.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall

_SIGNS = set(".,;:!?")


class Encoder:
    """The library's ids, with each piece of a text encoded once and remembered.

    A text is put into the file's normal form (NFC, lower case character by character)
    and cut at blanks and by its pattern into pieces, and the library's BPE model gives
    the ids of each piece. Texts with unprintable characters, odd white space or special strings
    take the library's whole way.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.tokenize = self.library.model.tokenize
        self._special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self._chars = byte_characters()
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        letters = piece if piece.isascii() else "".join([self._chars[b] for b in piece.encode()])
        return array("I", [t.id for t in self.tokenize(letters)]).tobytes()

    def _word(self, piece: str) -> bytes:
        ids = self._young.get(piece)
        if ids is None:
            ids = self._old.get(piece) or self._piece(piece)
            if len(self._young) >= REMEMBERED:
                self._old, self._young = self._young, {}
            self._young[piece] = ids
        return ids

    def _unit(self, unit: str) -> bytes:
        """Ids of a run without blanks; only its pieces are remembered."""
        if unit.isalpha():
            return self._word(unit)
        word = unit[:-1]
        if unit[-1:] in _SIGNS and word.isalpha():
            return self._word(word) + self._word(unit[-1])
        return b"".join([self._word(p) for p in _PIECES(unit)])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; a run without blanks is looked up once however often these texts hold it."""
        flats, whole = [], {}
        for i, text in enumerate(texts):
            flat = text.replace("\n", " ").replace("\t", " ")
            if not flat.isprintable() or any(x in flat for x in self._special):
                whole[i] = array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
                flats.append("")
                continue
            flat = unicodedata.normalize("NFC", flat)
            # Only the sigma's lower case depends on its neighbours.
            flats.append("".join([c.lower() for c in flat]) if "\u03a3" in flat else flat.lower())
        parts = pc.split_pattern(pa.array(flats, pa.large_string()), " ")
        units = parts.values.dictionary_encode()
        each = [self._unit(u) for u in units.dictionary.to_numpy(zero_copy_only=False)]
        ids = np.frombuffer(b"".join(each), "<u4")
        sizes = np.array([len(x) for x in each], np.int64) // 4
        firsts = np.cumsum(sizes) - sizes
        unit = units.indices.to_numpy()
        size = sizes[unit]
        ends = np.concatenate(([0], np.cumsum(size)))
        flat_ids = ids[np.arange(ends[-1]) + np.repeat(firsts[unit] - ends[:-1], size)]
        cuts = ends[parts.offsets.to_numpy()]
        return [whole[i] if i in whole else flat_ids[a:b].tobytes() for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


_loaded: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


_SHARD = "part int, shard int, doc_ids array<long>, ends array<long>, n long, zeros array<long>, planes array<binary>"


def write_shards(docs: DataFrame, tokenizer_path: str, path: str) -> None:
    """Encode every text of ``docs`` (``doc_id``, ``text``), end it with END and write the shards to ``path``."""
    end = END.to_bytes(4, "little")

    def run(batches):
        enc, part = _encoder(tokenizer_path), TaskContext.get().partitionId()
        shard, names, ends, data, size = 0, [], [], [], 0

        def close():
            ids = np.frombuffer(b"".join(data), "<u4")
            zeros, planes = WaveletMatrix.build(ids)
            return pa.record_batch({
                "part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()),
                "doc_ids": pa.array([names], pa.list_(pa.int64())), "ends": pa.array([ends], pa.list_(pa.int64())),
                "n": pa.array([len(ids)], pa.int64()), "zeros": pa.array([zeros], pa.list_(pa.int64())),
                "planes": pa.array([planes], pa.list_(pa.binary()))})

        for batch in small(batches, 1 << 22):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc, ids in zip(batch.column("doc_id").to_pylist(), enc.encode_all(texts), strict=True):
                ids += end
                names.append(doc)
                size += len(ids) // 4
                ends.append(size)
                data.append(ids)
                if size >= SHARD_TOKENS:
                    yield close()
                    shard, names, ends, data, size = shard + 1, [], [], [], 0
        if names:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    ordered.mapInArrow(run, _SHARD).write.option("compression", "none").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32, place)`` of every document from the files at ``path``.

    Only the shards' sizes are summed in order; a shard's ids are unpacked where it is read.
    """
    shards = spark.read.schema(_SHARD).parquet(path)
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select("part", "shard", "n").select(
        "part", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = WaveletMatrix(row["n"], row["zeros"], row["planes"]).unpack().astype("<u4")
                ends = np.array(row["ends"], np.int64)
                starts = np.concatenate(([0], ends[:-1]))
                yield pa.record_batch({
                    "part": pa.array([row["part"]] * len(ends), pa.int32()), "shard": pa.array([row["shard"]] * len(ends), pa.int32()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()), "within": pa.array(starts), "n_tokens": pa.array(ends - starts),
                    "ids_crc32": pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)], pa.int64())})

    read = shards.mapInArrow(run, "part int, shard int, doc_id long, within long, n_tokens long, ids_crc32 long")
    return read.join(offsets, ["part", "shard"]).select(
        "doc_id", (F.col("offset") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
