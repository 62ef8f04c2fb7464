"""Byte-level BPE by a priority queue of merge ranks over a doubly linked list.

The tokenizer file gives the vocabulary, the merges and the special strings. A
text is cut at special strings and then into pre-tokens; the symbols of a
pre-token form a doubly linked list, all adjacent pairs with a merge wait in a
heap by (rank, place), and entries whose symbols have changed since are skipped
when they surface. Decoding concatenates the vocabulary's byte strings.

Encoded pre-tokens are remembered in two generations of a dictionary that is bounded
by the bytes it holds, so frequent words cost one look-up and memory stays flat however
many or long the words are.

Edge cases: null text is empty and has no ids; special strings inside a text
become their ids; bytes that are no valid UTF-8 after decoding become U+FFFD.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from seriesrel.llm.text import small

# Fixed values of the byte-level format: the pre-token pattern, and the printable
# characters that stand for themselves; the other bytes follow from U+0100 on.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
REMEMBERED, SLOT = 32 << 20, 32      # bytes of a generation: words, their ids and a dictionary's slot for each
LARGEST = REMEMBERED // 16           # a larger entry would push out too many others


def byte_characters() -> dict[int, str]:
    rest = [b for b in range(256) if b not in set(PRINTABLE)]
    return {b: chr(b) for b in PRINTABLE} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class ByteBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = byte_characters()
        byte_of = {c: b for b, c in chars.items()}
        vocab = spec["model"]["vocab"]
        self.first = [vocab[chars[b]] for b in range(256)]
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merge[vocab[a], vocab[b]] = rank, vocab[a + b]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: bytes(byte_of[c] for c in s) for s, i in vocab.items()}
        self.strings |= {i: s.encode() for s, i in self.special.items()}
        self._split = regex.compile(PRETOKEN).findall
        longest = sorted(self.special, key=len, reverse=True)
        self._cut = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")").split if longest else None
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._held = 0               # bytes of the young ones

    def merge_word(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        symbols = [self.first[b] for b in data]
        n = len(symbols)
        if n < 2:
            return symbols
        merge, push, pop = self.merge.get, heapq.heappush, heapq.heappop
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = merge((symbols[i], symbols[i + 1]))
            if found:
                heap.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
        heapq.heapify(heap)
        while heap:
            _, i, left, right, made = pop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue                                   # stale
            symbols[i], symbols[j] = made, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = merge((made, symbols[k]))
                if found:
                    push(heap, (found[0], i, made, symbols[k], found[1]))
            h = before[i]
            if h >= 0:
                found = merge((symbols[h], made))
                if found:
                    push(heap, (found[0], h, symbols[h], made, found[1]))
        return [s for s in symbols if s >= 0]

    def _new(self, word: str) -> bytes:
        ids = self._old.get(word)
        if ids is None:
            ids = np.array(self.merge_word(word.encode("utf-8", "surrogatepass")), "<u4").tobytes()
        size = sys.getsizeof(word) + sys.getsizeof(ids) + SLOT
        if size > LARGEST:
            return ids
        if self._held + size > REMEMBERED:
            self._old, self._young, self._held = self._young, {}, 0
        self._young[word] = ids
        self._held += size
        return ids

    def _plain(self, text: str) -> bytes:
        known, new = self._young.get, self._new
        return b"".join([known(w) or new(w) for w in self._split(text)])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self._cut is None or not any(s in text for s in self.special):
            return self._plain(text)
        return b"".join(self.special[p].to_bytes(4, "little") if p in self.special else self._plain(p)
                        for p in self._cut(text) if p)

    def decode(self, ids: bytes) -> str:
        strings = self.strings
        return b"".join([strings[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


_loaded: dict[str, ByteBpe] = {}


def tokenizer(path: str) -> ByteBpe:
    """One tokenizer per worker process and file."""
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``ids`` (binary: unsigned 32-bit little-endian) and ``n_tokens``; other columns stay."""
    keep = [c for c in docs.columns if c not in ("ids", "n_tokens")]
    schema = docs.select(*keep).schema.add("ids", "binary").add("n_tokens", "long")

    def run(batches):
        bpe = tokenizer(path)
        for batch in small(batches):
            ids = [bpe.encode(t or "") for t in batch.column("text").to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())],
                                  names=[*batch.schema.names, "ids", "n_tokens"])

    return docs.select(*keep).mapInArrow(run, schema)


def decode(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with ``decoded`` from ``ids``."""
    schema = StructType([*rows.schema.fields, StructField("decoded", StringType())])

    def run(batches):
        bpe = tokenizer(path)
        for batch in batches:
            texts = [None if x is None else bpe.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return rows.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of encoding and decoding each whole text."""
    def run(batches):
        bpe = tokenizer(path)
        for batch in small(batches):
            n, a, b = [], [], []
            for text in batch.column("text").to_pylist():
                ids = bpe.encode(text or "")
                n.append(len(ids) // 4)
                a.append(hashlib.sha256(ids).hexdigest())
                b.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "n_tokens": pa.array(n, pa.int64()),
                                   "ids_sha256": pa.array(a, pa.string()), "decoded_sha256": pa.array(b, pa.string())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded_documents(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, lang, source, n_tokens, token_ids, decoded_sha256)``: a token file's rows, checked by decoding.

    ``lang`` and ``source`` are carried along if ``docs`` has them; other columns are not read.
    A plain function of the text moves a hundred rows at once, where an Arrow batch holds
    10,000 whole texts in the executor's and the worker's memory.
    """
    carried = [c for c in ("doc_id", "lang", "source") if c in docs.columns]

    @F.udf("n_tokens long, token_ids binary, decoded_sha256 string", useArrow=False)
    def encoded(text):
        bpe = tokenizer(path)
        ids = bpe.encode(text or "")
        return len(ids) // 4, ids, hashlib.sha256(bpe.decode(ids).encode()).hexdigest()

    return docs.select(*carried, encoded("text").alias("encoded")).select(*carried, "encoded.*")
