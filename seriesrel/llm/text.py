"""Vectorised word scanning shared by the operators that hash words.

A batch of texts becomes flat arrays: one 64-bit hash per word and the number of
the text it belongs to. Word hashes come from one running polynomial sum over the
UTF-8 bytes, so no Python object is made per word. Long texts are cut at white
space into pieces only to bound the working arrays; the words are the same.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
PIECE = 1 << 19                      # bytes scanned at once
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_pows = [np.ones(1, U), np.ones(1, U)]

SPACE, LETTER, UPPER, DIGIT, SYMBOL = range(5)


def byte_classes(symbols_are_words: bool) -> np.ndarray:
    """Class of each byte. All bytes of non-ASCII characters count as letters."""
    t = np.full(256, SYMBOL if symbols_are_words else SPACE, np.uint8)
    t[list(b" \t\n\r\x0b\x0c")] = SPACE
    t[ord("a"):ord("z") + 1] = LETTER
    t[ord("A"):ord("Z") + 1] = LETTER
    t[ord("0"):ord("9") + 1] = DIGIT if symbols_are_words else LETTER
    t[128:] = LETTER
    return t


WORDS = byte_classes(False)          # letters and digits in one word, the rest separates
TOKENS = byte_classes(True)          # letter runs, digit runs and symbol runs


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pows[0]) < n:
        size = max(n, PIECE + 64)
        for i, base in enumerate((_BASE, _INV)):
            p = np.full(size, base, U)
            p[0] = 1
            _pows[i] = np.cumprod(p)
    return _pows[0], _pows[1]


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[int], bytes, list[int]]]:
    """Groups of about PIECE bytes: text numbers, the joined bytes, lengths with the separator."""
    ids: list[int] = []
    parts: list[bytes] = []
    size = 0
    for i, t in enumerate(texts):
        at = 0
        while at < len(t):
            end = len(t)
            if end - at > PIECE:
                cut = re.compile(rb"[ \t\n\r\x0b\x0c]").search(t, at + PIECE)
                end = cut.start() if cut else end
            if parts and size + end - at > PIECE:
                yield ids, b"\n".join(parts) + b"\n", [len(p) + 1 for p in parts]
                ids, parts, size = [], [], 0
            ids.append(i)
            parts.append(t[at:end])
            size += end - at
            at = end
    if parts:
        yield ids, b"\n".join(parts) + b"\n", [len(p) + 1 for p in parts]


def scan(texts: list[bytes], table: np.ndarray, shapes: bool = False):
    """``(hash, owner[, class, upper_at_start, n_upper, n_bytes])`` of all words in text order."""
    out: list[tuple[np.ndarray, ...]] = []
    for ids, data, lens in _pieces(texts):
        b = np.frombuffer(data, np.uint8)
        k = table[b]
        starts = np.concatenate(([0], np.flatnonzero(k[1:] != k[:-1]) + 1))
        ends = np.append(starts[1:], len(b))
        keep = k[starts] != SPACE
        starts, ends = starts[keep], ends[keep]
        pw, inv = _powers(len(b) + 1)
        s = np.zeros(len(b) + 1, U)
        np.cumsum((b + U(1)) * pw[:len(b)], out=s[1:])
        h = mix((s[ends] - s[starts]) * inv[starts] + (ends - starts).astype(U))
        firsts = np.cumsum([0, *lens[:-1]])
        owner = np.asarray(ids, np.int64)[np.searchsorted(firsts, starts, "right") - 1]
        row = (h, owner)
        if shapes:
            up = (b >= 65) & (b <= 90)
            ups = np.concatenate(([0], np.cumsum(up)))
            row += (k[starts], up[starts], ups[ends] - ups[starts], ends - starts)
        out.append(row)
    if not out:
        empty = (np.zeros(0, U), np.zeros(0, np.int64))
        return empty + ((np.zeros(0, np.uint8), np.zeros(0, bool), np.zeros(0, np.int64),
                         np.zeros(0, np.int64)) if shapes else ())
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def unused(df, stem: str) -> str:
    """A column name that ``df`` does not have, whatever its columns are called."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name in taken:
        name += "_"
    return name


def encoded(column, lower: bool = False) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column, null as empty."""
    if lower:
        return [(t or "").lower().encode() for t in column.to_pylist()]
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def small(batches, limit: int = 1 << 21, column: str = "text"):
    """The batches cut into slices of whole rows with about ``limit`` bytes of text, so that memory stays flat."""
    for batch in batches:
        if not batch.num_rows:
            yield batch
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def shingles(texts: list[bytes], width: int = 5, table: np.ndarray = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash and owner of every run of ``width`` words; a shorter text is one shingle of all its words."""
    h, owner = scan(texts, table)
    n = np.bincount(owner, minlength=len(texts))
    first = np.concatenate(([0], np.cumsum(n)))[:-1]
    full = len(h) - width + 1
    out_h, out_o = [], []
    if full > 0:
        inside = owner[:full] == owner[width - 1:]
        acc = np.zeros(full, U)
        for j in range(width):
            acc = acc * U(0xD6E8FEB86659FD93) + h[j:full + j]
        out_h.append(mix(acc[inside]))
        out_o.append(owner[:full][inside])
    short = np.flatnonzero((n > 0) & (n < width))
    for i in short:
        acc = U(n[i])
        with np.errstate(over="ignore"):
            for x in h[first[i]:first[i] + n[i]]:
                acc = acc * U(0xD6E8FEB86659FD93) + x
        out_h.append(mix(np.array([acc], U)))
        out_o.append(np.array([i]))
    if not out_h:
        return np.zeros(0, U), np.zeros(0, np.int64)
    return np.concatenate(out_h), np.concatenate(out_o).astype(np.int64)
