"""Personal data: fixed rules plus a character BiLSTM-CRF.

The rules find e-mail addresses, IP numbers, card numbers and telephone numbers in
the whole text. The tagger adds spans that the rules' exact shapes miss. It is a
character-level bidirectional LSTM with CRF transitions, written in numpy and
trained on labelled spans: the windows of a bounded sample (``max_texts``), labelled
by the rules, and as many windows of the same texts with planted values: each kind in
the rules' shape and in odd ones (other separators, prefixes and brackets), and dates,
amounts, versions and impossible numbers that are none. So it learns contexts and
shapes rather than one spelling.

Every place that can hold such data has a digit or an ``@``, so the tagger reads a
window around each of those (``REACH`` characters to both sides, joined where they
meet). Long stretches are cut into overlapping windows; each window is decoded by
Viterbi, a character takes its tag from the window in which it is farthest from an
edge, and spans are read off the reconciled text, widened to whole runs of digits. A
span is added if it overlaps no rule span, its numbers are possible for its kind
(check sum, range, count of digits; an ``@`` in an e-mail address), and no rule of the
same kind refused a value there (12 to 19 digits that fail the check sum, or four
numbers of which one is over 255).

Edge cases: null and empty texts have no spans; repeated rows get equal answers; an
empty table works, and without labelled windows only the rules speak.
"""

from __future__ import annotations

import hashlib
import random
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesrel.llm.text import small

KINDS = ("email", "ip", "card", "phone")
# The rules' patterns. The number patterns are written without backtracking
# (a match can only begin at the start of a run of digits); e-mail addresses are read
# outwards from each "@", which gives the same leftmost matches in linear time.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
PATTERNS = {
    "ip": re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    "card": re.compile(r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
MAX_TEXTS, REACH = 2_000, 24
PLANTED, PER_TEXT = 16, 20           # plantings and windows of each text of the sample
LENGTH, OVERLAP = 96, 32
HIDDEN, EMBEDDED, STEPS, BATCH, RATE = 16, 8, 600, 32, 0.02
_CUE = re.compile(r"[@0-9]")
_DIGIT = re.compile(r"[0-9]")
_NUMBER = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _valid(kind: str, s: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(int(p) <= 255 if len(p) < 8 else int(p.lstrip("0")[:4] or 0) <= 255 for p in s.split("."))
    digits = "".join(_DIGIT.findall(s))
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def _emails(text: str):
    """Places of the e-mail rule's matches."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text[start - 1]):
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def rule_spans(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """``(start, end, kind)`` of the rules by start and kind, and of whole values that they refused."""
    found, refused = [], []
    if not _CUE.search(text):
        return found, refused
    for rank, kind in enumerate(KINDS):
        places = _emails(text) if kind == "email" else (m.span() for m in PATTERNS[kind].finditer(text))
        for a, b in places:
            if _valid(kind, text[a:b]):
                found.append((a, rank, b))
            elif kind == "ip" or (kind == "card" and 12 <= len(_DIGIT.findall(text[a:b])) <= 19):
                refused.append((a, b, kind))
    found.sort()
    return [(a, b, KINDS[r]) for a, r, b in found], refused


def stretches(text: str) -> list[tuple[int, int]]:
    """Places around each digit and ``@``, joined where they meet."""
    out: list[list[int]] = []
    for m in _CUE.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def windows(a: int, b: int) -> list[tuple[int, int]]:
    """Overlapping windows over ``a..b``."""
    step = LENGTH - OVERLAP
    return [(s, min(s + LENGTH, b)) for s in range(a, max(a + 1, b - OVERLAP), step)]


#: Letters share three codes, digits one; ASCII signs have their own.
N_CODES = 40
_SIGNS = "@.+-_%() \t\n:/,;=#*!?\"'[]<>{}|&$~"


def codes(text: str) -> np.ndarray:
    table = {c: i + 5 for i, c in enumerate(_SIGNS)}
    return np.array([table.get(c) or (1 if "0" <= c <= "9" else 2 if c.islower() else 3 if c.isalpha() else 4) for c in text], np.int64)


N_TAGS = 1 + 2 * len(KINDS)          # outside, then begin and inside of each kind


def tags_of(length: int, spans) -> np.ndarray:
    out = np.zeros(length, np.int64)
    for a, b, kind in spans:
        k = 1 + 2 * KINDS.index(kind)
        if a < 0 or b > length or out[a:b].any():
            continue
        out[a], out[a + 1:b] = k, k + 1
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Tagger:
    """Embedding, one LSTM per direction, a linear layer and CRF transitions; all arrays in ``p``."""

    def __init__(self, p: dict[str, np.ndarray] | None = None, seed: int = 5):
        r = np.random.default_rng(seed)
        make = lambda *s: r.normal(0, 1 / np.sqrt(s[0]), s)
        self.p = p or {"emb": r.normal(0, 0.3, (N_CODES, EMBEDDED)),
                       **{f"w{d}": make(EMBEDDED + HIDDEN, 4 * HIDDEN) for d in "fb"},
                       **{f"c{d}": np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN) for d in "fb"},
                       "out": make(2 * HIDDEN, N_TAGS), "bias": np.zeros(N_TAGS), "move": np.zeros((N_TAGS, N_TAGS))}

    def _lstm(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        n, length, _ = x.shape
        w, c0 = self.p["w" + d], self.p["c" + d]
        h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        out = np.zeros((n, length, HIDDEN))
        for t in range(length) if d == "f" else range(length - 1, -1, -1):
            xin = np.concatenate((x[:, t], h), 1)
            a = xin @ w + c0
            i, f, o = (_sigmoid(a[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(a[:, 3 * HIDDEN:])
            m = mask[:, t, None]
            c_new = f * c + i * g
            tc = np.tanh(c_new)
            h_new = o * tc
            if keep is not None:
                keep.append((t, xin, i, f, o, g, c, tc, m))
            c, h = np.where(m, c_new, c), np.where(m, h_new, h)
            out[:, t] = h
        return out

    def scores(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        e = self.p["emb"][x]
        kept = {"f": [], "b": []}
        hidden = np.concatenate([self._lstm(e, mask, d, kept[d] if keep is not None else None) for d in "fb"], 2)
        if keep is not None:
            keep.update(kept, hidden=hidden)
        return hidden @ self.p["out"] + self.p["bias"]

    def viterbi(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        s, move = self.scores(x, mask), self.p["move"]
        n, length, _ = s.shape
        best, back = s[:, 0], np.zeros((length, n, N_TAGS), np.int64)
        for t in range(1, length):
            v = best[:, :, None] + move
            back[t] = v.argmax(1)
            m = mask[:, t, None]
            back[t] = np.where(m, back[t], np.arange(N_TAGS))
            best = np.where(m, v.max(1) + s[:, t], best)
        tag = np.zeros((n, length), np.int64)
        tag[:, -1] = best.argmax(1)
        for t in range(length - 1, 0, -1):
            tag[:, t - 1] = back[t][np.arange(n), tag[:, t]]
        return tag

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        keep: dict = {}
        s, move = self.scores(x, mask, keep), self.p["move"]
        n, length, k = s.shape
        rows = np.arange(n)
        lse = lambda v, axis: (top := v.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(v - top).sum(axis))
        alpha, beta = np.zeros((length, n, k)), np.zeros((length, n, k))
        alpha[0] = s[:, 0]
        for t in range(1, length):
            alpha[t] = np.where(mask[:, t, None], lse(alpha[t - 1][:, :, None] + move, 1) + s[:, t], alpha[t - 1])
        total = lse(alpha[-1], 1)
        for t in range(length - 2, -1, -1):
            beta[t] = np.where(mask[:, t + 1, None], lse(move + (s[:, t + 1] + beta[t + 1])[:, None, :], 2), beta[t + 1])
        ds = np.exp(alpha + beta - total[None, :, None]).transpose(1, 0, 2)
        ds[rows[:, None], np.arange(length), y] -= 1
        ds *= mask[:, :, None] / n
        dmove = np.zeros_like(move)
        for t in range(1, length):
            m = mask[:, t]
            both = np.exp(alpha[t - 1][:, :, None] + move + (s[:, t] + beta[t])[:, None, :] - total[:, None, None])
            dmove += both[m].sum(0)
            np.add.at(dmove, (y[m, t - 1], y[m, t]), -1)
        g = {"move": dmove / n, "out": np.einsum("ntk,ntj->kj", keep["hidden"], ds), "bias": ds.sum((0, 1)),
             "emb": np.zeros_like(self.p["emb"])}
        dh_all = ds @ self.p["out"].T
        for j, d in enumerate("fb"):
            w = self.p["w" + d]
            dw, db = np.zeros_like(w), np.zeros(4 * HIDDEN)
            dh, dc = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
            for t, xin, i, f, o, gg, c, tc, m in reversed(keep[d]):
                dh = dh + dh_all[:, t, j * HIDDEN:(j + 1) * HIDDEN]
                dhm, dcm = np.where(m, dh, 0), np.where(m, dc, 0)
                dct = dcm + dhm * o * (1 - tc * tc)
                da = np.concatenate((dct * gg * i * (1 - i), dct * c * f * (1 - f), dhm * tc * o * (1 - o), dct * i * (1 - gg * gg)), 1)
                dw += xin.T @ da
                db += da.sum(0)
                dx = da @ w.T
                np.add.at(g["emb"], x[:, t], dx[:, :EMBEDDED])
                dh, dc = np.where(m, dx[:, EMBEDDED:], dh), np.where(m, dct * f, dc)
            g["w" + d], g["c" + d] = dw, db
        return g

    def fit(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray, steps: int = STEPS) -> Tagger:
        """Adam over shuffled batches, for ``steps`` batches or the whole of the last pass."""
        m1 = {k: np.zeros_like(v) for k, v in self.p.items()}
        m2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for epoch in range(-(-steps // -(-len(x) // BATCH))):
            order = np.random.default_rng(epoch).permutation(len(x))
            for at in range(0, len(x), BATCH):
                some = order[at:at + BATCH]
                step += 1
                for k, g in self.gradients(x[some], mask[some], y[some]).items():
                    g = np.clip(g, -1, 1)
                    m1[k] = 0.9 * m1[k] + 0.1 * g
                    m2[k] = 0.999 * m2[k] + 0.001 * g * g
                    self.p[k] -= RATE * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)
        return self


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    x, mask = np.zeros((len(rows), LENGTH), np.int64), np.zeros((len(rows), LENGTH), bool)
    for i, r in enumerate(rows):
        x[i, :len(r)], mask[i, :len(r)] = r, True
    return x, mask


def _grouped(digits: str, sizes, sep: str) -> str:
    parts, at = [], 0
    for n in sizes:
        parts.append(digits[at:at + n])
        at += n
    return sep.join(p for p in [*parts, digits[at:]] if p)


def _digits(r: random.Random, n: int) -> str:
    return str(r.randint(1, 9)) + "".join(r.choices("0123456789", k=n - 1))


def _card(r: random.Random, good: bool = True) -> str:
    head = _digits(r, r.choice((14, 15, 15, 15, 18)))
    return next(head + c for c in "0123456789" if luhn(head + c) == good)


def _word(r: random.Random) -> str:
    return "".join(r.choices("abcdefghijklmnoprstuvwz", k=r.randint(2, 8)))


def odd_value(kind: str, r: random.Random) -> str:
    """A value of ``kind`` in one of many spellings, the rules' own among them."""
    if kind == "email":
        local = _word(r) + r.choice(("", ".", "_", "-")) + r.choice(("", _digits(r, 2), _word(r)))
        at = r.choice(("@", "@", "@", " @ ", "[@]", "(@)"))
        dot = r.choice((".", ".", "[.]", "(.)", " . ", "[dot]", " (dot) "))
        host = _word(r) + r.choice(("", str(r.randint(0, 9))))
        return local + at + (host if r.random() < 0.3 else host + dot + r.choice(("com", "org", "net", "de", "co")))
    if kind == "ip":
        sep = r.choice((".", "[.]", "(.)", "{.}", " . ", ". ", "[dot]", "(dot)", " dot "))
        return sep.join(str(r.randint(0, 255)) for _ in range(4))
    if kind == "card":
        digits = _card(r)
        sizes = (4, 6) if len(digits) == 15 else (4, 4, 4, 4)
        return _grouped(digits, sizes, r.choice((" ", "-", "", ".", ".", "/", "_", ":", "  ", " - ", " . ", ", ")))
    if r.random() < 0.3:
        return f"+{r.randint(1, 99)} ({_digits(r, 3)}) {_digits(r, 3)}{r.choice(' -.')}{_digits(r, 4)}"
    head = r.choice(("", "", "0", "00")) + _digits(r, r.choice((2, 3, 3, 4)))
    rest = _digits(r, r.choice((7, 7, 8)) if len(head) > 2 else 8)
    sep = r.choice((" ", ".", "-", "/", " - ", "."))
    body = _grouped(rest, r.choice(((3,), (3, 2), (2, 2, 2), (4,), (3, 2, 2))), sep)
    return (f"({head})" + r.choice((" ", "", "-")) if r.random() < 0.4 else head + r.choice((sep, sep, "/"))) + body


def other_value(r: random.Random) -> str:
    """A number or sign that is no personal data."""
    n = r.randint
    return r.choice((
        lambda: f"{n(1, 31):02}{(c := r.choice('./-'))}{n(1, 12):02}{c}{n(1950, 2030)}",
        lambda: f"{n(1950, 2030)}-{n(1, 12):02}-{n(1, 31):02}" + r.choice(("", f" {n(0, 23):02}:{n(0, 59):02}:{n(0, 59):02}")),
        lambda: f"{n(0, 23)}:{n(0, 59):02}",
        lambda: r.choice("$ #") + f"{n(1, 999)}{r.choice('.,')}{n(0, 99):02}",
        lambda: f"{n(1, 99)},{n(0, 999):03},{n(0, 999):03}",
        lambda: f"v{n(0, 12)}.{n(0, 30)}" + r.choice(("", f".{n(0, 30)}")),
        lambda: _digits(r, n(1, 8)),
        lambda: f"{n(1, 99)} x {n(1, 99)} = {n(1, 9999)}",
        lambda: f"{n(1950, 2030)}-{n(1950, 2030)}",
        lambda: f"{n(256, 999)}.{n(0, 999)}.{n(0, 999)}.{n(0, 999)}",
        lambda: _grouped(_card(r, False), (4, 4, 4, 4), r.choice((" ", "-", ""))),
        lambda: f"@{_word(r)}",
    ))()


def planted(text: str, r: random.Random) -> tuple[str, list[tuple[int, int, str]]]:
    """Pieces of ``text`` without cues with planted values between them, and the spans of these."""
    at, out, found = r.randrange(len(text)), "", []
    words = [w for w in text[at:at + 400].split() if not _CUE.search(w)] or ["-"]
    for _ in range(r.randint(1, 2)):
        out += " ".join(words[(k := r.randrange(len(words))):k + r.randint(0, 5)]) + r.choice((" ", " ", ": ", " (", ", "))
        kind = r.choice((*KINDS, "phone", "phone", None, None))
        value = odd_value(kind, r) if kind else other_value(r)
        if kind:
            found.append((len(out), len(out) + len(value), kind))
        out += value + r.choice((" ", " ", ". ", ", ", ") "))
    return out + " ".join(words[(k := r.randrange(len(words))):k + 5]), found


def _windows_of(text: str, spans) -> list[tuple[np.ndarray, np.ndarray]]:
    tags = tags_of(len(text), spans)
    return [(codes(text[s:e]), tags[s:e]) for a, b in stretches(text) for s, e in windows(a, b)]


def labelled_windows(text: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Windows of a text with the rules' tags."""
    return _windows_of(text, rule_spans(text)[0])


def planted_windows(text: str, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Windows with planted values between words of the text, ``n`` plantings."""
    r = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    return [w for _ in range(n) for w in _windows_of(*planted(text, r))]


def train(docs: DataFrame, max_texts: int = MAX_TEXTS) -> dict[str, np.ndarray] | None:
    """Parameters from at most ``max_texts`` different texts that have a digit or an ``@``; None if there are none.

    The texts, their windows (``PER_TEXT`` of a text with the rules' tags at most) and the windows
    trained on (twice ``max_texts`` at most) are drawn by hash, each copy of a text once.
    """
    cued = docs.where(F.col("text").rlike("[@0-9]")).select("text", F.xxhash64("text").alias("key"))
    drawn = cued.select("key").distinct().orderBy(F.xxhash64("key"), "key").limit(max_texts)
    some = cued.join(F.broadcast(drawn), "key").groupBy("key").agg(F.min("text").alias("text")).select("text")

    def run(batches):
        for batch in batches:
            for text in batch.column("text").to_pylist():
                own = labelled_windows(text)
                r = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass")))
                own = [own[i] for i in sorted(r.sample(range(len(own)), min(PER_TEXT, len(own))))]
                own += planted_windows(text, PLANTED)
                yield pa.record_batch({"x": pa.array([c.tolist() for c, _ in own], pa.list_(pa.int64())),
                                       "y": pa.array([t.tolist() for _, t in own], pa.list_(pa.int64()))})

    rows = (some.mapInArrow(run, "x array<long>, y array<long>")
            .orderBy(F.xxhash64("x", "y"), "x", "y").limit(2 * max_texts).collect())
    if not rows:
        return None
    x, mask = padded([np.array(r["x"]) for r in rows])
    y, _ = padded([np.array(r["y"]) for r in rows])
    return Tagger().fit(x, mask, y).p


def tagger_spans(texts: list[str], tagger: Tagger) -> list[list[tuple[int, int, str]]]:
    """Spans of the tagger alone for each text."""
    jobs = [(i, s, e, a, b) for i, t in enumerate(texts) for a, b in stretches(t) for s, e in windows(a, b)]
    tags: dict[int, dict[int, tuple[int, int]]] = {}
    for at in range(0, len(jobs), 256):
        some = jobs[at:at + 256]
        x, mask = padded([codes(texts[i][s:e]) for i, s, e, _, _ in some])
        for (i, s, e, a, b), row in zip(some, tagger.viterbi(x, mask), strict=True):
            own = tags.setdefault(i, {})
            for p in range(s, e):
                # Distance to the window's edges that are not edges of the stretch.
                inner = min(p - s if s > a else LENGTH, e - 1 - p if e < b else LENGTH)
                if p not in own or own[p][0] < inner:
                    own[p] = inner, int(row[p - s])
    out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    for i, own in tags.items():
        start = kind = None
        for p in [*sorted(own), -1]:
            tag = own[p][1] if p >= 0 else 0
            if start is not None and (p != last + 1 or tag != 2 * kind + 2):
                out[i].append((start, last + 1, KINDS[kind]))
                start = None
            if tag and start is None:
                start, kind = p, (tag - 1) // 2
            last = p
    return out


def _plausible(kind: str, s: str) -> bool:
    """Whether the numbers of an odd shape are possible for its kind."""
    if kind == "email":
        return "@" in s.strip("@") and len(s) > 4
    if kind == "ip":
        parts = _NUMBER.findall(s)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    return _valid(kind, s)


def _whole(text: str, a: int, b: int) -> tuple[int, int]:
    """The span widened to whole runs of digits."""
    while a and _DIGIT.match(text[a]) and _DIGIT.match(text[a - 1]):
        a -= 1
    while b < len(text) and _DIGIT.match(text[b - 1]) and _DIGIT.match(text[b]):
        b += 1
    return a, b


def spans(texts: list[str], tagger: Tagger | None) -> list[tuple[list, list]]:
    """Per text: the rules' spans, and those that the tagger adds."""
    ruled = [rule_spans(t) for t in texts]
    more = tagger_spans(texts, tagger) if tagger else [[] for _ in texts]
    out = []
    for text, (base, refused), added in zip(texts, ruled, more, strict=True):
        extra, done = [], 0
        for a, b, kind in added:
            a, b = _whole(text, a, b)
            taken = any(a < d and c < b for c, d, _ in base) or any(a < d and c < b and k == kind for c, d, k in refused)
            if a >= done and not taken and _plausible(kind, text[a:b]):
                extra.append((a, b, kind))
                done = b
        out.append((base, extra))
    return out


_ready: dict[str, Tagger] = {}


def find_pii(docs: DataFrame, params: dict[str, np.ndarray] | None) -> DataFrame:
    """``(doc_id, spans array<struct<kind,start,end,base>>)`` of every whole text, in code points."""
    shared, name = docs.sparkSession.sparkContext.broadcast(params), uuid.uuid4().hex
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches):
        if name not in _ready and shared.value:
            _ready.clear()
            _ready[name] = Tagger(shared.value)
        for batch in small(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = []
            for base, extra in spans(texts, _ready.get(name)):
                both = [(a, KINDS.index(k), b, True) for a, b, k in base] + [(a, KINDS.index(k), b, False) for a, b, k in extra]
                rows.append([{"kind": KINDS[k], "start": a, "end": b, "base": own} for a, k, b, own in sorted(both)])
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "spans": pa.array(rows, kind)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean>>")


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(rows: DataFrame) -> DataFrame:
    """``(doc_id, n_<kind>..., base_sha256, spans)`` from :func:`find_pii`."""
    base = F.filter("spans", lambda s: s["base"])
    of_kind = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == F.lit(kind))).cast("long")
    return rows.select("doc_id", *(of_kind(k).alias(f"n_{k}") for k in KINDS),
                       F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def base_digest(text: str) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in rule_spans(text)[0]).encode()).hexdigest()
