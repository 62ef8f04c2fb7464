import hashlib
import re

import numpy as np
from llm_cases import DOCS, by_id, documents, edited, prose

from conftest import SF_MID
from seriesrel.llm import pii, ppm, quality, queries


def test_language_held_out_accuracy(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    held = [r for r in queries.op9_language_ppm(spark, SF_MID).collect() if r.held_out]
    assert len(held) > 200
    assert np.mean([docs[r.doc_id] == r.lang_pred for r in held]) > 0.99


def brute_bits(text, train, order=3):
    """Code length by walking the contexts of every byte."""
    from math import log2
    counts = {}
    for t in train:
        b = b"\n" * order + t.encode()
        for i in range(order, len(b)):
            for k in range(order + 1):
                own = counts.setdefault(b[i - k:i], {})
                own[b[i]] = own.get(b[i], 0) + 1
    total, b = 0.0, b"\n" * order + text.encode()
    for i in range(order, len(b)):
        for k in range(order, -1, -1):
            own = counts.get(b[i - k:i])
            if not own:
                continue
            n, d = sum(own.values()), len(own)
            if b[i] in own:
                total -= log2(own[b[i]] / (n + d))
                break
            total -= log2(d / (n + d))
        else:
            total += 8
    return total


def test_code_lengths_are_exact(spark):
    a, b = ["the cat sat on the mat", "the hat"], ["le chat est là", "la table"]
    rows = [(i, t, lang) for i, (t, lang) in enumerate([(t, "en") for t in a] + [(t, "fr") for t in b])]
    trees = ppm.Trees(ppm.train(documents(spark, rows)))
    tests = ["the mat", "là-bas", "zzz Ж", "t"]
    want = [[brute_bits(t, a), brute_bits(t, b)] for t in tests]
    assert np.allclose(trees.lengths([t.encode() for t in tests]), want, rtol=1e-5)


def test_language_edge_cases(spark):
    rows = [(1, "the cat", "en"), (2, "le chat", "fr"), (3, None, None), (4, "12 !", "en"), (5, "", "fr"), (None, "the cat", "en"), (1, "the cat", "en"), (6, "the cat " * 20_000, None)]
    docs = documents(spark, rows)
    got = [tuple(r) for r in ppm.identify(docs, ppm.train(docs)).collect()]
    pred = {i: (lang, score) for i, lang, score in got}
    assert len(got) == 8 and pred[1][0] == pred[6][0] == pred[None][0] == "en" and pred[2][0] == "fr"
    assert [pred[i] for i in (3, 4, 5)] == [("und", 0.0)] * 3
    untaught = ppm.identify(docs, ppm.train(docs.where("lang = 'xx'")))
    assert {r.lang_pred for r in untaught.collect()} == {"und"}
    assert ppm.identify(spark.createDataFrame([], DOCS), ppm.train(docs)).count() == 0


def test_quality_held_out(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    held = [r for r in queries.op6_quality_ftrl(spark, SF_MID).collect() if r.held_out and r.doc_id in labels]
    good, bad = ([r.score for r in held if labels[r.doc_id] == y] for y in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95


def test_quality_edge_cases(spark):
    docs = documents(spark, [(1, None), (2, ""), (3, "word"), (3, "word"), (None, "word"), (4, "long text " * 50_000)])
    flat = quality.train(docs.selectExpr("doc_id", "text", "CAST(NULL AS INT) AS label"))
    assert not flat.any()
    assert [r.score for r in quality.score(docs, flat).collect()] == [0.5] * 6
    assert quality.keep_good(docs, flat).columns == docs.columns
    taught = quality.train(docs.selectExpr("doc_id", "text", "CAST(doc_id % 2 AS INT) AS label"))
    assert all(0 <= r.score <= 1 for r in quality.score(docs, taught).collect())
    assert quality.score(spark.createDataFrame([], DOCS), taught).count() == 0


def test_dot_product_equals_counting():
    text = b"One two!! two two 12 | one"
    owner, feature, value = quality.ngrams([b"", text, b"x"])
    assert set(owner) == {1, 2}
    kinds = 5
    assert np.isclose(value[owner == 1].sum(), quality.SCALE * kinds)


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_rules(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            if kind == "email" or (kind == "ip" and all(int(x) < 256 for x in m.group().split("."))) or (
                    kind == "card" and 12 <= len(digits) <= 19 and pii.luhn(digits)) or (kind == "phone" and 9 <= len(digits) <= 15):
                out.append((m.start(), k, m.end(), kind))
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out)]


def pii_texts():
    import random
    r = random.Random(3)
    alphabet = list("ab@@..--+ ()019") + ["a@b.c", "1.2.3.4", "4337166598464399", "+1 (456) 555-2186", "é", "x@y@z.org.", "256.1.1.1.1.1.1.1"]
    return ["", None, "mail bosbt.42@mail8.example.com now", *("".join(r.choices(alphabet, k=r.randrange(40))) for _ in range(600)),
            "1" * 30_000, "a" * 30_000 + "@", "9." * 2000, "word " * 20_000 + "12.34.56.78"]


def test_rules_equal_the_plain_patterns(spark):
    rows = list(enumerate(pii_texts()))
    got = by_id(pii.digest(pii.find_pii(documents(spark, rows), None)))
    for i, t in rows:
        want = plain_rules(t or "")
        counts = tuple(sum(w.startswith(k + ":") for w in want) for k in pii.KINDS)
        assert tuple(got[i])[1:] == (*counts, hashlib.sha256(",".join(want).encode()).hexdigest(), ",".join(want)), ascii((t or "")[:60])


def test_gradients_by_differences():
    r = np.random.default_rng(0)
    x, y = r.integers(0, pii.N_CODES, (3, 7)), r.integers(0, pii.N_TAGS, (3, 7))
    mask = np.arange(7)[None] < np.array([7, 5, 1])[:, None]
    y = np.where(mask, y, 0)
    t = pii.Tagger()
    t.p["move"] = r.normal(0, 0.3, t.p["move"].shape)

    def loss():
        s, move = t.scores(x, mask), t.p["move"]
        total = 0.0
        for i, n in enumerate(mask.sum(1)):
            a, gold = s[i, 0], s[i, 0, y[i, 0]]
            for k in range(1, n):
                a = np.logaddexp.reduce(a[:, None] + move, 0) + s[i, k]
                gold += move[y[i, k - 1], y[i, k]] + s[i, k, y[i, k]]
            total += np.logaddexp.reduce(a) - gold
        return total / len(x)

    grads = t.gradients(x, mask, y)
    for name, g in grads.items():
        at = tuple(r.integers(0, n) for n in g.shape) if name != "emb" else (x[0, 0], 2)
        p = t.p[name]
        p[at] += 1e-5
        up = loss()
        p[at] -= 2e-5
        down = loss()
        p[at] += 1e-5
        assert np.isclose(g[at], (up - down) / 2e-5, rtol=1e-3, atol=1e-6), name


def test_tagger_learns_and_base_spans_stay(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    params = pii.train(docs)
    tagger = pii.Tagger(params)
    texts = [r.text for r in docs.where("text LIKE '%@%'").limit(30).collect()]
    found = pii.tagger_spans(texts, tagger)
    hit = [(a, b, k) in spans for t, spans in zip(texts, found) for a, b, k in pii.rule_spans(t)[0]]
    assert np.mean(hit) > 0.6
    for base, extra in pii.spans(texts, tagger):
        assert not any(a < d and c < b for a, b, _ in base for c, d, _ in extra)
    again = pii.train(docs)
    assert all((params[k] == again[k]).all() for k in params)


def test_long_stretches_and_windows():
    assert pii.windows(0, 50) == [(0, 50)]
    spans = pii.windows(10, 400)
    assert spans[0][0] == 10 and spans[-1][1] == 400
    assert all(b - c >= pii.OVERLAP for (_, b), (c, _) in zip(spans, spans[1:]))
    tagger = pii.Tagger()
    assert len(pii.spans(["7 " * 3000, "", "no digits"], tagger)) == 3


def test_pii_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert pii.train(empty) is None
    assert pii.find_pii(empty, None).count() == 0


def test_fixture_words_are_stable():
    assert edited(prose(1, 5), 2, 0.0) == prose(1, 5)


def test_signs_that_are_no_letters():
    from seriesrel.llm import ppm
    assert not any(ppm._LETTER.search(t) for t in ("²½ ①Ⅷ", "12 + 3", "_ !", ""))
    assert all(ppm._LETTER.search(t) for t in ("a", "1é", "中", "ʰ"))
