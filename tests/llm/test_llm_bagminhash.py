import random
from collections import Counter

import numpy as np
from llm_cases import DOCS, by_id, documents, edited, prose

from seriesrel.llm import bagminhash as B


def bag(text, width=5):
    import re
    w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
    return Counter(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else Counter()


def weighted_jaccard(a, b):
    common = sum((a & b).values())
    whole = sum((a | b).values())
    return common / whole if whole else 0.0


def brute_classes(rows, threshold=0.8):
    bags = [bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if weighted_jaccard(bags[i], bags[j]) >= threshold or rows[i][0] == rows[j][0]:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: least[find(i)] for i, (d, _) in enumerate(rows)}


def variants():
    rows, n = [], 0
    for g in range(12):
        base = prose(g, 60 + 40 * g)
        for k, share in enumerate((0, 0, 0.005, 0.01, 0.015, 0.02, 0.03, 0.05, 0.1)):
            rows.append((n * 7 % 997, " ".join(edited(base, 100 * g + k, share))))
            n += 1
    base = prose(77, 150)                          # many variants of a text, near and far
    for k in range(120):
        rows.append((2000 - k, " ".join(edited(base, 900 + k, random.Random(k).random() * 0.06))))
    rows += [(3000, ""), (3001, None), (3002, "!!! ..."), (3003, "one two"), (3004, "One, two!"), (3005, "two one"),
             (3006, "la " * 400), (3007, "la " * 390), (3008, "la " * 200), (3003, "one two")]
    return rows


def test_classes_match_brute_force(spark):
    rows = variants()
    got = B.near_classes(documents(spark, rows))
    assert got.count() == len(rows)
    assert {r.doc_id: r.class_id for r in got.collect()} == brute_classes(rows)


def test_estimates_are_unbiased():
    texts = [" ".join(prose(1, 500)), " ".join(edited(prose(1, 500), 5, 0.03)), "la " * 300, "la " * 200]
    _, _, _, reg = B.signatures([t.encode() for t in texts])
    for i, j in ((0, 1), (2, 3)):
        true = weighted_jaccard(bag(texts[i]), bag(texts[j]))
        assert abs((reg[i] == reg[j]).mean() - true) < 5 * np.sqrt(true * (1 - true) / B.REGISTERS)
    assert np.isfinite(reg).all()


def test_exact_overlap():
    a, b = "a b c d e f a b c d e f g", "a b c d e f g h"
    assert B.jaccard([a.encode()], [b.encode()])[0] == weighted_jaccard(bag(a), bag(b))


def test_one_stays(spark):
    base = " ".join(prose(3, 100))
    docs = documents(spark, [(4, base), (3, base + " end"), (8, "other text"), (None, base), (9, None)])
    kept = B.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.select("doc_id").collect()) == [(False, 3), (False, 8), (False, 9), (True, None)]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = by_id(B.components(spark.createDataFrame(chain, "a long, b long")), "node")
    assert {n: r.label for n, r in got.items()} == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_empty_table(spark):
    assert B.near_classes(spark.createDataFrame([], DOCS)).count() == 0


def test_texts_without_words_alone_in_a_slice(spark):
    total, n1, n2, reg = B.signatures([b"", b"!!!"])
    assert not total.any() and np.isinf(reg).all()
    docs = documents(spark, [(5, ""), (6, None), (7, "!!!"), (5, "")]).coalesce(1)
    assert sorted((r.doc_id, r.class_id) for r in B.near_classes(docs).collect()) == [(5, 5), (5, 5), (6, 6), (7, 7)]
    assert B.drop_near_copies(docs).count() == 4


def test_many_variants_of_variants(spark):
    """500 texts, most of them edits of edits: few are linked to any one pivot."""
    words, rows = [prose(5, 120)], []
    for k in range(500):
        base = words[random.Random(k).randrange(len(words))] if k % 3 else words[0]
        words.append(edited(base, 5000 + k, random.Random(k).random() * 0.04))
        rows.append((1000 - k, " ".join(words[-1])))
    assert {r.doc_id: r.class_id for r in B.near_classes(documents(spark, rows)).collect()} == brute_classes(rows)


def test_clashing_columns_stay(spark):
    from pyspark.sql import functions as F
    base = " ".join(prose(3, 100))
    docs = documents(spark, [(4, base), (3, base + " end")]).withColumns({"_gone": F.lit(1), "_GONE_": F.lit(2)})
    kept = B.drop_near_copies(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [3]
