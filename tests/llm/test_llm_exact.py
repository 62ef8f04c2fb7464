import hashlib
import re
from collections import defaultdict

from llm_cases import DOCS, documents

from seriesrel.llm.exact import exact_dedup, keep_first_copies

ROWS = [(5, "a  b\tc"), (2, "a b c"), (9, "a b c"), (1, None), (3, ""), (7, " "), (8, "\n\t"), (4, "x" * 50_000),
        (6, "x" * 50_000), (10, "a b c "), (2, "a b c"), (None, "a b c"), (11, "only one"), (12, "x" * 49_999 + "y")]


def test_matches_brute_force(spark):
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    want = []
    for text, ids in groups.items():
        keep = min(i for i in ids if i is not None)
        sha, used = hashlib.sha256(text.encode()).hexdigest(), False
        for i in sorted(ids, key=lambda i: (i is None, i)):
            kept = i == keep and not used
            used |= kept
            want.append((i, keep, len(ids), kept, sha))
    got = [tuple(r) for r in exact_dedup(documents(spark, ROWS)).collect()]
    key = lambda r: (str(r[0]), not r[3])
    assert sorted(got, key=key) == sorted(want, key=key)


def test_rows_that_stay_keep_their_columns(spark):
    kept = keep_first_copies(documents(spark, ROWS))
    assert kept.columns == [c.split()[0] for c in DOCS.split(", ")]
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 7, 10, 11, 12]
    nulls = keep_first_copies(documents(spark, [(None, "t"), (None, "t"), (None, "u")]))
    assert sorted(r.text for r in nulls.collect()) == ["t", "u"]


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert exact_dedup(empty).count() == 0
    assert keep_first_copies(empty).count() == 0


def test_clashing_columns_stay(spark):
    from pyspark.sql import functions as F
    docs = documents(spark, ROWS).withColumns({c: F.lit(c) for c in ("_id", "_sha", "_ID_", "_idd", "digest", "copies", "stays", "_text_sha")})
    kept = keep_first_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 7, 10, 11, 12]
