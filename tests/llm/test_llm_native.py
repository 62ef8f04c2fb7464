import datetime as dt
import itertools

from llm_cases import DOCS, documents, prose

from seriesrel.llm import spaced_seeds as S
from seriesrel.llm import url_lists as L


def test_masks_meet_every_window():
    for wrong in itertools.combinations(range(S.WINDOW), S.SUBSTITUTIONS):
        assert any(all(o + i not in wrong for i, c in enumerate(m) if c == "1")
                   for m in S.MASKS for o in range(S.WINDOW - len(m) + 1)), wrong


def test_short_mask_meets_every_window_with_one_substitution():
    m = S.SHORT_MASK
    for n in range(S.TOLERANT, S.WINDOW):
        for wrong in range(n):
            assert any(all(o + i != wrong for i, c in enumerate(m) if c == "1") for o in range(n - len(m) + 1)), (n, wrong)


def brute_leaks(docs, items):
    import re
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = {}
    for d, text in docs:
        w = words(text)
        for i, item in items:
            v = words(item)
            if not v:
                continue
            span = min(len(v), S.WINDOW)
            need = span - S.SUBSTITUTIONS if len(v) >= S.WINDOW else span - 1 if len(v) >= S.TOLERANT else span
            edge = [None] * span                       # words outside the document equal none
            wide = edge + w + edge
            best = max((sum(a == b for a, b in zip(wide[p:p + span], v[q:q + span]))
                        for p in range(len(wide) - span + 1) for q in range(len(v) - span + 1)), default=0)
            if best >= need:
                out[d, i] = max(best, out.get((d, i), 0))
    return out


def test_items_of_every_length(spark):
    """Items of 1 to 13 words: whole, with one and with two words changed, and cut by the document's end."""
    docs, items = [], []
    for n in range(1, 14):
        item = prose(700 + n, n, 10**6)
        items.append((n, " ".join(item)))
        for k, text in enumerate((item, ["x", *item[:n // 2], "gap", *item[n // 2 + 1:], "y"], item[1:], item[:-1],
                                  ["x", "gap", *item[1:-1], "gap", "y"], ["x", *item[::-1]])):
            docs.append((100 * n + k, " ".join(text)))
    want = brute_leaks(docs, items)
    assert {n for _, n in want} == set(range(1, 14)) and (801, 8) in want and (701, 7) not in want
    for limit in (S.BROADCAST_SEEDS, 0):
        got = S.decontaminate(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string"), limit)
        assert {(r.doc_id, r.item_id): r.matched for r in got.collect()} == want


def leak_case():
    item = prose(50, 40)
    hole = lambda words, *at: [("gap" if k in at else w) for k, w in enumerate(words)]
    noise = prose(51, 60)
    docs = [(1, noise + item + noise), (2, noise + item[10:23] + noise), (3, noise + hole(item[10:23], 3, 7) + noise),
            (4, noise + hole(item[10:23], 1, 5, 9) + noise), (5, item[:12]), (6, noise), (7, prose(52, 7)),
            (8, hole(prose(52, 7), 2)), (9, prose(53, 4)), (1, noise + item + noise), (12, item[-13:]), (13, hole(item, *range(0, 40, 4)))]
    docs = [(d, " ".join(w)) for d, w in docs] + [(10, None), (11, ""), (14, " ".join(prose(60, 30_000)) + ", " + " ".join(item).upper() + "!")]
    items = [(1, " ".join(item)), (1, " ".join(item)), (2, " ".join(prose(52, 7))), (3, " ".join(prose(53, 4))), (4, None), (5, ""), (6, " ".join(item[5:25]))]
    return docs, items


def test_leaks_match_brute_force_on_both_paths(spark):
    docs, items = leak_case()
    want = brute_leaks(docs, items)
    frame, bench = documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    assert {(1, 1), (2, 1), (3, 1), (7, 2), (12, 1), (14, 1)} <= set(want) and (4, 1) not in want
    for limit in (S.BROADCAST_SEEDS, 0):
        got = {(r.doc_id, r.item_id): r.matched for r in S.decontaminate(frame, bench, limit).collect()}
        assert got == want
    kept = S.remove_leaks(frame, bench)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_empty_benchmark_and_documents(spark):
    docs, items = leak_case()
    none = spark.createDataFrame([], "item_id long, text string")
    assert S.decontaminate(documents(spark, docs), none).count() == 0
    assert S.decontaminate(spark.createDataFrame([], DOCS), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


ENTRIES = [("a", "x.org", "block", day(1)), ("a", "x.org", "unlist", day(5)), ("a", "x.org", "block", day(9)), ("a", "x.org", "block", day(9)),
           ("a", "www.x.org", "allow", day(3)), ("b", "www.x.org/en", "block", day(2)), ("b", None, "block", day(2)), ("b", "z.org", "block", None),
           ("c", "x.org", "block", day(4)), ("c", "x.org", "allow", day(4))]


def brute_filter(url, when):
    import re
    m = re.match(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", url or "")
    host = m[1].lower() if m else ""
    s = re.match(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]+/([^/?#]+)", url or "")
    parts = host.split(".")
    keys = {".".join(parts[i:]) for i in range(max(len(parts) - 1, 1))} if host else set()
    if s and host:
        keys.add(f"{host}/{s[1]}")
    rank = {"unlist": 0, "block": 1, "allow": 2}
    state = {}
    for lst, pattern, action, at in sorted((e for e in ENTRIES if e[1] and e[3]), key=lambda e: (e[3], rank[e[2]])):
        if when and at <= when and pattern in keys:
            state[lst, pattern] = action
    active = {k: v for k, v in state.items() if v != "unlist"}
    blocked = []
    for lst in {k[0] for k in active}:
        top = max((len(p), p) for q, p in active if q == lst)[1]
        if active[lst, top] == "block":
            blocked.append(f"{lst}:{top}")
    return len(active), ",".join(sorted(blocked)), bool(blocked)


def test_url_lists_match_brute_force(spark):
    urls = ["http://www.x.org/en/1", "https://X.org", "//m.x.org:80/es?q", "http://u:p@www.x.org/en", "x.org/no-scheme", None, "", "http://z.org/", "http://org/", "http://www.x.org/en/1"]
    caps = [(i, u, day(d) if d is not None else None) for i, u in enumerate(urls) for d in (0, 1, 2, 3, 4, 5, 6, 9, 30, None)]
    frame = spark.createDataFrame([(*c, "extra") for c in caps], "page_id long, url string, fetched timestamp, pattern string")
    entries = spark.createDataFrame(ENTRIES, "list_name string, pattern string, action string, effective timestamp")
    got = sorted(((r.page_id, str(r.fetched), (r.n_active, r.decided_by, r.blocked)) for r in L.filter_urls(frame, entries).collect()))
    assert got == sorted((i, str(w), brute_filter(u, w)) for i, u, w in caps)


def test_url_lists_empty(spark):
    caps = spark.createDataFrame([], "page_id long, url string, fetched timestamp")
    entries = spark.createDataFrame([], "list_name string, pattern string, action string, effective timestamp")
    assert L.filter_urls(caps, entries).count() == 0
    one = spark.createDataFrame([(None, None, None)], "page_id long, url string, fetched timestamp")
    assert [tuple(r) for r in L.filter_urls(one, entries).collect()] == [(None, None, None, 0, "", False)]
    pages = spark.createDataFrame([(1, "http://a.example.org/en", None), (None, None, None)], "page_id long, url string, html string")
    assert L.dated_entries(pages).count() > 0
