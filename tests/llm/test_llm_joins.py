"""Operators 11 to 13 against plain loops."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_cases import DOCS, by_id, documents, edited, prose

from conftest import SF_SMALL
from seriesrel.llm import group_prefix as G
from seriesrel.llm import pivotal_grams as S
from seriesrel.llm import queries
from seriesrel.llm import token_links as K
from seriesrel.llm.perfect_hash import PerfectHash

A, B = (public_tokenizers.path(n) for n in (queries.BYTE_BPE, queries.PIECES))


def frame_rows(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]


# ------------------------------------------------------- grouped prefix join --
def runs(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))} if w else set()


def brute_components(rows):
    sets, parent = [runs(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_run = defaultdict(list)
    for i, s in enumerate(sets):
        for r in s:
            by_run[r].append(i)
    for i, s in enumerate(sets):
        for j, both in Counter(j for r in s for j in by_run[r] if j < i).items():
            if 100 * both >= 90 * (len(s) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def components_of(frame):
    return sorted(tuple(r) for r in G.link_classes(frame).select("doc_id", "n_shingles", "component_id").collect())


def test_join_matches_brute_force(spark):
    rows, n = [], 0
    for g in range(15):                                # families at and around the threshold
        base = prose(g, 20 + 25 * g)
        for k, share in enumerate((0, 0, 0.004, 0.008, 0.012, 0.02, 0.03)):
            rows.append((n * 11 % 2003, " ".join(edited(base, 60 * g + k, share))))
            n += 1
    words = [prose(40, 90)]                            # many variants of variants, no one centre
    for k in range(250):
        words.append(edited(words[random.Random(k).randrange(len(words))] if k % 2 else words[0], 7000 + k, random.Random(k).random() * 0.03))
        rows.append((5000 - k, " ".join(words[-1])))
    common = prose(41, 60)                             # a passage in very many documents
    rows += [(6000 + k, " ".join(common + prose(8000 + k, 8))) for k in range(150)]
    rows += [(9000, ""), (9001, None), (9002, " \t\n"), (9003, "one two"), (9004, "One\x0btwo"), (9005, "two one"), (9006, "one"), (9007, "ONE"),
             (9008, "la " * 400), (9009, "la " * 300), (9010, "É é x"), (9011, "é é x"), (9003, "one two"), (9012, " ".join(prose(3, 20_000))),
             (9013, " ".join(edited(prose(3, 20_000), 4, 0.01)))]
    assert components_of(documents(spark, rows)) == brute_components(rows)


def test_exact_boundary(spark):
    # 20 runs, of which one or two differ: 19 / 21 is linked, 18 / 22 is not; 9 of 10 is linked, 8 of 9 not.
    w = [f"t{i}" for i in range(22)]
    rows = [(1, " ".join(w)), (2, " ".join([*w[:-1], "x"])), (3, " ".join(["y", *w[1:-1], "z"])), (4, " ".join(w[:11])), (5, " ".join(w[:12])), (6, " ".join(w[:10]))]
    assert components_of(documents(spark, rows)) == brute_components(rows)


def test_join_of_a_table_and_of_none(spark):
    rows = frame_rows(spark)
    assert components_of(documents(spark, rows)) == brute_components(rows)
    assert G.link_classes(spark.createDataFrame([], DOCS)).count() == 0
    nulls = G.link_classes(documents(spark, [(None, "a b c d"), (None, "a b c d"), (4, "a b c d")])).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in nulls) == [(0, 2, 0), (0, 2, 0), (4, 2, 4)]


def test_order_of_runs_does_not_matter(spark, monkeypatch):
    """Any classes give the same components, and so does doing without extra pivots."""
    rows = [(k, " ".join(edited(prose(1, 80), k, 0.02 * (k % 3)))) for k in range(60)]
    want = brute_components(rows)
    monkeypatch.setattr(G, "PIVOTS", 1)
    monkeypatch.setattr(G, "run_classes", lambda docs: np.random.default_rng(5).integers(0, 9, G.BUCKETS).astype(np.uint8))
    assert components_of(documents(spark, rows)) == want


def outside_the_prefix(words, places, tag):
    """``words`` with another word at each place, so that the 21 least of their 200 runs stay as they are."""
    def prefix(w):
        return sorted(h >> G.U(8) for h in G.run_sets([" ".join(w).encode()])[1])[:21]

    for i in places:
        words = next(w for w in ([*words[:i], f"{tag}{i}x{k}", *words[i + 1:]] for k in range(1000)) if prefix(w) == prefix(words))
    return words


@pytest.mark.parametrize("more", [0, 1])
def test_members_link_where_the_first_of_their_groups_do_not(spark, more):
    # 190 of 200 runs must be common, a word changed is three runs: three changes link, four do not.
    base = [f"w{i}" for i in range(202)]
    h = G.run_sets([" ".join(base).encode()])[1]
    least = {x >> G.U(8) for x in sorted(h, key=lambda x: x >> G.U(8))[:21]}
    held = [k for k in range(200) if G.run_sets([" ".join(base[k:k + 3]).encode()])[1][0] >> G.U(8) in least]
    free = [i for i in range(10, 190) if not any(k in held for k in range(i - 2, i + 1))]
    free = free[::6]
    first, inner = outside_the_prefix(base, free[:3], "a"), next(i for i in range(10, 190) if i in held)
    other = [*base[:inner], "inside", *base[inner + 1:]]
    rows = [(1, " ".join(first)), (2, " ".join(base)), (3, " ".join(outside_the_prefix(other, free[4:6], "b")))]
    if more:                                           # a second member on the other side too
        rows.append((4, " ".join(outside_the_prefix(outside_the_prefix(other, free[4:6], "b"), free[7:8], "c"))))
    signed = {r.doc_id: (r.n, r.g1, r.g2) for r in G.prefixes(documents(spark, rows), np.zeros(G.BUCKETS, np.uint8)).collect()}
    assert signed[1] == signed[2] != signed[3]
    want = brute_components(rows)
    assert {c for *_, c in want} == {1} and components_of(documents(spark, rows)) == want


# ------------------------------------------------------------ pivotal grams --
def brute_words(rows):
    words = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def brute_forms(rows):
    words = brute_words(rows)
    masked = defaultdict(set)                          # words at one edit share a word with one letter left out or masked
    for w in words:
        for i in range(len(w)):
            masked[w[:i] + "?" + w[i + 1:]].add(w)
            masked[w[:i] + w[i + 1:]].add(w)
        masked[w].add(w)
    near = defaultdict(set)
    for group in masked.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def forms_of(frame):
    return sorted(tuple(r) for r in S.spelling_forms(frame).collect())


def test_forms_match_brute_force_on_a_table(spark):
    rows = frame_rows(spark)
    got = forms_of(documents(spark, rows))
    assert got == brute_forms(rows) and sum(r[4] > 0 for r in got) > 100


def test_forms_of_hard_words(spark):
    r = random.Random(3)
    base = ["".join(r.choice("abcd") for _ in range(r.randrange(7, 10))) for _ in range(60)]      # few letters: many near words and equal bigrams
    base += ["aaaaaaa", "aaaaaaaa", "abababab", "bababab", "ÀÉÎÕÜ÷×ß", "àéîõüøþß", "STRASSEN", "strassén"]
    words = base + ["".join(w[:i] + r.choice("abcdé") + w[i + r.randrange(2):] for i in [r.randrange(len(w))]) for w in base for _ in range(6)]
    chain = ["variant"] * 2000 + ["variantt"] * 150 + ["variantto"] * 12 + ["variattto"] * 2
    rows = [(k, " ".join(r.choice(words) for _ in range(300)) + "." + " ".join(chain[k::40]).upper()) for k in range(40)]
    rows += [(None, "variants variants"), (7, ""), (8, None), (3, "nächster " * 20_000), (3, "nächster")]
    want = brute_forms(rows)
    assert forms_of(documents(spark, rows)) == want
    assert {w: root for w, _, root, *_ in want}["variantto"] == "variant"


def test_pivots_are_disjoint_and_cheapest():
    r = random.Random(9)
    for _ in range(300):
        word = "".join(r.choice("abc") for _ in range(r.randrange(7, 14)))
        order = {g: (r.randrange(1, 6), g) for g in S.grams(word)}
        prefix, (i, j) = S.prefix_and_pivots(word, order)
        cost = lambda a, b: order[S.grams(word)[a]][0] + order[S.grams(word)[b]][0]
        assert j - i >= 2 and {i, j} <= set(prefix)
        assert cost(i, j) == min(cost(a, b) for a in prefix for b in prefix if b - a >= 2)


def test_no_words(spark):
    assert S.spelling_forms(spark.createDataFrame([], DOCS)).count() == 0
    assert S.spelling_forms(documents(spark, [(1, None), (2, "short words"), (3, "singleton")])).count() == 0


# -------------------------------------------------------------- token links --
def brute_links(rows):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    out, counts = [], Counter()
    for d, text in rows:
        whole, groups, pairs = " " + (text or ""), [], []
        ia, ib = (a.encode(whole, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        ta = [K.aligner(A, B).bytes_a[i] for i in ia]
        tb = [K.aligner(A, B).bytes_b[i] for i in ib]
        if b"".join(ta) != whole.encode() or b"".join(tb) != whole.encode():
            ia, ib = [], []
        ends_a, ends_b = (np.cumsum([len(x) for x in t]).tolist() for t in (ta, tb))
        i = j = 0
        while ia and i < len(ia):
            p, q = i, j
            while ends_a[p] != ends_b[q]:
                p, q = (p + 1, q) if ends_a[p] < ends_b[q] else (p, q + 1)
            groups.append(",".join(map(str, ia[i:p + 1])) + "|" + ",".join(map(str, ib[j:q + 1])))
            pairs.append((ia[p], ib[q]))
            i, j = p + 1, q + 1
        counts.update(pairs)
        out.append((d, len(ia), len(ib), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest() if ia else ""))
    top = defaultdict(int)
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    return sorted(((d, n_a, n_b, len(p), len(p), sum(counts[x] == top[x[1]] for x in p), sum(counts[x] for x in p), sha)
                   for d, n_a, n_b, p, sha in out), key=str)


ODD = ["a  b", "  lead", "trail ", "a\nb c\n\nd", "tab\tx y", "x▁y z", "<|endoftext|> here </s> <s>", "<0x41> q", "é́ ff ﬁ １", " nb sp",
       "\x1c a \x1d b", "日本語 \U0001F642 ok", "don't 's it''s", "a 　 b", "  ", "\n", " ", "word , , .", "a\x00b c", "", None, "no" * 30_000]


def test_links_match_a_plain_alignment(spark):
    rows = [*frame_rows(spark)[:120], *enumerate(ODD, 10**6), (None, "null id"), (3, "a  b"), (3, "a  b")]
    got = K.digest(K.links(documents(spark, rows).repartition(5), A, B))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_links(rows)
    assert got.columns == [*K.NAMES[:-1], "groups_sha256"]


def test_texts_are_aligned_once(spark):
    rows = frame_rows(spark)[:40]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = documents(spark, rows).mapInArrow(counted, DOCS)
    assert len(K.digest(K.links(docs, A, B)).collect()) == len(rows)
    assert read.value == len(rows)


def test_joined_pieces_get_the_ids_of_each_alone():
    one, letters = K.aligner(A, B), [chr(c) for c in range(0x250)]
    texts = [t for c in letters for t in (c, f"a{c}", f"{c}1{c}b", f"x{c}{c}.{c}", f"9{c} {c}'s{c}")] + ODD[:-3] + ["naïve,", "Œuvre", "x" * 500]
    texts = [t for t in texts if t]
    assert sum(K._quick(t) is not None for t in texts) > 1000
    ids, counts = one._ids_a(texts, np.array([len(t.encode()) + 1 for t in texts]))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [
        e.ids for e in one.a.encode_batch([" " + t for t in texts], add_special_tokens=False)]


def test_no_texts_to_align(spark):
    assert K.links(spark.createDataFrame([], DOCS), A, B).count() == 0
    none = by_id(K.digest(K.links(documents(spark, [(1, None), (2, ""), (5, "▁")]), A, B)))
    assert all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "") for r in none.values()) and len(none) == 3


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(-(1 << 62), 1 << 62, n))
    table = PerfectHash(keys)
    assert sorted(table.find(keys)) == list(range(len(keys))) and len(table) == len(keys)
    assert (table.find(keys + 1)[~np.isin(keys + 1, keys)] == -1).all()
    if len(keys):
        assert (table.keys[table.find(keys)] == keys).all()


def test_marks_are_cut_off_only_where_no_piece_has_them():
    one = K.aligner(A, B)
    for text in ["one, two. three; four: five! six?", "a,b c,, d ,e f", "x9, y), é, É. z", ",", "it's, don't.", "etc., e.g. i.e., p.m.", "Mr. U.S. www. http: no: o.k."]:
        whole, parts = one.align([text])[0], one.learn(set(one.cut(text)))
        assert whole.shown == ";".join(parts[p].shown for p in one.cut(text)), text
        assert list(whole.codes) == [c for p in one.cut(text) for c in parts[p].codes]
    assert "," in one.marks
