import numpy as np
from llm_cases import by_id, documents
from test_llm_models import brute_bits

from conftest import SF_MID
from seriesrel.llm import html_template, pii, ppm
from seriesrel.llm.html_template import extract

ODD = [("call (030) 123 45 67 today", "(030) 123 45 67", "phone"), ("paid by 4111.1111.1111.1111 then", "4111.1111.1111.1111", "card"),
       ("host 192[.]168[.]1[.]20 is down", "192[.]168[.]1[.]20", "ip"), ("write to bob.42@host please", "bob.42@host", "email")]


def test_odd_shapes_come_out_as_added_spans(spark):
    tagger = pii.Tagger(pii.train(spark.read.parquet(f"{SF_MID}/documents.parquet")))
    for (text, value, kind), (base, extra) in zip(ODD, pii.spans([t for t, _, _ in ODD], tagger)):
        at = text.index(value)
        assert not base and extra == [(at, at + len(value), kind)], text
    refused = ["card 4111 1111 1111 1112 is bad", "4111.1111.1111.1112 no", "ip 300.1.2.900 is bad", "on 12.05.2024 we paid 1,234.50 for 30 units"]
    assert pii.spans(refused, tagger) == [([], [])] * 4


class Says:
    """Stands for a tagger that finds given spans."""


def test_only_whole_values_of_the_same_kind_are_refused(monkeypatch):
    cases = [("x 555.123.4567 y", (2, 14, "phone"), True), ("x 4111.1111.1111.1111 y", (2, 21, "card"), True), ("x 4111.1111.1111.1112 y", (2, 21, "card"), False),
             ("x 4111 1111 1111 1112 y", (2, 21, "card"), False), ("x 192[.]168[.]1[.]20 y", (2, 20, "ip"), True), ("x 192[.]168[.]1[.]320 y", (2, 21, "ip"), False),
             ("x 256.1.1.1 y", (2, 11, "ip"), False), ("x 4111.1111.1111.1111 y", (3, 20, "card"), True)]
    monkeypatch.setattr(pii, "tagger_spans", lambda texts, tagger: [[span] for _, span, _ in cases])
    for (text, (a, b, kind), want), (base, extra) in zip(cases, pii.spans([t for t, _, _ in cases], Says())):
        assert base == [] and [(text[c:d], k) for c, d, k in extra] == ([(text[2:-2], kind)] if want else []), text


def main_texts(spark, pages):
    rows = [(n, f"http://a.example.org/{n}", p) for n, p in enumerate(pages)]
    got = by_id(html_template.extract_main(spark.createDataFrame(rows, "page_id long, url string, html string")), "page_id")
    return [got[n].text for n in range(len(rows))]


def test_inline_furniture_takes_no_other_text_along():
    assert extract("<article><p><a class='share'>Share</a> Real text</p></article>", []) == "Real text"
    assert extract("<article><pre><span class='hljs-comment'># x</span> code</pre><p>Text <span class='ad'>Buy</span></p></article>", []) == "# x code\nText"


def test_ambiguous_words_in_an_article_need_the_template(spark):
    page = "<article><section id='legal'><p>Law {0}</p></section><div class='side-by-side'><p>Pair {0} of words</p></div><p class='form-text'>Form {0}</p>{1}</article>"
    more = "<div class='related'><p><a href='/'>Other story {0}</a></p></div><div class='search'>Find it</div>"
    pages = [f"<body>{page.format(n, more.format(n))}</body>" for n in range(5)]
    assert main_texts(spark, pages) == [f"Law {n}\nPair {n} of words\nForm {n}" for n in range(5)]


def test_main_block_holds_all_parts(spark):
    page = "<body><nav>Menu</nav><div class='content'><h1>Title {0}</h1><p>{1}</p><ul>{2}</ul></div><div class='box'>Same box</div></body>"
    lead = "<body><div class='content'><div class='lead'>Lead {0}</div><div class='body'>{1}</div></div><div class='box'><a href='/'>Link {0}</a></div></body>"
    words = [f"para {n} " * 30 for n in range(4)]
    items = [[f"item {n} {k} of the list" for k in range(90)] for n in range(4)]
    got = main_texts(spark, [page.format(n, words[n], "".join(f"<li>{i}</li>" for i in items[n])) for n in range(4)])
    assert got == ["\n".join([f"Title {n}", words[n].strip(), *items[n]]) for n in range(4)]
    assert main_texts(spark, [lead.format(n, words[n]) for n in range(4)]) == [f"Lead {n}\n{words[n].strip()}" for n in range(4)]
    assert extract("<div>one part</div><section>two parts</section>", []) == "one part\ntwo parts"


def test_fixed_text_in_the_main_slot_is_template(spark):
    page = "<article><h1>Title {0}</h1><div class='x7'>Get our app</div><p>First {0} words of the story.</p>{1}<p>Read more on our site</p></article>"
    pages = [page.format(n, "".join(f"<p>Story {n} {k} goes on</p>" for k in range(n))) for n in range(5)]
    assert main_texts(spark, pages) == ["\n".join([f"Title {n}", f"First {n} words of the story.", *(f"Story {n} {k} goes on" for k in range(n))]) for n in range(5)]
    near = [f"<article><h1>Same</h1><p>Same text of the story.</p><p>Same end of it.</p><p>Copy {n}</p></article>" for n in range(5)]
    assert main_texts(spark, near) == [f"Same\nSame text of the story.\nSame end of it.\nCopy {n}" for n in range(5)]


def test_a_small_language_is_learnt_in_full(spark):
    rows = [(i, f"the cat sat {i}", "en") for i in range(3000)] + [(9000 + i, f"le chien {i}", "fr") for i in range(40)]
    counts = ppm.train(documents(spark, rows), 50)
    runs = lambda lang, text: counts[lang][1][counts[lang][0] == int.from_bytes(text, "big")].sum()
    assert runs("fr", b"chie") == 40 and 10 <= runs("en", b"the ") <= 120


def test_all_counted_contexts_are_kept():
    big = np.random.default_rng(4).integers(33, 127, 100_000).astype(np.uint8).tobytes().decode("latin-1")
    small = "zwölf boxkämpfer jagen viktor"
    counts = {}
    for lang, text in (("big", big), ("small", small)):
        at, b = ppm._codes([text.encode()])
        w = b.astype(np.int64)
        counts[lang] = np.unique((w[at - 3] << 24) | (w[at - 2] << 16) | (w[at - 1] << 8) | w[at], return_counts=True)
    assert len(np.unique(counts["big"][0] >> 8)) > 60_000
    tests = [big[500:560], small[3:20], "zwei kämpfer", "Ж"]
    want = [[brute_bits(t, [big]), brute_bits(t, [small])] for t in tests]
    assert np.allclose(ppm.Trees(counts).lengths([t.encode() for t in tests]), want, rtol=1e-5)


def test_copies_do_not_fill_the_taggers_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pii.Tagger, "fit", lambda self, x, mask, y: seen.append((x, mask)) or self)
    copies = [(i, "same text with the number 4567 in it") for i in range(300)]
    others = [(1000 + i, f"text {i} by user{i}@mail.example.org and more") for i in range(30)]
    pii.train(documents(spark, copies + others), 100)
    x, mask = seen[0]
    copy = pii.labelled_windows(copies[0][1])[0][0]
    assert len(x) <= 200 and sum(mask[i].sum() == len(copy) and (x[i, :len(copy)] == copy).all() for i in range(len(x))) <= 1
    first = pii.train(documents(spark, [(1, " word" * 30 + " 12 ")] + [(2, "".join(f" {n} " + "word " * 30 for n in range(900)))]), 2)
    assert first is not None and len(seen[1][0]) <= 4
