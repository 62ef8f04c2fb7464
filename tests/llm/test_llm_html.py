from llm_cases import by_id

from seriesrel.llm.html_template import extract, extract_main

PAGES = "page_id long, url string, html string, host string"


def site(n, body, extra=""):
    return (f"<html><head><title>T{n}</title><style>p{{}}</style></head><body><header><h2>Site</h2></header><nav><ul><li><a href='/'>Home</a></li></ul></nav>"
            f"{body}<div class=\"sidebar-box\"><p>Popular now</p></div><div id='comments'><p>Reader says {n}</p></div>{extra}"
            f"<form><p>Search here</p></form><footer><p>&copy; all</p></footer><script>if (a<b) document.write('<p>x</p>')</script></body></html>")


def test_main_text_without_furniture(spark):
    rows, want = [], {}
    for n in range(6):
        body = f"<article><h1>Title {n} &amp; more</h1><p>First <b>bold</b>\n line {n}.</p><div class='ad'>Buy</div><ul><li>point {n}</li></ul><aside>By the way</aside></article>"
        rows.append((n, f"http://a.example.org/{n}", site(n, body)))
        want[n] = f"Title {n} & more\nFirst bold line {n}.\npoint {n}"
    for n in range(10, 16):                        # no article: the densest slot of the template
        body = f"<div class='x1'><div class='x2'><p>Story {n} begins here with words.</p><p>It goes on for number {n}.</p></div></div><div class='x3'><p>Same in all pages.</p></div>"
        rows.append((n, f"http://b.example.org/{n}", site(n, body)))
        want[n] = f"Story {n} begins here with words.\nIt goes on for number {n}."
    for n in range(20, 24):                        # copies stay whole
        rows.append((n, "http://c.example.org/", site(0, "<article><h1>Same</h1><p>Same text.</p></article>")))
        want[n] = "Same\nSame text."
    rows += [(30, None, None), (31, "", ""), (32, "x", "plain text only"), (33, None, "<p>One<p>Two &lt;b&gt;<br>three"), (34, "http://a.example.org/z", "<article>open <b>never closed"),
             (0, "http://a.example.org/0", rows[0][2])]
    want |= {30: "", 31: "", 32: "plain text only", 33: "One\nTwo <b>\nthree", 34: "open never closed"}
    out = extract_main(spark.createDataFrame([(*r, "extra") for r in rows], PAGES))
    assert out.columns == ["page_id", "url", "text", "n_chars"] and out.count() == len(rows)
    got = by_id(out, "page_id")
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_one_page_alone():
    assert extract("<body><div class='cookie-notice'>We use cookies</div><main><p>a  b &eacute;</p><!-- <p>no</p> --><pre>x\n y</pre></main></body>", []) == "a b é\nx y"
    assert extract("<article><header><h1>Head</h1><p>by line</p></header><p hidden>no</p><p style='display:none'>no</p><p>yes</p></article>", []) == "Head\nyes"
    assert extract("<p>" + "long " * 50_000 + "</p>", []).count("long") == 50_000


def test_empty_table(spark):
    assert extract_main(spark.createDataFrame([], PAGES)).count() == 0
