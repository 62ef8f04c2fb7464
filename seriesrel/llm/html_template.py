"""Main text of web pages by deducing each host's template.

1. Each page is read into its block elements. The *token* of a block is its path of
   enclosing blocks with classes, so equal tags in different places differ.
2. Per host, tokens with the same occurrence vector (how often in each page) form an
   equivalence class; an order-free sum over page hashes names the vector, so no
   group of pages is gathered. Classes in at least half of the host's pages are
   valid. Those that occur once a page are the template; a class that repeats within
   a page is valid if one template token encloses all its members (a prefix of their
   paths; the order of a class's members is not compared between pages).
3. Each template token opens a slot: the text up to nested tokens. Slots in menus,
   headers, footers, sidebars, notices, adverts, forms and comments, slots of links and slots
   whose text is the same in all pages are furniture; inside an article, a word that may
   also name a part of it needs fixed text or links to make furniture. The main slot is the article
   (or ``main``) of the template; without one, the deepest block around nine tenths of the
   remaining text, widened to blocks that add nothing but such text.
4. Each page's text in the host's main slots is returned block by block, without
   text that is equal on all pages while the greater part varies: slots, and of a slot with
   several runs the first and last three.

A page that lacks its host's main slots, or whose host has too few pages to tell,
is read by its own tokens. Where the fixed text of the main slots is half or more of
them nothing is left out, so copies of an article stay whole.

Blocks are joined by one line end, white space inside a block becomes one blank,
character references are decoded. ``br`` ends a block.

Edge cases: null html is an empty text; a null or strange URL belongs to host ''
(its pages share a template); broken markup is read to its end; repeated pages
give equal texts; an empty table works.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesrel.llm.text import small

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([A-Za-z_:@][\w:.@-]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set("html head body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption "
            "figure footer form h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav noscript ol option p pre section select "
            "summary table caption tbody td template tfoot th thead tr ul svg math object audio video canvas button".split())
#: Elements whose text is never the article's.
FURNITURE = set("head nav footer aside form script style noscript template select button svg math object audio video canvas "
                "textarea iframe dialog menu option fieldset title".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Whole words of a class, id or role that name furniture.
WORDS = set("ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo promos promotion banner banners "
            "cookie cookies consent gdpr notice notices notification notifications alert alerts popup modal overlay paywall "
            "newsletter subscribe subscription signup share sharing social sidebar side rail aside complementary menu menus "
            "nav navbar navigation breadcrumb breadcrumbs footer foot colophon contentinfo header masthead topbar comment "
            "comments commentlist disqus reply replies respond related recommended recommendations widget widgets pagination "
            "pager toolbar login search form copyright disclaimer legal skip".split())
#: Of these, words that also name parts of articles: in an article a block is left out by one of them alone
#: only if the host's template agrees (fixed text, or links for the most part).
AMBIGUOUS = set("side form legal search alert comment related skip".split())
KEPT = {"html", "body", "main", "article"}
MAIN = {"article", "main"}
#: Elements of running text; the main block is one around them.
_LEAVES = HEADINGS | {"p", "li", "pre", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "table", "dd", "dt", "dl", "blockquote", "ul", "ol",
                      "figure", "figcaption"}
MOST = 0.9                           # share of the varying text that a main block holds at least
ENDS = 3                             # runs at each end of a repeated slot whose places are compared between pages
#: A start tag on the left ends an open element of those on the right.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_WALLS = {"ul", "ol", "dl", "table", "article", "section", "div", "main", "aside", "nav", "body", "blockquote", "form", "header", "footer"}


def _furniture(tag: str, attrs: str) -> tuple[bool, bool, str]:
    """Whether the element is furniture, whether only by an ambiguous word, and its class and id with numbers made equal."""
    if not attrs.strip():
        return tag in FURNITURE, False, ""
    named, hidden = [], False
    for key, value in _ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id", "role"):
            named.append(value)
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (
                key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
            hidden = True
    words = {w.lower() for v in named for w in _PARTS.findall(v)}
    sure = hidden or tag in FURNITURE
    named_so = words & WORDS if tag not in KEPT and tag not in HEADINGS else set()
    return sure or bool(named_so), not sure and len(named_so) == 1 and named_so <= AMBIGUOUS, ".".join(re.sub(r"[/#]", "_", re.sub(r"\d+", "0", v)) for v in named)


class Run:
    """The text of one block outside furniture: its path, its characters, those in links, an ambiguous block around it."""

    __slots__ = ("path", "bits", "links", "head", "doubt")

    def __init__(self, path: str, head: bool, doubt: str):
        self.path, self.bits, self.links, self.head, self.doubt = path, [], 0, head, doubt

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.bits)).split())


def blocks(page: str) -> tuple[list[Run], Counter, dict[str, int]]:
    """Text runs in page order, how often each block path occurs, and where first."""
    runs: list[Run] = []
    seen: Counter = Counter()
    first: dict[str, int] = {}
    stack: list[tuple[str, str, bool, bool, str]] = []      # tag, path, furniture, header of the site or article, ambiguous block
    state = ["", False, False, ""]                          # path, furniture, in a header, outermost ambiguous block
    links, current, at, n = 0, None, 0, len(page)

    def add(text: str) -> None:
        nonlocal current
        if state[1]:                                   # piece by piece: inline furniture takes no other text along
            return
        if current is None:
            if not text.strip():
                return
            current = Run(state[0], state[2], state[3])
            runs.append(current)
        current.bits.append(text)
        if links:
            current.links += len(text)

    def back(to: int) -> None:
        nonlocal links
        for tag, *_ in stack[to:]:
            links -= tag == "a"
        del stack[to:]
        state[:] = stack[-1][1:] if stack else ["", False, False, ""]

    while at < n:
        m = _TAG.search(page, at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                add(html.escape(m[0][9:-3], quote=False))
            continue
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    if any(t in BLOCK for t, *_ in stack[k:]):
                        current = None
                    back(k)
                    break
                if tag not in BLOCK and stack[k][0] in _WALLS:
                    break
            continue
        if tag in BLOCK:
            current = None
            closes = _CLOSES.get(tag, set()) | ({"p"} if tag not in ("option",) else set()) | (HEADINGS if tag in HEADINGS else set())
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in closes:
                    back(k)
                    break
                if stack[k][0] in _WALLS:
                    break
        if tag == "br" or tag == "hr":
            current = None
            continue
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
            continue
        bad, unsure, name = _furniture(tag, m[3])
        unsure = unsure and any(t in MAIN for t, *_ in stack)
        head = state[2] or tag == "header"
        path, out, doubt = state[0], state[1] or (bad and not unsure), state[3]
        if tag in BLOCK:
            path = f"{path}/{tag}.{name}" if name else f"{path}/{tag}"
            doubt = doubt or (path if unsure else "")
            seen[path] += 1
            first.setdefault(path, len(runs))
        if m[3].rstrip().endswith("/") and tag in ("svg", "math"):
            continue
        stack.append((tag, path, out, head, doubt))
        links += tag == "a"
        state[:] = [path, out, head, doubt]
    return runs, seen, first


def _last_tag(path: str) -> str:
    return path.rpartition("/")[2].partition(".")[0]


def _kept(run: Run) -> bool:
    """Of a header, only headings inside an article."""
    if run.head:
        tags = [p.partition(".")[0] for p in run.path.split("/")]
        return tags[-1] in HEADINGS and bool(MAIN & set(tags))
    return True


def _under(path: str, root: str) -> bool:
    return path == root or path.startswith(root + "/")


def main_roots(tokens: list[dict]) -> list[str]:
    """The paths of the main slots of a template.

    ``tokens``: ``path``, ``pos``, ``chars`` and ``links`` (kept text of the block's own, and in
    links), ``same`` (text equal in all pages).
    """
    slots = [t for t in tokens if t["chars"] > 0 and not t["same"] and t["links"] <= 0.5 * t["chars"]]
    marked = []
    for t in tokens:
        tag = _last_tag(t["path"])
        mass = sum(s["chars"] for s in slots if _under(s["path"], t["path"]))
        if tag in MAIN and mass:
            marked.append((t["path"], tag, mass))
    if marked:
        articles = [p for p, tag, _ in marked if tag == "article"] or [p for p, _, _ in marked]
        return sorted(p for p in articles if not any(p != q and _under(p, q) for q in articles))
    if not slots:
        return []
    # The deepest block around most of the text that is neither fixed nor a list of links ...
    mass: Counter = Counter()
    for t in slots:
        for p in _enclosing(t["path"]):
            mass[p] += t["chars"]
    total = sum(t["chars"] for t in slots)
    best = max((p for p in mass if mass[p] >= MOST * total), key=lambda p: (p.count("/"), mass[p], p))
    # ... widened to blocks that add such text only, as a title or a lead beside the body.
    root = best
    while _last_tag(best := best.rpartition("/")[0]) not in {"", "body", "html"}:
        new = [t for t in tokens if t["chars"] > 0 and _under(t["path"], best) and not _under(t["path"], root)]
        if any(t["same"] or t["links"] > 0.5 * t["chars"] for t in new):
            break
        if new:
            root = best
    return [root]


def _enclosing(path: str) -> list[str]:
    """The path and those around it, without the elements of running text at its end."""
    while _last_tag(path) in _LEAVES and "/" in path:
        path = path.rpartition("/")[0]
    out = [path]
    while path:
        path = path.rpartition("/")[0]
        out.append(path)
    return out


def dropped(tokens: list[dict], roots: list[str]) -> list[str]:
    """The paths in the main slots whose text is left out: fixed slots beside varying ones, and lists of links under ambiguous names.

    A path that ends in ``#`` and a number is the run at that place of the slot, counted from
    its end if negative. Fixed text stays where it is as much as the varying text or more, so
    (near) copies of an article stay whole.
    """
    inside = [t for t in tokens if t["chars"] > 0 and any(_under(t["path"], r) for r in roots)]
    slots = [t for t in inside if "#" not in t["path"]]
    fixed = [t for t in slots if t["same"]]
    whole = {t["path"] for t in fixed}
    places: dict[tuple, dict] = {}
    for t in inside:
        path, _, _ = t["path"].partition("#")
        if t["path"] != path and t["same"] and path not in whole:
            places.setdefault((path, t["text"]), t)       # one run may be counted from both ends
    out = []
    if sum(t["chars"] / t["support"] for t in [*fixed, *places.values()]) * 2 < sum(t["chars"] / t["support"] for t in slots):
        texts = set(places)
        out += [t["path"] for t in fixed]
        out += [t["path"] for t in inside if "#" in t["path"] and t["same"] and (t["path"].partition("#")[0], t["text"]) in texts]
    for d in sorted({t["doubt"] for t in slots if t["doubt"]}):
        under = [t for t in slots if _under(t["path"], d)]
        if sum(t["links"] for t in under) > 0.5 * sum(t["chars"] for t in under):
            out.append(d + "/*")
    return sorted(out)


def _slots(runs: list[Run]) -> dict[str, list]:
    """Per path, and per place at both ends of a path with several runs: characters, those in links, hash of the text, ambiguous block."""
    out: dict[str, list] = {}
    of: dict[str, list[Run]] = {}
    for r in runs:
        if _kept(r):
            of.setdefault(r.path, []).append(r)
    for path, own in of.items():
        texts = [r.text() for r in own]
        whole = 0
        for t in texts:
            whole = xxhash.xxh64_intdigest(t, whole)
        out[path] = [sum(len(b) for r in own for b in r.bits), sum(r.links for r in own), whole, own[0].doubt]
        if len(own) > 1:
            for k in {*range(min(ENDS, len(own))), *range(-min(ENDS, len(own)), 0)}:
                out[f"{path}#{k}"] = [sum(map(len, own[k].bits)), own[k].links, xxhash.xxh64_intdigest(texts[k]), own[k].doubt]
    return out


def _own_tokens(runs: list[Run], first: dict[str, int]) -> list[dict]:
    slots = _slots(runs)
    rows = ((p, *slots.get(p, (0, 0, 0, ""))) for p in {*first, *slots})
    return [{"path": p, "pos": first.get(p, 0), "chars": chars, "links": links, "text": text, "doubt": doubt, "support": 1, "same": False}
            for p, chars, links, text, doubt in rows if "#" not in p]


def extract(page: str | None, roots: list[str], drop: list[str] = ()) -> str:
    """The main text of one page under its host's main slots, without the template's text in them."""
    if not page:
        return ""
    runs, _, first = blocks(page)
    if not any(_under(p, r) for p in first for r in roots):
        own = _own_tokens(runs, first)
        roots = main_roots(own)
        drop = dropped(own, roots)
    if not roots and not first:
        roots = [""]
    drop = set(drop)
    kept = [r for r in runs if _kept(r)]
    count, at, out = Counter(r.path for r in kept), Counter(), []
    for r in kept:
        k = at[r.path]
        at[r.path] += 1
        if drop and (r.path in drop or (r.doubt and r.doubt + "/*" in drop)
                     or (count[r.path] > 1 and (f"{r.path}#{k}" in drop or f"{r.path}#{k - count[r.path]}" in drop))):
            continue
        if any(_under(r.path, root) for root in roots):
            out.append(r.text())
    return "\n".join(t for t in out if t)


_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"


def with_host(pages: DataFrame) -> DataFrame:
    return pages.withColumn("host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), _HOST, 1)))


def _tokens(batches):
    for batch in small(batches, column="html"):
        rows = []
        for host, page_id, page in zip(*(batch.column(c).to_pylist() for c in ("host", "page_id", "html")), strict=True):
            if not page:
                continue
            runs, seen, first = blocks(page)
            own = xxhash.xxh64_intdigest(page)
            rows.append((host, "", "", 1, 0, 0, 0, 0, 0))
            slots = _slots(runs)
            for path in {*seen, *slots}:
                chars, links, text, doubt = slots.get(path, (0, 0, 0, ""))
                times = seen[path] or (1 if "#" in path else 0)
                vector = xxhash.xxh64_intdigest(f"{own}:{times}") >> 2
                rows.append((host, path, doubt, times, vector & ((1 << 40) - 1), first.get(path, 0), chars, links, text >> 2))
        names = ("host", "path", "doubt", "times", "vector", "pos", "chars", "links", "text")
        cols = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        yield pa.record_batch([pa.array(c, pa.string() if i < 3 else pa.int64()) for i, c in enumerate(cols)], names=names)


def _deduce(batches):
    for batch in batches:
        out = []
        for tokens in batch.column("tokens").to_pylist():
            # Equivalence classes: equal occurrence vectors and equal counts a page.
            classes: dict[tuple, list[dict]] = {}
            for t in tokens:
                if "#" not in t["path"]:
                    classes.setdefault((t["vector"], t["support"], t["least"], t["most"]), []).append(t)
            once = [c for (_, _, least, most), c in classes.items() if least == most == 1]
            template = {t["path"] for c in once for t in c}
            # A repeating class is nested in the slot of a template token that encloses all its members;
            # members of others are text of the page, of which nothing is fixed.
            nested = [c for (_, _, least, most), c in classes.items() if not least == most == 1]
            valid = {t["path"] for c in once for t in c}
            valid |= {t["path"] for c in nested if any(all(_under(t["path"], p) for t in c) for p in template) for t in c}
            tokens = sorted((t | {"same": t["same"] and t["path"].partition("#")[0] in valid} for t in tokens),
                            key=lambda t: (t["pos"], t["path"]))
            roots = main_roots([t for t in tokens if "#" not in t["path"]])
            out.append(json.dumps([roots, dropped(tokens, roots)]))
        yield pa.record_batch({"host": batch.column("host"), "template": pa.array(out, pa.string())})


def templates(pages: DataFrame) -> DataFrame:
    """``(host, template)``: the main slots of each host and what is left out in them, as JSON lists of paths.

    The tokens of a host that reach half of its pages are at most twice the tokens of a
    page, so the last grouping is bounded by the size of a page, not of a host.
    """
    tokens = with_host(pages).select("host", "page_id", "html").mapInArrow(
        _tokens, "host string, path string, doubt string, times long, vector long, pos long, chars long, links long, text long")
    stats = tokens.groupBy("host", "path").agg(
        F.count("*").alias("support"), F.sum("vector").alias("vector"), F.min("times").alias("least"), F.max("times").alias("most"),
        F.avg("pos").alias("pos"), F.sum("chars").alias("chars"), F.sum("links").alias("links"),
        (F.min("text") == F.max("text")).alias("same"), F.min("text").alias("text"), F.max("doubt").alias("doubt"))
    n = stats.where("path = ''").select("host", F.col("support").alias("pages"))
    valid = stats.where("path <> ''").join(n, "host").where("2 * support >= pages")
    packed = valid.groupBy("host").agg(F.collect_list(F.struct(
        "path", "support", "vector", "least", "most", "pos", "chars", "links", "text", "doubt",
        (F.col("same") & (F.col("support") > 2) & (F.col("pages") > 2)).alias("same"))).alias("tokens"))
    return packed.mapInArrow(_deduce, "host string, template string")


def extract_main(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for each row of ``pages`` (``page_id, url, html``)."""
    def run(batches):
        for batch in small(batches, column="html"):
            texts = [extract(p, *json.loads(t or "[[]]")) for p, t in zip(batch.column("html").to_pylist(), batch.column("template").to_pylist(), strict=True)]
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                   pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = with_host(pages).select(F.col("page_id").cast("long").alias("page_id"), "url", "html", "host")
    return rows.join(templates(pages), "host", "left").select("page_id", "url", "html", "template").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")


