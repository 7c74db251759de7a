"""Main-text extraction by tag-path ratios.

A page is read into blocks (the text between two block boundaries), each with
its root-to-leaf path of tags and classes.  Per path, two ratios are taken over
all its blocks: unlinked characters per block and punctuation marks per block.
Put back on the blocks in page order, both are smoothed by a Gaussian window and
fused by multiplication; each path's mean, less its share of linked text, is
held against a threshold: a share of the mean score of the page, weighted by text.
Blocks on paths above it whose own ratios are not far below it are content; the
innermost element that holds nearly all of them is the article, made wider only
by outer elements of whose further text at least half is content, and never
beyond an ``article`` element.  Inside it the score decides: blocks below
the threshold go, but for short paragraphs, lists, table cells and captions in the
flow of content (the element around their paragraph, list, table, quotation,
figure or heading group directly holds content in the same way) and headings whose
next block stays.  A page heading right above an article without one belongs to it.

Tags of navigation, asides, footers, forms and the like, and a header outside
article and main, are dropped by name, unless they hold nearly all of the page's
paragraphs or the article itself (a form around the page, a tag never closed).
A button inside a sentence is text; other buttons are not.  Names in class, id
and role that are made of certain words alone are evidence: a block in such an
element keeps a fifth of its score, or of the mean score of the others if that is
less, and goes if that is below the threshold.  They say nothing on a heading, on an inline element, or on an element that holds
nearly all of the page's text.  In the same way words of notices (cookies,
newsletters, rights) are evidence on a short block that stands outside the flow of
content.  Text counts as linked inside ``<a href>``, up to ``</a>`` or the end of
the block.

White space is what ``str.split`` splits on; character references are decoded
once.  Defined results: null or empty html gives empty text; markup that is
never closed ends with the page; pages without content give empty text; a page
is one row, and repeated pages stay; page length bounds a row: elements are
numbered in page order and refer to their parent and path by number, so deep
markup takes time and memory in proportion to the page.
"""

from __future__ import annotations

import html as entities
import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logloom.llm.common import ddl, free_name, table

# Tag names of the HTML standard, by what they do to the text.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "math", "object", "canvas", "video", "audio"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark",
          "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
ENDS_P = {"address", "article", "aside", "blockquote", "details", "dialog", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2",
          "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"ul", "ol", "dl", "table", "body", "html"}
# Tags that are no article; words of class, id or role that speak against a block, and words that only name its shape.
NOT_TAGS = {"nav", "aside", "footer", "form", "button", "select", "menu", "dialog", "head"}
ARTICLE_MAY_HOLD = {"menu"}
NOT_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent",
             "cookie", "cookies", "disqus", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter",
             "notice", "notices", "pager", "pagination", "popup", "promo", "promoted", "promotion", "related", "replies", "reply", "respond", "search",
             "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget", "complementary",
             "contentinfo", "alert", "toast", "paywall", "recommended", "reactions", "discussion"}
NOTICE = re.compile(r"\b(cookies?|newsletter|subscribe|sign ?up|log ?in|advertisement|sponsored|all rights reserved|copyright|privacy policy|terms of (?:use|service))\b|©", re.I)
SHAPE_WORDS = {"area", "bar", "block", "bottom", "box", "button", "buttons", "container", "form", "icons", "inner", "item", "items", "left", "link",
               "links", "list", "outer", "panel", "post", "posts", "right", "section", "slot", "thread", "top", "unit", "wrap", "wrapper"}
ARTICLE_TAGS = {"article", "main"}
FLOW_TAGS = {"p", "pre", "blockquote", "td", "th", "tr", "tbody", "thead", "tfoot", "table", "caption", "li", "ul", "ol", "dl", "dd", "dt", "figure", "figcaption",
             "address", "header", "hgroup", "menu"}

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^"'>]++|"[^"]*+"|'[^']*+'|["'])*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S)
HEADING = re.compile("h[1-6]")
HREF = re.compile(r"(?:^|\s)href\s*=", re.I)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[a-z]+")
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")

SIGMA, SHARE = 1.0, 0.8
#: A path is content from this share of the page's mean score on, and if its own ratios alone give this share of that.
THRESHOLD, OWN = 0.4, 0.25
#: What is left of the score of a block that its class words, or words of a notice in it, speak against.
EVIDENCE = 0.2
#: Longest block that is taken for a notice by its words, and least paragraph that speaks for the element around it.
NOTICE_CHARS, PARAGRAPH_CHARS = 200, 80


@dataclass
class Element:
    number: int
    tag: str
    path: int
    parent: "Element | None"
    in_article: bool
    off: bool = False
    marked: bool = False


@dataclass
class Block:
    element: Element
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    button: int | None = None
    text: str = ""


def _is_off(tag: str, parent: Element) -> bool:
    """Whether the tag alone speaks against what it holds."""
    if tag == "header" or tag in ARTICLE_MAY_HOLD:
        return not parent.in_article
    return tag in NOT_TAGS


def _is_marked(tag: str, attributes: str) -> bool:
    """Whether a name in class, id or role is made of the words that speak against it, and of words for shapes, alone."""
    if tag in ("html", "body", "article", "main") or HEADING.fullmatch(tag):
        return False
    for _, a, b, c in ATTRIBUTE.findall(attributes):
        for name in (a or b or c).lower().split():
            words = set(WORDS.findall(name))
            if words - SHAPE_WORDS and words - SHAPE_WORDS <= NOT_WORDS:
                return True
    return False


def parse(page: str) -> tuple[list[Element], list[Block]]:
    """The page's elements, each after its parent, and its text blocks in order, dropped ones too."""
    root = Element(0, "", 0, None, False)
    elements, stack, found, link = [root], [root], [], 0
    paths: dict[tuple[int, str], int] = {}
    still_open: dict[str, int] = {}
    current: Block | None = None
    button = False

    def text(piece: str) -> None:
        nonlocal current
        if current is None:
            if not piece.strip():
                return
            current = Block(stack[-1])
            found.append(current)
        if not button and piece.strip():
            current.button = None  # the sentence goes on after its button
        current.pieces.append(piece)
        if link:
            current.linked += len(piece)

    def leave(names, scope=SCOPE) -> None:
        """Close the nearest open element among ``names``, not beyond ``scope``."""
        nonlocal current
        if not any(still_open.get(name) for name in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                for e in stack[i:]:
                    still_open[e.tag] -= 1
                del stack[i:]
                current = None
                return
            if stack[i].tag in scope:
                return

    at = 0
    while m := TOKEN.search(page, at):
        if m.start() > at:
            text(page[at:m.start()])
        at = m.end()
        closing, tag, attributes = m[1], (m[2] or "").lower(), m[3] or ""
        if not tag:
            continue
        if tag in RAW and not closing:
            if not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag == "br":
            if current is not None:
                current.pieces.append(" ")
            continue
        if tag == "a":
            link = int(not closing and bool(HREF.search(attributes)))
        if tag in INLINE:
            continue
        if tag == "button" and (button if closing else current is not None and current.element.tag != "button"):
            button = not closing
            if button and current.button is None:
                current.button = len(current.pieces)
            continue
        link, button = 0, False  # a link ends with its block at the latest
        if closing:
            leave({tag}, ())
            current = None
            continue
        if tag in VOID:
            if tag == "hr":
                leave({"p"})
                current = None
            continue
        if tag in ENDS_P:
            leave({"p"})
        if tag in SIBLINGS:
            leave(SIBLINGS[tag], SCOPE - {"body", "html"})
        classes = next((a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes) if k.lower() == "class"), "")
        step = ".".join([tag, *sorted(classes.lower().split())])
        up = stack[-1]
        path = paths.setdefault((up.path, step), len(paths) + 1)
        stack.append(Element(len(elements), tag, path, up, up.in_article or tag in ARTICLE_TAGS, _is_off(tag, up), _is_marked(tag, attributes)))
        elements.append(stack[-1])
        still_open[tag] = still_open.get(tag, 0) + 1
        current = None
    if at < len(page):
        text(page[at:])
    for b in found:
        # a button that ends its block belongs to no sentence
        b.text = " ".join(entities.unescape("".join(b.pieces[:b.button])).split())
    return elements, [b for b in found if b.text]


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order, dropped ones too."""
    return parse(page)[1]


def path_ratios(page: list[Block]) -> list[tuple[float, float, float]]:
    """Per block: its path's unlinked characters and punctuation marks a block, and its unlinked share."""
    sums: dict[int, list[int]] = {}
    for b in page:
        s = sums.setdefault(b.element.path, [0, 0, 0, 0])
        s[0] += 1
        s[1] += _unlinked(b)
        s[2] += len(PUNCTUATION.findall(b.text))
        s[3] += len(b.text)
    return [(s[1] / s[0], s[2] / s[0], s[1] / s[3]) for s in (sums[b.element.path] for b in page)]


def path_scores(page: list[Block], ratios: list[tuple[float, float, float]]) -> list[float]:
    """Per block: its path's smoothed ratios, fused; linked text counts against it after smoothing."""
    window = [(k, math.exp(-k * k / (2 * SIGMA * SIGMA))) for k in (-2, -1, 0, 1, 2)]

    def smooth(column: int, i: int) -> float:
        near = [(w, ratios[i + k][column]) for k, w in window if 0 <= i + k < len(page)]
        return sum(w * x for w, x in near) / sum(w for w, _ in near)

    fused = [smooth(0, i) * (1 + smooth(1, i)) for i in range(len(page))]
    means: dict[int, list[float]] = {}
    for b, f in zip(page, fused):
        s = means.setdefault(b.element.path, [0, 0.0])
        s[0] += 1
        s[1] += f
    return [means[b.element.path][1] / means[b.element.path][0] * unlinked for b, (_, _, unlinked) in zip(page, ratios)]


def _unlinked(b: Block) -> int:
    return len(b.text) - min(b.linked, len(b.text))


def _held(elements: list[Element], page: list[Block], amount) -> list[int]:
    """Per element: what its blocks and those of all elements in it amount to."""
    held = [0] * len(elements)
    for b in page:
        held[b.element.number] += amount(b)
    for e in reversed(elements):
        if e.parent:
            held[e.parent.number] += held[e.number]
    return held


def _passed_on(elements: list[Element], starts) -> list[bool]:
    """Per element: whether it or an element around it starts what is passed on."""
    out = [False] * len(elements)
    for e in elements:
        out[e.number] = starts(e) or e.parent is not None and out[e.parent.number]
    return out


def _flows(elements: list[Element]) -> list[Element]:
    """Per element: the one in whose flow it stands, beyond paragraphs, headings, lists, tables, quotations and figures."""
    out: list[Element] = []
    for e in elements:
        inner = e.parent and not e.off and (e.tag in FLOW_TAGS or HEADING.fullmatch(e.tag) or e.tag == "section" and e.parent.in_article and not e.marked)
        out.append(out[e.parent.number] if inner else e)
    return out


def _dropped(elements: list[Element], every: list[Block]) -> list[bool]:
    """Per element: whether a tag around it drops it.  A tag that holds most of the page's paragraphs, or its article, doesn't."""
    full = lambda b: b.element.tag == "p" and _unlinked(b) >= PARAGRAPH_CHARS
    paragraphs = _held(elements, every, lambda b: _unlinked(b) if full(b) else 0)
    number = _held(elements, every, full)
    articles = [e.tag in ARTICLE_TAGS for e in elements]
    for e in reversed(elements):
        if e.parent and articles[e.number]:
            articles[e.parent.number] = True
    # of an element, the article speaks only if it holds most of the page's paragraphs too
    most = lambda e: paragraphs[e.number] >= SHARE * paragraphs[0] > 0 and (articles[e.number] or number[e.number] > 2)
    return _passed_on(elements, lambda e: e.off and not most(e))


def main_text(page: str | None) -> str:
    elements, every = parse(page or "")
    if not every:
        return ""
    off = _dropped(elements, every)
    ratios = path_ratios(every)
    scores = path_scores(every, ratios)
    kept = [(b, s, chars * (1 + marks)) for b, s, (chars, marks, _) in zip(every, scores, ratios) if not off[b.element.number]]
    if not kept:
        return ""
    page = [b for b, _, _ in kept]
    length = _held(elements, page, lambda b: len(b.text))
    speaks = _passed_on(elements, lambda e: e.marked and length[e.number] < SHARE * length[0])
    against = [speaks[b.element.number] for b in page]
    # smoothing raises what stands among content, and is not to sink a lone paragraph among headings and lists
    scored = [max(s, own) for _, s, own in kept]
    plain = [(s, len(b.text)) for b, s, bad in zip(page, scored, against) if not bad] or [(s, len(b.text)) for b, s in zip(page, scored)]
    mean = sum(s * n for s, n in plain) / sum(n for _, n in plain)
    least = min(THRESHOLD * mean, max(scored))
    flows = _flows(elements)
    longest = [0] * len(elements)
    for b in page:
        e = flows[b.element.number].number
        longest[e] = max(longest[e], len(b.text))
    notice = [longest[flows[b.element.number].number] <= NOTICE_CHARS and bool(NOTICE.search(b.text)) for b in page]
    # a comment may be longer than the article's paragraphs, but is no better for it
    scored = [EVIDENCE * min(s, mean) if bad or told else s for s, bad, told in zip(scored, against, notice)]
    strong = [s >= least and own >= OWN * least for s, (_, _, own) in zip(scored, kept)]
    content = [b for b, hit, bad in zip(page, strong, against) if hit and not bad] or [b for b, hit in zip(page, strong) if hit] or page
    mass = _held(elements, content, lambda b: len(b.text))
    # the innermost that holds nearly all: of elements that hold more than half, each holds the next
    article = [e for e in elements if mass[e.number] >= SHARE * mass[0]][-1]
    # one article element with most of the content stands for itself, whatever stands beside it
    article = next((e for e in elements if e.tag == "article" and 2 * mass[e.number] > mass[0] and mass[e.number] < mass[article.number]), article)
    # a lone block is no container: what stands beside it belongs to the same article
    article = flows[article.number]
    # wider only for more content, where most of the text that an outer element adds is content too, and not beyond the article
    outer = article
    while outer.parent and outer.tag != "article":
        outer = outer.parent
        more = mass[outer.number] - mass[article.number]
        if more and 2 * more >= length[outer.number] - length[article.number]:
            article = outer

    inside = _passed_on(elements, lambda e: e is article)
    within = [inside[b.element.number] for b in page]
    of_content = {flows[b.element.number].number for b, hit, i in zip(page, strong, within) if i and hit}
    stays = [i and (hit or not bad and flows[b.element.number].number in of_content)
             for b, hit, i, bad in zip(page, strong, within, against)]
    # a heading outside the flow of content goes with the block that follows it
    heading = [bool(HEADING.fullmatch(b.element.tag)) and not bad for b, bad in zip(page, against)]
    for i in range(len(page) - 2, -1, -1):
        if within[i] and heading[i]:
            stays[i] = stays[i] or stays[i + 1]
    # so does the page's heading, if it stands right above an article that has none
    first = stays.index(True) if True in stays else 0
    if first and heading[first - 1] and not any(stay and b.element.tag == "h1" for b, stay in zip(page, stays)):
        stays[first - 1] = page[first - 1].element.tag == "h1"
    return "\n\n".join(b.text for b, stay in zip(page, stays) if stay)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """All columns of ``pages`` but the html, and last the text (``main_text``, or the next free name)."""
    others = pages.drop(html_col)
    columns = others.columns
    name = free_name(columns, "main_text")

    def run(batches):
        for b in batches:
            texts = pa.array([main_text(x) for x in b.column(html_col).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), texts], [*columns, name])

    return pages.mapInArrow(run, ddl(others, f"{name} string"))


def op1_html_extract(spark, sf_dir: str) -> DataFrame:
    rows = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return rows.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))
