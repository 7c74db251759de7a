"""HTML extraction, token counts, packing, decontamination: brute force on small inputs."""

import math
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logloom.llm import decontaminate, html_extract, packing, queries, token_counts
from logloom.llm.common import table

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string"
TEXTS = [None, "", " ", "a  b \n\n c\t\n▁ d▁", "<s>\n\n  x </s> ▁▁\n ▁z", "x y", "\n", "\nfoo bar\n", "x<|endoftext|>y <|endoftext|> z",
         "   x  y 's don't  it's", "a \n b\n  c \t d ", "日本語 テキスト　全角 123 ²½", "a\x1c b \x85 c​ d", "word " * 3000]


# --- HTML --------------------------------------------------------------------

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1><p>Menu of the site, here.</p></header>
<nav><ul><li><a href=x>One, two.</a></li></ul></nav><!-- <p>no</p> -->
<div id="content" class="post"><h2>Head &amp; line</h2><p>A long paragraph with, some <b>bold</b> punctuation. It goes on and on, really, for a while.
<p>Unclosed, it ends here&#33;<br>next   line</p><p>Short.</p><ul><li>one item</li><li><a href=x>link</a> and text</li></ul>
<div class="comments"><p>Reader comment: this is a long and punctuated comment, I agree, yes, it is. Really long, indeed, it goes on.</p></div></div>
<aside>Side, bar.</aside><form><p>Subscribe, now.</p><input></form><div class="cookie-notice">We use cookies, ok. Please accept them all.</div>
<script>var x = "<p>no, no.</p>";</script><footer>&copy; 2020, me.</footer></body></html>"""


def test_article_alone_is_kept():
    assert html_extract.main_text(PAGE) == "\n\n".join([
        "Head & line", "A long paragraph with, some bold punctuation. It goes on and on, really, for a while.",
        "Unclosed, it ends here! next line", "Short.", "one item", "link and text"])


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<p>One.", "One."), ("a < b and c > d <p x='>'>q</p>", "a < b and c > d\n\nq"),
    ("<!-- never", ""), ("<script>x", ""), ("<article><p>a</p></article><nav>b</nav>", "a"), ("&amp;lt;", "&lt;"), ("<nav>only</nav>", ""), ("</p></div>x", "x")])
def test_html_edges(html, text):
    assert html_extract.main_text(html) == text


def test_long_page_is_not_cut():
    assert html_extract.main_text("<article>" + "<p>word, word.</p>" * 20_000 + "</article>") == "\n\n".join(["word, word."] * 20_000)


LONG = "<p>A long paragraph with, some punctuation. It goes on and on, really, for a while, as paragraphs do.</p>"


def test_class_words_do_not_cut_an_article():
    long = LONG[3:-4]
    for name in ("content has-sidebar", "no-sidebar", "with-comments", "ad-free", "comments"):
        assert html_extract.main_text(f"<nav><a href=x>n</a></nav><div class='{name}'>{LONG * 3}</div><footer>f</footer>") == "\n\n".join([long] * 3)
    got = html_extract.main_text(f"<article>{LONG * 2}<h2 id='discussion'>Talk</h2>{LONG}<section id='related-work'>{LONG}</section>"
                                 f"<section id='search-methods'>{LONG}</section></article>")
    assert got == "\n\n".join([long, long, "Talk", long, long, long])


def test_links_in_an_article_stay():
    long = LONG[3:-4]
    assert html_extract.main_text(f"<article>{LONG * 3}<ul><li><a href=x>First source</a></li><li><a href=y>Second</a></ul></article>") == "\n\n".join(
        [long] * 3 + ["First source", "Second"])
    assert [b.linked for b in html_extract.blocks("<p><a name=x>One.</p><p>Two.</p><p><a href=y>Three.</p><p>Four.</p>")] == [0, 0, 6, 0]


def test_scores_choose_the_blocks_of_a_container():
    long = LONG[3:-4]
    links = "<ul>" + "<li><a href=x>Link</a></li>" * 4 + "</ul>"
    for tag in ("main", "article"):
        assert html_extract.main_text(f"<{tag}><div class=c1>{LONG * 4}</div><div class=c2>{links}</div></{tag}>") == "\n\n".join([long] * 4)
        assert html_extract.main_text(f"<{tag}>{LONG * 4}<div class=c2>{links}</div>{LONG}</{tag}>") == "\n\n".join([long] * 5)
    # whole sections of content stay, however small their share, and so do headings and short paragraphs of the flow
    got = html_extract.main_text(f"<main><div class=t><h1>Title</h1></div><div class=c1>{LONG * 9}<p class=s>Short.</p></div><div class=c3><h2>Part</h2>{LONG}</div>"
                                 f"<div class=c2>{links}</div></main>")
    assert got == "\n\n".join(["Title", *[long] * 9, "Short.", "Part", long])


COMMENT = "<p>Great post, I agree, thanks. I would add, though, that it is not so simple, is it?</p>"
ITEMS = "<ul>" + "<li>A list item with some text, and more.</li>" * 10 + "</ul>"


@pytest.mark.parametrize("html, text", [
    # what is no article goes, whatever it is called
    (f"<article>{LONG * 3}<div class=comments>{COMMENT * 6}</div></article>", ["L"] * 3),
    (f"<article>{LONG * 3}<div class=comment-thread>{COMMENT * 3}</div></article>", ["L"] * 3),
    (f"<main><article>{LONG * 4}</article><div class=c9>{COMMENT * 3}</div></main>", ["L"] * 4),
    (f"<main><div class=x>We use cookies to make this site better. Accept all?</div><h1>Title</h1>{LONG * 4}</main>", ["Title", *["L"] * 4]),
    (f"<main><div class=a>{LONG * 4}</div><div class=b><h3>About</h3><p>I write here.</p></div></main>", ["L"] * 4),
    (f"<main><div class=z><h1>T</h1>{ITEMS}</div><div>{'<a href=x>link</a> ' * 20}</div></main>", ["T", *["A list item with some text, and more."] * 10]),
    (f"<body><div class=n1><a href=x>Home</a></div><article><h1>T</h1>{LONG * 3}</article><div class=n2>© 2020 Firm, all rights reserved.</div></body>",
     ["T", *["L"] * 3]),
    (f"<article>{LONG * 3}<form><p>Leave a reply, please.</p></form><footer><p>Tags, a, b.</p></footer></article>", ["L"] * 3),
    # what is the article stays
    (f"<body><form action=x><nav><a href=y>Home</a></nav><div id=c>{LONG * 4}</div><footer>f</footer></form></body>", ["L"] * 4),
    (f"<body><nav><ul><li><a href=y>Home</a></li></ul><article><h1>T</h1>{LONG * 4}</article></body>", ["T", *["L"] * 4]),
    (f"<article><header><h1>Title</h1><p>By me, 2020</p></header>{LONG * 4}</article>", ["Title", "By me, 2020", *["L"] * 4]),
    (f"<body><div class=hero><h1>Title</h1></div><article>{LONG * 4}</article></body>", ["Title", *["L"] * 4]),
    (f"<body><menu><li>Home</li></menu><article>{LONG * 3}<menu><li>Fry it</li></menu>{LONG}</article></body>", [*["L"] * 3, "Fry it", "L"]),
    (f"<article>{LONG * 3}<p>Press the <button>OK</button> button, now.</p><button>Share</button></article>", [*["L"] * 3, "Press the OK button, now."]),
    (f"<article>{LONG * 3}<section><h2>Part</h2><p>Short one.</p></section>{LONG}</article>", [*["L"] * 3, "Part", "Short one.", "L"])])
def test_article_by_contract(html, text):
    assert html_extract.main_text(html) == "\n\n".join(LONG[3:-4] if x == "L" else x for x in text)


def test_neutral_names_change_few_pages(spark):
    """The ratios do the work: advert, menu and footer under names that say nothing leak from less than 1 % of the pages."""
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").filter("html is not null").select("html").collect()]
    neutral = [re.sub(r"<(/?)(nav|footer)\b", r"<\1div", x).replace('class="ad"', 'class="c1"') for x in pages]
    differ = sum(html_extract.main_text(a) != html_extract.main_text(b) for a, b in zip(pages, neutral))
    assert differ < 0.01 * len(pages)


def test_deep_markup_takes_time_in_proportion():
    for page in ("<div>" * 60_000, "<p><x>" * 30_000 + "z", "<div>" * 60_000 + "</zz>" * 60_000):
        start = time.process_time()
        html_extract.main_text(page)
        assert time.process_time() - start < 10   # 0.6 to 0.8 s here, on a machine of its own; quadratic growth took minutes
    tracemalloc.start()
    html_extract.main_text("<div>a" * 60_000)
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()


def test_pages_query_reads_every_page(spark):
    pages = table(spark, SF, "pages")
    rows = {r["page_id"]: r for r in queries.QUERIES["op1_html_extract"](spark, SF).collect()}
    assert len(rows) == pages.count()
    for p in pages.collect():
        assert rows[p["page_id"]]["text"] == html_extract.main_text(p["html"]) and rows[p["page_id"]]["n_chars"] == len(rows[p["page_id"]]["text"])
        assert "<" not in p["html"] or rows[p["page_id"]]["text"]
    odd = spark.createDataFrame([(1, "<p>x", "m")], "id long, html string, main_text string")
    assert html_extract.extract(odd).columns == ["id", "main_text", "main_text_"]
    assert html_extract.extract(odd.limit(0)).count() == 0


# --- token counts ------------------------------------------------------------

def test_counts_equal_the_library(spark):
    model = token_counts.load(token_counts.model_path())
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "x y"), (3, "x y")]
    for head in (0, 3, token_counts.HEAD):
        got = token_counts.token_counts(spark.createDataFrame(rows, DOC), token_counts.model_path(), head=head)
        assert Counter((r["id"], r["n_bytes"], r["n_tokens"]) for r in got.collect()) == Counter(
            (i, len((t or "").encode()), len(model.encode(t or ""))) for i, t in rows)
    docs = table(spark, SF, "documents").collect()
    got = {r["doc_id"]: r for r in queries.QUERIES["op10_token_counts"](spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        n = len(model.encode(d["text"]))
        assert (got[d["doc_id"]]["n_tokens"], got[d["doc_id"]]["over_limit"]) == (n, n > 4096)
    assert token_counts.token_counts(spark.createDataFrame([], DOC), token_counts.model_path()).count() == 0
    for kind in ("int", "string"):
        got = token_counts.token_counts(spark.createDataFrame([(1, "a b"), (None, "c")], DOC).select(F.col("doc_id").cast(kind).alias("doc_id"), "text"),
                                        token_counts.model_path())
        assert dict(got.dtypes)["id"] == kind and sorted((str(r["id"]), r["n_bytes"]) for r in got.collect()) == [("1", 3), ("None", 1)]


# --- packing -----------------------------------------------------------------

def fewest(items, size):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for r in {r: k for k, r in enumerate(rooms) if r >= items[i]}.values():
            rooms[r] -= items[i]
            go(i + 1, rooms)
            rooms[r] += items[i]
        go(i + 1, [*rooms, size - items[i]])
    go(0, [])
    return best[0]


def test_reduction_costs_no_sequence():
    rng = random.Random(1)
    fixed = 0
    for _ in range(200):
        size = rng.choice([10, 20, 50])
        items = [rng.randint(1, size) for _ in range(rng.randint(1, 10))]
        left = packing._Counts(Counter(items), size)
        sets = packing.reduce_by_dominance(left, size)
        rest = [n for n, k in enumerate(left.n) for _ in range(k)]
        fixed += len(items) - len(rest)
        assert sum(k for _, k in sets) + (fewest(rest, size) if rest else 0) == fewest(items, size)
    assert fixed > 500


def check_packing(rows, docs, size):
    from public_tokenizers import path
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(path("byte_bpe_50k.json"))
    by, places = {}, {}
    for r in rows:
        by.setdefault(r["id"], []).append(r)
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, text in docs:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for k, r in enumerate(sorted(by[i], key=lambda r: r["piece"])):
            part = ids[at:at + r["length"]]
            assert (r["piece"], r["start"], zlib.crc32(part.tobytes())) == (k, at, r["ids_crc32"]) and (r["length"] == size or k == 0)
            at += r["length"]
        assert at == len(ids) and (len(ids) > size or len(by[i]) == 1)
    for placed in places.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= size
    return len(places)


def test_packing_of_hard_texts_and_documents(spark):
    docs = list(enumerate(TEXTS))
    for size in (4, 64):
        check_packing(packing.pack(spark.createDataFrame(docs, DOC), size=size).collect(), docs, size)
    docs = [(d["doc_id"], d["text"]) for d in table(spark, SF, "documents").collect()]
    rows = queries.QUERIES["op4_best_fit_packing"](spark, SF).withColumnRenamed("doc_id", "id").collect()
    used = check_packing(rows, docs, packing.SIZE)
    assert used <= 1.02 * math.ceil(sum(r["length"] for r in rows) / packing.SIZE) + 1
    assert packing.pack(spark.createDataFrame([], DOC)).count() == 0
    twice = packing.pack(spark.createDataFrame([(1, "x y"), (1, "x y"), (None, None)], DOC)).collect()
    assert len(twice) == 3 and len({(r["sequence_id"], r["offset"]) for r in twice}) == 3


# --- decontamination ---------------------------------------------------------

def edits(item, text):
    row = [0] * (len(text) + 1)
    for a, x in enumerate(item, 1):
        new = [a]
        for b, y in enumerate(text):
            new.append(min(row[b] + (x != y), row[b + 1] + 1, new[b] + 1))
        row = new
    return min(row)


def test_passages_within_the_edit_budget_are_found(spark):
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    texts = [r["text"] for r in table(spark, SF, "documents").limit(60).collect()]
    known, rng = decontaminate.Items(items), random.Random(0)
    hit = 0
    for _ in range(40):
        k = rng.randrange(len(known.ids))
        passage = list(known.texts[k])
        for _ in range(rng.randint(0, int(0.12 * len(passage)))):
            at = rng.randrange(len(passage))
            passage[at:at + rng.randint(0, 1)] = rng.choice(["", "x", "qz"])
        text = decontaminate.normal(rng.choice(texts)[:300] + " " + "".join(passage) + " " + rng.choice(texts)[:200])
        true = edits(known.texts[k], text)
        found = {m[0]: m[1] for m in known.matches(text)}
        assert (true <= known.budget[k]) == (k in found)
        if k in found:
            hit += 1
            assert found[k] == true
    assert hit > 10


def test_decontamination_query_and_edges(spark):
    docs, items = table(spark, SF, "documents"), [(r["item_id"], decontaminate.normal(r["text"])) for r in table(spark, SF, "benchmark").collect()]
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in queries.QUERIES["op5_decontaminate"](spark, SF).collect()}
    whole = {(d["doc_id"], i) for d in docs.collect() for i, t in items if t in decontaminate.normal(d["text"])}
    assert whole and whole == {k for k, e in got.items() if e == 0}
    bench = spark.createDataFrame([(1, "the quick brown fox jumped over the lazy dog"), (2, None), (3, ""), (4, "Yes!"), (4, "Yes!")], "item_id long, text string")
    rows = [(1, "Foo İstanbul: The QUICK brown — fox, jumped over the lazy dog again", 0), (1, "yes", 1), (2, "yes, no", 2), (3, None, 3), (None, "", 4)]
    given = spark.createDataFrame(rows, "doc_id long, text string, passages int")
    for block in (10, 1_000_000):
        found = decontaminate.find_passages(given, bench, block_chars=block)
        assert found.columns == ["doc_id", "text", "passages", "passages_"]
        by = {r["passages"]: r["passages_"] for r in found.collect()}
        assert [rows[0][1][p["start"]:p["end"]] for p in by[0]] == ["The QUICK brown — fox, jumped over the lazy dog"]
        assert [len(by[k]) for k in (1, 2, 3, 4)] == [2, 0, 0, 0]
    assert sorted(r["passages"] for r in decontaminate.clean(given, bench).collect()) == [2, 3, 4]
    assert decontaminate.clean(given, bench.limit(0)).count() == 5 and decontaminate.clean(given.limit(0), bench).count() == 0


def test_repeated_and_empty_items_do_not_fill_a_block(spark, monkeypatch):
    seen, make = [], decontaminate.Items.__init__
    monkeypatch.setattr(decontaminate.Items, "__init__", lambda self, rows, *a: seen.append(len(rows)) or make(self, rows, *a))
    bench = spark.createDataFrame([(1, "a passage that is often repeated")] * 40 + [(None, None)] * 40 + [(2, "")] * 40 + [(3, "tiny")] * 2 + [(None, "another passage, only once")],
                                  "item_id long, text string")
    given = spark.createDataFrame([(1, "see: a passage that is often repeated."), (2, "Tiny"), (3, "with another passage, only once"), (4, "clean")], DOC)
    found = {r["doc_id"]: [p["item_id"] for p in r["passages"]] for r in decontaminate.find_passages(given, bench, block_chars=30).collect()}
    assert found == {1: [1] * 40, 2: [3, 3], 3: [None], 4: []}
    assert sum(seen) == 3
