"""Main text against a reader that builds the tree of a page."""

from __future__ import annotations

from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from lethe.llm.html_extract import extract_main_text, main_text

SF = "/root/testdata/sf0.01"
VOID = {"meta", "br", "img", "input", "link", "hr"}
DROPPED = {"script", "style", "title", "nav", "footer", "aside", "form", "head"}
BLOCKS = {"p", "h1", "h2", "div", "section", "article", "main", "ul", "li", "body", "html", "header"} | DROPPED
LONG = "word " * 900


class Tree(HTMLParser):
    """Text blocks of a page without the elements that ``dropped`` names by tag and classes."""

    def __init__(self, dropped):
        super().__init__(convert_charrefs=True)
        self.dropped, self.open, self.blocks = dropped, [], [""]

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.blocks.append("")
        if tag == "br":
            self.handle_data(" ")
        if tag not in VOID:
            gone = tag in DROPPED or (dict(attrs).get("class") or "") in self.dropped
            self.open.append((tag, gone or bool(self.open and self.open[-1][1])))

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.blocks.append("")
        if tag in [t for t, _ in self.open]:
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if not (self.open and self.open[-1][1]):
            self.blocks[-1] += data


def tree_text(page, dropped=()):
    tree = Tree(set(dropped))
    tree.feed(page)
    tree.close()
    return "\n".join(b for b in (" ".join(b.split()) for b in tree.blocks) if b)


def test_every_page_equals_its_tree(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = extract_main_text(pages).join(pages.select("page_id", "html"), "page_id").collect()
    assert len(got) == pages.count() > 0
    for r in got:
        assert r.text == tree_text(r.html or "", {"ad"}) and r.n_chars == len(r.text)


LAYOUTS = {
    "title beside": "<body><h1>Title {i}</h1><div class='post-body'><p>{long}</p></div></body>",
    "lead beside": "<body><div class='intro'>Lead {i}</div><div class='content'><p>{long}</p></div></body>",
    "end beside": "<body><div class='content'><p>{long}</p></div><p>The end {i}</p></body>",
    "dense part": "<body><article><p>First {i}</p><div class='x'><p>{long}</p></div><div class='y'>Last</div></article></body>",
    "byline": "<body><div class='post'><h1>T {i}</h1><div class='who'>By A</div><div class='text'>{long}</div></div></body>",
    "title above": "<body><main><h1>Title {i}</h1><article><p>{long}</p></article></main></body>",
    "stray less": "<body><div class='content'><p>3 {i} &lt; 4</p><p>{long}</p></div>< 5 apples",
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_nothing_of_an_article_is_lost(spark, name):
    made = {i: LAYOUTS[name].format(i=i, long=f"{i} {LONG}") for i in range(5)}
    rows = [(i, "https://one.example/a", page) for i, page in made.items()]
    rows.append((9, "https://alone.example/a", made[0]))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract_main_text(frame).collect()}
    assert got == {i: tree_text(made.get(i, made[0])) for i in [*made, 9]}


ASIDES = (
    "comments-container post-comments related-posts page-footer page-header sidebar-content cookie-text"
    " newsletter-container comment-body commentBody ad ad-slot article-share popup-text search-page"
).split()


@pytest.mark.parametrize("name", ASIDES)
def test_aside_words_win_in_names(name):
    for page in (
        "<body><div class='{n}'>Bad</div><div class='post'><h1>T</h1><p>{long}</p><div id='{n}'><p>Bad</p></div></div></body>",
        "<body><article><p>{long}</p></article><section class='x {n}'><div class='content'>Bad</div></section></body>",
    ):
        assert "Bad" not in main_text(page.format(n=name, long=LONG), None)
        assert main_text(page.format(n=name, long=LONG), None).count("word") == 900


def test_names_of_the_article_itself():
    for name in ("post-content share-on", "has-sidebar", "entry-header", "content-with-sidebar", "articleBody menu"):
        assert main_text(f"<body><div class='{name}'><p>Hello</p></div></body>", None) == "Hello"


def test_long_pages_ties_and_odd_rows(spark):
    long = "<body><article>" + "<p>some words here</p>" * 60_000 + "</article></body>"
    twin = "<body><div class='a1'><p>x y</p></div><div class='b1'><p>x z</p></div></body>"
    deep = "<body>" + "<div>" * 3000 + "<p>deep down</p>"
    rows = [(1, "https://l.example/", long), (2, "https://t.example/", twin), (2, "https://t.example/", twin),
            (3, "not a url", deep), (4, None, None), (5, "https://t.example/2", " \n"), (None, None, "<p>a</p>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    frame = frame.withColumn("agreed", F.lit("x")).withColumn("text", F.lit(0)).withColumn("_value", F.lit(0))
    got = extract_main_text(frame).collect()
    texts = {(r.page_id, r.text) for r in got if r.page_id != 1}
    assert texts == {(2, "x y\nx z"), (3, "deep down"), (4, ""), (5, ""), (None, "a")} and len(got) == 7
    assert next(r.text for r in got if r.page_id == 1) == "\n".join(["some words here"] * 60_000)
