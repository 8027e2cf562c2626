"""Elements that hold others of their kind, and tags in any case."""

import html.parser

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotledger.operators import extract, nesting


def one(spark, page, column):
    return spark.createDataFrame([(page,)], "html string").select(column.alias("x")).first().x


@pytest.mark.parametrize(("page", "want"), [
    ("<ul><li>a</li></ul>", "<ul><li>a</li></ul>"),
    ("<UL><li>a<ul><li>b</li></ul></li></UL>", "<UL><li>a<ul><li>b</li></ul></li></UL>"),
    ("<UL><li>a<ul><li>b</li></ul></li></UL><li>", "<ul#1><li#2>a<ul#3><li#4>b</li#4></ul#3></li#2></ul#1><li#1></li#1>"),
    ("x<ul><li>a<LI class='b'>c</ul>y", "x<ul#1><li#2>a</li#2><li#2 class='b'>c</li#2></ul#1>y"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "<table#1><tr#2><td#3>a</td#3><td#3>b</td#3></tr#2><tr#2><td#3>c</td#3></tr#2></table#1>"),
    ("</li><li><li>", "</li#0><li#1></li#1><li#1></li#1>"),
    ("<link><link>", "<link><link>"),
    (None, None),
    ("", ""),
])
def test_depths(spark, page, want):
    assert one(spark, page, nesting.marked(F.col("html"), nesting.BLOCKS)) == want
    if want and "#" in want:
        clean = one(spark, want, nesting.unmarked(F.col("html")))
        assert "#" not in clean


def test_long_pages_stay_linear(spark):
    page = "<ul><li><ul><li>x</li></ul></li></ul>" * 4000 + "<li>" * 2000
    marked = one(spark, page, nesting.marked(F.col("html"), nesting.BLOCKS))
    assert marked.startswith("<ul#1><li#2><ul#3><li#4>x</li#4></ul#3></li#2></ul#1><ul#1>") and marked.count("<li#1>") == 2000


class Tree(html.parser.HTMLParser):
    """Outermost cells of the first list item, by the standard library."""

    def __init__(self, page):
        super().__init__()
        self.open, self.cells = [], []
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        if tag == "td" and "td" not in self.open:
            self.cells.append("")
        self.open.append(tag)

    def handle_endtag(self, tag):
        self.open.pop()

    def handle_data(self, data):
        if "td" in self.open:
            self.cells[-1] += data


def random_table(random, depth):
    cells = ["".join(random.choice(["a", "b", " ", "&amp;"], 3)) if depth == 0 or random.random() < .6 else random_table(random, depth - 1) for _ in range(3)]
    tag = random.choice(["td", "TD"])
    return "<table><tr>" + "".join(f"<{tag}>{c}</{tag}>" for c in cells) + "</tr></table>"


def test_cells_against_a_parser(spark):
    random = np.random.default_rng(5)
    pages = [(i, random_table(random, 3)) for i in range(40)]
    fields = {f"c{k}": [extract.Step(extract.TABLE_CELL, k + 1)] for k in range(3)}
    got = extract.extract_fields(spark.createDataFrame(pages, "id long, html string"), fields, ["id"])
    for r in got.collect():
        assert [r.c0, r.c1, r.c2] == [c.strip(" ") for c in Tree(pages[r.id][1]).cells]


def test_deep_nesting_is_marked(spark):
    page = "<td>" * 9 + "x" + "</td>" * 9 + "<td>y</td>"
    rows = spark.createDataFrame([(1, f"<table><tr>{page}</tr></table>")], "id long, html string")
    assert "#" in one(spark, page.replace("td", "ul"), nesting.marked(F.col("html"), nesting.BLOCKS))
    assert extract.extract_fields(rows, {"c": [extract.Step(extract.TABLE_CELL, 10)]}, ["id"]).first().c == "y"
    deep = "<div>" * 30 + "계약중" + "</div>" * 30
    pages = spark.createDataFrame([(1, f'<div data-impression="1|2">{deep}</div><div data-impression="3|4"></div>')], "page_id long, html string")
    left = extract.drop_reserved(extract.listing_nodes(pages, ["page_id"]))
    assert [r.attribute for r in left.collect()] == ["3|4"]


def test_listing_node_has_all_its_descendants(spark):
    page = (
        '<div id="all"><div data-impression="11|900"><div>i</div><span>계약중</span></div>'
        '<div data-impression="12|5"><DIV data-impression="13|6">x</DIV></div><div class="a">계약중</div></div>'
    )
    nodes = extract.listing_nodes(spark.createDataFrame([(1, page)], "page_id long, html string"), ["page_id"])
    assert [r.attribute for r in nodes.orderBy("position").collect()] == ["11|900", "12|5", "13|6"]
    left = extract.drop_reserved(nodes).orderBy("position").collect()
    assert [r.attribute for r in left] == ["12|5", "13|6"] and "#" not in left[0].node


def test_items_around_inner_lists(spark):
    page = (
        "<DL><DD>12가 3</DD></DL><ul><li>1</li><li>2<ul><li><span>no</span></li></ul></li>"
        "<li><span><span>3회</span><span>4회</span></span><!-- </ul> --></li><li>4</li></ul><link href='x'><listing>"
    )
    row = extract.extract_fields(spark.createDataFrame([(1, page)], "id long, html string"), extract.ACCIDENT_FIELDS, ["id"]).first()
    assert (row.license, row.license_changed, row.owner_changed, row.total_loss) == ("12가 3", "3회", "4회", None)


def test_clear_pages_are_those_that_patterns_follow(spark):
    """Pages deeper than patterns go, with tags left open or with loose ends are marked, others never."""
    def depth(n, tag="li"):
        return f"<{tag}>" * n + "x" + f"</{tag}>" * n
    clear = ["", "<ul><li>a<ul><li>b</li></ul></li></ul>", depth(7), depth(7, "LI"), "<link><listing><l", "<<li>a<li >b</li>< /li></li>"]
    unclear = [depth(8), "<li>a<li>b</li>", "<ul><li>a<li>b</ul>", "</li><li><li></li></li>"]
    rows = spark.createDataFrame([(i, page) for i, page in enumerate(clear + unclear)], "id int, html string")
    marked = rows.select("id", "html", nesting.marked(F.col("html"), ("ul", "li")).alias("page"), F.col("html").rlike(nesting._clear("ul", "li")).alias("clear"))
    for r in marked.collect():
        assert r.clear == (r.id < len(clear)) and ("#" in r.page) == (r.id >= len(clear)), r.html


def test_marking_scans_a_page_once_unless_a_tag_is_in_another(spark):
    """Flat pages are told by one expression for all tags, not by one for each."""
    page = spark.createDataFrame([("<ul><li>a</li><li>b</li></ul>",)], "html string")
    assert not page.where(F.col("html").rlike(nesting._nested("ul", "li", "tr", "td"))).count()
    assert spark.range(1).select(F.lit("<tr><td><table><TD>x").rlike(nesting._nested("ul", "td"))).first()[0]


PIECES = ["<ul>", "<ul class='a'>", "</ul>", "</ul >", "<ul title='<li>'>", "<UL>", "</UL>", "<ul/>", "</ulx>", "<li>", "<li\n>", "<li a='>'>", "</li>", "</li >", "<li/>", "<LI>",
          "<link>", "</link>", "<!-- <li> -->", "<span>a</span>", "<span> b<b>c</b></span>", "<span></span>", "<SPAN x>d</SPAN >", "<span>", "</span>", "<strong>e</strong>", "x", "&amp;", ">", "<"]
LIST_FIELDS = {
    "item": [extract.Step(extract.LIST_ITEM, 2)], "block": [extract.Step(extract.LIST_BLOCK, 1)], "both": [extract.Step(extract.LIST_BLOCK, 2), extract.Step(extract.LIST_ITEM, 1)],
    "title": [extract.Step(extract.STRONG_TEXT, 1)],
    **{f"text{b}{i}{k}": [extract.Step(extract.LIST_BLOCK, b), extract.Step(extract.LIST_ITEM, i), extract.Step(extract.SPAN_TEXT, k)] for b in (1, 2) for i in (1, 3) for k in (1, 2)},
    "inner": [extract.Step(extract.LIST_ITEM, 1), extract.Step(extract.LIST_BLOCK, 1), extract.Step(extract.SPAN_TEXT, 1)],
}


def random_page(random):
    def some(most):
        return "".join(random.choice(PIECES[16:-2]) if random.random() > 0.1 else "y" for _ in range(random.integers(most)))

    def block():
        return some(2) + random.choice(PIECES[:2]) + some(2) + "".join(random.choice(PIECES[9:11]) + some(4) + random.choice(PIECES[12:14]) for _ in range(random.integers(4))) + random.choice(PIECES[2:4])

    page = "".join(block() for _ in range(random.integers(4))) + some(2)
    if random.random() < 0.5:
        at = random.integers(len(page) + 1)
        page = page[:at] + random.choice(PIECES) + page[at:]
    return page


@pytest.mark.parametrize("fields", [LIST_FIELDS, {"first": LIST_FIELDS["text111"]}, {"item": LIST_FIELDS["both"], "title": LIST_FIELDS["title"]}])
def test_flat_pages_give_the_same_fields(spark, fields, monkeypatch):
    random = np.random.default_rng(5)
    texts = [random_page(random) for _ in range(1500)] + [None, "", "<ul></ul>", "<ul><li></li></ul>"]
    pages = spark.createDataFrame(list(enumerate(texts)), "id long, html string")
    got = {r.id: r for r in extract.extract_fields(pages, fields, ["id"]).collect()}
    told = {r.id: r.flat for r in pages.select("id", nesting.flat(extract._without_comments(F.col("html"))).alias("flat")).collect()}
    assert len(got) == len(texts) and 300 < sum(map(bool, told.values())) < 1300
    assert any(told[i] and all(v is not None for v in r) for i, r in got.items()) or len(fields) > 3
    monkeypatch.setattr(extract, "_list_pages", lambda pages, keep, html: extract._marked_pages(pages, keep, html, nesting.LISTS).withColumn("__flat", F.lit(False)))
    monkeypatch.setattr(extract, "cut", lambda node, tag, first: F.array(F.lit("wrong")))
    for r in extract.extract_fields(pages, fields, ["id"]).collect():
        assert r == got[r.id], texts[r.id]


def test_flat_pages_are_told_and_may_be_long(spark):
    long = "<ul>" + "<li><span>a</span><span>b</span></li>" * 30_000 + "</ul><ul><li><span>c</span></li></ul>"
    want = {long: True, "<ul><li>a<ul></ul></li></ul>": False, "<ul><li>a<li>b</li></ul>": False, "<UL></UL>": False, "<ul><link></ul>": False, "<table><td>a</table>": True, "": True}
    got = spark.createDataFrame([(p,) for p in want], "html string").select("html", nesting.flat(F.col("html")).alias("flat")).collect()
    assert {r.html: r.flat for r in got} == want
    field = {"last": [extract.Step(extract.LIST_BLOCK, 2), extract.Step(extract.LIST_ITEM, 1), extract.Step(extract.SPAN_TEXT, 1)]}
    pages = spark.createDataFrame([(long,)], "html string")
    assert extract.extract_fields(pages, field, []).first().last == "c"


def test_flat_pages_need_no_list_patterns(spark, monkeypatch):
    # Neither the depths of elements nor the patterns of lists and items are worked out on a flat page.
    monkeypatch.setattr(extract, "marked", lambda *_: F.raise_error(F.lit("marked")).cast("string"))
    monkeypatch.setattr(extract, "inside", lambda _: F.raise_error(F.lit("inside")).cast("string"))
    pages = spark.createDataFrame([("<ul><li><span>a</span><span>b</span></li></ul>",)], "html string")
    field = {"second": [extract.Step(extract.LIST_BLOCK, 1), extract.Step(extract.LIST_ITEM, 1), extract.Step(extract.SPAN_TEXT, 2)]}
    assert extract.extract_fields(pages, field, []).first().second == "b"
