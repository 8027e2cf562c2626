"""Page extraction on literal pages."""

import pytest
from pyspark.sql import functions as F

from lotledger.catalogue import pages as pages_queries
from lotledger.functions.text import join_text
from lotledger.operators import extract

LISTING = (
    '<body><div class="i" data-impression="11|999|x"><span>a</span></div>\n'
    '<div data-impression="12|500|y"><span>b</span><span>계약중</span></div>'
    '<div data-impression="13"><span>c</span></div><div data-impression=""></div>'
    '<div data-impression="11|998|z">\n</div></body>'
)
INSPECTION = (
    "<ul><li><span>변속기</span><span> 자동 (수동) </span></li><li><span>연료</span><span></span></li></ul>"
    "<ul><li><span>계기</span><span>양호</span></li></ul>"
)


@pytest.fixture
def nodes(spark):
    pages = spark.createDataFrame([(1, LISTING), (2, "<body></body>"), (3, None)], "page_id long, html string")
    return extract.listing_nodes(pages, ["page_id"])


def test_listing_nodes(nodes):
    assert [(r.position, r.attribute) for r in nodes.orderBy("position").collect()] == [
        (0, "11|999|x"), (1, "12|500|y"), (2, "13"), (3, ""), (4, "11|998|z")]
    assert extract.drop_reserved(nodes).count() == 4
    parsed = extract.parse_listing(extract.drop_reserved(nodes))
    assert sorted((r.id, r.price) for r in parsed.collect()) == [("11", "998"), ("11", "999")]
    assert sorted(r.id for r in extract.listing_ids(nodes).collect()) == ["11", "12", "13"]


def test_empty_pages(spark):
    pages = spark.createDataFrame([("<strong>검색 조건에 맞는 차량이 없습니다</strong>",), ("<p>1</p>",)], "html string")
    assert extract.drop_empty_pages(pages).count() == 1


def test_fields_by_place(spark):
    pages = spark.createDataFrame([(1, INSPECTION), (2, "<p>nothing</p>"), (3, None)], "id long, html string")
    got = {r.id: r for r in extract.extract_fields(pages, extract.COLLECT_FIELDS, ["id"]).collect()}
    assert len(got) == 3
    assert got[1].gearbox == "자동 (수동)" and got[1].fuel_type == "" and got[1].mileage_condition == "양호"
    assert got[1].mileage is None and got[2].gearbox is None and got[3].gearbox is None


def test_fields_by_label(spark):
    html = (
        "<ul><li>용도 변경이력 <b><span>없음</span><span>x</span></b></li></ul>"
        "<table><tr><th>제작사 이름</th> <td>가</td><th>연식</th><td> 2020 </td></tr><tr><th>연식</th><td>1999</td></tr></table>"
    )
    pages = spark.createDataFrame([(1, html)], "id long, html string")
    row = extract.extract_labelled(
        pages, {"maker": "제작사", "year": "연식", "absent": "배기량"}, {"use": "용도 변경이력", "none": "특수"}, ["id"]
    ).first()
    assert (row.maker, row.year, row.absent, row.use, row.none) == ("가", "2020", None, "없음", None)


def test_join_text(spark):
    df = spark.createDataFrame([("<span>a</span><i><span>b</span></i>",), ("",)], "html string")
    assert [r[0] for r in df.select(join_text(F.col("html"), extract.SPAN_TEXT)).collect()] == ["a,b", ""]


def test_incomplete_rows(spark):
    df = spark.createDataFrame(
        [(1, "a", "b", "c"), (2, "a", None, "c"), (3, "a", " ", "c"), (4, None, "b", "c")],
        "id int, x string, y string, z string",
    )
    assert sorted(r.id for r in extract.require_all(df, ["x", "y", "z"]).collect()) == [1, 3]
    assert [r.id for r in extract.require_all(df, ["x", "y", "z"], blank_is_missing=True).collect()] == [1]
    kept = {r.id: (r.x, r.y, r.z) for r in extract.default_after_failure(df, ["x", "y", "z"]).collect()}
    assert kept == {
        1: ("a", "b", "c"), 2: ("a", "N/A", "N/A"), 3: ("a", "N/A", "c"), 4: ("N/A", "N/A", "N/A"),
    }


def test_pages_are_matched_once(spark):
    pages = spark.createDataFrame([(1, INSPECTION)], "id long, html string")
    df = extract.require_all(extract.extract_fields(pages, extract.INSPECTION_FIELDS, ["id"]), ["transmission", "warranty"])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(__page") == 1


MARKED = (
    "<dl><dd class='a'>12<b>가</b> 3456</dd></dl><table><tr><td>x</td><td> 그랜저&nbsp;<b>HG</b> </td></tr></table><ul><li>a</li><li>b</li>"
    "<li><span class='o'><span>1<b>회</b></span><span><!-- <span> -->2회 &amp;lt; &#44032;&#x1F697;</span></span></li>"
    "<li><span><span></span><i><span>없음 &lt;1&gt; &unknown; & b</span></i></span></li><li><p>5</p></li><li><span>a<br/>b</span></li></ul>"
)


def test_fields_with_inner_markup(spark):
    pages = spark.createDataFrame([(1, MARKED), (2, "<ul><li><span>" + "<i>x</i>" * 1500 + "</span></li></ul>")], "id long, html string")
    got = extract.extract_fields(pages, extract.ACCIDENT_FIELDS, ["id"])
    row = got.where("id = 1").first()
    assert (row.license, row.model, row.license_changed, row.owner_changed) == ("12가 3456", "그랜저 HG", "1회", "2회 &lt; 가🚗")
    assert (row.total_loss, row.flood, row.theft, row.cm, row.co) == ("", "없음 <1> &unknown; & b", None, None, "a\nb")
    stopped = extract.default_after_failure(got, ["license", "flood", "cm", "co"]).where("id = 1").first()
    assert (stopped.license, stopped.flood, stopped.cm, stopped.co) == ("12가 3456", "없음 <1> &unknown; & b", "N/A", "N/A")
    assert extract.extract_fields(pages, {"long": [extract.Step(extract.SPAN_TEXT, 1)]}, ["id"]).where("id = 2").first().long == "x" * 1500
    status = spark.createDataFrame([(1, "<ul><li><span>변속기</span><span>자동 <em>(8단)</em></span></li></ul>")], "id long, html string")
    assert extract.extract_fields(status, extract.INSPECTION_FIELDS, ["id"]).first().transmission == "자동 (8단)"


def test_labels_with_inner_markup(spark):
    html = (
        "<table><thead><tr><th>제목</th></tr></thead><tr><th><b>제작</b>사</th><td>현대&middot;<a href='x'>기아</a></td>"
        "<th>연식</th><td>2020</td></tr></table><ul><li>용도&nbsp;<b>변경</b>이력 <span>있<i>음</i></span></li></ul>"
    )
    pages = spark.createDataFrame([(1, html)], "id long, html string")
    row = extract.extract_labelled(pages, {"maker": "제작사", "year": "연식", "title": "제목"}, {"use": "용도 변경이력"}, ["id"]).first()
    assert (row.maker, row.year, row.title, row.use) == ("현대·기아", "2020", None, "있음")


def test_history_queries_match_only_their_fields(spark, monkeypatch):
    """Fields that a query does not return are not looked for."""
    seen = []
    monkeypatch.setattr(pages_queries, "accident_pages", lambda *_: None)
    monkeypatch.setattr(pages_queries.extract, "extract_fields", lambda pages, fields, keep: seen.append(list(fields)))
    pages_queries._history_fields(spark, "")
    assert seen == [pages_queries.HISTORY_FIELDS]


def test_text_of_a_node_with_breaks_and_entities(spark):
    rows = [("a<BR/>b &amp; <b>c</b>",), ("a<bR>b",), ("<break>x",), ("&lt;br&gt;",), ("plain",), (None,)]
    got = spark.createDataFrame(rows, "node string").select(extract.inner_text(F.col("node")).alias("x")).collect()
    assert [r.x for r in got] == ["a\nb & c", "a\nb", "x", "<br>", "plain", None]
