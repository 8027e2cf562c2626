"""Vehicle-shaped tables expressed over the provided order tables.

Orders stand in for listings and their line items for the claim history, so the operators
run over whole tables whose size follows the data. Every column is a fixed expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(*parts: Column | str) -> Column:
    """Concatenation of columns and literal texts."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _grouped(number: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(number, 0)


def price(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.floor(F.pow(F.col("o_totalprice") / 100000, 6)).cast("int").alias("price"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: line count, suppliers, line number range and claim amount."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("l_suppkey").alias("ns"),
            F.min("l_linenumber").alias("minl"),
            F.max("l_linenumber").alias("maxl"),
            (10000 * F.sum("l_quantity")).cast("long").alias("amt"),
        )
    )


def history_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "id")
    k, n, ns, amt = F.col("id"), F.col("n"), F.col("ns"), F.col("amt")
    own = (
        F.when(n == 1, "없음")
        .when((F.col("minl") > 1) & (k % 40 == 7), "미확정")
        .when(F.col("minl") > 1, _text(n, "회미확정"))
        .otherwise(_text(n, "회", _grouped(amt), "원"))
    )
    other = (
        F.when(n < 3, "없음")
        .when((F.col("maxl") == 7) & (k % 3 == 0), _text(n, "회/미확정"))
        .otherwise(_text(ns, "회/", _grouped(F.floor(amt / 10)), "원"))
    )
    fuel = F.when(F.col("o_orderstatus") == "F", "가솔린").when(F.col("o_orderstatus") == "O", "디젤").otherwise("LPG")
    return orders.join(order_lines(spark, sf_dir), "id").select(
        "id",
        _text(F.col("o_custkey"), "가", k).alias("license"),
        F.col("o_orderpriority").alias("model"),
        fuel.alias("fuel"),
        _text(1000 + 100 * n, "cc").alias("cc"),
        F.date_format("o_orderdate", "yyyy/MM/dd").alias("registration_date"),
        _text(k % 3, "회").alias("license_changed"),
        _text(ns, "회").alias("owner_changed"),
        _text("전손 ", F.when(k % 50 == 0, 1).otherwise(0), "회").alias("total_loss"),
        _text("침수(전손,분손) ", F.when(k % 70 == 0, 1).otherwise(0), "회").alias("flood"),
        F.lit("도난 0회").alias("theft"),
        own.alias("cm"),
        other.alias("co"),
    )


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")

    def present(modulus: int) -> Column:
        return F.when(k % modulus == 3, "있음").otherwise("없음")

    little = F.when(k % 5 == 3, "있음").when(k % 101 == 0, F.lit(None)).otherwise("없음")
    # Not every listing discloses its inspection: here those registered on a Saturday do not.
    return orders.where(F.dayofweek("o_orderdate") != 7).select(
        k.alias("id"),
        F.when(k % 9 == 0, "수동").when(k % 9 == 1, "-").otherwise("오토").alias("transmission"),
        F.lit("보험사보증").alias("warranty"),
        F.when(k % 97 == 0, "-").otherwise(_text(_grouped(F.floor("o_totalprice")), "km")).alias("mileage"),
        present(10).alias("tuning_history"),
        present(11).alias("special_history"),
        F.when(k % 12 == 3, "있음 / 렌트").otherwise("없음").alias("usage_change"),
        present(13).alias("accident"),
        little.alias("little_accident"),
    )


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing page per order: its own node, an older listing seen again, and a reserved one."""
    k, p = F.col("id"), F.col("price")

    def node(attribute: Column, name: str, tag: Column | str = "") -> Column:
        return _text('<div class="item" data-impression="', attribute, '"><span>', name, "</span>", tag, "</div>")

    own = F.when(k % 19 == 0, F.lit("")).when(k % 23 == 0, k.cast("string")).otherwise(_text(k, "|", p, "|1"))
    again = _text(k - k % 5, "|", p + k % 5, "|2")
    held = _text(k + 1, "|", p, "|3")
    # Some nodes hold other blocks before the text that tells a reserved listing.
    icon = F.when(k % 3 == 0, "<div class='icon'><div>i</div></div>").when(k % 3 == 1, "<DIV>i</DIV>").otherwise("")
    empty = F.when(k % 31 == 0, "<strong>검색 조건에 맞는 차량이 없습니다</strong>").otherwise("")
    html = _text(
        "<html><body>", node(own, "매물", icon), node(again, "매물"),
        node(held, "매물", _text(icon, "<span>계약중</span>")), empty, "</body></html>",
    )
    return price(spark, sf_dir).select(k.alias("page_id"), html.alias("html"))



def _accident_html() -> Column:
    """The accident report, over the columns of ``history_raw``."""
    k = F.col("id")
    year = F.substring("registration_date", 1, 4)
    claims = F.when(k % 29 == 4, "").otherwise(
        _text(
            "<li><strong>보험사고 이력 (내차 피해)</strong><span>", F.col("cm"), "</span></li>",
            "<li><strong>보험사고 이력 (타차 가해)</strong><span>", F.col("co"), "</span></li>",
        )
    )
    plate = F.when(k % 41 == 0, "").otherwise(_text("<dl><dt>차량번호</dt><dd>", F.col("license"), "</dd></dl>"))
    losses = F.when(k % 53 == 7, "").otherwise(_text(
        "<span><span>", F.col("total_loss"), "</span><span>", F.when(k % 37 == 0, " ").otherwise(F.col("flood")),
        "</span><span>", F.col("theft"), "</span></span>"))
    inner = F.when(k % 7 == 2, "<ul class='help'><li>도움말</li><li><b>안내</b></li></ul><!-- <li><span>x</span></li> -->").otherwise("")
    model = (
        F.when(k % 7 == 3, _text("<table><tr><td><b>", F.col("model"), "</b></td></tr><tr><td></td></tr></table>"))
        .when(k % 7 == 4, _text("<i>", F.substring("model", 1, 1), "</i>", F.expr("substring(model, 2)")))
        .otherwise(F.col("model"))
    )
    html = _text(
        '<div id="wrap">', plate, "<ul>",
        "<li><strong>일반사양</strong><span><span>", F.col("fuel"), "</span><span>", F.col("model"),
        "</span><span>", year, "</span></span></li>",
        "<li><strong>용도 변경이력</strong><span>", F.when(k % 12 == 3, "있음").otherwise("없음"), "</span>", inner, "</li>",
        "<li><strong>번호 / 소유자 변경이력</strong><span><span>", F.col("license_changed"), "</span><span>",
        F.col("owner_changed"), "</span></span></li>",
        "<li><strong>특수 사고이력</strong>", losses, "</li>",
        claims, "</ul><table>",
        "<tr><th>제작사</th><td>제작", k % 6, "</td><th>자동차명</th><td>", model, "</td></tr>",
        "<tr><th>연식</th><td>", year, "</td><th>사용연료</th><td>", F.col("fuel"), "</td></tr>",
        "<tr><th>배기량</th><td>", F.col("cc"), "</td><th>차체형상</th><td>세단</td></tr>",
        "<tr><th>용도 및 차종</th><td>자가용</td><th>최초 보험 가입일자</th><td>", F.col("registration_date"),
        "</td></tr></table></div>",
    )
    loud = html
    for tag in ("dl", "dd", "ul", "li", "tr", "td", "th", "table", "span"):
        loud = F.replace(F.replace(loud, F.lit(f"<{tag}>"), F.lit(f"<{tag.upper()} >")), F.lit(f"</{tag}>"), F.lit(f"</{tag.upper()}>"))
    return F.when(k % 7 == 5, loud).otherwise(html)


def accident_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accident report of every listing with a history.

    Some lack the plate, the claims or the losses in between. Some are written in capitals, and
    some have lists within items, tables within cells, inner markup and comments.
    """
    return history_raw(spark, sf_dir).select("id", _accident_html().alias("html"))


def _inspection_html() -> Column:
    """The inspection report, over the columns of ``status``; null fields leave their item out."""
    k = F.col("id")

    def item(label: str, value: Column | str) -> Column:
        return F.coalesce(_text("<li><span>", label, "</span><span>", value, "</span></li>"), F.lit(""))

    return _text(
        "<div><strong>차량, ", k % 1000, "나", k, " </strong></div>",
        "<div><strong>등록일 (최초 ", F.concat_ws("/", F.lit("2020"), F.lpad((k % 12 + 1).cast("string"), 2, "0"), F.lit("01")),
        ")</strong></div>",
        "<ul>", item("변속기", F.col("transmission")), item("연료", F.when(k % 2 == 0, "가솔린").otherwise("디젤")),
        item("보증", F.col("warranty")), "</ul>",
        "<ul>", item("계기", "양호"), item("주행거리", F.col("mileage")), item("차대번호", "양호"),
        item("튜닝", F.col("tuning_history")), item("특별이력", F.col("special_history")),
        item("용도변경", F.col("usage_change")), item("배출가스", "적합"),
        item("리콜", F.when(k % 17 == 0, "대상").otherwise("해당없음")), "</ul>",
        "<ul>", item("사고", F.col("accident")), item("단순수리", F.col("little_accident")), "</ul>",
    )


def inspection_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inspection report of every listing with a status."""
    return status(spark, sf_dir).select("id", _inspection_html().alias("html"))


def report_pairs(spark: SparkSession, sf_dir: str, files: int) -> DataFrame:
    """Both reports of every listing as ``inspection`` and ``accident``, null where there is none.

    Only the short rows are joined and dealt out by id, and pages are made last: their size cannot
    be told from that of the tables, and a plan would take them for small enough to broadcast.
    """
    inspected = status(spark, sf_dir).withColumn("inspected", F.lit(True))
    reported = history_raw(spark, sf_dir).withColumn("reported", F.lit(True))
    rows = (
        price(spark, sf_dir).select("id")
        .join(inspected.hint("merge"), "id", "left").join(reported.hint("merge"), "id", "left").repartition(files, "id")
    )
    return rows.select(
        "id", F.when(F.col("inspected"), _inspection_html()).alias("inspection"), F.when(F.col("reported"), _accident_html()).alias("accident"))
