"""Per-brand CSV files under the report headers: parsing, brands and imputed totals."""

import pytest
from pyspark.sql import functions as F

from lotledger.functions.claims import parse_claims
from lotledger.operators.impute import impute_mean
from lotledger.operators.relational import harmonise, remaining_ids
from lotledger.plans.jobs import brand_merge
from lotledger.schemas import ERROR_IDS, INSURANCE_NAMES, insurance_schema
from lotledger.sources.readers import read_brand_files, read_table

HEADER = ",".join(INSURANCE_NAMES["report"])
SAME = '0회,1회,전손 0회,"침수(전손,분손) 0회",도난 0회'
ROWS = {
    "kia": [f'1,10가1000,{SAME},"2회1,000원","1회/442,480원"', f"2,10가1001,{SAME},없음,없음"],
    "genesis": [f'3,10가1002,{SAME},1회미확정,2회/미확정', f"4,10가1003,{SAME},N/A,N/A", f'5,10가1004,{SAME},"1회4,003원",없음'],
}


@pytest.fixture
def files(tmp_path):
    for brand, lines in ROWS.items():
        tmp_path.joinpath(f"claims_{brand}.csv").write_text("\n".join([HEADER, *lines]) + "\n", encoding="utf-8")
    return [str(tmp_path / f"claims_{brand}.csv") for brand in ROWS]


def test_brand_comes_from_the_file_name(spark, files):
    df = harmonise(read_brand_files(spark, files, insurance_schema("report")), "report")
    assert df.columns == [*INSURANCE_NAMES["current"], "brand"]
    counts = {r["brand"]: r["count"] for r in df.groupBy("brand").count().collect()}
    assert counts == {"KIA": 2, "GENESIS": 3}
    assert {r.flood for r in df.select("flood").distinct().collect()} == {"침수(전손,분손) 0회"}


@pytest.mark.parametrize("column,known,filled", [
    # Means: (1000 + 0 + 4003) / 3 = 1667.67 and (442480 + 0 + 0) / 3 = 147493.33.
    ("cm", (5, 1, 2, 4, 5003), 5003 + 2 * 1668),
    ("co", (5, 1, 2, 3, 442480), 442480 + 2 * 147493),
])
def test_claim_totals(spark, files, column, known, filled):
    df = harmonise(read_brand_files(spark, files, insurance_schema("report")), "report")
    parsed = df.select(parse_claims(F.col(column)).alias("p")).select("p.count", "p.total")
    totals = parsed.agg(
        F.count("*"), F.count_if(F.col("count").isNull()), F.count_if(F.col("total").isNull()),
        F.sum("count"), F.sum("total"),
    ).first()
    assert tuple(totals) == known
    assert impute_mean(parsed, ["total"]).agg(F.sum("total")).first()[0] == filled


def test_merged_brands_keep_all_rows(spark, files):
    tables = [read_brand_files(spark, [f], insurance_schema("report")) for f in files]
    merged = brand_merge(tables, "report")
    assert sorted(r.id for r in merged.collect()) == ["1", "2", "3", "4", "5"]


def test_error_ids_with_windows_line_ends(spark, tmp_path):
    tmp_path.joinpath("failed.csv").write_bytes(b"id\r\n7\r\n8\r\n7\r\n")
    ids = read_table(spark, str(tmp_path / "failed.csv"), ERROR_IDS)
    assert ids.count() == 3
    assert sorted(r.id for r in remaining_ids(ids, ids.limit(0)).collect()) == [7, 8]
