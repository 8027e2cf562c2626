"""Benchmark windows in documents against brute force."""

import re
from collections import Counter

import duckdb
import pytest

import check_oracles
from lotledger.llm import contamination, queries
from lotledger.plans.vehicle_tables import TABLES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(10, len(w))
        for p in range(len(w) - size + 1 if w and item is not None else 0):
            windows.setdefault(tuple(w[p:p + size]), set()).add(str(item))
    out = Counter()
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for p in range(len(w)):
            for size in range(1, 11):
                if p + size <= len(w) and tuple(w[p:p + size]) in windows:
                    hit |= set(range(p, p + size))
                    found |= windows[tuple(w[p:p + size])]
        out[doc, len(w), len(hit), tuple(sorted(found)), bool(hit)] += 1
    return out


def rows_of(found):
    return Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in found.collect())


LONG = " ".join(f"w{i}" for i in range(24))
ITEMS = [
    (1, LONG), (2, "Only THREE words"), (3, "pair of"), (4, "solitaire"), (5, None), (6, " .,! "), (None, "never counted at all"),
    (7, LONG), (10, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9"), (11, "Éa éA été ñ 中文"), (12, "a a a a a a a a a a a"), (1, "pair of"),
]
DOCS = [
    (1, LONG), (2, f"x {LONG.upper()} y. {LONG}"), (3, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 stop"), (4, "w1 w2 w3 w4 w5 w6 w7 w8 w9"),
    (5, None), (6, ""), (7, "only-three_words; solitaire,pair\x00of"), (8, "a " * 3000), (9, "éa éa été ñ 中文"), (10, "Éa éa été ñ 中文!"),
    (11, "pair of pair of pair"), (11, "pair of pair of pair"), (11, "pair"), (None, "solitaire"), (None, "solitaire"), (12, "never counted at all"),
    (13, "the quick brown fox " * 500 + "solitaire"),
]


@pytest.mark.parametrize("limit", [contamination.BROADCAST_BYTES, 0])
def test_windows_against_brute_force(spark, limit):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "1 AS words", "'x' AS item_id", "2 AS place")
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS window")
    assert rows_of(contamination.decontaminate(docs, items, limit)) == brute(DOCS, ITEMS)


def test_no_items_and_no_documents(spark):
    docs = spark.createDataFrame(DOCS[:3], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert rows_of(contamination.decontaminate(docs, none)) == brute(DOCS[:3], [])
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert contamination.decontaminate(docs.limit(0), items).count() == 0


def test_query_against_sql(spark, sf_dir):
    con = duckdb.connect()
    for name in TABLES + ["documents", "benchmark"]:
        con.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    assert "op11_contamination" in queries.ORACLES
    verdict, detail, _ = check_oracles.compare(spark, con, "op11_contamination", sf_dir)
    assert verdict == "ok", detail


def test_main_path_is_native(spark, sf_dir):
    plan = queries.op11_contamination(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
