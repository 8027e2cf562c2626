"""The filter audit against brute force."""

import re
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pyarrow as pa

import check_oracles
from lotledger.llm import filter_audit
from lotledger.plans.vehicle_tables import TABLES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    return (len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text)))


def measured(texts):
    found = filter_audit.measure(pa.array(texts, pa.string()))
    return list(zip(*[found[n].tolist() for n in ("words", "distinct", "capitals", "characters", "symbols")], strict=True))


def odd_texts():
    random = np.random.default_rng(7)
    letters = list("aAbB é中\t\n\r\x0b\x0c\x1c#|* 😀x\x00")
    texts = ["".join(random.choice(letters, random.integers(0, 60))) for _ in range(300)]
    stem = "x" * 70
    texts += [None, "", " ", "\n\n", stem + " " + stem + "y " + stem, "a" * 200_000 + " " + "a" * 199_999 + " " + "a" * 200_000]
    texts += ["abcdefgh abcdefghi abcdefgh abcdefghj abcdefghijklmnop abcdefghijklmnoq", "word " * 5000, "A", " a", "a "]
    return texts


def test_one_pass_counts():
    texts = odd_texts()
    assert measured(texts) == [counts(t) for t in texts]
    assert measured([]) == []


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(filter_audit, "mix", lambda x: x & np.uint64(1))
    texts = odd_texts()[:60] + ["a b c a", "abcdefghij abcdefghik " * 3]
    assert measured(texts) == [counts(t) for t in texts]


def brute(docs, labels):
    rows, out = [], Counter()
    marks = {}
    for doc, quality, toxic in labels:
        old = marks.get(doc, (False, False))
        marks[doc] = (old[0] or quality == 1, old[1] or toxic == 1)
    for doc, text, source in docs:
        words, distinct, capitals, chars, symbols = counts(text)
        same = [d for d, t, _ in docs if (t or "") == (text or "") and d is not None and doc is not None and d < doc]
        good, toxic = marks.get(doc, (False, False)) if doc is not None else (False, False)
        rows.append((source or "", (words < 200, 100 * distinct < 50 * words, 100 * capitals > 2 * chars, symbols > 0, bool(same)), good, toxic))
    for part in {r[0] for r in rows}:
        mine, lines, shapley = [r for r in rows if r[0] == part], [], Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                k = "ABCDE".index(name)
                gone = [r for r in left if r[1][k]]
                stay = [r for r in left if not r[1][k]]
                shapley[name] += len(gone)
                lines.append((part, "".join(order), step, len(stay), len(gone), sum(r[1][k] for r in mine) - len(gone),
                              sum(r[1][k] and sum(r[1]) == 1 for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone), name))
                left = stay
        out.update(Counter((*line[:-1], shapley[line[-1]]) for line in lines))
    return out


def test_audit_against_brute_force(spark):
    full = " ".join(f"w{i}" for i in range(220))
    docs = [
        (1, full, "a"), (2, full, "a"), (2, full, "a"), (3, full, None), (4, full + " #", "a"), (5, None, "b"), (6, "", "b"), (6, "", "a"),
        (None, full, "a"), (None, "short", None), (7, "A B C", "a"), (8, "same " * 300, "b"), (9, full.upper(), "b"), (10, full + " #", ""),
        (11, "SAME | " * 300, "b"), (2, "other text of id two", "b"), (0, "same " * 300, "c"),
    ]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (4, 1, 1), (99, 1, 1), (None, 1, 1), (8, None, None), (11, 1, 1)]
    table = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("*", "1 AS n", "2 AS mask", "'x' AS part")
    found = filter_audit.audit(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "1 AS good"))
    got = Counter(tuple(r) for r in found.collect())
    assert got == brute(docs, labels)


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert filter_audit.audit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_query_against_sql(spark, sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    verdict, detail, _ = check_oracles.compare(spark, con, "op12_filter_audit", sf_dir)
    assert verdict == "ok", detail
