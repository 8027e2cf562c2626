"""Collocations against brute force."""

import re
from collections import Counter

import duckdb
import numpy as np
import pytest

import check_oracles
from lotledger.llm import collocations
from lotledger.plans.vehicle_tables import TABLES

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, least, percent, top):
    f, total = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            f.update((lang, *w[p:p + size]) for size in (1, 2, 3) for p in range(len(w) - size + 1))
    found = {}
    for (lang, *w), a in f.items():
        if len(w) > 1 and a >= least:
            cuts = [(1000000 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, *w[:k]], f[lang, *w[k:]], w))
    out = set()
    for lang, rows in found.items():
        held = {tuple(w[i:i + 2]): [] for *_, w in rows if len(w) == 3 for i in (0, 1)}
        for _, a, *_, w in rows:
            for i in (0, 1) if len(w) == 3 else ():
                held[tuple(w[i:i + 2])].append(-a)
        kept = sorted(r for r in rows if len(r[-1]) == 3 or all(100 * b < percent * -r[1] for b in held.get(tuple(r[-1]), [])))
        out |= {(lang, i, p.decode(), -a, le, r, total[lang], -s) for i, (s, a, p, le, r, _) in enumerate(kept[:top], 1)}
    return out


def rows_of(found):
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def random_docs(seed, count=260):
    random = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(40)] + ["É", "é", "The", "the", "x\x0by", "中文"]
    weights = 1 / np.arange(1, len(words) + 1)
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " ! "]
    docs = []
    for _ in range(count):
        drawn = random.choice(words, random.integers(0, 60), p=weights / weights.sum())
        docs.append(("".join(w + random.choice(marks) for w in drawn), [None, "en", "fr", "und", ""][random.integers(0, 5)]))
    return docs + [(None, "en"), ("", None), (" .,", "de"), ("buy now " * 400, "en"), ("one two three four five. " * 30, "de")]


@pytest.mark.parametrize(("seed", "least", "percent", "top"), [(1, 10, 50, 2000), (2, 3, 20, 25), (3, 1, 100, 2000)])
def test_phrases_against_brute_force(spark, seed, least, percent, top):
    docs = random_docs(seed)
    table = spark.createDataFrame(docs, "text string, lang string").selectExpr("*", "1 AS n", "'x' AS w1", "2 AS deal").repartition(3)
    assert rows_of(collocations.collocations(table, least, percent, top)) == brute(docs, least, percent, top)


def test_hot_words_and_pairs_are_merged(spark, monkeypatch):
    docs = random_docs(4) + [(f"of the n{i} of the m{i}", "en") for i in range(300)]
    table = spark.createDataFrame(docs, "text string, lang string")
    monkeypatch.setattr(collocations, "BUCKET_BYTES", 1 << 10)
    layout = collocations._layout(table)
    assert layout.buckets > 20 and "of" in layout.words and "of the" in layout.pairs
    assert rows_of(collocations.collocations(table)) == brute(docs, 10, 50, 2000)
    monkeypatch.setattr(collocations, "_layout", lambda docs: collocations.Layout(7, [], []))
    assert rows_of(collocations.collocations(table)) == brute(docs, 10, 50, 2000)


def test_counts_whose_products_pass_64_bits(spark):
    rows = [(10**15, 10**15 + 9, 10**15 + 1), (3 * 10**12, 4 * 10**12, 5 * 10**12 + 7), (1, 1, 1)]
    got = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", collocations._score("a", "l", "r").alias("s")).collect()
    assert [r.s for r in got] == [1000000 * a * a // (le * r) for a, le, r in rows]


def test_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0


def test_query_against_sql(spark, sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    verdict, detail, _ = check_oracles.compare(spark, con, "op13_collocations", sf_dir)
    assert verdict == "ok", detail
