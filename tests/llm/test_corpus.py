"""Operators on whole tables: repeats, near-duplicates, mixing and the pipeline."""

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lotledger.llm import minmax, mixing, queries, repeated_spans
from lotledger.llm.components import connected_components
from lotledger.llm.shingles import shingle_sets
from lotledger.llm.suffix_groups import suffix_arrays


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_suffix_order_of_many_strings():
    random = np.random.default_rng(1)
    for _ in range(60):
        strings = [np.append(random.integers(1, 1 + random.integers(1, 6), random.integers(0, 40)), 0) for _ in range(4)]
        strings += [np.append(np.tile(p, 12), 0) for p in ([1, 2], [1], [2, 1, 1])]
        starts = np.concatenate([[0], np.cumsum([len(s) for s in strings])])
        got = suffix_arrays(np.concatenate(strings), starts)
        for s, a, b in zip(strings, starts, starts[1:], strict=False):
            assert (got[a:b] - a).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    assert len(suffix_arrays(np.zeros(0, int), np.array([0]))) == 0


def brute_spans(rows, window=50):
    seen, out = {}, {}
    for doc, text in rows:
        for p in range(len(b := (text or "").encode()) - window + 1):
            w = b[p:p + window]
            seen[w] = min(seen.get(w, doc), doc)
    for doc, text in rows:
        b = (text or "").encode()
        cover = bytearray(len(b))
        for p in range(len(b) - window + 1):
            if seen[b[p:p + window]] < doc:
                cover[p:p + window] = b"\1" * window
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        spans = sum(1 for i, c in enumerate(cover) if c and (not i or not cover[i - 1]))
        out[doc] = (len(b), sum(cover), spans, hashlib.sha256(kept).hexdigest())
    return out


def digests(df):
    removed = F.aggregate(F.zip_with("begins", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    rows = df.select("doc_id", "n_bytes", removed.alias("r"), F.size("begins").alias("s"), F.sha2("kept", 256).alias("k")).collect()
    return {r.doc_id: (r.n_bytes, r.r, r.s, r.k) for r in rows}


def test_repeated_spans_of_odd_texts(spark):
    random = np.random.default_rng(3)
    base = "".join(random.choice(list("abcdé "), 400))
    rows = [
        (9, base), (3, base[:120] + "XY" + base[120:]), (12, None), (13, ""), (14, "a" * 49), (15, "a" * 300), (16, "a" * 50),
        (20, "pre" + base[100:260] + "post"), (21, base), (30, "ab" * 100), (31, "ba" * 60), (40, base[10:60]), (41, base[10:59]),
    ]
    got = digests(repeated_spans.remove_repeated(table(spark, rows).repartition(3)))
    assert got == brute_spans(rows)


def test_repeated_spans_of_hot_passages(spark, monkeypatch):
    """Many documents share a passage, and the limits on groups are low."""
    monkeypatch.setattr(repeated_spans, "HOT_BLOCKS", 2)
    monkeypatch.setattr(repeated_spans, "BLOCK_BYTES", 4_000)
    monkeypatch.setattr(repeated_spans, "GROUP_BYTES", 300)
    random = np.random.default_rng(4)
    passage = "".join(random.choice(list("abcdefgh "), 150))
    rows = [(i, "".join(random.choice(list("abcd"), random.integers(0, 90))) + passage[: random.integers(60, 150)] + str(i) * 40) for i in range(60)]
    assert digests(repeated_spans.remove_repeated(table(spark, rows).repartition(4))) == brute_spans(rows)


@pytest.mark.parametrize("longest", [200, 2_048])
def test_first_documents_against_brute_force(longest):
    """Segments of a few hashes: random sides, equal sides, equal segments, a hash that comes again."""
    random = np.random.default_rng(5)
    segments = []
    for key in range(4):
        gram = "".join(random.choice(list("abcd"), 16))
        sides = ["".join(random.choice(list("abc"), 34)) for _ in range(5)]
        for _ in range(30):
            left, right = (sides[random.integers(0, 5)] if random.random() < 0.6 else "".join(random.choice(list("abc"), 34)) for _ in "lr")
            segments.append((key, gram, (left[random.integers(0, 20):] + gram + right[:random.integers(16, 34)]).encode()))
        segments.append((key, gram, (sides[0] + gram + sides[1][:10] + gram + sides[2]).encode()))
    segments = [x for x in segments if len(x[2]) >= 50]
    docs = random.integers(0, 40, len(segments))
    h = np.array([repeated_spans._grams(np.frombuffer(g.encode(), np.uint8))[0] for _, g, _ in segments])
    least = {}
    for (key, _, text), doc in zip(segments, docs.tolist(), strict=True):
        for i in range(len(text) - 49):
            least[key, text[i:i + 50]] = min(least.get((key, text[i:i + 50]), doc), doc)
    want = [least[key, text[i:i + 50]] for key, _, text in segments for i in range(len(text) - 49)]
    data = np.frombuffer(b"".join(text for _, _, text in segments), np.uint8)
    lengths = np.array([len(text) for _, _, text in segments])
    assert repeated_spans.first_documents(h, data, lengths, docs, 50, longest).tolist() == want


def test_segments_that_share_little_are_not_sorted(monkeypatch):
    """Most segments of a hash have only its 16 bytes in common; they need no suffix array."""
    sorted_bytes = []
    monkeypatch.setattr(repeated_spans, "suffix_arrays", lambda text, starts: sorted_bytes.append(len(text)) or suffix_arrays(text, starts))
    random = np.random.default_rng(6)
    texts = ["".join(random.choice(list("abcdefgh "), 34)) + "sixteen bytes...".upper() + "".join(random.choice(list("abcdefgh "), 34)) for _ in range(50)]
    h = np.repeat(repeated_spans._grams(np.frombuffer(b"SIXTEEN BYTES...", np.uint8)), 50)
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    got = repeated_spans.first_documents(h, data, np.full(50, 84), np.arange(50), 50, 2_048)
    assert got.tolist() == np.repeat(np.arange(50), 35).tolist()
    assert not sorted_bytes


def test_lists_of_hashes_grow_no_faster_than_the_text():
    for size in (200 << 20, 1 << 30, 20 << 30):
        (a, b), (c, d) = repeated_spans._layout(size), repeated_spans._layout(5 * size)
        assert c * d < 5.2 * a * b


def test_repeated_spans_without_ids_and_rows(spark):
    text = "x y z " * 30
    got = repeated_spans.remove_repeated(table(spark, [(None, text), (1, text), (1, text), (2, text)])).collect()
    assert sorted((r.doc_id or 0, len(r.kept)) for r in got) == [(0, 180), (1, 180), (1, 180), (2, 0)]
    assert repeated_spans.remove_repeated(table(spark, [])).collect() == []


def test_repeated_spans_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op2_repeated_spans(spark, sf_dir).collect()}
    assert got == brute_spans(rows)


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


def brute_components(rows, n, percent):
    sets = [(doc, shingles(text, n)) for doc, text in rows]
    parent = {doc: doc for doc, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            both = len(s & t)
            if s and t and 100 * both >= percent * (len(s) + len(t) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {doc: (len(s), find(doc)) for doc, s in sets}


def test_shingles_are_those_of_the_rule():
    import pyarrow as pa

    texts = [None, "", " \t\n", "One", "one TWO", "a b c", "A\x0bB\x0cC d", "É é é É", "x" * 500 + " y z " + "x" * 500, "b a c", "a b c a b c"]
    got = [len(s) for s in shingle_sets(pa.array(texts), 3)]
    assert got == [len(shingles(t, 3)) for t in texts]
    hashes = [set(s.tolist()) for s in shingle_sets(pa.array(texts), 3)]
    assert hashes[5] == hashes[6] & hashes[5] and not hashes[5] & hashes[9] and hashes[5] < hashes[10]


def test_near_duplicates_in_crowded_buckets(spark):
    """Chains of edits, copies, and buckets whose members are not all linked."""
    random = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        words = list(base)
        for p in random.integers(0, 120, random.integers(0, 9)):
            words[p] = f"e{random.integers(0, 400)}"
        rows.append((i + 1000, " ".join(words)))
    rows += [(5, rows[3][1]), (7, rows[3][1].upper()), (8, None), (9, ""), (10, "lone words"), (11, "Lone words"), (12, "lone")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minmax.near_duplicates(table(spark, rows).repartition(3), 3, 85).collect()}
    assert got == brute_components(rows, 3, 85)


def test_overlaps_are_intersections(monkeypatch):
    random = np.random.default_rng(0)
    sides = [[np.unique(random.integers(0, 60, random.integers(0, 40)).astype(np.uint64)) for _ in range(n)] for n in (13, 9)]
    want = [[len(np.intersect1d(a, b)) for b in sides[1]] for a in sides[0]]
    for limit in (0, 5, 10**9):
        monkeypatch.setattr(minmax, "DENSE_PAIRS", limit)
        assert minmax.overlaps(*sides).tolist() == want


def test_near_duplicates_without_ids_and_rows(spark):
    got = minmax.near_duplicates(table(spark, [(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (2, "A b c d")]), 3, 85)
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in got.collect()) == [
        (0, None, True), (2, 2, True), (4, 2, False), (4, 2, False)]
    assert minmax.near_duplicates(table(spark, []), 3, 85).collect() == []


def test_near_duplicates_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op10_minmax(spark, sf_dir).collect()}
    assert got == brute_components(rows, 3, 85)


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (300, 200), (200, 300)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 140)} == {100} and got[300] == got[200] == 200
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def sources(spark):
    rows = [(i, "w " * (1 + i % 7), "big") for i in range(600)] + [(1000 + i, "w w w", "mid") for i in range(100)]
    rows += [(2000 + i, "w", None) for i in range(20)] + [(3000, None, "tiny"), (None, "", "tiny")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("place", F.lit("clash"))


@pytest.mark.parametrize("limit", [1.0, 2.0, 3.5])
def test_mixture_meets_its_weights(spark, limit):
    mixed = mixing.mix(sources(spark), repetition_limit=limit).collect()
    have, drawn, times = {}, {}, {}
    for r in sources(spark).collect():
        have[r.source] = have.get(r.source, 0) + max(1, len((r.text or "").split()))
    for r in mixed:
        drawn[r.source] = drawn.get(r.source, 0) + r.n_tokens
        times[r.doc_id] = max(times.get(r.doc_id, 0), r.epoch)
    total = sum(have.values())
    share = {s: n / total for s, n in have.items()}
    spread = max(share.values()) / min(share.values())
    power = 1 - math.log(limit) / math.log(spread)  # the limit in closed form
    scale = 1 / min(p**power / p for p in share.values())
    for s, p in share.items():
        assert drawn[s] <= p**power / p * scale * have[s] + 1e-6
        assert drawn[s] > p**power / p * scale * have[s] - 8
    assert set(times) == {r.doc_id for r in sources(spark).collect()} and max(times.values()) <= math.ceil(limit)
    assert sorted(map(tuple, mixed), key=repr) == sorted(map(tuple, mixing.mix(sources(spark).repartition(5), repetition_limit=limit).collect()), key=repr)


def test_mixture_of_a_target_entropy(spark):
    mixed = mixing.mix(sources(spark), target_entropy=1.0, budget=50_000.0).groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()
    parts = np.array([r.n for r in mixed]) / sum(r.n for r in mixed)
    assert -(parts * np.log(parts)).sum() == pytest.approx(1.0, abs=0.01) and sum(r.n for r in mixed) == pytest.approx(50_000, rel=0.01)


def test_mixture_of_one_source_and_of_nothing(spark):
    one = sources(spark).where("source = 'mid'")
    assert mixing.mix(one).count() == 100 and mixing.mix(one.where("false")).collect() == []


def test_mixing_query_keeps_every_document(spark, sf_dir):
    drawn = queries.op4_mixing(spark, sf_dir)
    assert drawn.select("doc_id").distinct().count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert drawn.groupBy("doc_id", "epoch").count().where("count > 1").count() == 0


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.materialise(stage(spark, docs, sf_dir), "test-stage")
        if name != "tokens":
            assert docs.columns == columns
        if name == "near dedup":
            texts = {r.doc_id: r.text for r in before.collect()}
            found = brute_components(sorted(texts.items()), 5, 80)
            assert {r.doc_id for r in docs.collect()} == {d for d, (_, c) in found.items() if d == c}
    ran = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, ran.collect())) == sorted(map(tuple, docs.collect())) and ran.count() > 0


def test_stages_take_odd_and_empty_documents(spark, sf_dir):
    kinds = "doc_id long, text string, lang string, source string, n_chars long, score double"
    rows = [(None, "some text here", None, None, None, 1.0), (-1, None, "en", "s", 0, None), (-1, "", None, "s", 0, 2.0), (-3, "x" * 200_000, "en", None, 1, 3.0)]
    for given in (rows, []):
        docs = spark.createDataFrame(given, kinds)
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.materialise(stage(spark, docs, sf_dir), "odd")
        assert docs.count() >= len(given)
