"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotledger.llm import (
    collocations,
    contamination,
    filter_audit,
    line_chunks,
    minmax,
    mixing,
    onebit_search,
    ordinal_quality,
    repeated_spans,
    sentencepiece_bpe,
    text_density,
    toxicity,
    vector_links,
)
from lotledger.llm.common import held_out, table

PIECE_MODEL = "piece_bpe_32k.model"


def op1_onebit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    return onebit_search.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op2_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without 50-byte strings of earlier documents."""
    left = repeated_spans.remove_repeated(table(spark, sf_dir, "documents"))
    removed = F.aggregate(F.zip_with("begins", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    return left.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("begins").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentencepiece_bpe.encode_decode(docs, public_tokenizers.path(PIECE_MODEL))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every draw of a mixture in which no source is repeated more than twice."""
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "source", "n_tokens", "epoch", "place")


def op5_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = text_density.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document once repeated passages are gone."""
    left = line_chunks.remove_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_removed", "n_cut", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op7_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: 0 of low quality, 1 readable but toxic, 2 good. Kept is what is likely above 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    grade = F.col("quality") * (2 - F.col("toxic"))
    model = ordinal_quality.fit(docs, table(spark, sf_dir, "labels"), grade, grades=3)
    return ordinal_quality.score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "expected_grade",
        "tail_probability",
        (F.col("tail_probability") >= 0.5).alias("kept"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors with a cosine of 0.9 or more."""
    return vector_links.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents by three-word shingles that overlap by 85 % of their union."""
    return minmax.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op11_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold windows of ten words of benchmark items."""
    found = contamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes from each source, in every order."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of two and three words of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_onebit_search": op1_onebit_search,
    "op2_repeated_spans": op2_repeated_spans,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_mixing": op4_mixing,
    "op5_text_density": op5_text_density,
    "op6_line_chunks": op6_line_chunks,
    "op7_ordinal_quality": op7_ordinal_quality,
    "op8_toxicity": op8_toxicity,
    "op9_vector_links": op9_vector_links,
    "op10_minmax": op10_minmax,
    "op11_contamination": op11_contamination,
    "op12_filter_audit": op12_filter_audit,
    "op13_collocations": op13_collocations,
}
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES: dict[str, str] = {
    "op11_contamination": rf"""
        WITH docs AS (SELECT doc_id, {_WORDS} AS words FROM documents),
        items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS words FROM benchmark),
        windows AS (
          SELECT DISTINCT item, size, array_to_string(words[p : p + size - 1], ' ') AS string FROM (
            SELECT item, words, size, unnest(range(1, len(words) - size + 2)) AS p
            FROM (SELECT *, least(len(words), 10) AS size FROM items WHERE len(words) > 0 AND item IS NOT NULL))),
        places AS (
          SELECT doc_id, size, p, array_to_string(words[p : p + size - 1], ' ') AS string FROM (
            SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS p
            FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size)),
        found AS (SELECT doc_id, p, places.size, item FROM places JOIN windows USING (size, string)),
        hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM found) GROUP BY doc_id),
        per AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM found GROUP BY doc_id)
        SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
               sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN per USING (doc_id)""",
    "op12_filter_audit": r"""
        WITH RECURSIVE marks AS (
          SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
          FROM labels GROUP BY doc_id),
        docs AS (
          SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                 min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents),
        measured AS (
          SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals FROM docs),
        masks AS (
          SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                 (CASE WHEN len(words) < 200 THEN 1 ELSE 0 END)
                 + (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END)
                 + (CASE WHEN 100 * capitals > 2 * length(text) THEN 4 ELSE 0 END)
                 + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
                 + (CASE WHEN doc_id > first THEN 16 ELSE 0 END) AS mask
          FROM measured LEFT JOIN marks USING (doc_id)),
        counted AS (SELECT part, good, toxic, mask, count(*) AS n FROM masks GROUP BY ALL),
        letters AS (SELECT unnest(range(0, 5)) AS k),
        orders AS (
          SELECT '' AS filter_order, 0 AS used UNION ALL
          SELECT filter_order || chr(CAST(65 + k AS INTEGER)), used | CAST(1 << k AS INTEGER) FROM orders, letters WHERE used & CAST(1 << k AS INTEGER) = 0),
        steps AS (
          SELECT filter_order, step, CAST(1 << (ascii(filter_order[step]) - 65) AS INTEGER) AS bit,
                 CAST(list_sum([0] || [1 << (ascii(filter_order[i]) - 65) for i in range(1, step)]) AS INTEGER) AS before
          FROM (SELECT filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM orders WHERE length(filter_order) = 5)),
        totals AS (
          SELECT part, filter_order, step, bit,
                 sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
                 sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
                 sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
                 sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
                 sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n * good ELSE 0 END) AS good_lost,
                 sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n * toxic ELSE 0 END) AS toxic_lost
          FROM counted, steps GROUP BY ALL)
        SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
               CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
        FROM totals""",
    "op13_collocations": rf"""
        WITH pieces AS (
          SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
            SELECT lang, unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
        grams AS (
          SELECT lang, size, array_to_string(w[p : p + size - 1], ' ') AS phrase, array_to_string(w[p : p + size - 2], ' ') AS head,
                 array_to_string(w[p + 1 : p + size - 1], ' ') AS tail, w[p] AS head1, w[p + size - 1] AS tail1
          FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM pieces, (SELECT unnest([1, 2, 3]) AS size) WHERE len(w) >= size)),
        f AS (SELECT lang, size, phrase, any_value(head) AS head, any_value(tail) AS tail, any_value(head1) AS head1, any_value(tail1) AS tail1, count(*) AS a FROM grams GROUP BY lang, size, phrase),
        total AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
        cuts AS (
          SELECT c.lang, c.size, c.phrase, c.a, 1 AS k, l.a AS l, r.a AS r FROM f c JOIN f l ON l.lang = c.lang AND l.size = 1 AND l.phrase = c.head1
          JOIN f r ON r.lang = c.lang AND r.size = c.size - 1 AND r.phrase = c.tail WHERE c.size > 1 AND c.a >= 10
          UNION ALL
          SELECT c.lang, c.size, c.phrase, c.a, 2, l.a, r.a FROM f c JOIN f l ON l.lang = c.lang AND l.size = 2 AND l.phrase = c.head
          JOIN f r ON r.lang = c.lang AND r.size = 1 AND r.phrase = c.tail1 WHERE c.size = 3 AND c.a >= 10),
        scored AS (SELECT *, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
        lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        kept AS (
          SELECT * FROM lowest c WHERE NOT EXISTS (
            SELECT 1 FROM f t WHERE t.size = 3 AND t.a >= 10 AND c.size = 2 AND t.lang = c.lang AND t.head = c.phrase AND 100 * t.a >= 50 * c.a)
          AND NOT EXISTS (
            SELECT 1 FROM f t WHERE t.size = 3 AND t.a >= 10 AND c.size = 2 AND t.lang = c.lang AND t.tail = c.phrase AND 100 * t.a >= 50 * c.a)),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000""",
}
