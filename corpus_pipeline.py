"""A training corpus from raw documents, in five stages; each is written and read again.

Every stage takes ``(spark, docs, sf_dir)`` and all that its predecessor kept. All but the last
return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotledger.llm import line_chunks, minmax, mixing, sentencepiece_bpe, toxicity
from lotledger.llm.common import table
from lotledger.llm.queries import PIECE_MODEL
from lotledger.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not likely toxic; the labels that are not held out teach the score."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, "__toxicity").where("__toxicity < 0.5").drop("__toxicity")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that occur before; those of which nothing is left go."""
    left = line_chunks.remove_repeated(docs)
    left = left.where(~((F.col("n_removed") + F.col("n_cut") > 0) & (F.trim("text") == ""))).drop("n_lines", "n_removed", "n_cut")
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with 80 % of its five-word shingles in common stays."""
    found = minmax.near_duplicates(docs.select("doc_id", "text"), words=5, percent=80)
    gone = found.where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, those of small sources up to twice."""
    return mixing.mix(docs).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them."""
    coded = sentencepiece_bpe.encode_decode(docs, public_tokenizers.path(PIECE_MODEL))
    return coded.select(
        "doc_id", "lang", "source", "n_chars",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("tokens", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
