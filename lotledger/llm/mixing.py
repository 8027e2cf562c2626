"""Mixing sources to target weights by temperature.

The weight of a source is its share of all tokens to the power of an exponent between 0 (all
alike) and 1 (as they are). The exponent is found by bisection so that the weights have a target
entropy, or so that no source is repeated more often than a limit. The weights are then met by
whole passes over a source, each a permutation of its own, and a last pass that stops when the
source's budget is spent. All sums are aggregates over Spark tables; no source is sorted whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotledger.session import materialise

REPETITION_LIMIT = 2.0
STEPS = 40  # halvings of the exponent's range
GRID = 5  # halvings that one pass over the sources decides
BUCKET_ROWS = 2_048  # documents of a source whose order is settled in one piece
MISSING = "(none)"  # stands for a missing source in comparisons only


def _measures(sources: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """Entropy of the weights, and most repetitions if the least repeated source is read once."""
    grid = sources.withColumn("e", F.explode(F.array(*map(F.lit, exponents))))
    power = F.pow("share", F.col("e"))
    rows = grid.groupBy("e").agg(
        F.sum(power).alias("z"), F.sum(power * F.log(power)).alias("zl"),
        F.max(power / F.col("share")).alias("most"), F.min(power / F.col("share")).alias("least"),
    )
    found = {r["e"]: (math.log(r["z"]) - r["zl"] / r["z"], r["most"] / r["least"]) for r in rows.collect()}
    return [found[e] for e in exponents]


def exponent(sources: DataFrame, target_entropy: float | None, repetition_limit: float) -> float:
    """The smallest exponent within the limit, or the one with the entropy; both fall with it."""
    low, high = 0.0, 1.0
    for _ in range(0, STEPS, GRID):
        inner = [low + (high - low) * i / (1 << GRID) for i in range(1, 1 << GRID)]
        fits = [
            entropy <= target_entropy if target_entropy is not None else most <= repetition_limit
            for entropy, most in _measures(sources, [low, *inner])
        ]
        if fits[0]:
            return low
        # The first that fits and the last that does not close in on the exponent.
        place = next((i for i, ok in enumerate(fits) if ok), len(fits))
        points = [low, *inner, high]
        low, high = points[place - 1], points[place]
    return high


def mix(
    docs: DataFrame, tokens: Column | None = None, source: str = "source",
    target_entropy: float | None = None, repetition_limit: float = REPETITION_LIMIT, budget: float | None = None,
) -> DataFrame:
    """``docs`` with each row as often as it is drawn, and ``n_tokens, epoch, place`` at the end.

    ``tokens`` defaults to the words of the text, at least one. Without ``budget`` (in tokens) the
    source that is repeated least is read exactly once, so every row appears at least once. A
    missing source is a source of its own. ``epoch`` counts the passes from 1, ``place`` orders a
    pass. Rows without an id, or with the same, are drawn by their place like others. With one
    source or an empty table all rows appear once.
    """
    names = [n for n in docs.columns if n not in ("n_tokens", "epoch", "place")]
    if tokens is None:
        words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
        tokens = F.greatest(F.lit(1), words)
    base = docs.select(*names, tokens.cast("long").alias("n_tokens")).withColumn("__source", F.coalesce(F.col(source).cast("string"), F.lit(MISSING)))
    # Order of a pass by a hash of what the row is, so that it does not depend on the layout.
    base = base.withColumn("__order", F.xxhash64(*[F.col(n) for n in ("doc_id", "text") if n in names], F.lit("order")))

    sums = base.groupBy("__source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n"))
    stored = materialise(sums, "source-tokens")
    all_tokens = stored.agg(F.sum("tokens")).first()[0]
    if not all_tokens:
        return base.select(*names, "n_tokens", F.lit(1).alias("epoch"), F.col("__order").alias("place"))
    shares = stored.withColumn("share", F.col("tokens") / F.lit(float(all_tokens)))
    power = exponent(shares, target_entropy, repetition_limit)
    weighed = shares.withColumn("__raw", F.pow("share", F.lit(power)))
    z, least = weighed.agg(F.sum("__raw"), F.min(F.col("__raw") / F.col("share"))).first()
    scale = 1 / least if budget is None else budget / (all_tokens * z)
    # A pass more or less for rounding errors would be a whole copy of the source.
    reps = F.round(F.col("__raw") / F.col("share") * F.lit(scale), 9)
    plan = weighed.select(
        "__source", F.floor(reps).alias("__full"), ((reps - F.floor(reps)) * F.col("tokens")).alias("__part"),
        F.ceil(F.col("n") / BUCKET_ROWS).alias("__buckets"),
    )
    plan = materialise(plan, "source-plan")

    drawn = base.join(plan, "__source")
    drawn = drawn.withColumn("__pass", F.xxhash64("__order", F.col("__full"))).withColumn(
        "__bucket", F.pmod(F.shiftrightunsigned("__pass", 20), F.col("__buckets"))
    )
    sums = drawn.groupBy("__source", "__bucket").agg(F.sum("n_tokens").alias("__held"), F.max("__part").alias("__limit"))
    before = F.sum("__held").over(Window.partitionBy("__source").orderBy("__bucket")) - F.col("__held")
    sums = sums.withColumn("__left", F.col("__limit") - before).select("__source", "__bucket", "__held", "__left")
    sums = materialise(sums, "bucket-tokens")
    inside = sums.where("__left >= __held").select("__source", "__bucket", F.lit(True).alias("__whole"))
    edge = sums.where("__left > 0 and __left < __held").select("__source", "__bucket", F.col("__left").alias("__rest"))
    # Only the bucket in which a budget ends is put in order: at most one of each source.
    order = Window.partitionBy("__source", "__bucket").orderBy("__pass").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        drawn.select("__source", "__bucket", "__pass", "n_tokens").join(edge, ["__source", "__bucket"])
        .withColumn("__sum", F.sum("n_tokens").over(order)).where("__sum <= __rest")
        .groupBy("__source", "__bucket").agg(F.max("__pass").alias("__last"))
    )
    marks = sums.select("__source", "__bucket").join(inside, ["__source", "__bucket"], "left").join(cut, ["__source", "__bucket"], "left")
    marks = materialise(marks.where("__whole or __last is not null"), "bucket-cuts")
    extra = F.coalesce("__whole", F.lit(False)) | F.coalesce(F.col("__pass") <= F.col("__last"), F.lit(False))
    copies = (F.col("__full") + extra.cast("long")).cast("int")
    out = drawn.join(marks, ["__source", "__bucket"], "left").withColumn("__copies", copies).where("__copies > 0")
    out = out.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return out.select(*names, "n_tokens", "epoch", F.xxhash64("__order", (F.col("epoch") - 1).cast("long")).alias("place"))
