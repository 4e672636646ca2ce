"""Mixing sources: tempered shares, a bisected exponent, budgeted block permutations.

A source with share p of all tokens gets a weight in proportion to p ** a. The
exponent is bisected for a limit on repetition or for a target entropy. Weights
become token budgets. Each source's documents are dealt into blocks by a hash;
every epoch puts the blocks, and the documents within them, in an order of its
own, and documents are taken in this order while their first token lies within
the budget. With the default budget the source that is repeated least is used
exactly once, so no document is left out.

Defined cases: a null source is a source of its own; a null or empty text has no
tokens and comes once, in the first epoch, as do all texts of a source without
tokens. Rows with one id are ordered by their tokens; rows alike in both share
what the order gives them. An empty table gives no rows. Extra columns are not
read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from castframe.session import materialize

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
JAVA_WORD = r"[\p{Alnum}\P{ASCII}]++"  # the same, as Java reads it faster
POINTS, ROUNDS = 64, 9  # the interval shrinks by 64 in each round, to 2 ** -54 at last
BISECTIONS = 50


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(JAVA_WORD)), F.lit(0)).cast("long")


def source_shares(counted: DataFrame) -> DataFrame:
    """(source, tokens, docs) of rows (source, n_tokens)."""
    return counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))


def exponent_for_repetition(sources: DataFrame, limit: float) -> float:
    """The smallest exponent, from 0 to 1, that repeats no source more than ``limit`` times as often as another."""
    if limit < 1:
        raise ValueError("the limit on repetition is 1 at least")
    ends = sources.where("tokens > 0").agg(F.min("tokens").alias("least"), F.max("tokens").alias("most")).first()
    if not ends["least"]:
        return 1.0
    ratio = ends["most"] / ends["least"]
    low, high = 0.0, 1.0
    if ratio <= limit:
        return low
    for _ in range(BISECTIONS):
        mid = (low + high) / 2
        low, high = (low, mid) if ratio ** (1 - mid) <= limit else (mid, high)
    return high


def exponent_for_entropy(sources: DataFrame, target: float) -> float:
    """The largest exponent, from 0 to 1, whose weights have an entropy (nats) of ``target`` at least; 0 if none has.

    Every round is one aggregate over the sources, which may be many: it
    evaluates the entropy at ``POINTS`` exponents between the last bounds.
    """
    some = sources.where("tokens > 0")
    most = some.agg(F.max("tokens")).first()[0]
    if not most:
        return 1.0
    share = F.col("tokens") / F.lit(float(most))

    def entropies(points: list[float]) -> list[float]:
        sums = [F.sum(x) for a in points for x in (F.pow(share, F.lit(a)), F.pow(share, F.lit(a)) * F.log(share))]
        got = some.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
        return [math.log(z) - a * y / z for a, z, y in zip(points, got[::2], got[1::2])]

    low, high = 0.0, 1.0
    if entropies([high])[0] >= target:
        return high
    for _ in range(ROUNDS):
        points = [low + (high - low) * i / POINTS for i in range(POINTS + 1)]
        enough = [i for i, h in enumerate(entropies(points)) if h >= target]
        at = max(enough, default=0)
        low, high = points[at], points[min(at + 1, POINTS)]
    return low


def weights(sources: DataFrame, exponent: float, budget: float | None = None) -> DataFrame:
    """Add ``weight``, ``epochs``, ``whole`` (full passes) and ``rest`` (tokens of the last, partial one)."""
    share = F.col("tokens").cast("double")
    totals = sources.where("tokens > 0").agg(F.max("tokens"), F.sum(F.pow(share, F.lit(exponent)))).first()
    most, z = F.lit(float(totals[0] or 0)), F.lit(float(totals[1] or 1))
    if budget is None:
        epochs = F.pow(most / F.col("tokens"), F.lit(1 - exponent))
    else:
        epochs = F.lit(float(budget)) * F.pow(share, F.lit(exponent)) / z / F.col("tokens")
    some = F.col("tokens") > 0
    return (
        sources.withColumn("weight", F.when(some, F.pow(share, F.lit(exponent)) / z).otherwise(0.0))
        .withColumn("epochs", F.when(some, epochs).otherwise(1.0))
        .withColumn("whole", F.floor("epochs"))
        .withColumn("rest", F.floor((F.col("epochs") - F.col("whole")) * F.col("tokens") + 0.5))
    )


def mix(
    docs: DataFrame,
    max_repeats: float | None = 2.0,
    entropy: float | None = None,
    budget: float | None = None,
    tokens: Column | None = None,
) -> DataFrame:
    """The mixture: doc_id, source, n_tokens, epoch (from 0), block, start_token.

    ``start_token`` is the place of the document among the tokens of its source
    in that epoch. Either ``max_repeats`` or ``entropy`` decides the exponent.
    """
    if (max_repeats is None) == (entropy is None):
        raise ValueError("give either max_repeats or entropy")
    count = word_count(F.col("text")) if tokens is None else tokens
    counted = materialize(docs.select("doc_id", F.col("source").cast("string").alias("source"), count.cast("long").alias("n_tokens")), "mix-counted")
    sources = materialize(source_shares(counted), "mix-sources")
    exponent = exponent_for_repetition(sources, max_repeats) if entropy is None else exponent_for_entropy(sources, entropy)
    return realise(counted, weights(sources, exponent, budget))


def realise(counted: DataFrame, budgets: DataFrame) -> DataFrame:
    """Take documents in the order of their epoch while they start within its budget.

    A block is one of 4,096 by a hash of the id, so even a source that holds most
    rows is ordered in many tasks; the sum over blocks has that many rows at most.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    small = budgets.select(F.col("source").alias("_source"), "whole", "rest")
    passes = F.when(F.col("n_tokens") > 0, F.col("whole") - F.when(F.col("rest") > 0, 0).otherwise(1)).otherwise(F.lit(0)).cast("int")
    copies = (
        counted.join(small, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_last", F.greatest(passes, F.lit(-1)))
        .withColumn("epoch", F.explode(F.when(F.col("_last") >= 0, F.sequence(F.lit(0), F.col("_last"))).otherwise(F.array().cast("array<int>"))))
        .withColumn("block", F.substring(F.md5(F.concat(F.lit("block/"), name)), 1, 3))
        .withColumn("_order", F.md5(F.concat(name, F.lit("/"), F.col("epoch").cast("string"))))
    )
    same = ["source", "epoch", "block"]
    within = Window.partitionBy(*same).orderBy("_order", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = copies.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    block_order = F.md5(F.concat_ws("/", "block", F.coalesce("source", F.lit("null")), F.col("epoch").cast("string")))
    before = Window.partitionBy("source", "epoch").orderBy(block_order, "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        copies.groupBy(*same).agg(F.sum("n_tokens").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select(F.col("source").alias("_b_source"), F.col("epoch").alias("_b_epoch"), F.col("block").alias("_b_block"), "_before")
    )
    match = F.col("source").eqNullSafe(F.col("_b_source")) & (F.col("epoch") == F.col("_b_epoch")) & (F.col("block") == F.col("_b_block"))
    taken = placed.join(blocks, match).withColumn("start_token", F.col("_before") + F.col("_inside"))
    full = (F.col("epoch") < F.col("whole")) | (F.col("n_tokens") == 0)
    return taken.where(full | (F.col("start_token") < F.col("rest"))).select("doc_id", "source", "n_tokens", "epoch", "block", "start_token")
