"""Summaries that are kept per movie and united: a new movie reads its own matches alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castframe.schema import SUMMARY_STATES

SKETCH_BITS = 12  # of the sketch of images: a standard error of 1.6 %


def summary_states(matches: DataFrame) -> DataFrame:
    """One row per movie and actor: rows, sum and extremes of the scores, and a sketch of the images."""
    score = F.col("similarity_score")
    states = matches.where("actor_name is not null").groupBy("movie", "actor_name").agg(
        F.count(score).alias("count"), F.sum(score).alias("sum"), F.max(score).alias("max"), F.min(score).alias("min"),
        F.hll_sketch_agg("frame_image_path", F.lit(SKETCH_BITS)).alias("images"),
    )
    return states.select(*SUMMARY_STATES.fieldNames())


def new_states(matches: DataFrame, states: DataFrame) -> DataFrame:
    """The states of movies that ``states`` lacks; matches stored by movie are read for these alone."""
    done = [r["movie"] for r in states.select("movie").distinct().toLocalIterator()]  # one per movie
    movie = F.col("movie")
    missing = ~movie.isin(done) if done else F.lit(True)
    return summary_states(matches.where(missing | movie.isNull() if None not in done else missing & movie.isNotNull()))


def united_summary(states: DataFrame, by: tuple[str, ...] = ("actor_name",)) -> DataFrame:
    """The summary of all movies per actor, as ``actor_summary`` has it, and about how many images."""
    return states.groupBy(*by).agg(
        F.sum("count").alias("count"), F.round(F.try_divide(F.sum("sum"), F.sum("count")), 4).alias("mean"),
        F.round(F.max("max"), 4).alias("max"), F.round(F.min("min"), 4).alias("min"),
        F.hll_sketch_estimate(F.hll_union_agg("images")).alias("images"),
    )
