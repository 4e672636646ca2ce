"""Approximate matching for large galleries with Spark's locality-sensitive hashing.

Unit vectors are hashed by ``BucketedRandomProjectionLSH``; only faces and actors
that share a bucket in some table are scored, exactly. A result may have fewer
than k rows per actor, but never a wrong score. The join shuffles both sides by
bucket, so the exact search stays the default: with a gallery of a few vectors
per movie it moves far less.
"""

from __future__ import annotations

from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castframe.functions.vectors import cosine, is_finite_vector, l2_norm
from castframe.operators.search import _as_matches, _rank_best, keyed_gallery

_FARTHEST = 2.1  # above the distance of any two unit vectors: the buckets alone decide


def match_faces_lsh(
    faces: DataFrame,
    gallery: DataFrame,
    k: int,
    within: str | None = None,
    tables: int = 16,
    bucket: float = 0.5,
    seed: int = 42,
) -> DataFrame:
    """The k best faces per actor among those that share a hash bucket.

    More ``tables`` or wider buckets raise the recall; fewer and narrower ones
    leave fewer pairs to score. Arguments and result are otherwise those of
    ``match_faces``.
    """
    if k < 1:
        raise ValueError("k must be positive")
    shared = [within] if within else []
    rest = ["face_id", "image_path", "bbox", "confidence"]
    usable = is_finite_vector(F.col("embedding")) & (l2_norm(F.col("embedding")) > 0)
    actors = keyed_gallery(gallery, within)

    def hashed(rows: DataFrame, *columns: str) -> DataFrame:
        unit = F.transform("embedding", lambda x: x.cast("double") / F.col("_norm"))
        kept = rows.where(usable).withColumn("_norm", l2_norm(F.col("embedding")))
        return kept.select(*shared, *columns, "embedding", array_to_vector(unit).alias("_unit"))

    lsh = BucketedRandomProjectionLSH(inputCol="_unit", outputCol="_buckets", numHashTables=tables, bucketLength=bucket, seed=seed)
    known = hashed(actors, "actor_key")
    if known.isEmpty():
        known = known.limit(0)
        model = None
    else:
        model = lsh.fit(known)
    if model is None:
        scored = faces.select(*shared, *rest, F.lit(0).cast("long").alias("actor_key"), F.lit(0.0).alias("similarity_score")).where(F.lit(False))
    else:
        pairs = model.approxSimilarityJoin(hashed(faces, *rest), known, _FARTHEST)
        if within:
            pairs = pairs.where(F.col(f"datasetA.{within}") == F.col(f"datasetB.{within}"))
        scored = pairs.select(
            *[F.col(f"datasetA.{c}").alias(c) for c in [*shared, *rest]], F.col("datasetB.actor_key").alias("actor_key"),
            cosine(F.col("datasetA.embedding"), F.col("datasetB.embedding")).alias("similarity_score"),
        )
    ranked = _rank_best(scored, [*shared, "actor_key"], [F.desc("similarity_score"), F.asc("face_id")], k)
    return _as_matches(ranked.where(F.col("rank") <= k), actors, shared)
