"""Counts and summaries. All aggregate partially before they shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castframe.operators.annotate import with_actor_style


def actor_summary(matches: DataFrame) -> DataFrame:
    score = F.col("similarity_score")
    return matches.where("actor_name is not null").groupBy("actor_name").agg(
        F.count(score).alias("count"),
        F.round(F.avg(score), 4).alias("mean"),
        F.round(F.max(score), 4).alias("max"),
        F.round(F.min(score), 4).alias("min"),
    )


def faces_per_actor(matches: DataFrame, actors: DataFrame, within: str | None = None) -> DataFrame:
    """Faces per actor with display name, most frequent first.

    The matches are counted before the names are joined.
    """
    shared = [within] if within else []
    counted = matches.where("actor_name is not null").groupBy(*shared, "actor_embedding_path", "actor_name").agg(F.count("*").alias("faces"))
    named = with_actor_style(counted, actors, within).select(*shared, "actor_name", "display_name", "faces")
    return named.orderBy(F.desc("faces"), "actor_name")


def unique_images(matches: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.countDistinct
    return matches.agg(count("frame_image_path").alias("images"))


def faces_per_image(matches: DataFrame) -> DataFrame:
    """Per image: rows, distinct faces, and the actor drawn last, on top."""
    per_face = matches.where("frame_image_path is not null").groupBy("frame_image_path", "face_id").agg(
        F.count("*").alias("n"), F.max(F.struct("actor_ord", "rank", "actor_name")).alias("last")
    )
    return per_face.groupBy("frame_image_path").agg(
        F.sum("n").alias("boxes"), F.count("*").alias("faces"), F.max("last").alias("last")
    ).select("frame_image_path", "boxes", "faces", F.col("last.actor_name").alias("top_actor"))


def detection_summary(frames: DataFrame, detections: DataFrame) -> DataFrame:
    """Faces, frames and faces per frame, over all frames also the empty ones."""
    counts = frames.agg(F.count("*").alias("frames"), F.lit(0).cast("long").alias("faces")).unionByName(
        detections.agg(F.lit(0).cast("long").alias("frames"), F.count("*").alias("faces"))
    )
    total = counts.agg(F.sum("frames").alias("frames"), F.sum("faces").alias("faces"))
    return total.select("frames", "faces", F.round(F.try_divide("faces", "frames"), 2).alias("faces_per_frame"))


def frames_without_faces(frames: DataFrame, detections: DataFrame) -> DataFrame:
    """Frames that no detection names; each path is shuffled once, however often it occurs."""
    return frames.join(detections.select(F.col("image_path").alias("path")).distinct(), "path", "left_anti")


def embedding_coverage(detections: DataFrame, embeddings: DataFrame) -> DataFrame:
    """How many faces are detected, embedded, both, or only one of the two.

    One shuffle of narrow rows, aggregated before it; a face embedded by
    several models counts once.
    """
    seen = detections.select("face_id", F.lit(1).alias("d"), F.lit(0).alias("e")).unionByName(
        embeddings.select("face_id", F.lit(0).alias("d"), F.lit(1).alias("e"))
    )
    faces = seen.groupBy("face_id").agg(F.max("d").alias("d"), F.max("e").alias("e"))
    return faces.agg(
        F.count_if(F.col("d") == 1).alias("detected"),
        F.count_if(F.col("e") == 1).alias("embedded"),
        F.count_if((F.col("d") == 1) & (F.col("e") == 1)).alias("both"),
        F.count_if((F.col("d") == 1) & (F.col("e") == 0)).alias("not_embedded"),
        F.count_if((F.col("d") == 0) & (F.col("e") == 1)).alias("not_detected"),
    )
