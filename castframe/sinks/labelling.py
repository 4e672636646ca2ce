"""Samples for a labelling tool: one image with its labelled boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castframe.functions.boxes import CORNERS, match_label, relative_box


def with_dimensions(matches: DataFrame, dimensions: DataFrame) -> DataFrame:
    """Matches with the size of their image; images of unknown or no size drop out."""
    sizes = dimensions.where("width > 0 and height > 0").select(F.col("image_path").alias("frame_image_path"), "width", "height")
    return matches.join(sizes, "frame_image_path")


def relative_boxes(matches: DataFrame, dimensions: DataFrame) -> DataFrame:
    """One row per match: its label and its box as fractions of the image."""
    return _boxes(with_dimensions(matches, dimensions))


def _boxes(sized: DataFrame, *extra: str) -> DataFrame:
    corners = [F.col(f"face_{c}") for c in CORNERS]
    return sized.select(
        F.col("frame_image_path").alias("filepath"),
        *extra,
        "actor_ord",
        "rank",
        "face_id",
        match_label(F.col("actor_name"), F.col("similarity_score")).alias("label"),
        relative_box(*corners, F.col("width"), F.col("height")).alias("bounding_box"),
        F.col("similarity_score").alias("confidence"),
    )


def labelling_samples(matches: DataFrame, dimensions: DataFrame) -> DataFrame:
    """The labelled boxes of all samples, one row each: ``filepath`` is the sample.

    The rows stay flat, so an image may have any number of boxes. Their result
    order is ``actor_ord``, ``rank``, ``face_id``.
    """
    return relative_boxes(matches, dimensions)


def sample_images(samples: DataFrame) -> DataFrame:
    """One row per sample, with its number of boxes."""
    return samples.groupBy("filepath").agg(F.count("*").alias("boxes"))


def save_samples(samples: DataFrame, path: str) -> None:
    """JSON lines, a box each; an existing dataset of that name is replaced."""
    samples.write.mode("overwrite").json(path)
