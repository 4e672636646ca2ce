"""From matches to what is drawn on the frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from castframe.functions.boxes import is_drawable, label_row, match_label, whole_pixels
from castframe.functions.paths import shot_relative_path
from castframe.schema import DEFAULT_COLOR, DEFAULT_TEXT_COLOR, LABEL_HEIGHT, LABEL_WIDTH, MAX_IMAGE_BYTES


def above_threshold(matches: DataFrame, threshold: float | Column) -> DataFrame:
    """Matches scoring at least ``threshold``; 0.0 keeps all, negative ones too.

    A column gives each match the threshold of its movie. Ranks come from the
    search and stay as they are.
    """
    if isinstance(threshold, Column):
        return matches.where((threshold <= 0.0) | (F.col("similarity_score") >= threshold))
    return matches.where(F.col("similarity_score") >= threshold) if threshold > 0.0 else matches


def with_actor_style(matches: DataFrame, actors: DataFrame, within: str | None = None) -> DataFrame:
    """Matches with display name, box colour and text colour, or their defaults.

    No broadcast hint: Catalyst broadcasts the actors if their size permits.
    """
    shared = [within] if within else []
    # A file that several movies name has the style of the first, unless each keeps to its own.
    entry = F.struct(*[c for c in ("movie", "actor_ord") if c in actors.columns], "display_name", "color", "text_color")
    named = actors.groupBy(*shared, F.col("embedding_path").alias("actor_embedding_path")).agg(F.min(entry).alias("style"))
    style = named.select(*shared, "actor_embedding_path", "style.display_name", "style.color", "style.text_color")
    yellow = F.struct(*[F.lit(v).alias(n) for n, v in zip("rgb", DEFAULT_COLOR)])
    return (
        matches.join(style, [*shared, "actor_embedding_path"], "left")
        .withColumn("display_name", F.coalesce("display_name", "actor_name"))
        .withColumn("color", F.coalesce("color", yellow))
        .withColumn("text_color", F.coalesce("text_color", F.lit(DEFAULT_TEXT_COLOR)))
    )


def annotation_plan(
    matches: DataFrame, actors: DataFrame, threshold: float | Column = 0.0, within: str | None = None
) -> DataFrame:
    """One row per box to draw. Within an image the order is actor, then rank.

    The plan stays flat: the order is in its columns, so an image with very
    many boxes is never gathered into one row.
    """
    corners = [F.col(f"face_{c}") for c in ("x1", "y1", "x2", "y2")]
    kept = above_threshold(matches, threshold).where(F.col("frame_image_path").isNotNull() & is_drawable(*corners))
    x1, y1, x2, y2 = (whole_pixels(c) for c in corners)
    text_y = label_row(y1)
    return with_actor_style(kept, actors, within).select(
        *([within] if within else []),
        "frame_image_path",
        shot_relative_path(F.col("frame_image_path")).alias("save_path"),
        "actor_ord",
        "rank",
        "face_id",
        x1.alias("x1"),
        y1.alias("y1"),
        x2.alias("x2"),
        y2.alias("y2"),
        match_label(F.col("display_name"), F.col("similarity_score")).alias("label"),
        x1.alias("text_x"),
        text_y.alias("text_y"),
        (x1 + LABEL_WIDTH).alias("back_x2"),
        (text_y + LABEL_HEIGHT).alias("back_y2"),
        "color",
        "text_color",
    )


def annotatable_images(matches: DataFrame, listing: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every matched image, and whether it can be annotated.

    ``listing`` has path and length. A file that is absent or larger than the
    limit is skipped. ``keep`` names columns that an image has once, such as
    its movie.
    """
    wanted = matches.where(F.col("frame_image_path").isNotNull()).select("frame_image_path", *keep).distinct()
    files = listing.select(F.col("path").alias("frame_image_path"), "length")
    status = (
        F.when(F.col("length").isNull(), "missing").when(F.col("length") > MAX_IMAGE_BYTES, "too_large").otherwise("ok")
    )
    return wanted.join(files, "frame_image_path", "left").select("frame_image_path", *keep, "length", status.alias("status"))
