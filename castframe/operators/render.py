"""Drawing the annotation plan on the images."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from castframe.functions.paths import shot_relative_path
from castframe.operators.inference import spread
from castframe.schema import BOX_WIDTH, RENDERED


def outline(pixels: np.ndarray, box: tuple[int, int, int, int], color: tuple[int, int, int], width: int) -> None:
    """Draw a box outline in place, inward from its inclusive corners."""
    x1, y1, x2, y2 = box
    if x2 < x1 or y2 < y1:
        raise ValueError(f"box has no area: {box}")
    height, wide = pixels.shape[:2]
    width = min(width, max(x2 - x1, y2 - y1) // 2 + 1)
    for left, top, right, bottom in (
        (x1, y1, x2, y1 + width - 1),
        (x1, y2 - width + 1, x2, y2),
        (x1, y1, x1 + width - 1, y2),
        (x2 - width + 1, y1, x2, y2),
    ):
        left, top = max(left, x1, 0), max(top, y1, 0)
        right, bottom = min(right, x2, wide - 1), min(bottom, y2, height - 1)
        if left <= right and top <= bottom:
            pixels[top : bottom + 1, left : right + 1, :3] = color


def outline_renderer() -> Callable[[np.ndarray, pd.DataFrame], int]:
    """The built-in renderer: box outlines only. Returns how many were drawn."""

    def draw(pixels: np.ndarray, rows: pd.DataFrame) -> int:
        drawn = 0
        for row in rows.itertuples(index=False):
            try:
                outline(pixels, (row.x1, row.y1, row.x2, row.y2), (row.r, row.g, row.b), BOX_WIDTH)
            except ValueError:
                continue
            drawn += row.faces
        return drawn

    return draw


def topmost_boxes(plan: DataFrame) -> DataFrame:
    """For outlines, only the last of equal boxes on an image is visible.

    ``faces`` counts the plan rows behind it. Aggregated before the shuffle,
    this takes out most rows: without a threshold every face has one box per
    actor.
    """
    order = F.struct("actor_ord", "rank")
    top = F.max_by(F.struct("actor_ord", "rank", "face_id", "label", "text_x", "text_y", "back_x2", "back_y2", "color", "text_color"), order)
    return (
        plan.groupBy("frame_image_path", "save_path", "x1", "y1", "x2", "y2")
        .agg(top.alias("top"), F.count("*").alias("faces"))
        .select("frame_image_path", "save_path", "x1", "y1", "x2", "y2", "top.*", "faces")
    )


def _boxes_of_usable(boxes: DataFrame, usable: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The boxes on usable images, a row without box for the bare ones, and the skipped images."""
    own_path = F.col("save_path") if "save_path" in usable.columns else shot_relative_path(F.col("frame_image_path"))
    images = usable.withColumn("save_path", own_path)
    ok = images.where(F.col("status") == "ok").select("frame_image_path", "save_path")
    # One pass over the plan: an image without boxes comes through with none.
    on_images = ok.join(boxes.drop("save_path"), "frame_image_path", "left").select(*boxes.columns)
    skipped = images.where(F.col("status") != "ok").select(
        "frame_image_path", "save_path", F.lit("skipped").alias("status"), F.lit(0).cast("long").alias("faces_drawn"),
        F.col("status").alias("error"),
    )
    return on_images, skipped


def render(
    plan: DataFrame,
    read_image: Callable[[str], np.ndarray],
    renderer_factory: Callable[[], Callable[[np.ndarray, pd.DataFrame], int]] | None = None,
    write_image: Callable[[str, np.ndarray], None] | None = None,
    keep_pixels: bool = False,
    usable: DataFrame | None = None,
    profile: Any = None,
    tasks: int | None = None,
    store_factory: Callable[[], Callable[[str, np.ndarray], str]] | None = None,
) -> DataFrame:
    """Open every image of the plan once, draw its boxes in order, hand it on.

    ``write_image(save_path, pixels)`` stores an image from inside the task;
    with ``keep_pixels`` the pixels come back in the result instead; with ``store_factory``,
    called once in each task, the ``file`` that its result says an image was stored in. ``usable``
    is the output of ``annotatable_images``, best as a stored table: images
    that are not ``ok`` there are reported as skipped and not opened, and an
    image without a drawable box is handed on as it is. It may have a
    ``save_path`` of its own. Without a factory the built-in renderer draws
    outlines.

    The rows of an image arrive sorted and are drawn piece by piece, so a task
    holds one image and one batch of rows, however many boxes the image has.
    """
    factory = renderer_factory or outline_renderer
    boxes = topmost_boxes(plan) if renderer_factory is None else plan.withColumn("faces", F.lit(1))
    boxes = boxes.select(*[c for c in boxes.columns if c != "color"], "color.r", "color.g", "color.b")
    if usable is not None:
        boxes, unopened = _boxes_of_usable(boxes, usable)
    rows = spread(boxes, tasks, F.col("frame_image_path"))
    rows = rows.sortWithinPartitions("frame_image_path", "actor_ord", "rank")

    schema = RENDERED
    if store_factory:
        schema = T.StructType([*[f for f in RENDERED.fields if f.name != "pixels"], T.StructField("file", T.StringType())])
    whole = {f.name: "int64" for f in rows.schema if f.dataType.typeName() in ("integer", "long")}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        draw = None
        store = store_factory() if store_factory else None
        path = save_path = pixels = error = None
        drawn = 0

        def finished() -> pd.DataFrame:
            nonlocal error
            if error is None and write_image is not None:
                try:
                    write_image(save_path, pixels)
                except Exception as problem:
                    error = f"{type(problem).__name__}: {problem}"
            file = None
            if error is None and store is not None:
                try:
                    file = store(save_path, pixels)
                except Exception as problem:
                    error = f"{type(problem).__name__}: {problem}"
            fine = error is None
            size = pixels.shape if fine else (None, None, None)
            kept = pixels.tobytes() if fine and keep_pixels else None
            status = "processed" if fine else "error"
            return pd.DataFrame(
                [(path, save_path, status, drawn if fine else 0, error, *size, file if store else kept)],
                columns=schema.fieldNames(),
            )

        for batch in batches:
            draw = draw or factory()
            for image_path, some in batch.groupby("frame_image_path", sort=False):
                if image_path != path:
                    if path is not None:
                        yield finished()
                    path, save_path, drawn, error = image_path, some["save_path"].iloc[0], 0, None
                    try:
                        pixels = np.array(read_image(path))
                    except Exception as problem:
                        pixels, error = None, f"{type(problem).__name__}: {problem}"
                # Rows of bare images turn the whole columns of a batch into floats.
                some = some[some["x1"].notna()].astype(whole)
                if error is None and len(some):
                    try:
                        drawn += draw(pixels, some)
                    except Exception as problem:
                        error = f"{type(problem).__name__}: {problem}"
        if path is not None:
            yield finished()

    result = rows.mapInPandas(run, schema, profile=profile)
    return result if usable is None else result.unionByName(unopened, allowMissingColumns=True)


def annotation_counters(rendered: DataFrame) -> DataFrame:
    """Totals of a run; faces count only where they were really drawn."""
    return rendered.agg(
        F.count_if(F.col("status") == "processed").alias("processed"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.coalesce(F.sum("faces_drawn"), F.lit(0)).alias("faces_drawn"),
    )
