"""Batch inference jobs around models that the user supplies.

A model is given as a factory: it is called in the task, so a model is loaded
once per task and never travels from the driver. With ``model_key`` it is kept
in the Python worker and shared by the tasks that the worker runs later.
Which device a model uses is its own business; ``profile`` takes a Spark
``ResourceProfile`` that asks for it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from castframe.functions.boxes import CORNERS, pack_box
from castframe.schema import DETECTION_BATCH, DETECTIONS, EMBEDDING_BATCH, FACE_EMBEDDINGS
from castframe.sources.images import rgb_pixels

_kept_models: dict[str, Any] = {}


def _model(factory: Callable[[], Any], key: str | None) -> Any:
    if key is None:
        return factory()
    if key not in _kept_models:
        _kept_models[key] = factory()
    return _kept_models[key]


def _message(problem: Exception) -> str:
    return f"{type(problem).__name__}: {problem}"


def spread(rows: DataFrame, tasks: int | None, *keys: Column) -> DataFrame:
    """Hash rows to a fixed number of tasks.

    The number is explicit because adaptive execution would otherwise merge
    the tasks by their few bytes, though each row means opening an image.
    """
    return rows.repartition(tasks or _default_tasks(rows), *keys)


def _default_tasks(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def detect(
    frames: DataFrame,
    detector_factory: Callable[[], Callable[[pd.DataFrame], list]],
    batch_size: int | str = DETECTION_BATCH,
    model_key: str | None = None,
    profile: Any = None,
    tasks: int | None = None,
    keep_errors: bool = False,
) -> DataFrame:
    """One row per detected face; a frame without faces gives none.

    The detector gets a batch of frame rows and returns, for each of them, a
    list of ``(x1, y1, x2, y2, confidence)``. ``det_no`` counts the faces of a
    frame from 0. An exception in the detector fails the job; with
    ``keep_errors`` each frame of its batch becomes a row with an ``error``
    and no box instead, so that other movies go on. ``batch_size`` is a number or
    names a column that holds it for each frame.

    A listing is small next to the work it stands for, so its rows are spread
    over ``tasks`` first. Frames that carry their ``content`` stay where they
    are read.
    """
    if "content" not in frames.columns:
        frames = spread(frames, tasks, F.col("path"))
    schema = T.StructType([*DETECTIONS.fields, T.StructField("error", T.StringType())]) if keep_errors else DETECTIONS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detector = None
        for batch in batches:
            detector = detector or _model(detector_factory, model_key)
            found: list = [()] * len(batch)
            failed, messages = [], []
            for places in _portions(batch, batch_size):
                some = batch.iloc[places]
                try:
                    result = detector(some)
                    if len(result) != len(some):
                        raise ValueError(f"the detector returned {len(result)} results for {len(some)} frames")
                except Exception as problem:
                    if not keep_errors:
                        raise
                    result = [()] * len(some)
                    failed.extend(places)
                    messages.extend([_message(problem)] * len(some))
                for place, faces in zip(places, result):
                    found[place] = faces
            if failed:
                lost = batch.iloc[failed]
                nothing = dict.fromkeys(("det_no", *CORNERS, "confidence"))
                lost = pd.DataFrame({"movie": lost["movie"], "image_path": lost["path"], "error": messages}).assign(**nothing)
                yield lost[schema.fieldNames()]
            counts = np.array([len(faces) for faces in found])
            if not counts.sum():
                continue
            values = np.array([face for faces in found for face in faces], np.float64)
            frame = np.repeat(np.arange(len(batch)), counts)
            numbers = np.arange(len(frame)) - np.repeat(np.cumsum(counts) - counts, counts)
            faces = pd.DataFrame(
                {
                    "movie": batch["movie"].to_numpy()[frame],
                    "image_path": batch["path"].to_numpy()[frame],
                    "det_no": numbers,
                    **dict(zip((*CORNERS, "confidence"), values.T)),
                }
            )
            yield faces.assign(error=None) if keep_errors else faces

    return frames.mapInPandas(run, schema, profile=profile)


def _portions(batch: pd.DataFrame, size: int | str, *together: str) -> Iterator[list[int]]:
    """Positions of rows to be taken at once: as many as ``size`` says, all alike in it and in ``together``."""
    by = [*together, *([size] if isinstance(size, str) else [])]
    groups = batch.groupby(by, sort=False, dropna=False).indices.values() if by else [np.arange(len(batch))]
    for rows in groups:
        step = int(batch[size].iat[rows[0]]) if isinstance(size, str) else size
        for at in range(0, len(rows), step):
            yield rows[at : at + step].tolist()


def _done_keys(done: DataFrame, model: str | None) -> DataFrame:
    """What identifies an embedded face: a new detection run may give its id to another box."""
    box = [F.col(f"bbox.{c}").alias(c) for c in CORNERS] if "bbox" in done.columns else [*CORNERS]
    keys = ["movie", "face_id", "image_path", *box]
    return done.select(*keys, "model") if model is None else done.where(F.col("model") == model).select(*keys)


def pending_embeddings(detections: DataFrame, done: DataFrame, model: str | None = None) -> DataFrame:
    """Detections that have no embedding yet of this model, or of the one in their ``model`` column."""
    return _against(detections, _done_keys(done, model), "left_anti")


def _against(detections: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """A join on all of ``keys``, in which missing values are equal."""
    names = keys.columns
    keys = keys.select(*[F.col(c).alias(f"_{c}") for c in names])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names]
    return detections.join(keys, reduce(lambda a, b: a & b, same), how)


def crop(pixels: np.ndarray, box: tuple[float, float, float, float]) -> np.ndarray:
    """Cut a box out. Corners round half to even; outside the image is zero."""
    left, top, right, bottom = (round(float(v)) for v in box)
    if right < left or bottom < top:
        raise ValueError(f"box has no area: {box}")
    height, width = pixels.shape[:2]
    if left >= 0 and top >= 0 and right <= width and bottom <= height:
        return pixels[top:bottom, left:right]
    out = np.zeros((bottom - top, right - left, *pixels.shape[2:]), pixels.dtype)
    x0, x1 = max(left, 0), min(right, width)
    y0, y1 = max(top, 0), min(bottom, height)
    if x0 < x1 and y0 < y1:
        out[y0 - top : y1 - top, x0 - left : x1 - left] = pixels[y0:y1, x0:x1]
    return out


def _whole_corners(boxes: np.ndarray) -> list[tuple[int, int, int, int] | None]:
    """The rounded corners of each box that has an area and no corner left of or above an image, else None: ``crop`` takes those."""
    x1, y1, x2, y2 = np.rint(boxes).T  # half to even, as in ``crop``
    usual = (x1 >= 0) & (y1 >= 0) & (x2 >= x1) & (y2 >= y1) & (x2 < 1 << 31) & (y2 < 1 << 31)
    whole = np.where(usual[:, None], np.rint(boxes), 0).astype(np.int64).tolist()
    return [tuple(box) if ok else None for box, ok in zip(whole, usual.tolist())]


def attach_images(rows: DataFrame, images: DataFrame, path: str = "image_path") -> DataFrame:
    """Rows with their decoded image, for images kept in a table.

    This shuffles pixels unless the tables are bucketed alike; prefer a reader
    that opens the image by path in the task.
    """
    return rows.join(images.select(F.col("image_path").alias(path), "image"), path)


def crop_faces(detections: DataFrame) -> DataFrame:
    """The cropped pixels of detections that carry an ``image`` column."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cut = [
                crop(rgb_pixels(image), box)
                for image, *box in zip(batch["image"], batch["x1"], batch["y1"], batch["x2"], batch["y2"])
            ]
            yield pd.DataFrame(
                {
                    "face_id": batch["face_id"],
                    "image_path": batch["image_path"],
                    "width": [c.shape[1] for c in cut],
                    "height": [c.shape[0] for c in cut],
                    "channels": [c.shape[2] for c in cut],
                    "pixels": [c.tobytes() for c in cut],
                }
            )

    schema = "face_id long, image_path string, width int, height int, channels int, pixels binary"
    columns = ["face_id", "image_path", "x1", "y1", "x2", "y2", "image"]
    return detections.where(F.col("image.height") > 0).select(*columns).mapInPandas(run, schema)


class _Opened:
    """The image opened last, or the error of opening it: rows come sorted by image."""

    def __init__(self, read_image: Callable[[str], np.ndarray] | None):
        self.read_image = read_image
        self.path: str | None = None
        self.held: np.ndarray | Exception | None = None

    def pixels(self, picture: Any) -> np.ndarray:
        if self.read_image is None:
            return rgb_pixels(picture)
        if picture != self.path or self.held is None:
            self.path = picture
            try:
                self.held = self.read_image(picture)
            except Exception as problem:
                self.held = problem
        if isinstance(self.held, Exception):
            raise self.held.with_traceback(None)
        return self.held


def _vectors(embedder: Callable[[list[np.ndarray]], Any], crops: list[np.ndarray]) -> list[tuple[np.ndarray | None, str | None]]:
    """A vector or an error for each crop. Crops that the model refuses are found by halving their batch."""
    try:
        result = embedder(crops)
    except Exception as problem:
        if len(crops) == 1:
            return [(None, _message(problem))]
        half = len(crops) // 2
        return _vectors(embedder, crops[:half]) + _vectors(embedder, crops[half:])
    try:
        if len(result) != len(crops):
            raise ValueError(f"the model returned {len(result)} vectors for {len(crops)} crops")
        table = np.asarray(result, np.float32)
        if table.ndim == 2 and table.size and np.isfinite(table).all():
            return [(v, None) for v in table]
        rows = list(table)
    except Exception as problem:
        return [(None, _message(problem))] * len(crops)
    return [(v, None) if v.size and np.isfinite(v).all() else (None, "the model returned no finite vector") for v in rows]


def embed(
    detections: DataFrame,
    embedder_factory: Callable[[], Callable[[list[np.ndarray]], Any]] | Mapping[str, Callable[[], Any]],
    model: str | None = None,
    read_image: Callable[[str], np.ndarray] | None = None,
    batch_size: int | str = EMBEDDING_BATCH,
    model_key: str | None = None,
    profile: Any = None,
    tasks: int | None = None,
) -> DataFrame:
    """One row per detection with its embedding and a status.

    ``read_image`` opens a path as an RGB array inside the task, so pixels are
    never shuffled. The small detection rows are sorted into ranges of movie,
    image and face: an image is opened once, or once per task where a range
    ends within it, and an image or movie with very many faces covers many
    ranges. A task then also holds few movies, which keeps the number of files
    low when the result is stored by movie. Without ``read_image`` the rows
    must carry an ``image`` column.

    The embedder gets a list of crops and returns one vector for each. A crop
    that cannot be read becomes an ``error`` row. If the model fails, its batch is
    halved down to the crops that it refuses; these become ``error`` rows, which
    a later run takes up again, and the others keep their vectors.

    Without ``model`` the detections have a ``model`` column, and the factories
    are given by model: rows of different models take one job. ``batch_size`` is
    a number or names a column that holds it for each row.
    """
    factories = {model: embedder_factory} if model is not None else dict(embedder_factory)
    extra = [batch_size] if isinstance(batch_size, str) else []
    columns = ["movie", "face_id", "image_path", *CORNERS, "confidence", "model"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        embedders: dict[str, Any] = {}
        opened = _Opened(read_image)
        for batch in batches:
            vectors: list = [None] * batch.num_rows
            errors: list = [None] * batch.num_rows
            pictures = batch.column("image_path" if read_image else "image").to_pylist()
            boxes = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in CORNERS]).astype(np.float64)
            corners = _whole_corners(boxes)
            keys = batch.select(["model", *extra]).to_pandas()
            for portion in _portions(keys, batch_size, "model"):
                crops, places = [], []
                for place in portion:
                    try:
                        pixels = opened.pixels(pictures[place])
                        inside = corners[place]
                        if inside and inside[2] <= pixels.shape[1] and inside[3] <= pixels.shape[0]:
                            crops.append(pixels[inside[1] : inside[3], inside[0] : inside[2]])
                        else:
                            crops.append(crop(pixels, boxes[place]))
                        places.append(place)
                    except Exception as problem:
                        errors[place] = _message(problem)
                if not crops:
                    continue
                name = keys["model"].iat[portion[0]]
                try:
                    if name not in embedders:
                        embedders[name] = _model(factories[name], model_key and f"{model_key}/{name}")
                except Exception as problem:
                    found = [(None, _message(problem))] * len(crops)
                else:
                    found = _vectors(embedders[name], crops)
                for place, (vector, error) in zip(places, found):
                    vectors[place], errors[place] = vector, error
            # The columns of the rows go back as they came; only the results are new.
            made = [
                pa.array(vectors, pa.list_(pa.float32())),
                pa.array(["saved" if e is None else "error" for e in errors], pa.string()),
                pa.array(errors, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], *made], names=[*columns, "embedding", "status", "error"])

    schema = (
        "movie string, face_id long, image_path string, x1 double, y1 double, x2 double, y2 double, "
        "confidence double, model string, embedding array<float>, status string, error string"
    )
    rows = detections if model is None else detections.withColumn("model", F.lit(model))
    if read_image is None:
        rows = rows.select(*columns, *extra, "image")
    else:
        order = ("movie", "image_path", "face_id")
        rows = rows.select(*columns, *extra)
        rows = rows.repartitionByRange(tasks or _default_tasks(rows), *order).sortWithinPartitions(*order)
    embedded = rows.mapInArrow(run, schema, profile=profile)
    return embedded.select(
        "movie", "face_id", "embedding", "model",
        pack_box(*[F.col(c) for c in CORNERS]).alias("bbox"),
        "confidence", "image_path", "status", "error",
    ).select(*FACE_EMBEDDINGS.fieldNames())


def embedding_run(detections: DataFrame, done: DataFrame, model: str, **how: Any) -> DataFrame:
    """The status of every detection: skipped because done, saved, or error."""
    keys = _done_keys(done, model)
    skipped = _against(detections, keys, "left_semi").select(
        "movie", "face_id", "image_path", F.lit("skipped").alias("status"), F.lit(None).cast("string").alias("error")
    )
    fresh = embed(pending_embeddings(detections, done, model), model=model, **how)
    return skipped.unionByName(fresh.select(*skipped.columns))


def embedding_counters(run: DataFrame) -> DataFrame:
    statuses = ("saved", "skipped", "error")
    names = ("saved", "skipped", "errors")
    return run.agg(*[F.count_if(F.col("status") == s).alias(n) for s, n in zip(statuses, names)])
