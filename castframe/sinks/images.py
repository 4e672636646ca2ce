"""An image sink that commits: what failed or repeated tasks wrote is never published.

Every task attempt writes its images, and a list of them, into a folder of its own.
When the job has ended, the driver writes one manifest that names the folders of the
attempts that counted, a line for each task; images that no manifest names are not
published. Nothing is moved or renamed, so publishing takes no time per image.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyarrow import parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from castframe.schema import RENDERED

LIST, FILES, MANIFEST = "list.parquet", "files", "_manifest"
BATCH_BYTES = 64 << 20  # of pixels that a task takes at once, or one image
PUBLISHED = T.StructType([*[f for f in RENDERED.fields if f.name != "pixels"], T.StructField("file", T.StringType())])
_ARROW = {T.StringType(): pa.string(), T.LongType(): pa.int64(), T.IntegerType(): pa.int32()}
_LISTED = pa.schema([(f.name, _ARROW[f.dataType]) for f in PUBLISHED.fields])


@dataclass
class Attempt(WriterCommitMessage):
    folder: str


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class _Store:
    """Stores the images of one task attempt in a folder of its own, and returns the file of each."""

    def __init__(self, path: str, job: str, write_image: Callable[[str, np.ndarray], None]):
        self.folder = f"{path}/attempts/{job}/{uuid.uuid4().hex}"
        self.write_image = write_image
        self.made: set[str] = set()

    def __call__(self, save_path: str, pixels: np.ndarray) -> str:
        file = f"{self.folder}/{FILES}/{save_path}"
        parent = file.rpartition("/")[0]
        if parent not in self.made:
            system, inner = _opened(parent)
            system.create_dir(inner, recursive=True)
            self.made.add(parent)
        self.write_image(file, pixels)
        return file


def _image_source(write_image: Callable[[str, np.ndarray], None] | None, job: str | None = None) -> type[DataSource]:
    """The sink as a data source. The class carries the function that stores one image, which no option could.

    Without it the rows name the ``file`` that ``job`` has stored already.
    """

    class Writer(DataSourceArrowWriter):
        def __init__(self, path: str, overwrite: bool):
            self.path = path.rstrip("/")
            self.overwrite = overwrite
            self.job = job or uuid.uuid4().hex

        def write(self, iterator: Iterator[pa.RecordBatch]) -> Attempt:
            folder = f"{self.path}/attempts/{self.job}/{uuid.uuid4().hex}"
            system, inner = _opened(folder)
            system.create_dir(inner, recursive=True)
            made: set[str] = set()
            with pq.ParquetWriter(system.open_output_stream(f"{inner}/{LIST}"), _LISTED) as listed:
                for batch in iterator:
                    if write_image is None:
                        rows = batch.to_pylist()
                    else:
                        rows = [_stored(row, folder, system, inner, made) for row in _rows(batch)]
                    listed.write_table(pa.Table.from_pylist(rows, _LISTED))
            return Attempt(folder)

        def commit(self, messages: list[WriterCommitMessage | None]) -> None:
            system, inner = _opened(f"{self.path}/{MANIFEST}")
            system.create_dir(inner, recursive=True)
            older = [f.path for f in system.get_file_info(fs.FileSelector(inner)) if f.path.endswith(".json")]
            # Written under another name first: a manifest is whole or not there.
            place = f"{inner}/{len(older):010d}-{self.job}"
            with system.open_output_stream(f"{place}.part") as out:
                out.write(json.dumps({"replaces": self.overwrite, "attempts": [m.folder for m in messages if m]}).encode())
            system.move(f"{place}.part", f"{place}.json")

        def abort(self, messages: list[WriterCommitMessage | None]) -> None:
            """Take away what this job's tasks wrote; no manifest names it."""
            system, inner = _opened(f"{self.path}/attempts/{self.job}")
            if system.get_file_info(inner).type == fs.FileType.Directory:
                system.delete_dir(inner)

    def _stored(row: dict[str, Any], folder: str, system: fs.FileSystem, inner: str, made: set[str]) -> dict[str, Any]:
        pixels = row.pop("pixels")
        if pixels is None:
            return row | {"file": None}
        shape = row["height"], row["width"], row["channels"]
        parent = row["save_path"].rpartition("/")[0]
        if parent not in made:
            system.create_dir(f"{inner}/{FILES}/{parent}".rstrip("/"), recursive=True)
            made.add(parent)
        file = f"{folder}/{FILES}/{row['save_path']}"
        try:
            write_image(file, np.frombuffer(pixels, np.uint8).reshape(shape))
        except Exception as problem:
            lost = {"status": "error", "faces_drawn": 0, "error": f"{type(problem).__name__}: {problem}", "file": None}
            return row | lost | dict.fromkeys(("height", "width", "channels"))
        return row | {"file": file}

    def _rows(batch: pa.RecordBatch) -> Iterator[dict[str, Any]]:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]

    class ImageSink(DataSource):
        @classmethod
        def name(cls) -> str:
            return "castframe_images"

        def schema(self) -> T.StructType:
            return PUBLISHED if write_image is None else RENDERED

        def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
            return Writer(self.options["path"], overwrite)

    return ImageSink


def write_images(rendered: DataFrame, path: str, write_image: Callable[[str, np.ndarray], None], mode: str = "overwrite") -> None:
    """Store the pixels of ``rendered`` with ``write_image(file, pixels)`` and publish them at once.

    ``overwrite`` replaces what is published at ``path``, ``append`` adds to it. Rows
    without pixels are listed too, without a file; an image that cannot be stored
    becomes an ``error`` row.
    """
    spark = rendered.sparkSession
    spark.dataSource.register(_image_source(write_image))
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, str(BATCH_BYTES))
    try:
        rendered.select(*RENDERED.fieldNames()).write.format("castframe_images").mode(mode).save(path)
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)


def draw_images(
    draw: Callable[[Callable[[], Callable[[str, np.ndarray], str]]], DataFrame],
    path: str, write_image: Callable[[str, np.ndarray], None], mode: str = "overwrite",
) -> None:
    """As ``write_images``, for images that the task that draws them stores: no pixels leave it.

    ``draw`` is given the ``store_factory`` of ``render`` and returns its rows. The rows of the
    attempt that counts name the files of that attempt, so the manifest publishes those alone.
    """
    path, job = path.rstrip("/"), uuid.uuid4().hex
    drawn = draw(lambda: _Store(path, job, write_image))
    drawn.sparkSession.dataSource.register(_image_source(None, job))
    drawn.select(*PUBLISHED.fieldNames()).write.format("castframe_images").mode(mode).save(path)


def published_images(spark: SparkSession, path: str) -> DataFrame:
    """The rows that the manifests at ``path`` publish, with the ``file`` of each image."""
    system, inner = _opened(f"{path.rstrip('/')}/{MANIFEST}")
    found = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    attempts: list[str] = []
    for info in sorted((f for f in found if f.path.endswith(".json")), key=lambda f: f.path):
        with system.open_input_stream(info.path) as file:
            manifest = json.loads(file.read())
        attempts = manifest["attempts"] + ([] if manifest["replaces"] else attempts)
    if not attempts:
        return spark.createDataFrame([], PUBLISHED)
    return spark.read.schema(PUBLISHED).parquet(*[f"{a}/{LIST}" for a in attempts]).select(*[F.col(f.name) for f in PUBLISHED.fields])
