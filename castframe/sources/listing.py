"""Frame folders as a data source: tasks of many folders, filters on movie and suffix before any listing."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from castframe.functions.paths import has_image_suffix
from castframe.schema import FRAMES, IMAGE_SUFFIXES
from castframe.sources.frames import _entries

LISTED = T.StructType([*FRAMES.fields, T.StructField("suffix", T.StringType())])
_ROWS = 20_000  # of a record batch


class Folders(InputPartition):
    """Folders that a task lists, as (movie, path, deep): with all below them, or their own files alone."""

    def __init__(self, folders: list[tuple[str, str, bool]]):
        super().__init__(None)
        self.folders = folders

    @property
    def path(self) -> str:
        """The first of them."""
        return self.folders[0][1] if self.folders else ""


class FrameReader(DataSourceReader):
    def __init__(self, roots: list[list[str]], tasks: int = 64):
        self.roots = roots
        self.tasks = tasks
        self.suffixes: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Movies and suffixes that are wanted; every other filter stays with Spark."""
        for one in filters:
            wanted = {one.value} if isinstance(one, EqualTo) else set(one.value) if isinstance(one, In) else None
            if wanted is not None and one.attribute == ("movie",):
                self.roots = [r for r in self.roots if r[0] in wanted]
            elif wanted is not None and one.attribute == ("suffix",):
                self.suffixes = wanted if self.suffixes is None else self.suffixes & wanted
            else:
                yield one

    def partitions(self) -> list[Folders]:
        """The folders directly inside each root, and the files of the root itself: one listing per movie here, the rest in tasks.

        The folders are dealt to ``tasks``, so that the cost of a task is not paid for each of them.
        """
        found = []
        for movie, root in self.roots:
            found.append((movie, root, False))
            found += [(movie, path, True) for path, _, is_folder in _entries(root) if is_folder]
        return [Folders(found[at :: self.tasks]) for at in range(min(self.tasks, len(found)))] or [Folders([])]

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for movie, folder, deep in partition.folders:
            todo = [folder]
            while todo:
                for path, length, is_folder in _entries(todo.pop()):
                    if is_folder:
                        todo += [path] if deep else []
                        continue
                    name, dot, suffix = path.rpartition("/")[2].rpartition(".")
                    suffix = suffix if dot else None
                    if self.suffixes is None or suffix in self.suffixes:
                        rows.append((movie, path, length, suffix))
                    if len(rows) == _ROWS:
                        yield _batch(rows)
                        rows = []
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 4
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=LISTED.fieldNames())


class FrameFolders(DataSource):
    """Options ``roots``: a JSON list of [movie, folder], and ``tasks``: how many tasks list them at most."""

    @classmethod
    def name(cls) -> str:
        return "castframe_frames"

    def schema(self) -> T.StructType:
        return LISTED

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return FrameReader(json.loads(self.options["roots"]), int(self.options["tasks"]))


def folder_listing(spark: SparkSession, roots: DataFrame, tasks: int | None = None) -> DataFrame:
    """All files (movie, path, length, suffix) below the folders of ``roots`` (movie, folder), a row for each movie.

    Nothing is listed until the result is used, and filters on ``movie`` and ``suffix``
    decide first which folders and files are looked at. A folder that is missing has no files;
    hidden names are kept, links to folders are not followed. Folders are dealt to
    ``tasks``, by default the number of shuffle partitions.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FrameFolders)
    named = [[r["movie"], r["folder"]] for r in roots.select("movie", "folder").toLocalIterator()]
    if any(movie is None for movie, _ in named):
        raise ValueError("every frame needs a movie")
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spark.read.format("castframe_frames").option("roots", json.dumps(named)).option("tasks", tasks).load()


def listed_frames(spark: SparkSession, roots: DataFrame) -> DataFrame:
    """The images among them."""
    files = folder_listing(spark, roots)
    # The suffix goes to the source; a name that is a suffix alone, such as ".jpg", is an image too.
    return files.where(F.col("suffix").isin(*IMAGE_SUFFIXES) & has_image_suffix(F.col("path"))).select(*FRAMES.fieldNames())
