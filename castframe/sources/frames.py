"""Frame listings."""

from __future__ import annotations

import os
import warnings
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from castframe.functions.paths import has_image_suffix
from castframe.schema import FRAMES, IMAGE_SUFFIXES
from castframe.session import materialize


def list_frames(spark: SparkSession, folder: str, movie: str) -> DataFrame:
    """All images under ``folder``, by Spark's file source. No content is read.

    Spark keeps the listing in the driver and skips names that start with
    ``_`` or ``.``. For very large trees use ``walk_frames``.
    """
    if movie is None:
        raise ValueError("every frame needs a movie")
    glob = "*.{" + ",".join(IMAGE_SUFFIXES) + "}"
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        warnings.warn(f"no such folder: {folder}", stacklevel=2)
        return spark.createDataFrame([], FRAMES)
    path = F.regexp_replace("path", "^file:/+", "/")
    return files.select(F.lit(movie).cast("string").alias("movie"), path.alias("path"), "length")


def image_frames(frames: DataFrame) -> DataFrame:
    """The rows of a listing whose path names an image."""
    return frames.where(has_image_suffix(F.col("path")))


def _entries(folder: str) -> Iterator[tuple[str, int, bool]]:
    """The entries of one folder: path, length, whether it is a folder."""
    if "://" in folder:
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(folder)
        prefix = folder[: len(folder) - len(inner)] if folder.endswith(inner) else folder.split("://")[0] + "://"
        for info in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
            yield prefix + info.path, info.size or 0, info.type == fs.FileType.Directory
        return
    try:
        with os.scandir(folder) as entries:
            for entry in entries:
                if entry.is_dir():
                    if not entry.is_symlink():
                        yield entry.path, 0, True
                else:
                    yield entry.path, _size(entry), False
    except (FileNotFoundError, NotADirectoryError):
        return


def _size(entry: os.DirEntry) -> int:
    """The length of the file, of its target if it is a link; 0 for a link to nothing."""
    try:
        return entry.stat().st_size
    except FileNotFoundError:
        return 0


def _list_folders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["movie", "path", "length", "is_folder"]
    for batch in batches:
        for movie, folder in zip(batch["movie"], batch["folder"]):
            rows = []
            for entry in _entries(folder):
                rows.append((movie, *entry))
                if len(rows) == 50_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            yield pd.DataFrame(rows, columns=names)


def walk_frames(roots: DataFrame) -> DataFrame:
    """All images under many folders, listed by the executors level by level.

    ``roots`` has movie and folder. Each level of the tree is one job over its
    folders and is written once, so the driver never holds the listing. Every
    name is kept that has an image suffix, also hidden ones.
    """
    spark = roots.sparkSession
    levels = []
    level = roots.select("movie", "folder")
    while True:
        # Each row is a folder to list over the network, so they are spread out.
        spread = level.repartition(spark.sparkContext.defaultParallelism * 4, "folder")
        listed = materialize(
            spread.mapInPandas(_list_folders, "movie string, path string, length long, is_folder boolean"), "walk"
        )
        levels.append(listed)
        level = listed.where("is_folder").select("movie", F.col("path").alias("folder"))
        if level.isEmpty():
            break
    everything = levels[0]
    for listed in levels[1:]:
        everything = everything.unionByName(listed)
    return image_frames(everything.where("not is_folder").select("movie", "path", "length"))
