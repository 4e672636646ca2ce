"""Decoded images and their dimensions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_images(spark: SparkSession, folder: str) -> DataFrame:
    """Images decoded by Spark's own source; unreadable files have height -1."""
    return (
        spark.read.format("image").option("recursiveFileLookup", "true").option("dropInvalid", "false").load(folder)
        .withColumn("image_path", F.regexp_replace("image.origin", "^file:/+", "/"))
    )


def image_dimensions(images: DataFrame) -> DataFrame:
    """Path and size of every readable image of a decoded table. Files are cheaper by ``file_dimensions``."""
    return images.where(F.col("image.height") > 0).select(
        "image_path",
        F.col("image.width").alias("width"),
        F.col("image.height").alias("height"),
        F.col("image.nChannels").alias("channels"),
    )


def header_size(read: Callable[[int], bytes]) -> tuple[int, int] | None:
    """Width and height of a PNG or JPEG, from its first bytes; None for anything else.

    ``read`` gives the next n bytes. No more is read than the segments before the size.
    """
    head = read(24)
    if head[:8] == b"\x89PNG\r\n\x1a\n" and len(head) == 24:
        return int.from_bytes(head[16:20], "big"), int.from_bytes(head[20:24], "big")
    if head[:2] != b"\xff\xd8":
        return None
    held = head[2:]

    def take(n: int) -> bytes:
        nonlocal held
        if len(held) < n:
            held += read(n - len(held))
        out, held = held[:n], held[n:]
        return out

    while True:
        mark = take(4)
        if len(mark) < 4 or mark[0] != 0xFF:
            return None
        kind, length = mark[1], int.from_bytes(mark[2:], "big")
        if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            frame = take(5)
            return (int.from_bytes(frame[3:5], "big"), int.from_bytes(frame[1:3], "big")) if len(frame) == 5 else None
        if length < 2 or len(take(length - 2)) < length - 2:
            return None


def open_file(path: str) -> Any:
    """A local path, or an address in any store that Arrow knows."""
    if "://" not in path:
        return open(path, "rb")
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def file_dimensions(listing: DataFrame, open_path: Callable[[str], Any] = open_file, tasks: int | None = None) -> DataFrame:
    """image_path, width and height of each file in a listing that is a readable image.

    Files are opened in the tasks, and only their headers are read.
    """

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for path in batch["path"]:
                try:
                    with open_path(path) as file:
                        size = header_size(file.read)
                except OSError:
                    size = None
                if size and min(size) > 0:
                    found.append((path, *size))
            yield pd.DataFrame(found, columns=["image_path", "width", "height"])

    rows = listing.select("path").repartition(tasks or int(listing.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")
    return rows.mapInPandas(sizes, "image_path string, width int, height int")


def rgb_pixels(image: dict) -> np.ndarray:
    """One row of an image table as an RGB or RGBA array; grey becomes RGB."""
    if image["height"] <= 0:
        raise ValueError("unreadable image")
    channels = image["nChannels"]
    pixels = np.frombuffer(image["data"], np.uint8).reshape(image["height"], image["width"], channels)
    if channels == 1:
        return np.repeat(pixels, 3, axis=2)
    return pixels[:, :, [2, 1, 0, 3][:channels]]
