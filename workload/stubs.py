"""Models made of arithmetic, so that SQL can state their results."""

from __future__ import annotations

import numpy as np
import pandas as pd


def frame_key(path: str) -> int:
    return int(path.rsplit("/", 1)[1].split(".")[0])


def detector():
    """Frame n has n mod 3 faces."""

    def detect(frames: pd.DataFrame) -> list:
        found = []
        for path in frames["path"]:
            key = frame_key(path)
            x, y = key % 1200, key % 650
            found.append([(x + i, y + i, x + i + 20, y + i + 30, 1 - i * 0.25) for i in range(key % 3)])
        return found

    return detect


def read_frame(path: str) -> np.ndarray:
    """A 1280 x 720 image in one colour that encodes the frame number."""
    key = frame_key(path)
    return np.broadcast_to(np.array([key & 255, key >> 8 & 255, key >> 16], np.uint8), (720, 1280, 3))


def read_some_frames(path: str) -> np.ndarray:
    """As ``read_frame``, but one frame in 97 cannot be opened."""
    if frame_key(path) % 97 == 5:
        raise OSError("broken image")
    return read_frame(path)


def blank_frame(path: str) -> np.ndarray:
    return np.zeros((720, 1280, 3), np.uint8)


def write_size(path: str, pixels: np.ndarray) -> None:
    """A file with one byte for each row of the image."""
    with open(path, "wb") as file:
        file.write(bytes(pixels.shape[0]))


def _keys(crops: list) -> np.ndarray:
    colors = np.array([crop[0, 0] for crop in crops], np.int64)
    return colors[:, 0] + (colors[:, 1] << 8) + (colors[:, 2] << 16)


def size_embedder():
    """A vector of frame number, crop width and crop height."""

    def embed(crops: list) -> np.ndarray:
        sizes = np.array([crop.shape[:2] for crop in crops])
        return np.column_stack([_keys(crops), sizes[:, 1], sizes[:, 0]]).astype(np.float32)

    return embed


def wave_embedder():
    """64 whole numbers between -50 and 50, from the frame number."""

    def embed(crops: list) -> np.ndarray:
        d = np.arange(64)
        return ((_keys(crops)[:, None] * 7 + d * d * 5) % 101 - 50).astype(np.float32)

    return embed
