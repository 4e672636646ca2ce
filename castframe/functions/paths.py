"""Columns over file paths. All are built-in expressions inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from castframe.schema import IMAGE_SUFFIXES


def has_image_suffix(path: Column) -> Column:
    found = F.lit(False)
    for suffix in IMAGE_SUFFIXES:
        found = found | path.endswith("." + suffix)
    return found


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """File name without its last extension; for a gallery file, the actor name.

    A dot at the very start or end of a name begins no extension.
    """
    name = base_name(path)
    suffix = F.length(F.substring_index(name, ".", -1))
    kept = F.length(name) - suffix - 1
    return F.when((suffix > 0) & (kept > 0), F.substring(name, F.lit(1), kept)).otherwise(name)


def shot_relative_path(path: Column) -> Column:
    """The path from its first ``shot_`` component on, else its last three parts.

    The result is always relative, so joining it to an output folder cannot
    leave that folder.
    """
    shot = F.instr(F.concat(F.lit("/"), path), "/shot_")
    last_three = F.ltrim(F.substring_index(path, "/", -3), F.lit("/"))
    return F.when(shot > 0, F.substring(path, shot, F.length(path))).otherwise(last_three)


def embedding_output_path(path: Column, input_root: str, output_root: str, face_id: Column) -> Column:
    """Where the record of one face belongs: the frame tree, mirrored.

    A frame outside ``input_root`` keeps only its file name. The root is
    compared by components, so ``/frames2`` is not inside ``/frames``.
    """
    root = input_root.rstrip("/") + "/"
    inside = F.when(
        F.startswith(path, F.lit(root)), F.substring(path, F.lit(len(root) + 1), F.length(path))
    ).otherwise(base_name(path))
    folder = F.substring(inside, F.lit(1), F.length(inside) - F.length(base_name(inside)))
    return F.concat(
        F.lit(output_root.rstrip("/") + "/"), folder, stem(inside), F.lit("_face_"), face_id.cast("string"), F.lit(".pkl")
    )
