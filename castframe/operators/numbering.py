"""Dense row numbers that never put a whole group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from castframe.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id(): partition above, row below

def number_rows(
    df: DataFrame,
    order: Sequence[Column],
    name: str,
    groups: Sequence[str] = (),
    start: int = 1,
) -> DataFrame:
    """Number the rows of each group densely from ``start`` in the given order.

    One range-partitioned sort places the rows; it splits even a group that
    holds most of the table. The sorted table is written once, together with
    each row's place, so that the counts and the numbers are taken from the
    same placement. The counts per partition and group then become offsets.

    ``order`` should be unique within a group. The offsets have a row for each
    sorted partition and group that meet, so partitions + groups at most. They are
    written, so that their size is known before the rows are shuffled for the join:
    without groups they are broadcast, with groups Catalyst does so if they are small.
    """
    placed = materialize(
        df.orderBy(*[F.col(g) for g in groups], *order).withColumn("_at", F.monotonically_increasing_id()),
        f"numbered-{name}",
    ).withColumn("_part", F.shiftright("_at", _ROW_BITS))

    counts = placed.groupBy("_part", *groups).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("_part").alias("_o_part"),
        *[F.col(g).alias(f"_o_{g}") for g in groups],
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + start).alias("_shift"),
    )
    offsets = materialize(offsets, f"offsets-{name}")
    same = F.col("_part") == F.col("_o_part")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_o_{g}"))
    offsets = offsets if groups else F.broadcast(offsets)
    numbered = placed.join(offsets, same).withColumn(name, F.col("_at") + F.col("_shift"))
    return numbered.select(*df.columns, name)


def assign_face_ids(detections: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """Add dense, 0-based ``face_id`` values; a table that has them stays as it is.

    The ids follow ``order``, by default image path and detection number, and
    so do not depend on how the table is partitioned.
    """
    if "face_id" in detections.columns:
        return detections
    if order is None:
        keys = [c for c in ("image_path", "det_no", "x1", "y1", "x2", "y2", "confidence") if c in detections.columns]
        order = [F.col(c) for c in keys]
    return number_rows(detections, order, "face_id", start=0)


def extend_ids(
    rows: DataFrame, known: DataFrame | None, keys: Sequence[str], order: Sequence[Column], name: str, start: int
) -> DataFrame:
    """Ids that last: rows that ``known`` has by ``keys`` take its id, the others are numbered from ``start``.

    Missing values are equal. Of rows alike in their keys, the first in ``order`` takes
    the least id known for them, the second the next, and so on.
    """
    if known is None:
        return number_rows(rows, order, name, start=start)
    columns = rows.columns
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).alias("_nth")
    old_nth = F.row_number().over(Window.partitionBy(*keys).orderBy(name)).alias("_old_nth")
    old = known.select(*[F.col(c).alias(f"_{c}") for c in keys], F.col(name).alias("_id"), old_nth)
    same = F.col("_nth") == F.col("_old_nth")
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    # Numbering sorts, and a sort samples its input first: join once.
    joined = materialize(rows.select(*columns, nth).join(old, same, "left").select(*columns, "_id"), f"known-{name}")
    fresh = number_rows(joined.where("_id is null").drop("_id"), order, name, start=start)
    return joined.where("_id is not null").select(*columns, F.col("_id").alias(name)).unionByName(fresh)
