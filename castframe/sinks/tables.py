"""Writing stage tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castframe.functions.vectors import l2_norm, scaled
from castframe.schema import MATCHES

ROWS_PER_FILE = 5_000_000  # a movie with most of the faces still gives many files


def save_detections(detections: DataFrame, path: str, fmt: str = "parquet") -> None:
    """An empty result writes an empty table, so that the next stage can read it."""
    writer = detections.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", "true").option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)


def save_embeddings(records: DataFrame, path: str, mode: str = "append", by: tuple[str, ...] = ("movie",)) -> None:
    """One folder per movie. No shuffle: a task writes the movies it holds, which are few after ``embed``."""
    records.write.mode(mode).partitionBy(*by).option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)


def normalized_embeddings(faces: DataFrame) -> DataFrame:
    """Faces with the norm of their vector and the vector scaled to unit length."""
    return faces.withColumn("norm", l2_norm(F.col("embedding"))).withColumn(
        "unit", scaled(F.col("embedding"), F.col("norm"))
    )


def save_normalized(faces: DataFrame, path: str) -> None:
    normalized_embeddings(faces).write.mode("overwrite").parquet(path)


def save_matches(matches: DataFrame, path: str, by: tuple[str, ...] = ("actor_name",)) -> None:
    """One table with a folder per actor: the result of one actor is one folder.

    Ranking leaves each actor's rows in one task, or in a few neighbours, so
    this writes few files.
    """
    matches.write.mode("overwrite").partitionBy(*by).option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)


def export_matches(matches: DataFrame, path: str) -> None:
    """One CSV export, actor by actor and by rank. The sort is by ranges."""
    (
        matches.orderBy("actor_ord", "rank").select(*MATCHES.fieldNames())
        .write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
    )


def save_bucketed(rows: DataFrame, table: str, path: str, by: tuple[str, ...] = ("face_id",), buckets: int = 64) -> DataFrame:
    """A catalog table at ``path`` with its rows in buckets by ``by``, sorted in each; what was there is replaced.

    Tables with the same number of buckets by the same columns are joined and compared
    without a shuffle of either. Rows are dealt to the buckets first, so that every
    bucket is one file, and tasks are as many as buckets: choose these for the largest table.
    """
    dealt = rows.repartition(buckets, *by).sortWithinPartitions(*by)
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, *by).sortBy(*by).format("parquet").saveAsTable(table)
    return rows.sparkSession.table(table)
