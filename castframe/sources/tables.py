"""Stored tables: detections, face embeddings, gallery and matches."""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from castframe.functions.boxes import CORNERS, pack_box
from castframe.functions.vectors import as_float_vector, is_finite_vector
from castframe.schema import DETECTIONS_CSV, GALLERY, MATCHES


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV table whose header must name the columns of ``schema`` in order."""
    return (
        spark.read.schema(schema).option("header", "true").option("enforceSchema", "false")
        .option("mode", "FAILFAST").option("escape", '"').csv(path)
    )


def read_detections(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    extra = [T.StructField("face_id", T.LongType())] if with_ids else []
    return read_csv(spark, path, T.StructType([*DETECTIONS_CSV.fields, *extra]))


def read_matches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MATCHES).parquet(path)


def readable_embeddings(records: DataFrame) -> DataFrame:
    """Records that hold a vector of finite numbers."""
    return records.where(is_finite_vector(F.col("embedding")))


def embedding_load_report(records: DataFrame) -> DataFrame:
    """How many records were loaded and how many dropped."""
    good = is_finite_vector(F.col("embedding"))
    return records.agg(F.count_if(good).alias("loaded"), F.count_if(~good).alias("dropped"))


def load_embedding(embeddings: DataFrame, face_id: int) -> DataFrame:
    """The record of one face; the filter reaches the scan."""
    return embeddings.where(F.col("face_id") == face_id)


def load_embeddings(embeddings: DataFrame, keys: DataFrame) -> DataFrame:
    """The records of all faces that ``keys`` names by ``face_id``."""
    return embeddings.join(keys.select("face_id"), "face_id", "left_semi")


def with_embeddings(detections: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Detections with the vector of their face, those alone that have one.

    Only the ids and vectors of the embeddings are read. Stage tables that are bucketed
    alike (``save_bucketed``) are joined where they lie.
    """
    shared = ["movie", "face_id"] if "movie" in detections.columns and "movie" in embeddings.columns else ["face_id"]
    return detections.join(embeddings.select(*shared, "embedding"), shared)


def faces_for_image(detections: DataFrame, image_path: str) -> DataFrame:
    """The faces of one image, by exact path; the filter reaches the scan."""
    return _faces(detections.where(F.col("image_path") == image_path))


def faces_for_images(detections: DataFrame, images: DataFrame) -> DataFrame:
    """The faces of all images that ``images`` names by ``image_path``."""
    return _faces(detections.join(images.select("image_path"), "image_path", "left_semi"))


def _faces(detections: DataFrame) -> DataFrame:
    box = pack_box(*[F.col(c) for c in CORNERS])
    return detections.select("image_path", "face_id", box.alias("bbox"), "confidence")


def load_gallery(records: DataFrame) -> DataFrame:
    """Gallery records with float32 vectors."""
    return records.withColumn("embedding", as_float_vector(F.col("embedding")))


def list_gallery(spark: SparkSession, folder: str, suffix: str = ".pkl") -> DataFrame:
    """The gallery files directly inside ``folder``, sorted by path."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        warnings.warn(f"no such gallery folder: {folder}", stacklevel=2)
        return spark.createDataFrame([], "embedding_path string")
    return files.select(F.regexp_replace("path", "^file:/+", "/").alias("embedding_path")).orderBy("embedding_path")


def sorted_gallery(gallery: DataFrame) -> DataFrame:
    return gallery.orderBy("embedding_path")


def read_gallery(spark: SparkSession, path: str) -> DataFrame:
    """A stored gallery table; a missing one is empty, with a warning."""
    try:
        return load_gallery(spark.read.schema(GALLERY).parquet(path))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        warnings.warn(f"no such gallery: {path}", stacklevel=2)
        return spark.createDataFrame([], GALLERY)
