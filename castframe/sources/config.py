"""Configuration of many movies as one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from castframe.functions.paths import base_name, embedding_output_path, stem
from castframe.functions.vectors import as_float_vector
from castframe.schema import CONFIG, GALLERY


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per line and movie."""
    return spark.read.schema(CONFIG).option("mode", "FAILFAST").json(path)


def actor_dimension(config: DataFrame) -> DataFrame:
    """One row per movie and actor, in configured order.

    Display names are looked up by file name, colours by actor name. An actor
    without an entry gets NULL here and a default when drawn.
    """
    path = F.col("embedding_path")
    return (
        config.select("movie", "actor_names", "actor_colors", "actor_text_colors", F.posexplode("actor_embeddings").alias("actor_ord", "embedding_path"))
        .withColumn("actor_name", stem(path))
        .select(
            "movie",
            "actor_ord",
            "embedding_path",
            "actor_name",
            F.try_element_at("actor_names", base_name(path)).alias("display_name"),
            F.try_element_at("actor_colors", F.col("actor_name")).alias("color"),
            F.try_element_at("actor_text_colors", F.col("actor_name")).alias("text_color"),
        )
    )


def build_gallery(actors: DataFrame, records: DataFrame, input_root: str, output_root: str) -> DataFrame:
    """The gallery of all movies, from the embedded faces of the actors' photographs.

    Photographs go through the same detection and embedding as frames. An actor
    names the record of one face by its mirrored path, and may do so in several
    movies.
    """
    path = embedding_output_path(F.col("image_path"), input_root, output_root, F.col("face_id"))
    faces = records.select(path.alias("embedding_path"), as_float_vector(F.col("embedding")).alias("embedding"))
    return actors.select("movie", "actor_ord", "embedding_path").join(faces, "embedding_path").select(*GALLERY.fieldNames())
