"""The driver tables seen as frames, detections, faces, images and a gallery.

One order is a frame, one line of it a detected face, and an embedding vector
is an embedded face. ``workload.oracle`` states the same views in SQL.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from castframe.functions.boxes import pack_box
from castframe.operators.inference import spread
from castframe.operators.numbering import assign_face_ids
from castframe.session import materialize, scratch

INPUT_ROOT = "/frames"
OUTPUT_ROOT = "/embeddings"

_stored: dict[tuple[str, str, str], DataFrame] = {}


# The columns in use; with a schema given, Spark need not open a file to plan.
SCHEMAS = {
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "orders": "o_orderkey bigint, o_orderdate timestamp",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double",
    "part": "p_brand string",
    "customer": "c_custkey bigint, c_nationkey int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(value) -> F.Column:
    return value.cast("string")


def frame_path(key, suffix=None) -> F.Column:
    shot = F.floor(key / 100).cast("bigint")
    return F.concat(
        F.lit("/frames/movie_"), _text(key % 3), F.lit("/shot_"), _text(shot), F.lit("/"), _text(key % 4), F.lit("/"),
        _text(key), F.lit(".jpg") if suffix is None else suffix,
    )


FIRST_DELIVERY = "1998-05-01"  # frames of earlier orders came first


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frames(table(spark, sf_dir, "orders"))


def first_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What had been delivered when the first of two runs took place; the second takes all frames."""
    return _frames(table(spark, sf_dir, "orders").where(F.col("o_orderdate") < FIRST_DELIVERY))


def _frames(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    suffix = F.when(key % 50 == 49, ".JPG").when(key % 50 == 48, ".txt").otherwise(".jpg")
    length = F.when(key % 40 == 7, 52428801).when(key % 40 == 8, 52428800).otherwise(1000 + key).cast("bigint")
    return orders.select(
        F.concat(F.lit("movie_"), _text(key % 3)).alias("movie"), frame_path(key, suffix).alias("path"), length.alias("length")
    )


LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*LINE_ORDER, "l_quantity", "l_discount")


def _as_detections(lines: DataFrame, *kept: str) -> DataFrame:
    """The detections that lines stand for, with the columns ``kept`` of the lines before them."""
    x = (F.col("l_partkey") % 1200).cast("double") + F.col("l_discount")
    y = (F.col("l_suppkey") % 650).cast("double") + F.col("l_discount")
    return lines.select(
        *kept,
        F.concat(F.lit("movie_"), _text(F.col("l_orderkey") % 3)).alias("movie"),
        frame_path(F.col("l_orderkey")).alias("image_path"),
        x.alias("x1"), y.alias("y1"),
        (x + 20 + F.col("l_quantity")).alias("x2"), (y + 20 + F.col("l_quantity")).alias("y2"),
        (F.lit(1.0) - F.col("l_discount") * 5).alias("confidence"),
        *[c for c in lines.columns if c == "face_id"],
    )


def raw_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections without ids, with the line columns that give their order."""
    return _as_detections(_lines(spark, sf_dir), *LINE_ORDER)


def number_detections(raw: DataFrame) -> DataFrame:
    return assign_face_ids(raw, [F.col(c) for c in LINE_ORDER]).drop(*LINE_ORDER)


def numbered_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections with ids. The lines are sorted and numbered; their paths and boxes, which are wider, come after that."""
    return _as_detections(assign_face_ids(_lines(spark, sf_dir), [F.col(c) for c in LINE_ORDER]))


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detections table with ids; the numbered lines behind it are written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, "detections")
    if key not in _stored:
        _stored[key] = numbered_detections(spark, sf_dir)
    return _stored[key]


def faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("vec_id")
    frame = F.floor(v / 2).cast("bigint")
    x, y = (v * 37 % 1200).cast("double"), (v * 53 % 650).cast("double")
    path = F.concat(
        F.lit("/frames/movie_"), _text(frame % 3), F.lit("/shot_"), _text(F.floor(v / 20).cast("bigint")), F.lit("/"),
        _text(frame % 4), F.lit("/"), _text(frame), F.lit(".jpg"),
    )
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("movie_"), _text(frame % 3)).alias("movie"),
        v.alias("face_id"), "embedding", path.alias("image_path"),
        pack_box(x + 0.75, y + 0.25, x + 40.75, y + 50.25).alias("bbox"),
        (F.lit(0.5) + (v % 50).cast("double") / 100).alias("confidence"),
    )


def stored(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A table that several queries read, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        _stored[key] = materialize(make(), name)
    return _stored[key]


def gallery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "gallery", lambda: _gallery(spark, sf_dir))


def _gallery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first vector of each label, as the reference vector of one actor."""
    first = table(spark, sf_dir, "embeddings").groupBy("label").agg(F.min_by("embedding", "vec_id").alias("embedding"))
    label = F.col("label")
    name = F.concat(F.lit("actor_"), _text(label), F.lit("_face_0"))
    styled = label % 3 == 0
    return first.select(
        F.concat(F.lit("movie_"), _text(label % 3)).alias("movie"),
        label.cast("int").alias("actor_ord"),
        F.concat(F.lit("/gallery/"), name, F.lit(".pkl")).alias("embedding_path"),
        "embedding",
        F.when(label % 2 == 0, F.concat(F.lit("Actor "), _text(label))).alias("display_name"),
        F.when(styled, F.struct((label * 20).cast("int").alias("r"), F.lit(50).alias("g"), F.lit(50).alias("b"))).alias("color"),
        F.when(styled, F.lit("white")).alias("text_color"),
    )


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The images that hold embedded faces, with their sizes."""
    frame = F.regexp_extract("image_path", r"/([0-9]+)\.jpg$", 1).cast("bigint")
    length = F.when(frame % 40 == 7, 52428801).otherwise(52428800).cast("bigint")
    return faces(spark, sf_dir).select("image_path").distinct().select(
        "image_path", F.lit(1280).alias("width"), F.lit(720).alias("height"), length.alias("length")
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One embedding record per detection; most hold no vector."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("face_id"), "embedding")
    return detections(spark, sf_dir).join(vectors, "face_id", "left")


def done(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    """The detections that already have an embedding."""
    keys = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("face_id"))
    return detections(spark, sf_dir).join(keys, "face_id", "left_semi").withColumn("model", F.lit(model))


def config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configuration row per movie, from the gallery."""
    actor = F.struct("actor_ord", "embedding_path", "actor_name", "display_name", "color", "text_color")
    named = gallery(spark, sf_dir).withColumn("actor_name", F.regexp_extract("embedding_path", "([^/]+)[.]pkl$", 1))
    grouped = named.groupBy("movie").agg(F.array_sort(F.collect_list(actor)).alias("actors"))

    def lookup(key, value):
        known = F.filter("actors", lambda a: a[value].isNotNull())
        return F.map_from_entries(F.transform(known, lambda a: F.struct(key(a).alias("key"), a[value].alias("value"))))

    return grouped.select(
        "movie",
        F.concat(F.lit("/frames/"), "movie").alias("frames_dir"),
        F.concat(F.lit("/out/"), "movie").alias("output_dir"),
        F.transform("actors", lambda a: a.embedding_path).alias("actor_embeddings"),
        lookup(lambda a: F.concat(a.actor_name, F.lit(".pkl")), "display_name").alias("actor_names"),
        lookup(lambda a: a.actor_name, "color").alias("actor_colors"),
        lookup(lambda a: a.actor_name, "text_color").alias("actor_text_colors"),
    )


def pixel_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector as an 8 x 8 grey image; those of label 0 are unreadable."""
    digits = F.transform("embedding", lambda x: F.lpad(F.hex(F.floor((x.cast("double") + 1) * 127).cast("bigint")), 2, "0"))
    readable = F.col("label") != 0
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("/pixels/"), _text(F.col("vec_id")), F.lit(".png")).alias("image_path"),
        F.struct(
            F.concat(F.lit("/pixels/"), _text(F.col("vec_id")), F.lit(".png")).alias("origin"),
            F.when(readable, 8).otherwise(-1).alias("height"),
            F.when(readable, 8).otherwise(-1).alias("width"),
            F.when(readable, 1).otherwise(-1).alias("nChannels"),
            F.when(readable, 0).otherwise(-1).alias("mode"),
            F.when(readable, F.unhex(F.array_join(digits, ""))).otherwise(F.unhex(F.lit(""))).alias("data"),
        ).alias("image"),
    )


def pixel_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box on each of those images; some reach over its border."""
    v = F.col("vec_id")
    x, y = (v % 7).cast("double") - 1.5, (v % 5).cast("double") - 0.5
    return table(spark, sf_dir, "embeddings").select(
        v.alias("face_id"),
        F.concat(F.lit("/pixels/"), _text(v), F.lit(".png")).alias("image_path"),
        x.alias("x1"), y.alias("y1"), (x + 3 + v % 4).alias("x2"), (y + 2 + v % 3).alias("y2"),
    )


_written: dict[tuple[str, str, str], str] = {}


def files(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> str:
    """A folder with the files of rows (path, content), written by tasks, once per application."""

    def write(batches):
        made = set()
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                parent = os.path.dirname(path)
                if parent not in made:
                    os.makedirs(parent, exist_ok=True)
                    made.add(parent)
                with open(path, "wb") as file:
                    file.write(content)
            yield batch[["path"]]

    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        folder = scratch(spark, name)
        # A small table is one scan task, and each of its rows is a file to write: they are dealt out by folder.
        rows = make().withColumn("path", F.concat(F.lit(folder), "path"))
        rows = spread(rows, None, F.regexp_extract("path", "^(.*)/", 1))
        rows.mapInPandas(write, "path string").write.format("noop").mode("overwrite").save()
        _written[key] = folder
    return _written[key]


def frame_files(spark: SparkSession, sf_dir: str) -> str:
    """A frame file for each customer: the start of an image whose size comes from the key. Some are no images by their names."""
    key = F.col("c_custkey")
    suffix = F.when(key % 5 == 0, ".txt").when(key % 5 == 1, ".JPG").when(key % 5 == 2, ".jpg").otherwise(".png")
    path = F.concat(
        F.lit("/movie_"), _text(F.col("c_nationkey") % 3), F.lit("/shot_"), _text(F.floor(key / 100).cast("bigint")), F.lit("/"), _text(key), suffix
    )
    start = F.lit("89504E470D0A1A0A0000000D49484452")
    size = [F.lpad(F.hex(n), 8, "0") for n in (key % 1280 + 1, key % 720 + 1)]
    return files(spark, sf_dir, "frame-files", lambda: table(spark, sf_dir, "customer").select(path.alias("path"), F.unhex(F.concat(start, *size)).alias("content")))


def gallery_files(spark: SparkSession, sf_dir: str) -> str:
    """The gallery's files, and others beside them."""
    own = gallery(spark, sf_dir).select(F.regexp_replace("embedding_path", "^/gallery", "").alias("path"))
    more = own.select(F.concat("path", F.lit(".txt")).alias("path"))
    return files(spark, sf_dir, "gallery-files", lambda: own.union(more).withColumn("content", F.lit(b"x")))
