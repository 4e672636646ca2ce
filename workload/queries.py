"""One query per operator, over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from castframe.functions import boxes, paths, vectors
from castframe.operators import annotate, inference, lsh, render, search, states, summary
from castframe.plans import tagging
from castframe.plans.configured import ConfiguredRun
from castframe.plans.tagging import Settings, TaggingRun
from castframe.schema import CONFIG, DETECTIONS_CSV, MATCHES, PREVIEW_ROWS
from castframe.session import materialize, scratch, ship
from castframe.sinks import images as image_sink
from castframe.sinks import labelling, tables as sinks
from castframe.sources import config, frames as frame_source, images, listing, tables
from workload import fixtures as fx
from workload import stubs

MODEL = "stub"
THRESHOLD = 0.2
TOP_K = 20

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark, "castframe", "workload")
        return function(spark, sf_dir.rstrip("/"))

    QUERIES[function.__name__] = run
    return function


def _six(*names: str) -> list:
    return [F.round(n, 6).alias(n) for n in names]


def _matches(spark: SparkSession, sf_dir: str, k: int | None = None, within: str | None = None) -> DataFrame:
    """The search anew: for the queries that are about it."""
    return search.match_faces(fx.faces(spark, sf_dir), fx.gallery(spark, sf_dir), k, within)


def _stored_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matches as a table: for the queries that start from it."""
    return fx.stored(spark, sf_dir, "matches", lambda: _matches(spark, sf_dir))


MATCH_COLUMNS = ("similarity_score", "face_x1", "face_y1", "face_x2", "face_y2", "face_confidence")


def _match_rows(matches: DataFrame, *extra: str) -> DataFrame:
    return matches.select(
        *extra, "rank", *_six(*MATCH_COLUMNS), "frame_image_path", "face_id", "actor_name", "actor_embedding_path"
    )


# Sources


@query
def frames_by_extension(spark, sf_dir):
    return frame_source.image_frames(fx.frames(spark, sf_dir)).select("path", "length")


@query
def detections_roundtrip(spark, sf_dir):
    columns = [*DETECTIONS_CSV.fieldNames(), "face_id"]
    path = scratch(spark, "detections-csv")
    sinks.save_detections(fx.detections(spark, sf_dir).select(*columns), path, "csv")
    back = tables.read_detections(spark, path, with_ids=True)
    return back.select("face_id", "image_path", *_six("x1", "y1", "x2", "y2", "confidence"))


@query
def load_face_embeddings(spark, sf_dir):
    good = tables.readable_embeddings(fx.records(spark, sf_dir))
    return good.select("face_id", "image_path", F.size("embedding").cast("bigint").alias("dims"), *_six("confidence"))


@query
def embedding_load_report(spark, sf_dir):
    return tables.embedding_load_report(fx.records(spark, sf_dir))


@query
def embedding_by_face_id(spark, sf_dir):
    """The faces that match an actor well: their ids come from the stored matches."""
    wanted = annotate.above_threshold(_stored_matches(spark, sf_dir), THRESHOLD).select("face_id")
    found = tables.load_embeddings(fx.faces(spark, sf_dir), wanted)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return found.select("face_id", "image_path", F.round(total, 6).alias("total"), *_six("confidence"))


@query
def load_gallery(spark, sf_dir):
    doubles = fx.gallery(spark, sf_dir).withColumn("embedding", F.col("embedding").cast("array<double>"))
    gallery = tables.load_gallery(doubles)
    return gallery.select("embedding_path", F.posexplode("embedding").alias("place", "value")).select(
        "embedding_path", F.col("place").cast("bigint").alias("place"), F.round(F.col("value").cast("double"), 6).alias("value")
    )


@query
def gallery_listing(spark, sf_dir):
    """The files of a real folder, other files beside them left out."""
    folder = fx.gallery_files(spark, sf_dir)
    listed = tables.list_gallery(spark, folder)
    path = F.concat(F.lit("/gallery"), F.substring("embedding_path", len(folder) + 1, 1 << 20))
    return listed.select(path.alias("embedding_path"), paths.stem(path).alias("actor_name"))


def _files(spark, sf_dir):
    """Real folders of frames, one per movie, as roots; the path without the folder they lie in."""
    folder = fx.frame_files(spark, sf_dir)
    movies = fx.table(spark, sf_dir, "customer").select(F.concat(F.lit("movie_"), F.col("c_nationkey") % 3).alias("movie")).distinct()
    roots = movies.withColumn("folder", F.concat(F.lit(folder + "/"), "movie"))
    return roots, lambda path: F.substring(path, len(folder) + 1, 1 << 20)


@query
def listed_frames(spark, sf_dir):
    """The images in real folders of three movies."""
    roots, inside = _files(spark, sf_dir)
    return listing.listed_frames(spark, roots).select("movie", inside("path").alias("path"), "length")


@query
def frame_file_sizes(spark, sf_dir):
    """Width and height from the first bytes of each listed file."""
    roots, inside = _files(spark, sf_dir)
    sizes = images.file_dimensions(listing.listed_frames(spark, roots))
    return sizes.select(inside("image_path").alias("image_path"), *[F.col(c).cast("bigint").alias(c) for c in ("width", "height")])


@query
def actor_dimension(spark, sf_dir):
    path = scratch(spark, "config")
    fx.config(spark, sf_dir).write.json(path)
    actors = config.actor_dimension(config.read_config(spark, path))
    return actors.select(
        "movie", F.col("actor_ord").cast("bigint").alias("actor_ord"), "embedding_path", "actor_name", "display_name",
        *[F.col(f"color.{c}").cast("bigint").alias(c) for c in "rgb"], "text_color",
    )


@query
def build_gallery(spark, sf_dir):
    """The gallery again, from the embedded faces that the actors name by path."""
    faces, gallery = fx.faces(spark, sf_dir), fx.gallery(spark, sf_dir)
    path = paths.embedding_output_path(F.col("image_path"), fx.INPUT_ROOT, fx.OUTPUT_ROOT, F.col("face_id"))
    first = fx.table(spark, sf_dir, "embeddings").groupBy("label").agg(F.min("vec_id").alias("face_id"))
    named = first.join(faces.select("face_id", "image_path"), "face_id").select(
        F.col("label").alias("actor_ord"), path.alias("embedding_path")
    )
    actors = gallery.select("movie", "actor_ord").join(named, "actor_ord")
    built = config.build_gallery(actors, faces, fx.INPUT_ROOT, fx.OUTPUT_ROOT)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return built.select("movie", F.col("actor_ord").cast("bigint").alias("actor_ord"), "embedding_path", F.round(total, 6).alias("total"))


@query
def image_dimensions(spark, sf_dir):
    sizes = images.image_dimensions(fx.pixel_images(spark, sf_dir))
    return sizes.select("image_path", *[F.col(c).cast("bigint").alias(c) for c in ("width", "height", "channels")])


# Sinks


@query
def embedding_table_layout(spark, sf_dir):
    path = scratch(spark, "embeddings")
    sinks.save_embeddings(fx.faces(spark, sf_dir), path)
    stored = spark.read.parquet(path)
    return stored.groupBy("movie").agg(
        F.count("*").alias("faces"), F.min("face_id").alias("first_id"), F.max("face_id").alias("last_id")
    )


@query
def normalized_embeddings(spark, sf_dir):
    path = scratch(spark, "normalized")
    sinks.save_normalized(fx.faces(spark, sf_dir).select("face_id", "embedding"), path)
    unit = spark.read.schema("face_id bigint, norm double, unit array<double>").parquet(path)
    return unit.select("face_id", *_six("norm"), F.posexplode("unit").alias("place", "value")).select(
        "face_id", "norm", F.col("place").cast("bigint").alias("place"), *_six("value")
    )


@query
def matches_for_one_actor(spark, sf_dir):
    path = scratch(spark, "matches")
    sinks.save_matches(_stored_matches(spark, sf_dir), path)
    stored = tables.read_matches(spark, path)
    return _match_rows(stored.where(F.col("actor_name") == "actor_3_face_0"))


@query
def exported_matches(spark, sf_dir):
    """The matches as CSV, read again."""
    path = scratch(spark, "export")
    sinks.export_matches(_stored_matches(spark, sf_dir), path)
    return _match_rows(tables.read_csv(spark, path, MATCHES))


@query
def labelling_samples(spark, sf_dir):
    path = scratch(spark, "samples")
    samples = labelling.labelling_samples(_stored_matches(spark, sf_dir), fx.images(spark, sf_dir))
    labelling.save_samples(samples, path)
    back = spark.read.schema(samples.schema).json(path)
    place = F.row_number().over(Window.partitionBy("filepath").orderBy("actor_ord", "rank", "face_id")) - 1
    return back.select(
        "filepath", place.cast("bigint").alias("place"), "label",
        *[F.round(F.col("bounding_box")[i], 6).alias(n) for i, n in enumerate("xywh")], *_six("confidence"),
    )


@query
def sample_images(spark, sf_dir):
    return labelling.sample_images(labelling.labelling_samples(_stored_matches(spark, sf_dir), fx.images(spark, sf_dir)))


# Columns


@query
def embedding_output_path(spark, sf_dir):
    path = paths.embedding_output_path(F.col("image_path"), "/frames/movie_1", fx.OUTPUT_ROOT, F.col("face_id"))
    return fx.detections(spark, sf_dir).select("face_id", path.alias("output_path"))


@query
def path_parts(spark, sf_dir):
    path = F.col("path")
    return fx.frames(spark, sf_dir).select("path", paths.base_name(path).alias("base_name"), paths.stem(path).alias("stem"))


@query
def shot_relative_path(spark, sf_dir):
    """Half of the paths lose their shot folder first, so both forms occur."""
    path = F.when(F.col("length") % 2 == 0, F.regexp_replace("path", "/shot_", "/scene/")).otherwise(F.col("path"))
    return fx.frames(spark, sf_dir).select("path", paths.shot_relative_path(path).alias("relative_path"))


@query
def faces_for_image(spark, sf_dir):
    """The faces of every listed image, in the form of one lookup per image."""
    wanted = frame_source.image_frames(fx.frames(spark, sf_dir)).select(F.col("path").alias("image_path"))
    found = tables.faces_for_images(fx.detections(spark, sf_dir), wanted)
    return found.select("image_path", "face_id", *_six("confidence"), *[F.round(c, 6).alias(f"box_{n}") for c, n in zip([f"bbox.{n}" for n in boxes.CORNERS], boxes.CORNERS)])


@query
def annotation_labels(spark, sf_dir):
    styled = annotate.with_actor_style(_stored_matches(spark, sf_dir), fx.gallery(spark, sf_dir))
    return styled.select(
        "face_id", "actor_name", "display_name",
        boxes.match_label(F.col("display_name"), F.col("similarity_score")).alias("label"),
    )


@query
def annotation_colors(spark, sf_dir):
    styled = annotate.with_actor_style(_stored_matches(spark, sf_dir), fx.gallery(spark, sf_dir))
    return styled.select(
        "face_id", "actor_name", *[F.col(f"color.{c}").cast("bigint").alias(c) for c in "rgb"], "text_color"
    )


@query
def relative_boxes(spark, sf_dir):
    rows = labelling.relative_boxes(_stored_matches(spark, sf_dir), fx.images(spark, sf_dir))
    return rows.select(
        "filepath", "face_id", "label", *_six("confidence"),
        *[F.round(F.col("bounding_box")[i], 6).alias(n) for i, n in enumerate("xywh")],
    )


@query
def cosine_scores(spark, sf_dir):
    scores = search.score_all(fx.faces(spark, sf_dir).select("face_id", "embedding"), fx.gallery(spark, sf_dir))
    return scores.select("face_id", F.col("actor_ord").cast("bigint").alias("actor_ord"), *_six("similarity_score"))


@query
def crop_shapes(spark, sf_dir):
    rows = inference.attach_images(fx.pixel_boxes(spark, sf_dir), fx.pixel_images(spark, sf_dir))
    cut = inference.crop_faces(rows)
    return cut.select(
        "face_id", *[F.col(c).cast("bigint").alias(c) for c in ("width", "height", "channels")], F.md5("pixels").alias("digest")
    )


# Filters


@query
def frames_without_faces(spark, sf_dir):
    listed = frame_source.image_frames(fx.frames(spark, sf_dir))
    return summary.frames_without_faces(listed, fx.raw_detections(spark, sf_dir)).select("path", "length")


@query
def matches_above_threshold(spark, sf_dir):
    return _match_rows(annotate.above_threshold(_stored_matches(spark, sf_dir), THRESHOLD))


@query
def matches_no_threshold(spark, sf_dir):
    return _match_rows(annotate.above_threshold(_stored_matches(spark, sf_dir), 0.0))


@query
def pending_embeddings(spark, sf_dir):
    todo = inference.pending_embeddings(fx.detections(spark, sf_dir), fx.done(spark, sf_dir, MODEL), MODEL)
    return todo.select("movie", "face_id", "image_path")


@query
def annotatable_images(spark, sf_dir):
    listing = frame_source.image_frames(fx.frames(spark, sf_dir))
    return annotate.annotatable_images(_stored_matches(spark, sf_dir), listing)


# Joins


@query
def actor_matches(spark, sf_dir):
    return _match_rows(_matches(spark, sf_dir))


@query
def actor_topk(spark, sf_dir):
    return _match_rows(_matches(spark, sf_dir, TOP_K))


@query
def actor_topk_lsh(spark, sf_dir):
    return _match_rows(lsh.match_faces_lsh(fx.faces(spark, sf_dir), fx.gallery(spark, sf_dir), TOP_K))


@query
def detections_with_embeddings(spark, sf_dir):
    vectors = fx.faces(spark, sf_dir).select("face_id", "embedding")
    joined = tables.with_embeddings(fx.detections(spark, sf_dir), vectors)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return joined.select("face_id", "image_path", *_six("x1", "y1", "x2", "y2"), F.round(total, 6).alias("total"))


@query
def bucketed_join(spark, sf_dir):
    """Detections and embeddings in equal buckets: joined, and those without a vector, where they lie."""
    path = scratch(spark, "bucketed")
    name = "bucketed_" + path.rsplit("-", 1)[1]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    detections = sinks.save_bucketed(fx.detections(spark, sf_dir), f"{name}_faces", f"{path}/faces", buckets=buckets)
    vectors = fx.faces(spark, sf_dir).select("face_id", "embedding")
    vectors = sinks.save_bucketed(vectors, f"{name}_vectors", f"{path}/vectors", buckets=buckets)
    found = tables.with_embeddings(detections, vectors).select("face_id", "image_path", F.size("embedding").cast("bigint").alias("dims"))
    missing = detections.join(vectors, "face_id", "left_anti")
    return found.unionByName(missing.select("face_id", "image_path", F.lit(0).cast("bigint").alias("dims")))


@query
def embedding_coverage(spark, sf_dir):
    return summary.embedding_coverage(fx.detections(spark, sf_dir), fx.faces(spark, sf_dir))


# Aggregates


@query
def actor_summary(spark, sf_dir):
    return summary.actor_summary(_stored_matches(spark, sf_dir))


@query
def faces_per_actor(spark, sf_dir):
    kept = annotate.above_threshold(_stored_matches(spark, sf_dir), THRESHOLD)
    return summary.faces_per_actor(kept, fx.gallery(spark, sf_dir))


@query
def unique_images(spark, sf_dir):
    return summary.unique_images(annotate.above_threshold(_stored_matches(spark, sf_dir), THRESHOLD))


@query
def faces_per_image(spark, sf_dir):
    return summary.faces_per_image(_stored_matches(spark, sf_dir))


@query
def annotation_plan(spark, sf_dir):
    plan = annotate.annotation_plan(_stored_matches(spark, sf_dir), fx.gallery(spark, sf_dir), THRESHOLD)
    whole = ("actor_ord", "rank", "x1", "y1", "x2", "y2", "text_x", "text_y", "back_x2", "back_y2")
    return plan.select(
        "frame_image_path", "save_path", "face_id", "label", "text_color",
        *[F.col(c).cast("bigint").alias(c) for c in whole], *[F.col(f"color.{c}").cast("bigint").alias(c) for c in "rgb"],
    )


@query
def embedding_counters(spark, sf_dir):
    """Counted from the stored outcome, so that no model runs for it."""
    run = fx.stored(spark, sf_dir, "embedding-run", lambda: inference.embedding_run(
        fx.detections(spark, sf_dir), fx.done(spark, sf_dir, MODEL), MODEL,
        embedder_factory=stubs.size_embedder, read_image=stubs.read_some_frames,
    ))
    return inference.embedding_counters(run)


@query
def detection_summary(spark, sf_dir):
    listed = frame_source.image_frames(fx.frames(spark, sf_dir))
    return summary.detection_summary(listed, fx.raw_detections(spark, sf_dir))


# Windows


@query
def assign_face_ids(spark, sf_dir):
    return fx.numbered_detections(spark, sf_dir).select(
        "face_id", "image_path", *_six("x1", "y1", "x2", "y2", "confidence")
    )


@query
def top5_preview(spark, sf_dir):
    best = search.preview(_matches(spark, sf_dir, PREVIEW_ROWS), PREVIEW_ROWS)
    return best.select("rank", *_six("similarity_score"), "frame_image_path", "actor_name")


@query
def matches_union(spark, sf_dir):
    faces, gallery = fx.faces(spark, sf_dir), fx.gallery(spark, sf_dir)
    runs = [gallery.where("display_name is not null"), gallery.where("display_name is null")]
    return _match_rows(search.union_matches(*[search.match_faces(faces, part) for part in runs]))


# Batch jobs


@query
def detect_with_stub(spark, sf_dir):
    found = inference.detect(frame_source.image_frames(fx.frames(spark, sf_dir)), stubs.detector)
    return found.select("movie", "image_path", "det_no", *_six("x1", "y1", "x2", "y2", "confidence"))


@query
def embed_with_stub(spark, sf_dir):
    result = inference.embed(fx.detections(spark, sf_dir), stubs.size_embedder, MODEL, stubs.read_some_frames)
    return result.select(
        "movie", "face_id", "image_path", "model", "status", "error",
        *[F.get("embedding", F.lit(i)).cast("bigint").alias(n) for i, n in enumerate(("frame", "width", "height"))],
    )


def _rendered(spark, sf_dir, store_factory=None):
    """Drawing starts from stored matches: they are read for the plan and for the images."""
    matches = materialize(annotate.above_threshold(_stored_matches(spark, sf_dir), THRESHOLD), "matches")
    plan = annotate.annotation_plan(matches, fx.gallery(spark, sf_dir), THRESHOLD)
    listing = fx.images(spark, sf_dir).select(F.col("image_path").alias("path"), "length")
    usable = materialize(annotate.annotatable_images(matches, listing), "usable")
    return render.render(plan, stubs.blank_frame, usable=usable, store_factory=store_factory)


def _render_columns():
    whole = [F.col(c).cast("bigint").alias(c) for c in ("width", "height", "channels")]
    return ["frame_image_path", "save_path", "status", "error", "faces_drawn", *whole]


@query
def render_status(spark, sf_dir):
    return _rendered(spark, sf_dir).drop("pixels").select(*_render_columns())


@query
def annotation_counters(spark, sf_dir):
    """Counted from the stored outcome, so that nothing is drawn for it."""
    return render.annotation_counters(fx.stored(spark, sf_dir, "rendered", lambda: _rendered(spark, sf_dir).drop("pixels")))


@query
def published_images(spark, sf_dir):
    """The images that a committed job has published, with the size of each file."""
    path = scratch(spark, "images")
    image_sink.draw_images(lambda store: _rendered(spark, sf_dir, store), path, stubs.write_size)
    published = image_sink.published_images(spark, path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jpg").load(path)
    stored = files.select(F.regexp_replace("path", "^file:/+", "/").alias("file"), "length")
    return published.join(stored, "file", "left").select(*_render_columns(), F.col("length").alias("file_bytes"))


@query
def nothing_to_draw(spark, sf_dir):
    """A threshold that no match reaches: no image is opened, and the counters are zero."""
    matches = annotate.above_threshold(_stored_matches(spark, sf_dir), 1.5)
    plan = annotate.annotation_plan(matches, fx.gallery(spark, sf_dir), 1.5)
    return render.annotation_counters(render.render(plan, stubs.blank_frame))


@query
def best_matches_kept_up_to_date(spark, sf_dir):
    """The best matches of the faces known first, merged with those of the others: equal to a search over all."""
    faces, gallery = fx.faces(spark, sf_dir), fx.gallery(spark, sf_dir)
    path = scratch(spark, "best")
    known = F.col("confidence") < 0.75
    search.match_faces(faces.where(known), gallery, TOP_K).write.parquet(path)
    later = search.match_faces(faces.where(~known), gallery, TOP_K)
    return _match_rows(search.merge_matches(spark.read.schema(later.schema).parquet(path), later, TOP_K))


@query
def united_actor_summary(spark, sf_dir):
    """Summaries kept per movie: those of two movies first, then the third reads its own rows; united per actor."""
    found = _stored_matches(spark, sf_dir)
    movie = F.regexp_extract("frame_image_path", "^/frames/([^/]+)/", 1)
    matches = found.withColumn("movie", movie)
    path = scratch(spark, "states")
    states.summary_states(matches.where("movie <> 'movie_2'")).write.parquet(path)
    states.new_states(matches, spark.read.parquet(path)).write.mode("append").parquet(path)
    united = states.united_summary(spark.read.parquet(path))
    exact = found.groupBy("actor_name").agg(F.countDistinct("frame_image_path").alias("exact"))
    near = F.abs(F.col("images") - F.col("exact")) <= 0.06 * F.col("exact")
    return united.join(exact, "actor_name").select("actor_name", "count", "mean", "max", "min", near.alias("images_within_error"))


# Whole runs


@query
def tag_run(spark, sf_dir):
    """Frames to the ten best faces per actor, with label, through all stages."""
    gallery = fx.gallery(spark, sf_dir)
    run = TaggingRun(spark, scratch(spark, "run"), Settings(model=MODEL, top_k=10))
    run.run(fx.frames(spark, sf_dir), gallery, gallery, stubs.detector, stubs.wave_embedder, stubs.read_frame)
    plan = run.table("annotation_plan")
    whole = ("actor_ord", "rank", "face_id", "x1", "y1", "x2", "y2", "text_y")
    return plan.select("movie", "save_path", "label", "text_color", *[F.col(c).cast("bigint").alias(c) for c in whole])


@query
def matches_all_movies(spark, sf_dir):
    return _match_rows(_matches(spark, sf_dir, within="movie"), "movie")


@query
def movie_status(spark, sf_dir):
    """Each part brand is a configured movie. Three have frames; the gallery of one does not fit its faces."""
    brands = fx.table(spark, sf_dir, "part").select(
        F.concat(F.lit("movie_"), F.regexp_extract("p_brand", "([0-9]+)$", 1).cast("int").cast("string")).alias("movie")
    )
    gallery = fx.gallery(spark, sf_dir)
    short = F.when(F.col("movie") == "movie_1", F.slice("embedding", 1, 32)).otherwise(F.col("embedding"))
    frames = fx.frames(spark, sf_dir)
    run = TaggingRun(spark, scratch(spark, "run"), Settings(model=MODEL, top_k=10))
    run.run(frames, gallery.withColumn("embedding", short), gallery, stubs.detector, stubs.wave_embedder, stubs.read_frame)
    return run.status(brands, frames)


@query
def configured_movies(spark, sf_dir):
    """Each movie under its own settings; the model of one is unknown, so that movie fails."""
    number = F.regexp_extract("movie", "([0-9]+)$", 1).cast("int")
    movies = fx.frames(spark, sf_dir).select("movie").distinct().withColumns({
        "frames_dir": F.concat(F.lit("/frames/"), "movie"),
        "embedding_model": F.when(number == 1, "unknown").otherwise(MODEL),
        "top_k": (number + 3).cast("int"),
        "similarity_threshold": F.when(number == 2, 0.1).otherwise(0.0),
    })
    absent = [c for c in CONFIG.fields if c.name not in movies.columns]
    configured = materialize(movies.select("*", *[F.lit(None).cast(c.dataType).alias(c.name) for c in absent]), "config")

    def listed(roots):
        return fx.frames(spark, sf_dir).join(roots.select("movie"), "movie", "left_semi")

    gallery = fx.gallery(spark, sf_dir)
    run = ConfiguredRun(spark, configured, scratch(spark, "configured"), listed)
    run.run(gallery, gallery, stubs.detector, {MODEL: stubs.wave_embedder}, stubs.read_frame)
    drawn = run.table("annotation_plan").groupBy("movie").agg(F.count("*").alias("drawn"))
    return run.status().join(drawn, "movie", "left").select("movie", "matches", "status", F.coalesce("drawn", F.lit(0)).alias("drawn"))


def _two_runs(spark, sf_dir, **settings):
    """A run over the first delivery of frames, and one over all frames."""
    folder = scratch(spark, "two-runs")
    first, second = (TaggingRun(spark, folder, Settings(model=MODEL, top_k=10, **settings)) for _ in range(2))
    first.detections(fx.first_frames(spark, sf_dir), stubs.detector)
    return first, second


@query
def lasting_face_ids(spark, sf_dir):
    """Ids after a second run with more frames: those of the first run are the same, new ones follow."""
    _, second = _two_runs(spark, sf_dir)
    faces = second.detections(fx.frames(spark, sf_dir), stubs.detector)
    return faces.select("face_id", "movie", "image_path", "det_no", *_six("x1", "y1", "x2", "y2", "confidence"))


@query
def frames_by_run(spark, sf_dir):
    """What the ledger says after two runs: which run showed which frames to the detector, those without faces too."""
    _, second = _two_runs(spark, sf_dir)
    second.detections(fx.frames(spark, sf_dir), stubs.detector)
    return second.ledger.seen().groupBy("batch", "movie").agg(
        F.count("*").alias("frames"), F.count_if(F.col("faces") == 0).alias("without_faces"), F.sum("faces").alias("faces")
    )


@query
def second_run_counts(spark, sf_dir):
    """The second run embeds the faces of new frames alone, and those that failed before."""
    first, second = _two_runs(spark, sf_dir)
    first.embeddings(stubs.size_embedder, stubs.read_some_frames)
    second.detections(fx.frames(spark, sf_dir), stubs.detector)
    stored = second.embeddings(stubs.size_embedder, stubs.read_some_frames)
    counts = {n: F.lit(second.embedding_counts[n]).cast("bigint").alias(n) for n in ("saved", "skipped", "errors")}
    return stored.groupBy("movie").agg(F.count("*").alias("faces"), F.count_distinct("face_id").alias("ids")).select("movie", "faces", "ids", *counts.values())


# Odd data


@query
def matches_with_odd_vectors(spark, sf_dir):
    """Some vectors are NULL, empty, or not finite: those faces match nobody."""
    face = F.col("face_id")
    broken = F.transform("embedding", lambda x, i: F.when(i == 3, F.lit(float("nan"))).otherwise(x))
    endless = F.transform("embedding", lambda x, i: F.when(i == 3, F.lit(float("-inf"))).otherwise(x))
    odd = (
        F.when(face % 7 == 1, F.lit(None)).when(face % 7 == 2, F.array()).when(face % 7 == 3, broken).when(face % 7 == 4, endless)
        .otherwise(F.col("embedding")).cast("array<float>")
    )
    faces = fx.faces(spark, sf_dir).withColumn("embedding", odd)
    return _match_rows(search.match_faces(faces, fx.gallery(spark, sf_dir), TOP_K))


@query
def matches_with_repeated_ordinals(spark, sf_dir):
    """Every movie counts its actors from 0, and one file stands in two movies."""
    gallery = fx.gallery(spark, sf_dir)
    own = gallery.withColumn("actor_ord", F.floor(F.col("actor_ord") / 3).cast("int"))
    again = own.where("movie = 'movie_0'").withColumn("movie", F.lit("movie_9"))
    found = search.match_faces(fx.faces(spark, sf_dir), own.unionByName(again), TOP_K)
    styled = annotate.with_actor_style(found, own.unionByName(again))
    return _match_rows(styled, "display_name")


@query
def annotation_of_odd_boxes(spark, sf_dir):
    """Boxes that no image can have are left out; those of other faces stay."""
    face = F.col("face_id")
    odd = F.when(face % 5 == 1, F.lit(1e12)).when(face % 5 == 2, F.lit(float("inf"))).when(face % 5 == 3, F.lit(None)).otherwise(F.col("face_x2"))
    plan = annotate.annotation_plan(_stored_matches(spark, sf_dir).withColumn("face_x2", odd), fx.gallery(spark, sf_dir), THRESHOLD)
    return plan.select("frame_image_path", "face_id", "label", *[F.col(c).cast("bigint").alias(c) for c in ("actor_ord", "rank", "x1", "x2")])


@query
def pending_embeddings_without_movie(spark, sf_dir):
    """A missing movie equals a missing movie: what is embedded is not taken up again."""
    movie = F.when(F.col("face_id") % 2 == 0, F.col("movie"))
    detections = fx.detections(spark, sf_dir).withColumn("movie", movie)
    done = fx.done(spark, sf_dir, MODEL).withColumn("movie", movie)
    return inference.pending_embeddings(detections, done, MODEL).select("movie", "face_id", "image_path")
