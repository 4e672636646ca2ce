"""The whole run, from frames to the annotation plan, over stored stage tables.

Every table has the movie as a column, so one run serves any number of movies:
each stage is one job over all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import MISSING, dataclass, fields
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from castframe.functions.boxes import CORNERS
from castframe.functions.paths import shot_relative_path
from castframe.operators.annotate import above_threshold, annotatable_images, annotation_plan
from castframe.operators.inference import detect, embed, pending_embeddings
from castframe.operators.render import render
from castframe.operators.search import match_faces, merge_matches
from castframe.schema import DETECTION_BATCH, EMBEDDING_BATCH, SIMILARITY_THRESHOLD, STAGES
from castframe.session import materialize
from castframe.sinks.batches import DetectionLedger
from castframe.sinks.images import draw_images, published_images
from castframe.sinks.tables import save_embeddings, save_matches
from castframe.sources.frames import image_frames
from castframe.sources.tables import embedding_load_report, readable_embeddings


@dataclass(frozen=True)
class Settings:
    """What a run needs besides its inputs. ``top_k`` None keeps every face.

    ``detector`` names the detector: frames that it has seen are not shown to it again.
    """

    model: str
    top_k: int | None = None
    threshold: float = SIMILARITY_THRESHOLD
    detection_batch: int = DETECTION_BATCH
    embedding_batch: int = EMBEDDING_BATCH
    skip_detection: bool = False
    skip_embedding: bool = False
    skip_search: bool = False
    skip_annotation: bool = False
    detector: str = "detector"


# The settings in the configuration table, and their names here.
SETTING_COLUMNS = {
    "embedding_model": "model", "top_k": "top_k", "similarity_threshold": "threshold",
    "face_detection_batch_size": "detection_batch", "embedding_batch_size": "embedding_batch",
    "skip_face_detection": "skip_detection", "skip_embedding_generation": "skip_embedding",
    "skip_actor_search": "skip_search", "skip_image_generation": "skip_annotation",
}
_TYPES = {"model": "string", "top_k": "int", "threshold": "double", "detection_batch": "int", "embedding_batch": "int", "detector": "string"}


def settings_of(movie: Row) -> Settings:
    """The settings in one row of the configuration table; absent values take the defaults."""
    return Settings(**{own: movie[name] for name, own in SETTING_COLUMNS.items() if movie[name] is not None})


def settings_table(config: DataFrame) -> DataFrame:
    """(movie, settings) of a configuration table, with a default where a value is absent; a movie has one row."""
    defaults = {f.name: None if f.default is MISSING else f.default for f in fields(Settings)}
    columns = {own: F.col(name) for name, own in SETTING_COLUMNS.items()}
    values = [F.coalesce(columns.get(n, F.lit(None)), F.lit(d)).cast(_TYPES.get(n, "boolean")).alias(n) for n, d in defaults.items()]
    return config.select("movie", *values).dropDuplicates(["movie"])


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished table lies at ``path``."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


class TaggingRun:
    """The stages of a run and the folder that holds their tables.

    ``settings`` hold for all movies, or are a table with a row for each (see
    ``settings_table``): they then stand beside the rows as columns, and every stage is
    one job over all movies, whatever the number of settings. Movies without a row
    take no part.

    A later run goes on where an earlier one ended: only frames that the detector has
    not seen are detected, faces keep their ids, and only new faces are embedded.

    For detection and embedding a skip flag reuses what is stored if there is
    any, else the stage runs. For search and annotation it skips outright and what is
    stored stays; a later stage that then lacks its input raises.
    """

    def __init__(self, spark: SparkSession, folder: str, settings: Settings | DataFrame):
        self.spark = spark
        self.settings = settings if isinstance(settings, Settings) else materialize(settings, "settings")
        folder = folder.rstrip("/")
        self.paths = {name: f"{folder}/{name}" for name in (*STAGES, "images")}
        self.ledger = DetectionLedger(spark, folder)
        self.embedding_counts: dict[str, int] = {}

    def _has(self, name: str) -> bool:
        return table_exists(self.spark, self.paths[name])

    def _table(self, name: str) -> DataFrame:
        if not self._has("current_frames" if name == "detections" else name):
            raise FileNotFoundError(f"the {name} table is missing: {self.paths[name]}")
        if name == "detections":
            return self.ledger.current(self._table("current_frames"))
        return self.spark.read.schema(STAGES[name]).parquet(self.paths[name])

    def _with(self, rows: DataFrame, *names: str) -> DataFrame:
        """Rows with the settings of their movie, each in a column with an underscore before its name."""
        if isinstance(self.settings, Settings):
            return rows.withColumns({f"_{n}": F.lit(getattr(self.settings, n)).cast(_TYPES.get(n, "boolean")) for n in names})
        own = self.settings.select(F.col("movie").alias("_movie"), *[F.col(n).alias(f"_{n}") for n in names])
        return rows.join(own, F.col("movie").eqNullSafe(F.col("_movie"))).drop("_movie")

    def _any(self, flag: str) -> bool:
        if isinstance(self.settings, Settings):
            return getattr(self.settings, flag)
        return not self.settings.where(flag).isEmpty()

    def _all(self, flag: str) -> bool:
        return self._any(flag) and (isinstance(self.settings, Settings) or self.settings.where(~F.col(flag)).isEmpty())

    def _kept(self, name: str, flag: str) -> list[DataFrame]:
        """The stored rows of the movies that skip a stage, before the others are written over."""
        if not (self._any(flag) and self._has(name)):
            return []
        own = self._with(self._table(name), flag).where(f"_{flag}").select(*STAGES[name].fieldNames())
        return [materialize(own, f"kept-{name}")]

    def detections(self, frames: DataFrame, detector_factory: Callable[[], Any]) -> DataFrame:
        """Detects in the frames that the ledger lacks. Frames that failed are not in it, so the next run retries them."""
        if not frames.where("movie is null").isEmpty():
            raise ValueError("every frame needs a movie")
        kept = self._kept("current_frames", "skip_detection")
        if not (kept and self._all("skip_detection")):
            listed = self._with(image_frames(frames), "detector", "detection_batch").withColumnRenamed("_detector", "detector")
            if kept:
                listed = listed.join(kept[0].select("movie").distinct(), "movie", "left_anti")
            compared = materialize(self.ledger.compared(listed), "compared")
            fresh = compared.where("batch is null").drop("batch")
            current = compared.where("batch is not null").select("movie", "path", "batch")
            if fresh.isEmpty():
                failed = self.spark.createDataFrame([], STAGES["detection_errors"])
            else:
                failed, added = self._detect(fresh, detector_factory)
                current = current.unionByName(added)
            # What is kept of the table that is written over was copied before.
            reduce(DataFrame.unionByName, kept, current).write.mode("overwrite").parquet(self.paths["current_frames"])
            failed.write.mode("overwrite").parquet(self.paths["detection_errors"])
        return self._table("detections")

    def _detect(self, fresh: DataFrame, detector_factory: Callable[[], Any]) -> tuple[DataFrame, DataFrame]:
        """Show new frames to the detector and add them to the ledger. Returns those it failed on, and (movie, path, batch) of the others."""
        sized = self._with(fresh, "detection_batch")
        found = detect(sized, detector_factory, "_detection_batch", keep_errors=True)
        # Numbering sorts, and a sort samples its input first: detect once.
        found = materialize(found, "found")
        failed = found.where("error is not null").select(*STAGES["detection_errors"].fieldNames())
        lost = failed.select(F.col("movie").alias("_movie"), F.col("image_path").alias("_path")).distinct()
        seen = fresh.join(lost, (F.col("path") == F.col("_path")) & (F.col("movie") == F.col("_movie")), "left_anti")
        batch = self.ledger.add(seen, found.where("error is null").drop("error"))
        # No earlier batch has them, so all have this one: the listing need not be compared again.
        return failed, self.ledger.frames.read([batch]).select("movie", "path", "batch")

    def embeddings(
        self, embedder_factory: Callable[[], Any] | Mapping[str, Callable[[], Any]], read_image: Callable[[str], Any]
    ) -> DataFrame:
        """Embeds what is missing. Failed faces are not stored, so the next run retries them.

        With settings by movie the factories are given by model; movies whose model
        has none go to ``embedding_errors``.
        """
        exists = self._has("embeddings")
        if not (exists and self._all("skip_embedding")):
            factories = embedder_factory if isinstance(embedder_factory, Mapping) else {self._model(): embedder_factory}
            detections = self._with(self._table("detections"), "model", "embedding_batch", "skip_embedding").withColumnRenamed("_model", "model")
            unknown = ~F.col("model").isin(list(factories)) | F.col("model").isNull()
            refused = detections.where(unknown).groupBy("movie", "model").agg(F.count("*").alias("n"))
            error = F.format_string("no embedder for model %s", "model").alias("error")
            refused.select("movie", error).write.mode("overwrite").parquet(self.paths["embedding_errors"])
            todo = detections.where(~unknown)
            total = todo.count()
            if exists:
                done = self._table("embeddings")
                if self._any("skip_embedding"):
                    stored = done.select(F.col("movie").alias("_m")).distinct()
                    todo = todo.join(stored, F.col("_skip_embedding") & F.col("movie").eqNullSafe(F.col("_m")), "left_anti")
                todo = pending_embeddings(todo, done.drop("batch"))
            fresh = embed(todo, factories, None, read_image, "_embedding_batch")
            counted = Observation()
            statuses = [F.count_if(F.col("status") == s).alias(n) for s, n in (("saved", "saved"), ("error", "errors"))]
            saved = fresh.observe(counted, *statuses).where("status = 'saved'").withColumn("batch", F.lit(self._last_batch() + 1))
            save_embeddings(saved, self.paths["embeddings"], by=("movie", "batch"))
            counts = counted.get
            self.embedding_counts = {**counts, "skipped": total - sum(counts.values())}
        stored = readable_embeddings(self._own_model(self._table("embeddings")))
        return self._without_stale(stored) if exists else stored

    def _last_batch(self) -> int:
        """The last batch of embeddings, -1 without any. A listing of folders; no data is read."""
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths["embeddings"] + "/movie=*/batch=*")
        found = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
        return max((int(s.getPath().getName().partition("=")[2]) for s in found), default=-1)

    def _model(self) -> str:
        if not isinstance(self.settings, Settings):
            raise ValueError("settings by movie need a factory for each model")
        return self.settings.model

    def _own_model(self, embeddings: DataFrame) -> DataFrame:
        """The vectors that the movie's model made."""
        if isinstance(self.settings, Settings):
            return embeddings.where(F.col("model") == self.settings.model)
        return self._with(embeddings, "model").where(F.col("model") == F.col("_model")).drop("_model")

    def load_report(self) -> DataFrame:
        """How many stored embeddings the search can read, and how many it leaves out."""
        return embedding_load_report(self._own_model(self._table("embeddings")))

    def _without_stale(self, stored: DataFrame) -> DataFrame:
        """Leave out faces that the detections no longer have, after a new detection run.

        Only the keys are compared first; the vectors are joined only if some are stale.
        """
        on = ["movie", "face_id", "image_path", "bbox"]
        box = F.struct(*CORNERS).alias("bbox")
        keys = self._table("detections").select("movie", "face_id", "image_path", box)
        if stored.select(*on).join(keys, on, "left_anti").isEmpty():
            return stored
        return stored.join(keys, on, "left_semi")

    def matches(self, embeddings: DataFrame, gallery: DataFrame) -> None:
        """Movies whose vectors differ in length go to ``search_errors``; the others go on."""
        if self._all("skip_search"):
            return
        kept = self._kept("matches", "skip_search")
        gallery = self._with(gallery, "top_k", "model", "skip_search").where("not _skip_search").drop("_skip_search")
        length = F.size("embedding")
        lengths = [
            side.groupBy("movie").agg(F.min(length).alias(f"low_{name}"), F.max(length).alias(f"high_{name}"))
            for side, name in ((gallery, "gallery"), (embeddings, "faces"))
        ]
        shown = [F.concat_ws(" to ", f"low_{name}", f"high_{name}") for name in ("gallery", "faces")]
        failed = lengths[0].join(lengths[1], "movie").where(
            "low_gallery <> high_gallery or low_faces <> high_faces or low_gallery <> low_faces"
        ).select("movie", F.format_string("gallery vectors have %s elements, faces %s", *shown).alias("error"))
        failed.write.mode("overwrite").parquet(self.paths["search_errors"])
        names = self._table("search_errors").select("movie")
        usable = gallery.join(names, "movie", "left_anti")

        entry = F.xxhash64("actor_ord", "embedding_path", "embedding").cast("decimal(38,0)")
        state = usable.groupBy("movie").agg(
            F.max("_model").alias("model"), F.max("_top_k").alias("top_k"), F.xxhash64(F.sum(entry), F.count("*")).alias("gallery")
        )
        state = materialize(state, "search-state")
        known = self._known_searches(state)
        faces = embeddings
        if known is not None:
            first = known.agg(F.min("last"), F.count("*")).first()
            if first[1] == state.count():
                faces = faces.where(F.col("batch") > first[0])  # prunes the folders of earlier batches
            own = known.select(F.col("movie").alias("_movie"), "last")
            faces = faces.join(own, F.col("movie") == F.col("_movie"), "left").where("last is null or batch > last").drop("_movie", "last")
        k = self.settings.top_k if isinstance(self.settings, Settings) else "_top_k"
        found = match_faces(faces.drop("batch"), usable, k, within="movie")
        if known is not None:
            stored = self._table("matches").join(known.select("movie"), "movie", "left_semi").select(*found.columns)
            limited = [self._with(side, "top_k") for side in (stored, found)]
            merged = merge_matches(*[side.where("_top_k is not null") for side in limited], "_top_k", within="movie").drop("_top_k")
            found = materialize(merged.unionByName(limited[1].where("_top_k is null").drop("_top_k")), "merged")
        save_matches(reduce(DataFrame.unionByName, kept, found), self.paths["matches"], by=("movie", "actor_name"))
        state.withColumn("batch", F.lit(self._last_batch()).cast("long")).write.mode("overwrite").parquet(self.paths["search_state"])

    def _known_searches(self, state: DataFrame) -> DataFrame | None:
        """(movie, last) of movies whose stored best matches can be kept up to date with the faces of batches after ``last``.

        They were searched with the same model, limit and gallery, and the faces that they
        matched are still there. None without such movies.
        """
        if not (self._has("search_state") and self._has("matches")):
            return None
        before = self._table("search_state").select(*[F.col(c).alias(f"_{c}") for c in ("movie", "model", "top_k", "gallery")], F.col("batch").alias("last"))
        alike = [F.col(c) == F.col(f"_{c}") for c in ("movie", "model", "top_k", "gallery")]  # without a limit nothing is alike
        same = state.join(before, reduce(lambda a, b: a & b, alike)).select("movie", "last")
        keys = self._table("detections").select("movie", "face_id", F.col("image_path").alias("frame_image_path"))
        gone = self._table("matches").join(keys, ["movie", "face_id", "frame_image_path"], "left_anti").select("movie").distinct()
        same = materialize(same.join(gone, "movie", "left_anti"), "known-searches")
        return None if same.isEmpty() else same

    def annotations(self, actors: DataFrame) -> None:
        if self._all("skip_annotation"):
            return
        kept = self._kept("annotation_plan", "skip_annotation")
        matches = self._with(self._table("matches"), "threshold", "skip_annotation").where("not _skip_annotation")
        plan = annotation_plan(matches, actors, F.col("_threshold"), within="movie")
        reduce(DataFrame.unionByName, kept, plan).write.mode("overwrite").parquet(self.paths["annotation_plan"])

    def draw(
        self,
        listing: DataFrame,
        read_image: Callable[[str], Any],
        write_image: Callable[[str, Any], None],
        renderer_factory: Callable[[], Any] | None = None,
    ) -> None:
        """Draw the plan on the frames. Each movie has a folder of its own.

        ``write_image(path, pixels)`` stores an image. The images are published by a
        manifest when all are drawn, so that tasks may run twice or fail meanwhile; those of an
        earlier run are replaced as a whole. ``image_files`` tells where they are.
        """
        if self._all("skip_annotation"):
            return
        matches = self._with(self._table("matches"), "threshold", "skip_annotation").where("not _skip_annotation")
        usable = annotatable_images(above_threshold(matches, F.col("_threshold")), listing, ("movie",)).withColumn(
            "save_path", F.concat_ws("/", "movie", shot_relative_path(F.col("frame_image_path")))
        )
        usable = materialize(usable, "usable")
        plan = self._table("annotation_plan")
        draw_images(
            lambda store: render(plan, read_image, renderer_factory, usable=usable, store_factory=store), self.paths["images"], write_image
        )
        rows = published_images(self.spark, self.paths["images"]).select(*STAGES["annotated_images"].fieldNames())
        rows.write.mode("overwrite").parquet(self.paths["annotated_images"])

    def image_files(self) -> DataFrame:
        """The published images: their path in the movie's folder, and the file that holds them."""
        return published_images(self.spark, self.paths["images"])

    def run(
        self,
        frames: DataFrame,
        gallery: DataFrame,
        actors: DataFrame,
        detector_factory: Callable[[], Any],
        embedder_factory: Callable[[], Any] | Mapping[str, Callable[[], Any]],
        read_image: Callable[[str], Any],
        write_image: Callable[[str, Any], None] | None = None,
        renderer_factory: Callable[[], Any] | None = None,
    ) -> "TaggingRun":
        """All stages in order. Images are drawn if ``write_image`` stores them."""
        self.detections(frames, detector_factory)
        self.matches(self.embeddings(embedder_factory, read_image), gallery)
        self.annotations(actors)
        if write_image is not None:
            self.draw(frames, read_image, write_image, renderer_factory)
        return self

    def table(self, name: str) -> DataFrame:
        return self._table(name)

    def errors(self) -> DataFrame:
        """(movie, error) of every stage that has run."""
        found = [self._table(n).select("movie", "error") for n in ("detection_errors", "embedding_errors", "search_errors") if self._has(n)]
        return reduce(DataFrame.unionByName, found, self.spark.createDataFrame([], STAGES["search_errors"]))

    def status(self, movies: DataFrame, frames: DataFrame) -> DataFrame:
        """How the run went for each configured movie, from its stage tables."""
        return movie_status(movies, frames, self._table("matches"), self.errors())


def movie_status(
    movies: DataFrame, frames: DataFrame, matches: DataFrame, errors: DataFrame | None = None
) -> DataFrame:
    """One row per configured movie: its frames, its matches, and how it went.

    A movie without frames is skipped. One with ``errors``, such as frames that
    the detector or vectors that the search could not take, has failed; the
    others go on.
    """
    listed = image_frames(frames).groupBy("movie").agg(F.count("*").alias("frames"))
    matched = matches.groupBy("movie").agg(F.count("*").alias("matches"))
    outcome = movies.select("movie").distinct().join(listed, "movie", "left").join(matched, "movie", "left")
    status = F.when(F.col("frames").isNull(), "skipped")
    if errors is not None:
        outcome = outcome.join(errors.groupBy("movie").agg(F.count("*").alias("errors")), "movie", "left")
        status = status.when(F.col("errors") > 0, "failed")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("frames", "matches")]
    return outcome.select("movie", *counts, status.otherwise("success").alias("status"))
