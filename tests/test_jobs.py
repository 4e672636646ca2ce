"""Batch jobs, drawing, and whole runs with stub models."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from castframe.operators import annotate, inference, render, summary
from castframe.plans.tagging import Settings, TaggingRun, movie_status, settings_of
from castframe.schema import CONFIG
from castframe.sinks import labelling
from castframe.sinks.tables import save_embeddings
from castframe.sources.images import rgb_pixels
from workload import stubs

DETECTION = "movie string, face_id long, image_path string, x1 double, y1 double, x2 double, y2 double, confidence double"


def frames(spark, count=30):
    return spark.range(count).select(
        F.lit("m").alias("movie"), F.concat(F.lit("/frames/m/shot_1/"), "id", F.lit(".jpg")).alias("path"), F.lit(10).cast("long").alias("length")
    )


def detections(spark, count=40, faces=4):
    rows = [("m", i, f"/frames/m/{i // faces}.jpg", 1.0, 2.0, 11.0 + i, 22.0, 0.5) for i in range(count)]
    return spark.createDataFrame(rows, DETECTION)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_frames_without_faces_give_no_row(spark):
    found = inference.detect(frames(spark), stubs.detector)
    assert found.count() == sum(i % 3 for i in range(30))
    assert found.where("image_path like '%/3.jpg'").count() == 0
    assert inference.detect(frames(spark), lambda: lambda batch: [[] for _ in range(len(batch))]).count() == 0


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_detection_does_not_depend_on_the_batch_size(spark, size):
    assert rows(inference.detect(frames(spark), stubs.detector, size)) == rows(inference.detect(frames(spark), stubs.detector))


def test_detector_sees_at_most_a_batch_and_is_made_once_per_task(spark):
    def factory():
        calls = []

        def detect(batch):
            calls.append(len(batch))
            assert len(batch) <= 4
            return [[(0, 0, 1, 1, len(calls))]] * len(batch)

        return detect

    found = inference.detect(frames(spark), factory, 4, tasks=1)
    assert found.agg(F.max("confidence")).first()[0] == 8  # 30 frames in one task


def test_detector_errors_fail_the_job(spark):
    with pytest.raises(Exception, match="0 results"):
        inference.detect(frames(spark), lambda: lambda batch: []).count()


def test_detector_errors_can_be_kept(spark):
    def factory():
        def detect(batch):
            if any(p.endswith("/7.jpg") for p in batch["path"]):
                raise RuntimeError("no")
            return stubs.detector()(batch)

        return detect

    out = inference.detect(frames(spark), factory, 5, tasks=1, keep_errors=True).cache()
    lost = out.where("error is not null")
    assert lost.count() == 5 and lost.where("x1 is not null or error <> 'RuntimeError: no'").count() == 0
    full = inference.detect(frames(spark), stubs.detector)
    kept = full.join(lost.select("image_path"), "image_path", "left_anti").select(*full.columns)
    assert rows(out.where("error is null").drop("error")) == rows(kept)


def test_embedding_of_rows_with_images(spark):
    images = spark.range(10).select(
        F.concat(F.lit("/frames/m/"), "id", F.lit(".jpg")).alias("image_path"),
        F.struct(
            F.lit("").alias("origin"), F.lit(4).alias("height"), F.lit(4).alias("width"), F.lit(1).alias("nChannels"),
            F.lit(0).alias("mode"), F.unhex(F.repeat(F.lpad(F.hex("id"), 2, "0"), 16)).alias("data"),
        ).alias("image"),
    )
    faces = detections(spark).withColumn("x1", F.lit(0.0)).withColumn("y1", F.lit(0.0))
    out = inference.embed(inference.attach_images(faces, images), lambda: lambda crops: [[c[0, 0, 0]] for c in crops], "m")
    assert all(r.embedding == [r.face_id // 4] for r in out.collect()) and out.count() == 40


def test_unreadable_image_is_one_error_row_each(spark):
    def read(path):
        if path.endswith("/3.jpg"):
            raise OSError("broken")
        return np.zeros((50, 60, 3), np.uint8)

    result = inference.embed(detections(spark), stubs.size_embedder, "m", read)
    assert result.where("status = 'error'").select("error").distinct().collect()[0][0] == "OSError: broken"
    assert result.groupBy("status").count().orderBy("status").collect() == [("error", 4), ("saved", 36)]
    assert result.where("status = 'error' and embedding is not null").count() == 0


def test_image_is_opened_once_per_task(spark, tmp_path):
    log = str(tmp_path / "opened")

    def read(path):
        with open(log, "a") as file:
            file.write(path + "\n")
        return np.zeros((50, 60, 3), np.uint8)

    inference.embed(detections(spark), stubs.size_embedder, "m", read, batch_size=3).count()
    opened = open(log).read().split()
    assert set(opened) == {f"/frames/m/{i}.jpg" for i in range(10)}
    assert len(opened) < 10 + 8  # the ends of the eight ranges
    (tmp_path / "opened").write_text("")
    inference.embed(detections(spark), stubs.size_embedder, "m", read, batch_size=3, tasks=1).count()
    assert len(open(log).read().split()) == 10


def test_many_faces_of_one_image_are_spread(spark):
    hot = spark.range(5000).select(
        F.lit("m").alias("movie"), F.col("id").alias("face_id"), F.lit("/frames/1.jpg").alias("image_path"),
        *[F.lit(float(v)).alias(c) for c, v in zip(("x1", "y1", "x2", "y2", "confidence"), (0, 0, 2, 2, 1))],
    )
    result = inference.embed(hot, stubs.size_embedder, "m", stubs.read_frame)
    parts = result.select(F.spark_partition_id().alias("p"), "face_id").groupBy("p").count().collect()
    assert len(parts) > 1 and sum(r["count"] for r in parts) == 5000


def test_failing_model_loses_one_crop_and_a_rerun_takes_it_up(spark):
    def picky():
        def embed(crops):
            if any(c.shape[1] == 15 for c in crops):  # the face with id 5
                raise RuntimeError("no")
            return [[1.0, 2.0]] * len(crops)

        return embed

    read = lambda path: np.zeros((50, 60, 3), np.uint8)
    faces = detections(spark)
    first = inference.embed(faces, picky, "m", read, batch_size=8, tasks=1).cache()
    failed = {r.face_id for r in first.where("status = 'error'").collect()}
    assert failed == {5}  # the others of its batch keep their vectors
    done = first.where("status = 'saved'")
    assert {r.face_id for r in inference.pending_embeddings(faces, done, "m").collect()} == failed
    assert inference.pending_embeddings(faces, done, "another").count() == 40
    run = inference.embedding_run(faces, done, "m", embedder_factory=stubs.size_embedder, read_image=read)
    assert inference.embedding_counters(run).first() == (1, 39, 0)


def test_wrong_number_of_vectors_is_an_error(spark):
    read = lambda path: np.zeros((50, 60, 3), np.uint8)
    result = inference.embed(detections(spark), lambda: lambda crops: [[1.0]], "m", read)
    assert result.where("status = 'saved'").count() <= result.where("error like '%1 vectors for%'").count()


def test_model_key_keeps_the_model_in_the_worker(spark):
    assert inference._model(lambda: object(), "k") is inference._model(lambda: object(), "k")
    assert inference._model(lambda: object(), None) is not inference._model(lambda: object(), None)


def image(channels):
    data = bytes(range(2 * 2 * channels))
    return {"height": 2, "width": 2, "nChannels": channels, "data": data}


def test_pixels_become_rgb():
    assert rgb_pixels(image(1)).tolist() == [[[0] * 3, [1] * 3], [[2] * 3, [3] * 3]]
    assert rgb_pixels(image(3))[0, 0].tolist() == [2, 1, 0]
    assert rgb_pixels(image(4))[0, 0].tolist() == [2, 1, 0, 3]
    with pytest.raises(ValueError):
        rgb_pixels({"height": -1})


MATCH = (
    "actor_ord int, rank long, similarity_score double, frame_image_path string, face_x1 double, face_y1 double, "
    "face_x2 double, face_y2 double, face_confidence double, face_id long, actor_name string, actor_embedding_path string"
)
ACTORS = "embedding_path string, display_name string, color struct<r:int,g:int,b:int>, text_color string"


def match(ord_, rank, score, path, box=(1.0, 30.0, 9.0, 40.0), face=0):
    return (ord_, rank, score, path, *box, 0.9, face, f"a{ord_}", f"/g/a{ord_}.pkl")


@pytest.fixture(scope="module")
def actors(spark):
    return spark.createDataFrame([("/g/a0.pkl", "Ann", (1, 2, 3), "white"), ("/g/a1.pkl", None, None, None)], ACTORS)


def test_threshold(spark):
    frame = spark.createDataFrame([match(0, i + 1, s, "/x") for i, s in enumerate((0.7, 0.5, 0.4999, 0.0, -0.2))], MATCH)
    assert annotate.above_threshold(frame, 0.0).count() == 5
    kept = annotate.above_threshold(frame, 0.5)
    assert sorted(r["rank"] for r in kept.collect()) == [1, 2]


def test_plan_defaults_order_and_missing_corners(spark, actors):
    frame = spark.createDataFrame(
        [
            match(0, 2, 0.5, "/d/shot_1/f.jpg", (10.9, 12.2, 20.0, 30.0)),
            match(1, 1, 0.25, "/d/shot_1/f.jpg", (-0.9, 100.0, 20.0, 30.0)),
            match(1, 2, 0.25, "/d/shot_1/f.jpg", (None, 100.0, 20.0, 30.0)),
            match(1, 3, 0.25, "/d/shot_1/f.jpg", (float("nan"), 100.0, 20.0, 30.0)),
            match(1, 4, 0.25, None),
        ],
        MATCH,
    )
    first, second = annotate.annotation_plan(frame, actors).orderBy("actor_ord", "rank").collect()
    assert (first.label, first.x1, first.text_y, first.back_x2, first.back_y2) == ("Ann (0.500)", 10, 5, 210, 25)
    assert tuple(first.color) == (1, 2, 3) and first.text_color == "white" and first["rank"] == 2
    assert (second.label, second.x1, second.text_y) == ("a1 (0.250)", 0, 75)
    assert tuple(second.color) == (255, 255, 0) and second.text_color == "black"
    assert first.save_path == "shot_1/f.jpg"


def test_annotatable_images(spark):
    frame = spark.createDataFrame([match(0, i, 0.5, p) for i, p in enumerate(("/a", "/a", "/b", "/c", None))], MATCH)
    listing = spark.createDataFrame([("/a", 52428800), ("/b", 52428801)], "path string, length long")
    assert rows(annotate.annotatable_images(frame, listing).select("frame_image_path", "status")) == [
        ("/a", "ok"), ("/b", "too_large"), ("/c", "missing"),
    ]


def plan_of(spark, actors, matches):
    return annotate.annotation_plan(spark.createDataFrame(matches, MATCH), actors)


def test_render_draws_later_boxes_on_top(spark, actors):
    plan = plan_of(spark, actors, [match(1, 1, 0.5, "/a", (0.0, 0.0, 9.0, 9.0)), match(0, 9, 0.5, "/a", (0.0, 0.0, 9.0, 9.0))])
    out = render.render(plan, lambda path: np.zeros((12, 12, 3), np.uint8), keep_pixels=True).first()
    pixels = np.frombuffer(out.pixels, np.uint8).reshape(out.height, out.width, out.channels)
    assert (out.status, out.faces_drawn) == ("processed", 2)
    assert pixels[0, 0].tolist() == [255, 255, 0] and pixels[5, 5].tolist() == [0, 0, 0] and pixels[11, 11].tolist() == [0, 0, 0]


def test_topmost_boxes_do_not_change_the_picture(spark, actors):
    rng = np.random.default_rng(5)
    matches = []
    for i in range(60):
        x, y = (float(v) for v in rng.integers(0, 6, 2))
        matches.append(match(i % 2, i, 0.5, f"/{i % 3}", (x, y, x + 3 + i % 4, y + 5), i))
    plan = plan_of(spark, actors, matches)
    read = lambda path: np.zeros((16, 16, 3), np.uint8)
    pre = render.render(plan, read, keep_pixels=True)
    full = render.render(plan, read, renderer_factory=render.outline_renderer, keep_pixels=True)
    assert rows(pre) == rows(full) and pre.count() == 3


@pytest.mark.parametrize("tasks", [1, None])
def test_render_errors_skips_and_counters(spark, actors, tmp_path, tasks):
    def read(path):
        if path == "/bad":
            raise OSError("broken")
        return np.zeros((50, 50, 3), np.uint8)

    def write(path, pixels):
        if path == "full":
            raise OSError("disk")
        (tmp_path / path).write_bytes(pixels.tobytes())

    found = [match(0, i, 0.5, p) for i, p in enumerate(("/ok", "/ok", "/bad", "/big", "/none", "/full"))]
    found.append(match(0, 9, 0.5, "/ok", (9.0, 9.0, 1.0, 1.0)))  # no area: left out
    found.append(match(0, 10, 0.5, "/bare", (None, 1.0, 2.0, 2.0)))  # handed on without a box
    frame = spark.createDataFrame(found, MATCH)
    listing = spark.createDataFrame(
        [("/ok", 1), ("/bad", 1), ("/full", 1), ("/bare", 1), ("/big", 52428801)], "path string, length long"
    )
    usable = annotate.annotatable_images(frame, listing)
    out = render.render(annotate.annotation_plan(frame, actors), read, write_image=write, usable=usable, tasks=tasks).cache()
    assert rows(out.select("frame_image_path", "status", "error", "faces_drawn")) == [
        ("/bad", "error", "OSError: broken", 0),
        ("/bare", "processed", None, 0),
        ("/big", "skipped", "too_large", 0),
        ("/full", "error", "OSError: disk", 0),
        ("/none", "skipped", "missing", 0),
        ("/ok", "processed", None, 2),
    ]
    assert render.annotation_counters(out).first() == (2, 2, 2, 2)
    assert (tmp_path / "ok").stat().st_size == 7500


def test_nothing_left_to_draw(spark, actors):
    plan = annotate.annotation_plan(spark.createDataFrame([match(0, 1, 0.1, "/a")], MATCH), actors, 0.9)
    out = render.render(plan, stubs.blank_frame)
    assert out.isEmpty()
    assert render.annotation_counters(out).first() == (0, 0, 0, 0)


@pytest.mark.parametrize("n", [50, 10_000, 10_001])
def test_samples_have_one_shape_at_every_size(spark, n):
    boxes = spark.range(n).select(F.lit(0).alias("actor_ord"), (F.col("id") + 1).alias("rank"), F.col("id").alias("face_id"))
    found = spark.createDataFrame([match(0, 99, 0.5, "/one", face=n)], MATCH)
    hot = found.drop("actor_ord", "rank", "face_id").withColumn("frame_image_path", F.lit("/hot")).join(F.broadcast(boxes), F.lit(True))
    sizes = [("/hot", 100, 50), ("/one", 100, 50), ("/flat", 100, 0)]
    dims = spark.createDataFrame(sizes, "image_path string, width int, height int")
    samples = labelling.labelling_samples(found.unionByName(hot), dims)
    assert {r.filepath: r.boxes for r in labelling.sample_images(samples).collect()} == {"/hot": n, "/one": 1}
    assert samples.where("filepath = '/one'").first().bounding_box == [0.01, 0.6, 0.08, 0.2]


def test_summary_of_nothing(spark):
    none = spark.createDataFrame([], "path string")
    assert summary.detection_summary(none, none).first() == (0, 0, None)
    assert summary.actor_summary(spark.createDataFrame([], MATCH)).count() == 0


def test_ranges_keep_the_files_by_movie_few(spark, tmp_path):
    rows_ = spark.range(8000).select(
        F.concat(F.lit("m"), F.when(F.col("id") < 3000, 0).otherwise(F.col("id") % 40)).alias("movie"), F.col("id").alias("face_id"),
        F.concat(F.lit("/frames/"), F.floor(F.col("id") / 4).cast("long"), F.lit(".jpg")).alias("image_path"),
        *[F.lit(float(v)).alias(c) for c, v in zip(("x1", "y1", "x2", "y2", "confidence"), (0, 0, 2, 2, 1))],
    )
    out = inference.embed(rows_, stubs.size_embedder, "m", stubs.read_frame)
    save_embeddings(out, str(tmp_path / "e"))
    assert len(list((tmp_path / "e").glob("movie=*/*.parquet"))) <= 40 + 8
    assert spark.read.parquet(str(tmp_path / "e")).count() == 8000


def test_settings_from_configuration(spark):
    empty = {f: None for f in CONFIG.fieldNames()}
    row = spark.createDataFrame([Row(**{**empty, "movie": "m", "embedding_model": "a", "top_k": 5, "skip_actor_search": True})], CONFIG).first()
    assert settings_of(row) == Settings(model="a", top_k=5, skip_search=True)


GALLERY = "movie string, actor_ord int, embedding_path string, embedding array<float>"


def gallery(spark):
    rng = np.random.default_rng(1)
    return spark.createDataFrame([("m", i, f"/g/a{i}.pkl", rng.normal(size=64).tolist()) for i in range(2)], GALLERY)


def style(spark):
    return spark.createDataFrame([("m", "/g/a0.pkl", "Ann", None, None), ("m", "/g/a1.pkl", None, None, None)], "movie string, " + ACTORS)


def models():
    return stubs.detector, stubs.wave_embedder, stubs.read_frame


def test_run_resume_and_skip_flags(spark, tmp_path):
    folder = str(tmp_path / "run")
    first = TaggingRun(spark, folder, Settings(model="w")).run(frames(spark), gallery(spark), style(spark), *models())
    assert first.embedding_counts == {"saved": 30, "errors": 0, "skipped": 0}
    plan = rows(first.table("annotation_plan"))
    assert len(plan) == 60

    again = TaggingRun(spark, folder, Settings(model="w")).run(frames(spark), gallery(spark), style(spark), *models())
    assert again.embedding_counts == {"saved": 0, "errors": 0, "skipped": 30}
    assert rows(again.table("annotation_plan")) == plan

    def never():
        raise AssertionError("a skipped stage ran")

    reuse = Settings(model="w", skip_detection=True, skip_embedding=True, threshold=0.05)
    third = TaggingRun(spark, folder, reuse).run(frames(spark), gallery(spark), style(spark), never, never, never)
    assert 0 < third.table("annotation_plan").count() < 60
    skip = Settings(model="w", skip_search=True, skip_annotation=True, skip_detection=True, skip_embedding=True)
    assert rows(TaggingRun(spark, folder, skip).run(frames(spark), gallery(spark), style(spark), never, never, never).table("matches")) == rows(third.table("matches"))


def test_skipped_search_without_result_raises(spark, tmp_path):
    run = TaggingRun(spark, str(tmp_path / "run"), Settings(model="w", skip_search=True))
    with pytest.raises(FileNotFoundError, match="matches"):
        run.run(frames(spark, 3), gallery(spark), style(spark), *models())


def test_run_without_faces_stays_empty(spark, tmp_path):
    nothing = lambda: lambda batch: [[] for _ in range(len(batch))]
    run = TaggingRun(spark, str(tmp_path / "run"), Settings(model="w"))
    run.run(frames(spark), gallery(spark), style(spark), nothing, *models()[1:])
    assert [run.table(n).count() for n in ("detections", "embeddings", "matches", "annotation_plan")] == [0] * 4


def without_ids(matches):
    return rows(matches.drop("face_id"))


def test_new_detections_leave_no_stale_faces(spark, tmp_path):
    folder = str(tmp_path / "run")
    TaggingRun(spark, folder, Settings(model="w")).run(frames(spark, 30), gallery(spark), style(spark), *models())
    grown = TaggingRun(spark, folder, Settings(model="w")).run(frames(spark, 45), gallery(spark), style(spark), *models())
    fresh = TaggingRun(spark, str(tmp_path / "fresh"), Settings(model="w")).run(frames(spark, 45), gallery(spark), style(spark), *models())
    # Ids last: the faces of the first run keep theirs, the new ones come after them.
    assert without_ids(grown.table("matches")) == without_ids(fresh.table("matches"))
    # Also when a later run finds them.
    shrunk = TaggingRun(spark, folder, Settings(model="w", skip_search=True, skip_annotation=True, skip_embedding=True))
    shrunk.run(frames(spark, 12), gallery(spark), style(spark), *models())
    last = TaggingRun(spark, folder, Settings(model="w", skip_detection=True))
    last.run(frames(spark, 12), gallery(spark), style(spark), *models())
    small = TaggingRun(spark, str(tmp_path / "small"), Settings(model="w")).run(frames(spark, 12), gallery(spark), style(spark), *models())
    assert without_ids(last.table("matches")) == without_ids(small.table("matches"))


def test_other_boxes_with_the_same_ids_are_embedded_again(spark, tmp_path):
    def shifted():
        def detect(batch):
            return [[(x1 + 5, y1, x2 + 5, y2, c) for x1, y1, x2, y2, c in faces] for faces in stubs.detector()(batch)]

        return detect

    run = lambda detector: TaggingRun(spark, str(tmp_path / "run"), Settings(model="w", detector=detector.__name__)).run(
        frames(spark), gallery(spark), style(spark), detector, *models()[1:]
    )
    run(stubs.detector)
    second = run(shifted)
    assert second.embedding_counts == {"saved": 30, "errors": 0, "skipped": 0}
    assert second.table("matches").count() == 60 and second.table("matches").where("face_x1 < 5").count() == 0


def test_failed_faces_are_retried(spark, tmp_path):
    folder = str(tmp_path / "run")

    def broken(path):
        if path.endswith("/5.jpg"):
            raise OSError("broken")
        return stubs.read_frame(path)

    run = TaggingRun(spark, folder, Settings(model="w"))
    run.run(frames(spark), gallery(spark), style(spark), stubs.detector, stubs.wave_embedder, broken)
    assert run.embedding_counts == {"saved": 28, "errors": 2, "skipped": 0}
    again = TaggingRun(spark, folder, Settings(model="w", skip_detection=True))
    again.run(frames(spark), gallery(spark), style(spark), *models())
    assert again.embedding_counts == {"saved": 2, "errors": 0, "skipped": 28}
    assert again.table("matches").count() == 60


def test_movies_fail_apart_and_images_are_drawn(spark, tmp_path):
    two = frames(spark).unionByName(
        spark.range(1000, 1009).select(F.lit("bad").alias("movie"), F.concat(F.lit("/frames/bad/shot_1/"), "id", F.lit(".jpg")).alias("path"), F.lit(10).cast("long").alias("length"))
    )

    def picky():
        def detect(batch):
            if any("/bad/" in p for p in batch["path"]):
                raise RuntimeError("no")
            return stubs.detector()(batch)

        return detect

    def write(path, pixels):
        Path(path).write_bytes(pixels[:1].tobytes())

    run = TaggingRun(spark, str(tmp_path / "run"), Settings(model="w", detection_batch=1))
    run.run(two, gallery(spark), style(spark), picky, stubs.wave_embedder, stubs.read_frame, write)
    movies = spark.createDataFrame([("m",), ("bad",), ("none",)], "movie string")
    status = movie_status(movies, two, run.table("matches"), run.table("detection_errors"))
    assert rows(status) == [("bad", 9, 0, "failed"), ("m", 30, 60, "success"), ("none", 0, 0, "skipped")]
    drawn = run.table("annotated_images")
    assert render.annotation_counters(drawn).first() == (20, 0, 0, 60)
    files = run.image_files().select("save_path", "file").collect()
    assert len({r.save_path for r in files}) == 20 and all(r.file.endswith("/" + r.save_path) and Path(r.file).stat().st_size == 3840 for r in files)
