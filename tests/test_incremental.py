"""Later runs: lasting ids, frames that are detected once, settings by movie, and images that a job commits."""

import json
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In

from castframe.operators import numbering, search
from castframe.operators.states import new_states, summary_states, united_summary
from castframe.operators.summary import actor_summary
from castframe.plans.configured import ConfiguredRun
from castframe.plans.tagging import Settings, TaggingRun, settings_table
from castframe.schema import CONFIG, RENDERED, STAGES
from castframe.sinks.batches import BatchedTable
from castframe.sinks.images import published_images, write_images
from castframe.sinks.tables import save_bucketed
from castframe.sources.frames import walk_frames
from castframe.sources.listing import FrameReader, folder_listing, listed_frames
from castframe.sources.tables import with_embeddings
from workload import stubs

GALLERY = "movie string, actor_ord int, embedding_path string, embedding array<float>, display_name string, color struct<r:int,g:int,b:int>, text_color string"


def frames(spark, ids, movie="m", length=10):
    path = F.concat(F.lit(f"/frames/{movie}/shot_1/"), F.lpad("id", 6, "0"), F.lit(".jpg"))
    return spark.createDataFrame([(i,) for i in ids], "id long").select(F.lit(movie).alias("movie"), path.alias("path"), F.lit(length).cast("long").alias("length"))


def gallery(spark, *movies):
    rng = np.random.default_rng(1)
    return spark.createDataFrame([(m, i, f"/g/{m}_{i}.pkl", rng.normal(size=64).tolist(), None, None, None) for m in movies for i in range(2)], GALLERY)


def logged(log, detector=stubs.detector):
    def factory():
        inner = detector()

        def detect(batch):
            with open(log, "a") as file:
                file.writelines(p + "\n" for p in batch["path"])
            return inner(batch)

        return detect

    return factory


def seen(log):
    lines = Path(log).read_text().split()
    Path(log).write_text("")
    return sorted(int(p.rsplit("/", 1)[1][:6]) for p in lines)


def ids(run):
    return {(r.image_path, r.det_no): r.face_id for r in run.table("detections").collect()}


def test_only_new_frames_are_detected_and_ids_last(spark, tmp_path):
    log, folder = str(tmp_path / "log"), str(tmp_path / "run")
    make = lambda **more: TaggingRun(spark, folder, Settings(model="w", **more))
    first = make()
    first.detections(frames(spark, range(10, 40)), logged(log))
    assert seen(log) == list(range(10, 40))
    first.embeddings(stubs.wave_embedder, stubs.read_frame)
    before = ids(first)
    assert sorted(before.values()) == list(range(30))

    # A frame with two faces that comes before all others, and frames without faces once more.
    second = make()
    second.detections(frames(spark, [5, *range(10, 40)]), logged(log))
    assert seen(log) == [5]
    after = ids(second)
    assert {k: v for k, v in after.items() if k in before} == before
    assert sorted(set(after.values()) - set(before.values())) == [30, 31]
    second.embeddings(stubs.wave_embedder, stubs.read_frame)
    assert second.embedding_counts == {"saved": 2, "errors": 0, "skipped": 30}

    third = make()
    third.detections(frames(spark, [5, *range(10, 40)]), logged(log))
    assert seen(log) == [] and ids(third) == after
    third.embeddings(stubs.wave_embedder, stubs.read_frame)
    assert third.embedding_counts == {"saved": 0, "errors": 0, "skipped": 32}
    assert second.ledger.seen().groupBy("batch").agg(F.count("*"), F.sum("faces")).orderBy("batch").collect() == [(0, 30, 30), (1, 1, 2)]


def test_frames_that_go_come_back_with_their_ids(spark, tmp_path):
    log = str(tmp_path / "log")
    run = TaggingRun(spark, str(tmp_path / "run"), Settings(model="w"))
    all_ = ids(run) if run.detections(frames(spark, range(12)), logged(log)) else None
    run.detections(frames(spark, range(6)), logged(log))
    fewer = ids(run)
    assert fewer == {k: v for k, v in all_.items() if int(k[0][-10:-4]) < 6} and 0 < len(fewer) < len(all_)
    run.detections(frames(spark, range(12)), logged(log))
    assert ids(run) == all_ and seen(log) == list(range(12))


def test_a_changed_file_is_another_frame(spark, tmp_path):
    log = str(tmp_path / "log")
    run = TaggingRun(spark, str(tmp_path / "run"), Settings(model="w"))
    run.detections(frames(spark, range(6)), logged(log))
    run.embeddings(stubs.wave_embedder, stubs.read_frame)
    before = ids(run)
    seen(log)
    changed = frames(spark, [4, 5], length=11).unionByName(frames(spark, range(4)))
    run.detections(changed, logged(log))
    after = ids(run)
    assert seen(log) == [4, 5] and len(after) == len(before) == 6
    new = {k for k in after if after[k] != before[k]}
    assert {int(k[0][-10:-4]) for k in new} == {4, 5} and min(after[k] for k in new) == 6
    run.embeddings(stubs.wave_embedder, stubs.read_frame)
    assert run.embedding_counts == {"saved": 3, "errors": 0, "skipped": 3}


def test_another_detector_keeps_the_ids_of_equal_boxes(spark, tmp_path):
    def more():
        def detect(batch):
            return [[*faces, (0, 0, 5, 5, 0.1)] for faces in stubs.detector()(batch)]

        return detect

    folder, log = str(tmp_path / "run"), str(tmp_path / "log")
    first = TaggingRun(spark, folder, Settings(model="w"))
    first.detections(frames(spark, range(6)), logged(log))
    before = ids(first)
    second = TaggingRun(spark, folder, Settings(model="w", detector="more"))
    second.detections(frames(spark, range(6)), logged(log, more))
    after = ids(second)
    assert {k: v for k, v in after.items() if k in before} == before
    assert len(after) == 12 and sorted(after.values()) == list(range(12))


def test_a_run_that_broke_off_leaves_nothing(spark, tmp_path):
    folder, log = str(tmp_path / "run"), str(tmp_path / "log")
    run = TaggingRun(spark, folder, Settings(model="w"))
    write = run.ledger.frames.write
    run.ledger.frames.write = lambda *_: (_ for _ in ()).throw(RuntimeError("broke off"))  # after the faces, before the commit
    with pytest.raises(RuntimeError, match="broke off"):
        run.detections(frames(spark, range(30)), logged(log))
    run.ledger.frames.write = write
    assert run.ledger.faces.numbers() == [0] and run.ledger.frames.numbers() == []
    run.detections(frames(spark, range(9)), logged(log))
    assert sorted(ids(run).values()) == list(range(9))


def test_frames_that_failed_are_shown_again(spark, tmp_path):
    def picky():
        def detect(batch):
            if any(p.endswith("000007.jpg") for p in batch["path"]):
                raise RuntimeError("no")
            return stubs.detector()(batch)

        return detect

    folder, log = str(tmp_path / "run"), str(tmp_path / "log")
    run = TaggingRun(spark, folder, Settings(model="w", detection_batch=1))
    run.detections(frames(spark, range(9)), logged(log, picky))
    assert run.table("detection_errors").count() == 1 and len(ids(run)) == 8
    seen(log)
    run.detections(frames(spark, range(9)), logged(log))
    assert seen(log) == [7] and run.table("detection_errors").count() == 0 and sorted(ids(run).values()) == list(range(9))


def test_unread_batches_and_repeated_rows(spark, tmp_path):
    table = BatchedTable(spark, str(tmp_path / "t"), STAGES["search_errors"])
    assert table.numbers() == [] and table.read([]).columns == ["movie", "error", "batch"]
    one = spark.createDataFrame([("m", "x")], STAGES["search_errors"])
    table.write(one, 0)
    table.write(one, 12)
    table.write(one.union(one), 0)
    assert table.numbers() == [0, 12] and table.read([0, 12]).groupBy("batch").count().orderBy("batch").collect() == [(0, 2), (12, 1)]
    run = TaggingRun(spark, str(tmp_path / "run"), Settings(model="w"))
    twice = frames(spark, range(6)).unionByName(frames(spark, range(6)))
    assert run.detections(twice, stubs.detector).count() == 6


def test_ids_of_equal_rows(spark):
    known = spark.createDataFrame([("a", None, 7), ("a", None, 3), ("b", "x", 5)], "k string, l string, id long")
    rows = spark.createDataFrame([("a", None, 2), ("a", None, 1), ("a", None, 3), ("b", "y", 1), ("b", "x", 9)], "k string, l string, n int")
    out = numbering.extend_ids(rows, known, ["k", "l"], [F.col("n"), F.col("k")], "id", 8)
    assert sorted(map(tuple, out.collect()), key=lambda r: r[3]) == [("a", None, 1, 3), ("b", "x", 9, 5), ("a", None, 2, 7), ("b", "y", 1, 8), ("a", None, 3, 9)]


# -- settings by movie --


def configured(spark, rows):
    return spark.createDataFrame([{**dict.fromkeys(CONFIG.fieldNames()), **r} for r in rows], CONFIG)


def test_limits_by_movie_equal_separate_searches(spark):
    rng = np.random.default_rng(3)
    rows = [(f"m{i % 4}", i, rng.normal(size=8).tolist(), "/x", (0.0, 0.0, 1.0, 1.0), 0.5) for i in range(200)]
    faces = spark.createDataFrame(rows, "movie string, face_id long, embedding array<float>, image_path string, bbox struct<x1:double,y1:double,x2:double,y2:double>, confidence double")
    actors = [(f"m{m}", a, f"/g/{m}_{a}.pkl", rng.normal(size=8).tolist(), k) for m, k in enumerate((2, None, 7, 50)) for a in range(3)]
    own = spark.createDataFrame(actors, "movie string, actor_ord int, embedding_path string, embedding array<float>, k int")
    got = search.match_faces(faces, own, "k", within="movie")
    want = [search.match_faces(faces.where(f"movie = 'm{m}'"), own.where(f"movie = 'm{m}'"), k, within="movie") for m, k in enumerate((2, None, 7, 50))]
    assert sorted(map(repr, got.collect())) == sorted(repr(r) for w in want for r in w.collect())
    assert got.groupBy("movie").count().orderBy("movie").collect() == [("m0", 6), ("m1", 150), ("m2", 21), ("m3", 150)]
    with pytest.raises(ValueError, match="positive"):
        search.match_faces(faces, own.withColumn("k", F.lit(0)), "k", within="movie")
    assert search.match_faces(faces, own.limit(0), "k", within="movie").count() == 0


def test_each_stage_is_one_job_whatever_the_settings(spark, tmp_path):
    """Three movies of different settings: their own batches, models, limits and thresholds, in one run."""
    sizes = str(tmp_path / "sizes")

    def detector():
        inner = stubs.detector()

        def detect(batch):
            with open(sizes, "a") as file:
                file.write(f"{batch['movie'].iat[0]} {len(batch)} {batch['movie'].nunique()}\n")
            return inner(batch)

        return detect

    def tilted():
        return lambda crops: -np.asarray(stubs.wave_embedder()(crops))

    config = configured(spark, [
        {"movie": "a", "embedding_model": "wave", "top_k": 3, "face_detection_batch_size": 2},
        {"movie": "b", "embedding_model": "tilted", "similarity_threshold": 0.05, "face_detection_batch_size": 5},
        {"movie": "c", "embedding_model": "lost", "top_k": 1, "face_detection_batch_size": 2},
    ])
    listing = frames(spark, range(9), "a").unionByName(frames(spark, range(30), "b")).unionByName(frames(spark, range(9), "c"))
    run = ConfiguredRun(spark, config, str(tmp_path / "run"), lambda roots: listing)
    own = gallery(spark, "a", "b", "c")
    run.run(own, own, detector, {"wave": stubs.wave_embedder, "tilted": tilted}, stubs.read_frame)
    most = {}
    for line in Path(sizes).read_text().splitlines():
        movie, n, _ = line.split()
        most[movie] = max(most.get(movie, 0), int(n))
    assert most["a"] <= 2 and most["b"] <= 5
    matches = run.table("matches").groupBy("movie").count().orderBy("movie").collect()
    assert matches == [("a", 6), ("b", 60)]
    scores = [r.similarity_score for r in run.table("matches").where("movie = 'b'").collect()]
    drawn = {r["movie"]: r["count"] for r in run.table("annotation_plan").groupBy("movie").count().collect()}
    assert drawn == {"a": 6, "b": sum(s >= 0.05 for s in scores)}
    assert {r.movie: r.status for r in run.status().collect()} == {"a": "success", "b": "success", "c": "failed"}
    assert run.errors().collect() == [("c", "no embedder for model lost")]

    # The movies alone, under constant settings, have the same results.
    alone = TaggingRun(spark, str(tmp_path / "alone"), Settings(model="tilted", threshold=0.05))
    alone.run(frames(spark, range(30), "b"), gallery(spark, "a", "b", "c").where("movie = 'b'"), own, stubs.detector, tilted, stubs.read_frame)
    columns = ["frame_image_path", "rank", "actor_name", "similarity_score"]
    assert sorted(map(tuple, run.table("matches").where("movie = 'b'").select(*columns).collect())) == sorted(map(tuple, alone.table("matches").select(*columns).collect()))


def test_skip_flags_by_movie(spark, tmp_path):
    folder, log = str(tmp_path / "run"), str(tmp_path / "log")
    own = gallery(spark, "a", "b")
    settings = [{"movie": m, "embedding_model": "wave", "top_k": 2} for m in ("a", "b")]

    def run(rows, *parts):
        made = TaggingRun(spark, folder, settings_table(configured(spark, rows)))
        listing = parts[0].unionByName(parts[1])
        return made.run(listing, own, own, logged(log), {"wave": stubs.wave_embedder}, stubs.read_frame)

    first = run(settings, frames(spark, range(6), "a"), frames(spark, range(6), "b"))
    assert len(seen(log)) == 12
    kept = sorted(map(tuple, first.table("matches").where("movie = 'a'").collect()))
    plan = sorted(map(repr, first.table("annotation_plan").where("movie = 'a'").collect()))
    skip = {n: True for n in ("skip_face_detection", "skip_embedding_generation", "skip_actor_search", "skip_image_generation")}
    second = run([{**settings[0], **skip, "top_k": 1}, {**settings[1], "top_k": 1}], frames(spark, range(9), "a"), frames(spark, range(9), "b"))
    assert seen(log) == [6, 7, 8]  # of movie b
    assert sorted(map(tuple, second.table("matches").where("movie = 'a'").collect())) == kept
    assert sorted(map(repr, second.table("annotation_plan").where("movie = 'a'").collect())) == plan
    assert second.table("matches").where("movie = 'b'").count() == 2
    assert second.table("detections").groupBy("movie").count().orderBy("movie").collect() == [("a", 6), ("b", 9)]


def test_settings_table_takes_defaults(spark):
    row = settings_table(configured(spark, [{"movie": "m", "embedding_model": "a", "skip_actor_search": True}])).first()
    default = Settings(model="a", skip_search=True)
    assert row.asDict() == {"movie": "m", **default.__dict__}


# -- best matches kept up to date --


def plain_matches(run):
    columns = ["frame_image_path", "rank", "actor_name", "similarity_score", "face_id"]
    return sorted(map(tuple, run.table("matches").select(*columns).collect()))


def test_later_runs_score_new_faces_only_and_equal_a_full_search(spark, tmp_path, monkeypatch):
    scored = []
    inner = search.match_faces
    monkeypatch.setattr("castframe.plans.tagging.match_faces", lambda faces, *more, **how: scored.append(faces) or inner(faces, *more, **how))
    folder, own = str(tmp_path / "run"), gallery(spark, "m")

    def run(n, k=3, actors=own, at=folder):
        made = TaggingRun(spark, at, Settings(model="w", top_k=k))
        return made.run(frames(spark, range(n)), actors, own, stubs.detector, stubs.wave_embedder, stubs.read_frame)

    def fresh(n, k=3, actors=own):
        made = run(n, k, actors, str(tmp_path / f"fresh-{n}-{k}"))
        scored.pop()
        return [r[:4] for r in plain_matches(made)]

    run(30)
    assert scored.pop().count() == 30
    grown = run(60)
    plan = scored[-1]._jdf.queryExecution().optimizedPlan().toString()
    assert scored.pop().count() == 30 and "batch" in plan  # the later half alone
    assert [r[:4] for r in plain_matches(grown)] == fresh(60)
    again = run(60)
    assert scored.pop().count() == 0 and plain_matches(again) == plain_matches(grown)
    # Another limit, other actors, or matched faces that went: all faces are scored.
    assert [r[:4] for r in plain_matches(run(60, 5))] == fresh(60, 5)
    assert scored.pop().count() == 60
    other = own.withColumn("embedding", F.transform("embedding", lambda x: -x))
    run(60, 5, other)
    assert scored.pop().count() == 60
    assert [r[:4] for r in plain_matches(run(30, 5, other))] == fresh(30, 5, other)
    assert scored.pop().count() == 30


def test_merged_matches(spark):
    columns = "rank long, similarity_score double, face_id long, actor_embedding_path string"
    stored = spark.createDataFrame([(1, 0.9, 4, "a"), (2, 0.5, 2, "a"), (1, 0.1, 2, "b")], columns)
    later = spark.createDataFrame([(1, 0.9, 1, "a"), (2, 0.5, 2, "a"), (1, 0.3, 9, "c")], columns)
    got = sorted(map(tuple, search.merge_matches(stored, later, 2).collect()), key=lambda r: (r[3], r[0]))
    assert got == [(1, 0.9, 1, "a"), (2, 0.9, 4, "a"), (1, 0.1, 2, "b"), (1, 0.3, 9, "c")]


# -- listing --


def test_folders_are_listed_in_tasks_and_filters_come_first(spark, tmp_path):
    for movie in ("a", "b"):
        for name in ("shot_1/x/1.jpg", "shot_1/x/2.png", "shot_1/3.txt", "shot_2/4.jpeg", "5.jpg", "shot_2/.jpg", "shot_2/README", "shot_2/6.JPG"):
            file = tmp_path / movie / name
            file.parent.mkdir(parents=True, exist_ok=True)
            file.write_bytes(b"x" * len(name))
    roots = spark.createDataFrame([(m, str(tmp_path / m)) for m in ("a", "b", "none")], "movie string, folder string")
    files = folder_listing(spark, roots)
    assert files.count() == 16
    images = {(r.movie, r.path[len(str(tmp_path)) + 3 :], r.length) for r in listed_frames(spark, roots).collect()}
    wanted = ("shot_1/x/1.jpg", "shot_1/x/2.png", "shot_2/4.jpeg", "5.jpg", "shot_2/.jpg")
    assert images == {(m, n, len(n)) for m in ("a", "b") for n in wanted}
    assert {tuple(r) for r in walk_frames(roots).collect()} == {tuple(r) for r in listed_frames(spark, roots).collect()}
    one = files.where("movie = 'b' and suffix = 'jpg'")
    assert " = " not in one._jdf.queryExecution().executedPlan().toString().split("BatchScan")[0]  # Spark has only to look for nulls
    assert one.count() == 3 and one.rdd.getNumPartitions() == 3  # the root and its two folders


def test_filters_of_the_listing():
    reader = FrameReader([["a", "/a"], ["b", "/b"]])
    kept = list(reader.pushFilters([In(("movie",), ("b", "c")), EqualTo(("suffix",), "jpg"), EqualTo(("length",), 3)]))
    assert reader.roots == [["b", "/b"]] and reader.suffixes == {"jpg"} and kept == [EqualTo(("length",), 3)]
    assert [p.path for p in FrameReader([]).partitions()] == [""] and next(FrameReader([]).read(FrameReader([]).partitions()[0])).num_rows == 0


# -- tables in buckets --


def test_tables_in_equal_buckets_are_joined_where_they_lie(spark, tmp_path):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        detections = spark.range(500).select(F.col("id").alias("face_id"), F.concat(F.lit("/"), F.floor(F.col("id") / 3)).alias("image_path"))
        vectors = spark.range(0, 500, 2).select(F.col("id").alias("face_id"), F.array(F.col("id").cast("float")).alias("embedding"))
        stored = [save_bucketed(df, f"bucketed_{name}", str(tmp_path / name), buckets=8) for name, df in (("detections", detections), ("embeddings", vectors))]
        assert len(list((tmp_path / "detections").glob("*.parquet"))) == 8
        joined, missing = with_embeddings(*stored), stored[0].join(stored[1], "face_id", "left_anti")
        for frame in (joined, missing):
            assert frame.count() == 250
            assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in with_embeddings(detections, vectors)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in ("detections", "embeddings"):
            spark.sql(f"DROP TABLE IF EXISTS bucketed_{name}")


# -- summaries that merge --

SCORED = "movie string, actor_name string, similarity_score double, frame_image_path string"


def test_united_states_equal_a_full_summary(spark):
    rng = np.random.default_rng(2)
    rows = [(f"m{i % 5}", f"a{i % 3}", float(rng.normal()), f"/{i % 400}") for i in range(3000)] + [("m0", None, 1.0, "/"), (None, "a9", 0.5, None)]
    matches = spark.createDataFrame(rows, SCORED)
    states = summary_states(matches.where("movie in ('m0', 'm1')"))
    more = new_states(matches, states)
    assert {r.movie for r in more.collect()} == {"m2", "m3", "m4", None}
    states = states.unionByName(more)
    assert new_states(matches, states).count() == 0
    united = united_summary(states)
    exact = actor_summary(matches)
    assert sorted(map(tuple, united.drop("images").collect())) == sorted(map(tuple, exact.collect()))
    images = {r.actor_name: r.n for r in matches.where("actor_name is not null").groupBy("actor_name").agg(F.countDistinct("frame_image_path").alias("n")).collect()}
    assert all(abs(r.images - images[r.actor_name]) <= 0.05 * images[r.actor_name] for r in united.collect())
    assert united_summary(summary_states(matches.limit(0))).count() == 0


# -- images --


def rendered(spark, n, bad=()):
    rows = [(f"/f/{i}.jpg", f"m/shot_1/{i}.jpg", "processed", 2, None, 2, 2, 3, bytearray([i] * 12)) for i in range(n) if i not in bad]
    rows += [(f"/f/{i}.jpg", f"m/shot_1/{i}.jpg", "skipped", 0, "missing", None, None, None, None) for i in bad]
    return spark.createDataFrame(rows, RENDERED).repartition(3)


def storing():
    def write(path, pixels):
        Path(path).write_bytes(pixels.tobytes())

    return write  # a nested function travels to the tasks by value


store = storing()


def test_published_images_are_whole(spark, tmp_path):
    path = str(tmp_path / "images")
    write_images(rendered(spark, 20, {3}), path, store)
    rows = published_images(spark, path).collect()
    assert len(rows) == 20
    for r in rows:
        number = int(r.save_path.rsplit("/", 1)[1][:-4])
        assert (r.file is None) == (number == 3)
        if r.file:
            assert Path(r.file).read_bytes() == bytes([number] * 12)
    write_images(rendered(spark, 2).withColumn("save_path", F.concat(F.lit("n/"), "save_path")), path, store, "append")
    assert published_images(spark, path).count() == 22
    write_images(rendered(spark, 5), path, store)
    assert published_images(spark, path).count() == 5
    assert published_images(spark, str(tmp_path / "none")).count() == 0


def test_an_image_that_cannot_be_stored_is_an_error_row(spark, tmp_path):
    def full(path, pixels):
        if path.endswith("/4.jpg"):
            raise OSError("disk")
        Path(path).write_bytes(pixels.tobytes())

    write_images(rendered(spark, 6), str(tmp_path / "i"), full)
    rows = {r.save_path: r for r in published_images(spark, str(tmp_path / "i")).collect()}
    lost = rows["m/shot_1/4.jpg"]
    assert (lost.status, lost.error, lost.faces_drawn, lost.file) == ("error", "OSError: disk", 0, None) and len(rows) == 6


def test_an_aborted_job_publishes_nothing(spark, tmp_path):
    path = str(tmp_path / "images")
    write_images(rendered(spark, 3), path, store)
    broken = rendered(spark, 9).withColumn("status", F.when(F.col("save_path").like("%/7.jpg"), F.raise_error(F.lit("no"))).otherwise(F.col("status")))
    with pytest.raises(Exception, match="no"):
        write_images(broken, path, store)
    assert published_images(spark, path).count() == 3


RETRIED = """
import sys
from pathlib import Path
sys.path[:0] = [{root!r}]
from pyspark.sql import SparkSession
from castframe.schema import RENDERED
from castframe.session import ship
from castframe.sinks.images import published_images, write_images
from castframe.sinks.tables import save_bucketed
from castframe.sources.frames import walk_frames
from castframe.sources.listing import FrameReader, folder_listing, listed_frames
from castframe.sources.tables import with_embeddings
import json
spark = SparkSession.builder.master("local[2, 4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
ship(spark, "castframe")
rows = [(f"/f/{{i}}.jpg", f"m/{{i}}.jpg", "processed", 1, None, 2, 2, 3, bytearray([i] * 12)) for i in range(12)]

def fails_once(path, pixels):
    Path(path).write_bytes(pixels.tobytes())
    with open({log!r}, "a") as file:
        file.write(path + "\\n")
    if path.endswith("/7.jpg"):
        try:
            Path({flag!r}).touch(exist_ok=False)
        except FileExistsError:
            return
        import os
        os._exit(1)  # the worker is lost after it has written the image

write_images(spark.createDataFrame(rows, RENDERED).coalesce(2), {path!r}, fails_once)
print("RESULT", json.dumps([(r.save_path, r.file) for r in published_images(spark, {path!r}).collect()]))
"""


def test_a_task_that_fails_once_leaves_each_image_once(tmp_path):
    root = str(Path(__file__).resolve().parent.parent)
    path, log = str(tmp_path / "images"), str(tmp_path / "log")
    code = RETRIED.format(root=root, path=path, log=log, flag=str(tmp_path / "flag"))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    published = json.loads(next(x for x in done.stdout.splitlines() if x.startswith("RESULT"))[7:])
    assert sorted(p for p, _ in published) == sorted(f"m/{i}.jpg" for i in range(12))
    written = Path(log).read_text().split()
    assert len(written) > 12 and len({f for _, f in published}) == 12  # some were written twice, none is published twice
    for save_path, file in published:
        assert Path(file).read_bytes() == bytes([int(save_path[2:-4])] * 12)
